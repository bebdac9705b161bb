"""Digests of the canonical forms of public licences in their usual variants.

Made from the published texts (as Debian and Rust ship them): with and without
title lines, with and without what follows the end of the terms, with and without
"All rights reserved", numbered and with bullets.  The texts themselves are not
kept here.
"""

#: SHA-256 of the canonical form, and the licence.
DIGESTS = {
    "135f996b0799264a94667b307181b4e708ac75af3dd183e62a37bd0555cbf0cc": "0BSD",
    "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c": "0BSD",
    "2f0e9bd97d3840ad1794cac641471cf4d96238da7ce4079fc79a8d414f6e3920": "0BSD",
    "33ccc2d840a9938a4483b8a877fbf1d4b1489afb1342a3251de9049ef1610849": "0BSD",
    "35c04e36cbd561c5b426fab4e84812826ba04258dc2859f780241153dea18a30": "0BSD",
    "39940ee96cfc4ad10916b4d3d0cd7421ef7624fcf0751d448987405ca979812e": "0BSD",
    "510a99e694b6764d1241887dc17a84f512915b769b51489b1d8613ca7140f7dd": "0BSD",
    "53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe": "0BSD",
    "5e19b64a719ef9785b8a1f6a2f174eb20769fa2d1721c9a7c5094bfa077cbe37": "0BSD",
    "6820e47cea55bb970e15bee1f23b10bef25138068783973d0c26849437cd5a70": "0BSD",
    "843df9be100ab21a2776200c2594361c829160bb555f44ab1bcdc07b87066bee": "0BSD",
    "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153": "0BSD",
    "1d2490e65bade4b7cde700178105759a1eeb6ed401841c01b9ff35e40e55c5ad": "Apache-2.0",
    "36bf4bc3f65a3a3715a27446fcc6e075c896e3b75cb615136b59a98da8c2d2c8": "Apache-2.0",
    "4d6aa515071f3f6f2188c96599b6a575fc0fb402afa0ec1ad84d4f0fabe15cd5": "Apache-2.0",
    "594673f8fe0542761280c31fa6f0d1eca9f491e533af6c2c1fef40b1c4229b47": "Apache-2.0",
    "8bc274b78ed86c607ba1cda8907d306bdcd748d87218adf3dcc786d7f5be76c9": "Apache-2.0",
    "e9dbf930ca0f1e090ec68da9a37b657d11bc9e43b30643455d6a96dbf73116ca": "Apache-2.0",
    "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100": "Apache-2.0",
    "97bd96ea1c5d75f32c9c4927909952ddf90c84f45667ae582acd3879d9fbe4f1": "Artistic-1.0-Perl",
    "ddb49d591ecc4f65a223b9f53f330918100c323532a653c090d21b38e35a3a42": "Artistic-1.0-Perl",
    "0ab44528181380371fb3cb9319cdd62cf38ed4fd817ac464ceb8a4228a0550dc": "BSD-2-Clause",
    "103c98ea1dcdfdbeeec27381a3e18ee35543712a782539739ec6a31d25bc28bd": "BSD-2-Clause",
    "117fa84a7ffb2cb3a2ba7d18dd284e7283b034d6fb6c6419721ee4e28b5306fe": "BSD-2-Clause",
    "1717ff2b1e6acb44b4bb425448cac8096179fd05f0d9ea5a622a60d9409d56fb": "BSD-2-Clause",
    "18a4ded338bbc2e1519cd794de3c17e3d5fe9628e240824c584fecdebe777a72": "BSD-2-Clause",
    "1d5ec6b24c5439f092c1777bef5f062494697d22e92a253e56c520a87913b541": "BSD-2-Clause",
    "1e519f8916dca74c89371617f4339d40a4ed3bb71e801c14aa72e8071bafaf81": "BSD-2-Clause",
    "218f5b650f149e23f159537f8b1ab16d0ff44722e0038a34bb90a58b3442864a": "BSD-2-Clause",
    "239190ee903aca2851ccd5099cd7954d026d60f9b9f98e391ca652499c6aaae1": "BSD-2-Clause",
    "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2": "BSD-2-Clause",
    "2745cc0a63b844cf79449cfeb9dbecb681f38d964a1341225821c2b2e836d0d0": "BSD-2-Clause",
    "2bbe1638c7a6f76c36f79582146b108b4b5e8ccc26b0fbc25f3e6fd6bed52e5d": "BSD-2-Clause",
    "2bfab67fd08a288050e6f725dc171b3e356dc50a4b04b23b6d5e27b6fe7ff639": "BSD-2-Clause",
    "2c570d136b858b0a4d090e301862eacb53fb1ae2743462bf3b89e602191665f7": "BSD-2-Clause",
    "2e9901df2d3cdd9b2ad2d0541a98d0ffe16ec6a54494b7837b493c08b3bde071": "BSD-2-Clause",
    "33903615089fdb3ab02696d1bd92eb9580c2c7a0e0c8714aa95b0dfc1dcdb89c": "BSD-2-Clause",
    "3686d5f539e94a6730fda8d848a8217078e82b810ce27a464ab76bb7bc48dc14": "BSD-2-Clause",
    "3851d34d50dcbb9256e3af58b5c99e83430619b6380f4adc9b118e7abf80bce6": "BSD-2-Clause",
    "3908db6da1d6e327ee8740e2a737a39f57507fc61785579161225a8e5eaaad1e": "BSD-2-Clause",
    "39a218d326b053017477f11ba35cee9d26fdac59f5656824e14e35aad6ac5ace": "BSD-2-Clause",
    "39bf1f2d26ae8c366dc83591039be7f0d61a26df3e0791f80c2e7dea787c89cb": "BSD-2-Clause",
    "3bfc40dc35ca19ea12ffdd1328ba438182a49a0b15316e18990912ba5e8728e6": "BSD-2-Clause",
    "3cda1d3fa664590c3102119604fc865e9e9170866a82b19bdecbdd1e6b7381a9": "BSD-2-Clause",
    "3ec94d771c239cd0693d2699953dce84d6c7aac6c4f1bd1c97864e1da9908716": "BSD-2-Clause",
    "40c90f6c9238d3566db0815d918a429881073d60e82c7bec1eb0155a8913d98c": "BSD-2-Clause",
    "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2": "BSD-2-Clause",
    "4b12427c919036fc08e3d3d6bda2d2d0fed58212d4c5dfc57237af4a66887098": "BSD-2-Clause",
    "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374": "BSD-2-Clause",
    "60f16c0da00f56775f1c3d6f9311b0e5f29ed6dd2f77116f234901743ce04e48": "BSD-2-Clause",
    "63151a500234e07ef3e50814b0d1d07db92c9481191003b577fbf42336ed40a0": "BSD-2-Clause",
    "68f54bd97d77aa7c6d7a3706ff20555e202ff9393a9e5eaf4f0ebede2ff51a1f": "BSD-2-Clause",
    "69cdbd21a2d990e706160e435568bdf1c22727c4ed2cab0cfaa1b78b3904ced3": "BSD-2-Clause",
    "6a5d49c15e02e9e94957d78177d86e8631be9a19549a7cfd2e8c3be2699f00b9": "BSD-2-Clause",
    "6b5d123c4e3497cba88844d845ccce94cdc9289a67dc4f061541c717d83fd85c": "BSD-2-Clause",
    "6e7a812c94c21565e57090a9d12200f36dbcf7537bf22ee860a7c3bc8a112122": "BSD-2-Clause",
    "759fbc88d1a61bf63640c42d23a213634de667f3d7ae64bc844d566a6cb7dd57": "BSD-2-Clause",
    "7acc61f0bd7743a1042c6d3379cd94a4a424b18f97fc7b342a2253b92e8082dc": "BSD-2-Clause",
    "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2": "BSD-2-Clause",
    "7c37d31c659b5b27892d66ad6ef68598af2a48bca290f0a9a650944f5cb9128b": "BSD-2-Clause",
    "7f95da13444a9a910b4f7fefbd81c8a1a6b59124899aa16d19d9ca717bb5e26d": "BSD-2-Clause",
    "848d8414baba42cee479fa71ffa22ef9ec4b39f478316a6c872197c6a55e1412": "BSD-2-Clause",
    "85c46767b6234227cebe127f5c22b9ede02ee48dda5f148ccefe8432c4d93221": "BSD-2-Clause",
    "8c578795c7eaefda33b03bcd1b5617be4f3266067b6f02a35de87c3951efe8e2": "BSD-2-Clause",
    "8e9dce55587c09da7adb0f3cfc5a8497b73e26aad978f536499fc078a7f8892c": "BSD-2-Clause",
    "9065833a6eaafa5a9c5469b09a210e06f425c9bd898ba15ba1282ba620445276": "BSD-2-Clause",
    "957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd": "BSD-2-Clause",
    "95c73627cc387ec5d01a1a283ff61cfc383ee2f6a6674a9cd32bb6bab5523cef": "BSD-2-Clause",
    "982589ab4ef486a958cd7491482ccd8c49f9642dbec1ec15dc8c42fb34e1be4f": "BSD-2-Clause",
    "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74": "BSD-2-Clause",
    "9c47a682ef64c4e02c50c208384916c7f80087d4e4395b2b06e65a4c4b08b152": "BSD-2-Clause",
    "a11471bc40750a21bd4508891b5626642657a09eaa0ef1ec576be7d37fe5ada8": "BSD-2-Clause",
    "a15fcc0daac5f45ce67b8232a31ffb9da0dd18505ef702a3726b8d923d9971e9": "BSD-2-Clause",
    "a22a1b1fd2de7816d322e7e5704778af52b1861158deb8a3cc441af54046dc0f": "BSD-2-Clause",
    "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30": "BSD-2-Clause",
    "aef99695204288c3828a4d0acd9e62a735a6c1781beaa3aee4aeb504f1f112db": "BSD-2-Clause",
    "b02d799e391838a73a0ccc75692ba88eafccab18abbd5f907e855d22048655d4": "BSD-2-Clause",
    "b070fd5d70d88d2dc201bf62e27cd5c1a36261a7b51912e5e4f044a2081fc2be": "BSD-2-Clause",
    "b265945940ccdc41492a8c56728fe75bfaf767b67d176e33b2649c7dcf426893": "BSD-2-Clause",
    "b27ae1244cfe7ac22545c64d69df9d6f21fefc643e67fffab979dcb62c1df56b": "BSD-2-Clause",
    "b9578a124b7f83b06b28da656e009d5188b5c664c402b7c018c56cfaeb24b00a": "BSD-2-Clause",
    "bc1e385eb5d19c6613b84fb0a516cbaef80caefb192cf62a0c520c07f0fcab07": "BSD-2-Clause",
    "cd9b30ab197f107db04da00f4378e43d4fd8ee50988ed680ff3fed81106cb1a8": "BSD-2-Clause",
    "ce4f857e309d0c127ba303aa24cf408c9495660c6a52f3d7e245cd7ed052d2a2": "BSD-2-Clause",
    "dfb735646da984cb814b2aab18aef097d6e575950073bd82353f618e44014642": "BSD-2-Clause",
    "e74f02edf06350e22d771b60d0580c53e28783fd12eda06abd03dab1348bc9d9": "BSD-2-Clause",
    "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9": "BSD-2-Clause",
    "eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc": "BSD-2-Clause",
    "ef3c818b28792f48774a4d16b461004c5e21338f9f74f2664f41f86803c30d60": "BSD-2-Clause",
    "f12994e03bd5c0c39a53247b091a1066818635f9b776c60626bcfae4babf953f": "BSD-2-Clause",
    "f4befedc01589c90d5effeae5f64453726c8fded8e4b6fe6c36f99d303581f1f": "BSD-2-Clause",
    "f660a20fd170fe8b6282213c3411227a553f1451ee95bd49ed6ca3abe7045314": "BSD-2-Clause",
    "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b": "BSD-2-Clause",
    "002ce4b8f1abc08327f935f87bf49584f7fc46fe8139a530cb4ce445fad613c6": "BSD-3-Clause",
    "007fde9b266f35183b511c8c01994581175bfdaa48438967e905c31fb50ba523": "BSD-3-Clause",
    "05a3bb85527e0f1ba6d76534ce44b32cce88341fd0a377010e24966dd9ef9c2d": "BSD-3-Clause",
    "06ad45966a561f59829f3496a1ae5a8531e12bb8891f87d10370de9e97beb789": "BSD-3-Clause",
    "07002ede2e559c6e97a5ba89a53d7ded83eda46c54cea64eb39745675c2aabfc": "BSD-3-Clause",
    "08f2e85d8a2a51087d4690aa5ebfc9585c1957b0895ac872a5384ad041a8fd0a": "BSD-3-Clause",
    "0bc2b9e886b205d11f39558b21f08473940083d59648f28e13c4f29d52071006": "BSD-3-Clause",
    "0fbd7c43c4bb3e398d262b8e39f58ee0a8709a2b3b6b4bee4e033b3d5755f58d": "BSD-3-Clause",
    "0fd715971b9eef40682d457e9b18f9eb0bdde1b640847b28593e4094f8871915": "BSD-3-Clause",
    "1238550805feaeec7ac6f60c2a1b7b3828c3fb1e9d9d52c718c3b75c7b5ff98e": "BSD-3-Clause",
    "1313e262e1087315ad2c873a88b9fd8a1a8451313b10b1297fc87f53145c729a": "BSD-3-Clause",
    "13bd4956c077751ad193b5da48b859c64ed6922c7c2b69a588be360696d979c1": "BSD-3-Clause",
    "1857da04bd28a635b28fb7b5c0c58da743556aacada6b2cafe03660609f6bacb": "BSD-3-Clause",
    "189c3227b3453c9b65fceda8658fa77fe183c162184e1001de53b798c4683e00": "BSD-3-Clause",
    "1931111684838f37f737a61662a5a45c4c08442048196700a964319911a29117": "BSD-3-Clause",
    "1cd0f1e2443fea8bb72dd99364782efdb5022cecec69208e109c76468d196bf4": "BSD-3-Clause",
    "1e350dc6c2d8da7bca0156ae532678cbfb4baa698831489ad313d2783a9635fa": "BSD-3-Clause",
    "214aa9c28152d6d77e6bebfb4a7511e677f65fdaf94b0fe9c0bb580e0eaf8997": "BSD-3-Clause",
    "2197427e156dd704210ae726a3807f7deae35bc31d7243168c575348f6a5419b": "BSD-3-Clause",
    "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651": "BSD-3-Clause",
    "220781d65cabba526c5f2c828bc0b2be5176762067699c3a6a1d990c34e288e7": "BSD-3-Clause",
    "27a2e1e89e7112620faea164ab107b2aa62736c29f8447674a19f27a4b44d972": "BSD-3-Clause",
    "2a4386d4ecdb97d143f06b73903fc9ff8f6c02d18e34a454e12468669d45c531": "BSD-3-Clause",
    "2ba0b48bd70c17636ca2194611f959dafe940990cbb186e77abda136e46c5ef8": "BSD-3-Clause",
    "2c3afdb63bc3a5f454656d5c80c1480407a68cd0989b45e728ad66617b3da23d": "BSD-3-Clause",
    "2e576cb1e8f7e3f48a93376633ae65f2635ea201a8265512e865364928b3834e": "BSD-3-Clause",
    "311ffd640fdffeb73e7bcf8a56eb2a35ed732f8f4c2e62b7e5535aee04ed1bfc": "BSD-3-Clause",
    "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903": "BSD-3-Clause",
    "37450a2b745ec19f098b8dc723c1f92c8037e6fab7dee592d71e65698dea65b3": "BSD-3-Clause",
    "37663b8e2a704c90e2de7c2e0506b5f3db5a9a59a668ca10b55c7f789a98f9b0": "BSD-3-Clause",
    "38ffde0f12210a2150d1ea1d05287e9b08c64028e69972d38c40799dac6cf92e": "BSD-3-Clause",
    "3baab76da740a6c28ffe82f277fabaf7486397e97e1998f2d5eb337d1b354e9a": "BSD-3-Clause",
    "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9": "BSD-3-Clause",
    "3d59b42d6065453438a2309dacc574bca2e9dfda435d45cbd7ba3786540fd4ef": "BSD-3-Clause",
    "3e66789e4fca5b965b2591c6757ccdfccad56ac08d56bd123408b8ec710ef497": "BSD-3-Clause",
    "3e9e67ce8db6405adaeb80fdfe961cc50bdc63af083c5f0704b6c0455b60ce8b": "BSD-3-Clause",
    "3f5624c0cdb1feccbb8495b4f61e52c91ad57226eb4189958981aec4615d17e9": "BSD-3-Clause",
    "3f9062d37b77f432d026143f524523db97c2548ea18088725df9bb2042bac4b5": "BSD-3-Clause",
    "418027c022345ec370b1c9271eb22b5c5f6670ba86ef8ef468346b0236ff635c": "BSD-3-Clause",
    "4241a91ed59fdc8d1c20d065984925429610744add02cce3becf94e4e83c49f9": "BSD-3-Clause",
    "43f53f92e171cbec89b342d9256b0b2592e598f6e4ef8b2901e32c4263d9bd7a": "BSD-3-Clause",
    "4411fdaedae7ae7738b402b178aba9873fb8cc287c841ad36f8bc543a4ccefd9": "BSD-3-Clause",
    "4442fef7988361bebdc82a51d30d3f239cfd1cc04f08b251524c5be0a4a08d42": "BSD-3-Clause",
    "49f78170991303b4b1169b784d17287d404223096ec7344cff800105bf3104b3": "BSD-3-Clause",
    "4bfb244e03bb8ff80f6efb1a78cded6cfd77aefc484bcea2baaf4096ac8e1f60": "BSD-3-Clause",
    "512445965f1f86aeae6585b7e12edb429f9d0a71215823b4ec32d4efa05ff7b8": "BSD-3-Clause",
    "5185bee4528bf0561fc3a400751abfef8611e120523a84af3e46cafc6a631501": "BSD-3-Clause",
    "518a824aff9df696f332328a14f1849ab1cc7390ff289021ecf3168aa1bc5e84": "BSD-3-Clause",
    "51d772108bb6e4c0a1d4b6c34089b05ba86e1c6f34ba03f49dc5d2e99acc7b8c": "BSD-3-Clause",
    "51f2434228efdac9d8998ce4675dea4424a2bb4f8327ce697b9815ddcff10ead": "BSD-3-Clause",
    "5232a6ad26c5aa684c61dc93aab03d96b6818e537ff78705616ab97a72d131db": "BSD-3-Clause",
    "52708ae7496bad323efc341f2b977f4deecc250729644235974381dbffa10b45": "BSD-3-Clause",
    "52c8e1f1387429e4ac2e46a159e2b2d17320de20b05dce03cbd7a7cf9be73702": "BSD-3-Clause",
    "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa": "BSD-3-Clause",
    "534288fd6896829ffd4d5f11629319e7196e3bf37c4fa80240ecc27e5e2e9c32": "BSD-3-Clause",
    "5a6e7ec0b1ac1e224277a8a6d5cd7691ea38298b0308b87a7a2e539d020ed1e0": "BSD-3-Clause",
    "5ac3409b403b0bcb66bf0dca152705ae0e3293c0b0718b2bce0b545907aa413a": "BSD-3-Clause",
    "5c207d7ecf0a192dc8b81acfc1b683482c9df8886e1a066053b7932a1cc5167b": "BSD-3-Clause",
    "5e1ecd488a751b906a60c3a8a118848440c2b9de21f254acc7a7bad0d8cea70f": "BSD-3-Clause",
    "61cb28703f473472657c2e3854b6b6a74761ece5343fba0049e832c57417d1d0": "BSD-3-Clause",
    "63c7a4194d3919af6ccce44c14c2fccfe8ff460b1b2493d84f31b9a8242b7b67": "BSD-3-Clause",
    "67e1d2ba8130577dff2853cf12d8539420a4ff6ea3f278e4f0a68094fb3572a5": "BSD-3-Clause",
    "6879a2e5a31cfbe41662378bd0e807b54603e40ba10bfbeb55484d803ae67da2": "BSD-3-Clause",
    "69d658e1c56a9977edae75ef5f7f6e96ed86e2ef580890a9eda7a9cd7fff0241": "BSD-3-Clause",
    "69e018ff789453a4e0977898aa3d504f77f49a0a1c48bf29c052f60fe9f93e05": "BSD-3-Clause",
    "6e8a618c0ae7ef158f2029790241fac8818b75bfd6ad2ba498e8d58139da61fb": "BSD-3-Clause",
    "6e8b14ab77c6672388994a6913afa2475ded7f0c8006b69905bdc33938e18e8a": "BSD-3-Clause",
    "6f5031a260c81332a40e090d5e58e0f0f98977842cb006396c5a55f924874540": "BSD-3-Clause",
    "6f922c6cb2a22faa1c3d9be59103bf5dc2942321f1c76cc3b6f0772aa184826c": "BSD-3-Clause",
    "6fc618780b44cdca4b29e5e2df831e67dfee9bade4a4996c59b815c2bfdb566c": "BSD-3-Clause",
    "7031e729cfebe01777714351e237951eaf79757daa29627f0d931c4b203e27c6": "BSD-3-Clause",
    "7209b76c0f7f1a4eb893ebe947ccdb9c00031c458154706be049811523b50954": "BSD-3-Clause",
    "7236a925b4417b0a38ce9f48f8806f09a35615fb3acc065fb248c8e96553d770": "BSD-3-Clause",
    "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da": "BSD-3-Clause",
    "74c22f5a0e30ab2136c60ddba8ab29620a08da429d098405616ab44bae747bbf": "BSD-3-Clause",
    "75f5972d9feef193d810245efc3f2be0cae3f78a03190fab436f118a450772c1": "BSD-3-Clause",
    "772e690b4ccedbab458b0984904cac1f24ffaed3d9c388fc7d34a1ec398323a9": "BSD-3-Clause",
    "779f673d35ef269f42b1e4f79bb60b893d6c16d65d658d031ba4ab38b745f603": "BSD-3-Clause",
    "78c86987599189754116c1775160ff935fde871762d940c79878c7a661b77def": "BSD-3-Clause",
    "7bb2a58f1a2613692218c36c4b52e004c6b230ce814c88d01ee7692bc36b3431": "BSD-3-Clause",
    "7ea4cb26971c20c55fa864dc747d47304218d8acf220c036dfe248ae70413c6d": "BSD-3-Clause",
    "85a253fdca75357d8f16143d242204d0c291650df54bf470a94c229f0d848c65": "BSD-3-Clause",
    "8cf70ccb8e5ade01ae2c5cc5be65d9d9740c8eaf8ee3172881167668394a6e10": "BSD-3-Clause",
    "8ec96ac102a1a4e8a51586c5069c7bbf5b233cd4fd6c2e01ef2e376f9fbace63": "BSD-3-Clause",
    "915887aac8394a9f5e03ee871fa74944f1eb3b600132c40032dd63cf063022c5": "BSD-3-Clause",
    "91ac11f4f00a65b8efdaf9acd840fb61dee7a83cdbd51b27a0939b4188201497": "BSD-3-Clause",
    "94a0a44b170114affb7b3975c6987906dca819b6cbd93510aa70be57345a1e3f": "BSD-3-Clause",
    "95a72d217f504646da019411d5c86c32c9904be93a36267894c4621658256f08": "BSD-3-Clause",
    "963afa54a725b4a13b0e421a6ea9c46dc879c500c7119063c9e90fc74495d2a1": "BSD-3-Clause",
    "9aed860e71836790db6841286702ad2929606f4272afc237a759f54cecb9c785": "BSD-3-Clause",
    "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2": "BSD-3-Clause",
    "9f656e5df280f94cdedf147e3429fddf854bc7bdab0aaa1cc17d4701303177b3": "BSD-3-Clause",
    "a72dd4ec7aada245e58f11727b01237341fae553e8ceba8f9b4bfeca2183f9cc": "BSD-3-Clause",
    "ab29b8ba65e56f8455b93d0a1da043b1defb51d8fa0e4e66f0e871b408d116a5": "BSD-3-Clause",
    "ad5ef07dfe7c95d3097c949527169b39dfe530eeeac3eff3ba0111bdd75b6993": "BSD-3-Clause",
    "ae3468cfe69262327fc7d75157315be532fe1399e623f7016c56d5e28221dc76": "BSD-3-Clause",
    "afc81ee99a150bf9ad976d1b4b3bae3ec8fb30e82c7f9ec18d0048b070d2ebc8": "BSD-3-Clause",
    "aff44d9f03d145272cb59e063b396ac9a551dcde6719d47a519325add9919133": "BSD-3-Clause",
    "b072852e05693bd1a4096c8cbe522c04a320fcc39c32585a94afa95631b2d98c": "BSD-3-Clause",
    "b684c740a2e9315b85d2450390fa2a4b706eb9156d704379201d2472c8474c42": "BSD-3-Clause",
    "b6ab7953b6c80a72261014244324a70663f1807fa212f52461b24c95eb16b4a9": "BSD-3-Clause",
    "b939ea8cbe8fec2b5e804679ae3575a5a733c60896f2b7a820c71c3df1c97aad": "BSD-3-Clause",
    "bcdc9821268e45486a6ea3cbf189ba75e335a107261c16ae98625dfc468a9912": "BSD-3-Clause",
    "c00245e0184e3fe353f213406ea77aada800e8600e31b33d5d0df3153d000933": "BSD-3-Clause",
    "c0331c39c531d59f16a69ad10af05c1549721d102a2cc1283ec7e80544180ac8": "BSD-3-Clause",
    "c4cf3734ee780fc89bceb7fb8056ec7ca769e41a0c92900dba65ee3fd1e94ee8": "BSD-3-Clause",
    "c7cd3d829016effefa5b337c24453f558754f8336735dc30c92c89d9dda0cbb8": "BSD-3-Clause",
    "ca7907d36e102a9283309374bec9fd25d45bf72d9d4ad6e3f882c8520e4e3318": "BSD-3-Clause",
    "ca7c285b249d3530f24ad35f883f1ba3e3e4bf82d113028faddca182644ab278": "BSD-3-Clause",
    "cc3432eb2f19bb6fe96706bad75b6fce1039db64fb70486899bf6425dea4d9cb": "BSD-3-Clause",
    "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15": "BSD-3-Clause",
    "ccfb31dda78a4742fc86eca91291c7f48c07ea18bdd7ecadd7b5e4e200615c37": "BSD-3-Clause",
    "ceb36b0173297578925e297a5e163a7f0f988327f28c8eb9654153d4354b2598": "BSD-3-Clause",
    "cf77ee3d20f4076cecdb58fc53aa7204c9f5c0651621abbc85e028f5b2ffa6b4": "BSD-3-Clause",
    "d18a9cf83a168e0fb64a5d254735362137270d0a1260161abd56a7a28c5933cb": "BSD-3-Clause",
    "d1ecc0a46c23dad7f9e13b19b877e5be7ec9d2b9bb05a2dfde2e47be83438590": "BSD-3-Clause",
    "d2acc3ce42d3bdf59e35d53f0cbb8dc10cb44c86ff16b781b203295db375b77b": "BSD-3-Clause",
    "d71b26459af241c9e1dfd46f88409f2f7b7747d3f0263d13b23f41dc4deb0f84": "BSD-3-Clause",
    "d8dd77f3ef4ca914c5a3912b911115fdecf0c5fb892c54461a2ac8890e656a2e": "BSD-3-Clause",
    "da336ff5d6bbb6a30ad59a0dd798c7e6e1e57d719bbb6300725786c3648c658d": "BSD-3-Clause",
    "db2a4edacbe66ccbd0458c05f14b5a62e776155a2e5b17bcb73affecb90d668f": "BSD-3-Clause",
    "dbdfde7fe53358e4d135fcf0485ffc425b2b94f13f57afa9728bfb29ad9c40e5": "BSD-3-Clause",
    "dec27fe65bef05b2373752571c969f57aba0893880df6cf6e89fe967752ae05e": "BSD-3-Clause",
    "dfd287034a64b9ecf6afaf5b63971500de0e8358e61442e8e54163867c749dde": "BSD-3-Clause",
    "e1ad6b10dcbd547d4d23ae33397e8e5606042e7abbaee438b5401cb3ecaa028f": "BSD-3-Clause",
    "e2aada32e626090356c89e4d98985e302c9e365dcd1a6c41d20cf6e9a344056a": "BSD-3-Clause",
    "e327b35e2b01d84b108447cf1bd62958a3a0431b96631ab4f225c0b10e274f1f": "BSD-3-Clause",
    "e4d34334d1e19820930122c7816c18f12fa68d9d4a2a6d91f53e4567cdb02167": "BSD-3-Clause",
    "e612af111b0f62aac3e107973cd804ade8a118ba3c7034d6824ebdce9852ba2e": "BSD-3-Clause",
    "e651765ec94c99c2ea03cf19aceb85785d656ba08685eb0772747c296340cb54": "BSD-3-Clause",
    "e66bec6d28f103dac90df15d737c2ad1f282c74d872d7138af14d8e95633dff4": "BSD-3-Clause",
    "e66dd66a534460058ad87faf0851d13c96157750cd6905a974925e6ded27992e": "BSD-3-Clause",
    "eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658": "BSD-3-Clause",
    "ead42fd7a936748f1212237c987f603707e356d13210a3b6a847ebd53bc0e41d": "BSD-3-Clause",
    "eec5945de45ed76e7be058fa981587e38b34a07d82e06710efcf26574e685d2b": "BSD-3-Clause",
    "f08a870065217ba55342269b9027bb6216422a7e12ca98951254f004a1b524cc": "BSD-3-Clause",
    "f0d9835dca35c7d0b2cd00d60492d48d510a54f3976bd3e8a419a5e983e22f51": "BSD-3-Clause",
    "f0e8834ecda30f77b491c184881feda6b6ffda49013dcecef43738d1c1f2e998": "BSD-3-Clause",
    "f0f31d36c242d704bbeab1dadeda716eead26754c416418285083f4c66da1b20": "BSD-3-Clause",
    "f2f49b468edc6b1259a03d37c9635c3525e11ce7388ab69d63d77cf3755741f2": "BSD-3-Clause",
    "f59184ebbfcc86919dd657cc32bb7c5e8b034bd555eeda05f210a502c7ddd412": "BSD-3-Clause",
    "f6c2b717c893fb12aedf4b06dbd80ad7cbded944221ad74b3c2f37ac75f19f92": "BSD-3-Clause",
    "f6d4b9fb0316366a56d8521018e6a7f7d56bcd82c221368ee3c9d8da5f33a759": "BSD-3-Clause",
    "f8fd13a02eae8e3ff714b8913784e2c1309e9753dd0b6b50eb750d71e1acc729": "BSD-3-Clause",
    "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af": "BSD-3-Clause",
    "ffaf95d85263622292249d95bd4dd4d52fb7022a95e647a4984777cd038657a5": "BSD-3-Clause",
    "def99b23ba8930a02c111ffb99c0c4f55f9fd9bb38ad3ffe9df58fde3aac4247": "CC-BY-SA-4.0",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "a142ae38742c8c4c35f5fa19e0a40ebfa60fc38535daf9c570ca3d7e012e1e32": "CC0-1.0",
    "37db86be8f16e9b8dfb0d63e1698ad2e07d54f312494c1cb2dbdb4fa37487f0f": "GFDL-1.2",
    "df4a7e18cb36653db66ec9376c2dd5d138aec376a4cce12d4424a526290733a8": "GFDL-1.2",
    "1f2021076bd507aed0cd904fc366e864f59df0192d296965d6b993c087505c56": "GFDL-1.3",
    "7befa86e5ee53162018d597eee81db6c727f3e64fab4641af93e19deab1807b4": "GFDL-1.3",
    "422dc6ece1afadb367f2bcdbf6ac496f4c7ad5c973c45cdd09ae377ceb4c8a12": "GPL-1.0",
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc": "GPL-1.0",
    "733356cadf8ca8b0ac2db2d593fb7c1a2b0528c7e891f8a911fdaeb64719fff5": "GPL-1.0",
    "7481518665d2db9ad29e3c605da9055f9b635541a3f6f50caea2de6e014e42f3": "GPL-1.0",
    "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70": "GPL-1.0",
    "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c": "GPL-1.0",
    "4646298f1f69486a71cbb9951aa491f173f0a25d76adfb9a1560a08c75f15daf": "GPL-2.0",
    "51784fcce02e3d6a52a2ec0260f583b9d573810cf33e46bd16fd6a821b36760b": "GPL-2.0",
    "a1e7ba14d8d85807f384435b77f91e925decc43da128311c991c4f2337e44017": "GPL-2.0",
    "aa997bc1c3422ccdc7ccabdc6f9aaa9ce2ebeed7be208887d2b13ff901326c75": "GPL-2.0",
    "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1": "GPL-2.0",
    "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999": "GPL-2.0",
    "e7bc7b2c2e4b763c9c6ceb90a3984a8273193cd39747fbab315ee26296ddd602": "GPL-2.0",
    "40f346cb66de2d05a54b24c1c85082c5387bb36d6258dadb27658d2b1f4bc7de": "GPL-3.0",
    "59a779feaae4de539260be3c8adb19c287a771586d211e12d93932777da37349": "GPL-3.0",
    "607c705f9768e313af3bc7846c6815e61bce971f831a5fd61344a150e8f32b08": "GPL-3.0",
    "b67ed0505c6cda8a9e78afbb7612dc2fb708edfd6852a34b420ffcc001336d21": "GPL-3.0",
    "efb0e35819ae763bd7add32e077414117ad6017f7d79e32447d0f0454f821bbf": "GPL-3.0",
    "f37d587507fc579524cb06d1130d5899891a978ee008cfc033b3b4d95da28bee": "GPL-3.0",
    "f7bb29d9a31c3a1a68ccff0d8d9053350dc0b10b52b62d46d0f2e36a41e32975": "GPL-3.0",
    "0c3817fecffce4796e22e5693f60b8f0db677ce8efce4467505045832a983167": "ISC",
    "1ed7296301d616a11b9a1e23a9f15ed4195117107d1aa7e1b411c2682d11fb98": "ISC",
    "217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a": "ISC",
    "23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1": "ISC",
    "280d76b420aeff51730e96577a2466120c91213f03dd50d60107078c498c5b29": "ISC",
    "2877ba767b634a2af0152c1c7f44b4760c9864e5c3087ed16eccde4ac94b15b2": "ISC",
    "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db": "ISC",
    "4ef101bc56f6e40d78880c2ac2d419af29c50988ec76feeca964b2a5426047e1": "ISC",
    "6319b4b8c6ba7aa89160245576fceabc3b744fb207d435db779dec2c61648e47": "ISC",
    "673f59dc8ad54524704b5b5d2deeb39eec917afad46597b1b7d4f2963edff317": "ISC",
    "71e638daa9a9b5572892642ad3b2898d7860124998d2bff139e1f88d7dd38679": "ISC",
    "78d12b012407f04494ad9447817157c702f9bc389600604ae4e0d6a025f6d32f": "ISC",
    "80c91bc2efd3e78116e00fde9052e737ea04907e8766e36081f7f7c856edfa95": "ISC",
    "8281b7122b87e54b97a6183786fef9b33350db9bfb9141855ea93e09543e1fcc": "ISC",
    "86cadf6b8ff9a33f9f1268672376624474ebcae80a1a08747115581a22146101": "ISC",
    "8ee0d4f927294d5cfe44a2a4b1faecb347cc94d0e53edd910b1abc0f6527865f": "ISC",
    "a6384b33afd7f77584664a3a36644717281a88522df1f957bee8eef971453563": "ISC",
    "bb7a7962f5774a5aa102d77fce97308caa6bead07a624c64b3c0e7e48f6a4bad": "ISC",
    "f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee": "ISC",
    "f9324348da82c2d9b4a0b0b8229973a6806c67a5b5628e587181e15e03c66d69": "ISC",
    "fd4e450e334b5e7722a9cb4a5ef92dda5eeb172eeee17b631a720d12591461b1": "ISC",
    "15f27022abae15e1ab7ca9c1e4a339d03e102d08507e241bd6d18f37debb275e": "LGPL-2.0",
    "4cb9b3374c19e11e661a04fa4a8694f82168f4507728e0db630b16375a598a4f": "LGPL-2.0",
    "5d5e835dc058a7da602999c412a08b84d73452108446791df08b08b89b65d19b": "LGPL-2.0",
    "b4114daa3dfa52e27e78b2c4e17acd58bf4381e812762f4ded0bcb8eabd1092c": "LGPL-2.0",
    "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499": "LGPL-2.0",
    "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c": "LGPL-2.0",
    "28ae034d49051161a24be17469531b301a17289933b35a734703e823295c9e73": "LGPL-2.1",
    "294fb9ec58649c7eb0cf90fc2900ac1b28b82fb6da9d40d7599d6b7d399d4d2e": "LGPL-2.1",
    "359509cf11d8ff3c5d1dcc9af8aef0449aa2f4665124a5f19daa9990ee1c77eb": "LGPL-2.1",
    "423978a4441f371091052e1e5f2731da425f4761edb5a121eb506d5f6bcc78f2": "LGPL-2.1",
    "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c": "LGPL-2.1",
    "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd": "LGPL-2.1",
    "13980739d6423be0921994d8ce3ce547437735b0e6733161f70b19c962f194b7": "LGPL-3.0",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "00a5c934b705d69594539c6a37a1105192217249a30fe111a375560a492639c9": "MIT",
    "0ae6a1449c55564f09306c58e84bcf7429809a582562aa93352d4acfec8c67cf": "MIT",
    "0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c": "MIT",
    "3531a540eb7fa1808dbb5f6dc8560c4272cb8936e306c210468fa3652e79d2ca": "MIT",
    "35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164": "MIT",
    "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f": "MIT",
    "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127": "MIT",
    "7c3366b22b9f0d6a198b2c29bd1c4b663b2d55eacbd066146e5476c4b8ff1ce4": "MIT",
    "8cde46b543036122641d289a848d3900df55f9efa471b2ff7354da3a6e4a113d": "MIT",
    "95d6e15f26b09973979cc939f067e143dab922c3ae8273ea44b568d429da0660": "MIT",
    "9803b59d0b48bc4c33519eaf3d6e133d08c752f8f17a5cd3d6198abdf08e49c4": "MIT",
    "9d602bd8af1e9c9f45a97426917360a8ebf839db41525317fa197d3e6c730b8c": "MIT",
    "c1f96c79406831ccc67467d4539d4ca88200b8e4f29f8c7f46129e5543b7011c": "MIT",
    "fb691d28b64b2a306b30449f04b63780c13263eccc568cc65d7f25fe9748dba2": "MIT",
    "2772c161a7ca5eceb4517ee311d5ee8b30c97502771ed5f826ca5e3856ad5c11": "MPL-1.1",
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6": "MPL-1.1",
    "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9": "MPL-2.0",
    "e07dcdcc3b2c19db7e604dfb1498cc5dafa0e9cecf6ffc44f7c2b093fe9bafc2": "MPL-2.0",
    "bb6c44416437f5ab412ca9d762d4bdae1dc4e6a9c5afc9ac0965eb5e57b4e055": "NCSA",
    "a4915a2dcd67c648b73ad8364858cba28bbfb700e62ca5847e2c30544066e01a": "OFL-1.1",
    "c8872bc68de96ac9828c6f8d80528b3802f565f516a1c3319df506e3bc63409d": "Unicode-3.0",
    "41f84c538b3bc6dcfe6afaab48f6e16c34fd1b11b2c6be7db47873ba3bce291a": "Unlicense",
    "6077a8a20d606206e486caec85a30b2545701071b1e08d12c37fb9a0e490d1bf": "Unlicense",
    "6343a29688390289d15287cc36e2826dba393cc9979176acd38ce2df41614be1": "Unlicense",
    "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd": "Unlicense",
    "9137ac0fab84d2bbd40d528074283e83bc514a40cae572819c6a647f087f1480": "Unlicense",
    "98f0ce274471690740f65dc7288f4c6aafef30303e633390c278a74d426c586e": "Unlicense",
    "b527b4e965100746a31d6f14a64d6d3dbcc3282d27f78dbd60f6af9eda20b602": "Unlicense",
    "d16b8030b26277b62374daad8fb9ea5270cce631a73755d0a4d01a99725ac02b": "Unlicense",
    "d45d2f3d1d02c7163bb92ab5f276f49116a765305e516270b1fe30e33d56400e": "Unlicense",
    "d5c59598465a8119e960a42b8f463f542ca3466b187c4d7597c853a682fd82c6": "Unlicense",
    "e4919515b7fc82e8c51d1cb9dba99c100767f08f55b74aa6ab6abe9f6cc262b3": "Unlicense",
    "e6e60d2037efe58841d698b341a609d8a738effceaadb12ac721e54f8e0bf7db": "Unlicense",
    "068d3cad77633b46ed4e0d287ad8c6e536ae3ed883c0edf6fb7faea9f857421f": "Zlib",
    "0d593737a7a37025e41cf44fd3e6799e3a152c232ee70ca8fd85e75521101d5e": "Zlib",
    "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7": "Zlib",
    "367e6e91e2959f49afeb2296adb5ebad77815396539e23ed3970a359cf1f61a7": "Zlib",
    "54f20eb91901ea3c76ff27cbc291387d261c4acbf89e49b910c20e53cc464425": "Zlib",
    "934a0108ab7101d45c9b0ac6f6774cbf6da6427036e057c269c3231274f06cdf": "Zlib",
    "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a": "Zlib",
    "a5077e3bd5e1fddc16e8af8710c266a83f01fdf5b8008ec357d075ae8185f8b2": "Zlib",
    "c6bf9eea7e43e5b816a3b0fa98bb0b9554e535e8d7ea285a602d2641fac07f15": "Zlib",
    "e8b4b40ce77fe1c6b396712780f759e806aa4252d6177655c74c2f9e80b083db": "Zlib",
    "eb6013e335fc04e68690d7483c75840eea4d8e2c665753e213e400851b72faa0": "Zlib",
    "ee37bc3ccba61ff28a10c05f28bdabf7466db400a75d9a1890fb865cda23e145": "Zlib",
}
