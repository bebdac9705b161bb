"""Operators of a training-data pipeline, and their queries.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries if
the package is there.
"""

from __future__ import annotations

from strata.llm.bpe import op9_forced_boundary_bpe
from strata.llm.hmm import op3_hidden_markov
from strata.llm.lexical import op13_presence_masks
from strata.llm.lexical import oracle as _lexical_oracle
from strata.llm.licences import op8_licence_digest
from strata.llm.licences import oracle as _licence_oracle
from strata.llm.minhash import op7_min_max_hash
from strata.llm.minhash import oracle as _near_duplicate_oracle
from strata.llm.packing import op2_dominance_packing
from strata.llm.phrases import op12_phrase_index
from strata.llm.phrases import oracle as _phrase_oracle
from strata.llm.quality import op6_quadratic_discriminant
from strata.llm.repetition import op1_suffix_repetition
from strata.llm.sharding import op5_stratified_interleave
from strata.llm.substrings import op10_suffix_automata
from strata.llm.substrings import oracle as _substring_oracle
from strata.llm.urls import op11_boosted_urls
from strata.llm.urls import oracle as _url_oracle
from strata.llm.winnowing import op4_winnowing

QUERIES = {f.__name__: f for f in (
    op1_suffix_repetition, op2_dominance_packing, op3_hidden_markov, op4_winnowing, op5_stratified_interleave,
    op6_quadratic_discriminant, op7_min_max_hash, op8_licence_digest, op9_forced_boundary_bpe, op10_suffix_automata,
    op11_boosted_urls, op12_phrase_index, op13_presence_masks,
)}

ORACLES = {"op7_min_max_hash": _near_duplicate_oracle(), "op8_licence_digest": _licence_oracle(), "op10_suffix_automata": _substring_oracle(),
           "op11_boosted_urls": _url_oracle(), "op12_phrase_index": _phrase_oracle(), "op13_presence_masks": _lexical_oracle()}
