"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule names a host (with its subdomains) and the beginning of a path; the longest
rule that fits a URL decides.  All other URLs are judged by trees that were boosted on
labelled URLs, by default those that a rule decides.

Features are integers: length, path depth, digits per thousand characters, entropy of
the characters (hundredths of a bit; case folded, all but ASCII letters and digits one
character), number of parameters, labels, length and marks (digits and hyphens) of the
host, and statistics of its suffixes over all pages: share of the pages under the last
label and under the last two, hosts per thousand pages under the last two.  ``GRID``
holds the thresholds at which a feature may be split.

Training: a tree level is one aggregation of gradients by (node, feature, bin) over the
labelled URLs, which are first counted by their bins and written; only that histogram
(at most 2^depth x all thresholds) reaches the driver, which picks the splits.  Gradients,
hessians and leaf values are integers (millionths), so sums do not depend on the order
and every engine finds the same trees.  Scoring is one expression.  DataFrame functions
only.

``TRAIN_URLS`` bounds the labelled URLs: of more, a share is taken by their hash.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
rule and is judged like any text; ties of splits go to the first feature and the lowest
threshold; without labelled URLs, or with one class only, there are no trees and the
class counts decide (none: allow); equal URLs are judged alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import discard, written

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
TREES, DEPTH, RATE, RIDGE, CHILD = 12, 3, 0.3, 1.0, 0.5
TRAIN_URLS = 1 << 20
ONE = 1_000_000

_SHARES = (1, 2, 5, 10, 20, *range(50, 1000, 50))
#: Thresholds: a split sends ``feature >= threshold`` to the right.
GRID = {
    "length": tuple(range(12, 160, 4)),
    "depth": tuple(range(1, 9)),
    "digits": tuple(range(20, 600, 20)),
    "entropy": tuple(range(200, 520, 10)),
    "params": tuple(range(1, 7)),
    "labels": tuple(range(2, 7)),
    "host_length": tuple(range(6, 50, 2)),
    "host_marks": tuple(range(1, 7)),
    "suffix_pages": _SHARES,
    "domain_pages": _SHARES,
    "domain_hosts": _SHARES,
}
_CHARS = "abcdefghijklmnopqrstuvwxyz0123456789"
_UPPER = _CHARS[:26].upper()


# ------------------------------------------------------------------ parts, rules, features


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z folded), path and query of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _CHARS[:26])
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def longest_first(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value: int | None = None) -> Column:
    """The longest rule that fits, as host and path (``value`` 2: its verdict), or null."""
    out = F.lit(None).cast("string")
    for rule in reversed(longest_first(rules)):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        out = F.when(fits, rule[0] + rule[1] if value is None else rule[value]).otherwise(out)
    return out


def _bits(n: Column) -> Column:
    """1000 * n * log2(n), rounded (0 for 0)."""
    return F.floor(1000 * n * F.log(F.greatest(n, F.lit(1))) / F.log(F.lit(2.0)) + 0.5)


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (a column url, any others) with host, path, the last label and last two
    labels of the host, and the features of the URL alone."""
    own = [F.col(f"`{c}`") for c in pages.columns]
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path, query = parts(url)
    df = pages.select(*own, host.alias("host"), path.alias("path"), query.alias("_query"), F.length(url).alias("length"),
                      F.translate(url, _UPPER, _CHARS[:26]).alias("_low"))
    counts = F.transform(F.array(*map(F.lit, _CHARS)), lambda c: F.length("_low") - F.length(F.replace(F.col("_low"), c, F.lit(""))))
    without = lambda c, gone: F.length(c) - F.length(F.translate(c, gone, ""))
    df = df.select(
        *own, "host", "path", F.col("length").cast("long").alias("length"), counts.alias("_counts"),
        F.substring_index("host", ".", -1).alias("suffix"), F.substring_index("host", ".", -2).alias("domain"),
        F.regexp_count("path", F.lit("[^/]+")).cast("long").alias("depth"),
        without("_low", _CHARS[26:]).cast("long").alias("_digits"),
        F.regexp_count("_query", F.lit("[^&]+")).cast("long").alias("params"),
        F.when(F.col("host") == "", 0).otherwise(without("host", ".") + 1).cast("long").alias("labels"),
        F.length("host").cast("long").alias("host_length"), without("host", _CHARS[26:] + "-").cast("long").alias("host_marks"))
    n = F.greatest("length", F.lit(1))
    other = F.col("length") - F.aggregate("_counts", F.lit(0).cast("long"), lambda a, c: a + c)
    held = F.aggregate(F.concat("_counts", F.array(other)), F.lit(0).cast("long"), lambda a, c: a + _bits(c))
    return (df.withColumn("digits", F.expr("1000 * _digits div greatest(length, 1L)"))
            .withColumn("_held", held).withColumn("_all", _bits(n))
            .withColumn("entropy", F.expr("(_all - _held) div (10 * greatest(length, 1L))"))
            .drop("_counts", "_digits", "_held", "_all"))


def suffix_statistics(pages: DataFrame) -> DataFrame:
    """(domain, suffix_pages, domain_pages, domain_hosts) over all of ``pages`` (host)."""
    hosts = pages.groupBy("host").agg(F.count("*").alias("n"))
    domains = hosts.groupBy(F.substring_index("host", ".", -2).alias("domain")).agg(F.sum("n").alias("n"), F.count("*").alias("hosts"))
    domains = written(domains, "domains")
    # A row a last label: the size of the join is left to Spark's own check.
    suffixes = written(domains.groupBy(F.substring_index("domain", ".", -1).alias("_suffix")).agg(F.sum("n").alias("_n")), "suffixes")
    total = suffixes.agg(F.sum("_n")).first()[0] or 1
    out = domains.join(suffixes, F.substring_index("domain", ".", -1) == F.col("_suffix"))
    return out.select("domain", F.expr(f"1000 * _n div {total}L").alias("suffix_pages"), F.expr(f"1000 * n div {total}L").alias("domain_pages"),
                      F.expr("1000 * hosts div n").alias("domain_hosts"))


# ------------------------------------------------------------------ trees


@dataclass
class Model:
    """Log-odds of block in millionths: ``base`` and, for each tree, splits and leaf values
    by node (root 1, children 2n and 2n + 1)."""

    base: int = 0
    trees: list[tuple[dict[int, tuple[int, int]], dict[int, int]]] = field(default_factory=list)

    def margin(self, at_least) -> Column:
        """``at_least(feature, place)``: whether a row reaches that threshold of the grid."""
        return reduce(lambda a, t: a + _value(t[0], t[1], at_least), self.trees, F.lit(self.base).cast("long"))


def _value(splits: dict, leaves: dict, at_least, node: int = 1) -> Column:
    if node not in splits:
        return F.lit(leaves[node]).cast("long")
    right = at_least(*splits[node])
    return F.when(right, _value(splits, leaves, at_least, 2 * node + 1)).otherwise(_value(splits, leaves, at_least, 2 * node))


def _best(cells: dict[tuple[int, int], tuple[int, int]], ridge: float, child: float):
    """Best split of a node: cells are (feature, bin) -> (gradient, hessian)."""
    by: dict[int, list] = defaultdict(list)
    for (f, b), v in sorted(cells.items()):
        by[f].append((b, *v))
    g_all, h_all = (sum(x[i] for x in by[0]) for i in (1, 2))
    part = lambda g, h: float(g) * float(g) / (float(h) + ridge)
    best = None
    for f, bins in by.items():
        g = h = 0
        for (_, gb, hb), (upper, _, _) in zip(bins, bins[1:]):
            g, h = g + gb, h + hb
            gain = part(g, h) + part(g_all - g, h_all - h) - part(g_all, h_all)
            if min(h, h_all - h) >= child and gain > 1.0 and (best is None or gain > best[0]):
                best = (gain, f, upper, (g, h), (g_all - g, h_all - h))
    return best, (g_all, h_all)


def bounded(labelled: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` of the rows if there are more; whether a row is taken depends on its URL's hash."""
    total = labelled.count()
    return labelled if total <= bound else labelled.where(F.pmod(F.xxhash64("url"), F.lit(ONE)) < F.lit(ONE * bound // total))


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, ridge: float = RIDGE,
          child: float = CHILD, bound: int = TRAIN_URLS) -> Model:
    """Boost trees on ``labelled``: the features and ``blocked`` (boolean), one row a URL."""
    labelled = bounded(labelled, bound)
    names = [f"b{i}" for i in range(len(GRID))]
    bins = [_bin(f).alias(b) for b, f in zip(names, GRID)]
    rows = written(labelled.select(*bins, F.col("blocked").cast("int").alias("y")).groupBy(*names)
                   .agg(F.count("*").alias("n"), F.sum("y").alias("y")), "labelled")
    n, y = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    model = Model(rows.sparkSession.range(1).select(_log_odds(F.lit(y), F.lit(n))).first()[0])
    if not 0 < y < n:
        return model
    reached = lambda f, place: F.col(names[f]) >= place
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("f"), F.col(b).alias("b")) for i, b in enumerate(names)]))
    for _ in range(trees):
        splits: dict[int, tuple[int, int]] = {}
        leaves: dict[int, tuple[int, int]] = {}
        state = rows.select(*names, "n", "y", F.floor(ONE / (1 + F.exp(-model.margin(reached) / ONE)) + 0.5).alias("p"))
        state = state.select(*names, F.expr(f"n * p - y * {ONE}").alias("g"), F.expr(f"n * (p * ({ONE} - p) div {ONE})").alias("h"))
        for _ in range(depth):
            leaf = _value(splits, {k: k for k in [1, *(c for s in splits for c in (2 * s, 2 * s + 1))]}, reached)
            found = (state.select(leaf.alias("node"), "g", "h", cells).groupBy("node", "f", "b")
                     .agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
            nodes: dict[int, dict] = defaultdict(dict)
            for r in found:
                nodes[r["node"]][r["f"], r["b"]] = (r["g"], r["h"])
            for node, held in sorted(nodes.items()):
                best, leaves[node] = _best(held, ridge * ONE, child * ONE)
                if best:
                    del leaves[node]
                    splits[node] = best[1:3]
                    leaves[2 * node], leaves[2 * node + 1] = best[3:]
        if not splits:
            break
        value = lambda g, h: int((-rate * ONE * float(g) / (float(h) + ridge * ONE) + 0.5) // 1)
        model.trees.append((splits, {k: value(*v) for k, v in leaves.items()}))
    discard(rows)
    return model


def _bin(feature: str) -> Column:
    """How many thresholds the feature reaches."""
    return F.size(F.filter(F.array(*map(F.lit, GRID[feature])), lambda t: F.col(feature) >= t))


def _log_odds(y: Column, n: Column) -> Column:
    return F.floor(ONE * F.log((y + 1.0) / (n - y + 1.0)) + 0.5).cast("long")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` (url and other columns) with host, path, rule, verdict and margin (log-odds of
    block, in millionths).  ``labelled``: url, blocked; by default the URLs that a rule decides."""
    host, path, _ = parts(F.coalesce(F.col("url"), F.lit("")))
    statistics = written(suffix_statistics(pages.select(host.alias("host"))), "statistics")
    if labelled is None:
        verdict = rule_of(F.col("host"), F.col("path"), rules, 2)
        labelled = (pages.select("url", host.alias("host"), path.alias("path")).select("url", (verdict == "block").alias("blocked")))
    labelled = lexical(labelled.where("blocked IS NOT NULL").select("url", "blocked"))
    model = train(_with_statistics(labelled, statistics))
    kept = [c for c in pages.columns if c == "url" or c not in ("host", "path", "rule", "verdict", "margin")]
    wrapped = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_page"), "url")
    scored = _with_statistics(lexical(wrapped), statistics)
    grids = list(GRID.items())
    margin = model.margin(lambda f, place: F.col(grids[f][0]) >= grids[f][1][place - 1])
    rule, verdict = (rule_of(F.col("host"), F.col("path"), rules, v) for v in (None, 2))
    return scored.withColumn("margin", margin).select(
        "_page.*", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("margin") > 0, "block").otherwise("allow")).alias("verdict"), "margin")


def _with_statistics(df: DataFrame, statistics: DataFrame) -> DataFrame:
    names = ("suffix_pages", "domain_pages", "domain_hosts")
    side = statistics.withColumnRenamed("domain", "_domain")
    out = df.join(side, F.col("domain") == F.col("_domain"), "left").drop("_domain")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in names})


def op11_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for the URL of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "margin")


# ------------------------------------------------------------------ the same in SQL


def oracle(rules: Sequence[tuple[str, str, str]] = RULES, trees: int = TREES, depth: int = DEPTH) -> str:
    """Trees over ungrouped rows: every page goes through all of them, labelled ones with weight 1."""
    low = f"translate({{}}, '{_UPPER}', '{_CHARS[:26]}')"
    case = lambda v: "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v(h, p, x)}'" for h, p, x in longest_first(rules)) + " END"
    bits = lambda n: f"floor(1000 * {n} * ln(greatest({n}, 1)) / ln(2.0::DOUBLE) + 0.5)::BIGINT"
    chars = ", ".join(f"'{c}'" for c in _CHARS)
    bins = ", ".join(f"len(list_filter([{', '.join(map(str, grid))}], lambda t: {f} >= t))" for f, grid in GRID.items())
    last = lambda n: f"array_to_string(string_split(host, '.')[-{n}:], '.')"
    sql = [rf"""
    WITH u AS (SELECT page_id, row_number() OVER () AS r, coalesce(url, '') AS url FROM pages),
    v AS (SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM u),
    w AS (SELECT page_id, r, {low.format('url')} AS low, length(url) AS length, {low.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM v),
    x AS (SELECT *, {last(1)} AS suffix, {last(2)} AS domain, list_transform([{chars}], lambda c: length(low) - length(replace(low, c, ''))) AS counts,
                 {case(lambda h, p, x: h + p)} AS rule, {case(lambda h, p, x: x)} AS verdict FROM w),
    s AS (SELECT suffix, count(*) AS n FROM x GROUP BY 1),
    d AS (SELECT domain, count(*) AS n, count(DISTINCT host) AS hosts FROM x GROUP BY 1),
    y AS (SELECT page_id, r, host, path, rule, verdict, length, len(regexp_extract_all(path, '[^/]+')) AS depth,
                 1000 * list_sum(counts[27:36])::BIGINT // greatest(length, 1) AS digits,
                 ({bits('greatest(length, 1)')} - list_sum(list_transform(list_append(counts, length - list_sum(counts)::BIGINT), lambda c: {bits('c')}))::BIGINT)
                     // (10 * greatest(length, 1)) AS entropy,
                 len(regexp_extract_all(query, '[^&]+')) AS params,
                 CASE WHEN host = '' THEN 0 ELSE len(string_split(host, '.')) END AS labels, length(host) AS host_length,
                 length(regexp_replace(host, '[^0-9-]', '', 'g')) AS host_marks,
                 1000 * s.n // (SELECT count(*) FROM u) AS suffix_pages, 1000 * d.n // (SELECT count(*) FROM u) AS domain_pages,
                 1000 * d.hosts // d.n AS domain_hosts
          FROM x JOIN s USING (suffix) JOIN d USING (domain)),
    m0 AS MATERIALIZED (SELECT r, verdict IS NOT NULL AS used, (verdict = 'block')::INT AS y, [{bins}] AS b,
                               floor({ONE} * ln((count(*) FILTER (verdict = 'block') OVER () + 1.0::DOUBLE) / (count(*) FILTER (verdict = 'allow') OVER () + 1.0::DOUBLE))
                                     + 0.5)::BIGINT AS margin FROM y)"""]
    part = lambda g, h: f"({g})::DOUBLE * ({g})::DOUBLE / (({h})::DOUBLE + {RIDGE * ONE}::DOUBLE)"
    for t in range(trees):
        sql.append(f"""
    n{t}_0 AS MATERIALIZED (SELECT *, 1::BIGINT AS node, p - y * {ONE} AS g, p * ({ONE} - p) // {ONE} AS h
        FROM (SELECT r, used, y, b, margin, floor({ONE} / (1 + exp(-margin / {ONE}.0::DOUBLE)) + 0.5)::BIGINT AS p FROM m{t}))""")
        for k in range(depth):
            sql.append(f"""
    c{t}_{k} AS (SELECT node, f, v, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h
        FROM (SELECT node, g, h, unnest(b) AS v, generate_subscripts(b, 1) AS f FROM n{t}_{k} WHERE used) GROUP BY ALL),
    a{t}_{k} AS (SELECT node, f, lead(v) OVER o AS v, sum(g) OVER o AS gl, sum(h) OVER o AS hl,
                        sum(g) OVER (PARTITION BY node, f) AS ga, sum(h) OVER (PARTITION BY node, f) AS ha
        FROM c{t}_{k} WINDOW o AS (PARTITION BY node, f ORDER BY v)),
    s{t}_{k} AS MATERIALIZED (SELECT node, f, v
        FROM (SELECT *, {part('gl', 'hl')} + {part('ga - gl', 'ha - hl')} - {part('ga', 'ha')} AS gain FROM a{t}_{k} WHERE v IS NOT NULL)
        WHERE gain > 1.0 AND least(hl, ha - hl) >= {CHILD * ONE}
        QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1),
    n{t}_{k + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN s.f IS NULL THEN n.node ELSE 2 * n.node + (n.b[s.f] >= s.v)::INT END AS node)
        FROM n{t}_{k} n LEFT JOIN s{t}_{k} s ON s.node = n.node)""")
        sql.append(f"""
    l{t} AS (SELECT node, floor(-{RATE} * {ONE} * sum(g)::DOUBLE / (sum(h)::DOUBLE + {RIDGE * ONE}::DOUBLE) + 0.5)::BIGINT AS value
        FROM n{t}_{depth} WHERE used GROUP BY 1),
    m{t + 1} AS MATERIALIZED (SELECT r, used, y, b, margin + CASE WHEN (SELECT count(DISTINCT y) FROM n{t}_0 WHERE used) = 2
                                     AND (SELECT count(*) FROM s{t}_0) > 0 THEN l.value ELSE 0 END AS margin
        FROM n{t}_{depth} n LEFT JOIN l{t} l ON l.node = n.node)""")
    return ",".join(sql) + f"""
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN margin > 0 THEN 'block' ELSE 'allow' END) AS verdict, margin
    FROM y JOIN m{trees} USING (r)"""
