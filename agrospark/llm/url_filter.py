"""URL filters (13): fixed rules first, empirical-Bayes host reputation for the rest.

Every host gets a posterior of its rate of bad pages.  Labelled pages are counted
by host, registered domain and suffix, and each level is a beta-binomial prior of
the next: a suffix is shrunk to the overall rate, a domain to its suffix' mean, a
host to its domain's mean.  A prior's strength is a moment estimate, w / v: of groups
with n labelled and k bad pages within a parent with N and K, w sums
k (n - k) (N - n), and v sums k (k - 1) (N - n) - k (K - k) (n - 1), that is, how much
more alike two pages of one group are than two of neighbouring groups.  These are
whole numbers, so the result depends on no order of addition.
A host is blocked if the lower posterior bound of its rate (mean less ``z`` standard
deviations) exceeds ``limit``: few or no labelled pages block a host only with its
domain or suffix.

DataFrame operations only.  Counting is partial before the shuffle, so a host with
a third of all pages is one row a task; pages then meet the blocked hosts alone.
A few rows of counts go to the driver, whatever the input.

Defined results: a null url, or one without ``://``, has an empty host and path and
is judged by the reputation of the empty host; a page without a document or whose
document has no label counts for no rate; a label without a value is not bad;
labels that repeat a document count once, bad if one of them is; repeated pages
each count and each return; equally long rules: the one with the longer host, then
block; no labels at all: no host is blocked; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept_in_table

# Second-level labels that belong to the suffix below a country's label.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRENGTHS = (0.01, 1e6)          # least and largest strength of a prior


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1))
    rest = F.substring_index(rest, "?", 1)
    host = F.substring_index(rest, "/", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")),
            F.coalesce(F.substring(rest, F.length(host) + 1, F.length(rest)), F.lit("")))


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address or a single label is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    deep = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(SECOND_LEVEL)
    last = lambda k: F.array_join(F.slice(labels, -k, k), ".")
    alone = bare.rlike(r"^[0-9.]*$|^\[") | (n < 2)
    return (F.when(alone, bare).when(deep, last(3)).otherwise(last(2)),
            F.when(alone, F.lit("")).when(deep, last(2)).otherwise(last(1)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest of ``rules`` (verdict, host, path) that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    rule = verdict = F.lit(None).cast("string")
    for said, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def strength(child: DataFrame) -> float:
    """Strength of the prior of groups (n, k) within parents (N, K); counts below 10^12."""
    d = {c: f"CAST({c} AS DECIMAL(12,0))" for c in ("n", "k", "pn", "pk")}
    minus = lambda x, y: f"CAST({x} - {y} AS DECIMAL(12,0))"
    w = f"sum({d['k']} * {minus('n', 'k')} * {minus('pn', 'n')})"
    v = f"sum({d['k']} * {minus('k', 1)} * {minus('pn', 'n')}) - sum({d['k']} * {minus('pk', 'k')} * {minus('n', 1)})"
    row = child.agg(F.expr(f"CAST({w} AS DOUBLE)").alias("w"), F.expr(f"CAST({v} AS DOUBLE)").alias("v")).first()
    if not row["v"] or row["v"] <= 0:
        return STRENGTHS[1]
    return min(max(row["w"] / row["v"], STRENGTHS[0]), STRENGTHS[1])


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, ..., bad: 0, 1 or null) -> (host, n, k, mean, bound) of every host."""
    domain, suffix = domain_and_suffix(F.col("host"))
    seen, bad = F.count("bad"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))
    hosts = outcomes.groupBy("host").agg(seen.alias("n"), bad.alias("k")).withColumns({"domain": domain, "suffix": suffix})
    hosts = kept_in_table(hosts, "hosts")
    total = lambda *by: hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains, suffixes, whole = total("domain", "suffix"), total("suffix"), total().first()
    rate = whole["k"] / whole["n"] if whole["n"] else 0.0
    parent = lambda frame: frame.withColumnsRenamed({"n": "pn", "k": "pk"})
    s_host = strength(hosts.join(parent(domains), ["domain", "suffix"]))
    s_domain = strength(domains.join(parent(suffixes), "suffix"))
    s_suffix = strength(suffixes.withColumns({"pn": F.lit(whole["n"]), "pk": F.lit(whole["k"])}))
    mean = lambda s, above: (F.lit(s) * above + F.col("k")) / (F.lit(s) + F.col("n"))
    by_suffix = suffixes.select("suffix", mean(s_suffix, F.lit(rate)).alias("above"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", "suffix", mean(s_domain, F.col("above")).alias("above"))
    found = hosts.join(by_domain, ["domain", "suffix"]).withColumn("mean", mean(s_host, F.col("above")))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.lit(s_host) + F.col("n") + 1))
    return found.select("host", "n", "k", "mean", (F.col("mean") - F.lit(z) * spread).alias("bound"))


def outcomes_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) a page: the label of the document that the path's last number names."""
    host, path = host_and_path(F.col("url"))
    made = pages.select(host.alias("host"), F.regexp_extract(path, r"([0-9]{1,18})[^0-9]*$", 1).alias("_doc"))
    made = made.select("host", F.when(F.col("_doc") != "", F.col("_doc").cast("long")).alias("doc_id"))
    is_bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(is_bad.cast("int")).alias("bad"))
    return made.join(known, "doc_id", "left").select("host", "bad")


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], z: float = 1.645, limit: float = 0.5) -> DataFrame:
    """pages(page_id, url), labels(doc_id, quality, toxic) -> (page_id, host, path, rule, verdict)."""
    blocked = reputation(outcomes_of(pages, labels), z).where(F.col("bound") > limit).select("host", F.lit("block").alias("_bad"))
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    return seen.join(blocked, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "_bad", F.lit("allow")).alias("verdict"))


# The rules of the registered query (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

_ORDERED = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
_FITS = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'" for _, h, p in _ORDERED]
_SAYS = [f"WHEN rule = '{h + p}' THEN '{said}'" for said, h, p in _ORDERED]
_SECOND = ", ".join(f"'{x}'" for x in SECOND_LEVEL)


def _strength(level: str, child: str, parent: str) -> str:
    w = "sum(c.k::HUGEINT * (c.n - c.k) * (p.n - c.n))::DOUBLE"
    v = "(sum(c.k::HUGEINT * (c.k - 1) * (p.n - c.n)) - sum(c.k::HUGEINT * (p.k - c.k) * (c.n - 1)))::DOUBLE"
    return (f"{level} AS (SELECT CASE WHEN {v} > 0 THEN least(greatest({w} / {v}, {STRENGTHS[0]}), {STRENGTHS[1]}) "
            f"ELSE {STRENGTHS[1]} END AS {level} FROM {child} c JOIN {parent})")


SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
known AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
          FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
o AS (SELECT p.host, k.bad FROM p LEFT JOIN known k
      ON k.doc_id = try_cast(regexp_extract(p.path, '([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT)),
bare AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k,
                regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS b FROM o GROUP BY host),
cut AS (SELECT *, string_split(b, '.') AS l, len(string_split(b, '.')) AS c FROM bare),
flag AS (SELECT *, regexp_matches(b, '^[0-9.]*$|^\\[') OR c < 2 AS alone,
                c >= 3 AND length(l[c]) = 2 AND l[c - 1] IN ({_SECOND}) AS deep FROM cut),
hosts AS (SELECT host, n, k, CASE WHEN alone THEN b ELSE array_to_string(l[c - CASE WHEN deep THEN 2 ELSE 1 END : c], '.') END AS domain,
                 CASE WHEN alone THEN '' ELSE array_to_string(l[c - CASE WHEN deep THEN 1 ELSE 0 END : c], '.') END AS suffix FROM flag),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1),
whole AS (SELECT sum(n) AS n, sum(k) AS k FROM hosts),
r AS (SELECT coalesce(k::DOUBLE / nullif(n, 0)::DOUBLE, 0) AS rate FROM whole),
{_strength('s_suffix', 'suffixes', 'whole p ON true')},
{_strength('s_domain', 'domains', 'suffixes p ON c.suffix = p.suffix')},
{_strength('s_host', 'hosts', 'domains p ON c.domain = p.domain AND c.suffix = p.suffix')},
s AS (SELECT * FROM r, s_suffix, s_domain, s_host),
ms AS (SELECT suffix, (s_suffix * rate + k) / (s_suffix + n) AS above FROM suffixes, s),
md AS (SELECT d.domain, d.suffix, (s_domain * above + k) / (s_domain + n) AS above FROM domains d JOIN ms USING (suffix), s),
mh AS (SELECT host, n, s_host, (s_host * above + k) / (s_host + n) AS mean FROM hosts JOIN md USING (domain, suffix), s),
blocked AS (SELECT host FROM mh WHERE mean - 1.645 * sqrt(mean * (1 - mean) / (s_host + n + 1)) > 0.5),
ruled AS (SELECT page_id, host, path, CASE {' '.join(_FITS)} END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE {' '.join(_SAYS)} WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
