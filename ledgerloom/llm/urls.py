"""URL filter by a tree of path templates per host, all in DataFrame operations.

Rules on hosts and paths decide some urls; these are the labels. Paths become templates: segments
with digits, and whatever lies below ``DEPTH`` segments, are wildcards. Per host the templates form a
tree. From the deepest level up, a parent with many children, each of them rare, turns them all
into a wildcard, and a child is merged into the parent's wildcard if it and its siblings have labels
enough and a two-sample test finds no difference between their shares of blocked urls. A branch
with few labels keeps its own shape. What remains is judged by its smoothed purity: the share
of blocked urls, drawn towards that of the same path on all hosts, which is drawn towards that of
the path one segment shorter, and so on up to the share of all urls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import sized, stored

DEPTH = 4
MANY_CHILDREN, RARE = 50, 5  # more children than this, with fewer urls each on average, are a wildcard
SIMILAR_Z = 1.96
ENOUGH_LABELS = 5  # on both sides of a comparison
SMOOTHING = 4.0
BLOCK_FROM = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty without ``://``."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return F.translate(found, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def path_segments(path: Column, depth: int = DEPTH) -> Column:
    """Segments of a path with wildcards for those that hold a digit, and one for all below depth."""
    parts = F.array_remove(F.split(path, "/"), "")
    plain = F.transform(F.slice(parts, 1, depth), lambda s: F.when(s.rlike("[0-9]"), "*").otherwise(s))
    return F.concat(plain, F.when(F.size(parts) > depth, F.array(F.lit("**"))).otherwise(
        F.array().cast("array<string>")))


def template_verdicts(urls: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, segments, template, purity, blocked) for the templates of ``urls`` (host, segments,
    label: true blocked, false allowed, null neither)."""
    tree = urls.groupBy("host", "segments").agg(
        F.count("*").alias("urls"), F.count("label").alias("n"), F.count_if("label").alias("k"))
    tree = stored(tree.withColumn("now", F.col("segments")), "templates")
    for level in range(depth, 0, -1):
        parent, own = F.slice("now", 1, level - 1), F.get("now", F.lit(level - 1))
        rows = tree.withColumn("parent", parent).withColumn("own", own)
        children = rows.filter("own IS NOT NULL").groupBy("host", "parent", "own").agg(
            F.sum("urls").alias("urls"), F.sum("n").alias("n"), F.sum("k").alias("k"))
        parents = children.groupBy("host", "parent").agg(
            F.count("*").alias("children"), F.sum("urls").alias("all_urls"), F.sum("n").alias("all_n"),
            F.sum("k").alias("all_k"))
        share = (F.col("all_k") + 1) / (F.col("all_n") + 2)
        rest = F.col("all_n") - F.col("n")
        # |k / n - (all_k - k) / rest| against its spread, multiplied by n * rest
        apart = F.abs(F.col("k") * F.col("all_n") - F.col("all_k") * F.col("n")).cast("double")
        alike = ((F.col("n") >= ENOUGH_LABELS) & (rest >= ENOUGH_LABELS)
                 & (apart <= SIMILAR_Z * F.sqrt(share * (1 - share) * (F.col("all_n") * F.col("n") * rest).cast("double"))))
        crowded = (F.col("children") > MANY_CHILDREN) & (F.col("all_urls") < RARE * F.col("children"))
        merged = (children.join(parents, ["host", "parent"]).filter(alike | crowded)
                  .select("host", "parent", "own", F.lit(True).alias("merge")))
        head, tail = F.slice("now", 1, level - 1), F.slice("now", level + 1, depth + 1)
        tree = rows.join(merged, ["host", "parent", "own"], "left").select(
            "host", "segments", "urls", "n", "k",
            F.when(F.col("merge"), F.concat(head, F.array(F.lit("*")), tail)).otherwise(F.col("now")).alias("now"))
    tree = stored(tree, "tree")
    own = tree.groupBy("host", "now").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = tree.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0) + 1) / ((total["n"] or 0) + 2)
    steps = (tree.groupBy("segments").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
             .select("segments", "n", "k", F.explode(F.expr("sequence(0, size(segments))")).alias("level"))
             .withColumn("above", F.slice("segments", F.lit(1), F.col("level"))).filter("level > 0"))
    sums = stored(steps.groupBy("above").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "above")
    bytes_ = sums.agg(F.sum(F.length(F.array_join("above", "/")) * 4 + 64).alias("b")).first()["b"] or 0
    # At most depth + 1 steps for a path; from all urls down to the whole path.
    wide = F.aggregate(F.array_sort("steps"), F.lit(overall), lambda share, step:
                       (step["k"] + SMOOTHING * share) / (step["n"] + SMOOTHING))
    everywhere = (steps.select("segments", "level", "above").join(sized(sums, 1, bytes_), "above")
                  .groupBy("segments").agg(F.collect_list(F.struct("level", "n", "k")).alias("steps"))
                  .select("segments", wide.alias("wide")))
    prior = F.coalesce("wide", F.lit(overall))  # the root has no step above it
    purity = (F.col("k") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)
    return (tree.select("host", "segments", "now").join(own, ["host", "now"])
            .join(everywhere, "segments", "left")
            .select("host", "segments", F.concat(F.lit("/"), F.array_join("now", "/")).alias("template"),
                    purity.alias("purity"), (purity >= BLOCK_FROM).alias("blocked")))


def filtered(pages: DataFrame, rules: tuple[Rule, ...] = RULES, depth: int = DEPTH) -> DataFrame:
    """page_id, host, path, rule, verdict and template, one row per row of ``pages``.

    The verdict is that of the longest fitting rule, else the template's. Null urls and urls without
    ``://`` have empty host and path and the root template. Rows may repeat; an empty table gives no
    rows; columns other than page_id and url are not read.
    """
    host, path = host_and_path("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                         path_segments(F.col("path"), depth).alias("segments"))
    verdicts = stored(template_verdicts(ruled.withColumn("label", F.col("ruled") == "block"), depth), "verdicts")
    text = F.length("host") + F.length(F.array_join("segments", "/")) + F.length("template")
    width = verdicts.agg(F.sum(text * 4 + 64).alias("b")).first()["b"] or 0  # real sizes, 4 bytes a character
    return (ruled.join(sized(verdicts, 1, width), ["host", "segments"])
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
                    "template"))


def oracle(rules: tuple[Rule, ...] = RULES, depth: int = DEPTH) -> str:
    """The same rows in DuckDB SQL."""
    def chosen(what: str) -> str:
        cases = " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
            f"THEN '{getattr(r, what)}'" for r in sorted(rules, key=lambda r: (len(r.name), r.name), reverse=True))
        return f"CASE {cases} END"

    levels = []
    before = "t0"
    for level in range(depth, 0, -1):
        levels.append(f"""
r{level} AS (SELECT *, now[1:{level - 1}] AS parent, now[{level}] AS own FROM {before}),
c{level} AS (SELECT host, parent, own, sum(urls) AS urls, sum(n) AS n, sum(k) AS k FROM r{level}
       WHERE own IS NOT NULL GROUP BY ALL),
p{level} AS (SELECT host, parent, count(*) AS children, sum(urls) AS all_urls, sum(n) AS all_n, sum(k) AS all_k,
       (sum(k) + 1)::DOUBLE / (sum(n) + 2)::DOUBLE AS share FROM c{level} GROUP BY ALL),
m{level} AS (SELECT host, parent, own FROM c{level} JOIN p{level} USING (host, parent)
       WHERE (n >= {ENOUGH_LABELS} AND all_n - n >= {ENOUGH_LABELS} AND abs(k * all_n - all_k * n)::DOUBLE
              <= {SIMILAR_Z} * sqrt(share * (1 - share) * (all_n * n * (all_n - n))::DOUBLE))
          OR (children > {MANY_CHILDREN} AND all_urls < {RARE} * children)),
t{level} AS (SELECT r.host, r.segments, r.urls, r.n, r.k, CASE WHEN m.own IS NOT NULL
       THEN r.now[1:{level - 1}] || ['*'] || r.now[{level + 1}:] ELSE r.now END AS now
       FROM r{level} r LEFT JOIN m{level} m ON r.host = m.host AND r.parent = m.parent AND r.own = m.own)""")
        before = f"t{level}"
    wide = [f"""
a{level} AS (SELECT segments[1:{level}] AS above, sum(n) AS n, sum(k) AS k FROM {before}
       WHERE len(segments) >= {level} GROUP BY ALL),
w{level} AS (SELECT w.segments, CASE WHEN a.n IS NULL THEN wide
       ELSE (a.k::DOUBLE + {SMOOTHING} * wide) / (a.n::DOUBLE + {SMOOTHING}) END AS wide
       FROM w{level - 1} w LEFT JOIN a{level} a ON len(w.segments) >= {level} AND a.above = w.segments[1:{level}])"""
            for level in range(1, depth + 2)]
    return rf"""
WITH u AS (SELECT page_id,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
s AS (SELECT *, [x FOR x IN string_split(path, '/') IF x <> ''] AS parts FROM u),
d AS (SELECT page_id, host, path, {chosen('name')} AS rule, {chosen('verdict')} AS ruled,
  [CASE WHEN regexp_matches(x, '[0-9]') THEN '*' ELSE x END FOR x IN parts[1:{depth}]]
    || CASE WHEN len(parts) > {depth} THEN ['**'] ELSE []::VARCHAR[] END AS segments FROM s),
t0 AS (SELECT host, segments, count(*) AS urls, count(ruled) AS n, count(*) FILTER (ruled = 'block') AS k,
  segments AS now FROM d GROUP BY host, segments),{','.join(levels)},
o AS (SELECT host, now, sum(n) AS n, sum(k) AS k FROM {before} GROUP BY ALL),
g AS (SELECT (coalesce(sum(k), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2)::DOUBLE AS overall FROM {before}),
w0 AS (SELECT segments, overall AS wide FROM (SELECT DISTINCT segments FROM {before}), g),{','.join(wide)},
v AS (SELECT t.host, t.segments, '/' || array_to_string(t.now, '/') AS template,
        (o.k::DOUBLE + {SMOOTHING} * wide) / (o.n::DOUBLE + {SMOOTHING}) >= {BLOCK_FROM} AS blocked
      FROM {before} t JOIN o ON t.host = o.host AND t.now = o.now JOIN w{depth + 1} w ON t.segments = w.segments)
SELECT page_id, d.host, path, rule, coalesce(ruled, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict, template
FROM d JOIN v ON d.host = v.host AND d.segments = v.segments"""
