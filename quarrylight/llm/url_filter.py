"""URL filters: fixed host and path rules, and a path-template tree for what no rule decides.

Native DataFrame expressions only. Every url becomes a template: its host and the segments of its path,
in which numbers, dates, hex ids and uuids are wildcards from the start. Templates are counted with the
labels that their urls have; levels of the tree are the host and the first, second, ... segment. A segment
under a parent with many different children is generalised into a wildcard too. Whole templates that have the
same parent and whose share of bad labels does not differ significantly from their siblings' are merged with
them; the others keep their own counts. Inner levels are not merged, and templates without labels are allowed.
A template is rejected if its purity, the share of bad labels smoothed
toward the share over all labelled urls, reaches a threshold.

Labels come from the rules (block: bad, allow: good) and from a list of host and path words that mark
gambling, adult and link-farm sites (bad).

Everything after the first count works on distinct templates; the verdicts come back by an equi-join on the
template, which is broadcast only if it has been counted to be small.

Defined cases: null urls and urls without :// have an empty host and path, no rule, and are allowed; an
empty table gives an empty result; rows that repeat are judged each; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, require, settle

#: Words, between separators of a url, that mark a site as junk. Fixed values.
BAD_WORDS = ("casino", "poker", "bets", "betting", "adult", "porn", "xxx", "sex", "escort", "viagra", "cialis", "spam", "warez", "payday", "loans", "lottery", "slots")
JUNK = rf"(?i)(?:^|[^a-z])(?:{'|'.join(BAD_WORDS)})(?:[^a-z]|$)"
DEPTH = 4  # levels between two stored tables; the SQL for comparison stops here
MANY_CHILDREN = 64
SMOOTHING = 4.0
REJECT = 0.6
Z = 1.96
BROADCAST_TEMPLATES = 200_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a url; both empty without ://."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.when(has, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


#: A segment that is an id once its digits are wildcards.
ID_SEGMENT = r"(?i)^[0-9a-f{}n-]{8,}(?:\.[^.]*)?$"


def segments(path: Column) -> Column:
    """The segments with obvious variables as wildcards."""
    parts = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/"), lambda x: x != "")
    return F.transform(parts, lambda x: F.when(F.contains(x, F.lit("{n}")) & x.rlike(ID_SEGMENT), F.concat(F.lit("{id}"), F.regexp_extract(x, r"\.[^.]*$", 0))).otherwise(x))


def _level(nodes: DataFrame, k: int) -> DataFrame:
    """Generalise segment k: under a parent with many children it becomes a wildcard."""
    parent = [F.col("host"), F.slice("segments", 1, k).alias("parent")]
    own = F.get(F.col("segments"), F.lit(k))
    wide = nodes.filter(F.size("segments") > k).select(*parent, own.alias("s")).distinct().groupBy("host", "parent").agg(F.count(F.lit(1)).alias("children")).filter(F.col("children") >= MANY_CHILDREN)
    nodes = nodes.withColumn("parent", F.slice("segments", 1, k)).join(wide, ["host", "parent"], "left")
    general = F.transform("segments", lambda x, i: F.when(i == k, F.lit("*")).otherwise(x))
    return nodes.withColumn("segments", F.when(F.col("children").isNotNull(), general).otherwise(F.col("segments"))).drop("parent", "children")


def template_purity(counted: DataFrame) -> DataFrame:
    """host, shape, purity for counted templates (host, shape: segments as found, n, good, bad)."""
    nodes = counted.withColumn("segments", F.col("shape"))
    deepest = counted.agg(F.max(F.size("shape"))).first()[0] or 0
    for k in range(deepest):
        nodes = _level(nodes, k)
        if k % DEPTH == DEPTH - 1:
            nodes = settle(nodes)  # plans stay short, however deep a path is
    tree = nodes.groupBy("host", "segments").agg(*[F.sum(c).alias(c) for c in ("good", "bad")])
    whole = counted.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    labels = (whole["bad"] or 0) + (whole["good"] or 0)
    prior = whole["bad"] / labels if labels else 0.0
    # One level: a template that does not differ from its siblings takes their counts.
    joined = tree.withColumn("parent", F.slice("segments", 1, F.greatest(F.size("segments") - 1, F.lit(0))))
    siblings = joined.groupBy("host", "parent").agg(F.sum("good").alias("s_good"), F.sum("bad").alias("s_bad"))
    joined = joined.join(siblings, ["host", "parent"])
    n, s_n = F.col("good") + F.col("bad"), F.col("s_good") + F.col("s_bad")
    share, others = F.try_divide("bad", n), F.try_divide(F.col("s_bad") - F.col("bad"), s_n - n)
    pooled = F.try_divide("s_bad", s_n)
    spread = F.sqrt(pooled * (1 - pooled) * F.try_divide(s_n, n * (s_n - n)))
    take = F.coalesce(F.abs(share - others) <= Z * spread, F.lit(False))  # null: it or its siblings have no labels
    bad, labelled = F.when(take, F.col("s_bad")).otherwise(F.col("bad")), F.when(take, s_n).otherwise(n)
    purity = (bad + SMOOTHING * prior) / (labelled + SMOOTHING)
    scored = joined.select("host", "segments", F.when(labelled > 0, purity).otherwise(F.lit(0.0)).alias("purity"))
    return nodes.select("host", "shape", "segments").join(scored, ["host", "segments"]).select("host", "shape", "segments", "purity")


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id, host, path, rule and verdict of every row; template and purity where no rule fits."""
    require(df, id_col, url_col)
    host, path = host_and_path(F.col(url_col))
    urls = df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    words = F.concat_ws("/", "host", "path")
    marked = words.rlike(JUNK)
    urls = urls.withColumns({"rule": name, "ruled": verdict, "shape": segments(F.col("path"))})
    urls = urls.withColumn("label", F.when(F.col("ruled") == "block", F.lit(1)).when(F.col("ruled") == "allow", F.lit(0)).when(marked, F.lit(1)))
    counted = settle(urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label") == 0, 1)).alias("good"), F.count(F.when(F.col("label") == 1, 1)).alias("bad")))
    purity = template_purity(counted)
    if counted.count() <= BROADCAST_TEMPLATES:
        purity = F.broadcast(purity)
    out = urls.join(purity, ["host", "shape"], "left")
    method = F.when(F.coalesce("purity", F.lit(0.0)) >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), F.array_join("segments", "/").alias("template"), "purity")
