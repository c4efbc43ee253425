"""URL filter by association rules: explicit (host, path) rules first, mined rules for the rest.

Spark's FP-growth mines token combinations of labelled URLs together with the label; rules pruned by confidence
and support are matched through an inverted index from token to rule. DataFrame functions only.

The tokens of one URL hang together, so item sets would grow as powers of two. What is redundant is settled before mining:

* Rules of a single token are counted, not mined, and all of them are.
* A token whose labelled URLs all have one verdict is such a rule; no longer rule that holds it can be more confident or
  better supported, so it is not mined further.
* Tokens that stand in exactly the same labelled URLs are one item: the longest of them (then the first by text).
* Of a labelled URL with up to ``ITEMS`` = 12 items still left FP-growth lists all combinations. In a longer one they would grow as powers of two, most of them for nothing:
  a combination from which a token can go while all its URLs stay the same is no better than without it. So combinations that some longer URL holds are counted level by level over all
  labelled URLs, and only those are taken further of which each token tells (``generators``). Both ways together give every rule that is left after pruning, whatever ``ITEMS`` is.

Defined cases: a null url, or one without ``://``, has an empty host and path, no tokens, no explicit rule and the default
verdict; an empty path fits no rule path, since every rule path starts with ``/``; a host of over 127 labels, which no
name has, gives tokens of its last 127; repeated rows and repeated ids are judged each on its own; an empty table gives no rows; further
columns of the input are left alone and none is returned; without a single labelled URL no rule is mined and the
default verdict holds.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few, staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The explicit rules as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
MIN_SUPPORT, MIN_CONFIDENCE, MIN_ROWS, ITEMS = 0.005, 0.8, 8, 12
LABELS = 127  # a name has no more labels; a longer host gives its last ones


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a URL; both empty without ``://``."""
    pos = F.coalesce(F.locate("://", url), F.lit(0))
    tail = F.when(pos > 0, F.substring(url, pos + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(tail, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(tail, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def explicit_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest ends outermost
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        best = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def tokens(host: Column, path: Column) -> Column:
    """The distinct tokens of a URL: host suffixes by labels, path segments, and what the last segment starts with."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    labels = F.slice(labels, F.greatest(F.size(labels) - LABELS, F.lit(0)) + 1, LABELS)
    # Inside the outer function the labels are a value; written in place they would be found again for each suffix.
    ends = lambda ls: F.transform(F.sequence(F.lit(1), F.greatest(F.size(ls), F.lit(1))), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(ls, -F.least(i, F.greatest(F.size(ls), F.lit(1))), i), ".")))
    suffixes = F.flatten(F.transform(F.array(labels), ends))
    first = F.transform(F.slice(labels, 1, 1), lambda x: F.concat(F.lit("s:"), x))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    segments = F.transform(parts, lambda x: F.concat(F.lit("p:"), x))
    heads = F.transform(parts, lambda x: F.concat(F.lit("d:"), F.substring(x, 1, 1)))
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.when(F.size(labels) > 0, suffixes).otherwise(empty), first, segments, heads))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, most: int = ITEMS) -> DataFrame:
    """Rules (rule_id, antecedent: sorted tokens, verdict, confidence, support, size) from rows (items, verdict).

    The support is also at least MIN_ROWS rows. A rule is pruned if leaving out one of its tokens gives a rule of the same
    verdict that is as confident. most: how many items of a row FP-growth takes; those with more go by ``generators``."""
    rows = staged(labelled.select("items", "verdict", F.monotonically_increasing_id().alias("row")), "labelled")
    total = {r.verdict: r.n for r in rows.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    n = sum(total.values())
    shape = "rule_id long, antecedent array<string>, verdict string, confidence double, support double, size int"
    if not n:
        return rows.sparkSession.createDataFrame([], shape)
    least = max(min_support * n, min(n, MIN_ROWS))
    # Of each token: how often it stands with each verdict, and a hash of the set of its rows.
    single = rows.select("verdict", "row", F.explode("items").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("m1"), F.bit_xor(F.xxhash64(F.lit("again"), "row")).alias("m2"),
        *(F.count_if(F.col("verdict") == v).alias(f"n{i}") for i, v in enumerate(sorted(total))),
    ).where(F.col("n") >= least)
    single = staged(single, "tokens")
    by = F.array(*(F.struct(F.lit(v).alias("verdict"), F.col(f"n{i}").alias("k")) for i, v in enumerate(sorted(total))))
    ones = single.select(F.array("token").alias("antecedent"), F.col("n"), F.inline(by)).where(F.col("k") >= min_confidence * F.col("n"))
    ones = ones.select("antecedent", "verdict", (F.col("k") / F.col("n")).alias("confidence"), (F.col("k") / n).alias("support"))
    pure = F.greatest(F.lit(0), *(F.col(f"n{i}") for i in range(len(total)))) == F.col("n")
    marks = [f"n{i}" for i in range(len(total))]
    items = staged(single.where(~pure).groupBy("m1", "m2", "n", *marks).agg(F.min(F.struct((-F.length("token")).alias("long"), "token")).alias("x")).select(F.col("x.token").alias("token"), "n", *marks), "items")
    kept = rows.select("row", "verdict", F.explode("items").alias("token")).join(items, "token")
    # The rarest first: what follows a token is short then.
    kept = kept.groupBy("row", "verdict").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("items"))
    kept = staged(kept.select(F.transform("items", lambda x: x["token"]).alias("items"), "verdict").where(F.size("items") > 1), "kept")
    longer, narrow = [], kept.where(F.size("items") <= most)
    wide = staged(kept.where(F.size("items") > most).select("items").distinct(), "wide")
    # The support is of all labelled rows; FP-growth sees those with two items or more.
    if (left := narrow.count()) >= least:
        seen = narrow.select(F.concat("items", F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=(math.ceil(least) - 0.5) / left, minConfidence=min_confidence).fit(seen)
        grown = model.associationRules.where(
            F.element_at("consequent", 1).startswith("=") & (F.size("antecedent") > 1) & ~F.exists("antecedent", lambda x: x.startswith("="))
        ).select(
            F.array_sort("antecedent").alias("antecedent"), F.substring(F.element_at("consequent", 1), 2, 99).alias("verdict"), "confidence", (F.round(F.col("support") * left) / n).alias("support"),
        )
        longer.append(grown if wide.isEmpty() else _outside(staged(grown, "grown"), wide, items))
    if not wide.isEmpty():
        sets = kept.groupBy("items").agg(*(F.count_if(F.col("verdict") == v).alias(m) for v, m in zip(sorted(total), marks)), F.max(F.size("items") > most).cast("long").alias("wide"))
        told = generators(sets, items, marks, least).select(F.array_sort("x").alias("antecedent"), "n", F.inline(by))
        longer.append(told.where((F.col("k") >= least) & (F.col("k") / F.col("n") >= min_confidence)).select("antecedent", "verdict", (F.col("k") / F.col("n")).alias("confidence"), (F.col("k") / n).alias("support")))
    rules = staged(functools.reduce(DataFrame.unionByName, longer, ones), "found")
    shorter = rules.select(F.col("antecedent").alias("less"), "verdict", F.col("confidence").alias("c"))
    beaten = (
        rules.where(F.size("antecedent") > 1).select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("out"))
        .withColumn("less", F.array_remove("antecedent", F.col("out"))).join(shorter, ["less", "verdict"]).where("c >= confidence").select("antecedent", "verdict").distinct()
    )
    rules = rules.join(beaten, ["antecedent", "verdict"], "left_anti")
    return rules.select(F.xxhash64("antecedent", "verdict").alias("rule_id"), "antecedent", "verdict", "confidence", "support", F.size("antecedent").alias("size"))


def _outside(rules: DataFrame, wide: DataFrame, items: DataFrame) -> DataFrame:
    """The rules whose antecedent no set of ``wide`` (items) holds; they meet by the antecedent's rarest token."""
    rarest = rules.select("*", F.explode("antecedent").alias("token")).join(items.select("token", "n"), "token").groupBy(*rules.columns).agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    held = wide.select("items", F.explode("items").alias("of"))
    return rarest.join(held, (F.col("token") == F.col("of")) & (F.size(F.array_except("antecedent", "items")) == 0), "left_anti").select(*rules.columns)


def generators(sets: DataFrame, items: DataFrame, marks: Sequence[str], least: float) -> DataFrame:
    """(x, n, marks) of the sets x of two tokens or more that stand in a wide row, in fewer rows than x without any one of its tokens, in at
    least ``least`` rows of one verdict, and of which no smaller part has one verdict alone.

    sets: distinct rows (items in one order, marks: how often with each verdict, wide: 1 or 0); items: each token's (token, n, marks). A part of such a set is such a set,
    so sets grow by one token a level: a row is kept as a part (prefix) and the tokens that may follow it, equal rests are one, and only these are shuffled."""
    sums, n, most = [F.sum(m).alias(m) for m in marks], sum(F.col(m) for m in marks), F.greatest(F.lit(0), *marks)
    known = items.select(F.array("token").alias("x"), "n")
    rows, found = sets.select(F.array().cast("array<string>").alias("prefix"), F.col("items").alias("rest"), *marks, "wide"), []
    while True:
        grown = rows.select("prefix", "rest", F.posexplode("rest").alias("i", "token"), *marks, "wide")
        grown = grown.select(F.array_append("prefix", F.col("token")).alias("prefix"), F.slice("rest", F.col("i") + 2, F.size("rest")).alias("rest"), *marks, "wide").where(F.size("rest") > 0)
        grown = staged(grown.groupBy("prefix", "rest").agg(*sums, F.max("wide").alias("wide")), "rests")
        counted = grown.select("prefix", F.explode("rest").alias("token"), *marks, "wide").groupBy("prefix", "token").agg(*sums, F.max("wide").alias("wide")).where((F.col("wide") > 0) & (most >= least))
        counted = staged(counted.select(F.array_append("prefix", F.col("token")).alias("x"), n.alias("n"), *marks), "counted")
        less = counted.select("x", "n", F.explode(F.transform("x", lambda t: F.array_remove("x", t))).alias("y"))
        tells = less.join(known.select(F.col("x").alias("y"), F.col("n").alias("m")), "y").where("m > n").groupBy("x").agg(F.count("*").alias("parts")).where(F.col("parts") == F.size("x"))
        made = staged(counted.join(tells, "x", "left_semi"), "generators")
        found.append(made)
        known = made.where(most < F.col("n"))
        if known.isEmpty():
            return functools.reduce(DataFrame.unionByName, found)
        ends = known.groupBy(F.slice("x", F.lit(1), F.size("x") - 1).alias("prefix")).agg(F.collect_list(F.element_at("x", -1)).alias("ends"))
        rows = grown.join(F.broadcast(ends) if few(ends) else ends, "prefix").select("prefix", F.array_intersect("rest", "ends").alias("rest"), *marks, "wide").where(F.size("rest") > 1)


def match(urls: DataFrame, rules: DataFrame, row: str = "row", items: str = "items") -> DataFrame:
    """(row, mined, mined_verdict, mined_confidence) of the best rule whose tokens all occur in a URL: highest confidence, then
    support, then the larger antecedent, then text order. By an inverted index from token to rule."""
    index = rules.select("rule_id", "verdict", "confidence", "support", "size", F.array_join("antecedent", " ").alias("mined"), F.explode("antecedent").alias("token"))
    hit = (
        urls.select(row, F.explode(items).alias("token")).join(F.broadcast(index) if few(index) else index, "token")
        .groupBy(row, "rule_id", "verdict", "confidence", "support", "size", "mined").agg(F.count("*").alias("n")).where("n = size")
    )
    best = F.max(F.struct("confidence", "support", "size", "mined", "verdict")).alias("best")
    return hit.groupBy(row).agg(best).select(row, F.col("best.mined").alias("mined"), F.col("best.verdict").alias("mined_verdict"), F.col("best.confidence").alias("mined_confidence"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = DEFAULT, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, keep: Sequence[str] = ("page_id",), url: str = "url") -> DataFrame:
    """Judge each url. The explicit rules label the URLs they fit; from these FP-growth learns
    what judges the others. Returns ``keep`` and host, path, rule, verdict, mined (the mined
    rule's tokens where one decided). A column of ``keep`` named like one of these is an error."""
    host, path = host_and_path(F.col(url))
    seen = pages.select(*keep, host.alias("host"), path.alias("path"))
    seen = seen.withColumn("fit", explicit_rule(F.col("host"), F.col("path"), rules))
    labelled = seen.where("fit is not null").select(tokens(F.col("host"), F.col("path")).alias("items"), F.col("fit.verdict").alias("verdict"))
    mined = staged(mine(labelled, min_support, min_confidence), "rules")
    # One judgement for each distinct set of the rules' own tokens, not for each page. Each such
    # token has at least the support, so their number is bounded whatever the size of the table.
    known = sorted(r.token for r in mined.select(F.explode("antecedent").alias("token")).distinct().collect())
    own = F.array(*map(F.lit, known)) if known else F.array().cast("array<string>")
    shape = F.array_sort(F.array_intersect(tokens(F.col("host"), F.col("path")), own))
    marked = seen.select(*keep, "host", "path", "fit", F.when(F.col("fit").isNull(), shape).alias("shape"))
    shapes = marked.where(F.size("shape") > 0).select("shape").distinct().withColumn("items", F.col("shape"))
    judged = staged(match(shapes, mined, "shape"), "judged")
    return marked.join(F.broadcast(judged) if few(judged) else judged, "shape", "left").select(
        *keep, "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "mined_verdict", F.lit(default)).alias("verdict"), "mined",
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "mined")
