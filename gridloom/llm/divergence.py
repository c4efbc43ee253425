"""How far the word distributions of sources lie apart, by joint count histograms.

Each language keeps the terms of at least ``MIN_DOCS`` of its documents. A source's share of a term is smoothed and rounded down,
so it depends on the term's count alone; the distance of two sources is therefore a sum over the distinct (count, count)
combinations of their terms, each evaluated once and multiplied by the number of terms that have it. Only terms that both sources hold are
tallied: with h the tallies of single counts, V the kept terms and f(a, b) the distance of two shares,

    sum f = sum h_s(a) f(a, 0) + sum h_t(b) f(0, b) + (V - |s| - |t|) f(0, 0) + sum m(a, b) (f(a, b) - f(a, 0) - f(0, b) + f(0, 0)),

which gives the implied zero cells their multiplicity without a row for any of them.

Texts are counted inside the tasks, in tables of at most ``HELD`` entries, so that what is shuffled are sums. A pair's tallies are made in blocks:
terms are dealt out by hash, sources in blocks of ``SOURCES``; a task holds one block of terms of two blocks of sources
and emits combinations, never the pairs of a term. Shares are computed in Decimal, exact at any count.

Defined cases: null texts, languages and sources are empty strings, and are groups like any other; a group without terms has its rows in part
``pair`` (value 0 where its language keeps no term); repeated rows are documents of their own; ties go by the item's bytes;
a language with one source has no pairs; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

MIN_DOCS, TOP, SMOOTH, SCALE = 30, 50, 5, 1_000_000_000
#: Entries of a task's tables before they are emitted; bytes of a text taken apart at once; cells of a block of terms; sources of a block.
HELD, SLICE, CELLS, SOURCES = 300_000, 4 << 20, 100_000, 64
# Terms are runs of ASCII letters and of all bytes of other characters; A-Z are lower-cased.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes, at_once: int = SLICE) -> Counter:
    """How often each term stands in a text's UTF-8 bytes."""
    folded, found, start = text.translate(FOLD), Counter(), 0
    while start < len(folded):
        stop = folded.find(b" ", start + at_once)
        stop = len(folded) if stop < 0 else stop
        found.update(folded[start:stop].split())
        start = stop
    return found


def counted(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", held: int = HELD) -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents, several rows a term as tasks emit them; an empty term marks a group."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    shape = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def emptied() -> pa.RecordBatch:
            langs, sources, names, n, in_docs = [], [], [], [], []
            for (a, b), (total, found) in groups.items():
                total[b""] = found[b""] = 0
                langs += [a] * len(total)
                sources += [b] * len(total)
                names += total
                n += total.values()
                in_docs += map(found.__getitem__, total)
            groups.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((langs, sources, names, n, in_docs), shape, strict=True)], schema=shape)

        size = 0
        for batch in batches:
            of = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, value in zip(of, batch.column("text"), strict=True):
                if group not in groups:
                    groups[group] = Counter(), Counter()
                    size += 1
                total, found = groups[group]
                size -= len(total)
                own = terms(value.as_buffer().to_pybytes())
                total.update(own)
                found.update(own.keys())
                size += len(total)
                if size > held:
                    yield emptied()
                    size = 0
        yield emptied()

    return rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long").withColumn("term", F.col("term").cast("string"))


def cells(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, source, term, n, total, first): the counts of kept terms by group and in the language, one row of a term marked ``first``; the
    empty term marks each group that occurs. One shuffle: groups and languages are both whole where a term is."""
    dealt = counted(docs, lang, source, text).repartition("lang", "term")
    sums = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    kept = sums.withColumns({"in_docs": F.sum("docs").over(term), "total": F.sum("n").over(term), "at": F.row_number().over(term.orderBy("source"))})
    named = F.col("term") != ""
    return kept.where(~named | (F.col("in_docs") >= min_docs)).select("lang", "source", "term", "n", "total", (named & (F.col("at") == 1)).alias("first"))


def tallies(rows: DataFrame, blocks: int, each: int = SOURCES) -> DataFrame:
    """Rows (lang, s, t, a, b, m): m terms that source s < t holds a times and t b times, both at least once; parts of sums.
    rows: (lang, term, s int: the source's number in its language, n), one a term and source; ``sources`` is their number there."""
    block = (F.col("s") / each).cast("int")
    last = ((F.col("sources") - 1) / each).cast("int")
    filed = rows.withColumns({"part": F.pmod(F.xxhash64("term"), F.lit(blocks)), "other": F.explode(F.sequence(F.lit(0), last))})
    filed = filed.withColumns({"i": F.least(block, "other"), "j": F.greatest(block, "other")}).select("lang", "part", "i", "j", "term", "s", "n")

    def tally(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        term, names = pd.factorize(x["term"])
        who, s = np.unique(x["s"].to_numpy(), return_inverse=True)
        values, code = np.unique(x["n"].to_numpy(), return_inverse=True)
        held = np.full((len(who), len(names)), -1, np.int64)
        held[s, term] = code
        lang, _, i, j = key
        found = []
        for a in range(len(who)):
            for b in range(a + 1, len(who)):
                if i != j and who[a] // each == who[b] // each:
                    continue  # a pair inside a block belongs to that block alone
                both = (held[a] >= 0) & (held[b] >= 0)
                pair, m = np.unique(held[a][both] * len(values) + held[b][both], return_counts=True)
                found.append((np.full(len(m), who[a]), np.full(len(m), who[b]), values[pair // len(values)], values[pair % len(values)], m))
        s, t, a, b, m = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 5
        return pd.DataFrame({"lang": lang, "s": s.astype(np.int32), "t": t.astype(np.int32), "a": a, "b": b, "m": m})

    return filed.groupBy("lang", "part", "i", "j").applyInPandas(tally, "lang string, s int, t int, a long, b long, m long")


def share(count: str, size: str, kept: str) -> Column:
    """1 + floor(SCALE (count + 5) / (size + 5 kept)), exact."""
    whole = lambda x: f"CAST({x} AS DECIMAL(20,0))"
    return F.expr(f"1 + (({whole(count)} + {SMOOTH}) * CAST({SCALE} AS DECIMAL(10,0))) div ({whole(size)} + {SMOOTH} * {whole(kept)})")


def _distance(count: str, size: str, other: str, other_size: str) -> Column:
    return F.abs(share(count, size, "v") - share(other, other_size, "v"))


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value long, rank int)."""
    known = staged(cells(docs, lang, source, text, min_docs), "cells")
    named = known.where("term <> ''")
    every = known.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum((F.col("term") != "").cast("long")).alias("held"), F.sum(F.col("first").cast("long")).alias("v"))
    by_lang = Window.partitionBy("lang")
    groups = staged(every.select("lang", "source", "size", "held", F.sum("v").over(by_lang).alias("v"), F.sum("size").over(by_lang).alias("lang_size"),
                                 (F.row_number().over(by_lang.orderBy("source")) - 1).alias("s"), F.count("*").over(by_lang).cast("int").alias("sources")), "groups")

    a = groups.select("lang", F.col("source"), F.col("s"), F.col("size").alias("size_s"), F.col("held").alias("held_s"), "v")
    b = groups.select("lang", F.col("source").alias("item"), F.col("s").alias("t"), F.col("size").alias("size_t"), F.col("held").alias("held_t"))
    pairs = a.join(b, "lang").where("s < t")
    zeros = F.when(F.col("v") > 0, _distance("0", "size_s", "0", "size_t")).otherwise(0) * (F.col("v") - F.col("held_s") - F.col("held_t"))
    # Single counts against zero: once a distinct count and partner.
    single = named.join(groups.select("lang", "source", "s"), ["lang", "source"]).groupBy("lang", "s", "n").agg(F.count("*").alias("m"))
    own, partner = groups.select("lang", "s", "size", "v"), groups.select("lang", F.col("s").alias("t"), F.col("size").alias("size_t"))
    alone = single.join(own, ["lang", "s"]).join(partner, "lang").where("s <> t")
    alone = alone.select("lang", F.least("s", "t").alias("s"), F.greatest("s", "t").alias("t"), (F.col("m") * _distance("n", "size", "0", "size_t")).alias("value"))
    # Combinations of two counts: once each.
    numbered = named.join(groups.select("lang", "source", "s", "sources"), ["lang", "source"]).select("lang", "term", "s", "sources", "n")
    blocks = 1 + known.count() // CELLS
    joint = tallies(numbered, blocks).groupBy("lang", "s", "t", "a", "b").agg(F.sum("m").alias("m"))
    joint = joint.join(own.withColumnRenamed("size", "size_s"), ["lang", "s"]).join(partner, ["lang", "t"])
    excess = _distance("a", "size_s", "b", "size_t") - _distance("a", "size_s", "0", "size_t") - _distance("0", "size_s", "b", "size_t") + _distance("0", "size_s", "0", "size_t")
    sums = alone.unionByName(joint.select("lang", "s", "t", (F.col("m") * excess).alias("value"))).groupBy("lang", "s", "t").agg(F.sum("value").alias("more"))
    value = zeros + F.coalesce("more", F.lit(0))
    apart = staged(pairs.join(sums, ["lang", "s", "t"], "left").select("lang", "source", "item", value.alias("value")), "pairs")
    both = apart.unionByName(apart.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    # What a group says more often than its language: the first ``top`` of each task, then of all.
    sized = named.join(groups.select("lang", "source", "size", "v", "lang_size"), ["lang", "source"])
    more = sized.select("lang", "source", F.col("term").alias("item"), (share("n", "size", "v") - share("total", "lang_size", "v")).alias("value")).where("value > 0")
    salted = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(16))).orderBy(F.desc("value"), "item")
    first = more.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    term = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
counts AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sized AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS size, count(*) OVER (PARTITION BY lang, source) AS v, sum(n) OVER (PARTITION BY lang, term) AS total, sum(n) OVER (PARTITION BY lang) AS lang_size FROM counts),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (size + 5 * v) AS p, 1 + (1000000000 * (total + 5)) // (lang_size + 5 * v) AS q FROM sized),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50"""
