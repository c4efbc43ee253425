"""Collocations: phrases of two words and more that stand together far more often than their parts would by chance.

All phrases of 1 to ``MAX_WORDS`` words are exploded into rows of partial counts and hash-aggregated by language. A candidate's
counts are joined with those of the two parts of each cut, scored in Decimal, candidates that a one-word extension explains
go by an anti-join, and the rest are ranked by a window.

Phrases under ``MIN_COUNT`` occurrences are neither candidates nor parts of one, as each part stands wherever its phrase does.
So a phrase is exploded only if its words, pairs and triples of words may occur that often. Bitmaps of 2^``BITS`` bits, of the same size whatever the
input, tell for sure which do not: of words by their counts, of pairs and triples by the counts of ``HASH`` bits of their hashes. They let a
few others pass, more of them as the corpus grows; the exact counts of what passes settle it. Words are numbered inside the tasks,
slice by slice, phrases by pairs of such numbers.

Of longer phrases only one-word extensions need be asked: if a longer one holds ``share`` hundredths of a phrase's
occurrences, so does each phrase between the two.

Defined cases: a null text is empty, a null language is ``und``; pieces without a word give nothing; a language without candidates has no rows;
repeated rows count each on its own; ties go by score, count and the phrase's bytes; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import few, staged, table

MAX_WORDS, MIN_COUNT, SHARE, TOP, SEED = 5, 100, 100, 2000, 42
#: log2 of a bitmap's bits; bits of a hash that are counted; words of the phrases that are sifted so; bytes of text that are counted at once.
BITS, HASH, SIFTED, SLICE = 27, 40, 3, 4 << 20
# Punctuation and line ends part pieces; they become a byte that UTF-8 has not. Tabs are spaces.
BREAK = b"\xff"
FOLD = bytes(255 if chr(b) in ".,;:!?\n\v\f\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """Bit ``h`` mod 2^bits is set for each row's hash h; at most 2^bits / 64 longs reach the driver, at any size."""
    at = F.col("h").bitwiseAND((1 << bits) - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    found = hashes.select(F.shiftright(at, 6).alias("i"), one.alias("bit")).groupBy("i").agg(F.bit_or("bit").alias("bits")).toPandas()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["i"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return words.view(np.uint64)


def passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set."""
    return (words[(h & np.uint64(64 * len(words) - 1)) >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) > 0


def slices(text: bytes, overlap: int, at_once: int = SLICE) -> Iterator[tuple[pa.Array, np.ndarray, int]]:
    """A text's words and breaks in slices: the different ones; their numbers in order, with up to ``overlap`` that follow; how many are the slice's own."""
    folded, start = text.translate(FOLD).replace(BREAK, b" \xff "), 0
    while start < len(folded):
        stop = folded.find(b" ", start + at_once)
        stop = len(folded) if stop < 0 else stop
        tail = folded[stop:].split(None, overlap)[:overlap] if overlap else []
        found = pc.split_pattern(pa.array([b" ".join([folded[start:stop], *tail])], pa.binary()), b" ").flatten().dictionary_encode()
        ids, empty = found.indices.to_numpy().astype(np.int64), pc.index(found.dictionary, pa.scalar(b"", pa.binary())).as_py()
        ids = ids[ids != empty]
        yield found.dictionary, ids, len(ids) - len(tail)
        start = stop


def rolled(h: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of k words that start at ``at``, from their words' hashes h."""
    out = h[ids[at]].copy()
    for i in range(1, k):
        turn, x = np.uint64(21 * i % 64), h[ids[at + i]]
        out ^= x << turn | x >> (np.uint64(64) - turn)
    return out


def phrases(names: pa.Array, ids: np.ndarray, own: int, sizes: tuple[int, ...], maps: Mapping[int, np.ndarray], hashed: bool = False) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The phrases of ``sizes`` words that start at the first ``own`` of a slice's words (``hashed``: ``HASH`` bits of their hashes), and how often. maps: for
    phrases of 1, 2, ... words the bitmap of what may occur often enough."""
    word = pc.not_equal(names, pa.scalar(BREAK, pa.binary())).to_numpy(zero_copy_only=False)
    if 1 in sizes:
        n = np.bincount(ids[:own], minlength=len(names))
        n[~word] = 0
        at = np.flatnonzero(n)
        yield names.take(pa.array(at)), n[at]
        yield pa.array([b""], pa.binary()), np.array([n.sum()])
    if max(sizes) == 1:
        return
    h = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in names.to_pylist()), np.uint64, len(names)) if maps or hashed else None
    if 1 in maps:
        word &= passes(maps[1], h)
    now = np.where(word[ids], ids, -1)
    for k in range(2, max(sizes) + 1):
        # A phrase is two of one word less that overlap; for pairs these are the words.
        ok = np.flatnonzero((now[:-1] >= 0) & (now[1:] >= 0))
        if k in maps:
            ok = ok[passes(maps[k], rolled(h, ids, ok, k))]
        _, first, number = np.unique((now[ok] << 32) | now[ok + 1], return_index=True, return_inverse=True)
        now = np.full(max(0, len(now) - 1), -1, np.int64)
        now[ok] = number
        if k in sizes:
            n = np.bincount(number[: np.searchsorted(ok, own)], minlength=len(first))
            at, n = ok[first[n > 0]], n[n > 0]
            if hashed:
                yield pa.array((rolled(h, ids, at, k) & np.uint64((1 << HASH) - 1)).astype(np.int64)), n
            else:
                yield pc.binary_join_element_wise(*(names.take(pa.array(ids[at + i])) for i in range(k)), b" "), n


def exploded(docs: DataFrame, sizes: tuple[int, ...], maps: Mapping[int, np.ndarray], hashed: bool = False, at_once: int = SLICE) -> DataFrame:
    """Rows (lang, phrase, n), or (lang, h, n) if ``hashed``, several a phrase as slices give them. docs: (lang, text). The empty phrase counts all words."""
    bitmaps = docs.sparkSession.sparkContext.broadcast(dict(maps))  # of fixed size, whatever the input
    shape = pa.schema([("lang", pa.string()), ("h", pa.int64()) if hashed else ("phrase", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for names, ids, own in slices(BREAK.join(texts), max(sizes) - 1, at_once):
                    for found, n in phrases(names, ids, own, sizes, bitmaps.value, hashed):
                        for i in range(0, len(found), 100_000):
                            some = found.slice(i, 100_000)
                            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), some, pa.array(n[i : i + 100_000], pa.int64())], schema=shape)
            held.clear()

        for batch in batches:
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                text = value.as_buffer().to_pybytes()
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size > at_once:
                    yield from emptied()
                    size = 0
        yield from emptied()

    if hashed:
        return docs.mapInArrow(run, "lang string, h long, n long")
    return docs.mapInArrow(run, "lang string, phrase binary, n long").withColumn("phrase", F.col("phrase").cast("string"))


def frequent(docs: DataFrame, max_words: int = MAX_WORDS, least: int = MIN_COUNT, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Rows (lang, phrase, f) of the words with f >= least, and of the phrases of 2 to ``max_words`` words with it. The
    first also holds the empty phrase with the number of all words of the language."""
    counts = lambda rows: rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))
    one = staged(counts(exploded(docs, (1,), {})), "words")
    maps = {1: bitmap(one.where("phrase <> ''").select(F.xxhash64("phrase").alias("h")), bits)}
    for k in range(2, min(SIFTED, max_words) + 1):
        sums = exploded(docs, (k,), maps, hashed=True).groupBy("h").agg(F.sum("n").alias("n"))  # languages that share a hash only let more pass
        maps[k] = bitmap(sums.where(F.col("n") >= least), bits)
    return one, staged(counts(exploded(docs, tuple(range(2, max_words + 1)), maps)), "phrases")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = MAX_WORDS, least: int = MIN_COUNT, share: int = SHARE, top: int = TOP, bits: int = BITS) -> DataFrame:
    """Rows (lang, rank int, phrase, a, l, r, n, score long): of each language the first ``top`` collocations."""
    if not 2 <= max_words:
        raise ValueError("a collocation has two words at least")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    one, longer = frequent(rows, max_words, least, bits)
    counts = one.where("phrase <> ''").unionByName(longer)
    totals = one.where("phrase = ''").select("lang", F.col("f").alias("n"))
    totals = F.broadcast(totals) if few(totals) else totals
    found = longer.withColumnRenamed("f", "a")
    # Each cut's two parts, and their counts.
    apart = F.split("phrase", " ")
    size = F.size(apart)
    piece = lambda start, n: F.array_join(F.slice(apart, start, n), " ")
    cuts = found.select("lang", "phrase", "a", F.explode(F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("k"), piece(F.lit(1), k).alias("first"), piece(k + 1, size - k).alias("rest")))).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    whole = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    score = F.expr(f"(CAST(1000 AS DECIMAL(4,0)) * {whole('a')} * {whole('n')}) div ({whole('l')} * {whole('r')})")
    least_cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    judged = scored.groupBy("lang", "phrase", "a", "n").agg(least_cut).select("lang", "phrase", "a", "n", "cut.*")
    # One-word extensions: a phrase of three words or more explains what it leaves without its first or last word.
    parents = found.where(size > 2).select("lang", F.col("a").alias("more"), F.explode(F.array(piece(F.lit(1), size - 1), piece(F.lit(2), size - 1))).alias("inside"))
    parents = parents.groupBy("lang", "inside").agg(F.max("more").alias("more"))
    explained = (judged["lang"] == parents["lang"]) & (judged["phrase"] == parents["inside"]) & (F.lit(100).cast("decimal(3,0)") * parents["more"].cast("decimal(15,0)") >= F.lit(share).cast("decimal(3,0)") * judged["a"].cast("decimal(15,0)"))
    left = judged.join(parents, explained, "left_anti")
    # Only rows that may be among the first leave a task: by salt, then of all.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(16))).orderBy(*best)
    some = left.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""WITH pieces AS (SELECT lang, row_number() OVER () AS id, words FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)) WHERE len(words) > 0),
words AS (SELECT lang, id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM pieces),
next AS (SELECT lang, w, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3, lead(w, 3) OVER s AS w4, lead(w, 4) OVER s AS w5 FROM words WINDOW s AS (PARTITION BY id ORDER BY i)),
grams AS (SELECT lang, 1 AS k, w AS phrase FROM next UNION ALL SELECT lang, 2, w || ' ' || w2 FROM next WHERE w2 IS NOT NULL UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM next WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM next WHERE w4 IS NOT NULL UNION ALL SELECT lang, 5, w || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM next WHERE w5 IS NOT NULL),
f AS (SELECT *, string_split(phrase, ' ') AS ws FROM (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100)),
n AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
cuts AS (SELECT c.lang, c.phrase, c.k AS size, c.f AS a, cut, l.f AS l, r.f AS r, n.n, (1000 * CAST(c.f AS HUGEINT) * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM f c JOIN range(1, 5) AS s(cut) ON cut < c.k JOIN f l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(c.ws[1 : cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(c.ws[cut + 1 : ], ' ') JOIN n ON n.lang = c.lang),
judged AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM judged j WHERE NOT EXISTS (SELECT 1 FROM f x WHERE x.lang = j.lang AND x.k > j.size AND 100 * x.f >= 100 * j.a AND contains(' ' || x.phrase || ' ', ' ' || j.phrase || ' '))),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000"""
