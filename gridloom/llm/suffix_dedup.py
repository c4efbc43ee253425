"""Repeated passages by a run-length index: remove each byte that a repeated string of
``LENGTH`` = 400 bytes covers.

1. Every 400-byte window of every text picks its leftmost minimal 64-byte gram, its seed.
   Equal windows pick equal seeds at equal places, wherever they stand. Neighbouring windows with
   the same seed make a span: the bytes that these windows cover.
2. Spans equal as a whole collapse to one with a count (by 128-bit hashes); from two on all their windows repeat.
   Only different spans that share a seed remain open.
3. The open spans are dealt out by seed and indexed in blocks (``RunIndex``): a Burrows-Wheeler transform
   compressed to runs, with the text positions at both ends of each run as samples. Common
   prefixes are taken at the samples alone; the matching statistics of the block's strings are streamed from there along
   the text, since they fall by one with each step inside a run. Windows whose match reaches 400 bytes are marked.
4. A seed with more than ``HOT`` open spans is split by halving the range of its windows: a half
   shares a longer core, equal half spans collapse again, lone ones end, and what is left
   is small or is halved again, at most nine times. Nothing is capped and no group meets in one task.
5. Marks go back to the documents, where they are merged and cut.

Defined cases: a null text counts as empty; texts under 400 bytes lose nothing; rows repeated
with the same key and text are rows of their own (and so repeat each other); a null key is a key;
matches never cross documents; an empty table gives no rows; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, staged, table

LENGTH, GRAM, HOT = 400, 64, 2048
PIECE, BLOCK = 1 << 20, 1 << 19  # bytes hashed at once; bytes indexed at once
_TABLE = np.random.default_rng(0).integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = np.random.default_rng(1).integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _halves(data: bytes) -> tuple[int, int]:
    x = int.from_bytes(xxhash.xxh3_128_digest(data), "little")
    return (x & (1 << 64) - 1) - (1 << 63), (x >> 64) - (1 << 63)


def seeds(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """(first window, last window, place, hash) of each span of windows with the same seed. gram: a power of two."""
    for base in range(0, max(0, len(data) - length + 1), PIECE):
        raw = np.frombuffer(data, np.uint8, min(len(data) - base, PIECE + length - 1), base)
        h = _TABLE[raw]
        step = 1
        while step < gram:
            h = h[:-step] * _ODD[step.bit_length() - 1] + h[step:]
            step *= 2
        h ^= h >> np.uint64(29)
        h *= _ODD[7]
        h ^= h >> np.uint64(32)
        wide, low, at = length - gram + 1, h, np.arange(len(h), dtype=np.int32)
        step = 1
        while step <= wide:  # minima over 1, 2, 4 ... grams; ties to the left
            ahead = step if 2 * step <= wide else wide - step
            if ahead:
                less = low[ahead:] < low[:-ahead]
                at = np.where(less, at[ahead:], at[:-ahead])
                low = np.where(less, low[ahead:], low[:-ahead])
            step *= 2
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        place = at[first]
        yield from zip((first + base).tolist(), (last + base).tolist(), (place + base).tolist(), h[place].view(np.int64).tolist(), strict=True)


def suffix_order(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order; each ends with its string, ``left`` bytes on. By doubling."""
    n = len(data)
    key = np.zeros(n, np.uint64)
    wide = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
    for i in range(7):
        key = (key << np.uint64(8)) | np.where(left > i, wide[i : n + i], np.uint64(0))
    key = (key << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    done, most, known = 7, int(left.max(initial=0)), 0
    while True:
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order[1:]] != key[order[:-1]]]
        count = int(new.sum())
        if done >= most or count in (n, known):
            return order
        known = count
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        after = np.zeros(n, np.int64)
        far = np.flatnonzero(left > done)
        after[far] = rank[far + done]
        key = (rank * (n + 1) + after).astype(np.uint64)
        done *= 2


@dataclass
class RunIndex:
    """A Burrows-Wheeler transform of some strings, compressed to runs, with samples at the ends of the runs. The suffix order
    itself is not kept.

    Each string ends with a character of its own, less than all bytes; 256 + i stands for what comes before string i.
    heads and tails: text positions of the suffixes at each run's first and last row, in text order, and how long a prefix
    each has in common with the suffix one row further out, which is where the longest match elsewhere of a whole run begins."""

    chars: np.ndarray
    lengths: np.ndarray
    sizes: np.ndarray
    heads: tuple[np.ndarray, np.ndarray]
    tails: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, strings: list[bytes]) -> RunIndex:
        data = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.array([len(s) for s in strings], np.int64)
        n = len(data)
        starts = np.cumsum(sizes) - sizes
        left = np.repeat(starts + sizes, sizes) - np.arange(n)
        order = suffix_order(data, left)
        first = np.full(n, -1, np.int32)
        first[starts[sizes > 0]] = 256 + np.flatnonzero(sizes > 0)
        before = np.where(first[order] >= 0, first[order], data[order - 1])
        wide = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
        word = np.zeros(n, np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | wide[i : n + i]
        cut = before[1:] != before[:-1]
        samples = []
        for ends, out in ((np.r_[True, cut], -1), (np.r_[cut, True], 1)):
            rows = np.flatnonzero(ends[:n])
            inner = rows[(rows + out >= 0) & (rows + out < n)]
            at, value = order[rows], np.zeros(len(rows), np.int64)
            value[(rows + out >= 0) & (rows + out < n)] = _common(word, left, order[inner], order[inner + out])
            by = np.argsort(at)
            samples.append((at[by], value[by]))
        # The rows of the ends of the strings come before all others.
        last = [data[b - 1] if k else 256 + i for i, (b, k) in enumerate(zip(starts + sizes, sizes, strict=True))]
        whole = np.r_[np.array(last, np.int32), before]
        edges = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
        return cls(whole[edges], np.diff(np.r_[edges, len(whole)]), sizes, *samples)

    def matching_statistics(self) -> list[np.ndarray]:
        """For each position of each string the longest match that starts at any other position, ending with either string. From a
        sample it is streamed along the text: inside a run it falls by one with each step."""
        n = int(self.sizes.sum())
        best = np.zeros(n, np.int64)
        for at, value in (self.heads, self.tails):
            steps = np.diff(np.r_[at, n])
            np.maximum(best, np.repeat(value + at, steps) - np.arange(n), out=best)
        return np.split(best, np.cumsum(self.sizes)[:-1])

    def occurrences(self, pattern: bytes) -> int:
        """How often a byte string occurs, by backward search over the runs."""
        begins = np.cumsum(self.lengths) - self.lengths
        low, high = 0, int(self.lengths.sum())
        for c in reversed(pattern):
            of = np.flatnonzero(self.chars == c)
            total = np.r_[0, np.cumsum(self.lengths[of])]
            smaller = len(self.sizes) + int(self.lengths[self.chars < c].sum())
            ranks = []
            for row in (low, high):
                k = int(np.searchsorted(begins[of], row, "left"))
                over = max(0, int(begins[of][k - 1] + self.lengths[of][k - 1]) - row) if k else 0
                ranks.append(smaller + int(total[k]) - over)
            low, high = ranks
        return high - low


def _common(word: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at a and b."""
    most = np.minimum(left[a], left[b])
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        k = out[live]
        diff = word[a[live] + k] ^ word[b[live] + k]
        same = diff == 0
        out[live] += np.where(same, 8, 0)
        odd = live[~same]
        bits = diff[~same]
        lead = np.zeros(len(odd), np.int64)
        for i in range(7):  # leading equal bytes
            lead += (lead == i) & (bits >> np.uint64(56 - 8 * i) == 0)
        out[odd] += lead
        live = live[same & (out[live] < most[live])]
    return np.minimum(out, most)


def _spans_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def spans(text: str) -> Iterator[tuple]:
        data = text.encode("utf-8", "surrogatepass")
        for a, b, place, seed in seeds(data, length, gram):
            yield a, b, a - place, seed, *_halves(data[a : b + length])

    return map_texts(docs.select("key", "th", "text"), "text", lambda: spans, "a int, b int, o int, seed long, c1 long, c2 long")


def _marks(opened: DataFrame, length: int) -> DataFrame:
    """(c1, c2, a, b): windows a..b of an open span that also start elsewhere. opened: (core, c1, c2, base,
    lone, span): the windows of ``span`` are numbered from ``base``; lone: the marks are wanted."""
    def index(rows: list[tuple]) -> Iterator[tuple]:
        for (c1, c2, base, lone, span), match in zip(rows, RunIndex.of([r[-1] for r in rows]).matching_statistics(), strict=True):
            if lone:
                hit = np.flatnonzero(np.diff(np.r_[False, match[: len(span) - length + 1] >= length, False]))
                yield from ((c1, c2, base + int(x), base + int(y) - 1) for x, y in zip(hit[::2], hit[1::2], strict=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size, core = [], 0, None
        for batch in batches:
            out = []
            for x in batch.itertuples(index=False, name=None):
                if size >= BLOCK and x[0] != core:
                    out += index(rows)
                    rows, size = [], 0
                core = x[0]
                rows.append(x[1:])
                size += len(x[-1])
            yield pd.DataFrame(out, columns=["c1", "c2", "a", "b"])
        if rows:
            yield pd.DataFrame(list(index(rows)), columns=["c1", "c2", "a", "b"])

    dealt = opened.select("core", "c1", "c2", "base", "lone", "span").repartition("core").sortWithinPartitions("core")
    return dealt.mapInPandas(run, "c1 long, c2 long, a int, b int")


def _halved(hot: DataFrame, length: int) -> DataFrame:
    """Each row of (c1, c2, base, o, lo, hi, span) as its two halves: lo..hi is the group's range of windows
    and o the place of the row's first window, both counted from the seed."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for c1, c2, base, o, lo, hi, span in batch.itertuples(index=False, name=None):
                mid, end = (lo + hi) // 2, o + len(span) - length
                for p, q in ((lo, mid), (mid + 1, hi)):
                    first, last = max(o, p), min(end, q)
                    if first <= last:
                        own = span[first - o : last - o + length]
                        core, _ = _halves(b"%d %d " % (p, q) + span[q - o : p - o + length])
                        rows.append((core, c1, c2, base + first - o, first, p, q, *_halves(own), own))
            yield pd.DataFrame(rows, columns=["core", "c1", "c2", "base", "o", "lo", "hi", "s1", "s2", "span"])

    return hot.select("c1", "c2", "base", "o", "lo", "hi", "span").mapInPandas(
        run, "core long, c1 long, c2 long, base int, o int, lo int, hi int, s1 long, s2 long, span binary"
    )


def _identity(docs: DataFrame, key: str, text: str) -> tuple[Column, Column]:
    """What a row is known by: its key, and a hash of its text and of whether the key is null. The key is made not null, as
    pandas would turn whole numbers beside nulls into floats."""
    kind = docs.schema[key].dataType
    some = F.coalesce(F.col(key), F.lit("0").cast(kind))
    return some.alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(key).isNull()).alias("th")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Rows (key, th, cuts: array of struct(a, b)), for texts that lose bytes: a..b, without b. key and th: of ``_identity``."""
    docs = docs.select(*_identity(docs, key, text), F.coalesce(text, F.lit("")).alias("text")).where(F.octet_length("text") >= length)
    spans = staged(_spans_of(docs, length, gram), "spans")
    # Most seeds stand once; only the spans of the others go on.
    twice = staged(spans.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "seeds")
    spans = staged(spans.join(twice, "seed"), "met")
    kinds = staged(spans.groupBy("seed", "c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("th", "key", "a", "b", "o")).alias("at")), "kinds")
    several = kinds.groupBy("seed").agg(F.count("*").alias("m")).where("m > 1")
    need = kinds.join(several, "seed").select("seed", "m", "c1", "c2", (F.col("n") == 1).alias("lone"), "at.*")
    # One text for each open span, fetched once.
    lists = need.groupBy("key", "th").agg(F.collect_list(F.struct("seed", "m", "c1", "c2", "lone", "a", "b", "o")).alias("want"))
    texts = docs.join(lists.select(F.col("key").alias("k"), F.col("th").alias("t"), "want"), (docs["key"] == F.col("k")) & (F.col("th") == F.col("t")))
    texts = texts.select("th", "key", F.col("text").cast("binary").alias("data"), F.explode("want").alias("w")).select(
        "w.*", F.expr(f"substring(data, w.a + 1, w.b - w.a + {length})").alias("span")
    )
    opened = staged(
        texts.groupBy("c1", "c2").agg(*(F.first(c).alias(c) for c in ("seed", "m", "lone", "o", "span"))).withColumn("base", F.lit(0)), "open"
    )
    found = _marks(opened.where(F.col("m") <= hot).withColumnRenamed("seed", "core"), length)
    rest = opened.where(F.col("m") > hot).select("c1", "c2", "base", "o", F.lit(gram - length).alias("lo"), F.lit(0).alias("hi"), "span")
    while not rest.isEmpty():
        half = staged(_halved(rest, length), "halves")
        same = half.groupBy("core", "s1", "s2").agg(F.count("*").alias("n"))
        size = same.groupBy("core").agg(F.count("*").alias("m"))
        again = half.join(same.where("n > 1"), ["core", "s1", "s2"])
        found = found.unionByName(again.select("c1", "c2", F.col("base").alias("a"), F.expr(f"base + octet_length(span) - {length}").cast("int").alias("b")))
        one = half.groupBy("core", "s1", "s2").agg(F.count("*").alias("n"), F.min(F.struct("c1", "c2", "base", "o", "lo", "hi", "span")).alias("x"))
        one = staged(one.join(size.where("m > 1"), "core").select("core", "m", (F.col("n") == 1).alias("lone"), "x.*"), "halved")
        found = found.unionByName(_marks(one.where(F.col("m") <= hot), length))
        rest = one.where(F.col("m") > hot)
    whole = kinds.where("n > 1").select("c1", "c2", F.lit(0).alias("a"), F.expr("at.b - at.a").alias("b"))
    marks = found.unionByName(whole).select("c1", "c2", F.col("a").alias("x"), F.col("b").alias("y"))
    cuts = spans.select("key", "th", "a", "c1", "c2").join(marks, ["c1", "c2"]).select("key", "th", F.expr("a + x").alias("a"), F.expr(f"a + y + {length}").alias("b"))
    return cuts.groupBy("key", "th").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("cuts"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, over_words: int = 0) -> DataFrame:
    """The input's columns, and _n_bytes long, _n_removed long, _n_spans long, _kept binary: the bytes left.

    ``over_words``: only runs of more words than that (parted by ASCII white space) are removed. Input columns named like
    the new ones are an error; any other name may occur."""
    if clash := {"_n_bytes", "_n_removed", "_n_spans", "_kept"} & set(docs.columns):
        raise ValueError(f"columns named like results: {sorted(clash)}")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for cuts in batch["cuts"]:
                runs: list[list[int]] = []
                for x in cuts:
                    if runs and runs[-1][1] >= x["a"]:
                        runs[-1][1] = max(runs[-1][1], x["b"])
                    else:
                        runs.append([x["a"], x["b"]])
                out.append([{"a": a, "b": b} for a, b in runs])
            yield batch[["key", "th"]].assign(cuts=out)

    found = repeated_spans(docs, key, text, length, gram, hot)
    found = found.mapInPandas(merge, found.schema).withColumnsRenamed({"key": "k", "th": "t"})
    # The input's row is kept as one value, so that its names meet none of those used here.
    rows = docs.select(*_identity(docs, key, text), F.struct("*").alias("row"))
    rows = rows.join(found, (rows["key"] == found["k"]) & (rows["th"] == found["t"]), "left")
    rows = rows.select("row", "cuts", F.coalesce(F.col("row").getField(text), F.lit("")).cast("binary").alias("data"))
    part = lambda a, n: F.call_function("substring", F.col("data"), a + 1, n)
    runs = F.coalesce("cuts", F.array().cast("array<struct<a:int,b:int>>"))
    if over_words:
        runs = F.filter(runs, lambda x: F.regexp_count(part(x["a"], x["b"] - x["a"]).cast("string"), F.lit(r"\S+")) > over_words)
    rows = rows.select("row", "data", runs.alias("runs"))
    size = F.octet_length("data")
    # Piece i lies between cut i and cut i + 1; the pieces are joined at once, as hex digits.
    begins = F.concat(F.array(F.lit(0)), F.transform("runs", lambda x: x["b"]))
    ends = F.concat(F.transform("runs", lambda x: x["a"]), F.array(size))
    pieces = F.transform(F.arrays_zip(begins.alias("p"), ends.alias("q")), lambda x: F.hex(part(x["p"], x["q"] - x["p"])))
    kept = F.when(F.size("runs") == 0, F.col("data")).otherwise(F.unhex(F.array_join(pieces, "")))
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, x: acc + x["b"] - x["a"])
    return rows.select("row.*", size.cast("long").alias("_n_bytes"), gone.alias("_n_removed"), F.size("runs").cast("long").alias("_n_spans"), kept.alias("_kept"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, over_words: int = 0) -> DataFrame:
    """The documents with repeated passages cut out of their texts; columns as given, under any names, n_chars brought up to date.

    A cut inside a character leaves U+FFFD for the rest of it. A null text stays null."""
    row = F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c != text))
    left = remove_repeats(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), row.alias("row")), "key", "text", length, gram, over_words=over_words)
    new = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.make_valid_utf8(F.col("_kept").cast("string")))
    left = left.select("row", new.alias("text"))
    out = [(F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns]
    if "n_chars" in docs.columns and text != "n_chars":
        out[docs.columns.index("n_chars")] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return left.select(*out)
