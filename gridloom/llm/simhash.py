"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint per text; two fingerprints link at ``MAX_BITS`` = 3 or fewer
differing bits. A fingerprint is cut into two segments of 32 bits: of three differing
bits one segment holds at most one, and two segments that differ in at most one bit share
the variant in which that bit is a wildcard. Each distinct fingerprint therefore
files 2 x 32 one-wildcard variants; equal variants meet by an equality
join and each meeting is verified, so no link is lost. Copies are collapsed to
distinct fingerprints first. The fingerprints of a common variant are compared in blocks
inside one task, which emits a spanning forest of the links and not the pairs;
variants with over ``BLOCK`` fingerprints are dealt out as pairs of blocks.

Defined cases: null and empty texts, and texts without a word, have fingerprint zero and
link like any other; fewer words than a shingle count as one shingle; a null key keeps its row
and never becomes a class id unless all keys of the class are null; repeated rows stay; an empty table gives no rows;
other columns are ignored.

The filtering stage, ``keep_one``, goes by similarity and not by fingerprint: texts link at a Jaccard similarity of
``SIMILAR`` = 0.8 or more of their sets of five-word shingles. Such texts differ in some ten of 64 fingerprint bits, a
radius at which one-wildcard segments are eight bits or shorter and every two texts meet. Its signatures are therefore of
least hashes, of which a share equal to the similarity agrees, and not of bits; they are cut, varied and joined in the same way: ``SEGMENTS`` =
8 segments of ``SYMBOLS`` = 5 least hashes, each filed without each one of its symbols in turn, so that two segments
that differ in at most one symbol share a variant. A pair at 0.8 has no such segment with a chance of 2 in 100,000, a closer one more
rarely. Every link is verified on the shingles themselves. Equal sets collapse first, and variants with the same members are one. The
members of a variant are first compared with one of them, then only those of different components, in blocks, by lists of what each shingle
stands in; a task emits a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, few, map_texts, staged, table, with_hot

WORDS, MAX_BITS, SEED, BLOCK, ROOM, SOME = 3, 3, 42, 2048, 1 << 20, 64
STAGE_WORDS, SIMILAR, SEGMENTS, SYMBOLS = 5, 0.8, 8, 5
OTHERS = np.array([[j for j in range(SYMBOLS) if j != i] for i in range(SYMBOLS)])
# Fixed odd factors and masks: each pair makes another order of the hashes.
FACTORS, MASKS = (np.random.default_rng(SEED).integers(1, 1 << 63, (2, SEGMENTS * SYMBOLS), np.uint64) * np.uint64(2) + np.uint64(1))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The SimHash of a text's word shingles: a bit is set if over half of the hashes have it."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    of = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 16):  # bounded memory for long texts
        h = np.array([of(b" ".join(parts[i : i + words]), SEED) for i in range(a, min(n, a + (1 << 16)))], ">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """Rows (key, th long: xxhash64 of the text, fp long: the fingerprint's 64 bits as a signed number)."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    signed = lambda x: ((fingerprint(x, words) + (1 << 63)) % (1 << 64) - (1 << 63),)
    return map_texts(rows, "text", lambda: lambda x: [signed(x)], "fp long")


def forest(a: np.ndarray, b: np.ndarray | None, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among ``a``, or among ``a`` and ``b`` together."""
    x = a if b is None else np.concatenate([a, b])
    bits = x.view(np.uint64)  # numpy counts the bits of absolute values
    root = np.arange(len(x))
    edges = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(x)):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= max_bits) + i + 1
        for j in near:
            p, q = find(i), find(int(j))
            if p != q:
                root[q] = p
                edges.append((int(x[i]), int(x[j])))
    return edges


def _counted(filed: DataFrame, block: int) -> DataFrame:
    """Rows (variant, fp) of variants that more than one fingerprint has, with their number n.

    Counting by a window sends each row once, but all of a variant to one task. Variants that look common among one fingerprint in ``SOME`` are
    therefore counted by sums, and their rows stay where they are; which way a variant goes does not change its rows or its number."""
    some = filed.where(F.pmod(F.xxhash64("fp"), F.lit(SOME)) == 0)
    common = staged(some.groupBy("variant").agg(F.count("*").alias("n")).where(F.col("n") > block / (2 * SOME)).select("variant"), "common")
    alone = lambda df: df.select("variant", "fp", F.count("*").over(Window.partitionBy("variant")).alias("n")).where("n > 1")
    if common.isEmpty() or not few(common):
        return alone(filed)
    hot = filed.join(F.broadcast(common), "variant")
    sums = hot.groupBy("variant").agg(F.count("*").alias("n")).where("n > 1")
    return alone(filed.join(F.broadcast(common), "variant", "left_anti")).unionByName(hot.join(F.broadcast(sums), "variant").select("variant", "fp", "n"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect the same distinct fingerprints as all links do. fps: (fp long), distinct."""
    if max_bits != MAX_BITS:
        raise ValueError("two segments and one wildcard hold for three differing bits")
    # The variant's number: segment, wildcard, and the segment's bits without it.
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(0xFFFFFFFF)
    bits = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(
        i.alias("i"),
        high.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("h"),
        low.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("l"),
    ))
    tag = lambda s, i, v: (F.lit(s).cast("long") * 32 + i) * F.lit(1 << 32) + v
    keys = F.flatten(F.transform(bits, lambda x: F.array(tag(0, x["i"], x["h"]), tag(1, x["i"], x["l"]))))
    # Few bytes become many rows here: they are dealt out before, and meet in one shuffle.
    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), fps.count() // 50_000)
    filed = fps.repartition(tasks, "fp").select("fp", F.explode(keys).alias("variant"))
    rows = staged(_counted(filed, block), "variants")
    small = rows.where(F.col("n") <= block).groupBy("variant").agg(F.collect_list("fp").alias("a")).select("a", F.lit(None).cast("array<long>").alias("b"))
    # A common variant: its fingerprints in blocks, each pair of blocks a row of its own.
    size = F.ceil(F.col("n") / F.lit(block)).cast("long")
    hot = rows.where(F.col("n") > block).withColumn("c", F.pmod(F.xxhash64("fp"), size))
    hot = hot.select("variant", "fp", "c", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)).alias("d"))
    hot = hot.select("variant", "fp", "c", F.least("c", "d").alias("p"), F.greatest("c", "d").alias("q")).groupBy("variant", "p", "q").agg(
        F.collect_list(F.when(F.col("c") == F.col("p"), F.col("fp"))).alias("a"), F.collect_list(F.when(F.col("c") != F.col("p"), F.col("fp"))).alias("b")
    ).select("a", "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {e for a, b in zip(batch["a"], batch["b"], strict=True) for e in forest(np.asarray(a, np.int64), None if b is None or not len(b) else np.asarray(b, np.int64))}
            yield pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return small.unionByName(hot).mapInPandas(run, "a long, b long").distinct()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """Rows (key, th, fp, root: the class's smallest fingerprint, component_id: its smallest key), one for each document."""
    marked = staged(fingerprints(docs, key, text, words), "fingerprints")
    least = staged(marked.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n")), "distinct")
    groups = components(links(least.select("fp")))
    roots = least.join(groups, least["fp"] == groups["node"], "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root"))
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(roots.join(ids, "root").select("fp", "n", "root", "component_id"), "named")
    return with_hot(marked, named, ["fp"], "n").drop("n")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """Rows (key, fingerprint string, component_id: the smallest key reachable by links)."""
    return classes(docs, key, text, words).select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingles(text: str | None, words: int = STAGE_WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles; none of a text without a word."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    of = xxhash.xxh64_intdigest
    return np.unique(np.array([of(b" ".join(parts[i : i + words]), SEED) for i in range(max(1, len(parts) - words + 1))], np.uint64))


def variant_keys(own: np.ndarray) -> np.ndarray:
    """The keys of a set of shingles: of each segment of its least hashes, in an order for each, those without one of them."""
    least = np.full(SEGMENTS * SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(own), 4096):  # bounded memory for long texts
        least = np.minimum(least, ((own[a : a + 4096, None] ^ MASKS) * FACTORS).min(0))
    left = least.reshape(SEGMENTS, SYMBOLS)[:, OTHERS].tobytes()
    n = 8 * (SYMBOLS - 1)
    keys = [xxhash.xxh64_intdigest(left[i * n : (i + 1) * n], i) for i in range(SEGMENTS * SYMBOLS)]
    return np.array(keys, np.uint64).view(np.int64)


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, th, sig long: a hash of the set of shingles, size int of the set, variants array<long>)."""
    def sketch(text: str | None) -> list[tuple]:
        own = shingles(text)
        return [(int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), SEED)).view(np.int64)), len(own), variant_keys(own))]

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return map_texts(rows, "text", lambda: sketch, "sig long, size int, variants array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``sets`` (sig, own binary) have a Jaccard similarity of ``SIMILAR`` or more."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= SIMILAR * (len(x) + len(y) - both))
            yield batch.loc[good, ["a", "b"]]

    left, right = sets.select(F.col("sig").alias("a"), F.col("own").alias("x")), sets.select(F.col("sig").alias("b"), F.col("own").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def similar_forest(root: list[int], sets: list[np.ndarray], side: list[int]) -> list[tuple[int, int]]:
    """Edges (places i, j) of a spanning forest of the links among ``sets``, where equal roots are linked already; if there are
    two sides, links within a side are left to others."""
    part = {}
    of = [part.setdefault(r, i) for i, r in enumerate(root)]
    sizes, sides = np.array([len(x) for x in sets]), np.array(side)
    words, at = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    crossing, edges = len(set(side)) > 1, []

    def find(i: int) -> int:
        while of[i] != i:
            of[i] = of[of[i]]
            i = of[i]
        return i

    def link(i: int, shared: np.ndarray) -> None:
        near = shared >= SIMILAR * (sizes + sizes[i] - shared)
        for j in np.flatnonzero(near & (sides != sides[i]) if crossing else near):
            p, q = find(i), find(int(j))
            if p != q:
                of[max(p, q)] = min(p, q)
                edges.append((i, int(j)))

    link(0, np.bincount(at[np.isin(words, sets[0])], minlength=len(sets)))
    roots = np.array([find(i) for i in range(len(sets))])
    # Sets of the largest class are not compared with each other: what the others hold is listed by shingle.
    names, counts = np.unique(roots, return_counts=True)
    open_ = (roots != names[counts.argmax()])[at]
    by = np.argsort(words[open_], kind="stable")
    words, at = words[open_][by], at[open_][by]
    for i, own in enumerate(sets):
        low, high = np.searchsorted(words, own, "left"), np.searchsorted(words, own, "right")
        n = high - low
        if total := int(n.sum()):
            place = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(total)
            link(i, np.bincount(at[place], minlength=len(sets)))
    return edges


def cross_links(rows: DataFrame, sets: DataFrame, block: int = BLOCK, room: int = ROOM) -> DataFrame:
    """Edges (a, b) that, with the roots, connect what all links within the variants do. rows: (variant, sig, size, root). Only variants
    of several roots are looked at, each in one task; those of over ``block`` sets or ``room`` shingles as pairs of blocks. A task
    emits a spanning forest, never the pairs."""
    split = rows.groupBy("variant").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.greatest(F.count("*") / block, F.sum("size") / room)).cast("long").alias("parts"))
    dealt = rows.join(split.where("low < high").select("variant", "parts"), "variant").join(sets, "sig").withColumn("c", F.pmod(F.xxhash64("sig"), "parts"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("d"))
    dealt = dealt.select("variant", F.least("c", "d").alias("p"), F.greatest("c", "d").alias("q"), "c", "sig", "root", "own")

    def forest_of(group: list[tuple]) -> list[tuple[int, int]]:
        side, sig, root, own = zip(*group, strict=True)
        if len(set(root)) < 2:
            return []
        return [(min(sig[i], sig[j]), max(sig[i], sig[j])) for i, j in similar_forest(root, [np.frombuffer(x, np.uint64) for x in own], side)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, now = [], None
        for batch in batches:
            out = []
            for variant, p, q, *rest in batch.itertuples(index=False, name=None):
                if (variant, p, q) != now and group:
                    out += forest_of(group)
                    group = []
                now = variant, p, q
                group.append(rest)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        if group:
            yield pd.DataFrame(forest_of(group), columns=["a", "b"], dtype="int64")

    return dealt.repartition("variant", "p", "q").sortWithinPartitions("variant", "p", "q").mapInPandas(run, "a long, b long").distinct()


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, th, root), one for each document: root is one for the texts that links of similarity connect."""
    marked = staged(sketches(docs, key, text), "sketches")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "th")).alias("s")
    nodes = marked.groupBy("sig").agg(first, F.first("size").alias("size"), F.first("variants").alias("variants"), F.count("*").alias("n"))
    nodes = staged(nodes.select("sig", "s.key", "s.th", "size", "variants", "n"), "distinct")
    copies, nodes = nodes.select("sig", "n"), nodes.where("size > 0").drop("n")
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.count() // 50_000)
    filed = nodes.select("sig", "size", "variants").repartition(tasks, "sig").select("sig", "size", F.explode("variants").alias("variant"))
    # Of variants with the same members one will do: by count and two hashes of the members.
    hub = F.min(F.struct(F.xxhash64("sig").alias("order"), "sig"))["sig"].alias("hub")
    met = filed.groupBy("variant").agg(F.count("*").alias("n"), hub, F.bit_xor(F.xxhash64("sig")).alias("m1"), F.bit_xor(F.xxhash64(F.lit("again"), "sig")).alias("m2")).where("n > 1")
    met = met.groupBy("n", "m1", "m2").agg(F.min("variant").alias("variant"), F.first("hub").alias("hub")).select("variant", "hub")
    rows = staged(filed.join(staged(met, "met"), "variant"), "variants")

    need = nodes.join(rows.select("sig").distinct(), "sig", "left_semi").select("sig", F.col("key").alias("_key"), F.col("th").alias("_th"))
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    texts = texts.join(need, texts["key"].eqNullSafe(need["_key"]) & (texts["th"] == need["_th"])).select("sig", "text").dropDuplicates(["sig"])
    sets = staged(map_texts(texts, "text", lambda: lambda x: [(shingles(x).tobytes(),)], "own binary"), "shingles")
    pairs = staged(rows.where("sig != hub").select(F.least("sig", "hub").alias("a"), F.greatest("sig", "hub").alias("b")).distinct(), "pairs")
    links = staged(verified(pairs, sets), "links")
    groups = components(links)
    open_ = rows.join(groups, rows["sig"] == groups["node"], "left").select("variant", "sig", "size", F.coalesce("root", "sig").alias("root"))
    more = staged(cross_links(staged(open_, "open"), sets), "links")
    if not more.isEmpty():
        groups = components(links.unionByName(more))
    roots = staged(copies.join(groups, copies["sig"] == groups["node"], "left").select("sig", "n", F.coalesce("root", "sig").alias("root")), "roots")
    return with_hot(marked, roots, ["sig"], "n").select("key", "th", "root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of similar texts: of the smallest key, null keys last. Of rows with the same key and
    text one stays. Columns as given."""
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "th")).alias("s")
    stay = similar_classes(docs, key, text).groupBy("root").agg(first).select(F.col("s.key").alias("_key"), F.col("s.th").alias("_th"))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.struct("*").alias("row"))
    rows = rows.join(stay, rows["key"].eqNullSafe(stay["_key"]) & (rows["th"] == stay["_th"]), "left_semi")
    return rows.dropDuplicates(["key", "th"]).select("row.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
