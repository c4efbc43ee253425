"""Best-fit packing by a linear grouping scheme.

Only the histogram of lengths decides the layout, so the plan is made on the driver from at
most ``CAPACITY`` counts, whatever the number of documents; Spark tokenises, ranks the pieces within each length,
places them by the plan and adds up offsets.

1. Large lengths are sorted and cut into groups of equal cardinality; each is rounded up to its group's largest.
2. Configurations of these few sizes are chosen: the largest size left, and with it the sizes that
   fill a sequence best (a subset-sum table), as often as the counts allow.
3. Each slot gets actual pieces of its group, in order of length, which frees what rounding took.
4. Small pieces, longest first, go where they fit best; what fits nowhere opens new sequences.
5. Of the plans of several numbers of groups and bounds of small lengths the one of fewest sequences is taken.

A document is its ids and the end id; only longer ones are cut, the first piece taking what
is over whole sequences.

Defined cases: a null or empty text is the end id alone; the strings of special ids in a text are those ids, as the
tokenizers library has it; repeated rows are packed each on its own; an empty table gives no rows; other columns are ignored,
whatever their names; a key named like a result (piece, start, length, ids_crc32, sequence_id, offset) is an error.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import carried, kind_of, map_texts, restored, staged, table

CAPACITY, END = 1024, 2
#: Numbers of groups, and shares of a sequence up to which a length is small, that are tried.
GROUPS, SMALL = (32, 64, 128, 256, 512, 1024), (2, 4, 8)
# Fixed value: what the pattern's \s stands for (Unicode's White_Space), in long runs.
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
RESULTS = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@functools.lru_cache(2)
def tokenizer(path: str) -> Callable[[str], list[int]]:
    """Text to ids by a byte-level BPE file of the tokenizers library, special ids' strings included.

    Such a file's ids are ranks of its merges, so tiktoken, which takes a quarter of the time, gives the same ids
    from the same file (tests compare them). Its matcher needs stack for each character of a run of white space; a run
    of 1000 or more is therefore cut out beforehand where the pattern cuts it: before its last character, or
    at its end if no text follows. Files of another make go to the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    own = Tokenizer.from_file(path)
    plain = lambda text: own.encode(text, add_special_tokens=False).ids
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    alike = (
        model["type"] == "BPE" and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split["use_regex"] and not spec["normalizer"]
        and not any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] or not x["special"] for x in spec["added_tokens"])
        and [vocab.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges)))
    )
    if not alike:
        return plain
    # The library writes bytes as characters: printable ones as they are, the others from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks={bytes(byte_of[c] for c in w): i for w, i in vocab.items()}, special_tokens=special)
    every = set(special)

    def encode(text: str) -> list[int]:
        ids, at = [], 0
        for run in WHITE.finditer(text):
            a, b = run.span()
            if b < len(text) and not text.startswith(tuple(every), b):
                b -= 1
            ids += fast.encode(text[at:a], allowed_special=every)
            ids += fast._encode_single_piece(text[a:b])
            at = b
        return ids + fast.encode(text[at:], allowed_special=every)

    return encode


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Rows (key, piece int, start long, length long, ids_crc32 long)."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if key in RESULTS:
        raise ValueError(f"the key is named like a result: {key}")

    def made() -> Callable[[str | None], Iterator[tuple]]:
        encode = tokenizer(path)

        def cut(text: str | None) -> Iterator[tuple]:
            ids = np.array(array("I", [*encode(text or ""), end]), "<u4")
            first = (len(ids) - 1) % capacity + 1
            for i, stop in enumerate(range(first, len(ids) + 1, capacity)):
                start = stop - capacity if i else 0
                yield i, start, stop - start, zlib.crc32(ids[start:stop].tobytes())

        return cut

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_texts(rows, "text", made, "piece int, start long, length long, ids_crc32 long").withColumnRenamed("key", key)


def configuration(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> dict[int, int]:
    """How many of each size a sequence takes: the largest that is left, and what fills the rest best."""
    top = int(np.flatnonzero(counts)[0])
    room = capacity - int(sizes[top])
    by = np.full(room + 1, -1)  # the size that reached a sum first; larger sizes come first
    by[0] = len(sizes)
    for g in range(top, len(sizes)):
        size, free = int(sizes[g]), int(counts[g]) - (g == top)
        for _ in range(min(free, room // size)):
            new = np.flatnonzero((by[size:] < 0) & (by[: room + 1 - size] >= 0)) + size
            if not len(new):
                break
            by[new] = g
        if by[room] >= 0:
            break
    fill, taken = int(np.flatnonzero(by >= 0)[-1]), {top: 1}
    while fill > 0:
        g = int(by[fill])
        taken[g] = taken.get(g, 0) + 1
        fill -= int(sizes[g])
    return taken


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 128, small: int = 4) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, so many in a sequence, first sequence): ranks count from 0 within a length.

    Lengths over capacity / ``small`` are large."""
    lengths = sorted((x for x in histogram if x * small > capacity and x < capacity and histogram[x]), reverse=True)
    total = sum(histogram[x] for x in lengths)
    out: list[tuple[int, int, int, int, int]] = []
    seqs = histogram.get(capacity, 0)
    if seqs:
        out.append((capacity, 0, seqs, 1, 0))
    # Groups of equal cardinality over the lengths in falling order: their runs (length, first rank, count).
    each = max(1, -(-total // groups))
    runs: list[list[list[int]]] = []
    filled = each
    for x in lengths:
        rank = 0
        while rank < histogram[x]:
            if filled == each:
                runs.append([])
                filled = 0
            n = min(each - filled, histogram[x] - rank)
            runs[-1].append([x, rank, n])
            filled += n
            rank += n
    sizes = np.array([r[0][0] for r in runs], np.int64)
    counts = np.array([sum(x[2] for x in r) for r in runs], np.int64)
    free: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, count)
    while counts.any():
        taken = configuration(sizes, counts, capacity)
        times = min(int(counts[g]) // k for g, k in taken.items())
        slots: list[list[tuple[int, int]]] = []  # for each slot (length, count) along the sequences
        for g, k in taken.items():
            counts[g] -= k * times
            for _ in range(k):
                slot, need = [], times
                while need:
                    x, rank, n = runs[g][0]
                    use = min(n, need)
                    out.append((x, rank, use, 1, seqs + times - need))
                    slot.append((x, use))
                    need -= use
                    runs[g][0] = [x, rank + use, n - use]
                    if use == n:
                        runs[g].pop(0)
                slots.append(slot)
        at, heads = 0, [[0, s[0][1]] for s in slots]
        while at < times:
            step = min(h[1] for h in heads)
            room = capacity - sum(s[h[0]][0] for s, h in zip(slots, heads, strict=True))
            if room:
                free.setdefault(room, []).append((seqs + at, step))
            at += step
            for s, h in zip(slots, heads, strict=True):
                h[1] -= step
                if not h[1] and h[0] + 1 < len(s):
                    h[0] += 1
                    h[1] = s[h[0]][1]
        seqs += times
    for x in sorted((x for x in histogram if x * small <= capacity and histogram[x] and x < capacity), reverse=True):
        rank, left = 0, histogram[x]
        while left:
            room = min((r for r in free if r >= x), default=0)
            if not room:
                n = -(-left // (capacity // x))
                free[room := capacity] = [(seqs, n)]
                seqs += n
            first, n = free[room].pop()
            if not free[room]:
                del free[room]
            k = min(room // x, left)
            use = min(n, left // k)
            out.append((x, rank, use * k, k, first))
            rank += use * k
            left -= use * k
            if room > k * x:
                free.setdefault(room - k * x, []).append((first, use))
            if use < n:
                free.setdefault(room, []).append((first + use, n - use))
    return out


def sequences(layout: list[tuple[int, int, int, int, int]]) -> int:
    """How many sequences a plan takes."""
    return max((first + -(-n // each) for _, _, n, each, first in layout), default=0)


def fewest(histogram: dict[int, int], capacity: int = CAPACITY, groups: Sequence[int] = GROUPS, small: Sequence[int] = SMALL) -> list[tuple[int, int, int, int, int]]:
    """Of the plans of several numbers of groups and bounds of small lengths that with the fewest sequences, ties to the first: each sees counts only."""
    return min((plan(histogram, capacity, g, s) for g in groups for s in small), key=sequences)


def pack(parts: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, groups: Sequence[int] = GROUPS, small: Sequence[int] = SMALL) -> DataFrame:
    """``parts`` (of ``pieces``) with sequence_id long and offset long, by the plan of the ``fewest`` sequences."""
    parts = parts.select(F.col(key).alias("key"), "piece", "start", "length", "ids_crc32")
    counted = parts.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    n = sum(r.n for r in counted)
    layout = fewest({r.length: r.n for r in counted}, capacity, groups, small)
    # Ranks within a length: by salt, then within the salt, so that a common length is no one task's.
    salts = 8 + n // 100_000
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_salt").orderBy("key", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    by_length: dict[int, np.ndarray] = {}
    for x in {r[0] for r in layout}:
        by_length[x] = np.array(sorted(r[1:] for r in layout if r[0] == x), np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seq = np.empty(len(b), np.int64)
            length, rank = b["length"].to_numpy(), b["_rank"].to_numpy()
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, _, each, base = by_length[int(x)].T
                i = np.searchsorted(first, rank[at], "right") - 1
                seq[at] = base[i] + (rank[at] - first[i]) // each[i]
            yield b.assign(sequence_id=seq)

    own, _ = carried(parts, "key")
    kept = ranked.select(*(own.alias(c) if c == "key" else c for c in parts.columns), "_rank")
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "sequence_id long"])
    placed = restored(kept.mapInPandas(place, shape), "key", kind_of(parts, "key"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("_rank").withColumnRenamed("key", key)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    return pack(staged(pieces(docs, key, text, path), "pieces"), key)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
