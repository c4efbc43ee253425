"""Text quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. A byte's number, with 256 more where it ends a repeat of
what stood up to ``LAGS`` bytes before, has a learned vector; learned filters of ``WIDTH`` bytes slide over these, half their width at a
time, and each chunk keeps every filter's largest answer. The largest and the mean of these over the chunks give one probability.

Training is spread: the labelled sample is dealt into ``SHARDS``, a task trains the common weights on one shard for a few epochs,
and their average starts the next round. The sample has at most ``SAMPLE`` labelled rows that are not held out, in the
order of the hash of their ids; copies in it count once. The gradient goes through the windows that gave the largest answers.

Defined cases: null and empty texts are one chunk of padding and get a score like any other; without labels of both classes the
score is the share of good training rows (0 without any); several labels of a document count as good if all are; null labels and null ids
teach nothing; repeated rows are scored each on its own; an empty table gives no rows; other columns of ``docs`` are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kind_of, staged, table
from .toxicity import held_out

SAMPLE, SHARDS, ROUNDS, EPOCHS, BATCH, RATE = 6000, 4, 4, 4, 16, 0.004
CHUNK, OVERLAP, WIDTH, DEPTH, FILTERS, LAGS = 512, 64, 8, 8, 24, 32
STEP, HALF, PAD = CHUNK - OVERLAP, WIDTH // 2, 255  # UTF-8 has no byte 255
SLAB, KEEP = 256, 0.3


def fresh(seed: int = 0) -> dict[str, np.ndarray]:
    """Weights before training."""
    rnd = np.random.default_rng(seed)
    return {
        "bytes": (rnd.standard_normal((512, DEPTH)) * 0.5).astype(np.float32), "filters": (rnd.standard_normal((FILTERS, WIDTH * DEPTH)) * (1.0 / WIDTH)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32), "out": (rnd.standard_normal(2 * FILTERS) * 0.1).astype(np.float32), "base": np.zeros(1, np.float32),
    }


def chunks(text: bytes) -> np.ndarray:
    """(chunks, CHUNK) bytes, padded: chunk i starts at byte i * STEP, and together they hold every byte."""
    k = max(1, -(-(len(text) - OVERLAP) // STEP))
    padded = np.full((k - 1) * STEP + CHUNK, PAD, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def numbers(chunk: np.ndarray) -> np.ndarray:
    """Bytes as 0 to 255, and 256 more where the last four stood up to LAGS bytes before too. Padding is PAD."""
    repeats = np.zeros(chunk.shape, bool)
    for lag in range(2, LAGS + 1):
        run = chunk[:, lag:] == chunk[:, :-lag]
        run = run[:, 1:] & run[:, :-1]
        run = run[:, 2:] & run[:, :-2]
        repeats[:, lag + 3 :] |= run
    return chunk + np.where(repeats & (chunk != PAD), np.uint16(256), np.uint16(0))


def answers(ids: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    """(chunks, windows, FILTERS): a window's answer is that of its two halves."""
    n = len(ids)
    halves = w["bytes"][ids].reshape(n * (CHUNK // HALF), HALF * DEPTH)
    both = np.concatenate([w["filters"][:, : HALF * DEPTH], w["filters"][:, HALF * DEPTH :]]).T
    y = (halves @ both).reshape(n, CHUNK // HALF, 2 * FILTERS)
    return y[:, :-1, :FILTERS] + y[:, 1:, FILTERS:] + w["bias"]


def pooled(chunk: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    return np.maximum(answers(numbers(chunk), w).max(1), 0)


def vectors(texts: Sequence[bytes], w: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, 2 FILTERS): the largest and the mean of the chunks' answers. At most ``SLAB`` chunks are held at once, of one text or several."""
    most, total, count = np.zeros((len(texts), FILTERS), np.float32), np.zeros((len(texts), FILTERS)), np.zeros(len(texts))
    held: list[tuple[int, np.ndarray]] = []

    def done() -> None:
        found = pooled(np.concatenate([c for _, c in held]), w)
        starts = np.cumsum([0, *(len(c) for _, c in held[:-1])])
        at = [i for i, _ in held]
        most[at] = np.maximum(most[at], np.maximum.reduceat(found, starts))
        total[at] += np.add.reduceat(found, starts, dtype=np.float64)
        count[at] += [len(c) for _, c in held]
        held.clear()

    room = SLAB
    for i, text in enumerate(texts):
        own = chunks(text)
        while len(own):
            held.append((i, own[:room]))
            own, room = own[room:], room - len(own[:room])
            if not room:
                done()
                room = SLAB
    if held:
        done()
    return np.concatenate([most, total / np.maximum(count, 1)[:, None]], 1)


def probability(texts: Sequence[bytes], w: dict[str, np.ndarray]) -> np.ndarray:
    return 1 / (1 + np.exp(-(vectors(texts, w) @ w["out"].astype(np.float64) + float(w["base"][0]))))


def gradient(texts: Sequence[bytes], good: np.ndarray, w: dict[str, np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
    """The mean log loss and its gradient."""
    own = [chunks(x) for x in texts]
    k = np.array([len(c) for c in own])
    starts = np.concatenate([[0], np.cumsum(k)[:-1]])
    doc = np.repeat(np.arange(len(texts)), k)
    ids = np.concatenate([numbers(np.ascontiguousarray(c)) for c in own])
    found, where = np.empty((len(ids), FILTERS), np.float32), np.empty((len(ids), FILTERS), np.int64)
    for a in range(0, len(ids), SLAB):
        y = answers(ids[a : a + SLAB], w)
        where[a : a + SLAB] = y.argmax(1)
        found[a : a + SLAB] = np.maximum(y.max(1), 0)
    most, mean = np.maximum.reduceat(found, starts), np.add.reduceat(found, starts) / k[:, None]
    v = np.concatenate([most, mean], 1)
    p = 1 / (1 + np.exp(-np.clip(v @ w["out"] + w["base"][0], -30, 30)))
    loss = -np.mean(np.where(good > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9)))
    d = ((p - good) / len(texts)).astype(np.float32)
    out = {"out": v.T @ d, "base": np.array([d.sum()], np.float32)}
    # Back to each chunk's largest answers: all by the mean, the first of the largest by the largest.
    top = found == most[doc]
    first = top & (np.cumsum(top, 0) - np.where(starts[doc][:, None] > 0, np.cumsum(top, 0)[starts[doc] - 1], 0) == 1)
    back = d[doc][:, None] * (w["out"][FILTERS:] / k[doc][:, None] + np.where(first, w["out"][:FILTERS], 0))
    back = np.where(found > 0, back, 0).astype(np.float32)
    at = where[:, :, None] * HALF + np.arange(WIDTH)  # (chunks, FILTERS, WIDTH)
    seen = ids[np.arange(len(ids))[:, None, None], at]
    out["bias"] = back.sum(0)
    out["filters"] = np.einsum("nf,nfx->fx", back, w["bytes"][seen].reshape(len(ids), FILTERS, WIDTH * DEPTH))
    weight = (back[:, :, None, None] * w["filters"].reshape(FILTERS, WIDTH, DEPTH)).reshape(-1, DEPTH)
    out["bytes"] = np.stack([np.bincount(seen.ravel(), weight[:, j], 512) for j in range(DEPTH)], 1).astype(np.float32)
    out["bytes"][PAD] = 0
    return float(loss), out


def trained(texts: Sequence[bytes], good: np.ndarray, w: dict[str, np.ndarray], epochs: int, seed: int, rate: float = RATE) -> dict[str, np.ndarray]:
    """The weights after some epochs of Adam."""
    rnd, w = np.random.default_rng(seed), {n: x.copy() for n, x in w.items()}
    w["bytes"][PAD] = 0
    m, s = ({n: np.zeros_like(x) for n, x in w.items()} for _ in range(2))
    t = 0
    for _ in range(epochs):
        order = rnd.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            _, g = gradient([texts[i] for i in some], good[some], w)
            t += 1
            for n in w:
                m[n] += 0.1 * (g[n] - m[n])
                s[n] += 0.01 * (g[n] ** 2 - s[n])
                w[n] -= rate * (m[n] / (1 - 0.9**t)) / (np.sqrt(s[n] / (1 - 0.99**t)) + 1e-6)
    return w


def packed(w: dict[str, np.ndarray]) -> list[float]:
    return np.concatenate([w[n].ravel() for n in sorted(w)]).tolist()


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    like, at, out = fresh(), 0, {}
    for n in sorted(like):
        out[n] = np.asarray(flat[at : at + like[n].size], np.float32).reshape(like[n].shape)
        at += like[n].size
    return out


def _round(w: dict[str, np.ndarray], epochs: int, seed: int, rate: float) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def train(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("text")
        new = trained([t.encode("utf-8", "surrogatepass") for t in x["text"]], x["good"].to_numpy(np.float32), w, epochs, seed + int(key[0]), rate)
        return pd.DataFrame({"shard": [key[0]], "n": [len(x)], "w": [packed(new)]})

    return train


def fit(taught: DataFrame, rounds: int = ROUNDS, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """The weights learned from ``taught`` (good int, text string, shard int), a bounded sample; a shard is one task's."""
    w = fresh()
    for r in range(rounds):
        found = taught.groupBy("shard").applyInPandas(_round(w, epochs, 1000 * r, RATE / (1 + r)), "shard int, n long, w array<float>")
        found = sorted(found.collect(), key=lambda x: x.shard)  # SHARDS rows
        w = unpacked(np.average([x.w for x in found], axis=0, weights=[x.n for x in found]))
    return w


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", target: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Rows (key, _held_out boolean, _score double, _predicted int), learned from the labels of rows not held out."""
    known = labels.where(F.col(key).isNotNull() & F.col(target).isNotNull()).where(~held_out(key)).groupBy(key).agg(F.min(F.col(target).cast("int")).alias("good"))
    known = known.orderBy(F.xxhash64(key), key).limit(sample)  # so few that they may be broadcast
    texts = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("text"))
    taught = texts.join(F.broadcast(known), key).groupBy("good", "text").agg(F.pmod(F.xxhash64("text"), F.lit(SHARDS)).cast("int").alias("shard"))
    taught = staged(taught, "taught")
    counts = {r.good: r.n for r in taught.groupBy("good").agg(F.count("*").alias("n")).collect()}
    base = docs.select(F.col(key), held_out(key).alias("_held_out"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    if len(counts) < 2:
        judged = base.select(key, "_held_out", F.lit(float(max(counts, default=0))).alias("_score"))
    else:
        judged = _scored(base, fit(taught), key)
    return judged.withColumn("_predicted", (F.col("_score") >= KEEP).cast("int"))


def _scored(base: DataFrame, w: dict[str, np.ndarray], key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, size = [], [], 0
            for value in batch.column("_text"):
                texts.append(value.as_buffer())
                size += len(texts[-1])
                if size > 4 << 20:
                    found.append(probability(texts, w))
                    texts, size = [], 0
            found.append(probability(texts, w))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_held_out"), pa.array(np.concatenate(found), pa.float64())], names=[key, "_held_out", "_score"])

    return base.mapInArrow(run, f"`{key}` {kind_of(base, key)}, _held_out boolean, _score double")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))
