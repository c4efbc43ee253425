"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a lexicon and of its stems, their proximity to
second-person words, capitals, punctuation, and obfuscated spellings. The lexicon is learned from the labelled training
rows, of which copies of a text count once: words, and stems of five letters, that stand in far more toxic than clean
documents. The trees are Spark ML's, fitted on four fifths of a sample of at most ``SAMPLE``
labelled training rows, the calibration on the rest. Every document is scored, by its text alone.

Defined cases: null and empty texts have all features zero and get a score like any other; without labels of both
classes the score is the share of toxic training rows (0 without any); several labels of
a document count as toxic if one is; null labels and null ids teach nothing; repeated rows are
scored each on its own; an empty table gives no rows; other columns of ``docs`` are ignored by ``score`` and carried along by
``drop_toxic``, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, staged, table

SAMPLE, FOLDS, STEM = 20_000, 5, 5
# Second-person words of the four languages.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta vous votre vos tú ti usted ustedes vosotros tus".split())
LEET = str.maketrans("013457@$!*", "oieastasi.")
WORD, ODD = re.compile(r"[^\W\d_]+"), re.compile(r"[^\W\d_]+[0-9@$*!.]+[^\W\d_][\w@$*]*")
SHOUT, MARKS = re.compile(r"\b[^\W\d_a-zà-öø-ÿ]{3,}\b"), re.compile(r"[!?]")
WIDTH = 12


def features(text: str | None, words: frozenset[str], stems: frozenset[str]) -> list[float]:
    """The dense features of one text."""
    if not text:
        return [0.0] * WIDTH
    found = WORD.findall(text.lower())
    n = max(1, len(found))
    hits = [i for i, w in enumerate(found) if w in words]
    stem_hits = sum(w[:STEM] in stems for w in found if len(w) > STEM)
    you = [i for i, w in enumerate(found) if w in YOU]
    at = np.asarray(hits, np.int64)
    near = int((np.searchsorted(you, at - 5, "left") < np.searchsorted(you, at + 5, "right")).sum())  # both lists are sorted
    odd = ODD.findall(text)
    masked = sum((plain := w.lower().translate(LEET).replace(".", "")) in words or plain[:STEM] in stems for w in odd)
    upper = sum(map(str.isupper, text))
    return [
        float(len(hits)), len(hits) / n, len({found[i] for i in hits}) / n**0.5, float(stem_hits), stem_hits / n, near / n, len(you) / n,
        upper / len(text), len(SHOUT.findall(text)) / n, len(MARKS.findall(text)) / n, len(odd) / n, float(masked),
    ]


def held_out(key: str, folds: int = FOLDS):
    """Whether crc32 of the key as text is divisible by ``folds``; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))


def _words(text: str = "text"):
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda x: x != ""))


def without_copies(sample: DataFrame) -> DataFrame:
    """One row for each (toxic, text) of ``sample``, texts being copies if they are equal but for case and white space: the one of
    the smallest hash. Adds ``sig``, a hash of the text so normalised, and ``kin``, which near copies nearly always share: two least hashes of its words."""
    least = lambda seed: F.array_min(F.transform("w", lambda x: F.xxhash64(x, F.lit(seed))))
    marked = sample.withColumn("sig", F.xxhash64(F.trim(F.regexp_replace(F.lower("text"), r"\s+", " "))))
    one = marked.groupBy("toxic", "sig").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.withColumn("w", _words()).withColumn("kin", F.xxhash64(least(1), least(2))).drop("w")


def lexicon(sample: DataFrame, clean: int, toxic: int) -> tuple[frozenset[str], frozenset[str]]:
    """Words, and stems of ``STEM`` letters of longer words, that mark toxic texts: log odds over 3.5 standard errors, at
    least 4 documents, 5 times as often. sample: texts without copies, of which ``clean`` and ``toxic`` are so labelled. As each
    word marks 4 texts or more, the sample bounds their number."""
    words = _words()
    stems = F.array_distinct(F.transform(F.filter(words, lambda x: F.length(x) > STEM), lambda x: F.substring(x, 1, STEM)))
    of = lambda kind, found: F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("word")))
    seen = sample.select("toxic", F.explode(F.concat(of("word", words), of("stem", stems))).alias("x")).groupBy("x").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (toxic - a + 0.5)) - F.log((b + 0.5) / (clean - b + 0.5))
    z = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    often = (a >= 4) & (a * clean >= 5 * (b + 0.5) * toxic)
    found = seen.where(often & (z > 3.5)).select("x.*").collect()
    return tuple(frozenset(r.word for r in found if r.kind == kind) for kind in ("word", "stem"))


def with_features(docs: DataFrame, text: str, words: frozenset[str], stems: frozenset[str]) -> DataFrame:
    """The columns of ``docs`` but the text, and _features array<double>."""
    return map_texts(docs, text, lambda: lambda x: [(features(x, words, stems),)], "_features array<double>")


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", target: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Rows (key, _th long: xxhash64 of the text, _held_out boolean, _score double, _predicted int), learned from the labels of rows not held out."""
    known = labels.where(F.col(key).isNotNull() & F.col(target).isNotNull()).where(~held_out(key)).groupBy(key).agg(F.max(F.col(target).cast("int")).alias("toxic"))
    # At most ``sample`` ids, by hash order; so few that they may be broadcast.
    known = known.orderBy(F.xxhash64(key), key).limit(sample)
    texts = docs.select(F.col(key), F.coalesce(text, F.lit("")).alias("text"))
    taught = without_copies(texts.join(F.broadcast(known), key).select("toxic", "text"))
    # Near copies are in one fold, so that the calibration does not see what the trees learned from.
    taught = staged(taught.withColumn("fold", F.pmod(F.col("kin"), F.lit(5))).drop("kin"), "taught")
    counts = {(r.toxic, r.spare): r.n for r in taught.groupBy("toxic", (F.col("fold") == 0).alias("spare")).agg(F.count("*").alias("n")).collect()}
    clean, toxic = (sum(n for (t, _), n in counts.items() if t == kind) for kind in (0, 1))
    base = docs.select(F.col(key), F.xxhash64(text).alias("_th"), held_out(key).alias("_held_out"), F.col(text).alias("text"))
    if not clean or not toxic:
        flat = float(toxic > 0)
        return base.select(key, "_th", "_held_out", F.lit(flat).alias("_score"), F.lit(int(flat)).alias("_predicted"))
    words, stems = lexicon(taught, clean, toxic)
    rows = staged(with_features(taught, "text", words, stems).select("toxic", "fold", array_to_vector("_features").alias("features")).coalesce(6), "features")
    both = lambda spare: (0, spare) in counts and (1, spare) in counts
    fit, spare = rows.where("fold > 0") if both(False) else rows, rows.where("fold = 0") if both(True) else rows
    trees = GBTClassifier(labelCol="toxic", maxIter=12, maxDepth=4, maxBins=32, stepSize=0.3, seed=1, checkpointInterval=-1).fit(fit)
    raw = lambda df: trees.transform(df).withColumn("raw", F.element_at(vector_to_array("probability"), 2))
    curve = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="level").fit(raw(spare).select("raw", F.col("toxic").cast("double").alias("toxic")))
    seen = with_features(base, "text", words, stems).withColumn("features", array_to_vector("_features"))
    # A thousandth of the trees' own probability keeps the order within the calibration's steps.
    level = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.999 * F.col("level") + 0.001 * F.col("raw")))
    done = curve.transform(raw(seen)).select(key, "_th", "_held_out", level.alias("_score"))
    return done.withColumn("_predicted", (F.col("_score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not predicted to be toxic; columns as given. Rows with the same key and text share the verdict."""
    found = score(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), labels.select(F.col(key).alias("key"), "toxic"), "key", "text")
    bad = found.where("_predicted = 1").select(F.col("key").alias("k"), "_th").distinct()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.struct("*").alias("row"))
    return rows.join(bad, rows["key"].eqNullSafe(bad["k"]) & (rows["th"] == bad["_th"]), "left_anti").select("row.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", F.col("_held_out").alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))
