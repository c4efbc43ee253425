"""Distances of sources and collocations against plain counting; the byte network against numbers, planted junk and held-out labels."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridloom.llm import collocations, divergence, quality_cnn, simhash
from gridloom.llm.common import staged, with_hot

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, phrase string, s int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    rnd = random.Random(5)
    words = ["the", "of", "Red", "carpet", "New", "York", "city", "É", "éa", "x1y", "ß", "don't"]
    rows = []
    for i in range(400):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "; ", " New York city "]) for _ in range(rnd.randint(0, 30)))
        rows.append((i, text, rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "c", None, "é"]), "clash", 1, "clash", 2))
    rows += [(500, None, "en", "a", None, None, None, None), (501, "", "xx", "only", None, None, None, None), (502, " \n.,", None, None, None, None, None, None), (503, "ÀÉ Straße", "yy", "p", None, None, None, None), (504, None, "yy", "q", None, None, None, None)]
    return [*rows, rows[3], rows[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


def plain_divergence(rows, least, top):
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    in_docs, n, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = word.findall((text or "").translate(UPPER))
        groups.add((lang, source))
        in_docs[lang].update(set(found))
        n[lang, source].update(found)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, k in in_docs[lang].items() if k >= least]
        own = sorted(s for a, s in groups if a == lang)
        p = {}
        for s in [*own, None]:
            counts = {t: sum(n[lang, x][t] for x in (own if s is None else [s])) for t in kept}
            size = sum(counts.values())
            p[s] = {t: 1 + 10**9 * (k + 5) // (size + 5 * len(kept)) for t, k in counts.items()}
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            more = [(t, p[s][t] - p[None][t]) for t in kept if n[lang, s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", more, top)):
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(100_000, 64, 300_000), (40, 2, 20)])
def test_divergence_equals_plain_counting(docs, monkeypatch, blocks):
    monkeypatch.setattr(divergence, "CELLS", blocks[0])
    monkeypatch.setattr(divergence.tallies, "__defaults__", (blocks[1],))
    monkeypatch.setattr(divergence.counted, "__defaults__", ("lang", "source", "text", blocks[2]))
    for least, top in ((30, 50), (1, 2), (10_000, 5)):
        got = sorted(map(tuple, divergence.divergence(docs, min_docs=least, top=top).collect()))
        assert got == plain_divergence(corpus(), least, top) and got


def test_shares_are_exact_at_any_count(spark):
    rows = [(10**13 + i, 10**15 + 7 * i, 10**9 + i) for i in range(50)] + [(0, 0, 1)]
    found = spark.createDataFrame(rows, "n long, size long, v long").select("n", "size", "v", divergence.share("n", "size", "v").alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r.n + 5) // (r.size + 5 * r.v) for r in found)


def test_terms_of_long_texts_meet():
    text = ("Ab éÉ-c1d " * 3000).encode()
    assert divergence.terms(text) == divergence.terms(text, 7) == Counter({b"ab": 3000, "éÉ".encode(): 3000, b"c": 3000, b"d": 3000})


def plain_collocations(rows, most, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {w: a for w, a in counts.items() if len(w) > 1 and a >= least}
        scored = []
        for w, a in found.items():
            score, k = min((1000 * a * n[lang] // (counts[w[:k]] * counts[w[k:]]), k) for k in range(1, len(w)))
            inside = lambda x: any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))  # noqa: B023, E731
            if not any(len(x) > len(w) and 100 * b >= share * a and inside(x) for x, b in found.items()):
                scored.append((-score, -a, " ".join(w).encode(), counts[w[:k]], counts[w[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits,at_once", [(27, 4 << 20), (6, 50)])
def test_collocations_equal_plain_counting(docs, monkeypatch, bits, at_once):
    monkeypatch.setattr(collocations.exploded, "__defaults__", (False, at_once))
    for most, least, share, top in ((5, 20, 100, 2000), (5, 2, 60, 7), (2, 5, 100, 2000), (3, 1, 100, 50)):
        got = sorted(map(tuple, collocations.collocations(docs, max_words=most, least=least, share=share, top=top, bits=bits).collect()))
        assert got == plain_collocations(corpus(), most, least, share, top) and got


def test_phrases_of_slices_meet():
    text = b"a b c. d e\tf  g h,, i j " * 40
    whole, cut = Counter(), Counter()
    for counts, at_once in ((whole, 4 << 20), (cut, 5)):
        for names, ids, own in collocations.slices(text, 4, at_once):
            for found, n in collocations.phrases(names, ids, own, (1, 2, 3, 4, 5), {}):
                counts.update(dict(zip(found.to_pylist(), n.tolist(), strict=True)))
    assert whole == cut and whole[b"h"] == 40 and whole[b"d e f g h"] == 40 and b"h i" not in whole and whole[b"i j a b c"] == 39 and whole[b""] == 400


def test_bitmap_lets_all_frequent_pass(spark):
    words = [f"w{i}" for i in range(3000)]
    h = lambda found: np.array([xxhash.xxh64_intdigest(w, 42) for w in found], np.uint64)
    bits = collocations.bitmap(spark.createDataFrame([(w,) for w in words], "a string").select(F.xxhash64("a").alias("h")), 16)
    assert collocations.passes(bits, h(words)).all() and collocations.passes(bits, h(f"o{i}" for i in range(3000))).mean() < 0.1


def test_phrases_have_hashes_of_their_own():
    rnd = random.Random(1)
    text = " ".join(rnd.choice("abcdefgh") for _ in range(5000)).encode()
    ((names, ids, own),) = collocations.slices(text, 4)
    for k in (2, 3):
        ((found, n),) = collocations.phrases(names, ids, own, (k,), {})
        ((hashes, m),) = collocations.phrases(names, ids, own, (k,), {}, hashed=True)
        assert n.tolist() == m.tolist() and len(set(hashes.to_pylist())) == len(found) == 8**k and max(hashes.to_pylist()) < 1 << collocations.HASH


def test_statistics_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert divergence.divergence(none).count() == 0 and collocations.collocations(none).count() == 0
    assert quality_cnn.score(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_chunks_cover_all_bytes():
    for n in (0, 1, 64, 65, 511, 512, 513, 960, 961, 5000):
        text = bytes(i % 251 for i in range(n))
        got = quality_cnn.chunks(text)
        flat = bytearray(got[0].tobytes())
        for c in got[1:]:
            assert bytes(flat[-quality_cnn.OVERLAP :]) == c[: quality_cnn.OVERLAP].tobytes()
            flat += c[quality_cnn.OVERLAP :].tobytes()
        assert bytes(flat).rstrip(b"\xff") == text and (n <= 512) == (len(got) == 1)


def test_gradient_and_slabs():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abc |#") for _ in range(n)).encode() for n in (0, 10, 700, 3000)]
    w = quality_cnn.fresh(1)
    w["bytes"][quality_cnn.PAD] = 0
    w["bias"] += np.linspace(-0.2, 0.3, len(w["bias"]), dtype=np.float32)  # away from the answer zero, where there is no slope
    good = np.array([1, 0, 1, 0], np.float32)
    _, g = quality_cnn.gradient(texts, good, w)
    for name in w:
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        up, down = ({n: x.copy() for n, x in w.items()} for _ in range(2))
        up[name][i] += 0.001
        down[name][i] -= 0.001
        slope = (quality_cnn.gradient(texts, good, up)[0] - quality_cnn.gradient(texts, good, down)[0]) / 0.002
        assert abs(slope - g[name][i]) < 0.03 * abs(slope) + 5e-4
    one = np.concatenate([quality_cnn.probability([t], w) for t in texts])
    assert np.allclose(one, quality_cnn.probability(texts, w), atol=1e-5)
    # A plain convolution of the same weights.
    ids = quality_cnn.numbers(np.ascontiguousarray(quality_cnn.chunks(texts[2])))
    x = w["bytes"][ids]
    plain = np.stack([np.einsum("nwd,fwd->nf", x[:, i : i + 8], w["filters"].reshape(-1, 8, 8)) + w["bias"] for i in range(0, 505, 4)], 1)
    assert np.allclose(plain, quality_cnn.answers(ids, w), atol=1e-4)
    back = quality_cnn.unpacked(np.array(quality_cnn.packed(w)))
    assert all((back[n] == w[n]).all() for n in w)


def test_repeats_are_numbered():
    ids = quality_cnn.numbers(np.ascontiguousarray(quality_cnn.chunks(b"abcd wxyz wxyz q" + b"z" * 40)))[0]
    assert (ids[:12] < 256).all() and ids[12] == ord("y") + 256 and ids[13] == ord("z") + 256 and ids[15] < 256 and ids[40] == ord("z") + 256 and (ids[56:] == quality_cnn.PAD).all()


def quality_rows():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abdeinorst") for _ in range(rnd.randint(2, 8)))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(rnd.randint(20, 400))]
        if i % 4 == 0:
            words = [f"{w}{rnd.choice(['###', '$$$'])}" for w in words] if i % 8 else [w for w in words for _ in range(6)]
        rows.append((i, " ".join(words), "en", "s", "clash", 1, "clash", 2))
        labels.append((i, int(i % 4 > 0), "clash"))
    return rows + [(900, None, None, None, None, None, None, None), (901, "", None, None, None, None, None, None), (None, "words", None, None, None, None, None, None), rows[5]], [*labels, (None, 1, ""), (3, None, ""), (4, 1, "")]


def test_quality_is_learned(spark):
    rows, labels = quality_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    got = quality_cnn.score(docs, known).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r._score <= 1 and r._predicted == int(r._score >= 0.3) for r in got)
    assert all(r._held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert by[900]._score == by[901]._score and len({r._score for r in got if r.doc_id == 5}) == 1
    held = [(by[i]._predicted, y) for i, y, _ in labels if i is not None and y is not None and i != 4 and by[i]._held_out]
    assert len(held) > 30 and sum(p == y for p, y in held) >= 0.95 * len(held)
    # Labels of held-out rows teach nothing, nor does a table with one class.
    turned = known.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r._score for r in quality_cnn.score(docs, turned).collect()}
    assert all(abs(again[k] - r._score) < 1e-4 for k, r in by.items())
    assert {r._score for r in quality_cnn.score(docs, known.where("quality = 1")).collect()} == {1.0}


def test_network_is_trained_by_shards(spark):
    rows = [(i % 2, ("good words here " if i % 2 else "### $$$ ### ") * (5 + i % 7) + str(i), i % 4) for i in range(80)]
    w = quality_cnn.fit(spark.createDataFrame(rows, "good int, text string, shard int"), rounds=2, epochs=3)
    p = quality_cnn.probability([t.encode() for _, t, _ in rows], w)
    assert ((p >= 0.5) == np.array([g for g, *_ in rows])).all()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bound", [5, 1000])
def test_hot_keys_join_like_any_other(spark, how, bound):
    rows = spark.createDataFrame([(i % 7 if i % 2 else 0, i) for i in range(200)], "k long, v long")
    small = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("w")).where("k <> 3")
    got = with_hot(rows, small, ["k"], "n", how, bound)
    assert sorted(map(str, got.select("k", "v", "n", "w").collect())) == sorted(map(str, rows.join(small, "k", how).select("k", "v", "n", "w").collect()))


def test_half_of_all_rows_on_one_key_stay_spread(spark):
    """With one key that half of the rows have, no task of the join's result holds more than a few parts of it."""
    rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    small = staged(rows.groupBy("k").agg(F.count("*").alias("n")), "small")
    sizes = [r[0] for r in with_hot(rows, small, ["k"], "n", bound=1000).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 16_000
    assert max(r[0] for r in rows.hint("shuffle_hash").join(small.hint("merge"), "k").groupBy(F.spark_partition_id()).count().select("count").collect()) >= 20_000


@pytest.mark.parametrize("block", [2, 64, 1_000_000])
def test_variants_are_counted_alike_either_way(spark, block):
    rows = [(v, f) for f in range(3000) for v in ({0, f % 5 + 1} if f % 2 else {f + 100, f // 3 + 10_000})]
    got = simhash._counted(spark.createDataFrame(rows, "variant long, fp long").repartition(4), block)
    n = Counter(v for v, _ in rows)
    assert sorted((r.variant, r.fp, r.n) for r in got.select("variant", "fp", "n").collect()) == sorted((v, f, n[v]) for v, f in rows if n[v] > 1)
