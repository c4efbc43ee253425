"""Encoding, repeats, licences, SimHash and packing against plain versions on small fixtures."""

import base64
import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from gridloom.llm import bpe, license_rules, packing, simhash, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, th long"


def words(rnd, n):
    return " ".join("".join(rnd.choice("abdeimnorstu") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def corpus():
    rnd = random.Random(3)
    shared, long_ = words(rnd, 120), words(rnd, 9000)
    docs = [words(rnd, rnd.randint(5, 200)) for _ in range(12)]
    docs += [docs[0], docs[0], words(rnd, 40) + " " + shared + " " + words(rnd, 30), shared, words(rnd, 10) + shared[:420] + words(rnd, 20) + shared[-450:]]
    docs += [None, "", " \n\t", "one", "two words", "é" * 700, "a" * 1500, "Grüße 😀 " * 120, long_, long_[5000:9000] + words(rnd, 50)]
    rows = [(i, t, "en", "s", 0, "clash", 1) for i, t in enumerate(docs)]
    return [*rows, (None, docs[1], None, None, None, None, None), (3, docs[3], "en", "s", 0, "clash", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


def oracle():
    with open(bpe.vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_the_library():
    enc, own, rnd = oracle(), bpe.codec(bpe.vocabulary()), random.Random(0)
    for kind in ("ab", "the ing", "aeiou \n\t", "éüñß €中😀", "01 .,!", "\x1c\x85\u180e\xa0 a", "<|endoftext|>"):
        for _ in range(300):
            text = "".join(rnd.choice(kind) for _ in range(rnd.randint(0, 60)))
            ids = own.encode(text)
            assert ids == enc.encode_ordinary(text)
            assert own.decode(ids) == text
    for word in (b"a" * 20000, b"ab" * 5000, b" " * 9000, bytes(rnd.randrange(256) for _ in range(9000))):
        assert own.fst.encode(word) == enc._encode_single_piece(word)


def test_texts_are_split_alike_by_both_matchers():
    own, rnd = bpe.codec(bpe.vocabulary()), random.Random(4)
    near = [chr(c) for c in range(bpe.NEAR + 1)]
    for kinds in (near, [*" '\t\n\r\x0b\x0c\x1c\x1f\x85\xa0", *"stmdrevl'abÉß²½ªº1!"], list(" 's't're")):
        for _ in range(3000):
            text = "".join(rnd.choice(kinds) for _ in range(rnd.randint(0, 30)))
            assert own.near.findall(text) == own.split(text)
    assert own.far("a\u0250") and not own.far("\u024f")


def test_decoder_holds_split_characters_and_replaces_bad_ones():
    own = bpe.codec(bpe.vocabulary())
    ids = [own.fst.ranks[bytes([b])] for b in "😀".encode()]
    pieces = list(own.utf8.decode(ids))
    assert pieces == ["", "", "", "😀"]
    rnd = random.Random(1)
    for _ in range(500):
        data = bytes(rnd.choice((0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0xF0, 0x90, 0xF4, 0x8F, 0xFF)) for _ in range(8))
        assert own.decode([own.fst.ranks[bytes([b])] for b in data]) == data.decode("utf-8", "replace")


def test_encode_and_decode_frames(docs):
    enc = oracle()
    tokens = bpe.encode(docs)
    got = {(r.doc_id, tuple(r.ids)) for r in tokens.collect()}
    assert got == {(r[0], tuple(enc.encode_ordinary(r[1] or ""))) for r in corpus()}
    back = sorted((str(r.doc_id), r.text) for r in bpe.decode(tokens).collect())
    assert back == sorted((str(r[0]), r[1] or "") for r in corpus())
    for r in bpe.round_trip(docs).collect():
        text = next(x[1] or "" for x in corpus() if x[0] == r.doc_id)
        ids = enc.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def repeats(rows, length):
    seen = {}
    for _, t, *_ in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for k, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = True
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes() if len(b) else b""
        out.append((str(k), len(b), int(gone.sum()), runs, kept))
    return sorted(out)


def test_index_finds_the_longest_match_elsewhere():
    rnd = random.Random(5)
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    for trial in range(60):
        strings = [bytes(rnd.choice(b"ab\0c"[: 2 + trial % 3]) for _ in range(rnd.randint(1, 25))) for _ in range(rnd.randint(1, 5))]
        at = [(i, j) for i, x in enumerate(strings) for j in range(len(x))]
        index = suffix_dedup.RunIndex.of(strings)
        got = index.matching_statistics()
        for _ in range(10):
            pattern = bytes(rnd.choice(b"ab\0c") for _ in range(rnd.randint(1, 4)))
            assert index.occurrences(pattern) == sum(s.startswith(pattern, k) for s in strings for k in range(len(s)))
        for i, j in at:
            assert got[i][j] == max((common(strings[i][j:], strings[p][q:]) for p, q in at if (p, q) != (i, j)), default=0)


@pytest.mark.parametrize("hot", [2048, 2])
def test_repeats_equal_brute_force(docs, hot):
    got = suffix_dedup.remove_repeats(docs, hot=hot)
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = sorted((str(r.doc_id), r._n_bytes, r._n_removed, r._n_spans, bytes(r._kept)) for r in got.collect())
    assert rows == repeats(corpus(), suffix_dedup.LENGTH)


def test_planted_passages_are_told_by_n_removed(spark, tmp_path):
    """The query's columns: n_bytes is the whole text's, whatever goes; passages under 400 bytes stay, repeats within a text go."""
    rnd = random.Random(12)
    long_, short, own = words(rnd, 90), words(rnd, 52), words(rnd, 90)
    assert len(long_) > 400 > len(short)
    around = lambda x: f"{words(rnd, 20)}\n{x}\t{words(rnd, 20)}"
    texts = [around(long_), around(long_), around(short), around(short), around(f"{own} - {own}"), words(rnd, 200)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(suffix_dedup.op2_suffix_dedup(spark, str(tmp_path)).collect())
    want = [(int(k), n, gone, runs, hashlib.sha256(kept).hexdigest()) for k, n, gone, runs, kept in repeats(rows, 400)]
    assert [tuple(r) for r in got] == want and [r.n_bytes for r in got] == [len(t) for t in texts]
    assert [r.n_removed > 0 for r in got] == [True, True, False, False, True, False]


def test_repetitive_strings_have_few_runs():
    rnd = random.Random(6)
    base = words(rnd, 300).encode()
    copies = [base[: 50 * k] + b"x%d" % k + base[50 * k :] for k in range(30)]
    index = suffix_dedup.RunIndex.of(copies)
    assert len(index.lengths) < 0.1 * sum(map(len, copies)) and int(index.lengths.sum()) == sum(map(len, copies)) + 30
    assert suffix_dedup.RunIndex.of([b"", b"a", b""]).matching_statistics()[1].tolist() == [0]


def test_repeats_with_short_strings(docs):
    rows = sorted((str(r.doc_id), r._n_bytes, r._n_removed, r._n_spans, bytes(r._kept)) for r in suffix_dedup.remove_repeats(docs, length=50, gram=16, hot=3).collect())
    assert rows == repeats(corpus(), 50)


def test_only_runs_of_many_words_go(docs):
    passage = {"length": 224, "gram": 32, "over_words": 50}
    rows = corpus()
    seen = {}
    for _, t, *_ in rows:
        b = (t or "").encode()
        for s in range(len(b) - 223):
            seen[b[s : s + 224]] = seen.get(b[s : s + 224], 0) + 1
    want, some = [], 0
    for k, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int8)
        for s in range(len(b) - 223):
            if seen[b[s : s + 224]] > 1:
                gone[s : s + 224] = 1
        at = np.flatnonzero(np.diff(np.r_[0, gone]))
        for a, z in zip(at[::2], at[1::2]):
            if len(b[a:z].split()) <= 50:
                gone[a:z] = 0
                some += 1
        want.append((str(k), None if t is None else np.frombuffer(b, np.uint8)[gone[:-1] == 0].tobytes().decode("utf-8", "replace") if b else ""))
    assert some and any(x and len(x) < len(t or "") for (_, x), (_, t, *_) in zip(want, rows))
    got = suffix_dedup.without_repeats(docs, **passage)
    assert got.columns == docs.columns
    got = got.collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(want, key=lambda x: (x[0], x[1] or ""))
    assert all((r.th, r.n_chars) == (1, None if r.text is None else len(r.text)) for r in got if r.doc_id is not None)


def test_names_of_other_columns_meet_none_inside(spark):
    rows = [(i, "the same text of many words " * 40, *range(8)) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _x long, _data long, runs long, key long, row long, cuts long, th long, data long")
    got = suffix_dedup.remove_repeats(frame)
    assert got.columns == [*frame.columns, "_n_bytes", "_n_removed", "_n_spans", "_kept"]
    assert {tuple(r[2:10]) for r in got.collect()} == {tuple(range(8))}
    cut = suffix_dedup.without_repeats(frame)
    assert cut.columns == frame.columns and {tuple(r)[1:] for r in cut.collect()} == {("", *range(8))}
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(frame.withColumnRenamed("_x", "_kept"))


def test_pieces_of_long_texts_meet(spark, monkeypatch):
    rnd = random.Random(9)
    text = words(rnd, 400)
    raw = text.encode()
    whole = list(suffix_dedup.seeds(raw))
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    cut = list(suffix_dedup.seeds(raw))
    assert sorted({p for _, _, p, _ in whole}) == sorted({p for _, _, p, _ in cut})
    assert [w for a, b, *_ in cut for w in range(a, b + 1)] == list(range(len(raw) - suffix_dedup.LENGTH + 1))


def simhash_plain(text, n=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + n]).encode(), 42) for i in range(max(1, len(ws) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs):
    rows = corpus()
    fps = {(r[0], r[1]): simhash_plain(r[1]) for r in rows}
    root = {f: f for f in fps.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    values = list(root)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for (k, _), f in fps.items():
        if k is not None:
            least[find(f)] = min(least.get(find(f), k), k)
    want = sorted((str(k), f"{fps[k, t]:016x}", least.get(find(fps[k, t]))) for k, t, *_ in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()) == want


def test_simhash_links_are_complete(spark):
    rnd = random.Random(2)
    fps = set()
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(6):
            x = base
            for bit in rnd.sample(range(64), rnd.choice((1, 2, 3, 4))):
                x ^= 1 << bit
            fps.add(x - (1 << 63))
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")

    def groups(edges):
        root = {f: f for f in fps}

        def find(f):
            while root[f] != f:
                f = root[f]
            return f

        for a, b in edges:
            root[find(a)] = find(b)
        return {frozenset(g for g in fps if find(g) == find(f)) for f in fps}

    want = groups([(a, b) for a in fps for b in fps if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])
    for block in (2048, 2):
        assert groups([tuple(r) for r in simhash.links(frame, block=block).collect()]) == want


def test_keep_one_drops_texts_of_similarity_and_no_others(spark):
    rnd = random.Random(8)
    texts = []
    for i in range(24):
        base = words(rnd, 60 + 20 * i).split()
        texts.append(base)
        for every in (150, 60, 40, 14):  # one word replaced in so many: above and below 0.8
            texts.append([words(rnd, 1) if n % every == 7 else w for n, w in enumerate(base)])
    texts += [texts[0], [*texts[5], "end"], ["x", *texts[10][:20]]]
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    want = {find(i) for i in range(len(texts))}
    assert 40 < len(want) < 80
    frame = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(frame).collect()} == want


def test_segments_that_differ_in_one_symbol_share_a_variant():
    rnd = np.random.default_rng(0)
    missed = met = 0
    for _ in range(400):
        words_ = rnd.integers(0, 1 << 63, 220, np.uint64)
        a, b = np.unique(words_[:190]), np.unique(words_[20:210])  # 170 of 210 in common: 0.81
        x, y = simhash.variant_keys(a), simhash.variant_keys(b)
        least = lambda s: ((s[:, None] ^ simhash.MASKS) * simhash.FACTORS).min(0).reshape(simhash.SEGMENTS, simhash.SYMBOLS)
        near = ((least(a) != least(b)).sum(1) <= 1).any()
        assert near == bool((x == y).any())
        missed += not near
        met += bool((simhash.variant_keys(np.unique(words_[:100])) == simhash.variant_keys(np.unique(words_[100:200]))).any())
    assert missed <= 1 and met == 0


def test_links_across_a_common_variant_equal_all_pairs(spark):
    rnd = random.Random(5)
    base = rnd.sample(range(1 << 40), 60)
    sets = [set(base)]
    for i in range(70):  # most are like the base, few like each other; some are like nothing
        sets.append({*rnd.sample(base, rnd.choice((50, 55, 57, 30))), *rnd.sample(range(1 << 40), rnd.choice((1, 4, 7)))})
    sigs = [10 * i for i in range(len(sets))]
    root = {x: x for x in sigs}

    def groups(edges, known):
        of = dict(known)

        def find(x):
            while of[x] != x:
                x = of[x]
            return x

        for x, y in edges:
            p, q = sorted((find(x), find(y)))
            of[q] = p
        return {x: find(x) for x in of}

    like = [(sigs[i], sigs[j]) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    some = groups(like[::9], root)
    held = spark.createDataFrame([(x, np.sort(np.array(list(own), np.uint64)).tobytes()) for x, own in zip(sigs, sets)], "sig long, own binary")
    for known in (root, some):
        rows = spark.createDataFrame([(1, x, len(own), known[x]) for x, own in zip(sigs, sets)], "variant long, sig long, size int, root long")
        for block, room in ((2048, 1 << 20), (9, 1 << 20), (2048, 700)):
            edges = [tuple(r) for r in simhash.cross_links(rows, held, block, room).collect()]
            assert groups(edges, known) == groups(like, root) and (block < 2048 or room < 1000 or len(edges) < len(sets))


def test_stages_keep_columns_of_any_name(spark):
    rows = [(1, "some text of five words", *range(6)), (2, "some text of five words", *range(6)), (3, None, *range(6))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key long, th long, row long, _own long, _th long, k long")
    assert sorted(map(tuple, simhash.keep_one(frame).collect())) == [rows[0], rows[2]]
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.drop_toxic(frame, labels)
    assert got.columns == frame.columns and sorted(map(tuple, got.collect())) == rows


def test_keep_one_keeps_the_columns(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(None, "a lone text without a key"), (None, "another one that has none either"), (5, "five five five"), (5, "another text of the same key"), (5, "five five five"), (None, "five five five"), (9, None), (8, "")]
    few = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, simhash.keep_one(few).collect())) == sorted(f"Row(doc_id={k}, text={t!r})" for k, t in [*rows[:4], rows[7]])
    keys = [r.doc_id for r in kept.collect()]
    assert len(keys) == len(set(keys)) and 0 in keys and 12 not in keys and 13 not in keys


def test_packing_is_whole_and_gapless(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack_documents(docs).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for k, text in {r[0]: r[1] for r in corpus()}.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[k]})
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        assert mine == [(i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(seqs) <= -(-sum(r.length for r in rows) // 1024) + 2


def test_both_libraries_give_the_same_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t, own, rnd = Tokenizer.from_file(path), packing.tokenizer(path), random.Random(6)
    texts = ["".join(rnd.choice(kind) for _ in range(rnd.randint(0, 80))) for kind in ("ab", "the ing\n\t ", "éüñß €中😀", "01 .,!'s", "\x1c\x85\u180e\xa0 a\0") for _ in range(200)]
    texts += [x[1] or "" for x in corpus()] + ["<|endoftext|> a", "a  <|endoftext|>  b<|endoftext|>", " " * 3000, "x" * 1_000_005]
    white = " \t\n\r\x0b\x0c\x85\xa0\u2003\u3000"
    for run in (" " * 999, " " * 1000, " " * 1001, "\n" * 4000, "".join(rnd.choice(white) for _ in range(5000)), " " * 1_300_000):
        texts += [run, run + "x", run + "\n", "x" + run, "a." + run + "b " + run + "'s", run + "<|endoftext|>" + run + "7", "\x1c" + run + "\x1c" + run + "é"]
    assert [own(x) for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))("Two words") == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Two words", add_special_tokens=False).ids


def test_plans_fit_and_lose_nothing():
    rnd = random.Random(4)
    for n, top, groups in ((1, 1024, 256), (300, 1024, 256), (2000, 1024, 512), (500, 130, 4), (40, 1024, 3)):
        histogram = {}
        for _ in range(n):
            x = rnd.randint(1, top)
            histogram[x] = histogram.get(x, 0) + 1
        used, seen = {}, set()
        for length, first, count, each, seq in packing.plan(histogram, groups=groups):
            for i in range(count):
                seen.add((length, first + i))
                used[seq + i // each] = used.get(seq + i // each, 0) + length
        assert seen == {(x, i) for x, c in histogram.items() for i in range(c)} and max(used.values()) <= 1024
        if groups >= 256 and n > 200:
            assert len(used) <= 1.06 * -(-sum(x * c for x, c in histogram.items()) // 1024) + 1


def wrapped(text, leader, width=60):
    """A text as it stands in the head of a source file."""
    out = []
    for part in text.split("\n\n"):
        out += [f"{leader} {line}".rstrip() for line in textwrap.wrap(part, width)] + [leader.rstrip()]
    return "\n".join(out)


def plain_scan(text):
    """The licences of a text, by the words of the definition."""
    names, taken = [], []
    for s in license_rules.normalised(text or ""):
        held = {w: n for w, n in license_rules.SENTENCES.items() if f" {w} " in f" {s} "}
        names += sorted(n for w, n in held.items() if not any(o != w and f" {w} " in f" {o} " for o in held))
    seq = list(names)
    for licence, want in license_rules.RULES:
        i = 0
        while i + len(want) <= len(seq):
            if tuple(seq[i : i + len(want)]) == want:
                taken.append(licence)
                seq[i : i + len(want)] = ["|"]
            i += 1
    return tuple(names), tuple(sorted(set(taken))), sum(x != "|" for x in seq)


def test_licences(spark):
    rnd = random.Random(2)
    texts = [
        ("Hello. Released under the MIT License. Bye.", "MIT"), ("Licensed under the Apache License, Version 2.0.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"), ("This text is licensed under the MIT License.", "MIT"),
        (None, ""), ("", ""), ("released under the mit licensee", ""), ("You may obtain a copy of the License at", ""), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("All rights reserved.", ""),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"), ("Licensed under the GNU General Public License, version 3 or later", "GPL-3.0-or-later"), ("# SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0-or-later"),
        ("Dual licensed under the MIT License or distributed under the Apache License, Version 2.0 at your option.", "Apache-2.0 MIT"), ("no end\nreleased under the MIT License\nand on", "MIT"), ("x" * 300_000 + " licensed under the ISC License " + "y. " * 50_000, "ISC"),
    ]
    bsd = license_rules.TEXTS["BSD-3-Clause"].replace("the copyright holder nor", "Google Inc. nor").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE REGENTS AND CONTRIBUTORS").replace("THE COPYRIGHT HOLDER OR", "THE REGENTS OR")
    assert bsd != license_rules.TEXTS["BSD-3-Clause"]
    texts += [
        (bsd, "BSD-3-Clause"), (bsd.split("\n\n")[0], ""), ("This is released under the GPLv2 or later.", "GPL-2.0-or-later"), ("Released under the GPLv2+.", "GPL-2.0-or-later"), ("Released under GPLv2.", "GPL-2.0-only"),
        ("licensed under the LGPLv2.1+ by us", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: GPL-3.0+", "GPL-3.0-or-later"), ("This is not licensed under the MIT License.", ""), ("It was never released under the terms of the MIT License!", ""),
        ("Licensed under the GNU General Public License, version 2, or (at your option) any later version.", "GPL-2.0-or-later"), ("one licensed " * 40_000 + "under the MIT License", "MIT"),
    ]
    for name, text in license_rules.TEXTS.items():
        texts.append((text, name))
        for leader in ("#", " *", "//", ";;", ""):
            texts.append((f"Copyright (c) 2020 Someone\n{leader}\n{wrapped(text, leader, rnd.randint(40, 90))}\n{leader}\nint main;", name))
    rows = [(i if i % 7 else 7, t, "clash", 0) for i, (t, _) in enumerate(texts)]
    got = license_rules.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string, fold string, sentence_ids int")).collect()
    assert sorted(str((r.doc_id, tuple(r.sentence_ids), tuple(r.licenses), r.unmatched)) for r in got) == sorted(str((k, *plain_scan(t))) for k, t, *_ in rows)
    for text, want in texts:
        found = plain_scan(text)[1]
        assert " ".join(found) == want, (text, found)
    header = wrapped(license_rules.TEXTS["Apache-2.0"].replace("License at\n\n", "License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"), " *")
    assert plain_scan(header)[1:] == (("Apache-2.0",), 0)


def test_large_ids_beside_nulls_stay_whole(spark):
    big = (1 << 62) + 1
    text = words(random.Random(1), 90)
    rows = [(big, text), (None, text), (big + 2, "some other text of no interest"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    keys = sorted((str(r[0]) for r in rows))
    ids = lambda df: sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    tokens = bpe.encode(docs)
    assert ids(tokens) == ids(bpe.decode(tokens)) == ids(bpe.round_trip(docs)) == keys
    assert ids(packing.pack_documents(docs)) == ids(simhash.near_duplicates(docs)) == keys
    got = {str(r.doc_id): r._n_removed for r in suffix_dedup.remove_repeats(docs).where("text is not null").collect()}
    assert got == {str(big): len(text), "None": len(text), str(big + 2): 0}
    assert {r.component_id for r in simhash.near_duplicates(docs).where(F.col("fingerprint") != "0" * 16).collect()} == {big, big + 2}
    assert ids(simhash.keep_one(docs.where("text is not null"))) == [str(big), str(big + 2)]
    labels = spark.createDataFrame([(big, 0, 0), (big + 2, 0, 0)], "doc_id long, quality int, toxic int")
    assert ids(toxicity.score(docs, labels)) == ids(toxicity.drop_toxic(docs, labels)) == keys


def test_the_plan_of_fewest_sequences_is_taken(spark):
    rnd = random.Random(9)
    histogram = Counter(rnd.choice((rnd.randint(1, 300), rnd.randint(200, 700), rnd.randint(600, 1024))) for _ in range(20_000))
    best = packing.sequences(packing.fewest(histogram))
    every = [packing.sequences(packing.plan(histogram, groups=g, small=s)) for g in packing.GROUPS for s in packing.SMALL]
    assert best == min(every) < max(every) and best >= -(-sum(x * n for x, n in histogram.items()) // 1024)
    parts = spark.createDataFrame([(i, 0, 0, x, 0) for i, (x, n) in enumerate(histogram.items()) for _ in range(min(n, 3))], "doc_id long, piece int, start long, length long, ids_crc32 long")
    few = Counter({x: min(n, 3) for x, n in histogram.items()})
    assert packing.pack(parts).select("sequence_id").distinct().count() == packing.sequences(packing.fewest(few))


@pytest.mark.parametrize("key", ["_text", "_salt", "_rank", "_before", "text", "key", "salts"])
def test_keys_of_any_name(spark, key):
    docs = spark.createDataFrame([(i, "some words here " * i) for i in range(1, 4)], f"`{key}` long, body string")
    assert sorted(r[key] for r in packing.pack_documents(docs, key, "body").collect()) == [1, 2, 3]
    assert sorted(r[key] for r in bpe.round_trip(docs, key, "body").collect()) == [1, 2, 3]
    assert sorted(r[key] for r in bpe.encode(docs, key, "body").collect()) == [1, 2, 3]


def test_very_long_texts():
    rnd = random.Random(3)
    long_ = " ".join(rnd.choice(("bad", "you", "so", "Ü!", "B4d", "x" * 50)) for _ in range(400_000))
    found = toxicity.features(long_, frozenset({"bad"}), frozenset({"xxxxx"}))
    plain = long_.lower().split()
    assert found[0] == sum(w == "bad" for w in plain) and len(found) == toxicity.WIDTH
    assert simhash.fingerprint(long_) == simhash.fingerprint(long_ + " ") and len(simhash.variant_keys(simhash.shingles(long_))) == 40


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert license_rules.scan_licenses(none).count() == 0
    assert none.select(F.col("doc_id")).count() == 0
