"""Archives with shared contents, read by ranges, and trees of tiles merged by kind."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import color
from gridloom.operators import tiles
from gridloom.operators.staging import per_group
from gridloom.sources import files, parts, sinks


def tiles_of(spark, content):
    return spark.createDataFrame([(z, x, y, bytes(c)) for (z, x, y), c in content.items()], "z int, tx int, ty int, content binary").repartition(3)


@pytest.mark.parametrize("leaf", [4, 4096])
def test_equal_tiles_are_stored_once(spark, tmp_path, leaf):
    content = {(z, x, y): b"ocean" if (x + y) % 5 else b"land %d %d %d" % (z, x, y) for z in (3, 4) for x in range(2**z) for y in range(2**z) if x < 11}
    made = sinks.shared_pmtiles(tiles_of(spark, content), {"name": "x"}, leaf=leaf)
    rows = made.collect()
    assert sum(r.kind == -1 for r in rows) == len(set(content.values()))
    parts.write_files(made.select(F.lit("a.pmtiles").alias("path"), "kind", F.col("sub").alias("level"), "content"), str(tmp_path)).collect()
    raw = (tmp_path / "a.pmtiles").read_bytes()
    _, _, _, _, _, leaves, data_at, data, n, entries, contents = struct.unpack_from("<11Q", raw, 8)
    assert (n, contents, data) == (len(content), len(set(content.values())), sum(map(len, set(content.values())))) and entries < n and data_at + data == len(raw)
    # Runs hold the ids of tiles of one content, each tile once.
    at = {}
    ids = {(r.z, r.tx, r.ty): r.id for r in tiles_of(spark, content).select("z", "tx", "ty", sinks.hilbert_id("z", "tx", "ty").alias("id")).collect()}
    for r in rows:
        if r.kind == -2:
            for first, offset, length, run in files.read_directory(r.content):
                at |= {first + k: raw[data_at + offset : data_at + offset + length] for k in range(run)}
    assert at == {ids[k]: v for k, v in content.items()}
    # The reader finds these and no others.
    asked = [(z, x, y) for z in (2, 3, 4, 5) for x in range(2**z) for y in range(min(4, 2**z))]
    got = files.pmtiles(spark.createDataFrame(asked, "z int, tx int, ty int"), str(tmp_path / "a.pmtiles")).collect()
    assert {(r.z, r.tx, r.ty): bytes(r.content) for r in got} == {k: content[k] for k in asked if k in content} and len(got) == len({k for k in asked if k in content})


def test_empty_archives_and_other_files(spark, tmp_path):
    none = tiles_of(spark, {(1, 0, 0): b"x"}).limit(0)
    made = sinks.shared_pmtiles(none, {})
    assert [r.kind for r in made.orderBy("kind", "sub").collect()] == [-3, -3, -3]
    parts.write_files(made.select(F.lit("e.pmtiles").alias("path"), "kind", F.col("sub").alias("level"), "content"), str(tmp_path)).collect()
    assert files.pmtiles(tiles_of(spark, {(1, 0, 0): b""}), str(tmp_path / "e.pmtiles")).count() == 0
    (tmp_path / "no").write_bytes(b"something else, of some length" * 9)
    with pytest.raises(ValueError):
        files.pmtiles(none, str(tmp_path / "no"))


def test_over_on_bytes_equals_columns(spark):
    rnd = np.random.default_rng(5)
    a, b = rnd.integers(0, 256, (2, 40, 50, 4)).astype(np.uint8)
    a[:5, :, 3], b[3:9, :, 3], b[20:, :, 3] = 0, 0, 255
    rows = [(i, *map(int, x), *map(int, y)) for i, (x, y) in enumerate(zip(a.reshape(-1, 4), b.reshape(-1, 4), strict=True))]
    df = spark.createDataFrame(rows, "i int, a0 int, a1 int, a2 int, a3 int, b0 int, b1 int, b2 int, b3 int")
    mixed = color.over([F.col(f"a{k}") for k in range(4)], [F.col(f"b{k}") for k in range(4)])
    want = np.array([r[1:] for r in sorted(df.select("i", *(c.alias(f"c{k}") for k, c in enumerate(mixed))).collect())])
    assert np.array_equal(tiles.over_bytes(a, b).reshape(-1, 4), want)


def test_trees_are_merged_by_kind(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    clear = lambda: rnd.integers(0, 256, (4, 4, 4)).astype(np.uint8)
    solid = lambda: rnd.integers(0, 256, (4, 4, 3)).astype(np.uint8)
    nothing = np.zeros((4, 4, 4), np.uint8)
    stacks = {0: {0: solid()}, 1: {0: solid(), 2: solid()}, 2: {0: solid(), 1: clear()}, 3: {0: clear(), 1: solid(), 2: clear(), 5: clear()}, 4: {1: clear(), 2: clear()}, 5: {3: clear()}, 6: {0: nothing, 1: nothing}, 7: {0: clear(), 4: solid()}}
    rows = [(layer, 2, x, 0, sinks.png_bytes(image)) for x, stack in stacks.items() for layer, image in stack.items()]
    got = {r.tx: r for r in tiles.merge_trees(spark.createDataFrame(rows, "layer int, z int, tx int, ty int, content binary").repartition(3)).collect()}
    assert {x: got[x].decoded for x in got} == {0: False, 1: False, 2: True, 3: True, 4: True, 5: False, 7: False}  # 6 shows nothing
    assert bytes(got[1].content) == sinks.png_bytes(stacks[1][2]) and bytes(got[7].content) == sinks.png_bytes(stacks[7][4]) and bytes(got[5].content) == sinks.png_bytes(stacks[5][3])
    for x in (2, 3, 4):
        now = np.zeros((4, 4, 4), np.uint8)
        for _, image in sorted(stacks[x].items()):
            now = tiles.over_bytes(now, image if image.shape[2] == 4 else np.concatenate([image, np.full((4, 4, 1), 255, np.uint8)], 2))
        assert np.array_equal(files.png_rows(bytes(got[x].content)), now if (now[..., 3] < 255).any() else now[..., :3])


def test_files_are_whole_or_not_there(spark, tmp_path):
    inside = spark.createDataFrame([("3/1/2.png", b"x"), ("3/1/1.png", b"yy")], "path string, content binary")
    assert sorted(map(tuple, parts.write_files(inside, f"file://{tmp_path}/tree").collect())) == [("3/1/1.png", 2), ("3/1/2.png", 1)]
    assert sorted(str(x.relative_to(tmp_path / "tree")) for x in (tmp_path / "tree").rglob("*") if x.is_file()) == ["3/1/1.png", "3/1/2.png"]
    rows = [(f"f{i % 3}", i // 3, 0, 0, 0, bytes([i]) * 1000) for i in range(30)]
    df = spark.createDataFrame(rows, parts.PART).repartition(7)
    done = {r.path: r.bytes for r in parts.write_files(df, str(tmp_path / "out")).collect()}
    again = {r.path: r.bytes for r in parts.write_files(df, f"file://{tmp_path}/out").collect()}
    assert done == again == {f"f{k}": 10_000 for k in range(3)} and sorted(x.name for x in (tmp_path / "out").iterdir()) == ["f0", "f1", "f2"]
    assert (tmp_path / "out/f1").read_bytes() == b"".join(bytes([i]) * 1000 for i in range(1, 30, 3))


def test_small_groups_share_calls(spark):
    rows = [(k, i, float(k * 100 + i)) for k in range(40) for i in range(1 + k * 7 % 30)]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        make = lambda t: (t["k"][0], len(t["i"]), t["v"].sum()) if t["k"][0] % 5 else None
        got = sorted(tuple(r) for r in per_group(df, ["k"], make, "k int, n long, total double").collect())
        assert per_group(df.where("k < 0"), ["k"], make, "k int, n long, total double").count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    own = {k: [v for q, _, v in rows if q == k] for k in range(40) if k % 5}
    assert got == [(k, len(v), sum(v)) for k, v in own.items()]
    # No writer calls Python once a tile.
    t = spark.createDataFrame([(1, x, 0, r, c, 1, 2, 3, 255) for x in range(2) for r in range(2) for c in range(2)], "z int, tx int, ty int, row int, col int, r int, g int, b int, a int")
    for df in (sinks.png_tiles(t, 2), sinks.mbtiles_chunks(sinks.png_tiles(t, 2), {}), sinks.geotiffs(t, "tx", "r", "z", 0.0, 1.0)):
        assert "FlatMapGroups" not in df._jdf.queryExecution().executedPlan().toString() and df.count() > 0
    assert files.png_pixels(sinks.png_tiles(t, 2)).exceptAll(t).count() == 0
