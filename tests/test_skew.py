"""Hot keys: the same rows by every strategy, and errors instead of losses."""

import pytest
from pyspark.sql import functions as F

from rastertable.functions import geo
from rastertable.functions.batches import crop_listed, map_rows
from rastertable.grid import Grid
from rastertable.operators import assemble, extract, layout
from rastertable.operators.index import dense_index
from rastertable.operators.joins import join_tiles, measured_broadcast, window_keys
from rastertable.operators.windows import crop_tiles, stitch, window_pieces
from rastertable.sources.scenes import parse_scene_key, source_ordinal

GRID = Grid(0.0, 64.0, 1.0, 1.0, 8, 64, 64)


def full_tiles(spark, n=8, t=8):
    keys = spark.range(n * n).select(
        (F.col("id") % n).cast("int").alias("col"), F.floor(F.col("id") / n).cast("int").alias("row")
    )
    x = lambda k: F.col("col") * t + k % t
    y = lambda k: F.col("row") * t + F.floor(k / t)
    cells = F.transform(F.sequence(F.lit(0), F.lit(t * t - 1)), lambda k: (y(k) * 1000 + x(k)).cast("int"))
    return keys.withColumn("b0", cells)


def hot_windows(spark):
    """A third of 300 windows lies on a single tile."""
    i = F.col("id")
    x0 = F.when(i % 3 == 0, 17).otherwise((i * 37) % 50).cast("bigint")
    y0 = F.when(i % 3 == 0, 18).otherwise((i * 11) % 50).cast("bigint")
    return spark.range(300).select(
        i.alias("window_id"), x0.alias("x0"), y0.alias("y0"), (x0 + 4).alias("x1"), (y0 + 3).alias("y1")
    )


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "salted"])
@pytest.mark.parametrize("hot", [1, 16, 10_000])
def test_join_strategies_agree(spark, strategy, hot):
    tiles = full_tiles(spark)
    joined = join_tiles(window_keys(hot_windows(spark), 8), tiles, "window_id", strategy, hot_key=hot)
    chips = stitch(crop_tiles(joined, 8, ["window_id"]), 8).collect()
    assert len(chips) == 300
    for c in chips:
        want = [y * 1000 + x for y in range(c.y0, c.y1 + 1) for x in range(c.x0, c.x1 + 1)]
        assert c.b0 == want


def test_shuffle_join_beyond_the_broadcast_limit(spark):
    joined = join_tiles(window_keys(hot_windows(spark), 8), full_tiles(spark), "window_id", max_broadcast=10, hot_key=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan.split("_salt")[0]
    assert joined.count() == join_tiles(
        window_keys(hot_windows(spark), 8), full_tiles(spark), "window_id", "broadcast"
    ).count()
    small = spark.range(5)
    assert "broadcast" in measured_broadcast(small, 5)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in measured_broadcast(small, 4)._jdf.queryExecution().analyzed().toString()


def test_salting_deals_out_the_hot_tile(spark):
    joined = join_tiles(window_keys(hot_windows(spark), 8), full_tiles(spark), "window_id", "salted", hot_key=8)
    per_task = joined.select(F.spark_partition_id().alias("p"), "col", "row").where("col = 2 and row = 2")
    assert per_task.select("p").distinct().count() > 1


def test_missing_tiles_become_nodata(spark):
    tiles = full_tiles(spark).where("not (col = 2 and row = 2)")
    windows = spark.createDataFrame([(0, 14, 14, 18, 17), (1, 17, 17, 19, 19)], "window_id int, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    chips = stitch(crop_tiles(join_tiles(window_keys(windows, 8), tiles, "window_id"), 8, ["window_id"]), 8).collect()
    # The second window meets no tile and is skipped; its number stays unused.
    assert [c.window_id for c in chips] == [0]
    want = [None if x >= 16 and y >= 16 else y * 1000 + x for y in range(14, 18) for x in range(14, 19)]
    assert chips[0].b0 == want


def test_oblong_chips_turn(spark):
    from rastertable.operators.augment import orient_chips, orient_pieces
    import numpy as np

    windows = spark.createDataFrame(
        [(n * 4 + v * 2 + h, 5, 6, 18, 13, bool(v), bool(h), n) for n in range(5) for v in (0, 1) for h in (0, 1)],
        "window_id int, x0 bigint, y0 bigint, x1 bigint, y1 bigint, flip_v boolean, flip_h boolean, turns int",
    )
    keep = ["window_id", "flip_v", "flip_h", "turns"]
    pieces = crop_tiles(join_tiles(window_keys(windows, 8), full_tiles(spark), "window_id"), 8, keep)
    a = np.array([[y * 1000 + x for x in range(5, 19)] for y in range(6, 14)])
    turned = {}
    for p in orient_pieces(pieces).collect():
        for k, v in enumerate(p.b0):
            turned.setdefault(p.window_id, {})[(p.py + k // p.w, p.px + k % p.w)] = v
    for c in orient_chips(stitch(pieces, 8)).collect():
        b = a[:, ::-1] if c.flip_v else a
        b = np.rot90(b[::-1] if c.flip_h else b, c.turns)
        assert (c.rows, c.cols) == b.shape and c.b0 == b.ravel().tolist()
        assert turned[c.window_id] == {(y, x): b[y, x] for y in range(c.rows) for x in range(c.cols)}


def test_hot_tile_merges_cell_by_cell(spark):
    """Forty overlapping copies of a block: both merge paths, same layer."""
    blocks = spark.range(40).select(
        F.col("id").alias("ord"), (F.col("id") % 3).alias("x0"), (F.col("id") % 4).alias("y0"),
        F.lit(7).alias("cols"), F.lit(5).alias("rows"),
        F.transform(
            F.sequence(F.lit(0), F.lit(34)),
            lambda k: F.when((k + F.col("id")) % 3 != 0, (F.col("id") * 100 + k).cast("int")),
        ).alias("b0"),
    )
    far = blocks.where("ord < 2").withColumns({"x0": F.col("x0") + 20, "ord": F.col("ord") + 100})
    blocks = blocks.unionByName(far)
    cold = layout.tile_to_layout(blocks, GRID, "ord", fan_in=1000)
    hot = layout.tile_to_layout(blocks, GRID, "ord", fan_in=3)
    assert cold.exceptAll(hot).count() == 0 and hot.exceptAll(cold).count() == 0
    best = {}
    for r in blocks.orderBy("ord").collect():
        for k, v in enumerate(r.b0):
            if v is not None:
                best.setdefault((r.x0 + k % 7, r.y0 + k // 7), v)
    got = {(p.x, p.y): p.b0 for p in layout.tiles_to_pixels(cold.select("col", "row", "b0"), 8).collect()}
    assert got == best


def test_tiling_is_reversible(spark):
    tiles = full_tiles(spark)
    px = layout.tiles_to_pixels(tiles, 8)
    back = layout.pixels_to_tiles(px, 8).select("col", "row", "b0")
    assert back.exceptAll(tiles.select("col", "row", "b0")).count() == 0 and back.count() == 64


@pytest.mark.parametrize("level", [1, 2, 3, 4])
def test_overviews_keep_the_top_left_cell(spark, level):
    """Within a tile (levels 1-3) and across whole tiles (level 4)."""
    f = 2**level
    tiles = full_tiles(spark).where("col <> 3")
    got = layout.tiles_to_pixels(layout.pyramid_level(tiles, 8, level).select("col", "row", "b0"), 8).collect()
    want = {
        (x // f, y // f): y * 1000 + x
        for y in range(0, 64, f) for x in range(0, 64, f) if x // 8 != 3
    }
    assert {(p.x, p.y): p.b0 for p in got} == want


def test_dense_index_spans_buckets(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id") * 7).alias("z")).repartition(5)
    got = dense_index(df, "z", bits=3).collect()
    assert [r.idx for r in sorted(got, key=lambda r: r.z)] == list(range(1000))


def test_polygons_against_brute_force(spark):
    rings = [[[3.0, 5.0], [50.0, 9.0], [44.0, 60.0], [21.0, 30.0], [3.0, 5.0]], [[30.0, 20.0], [36.0, 20.0], [36.0, 26.0], [30.0, 20.0]]]
    tiny = [[[10.1, 10.1], [10.4, 10.1], [10.4, 10.4], [10.1, 10.1]]]
    schema = "poly_id int, rings array<array<array<double>>>"
    polys = spark.createDataFrame([(0, rings), (1, tiny)] + [(k, tiny) for k in range(2, 30)], schema)
    masked = extract.polygons_join_tiles(polys, full_tiles(spark), GRID, "poly_id", strategy="salted", hot_key=4)
    got = {}
    for r in masked.collect():
        got.setdefault(r.poly_id, set()).update(v for v in r.b0 if v is not None)
    px = layout.tiles_to_pixels(full_tiles(spark), 8)
    want = {r.b0 for r in extract.mask_pixels(px, rings, GRID).collect()}
    assert got[0] == want and len(want) > 500 and got[1] == set()
    one = extract.filter_intersects(full_tiles(spark), tiny, GRID).collect()
    # A polygon smaller than a cell still meets the one tile around it.
    assert [(r.col, r.row) for r in one] == [(1, 6)]
    many = [[[20 + 9 * __import__("math").cos(a / 50), 30 + 9 * __import__("math").sin(a / 50)] for a in range(315)]]
    a = extract.mask_pixels(px, many, GRID).count()
    b = layout.tiles_to_pixels(extract.mask_tiles(full_tiles(spark), many, GRID), 8).count()
    assert a == b > 200


BLOCK = ("source_dir string, file_name string, crs string, extent struct<xmin:double,ymin:double,xmax:double,ymax:double>,"
         "band int, cell_type string, cols int, rows int, block_x int, block_y int, cells array<int>, src int, i int, j int")


def blocks(spark, *files, extent=(0.0, 0.0, 1.0, 1.0), size=2):
    rows = [
        (d, f, "EPSG:32633", extent, b, "int32", size, size, 0, 0, [s * 10 + b] * (size * size), s, 1, 2)
        for s, d, f, n in files for b in range(n)
    ]
    return spark.createDataFrame(rows, BLOCK)


def test_copies_are_kept_or_refused(spark):
    twice = blocks(spark, (0, "a", "x_1_2", 2), (0, "a", "y_1_2", 2), (1, "b", "x_1_2", 1))
    row = assemble.assemble_scenes(twice, 2, 2, total_bands=6).first()
    # Ties of the source are broken by file name; the zero band is last.
    assert [row[f"b{k}"][0] for k in range(6)] == [0, 1, 0, 1, 10, 0] and row.n_bands == 5
    with pytest.raises(Exception, match="more than 4 bands"):
        assemble.assemble_scenes(twice, 2, 2, total_bands=4).collect()


def test_cells_are_shuffled_once(spark, sf_dir):
    """Without broadcasts: one exchange for the blocks, one for the frame."""
    from rastertable.catalog import fixtures as X
    from rastertable.sources.scenes import reblock

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = assemble.assemble_scenes(reblock(X.px_blocks(spark, sf_dir), 3), 3, X.SCENE)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        by_block = [l for l in plan.splitlines() if "Exchange hashpartitioning(" in l and "block_x" in l]
        assert len(by_block) == 2
        assert df.count() == 46 * 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slot_padding_keeps_or_refuses(spark):
    one = blocks(spark, (1, "b", "x_1_2", 1))
    row = assemble.assemble_scenes(one, 2, 2, total_bands=3, pad="slot", source_bands=(2, 1)).first()
    assert [row[f"b{k}"][0] for k in range(3)] == [0, 0, 10]
    twice = blocks(spark, (1, "b", "x_1_2", 1), (1, "b", "y_1_2", 1))
    with pytest.raises(Exception, match="more than 1 bands"):
        assemble.assemble_scenes(twice, 2, 2, total_bands=3, pad="slot", source_bands=(2, 1)).collect()


def test_scene_errors(spark):
    bad = blocks(spark, (0, "a", "x_1_2", 1), extent=(0.0, 0.0, 2.0, 2.0))
    with pytest.raises(Exception, match="no file with a valid extent"):
        assemble.assemble_scenes(bad, 2, 2, total_bands=1).collect()
    with pytest.raises(Exception, match="exceeds|outside"):
        assemble.assemble_scenes(blocks(spark, (0, "a", "x_1_2", 1), size=3), 2, 2, total_bands=1).collect()


def test_names_and_directories(spark):
    df = spark.createDataFrame([("a_02_010_x.tif",), ("none.tif",), ("1_2_and_3_4",)], "file_name string")
    assert [(r.i, r.j) for r in parse_scene_key(df, on_bad="drop").collect()] == [(2, 10)]
    with pytest.raises(Exception, match="exactly one number pair"):
        parse_scene_key(df).collect()
    dirs = spark.createDataFrame([("hdfs://host/data/b/",), ("b",)], "d string")
    got = dirs.select(source_ordinal(F.col("d"), "x/a,,file:///y/b")).collect()
    assert [r[0] for r in got] == [1, 1]
    with pytest.raises(Exception, match="unknown source directory"):
        dirs.select(source_ordinal(F.col("d"), "x/a")).collect()


def test_mixed_cell_sizes_are_refused(spark):
    grid = Grid(0.0, 8.0, 1.0, 1.0, 4, 8, 8)
    df = spark.createDataFrame([((0.0, 0.0, 4.0, 4.0), 0, 0)], "extent struct<xmin:double,ymin:double,xmax:double,ymax:double>, x_off int, y_off int")
    assert layout.place_on_grid(df, grid, 4).first()["y0"] == 4
    with pytest.raises(Exception, match="cell size differs"):
        layout.place_on_grid(df, grid, 3).collect()


def test_shuffled_tiles_are_not_sorted(spark):
    """Where tiles are shuffled, the small keys are hashed and tiles stream past them."""
    tiles = full_tiles(spark)
    windows = spark.createDataFrame([(i, i % 9, 0, i % 9 + 5, 5) for i in range(40)], "window_id long, x0 long, y0 long, x1 long, y1 long")
    joined = join_tiles(window_keys(windows, 8), tiles, "window_id", max_broadcast=1)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    small = join_tiles(window_keys(windows, 8), tiles, "window_id", strategy="broadcast")
    pairs = ["window_id", "col", "row"]
    assert sorted(joined.select(pairs).collect()) == sorted(small.select(pairs).collect())


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "salted"])
@pytest.mark.parametrize("hot", [16, 10_000])
def test_tiles_meet_their_windows_as_lists(spark, strategy, hot):
    """A tile is joined once, not once per window, and the pieces are those of the pairs, also in small batches."""
    tiles = full_tiles(spark).withColumn("b1", F.when(F.col("col") != 2, F.transform("b0", lambda v: v / 2.0)))
    windows = hot_windows(spark).withColumn("chip", F.struct("x0", F.lit("a").alias("name")))
    keys = window_keys(windows, 8)
    joined = join_tiles(keys, tiles, "window_id", strategy, hot_key=hot, lists=True)
    if hot == 10_000:
        assert joined.groupBy("col", "row").count().where("count > 1").count() == 0
    want = crop_tiles(join_tiles(keys, tiles, "window_id", strategy, hot_key=hot), 8, ["window_id", "chip"])
    got = window_pieces(windows, tiles, 8, strategy=strategy, hot_key=hot)
    small = map_rows(joined, crop_listed(8, ["window_id", "chip"], ["b0", "b1"], 50), got.schema)
    assert got.columns == want.columns and "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    rows = sorted(map(str, want.collect()))
    assert sorted(map(str, got.collect())) == rows and sorted(map(str, small.collect())) == rows
