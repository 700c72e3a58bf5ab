"""End-to-end jobs on files: ingest, lookups, sampling, extracts, overviews."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertable.catalog import fixtures as X
from rastertable.functions import geo
from rastertable.grid import Grid
from rastertable.operators import extract, layout
from rastertable.operators.algebra import merged_stats
from rastertable.operators.assemble import assemble_scenes
from rastertable.operators.index import batch, with_index
from rastertable.operators.splits import split_extents
from rastertable.operators.windows import hash_uniform, sample_windows
from rastertable.plans.ingest import build_zoomed, ingest
from rastertable.plans.sampling import chips_from_windows, generate_samples
from rastertable.sources import layers
from rastertable.sources.samples import product_view
from rastertable.sources.scenes import common_cell, read_scenes, split_paths

TILE = 6


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    """The fixture scenes as four block tables on disk."""
    root = tmp_path_factory.mktemp("sources")
    raw = X.raw_blocks(spark, sf_dir).drop("scene", "scene_band")
    paths = []
    for d in X.DIRS:
        path = f"{root}{d}"
        raw.where(F.col("source_dir") == d).drop("source_dir").write.parquet(path)
        paths.append(path)
    return ",".join([paths[0], "", *paths[1:]])


@pytest.fixture(scope="module")
def catalog(spark, sources, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("catalog"))
    ingest(spark, sources, path, "scenes", tile=TILE, block_size=3, scene_size=X.SCENE, max_block=3)
    return path


def test_read_scenes(spark, sources):
    df = read_scenes(spark, sources, crs="EPSG:3857", partitions=3, max_block=4)
    assert len(split_paths(sources)) == 4
    assert df.rdd.getNumPartitions() == 3
    assert df.select("crs").distinct().first()[0] == "EPSG:3857"
    assert df.agg(F.max("cols"), F.max("rows"), F.max("src")).first()[:] == (4, 4, 3)
    # The cut is a partition of the cells.
    assert df.select(F.sum(F.size("cells"))).first()[0] == 31632
    assert df.select(F.sum(F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, v: a + v))).first()[0] == 3991710


def test_ingest_layer(spark, sf_dir, catalog):
    meta = layers.layer_meta_row(spark, catalog, "scenes", 0)
    assert (meta.tile_size, meta.cell_w, meta.crs) == (TILE, 0.5, "EPSG:32633")
    tiles = layers.read_layer(spark, catalog, "scenes", 0)
    assert tiles.select("col", "row").distinct().count() == tiles.count()
    # Total of every band survives assembly, tiling, writing and reading.
    blocks = assemble_scenes(X.px_blocks(spark, sf_dir), X.SCENE, X.SCENE)
    for b in ("b0", "b4", "b10"):
        total = F.sum(F.aggregate(b, F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v, F.lit(0))))
        assert tiles.select(total).first()[0] == blocks.select(total).first()[0]


def test_layer_is_clustered_and_pruned(spark, catalog):
    one = extract.get_tile(layers.read_layer(spark, catalog, "scenes", 0), 2, 3).select("b4")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert all("/tiles/layer=scenes/zoom=0/" in f for f in one.inputFiles())
    assert "EqualTo(col,2)" in plan and "EqualTo(z," in plan
    assert "b4" in plan.split("ReadSchema")[1] and "b5" not in plan.split("ReadSchema")[1]
    assert one.count() == 1
    assert extract.get_tile(layers.read_layer(spark, catalog, "scenes", 0), 900, 900).count() == 0


def test_metadata_and_attributes(spark, catalog, tmp_path):
    text = layers.metadata_json(layers.layer_meta(spark, catalog, "scenes", 0)).first()[0]
    assert '"layer":"scenes"' in text and '"band_names":["R","G","B","IR","DSM"' in text
    box = layers.split_extent(spark, catalog, "scenes", 0, "training")
    assert box == pytest.approx((366028.0, 5807968.1, 366052.0, 5807992.1))
    whole = layers.split_extent(spark, catalog, "scenes", 0, "entire")
    assert whole[0] <= box[0] and whole[3] >= box[3]
    with pytest.raises(LookupError):
        layers.layer_meta_row(spark, catalog, "absent", 0)
    with pytest.raises(LookupError):
        layers.split_extent(spark, catalog, "absent", 0, "test")
    # An empty split is stored as NULL and reading it is an error.
    path = str(tmp_path / "c")
    heads = spark.createDataFrame(
        [(2, 10, (0.0, 0.0, 1.0, 1.0))], "i int, j int, extent struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    )
    layers.write_attributes(split_extents(heads), path, "x", 0)
    layers.write_attributes(split_extents(heads), path, "x", 1)
    assert layers.split_extent(spark, path, "x", 0, "training") == (0.0, 0.0, 1.0, 1.0)
    with pytest.raises(LookupError):
        layers.split_extent(spark, path, "x", 0, "validation")
    assert layers.layer_attrs(spark, path, "x", 1).count() == 0


def test_generate_samples(spark, catalog, tmp_path):
    out, copy = str(tmp_path / "chips"), str(tmp_path / "copy")
    args = dict(split="test", size=5, amount=12, seed=3)
    chips = generate_samples(spark, catalog, "scenes", out, gzip=True, copy_to=copy, products=True, **args)
    rows = chips.orderBy("window_id").collect()
    assert [r.window_id for r in rows] == list(range(len(rows))) and len(rows) == 12
    for r in rows:
        # The side is (size - 1) cells at a random offset: size cells, one
        # less only where the offset is aligned or the layer ends.
        assert r.cols in (4, 5) and r.rows in (4, 5)
        n = r.cols * r.rows
        assert len(r.b0) == len(r.ndvi) == len(r.mask) == len(r.z_b7) == n
        assert all(m in (0, 1) for m in r.mask)
        assert all(v is None or -1 <= v <= 1 for v in r.ndvi)
        for k in range(n):
            if r.b0[k] is not None and r.b0[k] + r.b3[k]:
                assert r.ndvi[k] == (r.b3[k] - r.b0[k]) / (r.b3[k] + r.b0[k])
    files = [f for _, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert files and all(".gz." in f for f in files)
    assert os.path.isdir(f"{out}/split=test/size=5")
    assert spark.read.parquet(copy).count() == 12
    ndvi = spark.read.parquet(f"{out}-products/product=ndvi")
    assert set(ndvi.columns) >= {"window_id", "split", "size", "b0"} and ndvi.count() == 12
    # The same seed gives the same chips, whatever the partitioning.
    again = generate_samples(spark, catalog, "scenes", str(tmp_path / "again"), **args)
    order = [c for c in chips.columns]
    assert again.select(order).exceptAll(chips.select(order)).count() == 0
    plain = generate_samples(spark, catalog, "scenes", str(tmp_path / "plain"), randomize=False, zscore=False, bands="2.0", **args)
    assert [c for c in plain.columns if c.startswith("b")] == ["b0", "b1"] and "z_b0" not in plain.columns
    assert product_view(plain, "image").count() == 12


def test_positional_ndvi(spark, catalog, tmp_path):
    kept = dict(split="entire", size=4, amount=3, randomize=False, zscore=False, seed=1)
    a = generate_samples(spark, catalog, "scenes", str(tmp_path / "a"), bands="3.1.2.0", positional=True, **kept)
    b = generate_samples(spark, catalog, "scenes", str(tmp_path / "b"), **kept)
    both = a.select("window_id", F.col("ndvi").alias("p")).join(b.select("window_id", "ndvi"), "window_id")
    # Red and infrared exchanged: the index changes its sign.
    flipped = F.zip_with("p", "ndvi", lambda p, q: F.coalesce(p, F.lit(0.0)) + F.coalesce(q, F.lit(0.0)) == 0)
    assert both.where(~F.forall(flipped, lambda v: v)).count() == 0


def test_blocks_of_a_chip_are_the_chip(spark, catalog):
    """Blocks cover a turned chip exactly once, with the cells and z-scores of the chip in one row."""
    grid = Grid.from_meta(layers.layer_meta_row(spark, catalog, "scenes", 0))
    box = layers.split_extent(spark, catalog, "scenes", 0, "training")
    windows = sample_windows(spark, 6, box, 20, grid, 5)
    tiles = layers.read_layer(spark, catalog, "scenes", 0)
    products = ("b0", "b7", "ndvi", "mask", "z_b0", "z_b7")
    make = lambda **k: chips_from_windows(windows, tiles, grid.tile, hash_uniform(5), **k).collect()
    whole = {c.window_id: c for c in make(size=20)}
    blocks = make(block=6)
    assert max(b.cols for b in blocks) == max(b.rows for b in blocks) == 6
    seen = {w: set() for w in whole}
    for b in blocks:
        c = whole[b.window_id]
        assert (c.px, c.py) == (0, 0) and (b.x0, b.y1) == (c.x0, c.y1)
        for k in range(b.cols * b.rows):
            x, y = b.px + k % b.cols, b.py + k // b.cols
            assert (x, y) not in seen[b.window_id]
            seen[b.window_id].add((x, y))
            for name in products:
                assert b[name][k] == c[name][y * c.cols + x]
    for w, c in whole.items():
        # What no block covers is what no tile covers.
        assert all(c.b0[y * c.cols + x] is None for y in range(c.rows) for x in range(c.cols) if (x, y) not in seen[w])


def test_merged_statistics_of_floats(spark):
    rows = [(1, [1.5, None, 2.25]), (1, [7.0, -3.5]), (1, [None]), (2, [None])]
    df = spark.createDataFrame(rows, "window_id int, b0 array<double>")
    got = {r.window_id: r.b0 for r in merged_stats(df, "window_id", ["b0"]).collect()}
    values = [1.5, 2.25, 7.0, -3.5]
    mean = sum(values) / 4
    assert got[1].mean == pytest.approx(mean) and got[1].sd == pytest.approx((sum((v - mean) ** 2 for v in values) / 4) ** 0.5)
    assert got[2].mean is None


def test_window_too_large(spark, catalog):
    grid = Grid.from_meta(layers.layer_meta_row(spark, catalog, "scenes", 0))
    with pytest.raises(ValueError, match="larger than the extent"):
        sample_windows(spark, 5, (0.0, 0.0, 3.0, 3.0), 9, grid)


def test_exact_fit_starts_at_the_extent(spark):
    grid = Grid(0.0, 10.0, 1.0, 1.0, 4, 10, 10)
    row = sample_windows(spark, 7, (2.0, 3.0, 6.0, 7.0), 5, grid).collect()
    # All draws coincide, so one distinct window is left.
    assert len(row) == 1 and (row[0].xmin, row[0].ymin, row[0].window_id) == (2.0, 3.0, 0)


def test_extract_with_lonlat_polygon(spark, catalog):
    grid = Grid.from_meta(layers.layer_meta_row(spark, catalog, "scenes", 0))
    tiles = layers.read_layer(spark, catalog, "scenes", 0).drop("layer", "zoom")
    xmin, ymin, xmax, ymax = layers.split_extent(spark, catalog, "scenes", 0, "training")
    ring = [[xmin + 1, ymin + 2], [xmax - 3, ymin + 1], [xmax - 2, ymax - 4], [xmin + 1, ymin + 2]]
    lonlat = geo.reproject_rings([ring], "EPSG:32633", "EPSG:4326")
    import json

    text = json.dumps({"type": "Polygon", "coordinates": lonlat})
    got = extract.extract(tiles, grid, text, "0.4").collect()
    px = layout.tiles_to_pixels(tiles.select("col", "row", "b0", "b4"), grid.tile)
    want = extract.mask_pixels(px, [ring], grid).count()
    assert sum(v is not None for p in got for v in p.b0) == want > 0
    whole = extract.extract(tiles, grid)
    assert whole.count() == tiles.count() and whole.columns[:9] == extract.extract(tiles, grid, text).columns[:9]
    data = lambda df: df.agg(F.sum(F.size(F.filter("b0", lambda v: v.isNotNull())))).first()[0]
    assert data(whole) == data(tiles)
    col, row = got[0].col, got[0].row
    view = extract.tile_view(tiles, grid, col, row, "DSM,R", text).first()
    plain = extract.tile_view(tiles, grid, col, row, "DSM,R").first()
    assert len(view.b0) == TILE * TILE and "b2" not in view.asDict()
    assert all(a is None or a == b for a, b in zip(view.b1, plain.b1))


def test_zoomed_layer_and_overviews(spark, catalog):
    base = build_zoomed(spark, catalog, "scenes", "web", tile=64, zoom=16)
    assert base == 16
    tops = layers.read_layer(spark, catalog, "web", 0).collect()
    assert len(tops) == 1 and (tops[0].col, tops[0].row) == (0, 0)
    meta = layers.layer_meta_row(spark, catalog, "web", 16)
    assert meta.crs == "EPSG:3857" and meta.tile_size == 64
    # Every overview is the top-left thinning of the level below it.
    below = layout.tiles_to_pixels(layers.read_layer(spark, catalog, "web", 16).select("col", "row", "b0"), 64)
    above = layout.tiles_to_pixels(layers.read_layer(spark, catalog, "web", 15).select("col", "row", "b0"), 64)
    want = layout.pyramid_pixels(below.select("x", "y", "b0"), 1)
    assert above.select("x", "y", "b0").exceptAll(want.select("x", "y", "b0")).count() == 0
    assert above.count() == want.count()


def test_batches_partition_the_layer(spark, catalog):
    tiles = layers.read_layer(spark, catalog, "scenes", 0)
    n = tiles.count()
    assert sorted(r.idx for r in with_index(tiles).select("idx").collect()) == list(range(n))
    parts = [batch(tiles, 4, k).select("col", "row").collect() for k in range(4)]
    assert sum(map(len, parts)) == n and len({r for p in parts for r in p}) == n
    with pytest.raises(ValueError):
        batch(tiles, 4, 4)


def small_layer(spark, catalog, layer, bands, cell="int", value=0, commit=True, **mode):
    row = (0, 0, *[[value + k] * 4 for k in range(bands)])
    names = "col int, row int" + "".join(f", b{k} array<{cell}>" for k in range(bands))
    layers.write_layer(spark.createDataFrame([row], names), catalog, layer, 0, **mode)
    if commit:
        box = (0.0, 0.0, 1.0, 1.0)
        meta = (layer, 0, "EPSG:3857", "int32", box, box, 2, 0.5, 0.5, 0, 0, 0, 0, [f"B{k}" for k in range(bands)])
        layers.write_metadata(spark.createDataFrame([meta], layers.LAYER_META), catalog, layer, 0)


def test_layers_of_different_bands_share_a_catalog(spark, tmp_path):
    path = str(tmp_path / "c")
    for name, bands, cell in (("a_one", 1, "int"), ("001", 4, "int"), ("wide/one", 11, "int"), ("real", 2, "double")):
        small_layer(spark, path, name, bands, cell, 1.5 if cell == "double" else 7)
    for name, bands, cell in (("a_one", 1, "int"), ("001", 4, "int"), ("wide/one", 11, "int"), ("real", 2, "double")):
        got = layers.read_layer(spark, path, name, 0)
        assert [c for c in got.columns if c[0] == "b"] == [f"b{k}" for k in range(bands)]
        (r,) = got.collect()
        assert r["layer"] == name and r["b0"] == [1.5 if cell == "double" else 7] * 4


def test_layers_are_not_doubled(spark, tmp_path):
    path = str(tmp_path / "c")
    small_layer(spark, path, "x", 1)
    small_layer(spark, path, "y", 1)
    with pytest.raises(FileExistsError):
        small_layer(spark, path, "x", 1)
    small_layer(spark, path, "x", 2, value=5, mode="overwrite")
    (r,) = layers.read_layer(spark, path, "x", 0).collect()
    assert r["b1"] == [6] * 4 and layers.read_layer(spark, path, "y", 0).count() == 1
    # Tiles without their metadata are no layer; the next run replaces them.
    small_layer(spark, path, "z", 1, commit=False)
    with pytest.raises(LookupError):
        layers.read_layer(spark, path, "z", 0)
    small_layer(spark, path, "z", 1)
    assert layers.read_layer(spark, path, "z", 0).count() == 1


def test_failed_ingest_leaves_no_layer(spark, sources, tmp_path):
    path = str(tmp_path / "c")
    args = dict(tile=TILE, block_size=3, max_block=3)
    with pytest.raises(Exception):
        # Scenes are larger than this, so a block lies outside.
        ingest(spark, sources, path, "scenes", scene_size=3, **args)
    with pytest.raises(LookupError):
        layers.read_layer(spark, path, "scenes", 0)
    ingest(spark, sources, path, "scenes", scene_size=X.SCENE, **args)
    with pytest.raises(FileExistsError):
        ingest(spark, sources, path, "scenes", scene_size=X.SCENE, **args)
    n = layers.read_layer(spark, path, "scenes", 0).count()
    ingest(spark, sources, path, "scenes", scene_size=X.SCENE, mode="overwrite", **args)
    assert layers.read_layer(spark, path, "scenes", 0).count() == n


def test_web_layer_has_split_extents(spark, catalog):
    if layers.layer_meta(spark, catalog, "web2", 16).isEmpty():
        build_zoomed(spark, catalog, "scenes", "web2", tile=64, zoom=16, pyramid=False)
    box = layers.split_extent(spark, catalog, "web2", 16, "training")
    source = layers.split_extent(spark, catalog, "scenes", 0, "training")
    ring = [[source[0], source[1]], [source[2], source[3]]]
    ((low, high),) = geo.reproject_rings([ring], "EPSG:32633", "EPSG:3857")
    assert box[0] == pytest.approx(low[0], abs=5) and box[3] == pytest.approx(high[1], abs=5)


def test_two_rows_of_one_block_are_an_error(spark, sf_dir):
    blocks = X.px_blocks(spark, sf_dir)
    twice = blocks.union(blocks.where("band = 0 AND src = 0").limit(1))
    with pytest.raises(Exception, match="two rows of one band"):
        assemble_scenes(twice, X.SCENE, X.SCENE).select("i").collect()


def test_float_sources(spark, sources, catalog, tmp_path):
    """One source of doubles makes a layer of doubles; its NaN cells are NoData."""
    paths = split_paths(sources)
    real = f"{tmp_path}/height"
    os.makedirs(real)
    real = f"{real}/{os.path.basename(paths[1])}"
    k = F.transform("cells", lambda v, i: F.when(i % 5 == 0, F.lit(float("nan"))).otherwise(v + 0.25))
    spark.read.parquet(paths[1]).withColumn("cells", k).write.parquet(real)
    listed = [paths[0], real, *paths[2:]]
    blocks = read_scenes(spark, listed)
    assert blocks.schema["cells"].dataType.elementType == T.DoubleType()
    assert [r[0] for r in blocks.select("cell_type").distinct().collect()] == ["float64"]

    path = str(tmp_path / "c")
    ingest(spark, listed, path, "scenes", tile=TILE, block_size=3, scene_size=X.SCENE, max_block=3)
    assert layers.layer_meta_row(spark, path, "scenes", 0).cell_type == "float64"
    got = layout.tiles_to_pixels(layers.read_layer(spark, path, "scenes", 0), TILE, drop_nodata=False)
    plain = layout.tiles_to_pixels(layers.read_layer(spark, catalog, "scenes", 0), TILE, drop_nodata=False)
    assert dict(got.dtypes)["b0"] == "double" and dict(plain.dtypes)["b0"] == "int"
    bands = [c for c in got.columns if c[0] == "b"]
    both = got.select("x", "y", *bands).join(
        plain.select("x", "y", *[F.col(b).alias(f"i{b}") for b in bands]), ["x", "y"]
    )
    changed = both.select(*[F.count_if(~F.col(b).eqNullSafe(F.col(f"i{b}").cast("double"))).alias(b) for b in bands]).first()
    moved = [b for b in bands if changed[b]]
    # Only bands of that source differ: by a quarter, or as NoData.
    assert moved and len(moved) < len(bands)
    for b in moved:
        n = both.select(
            F.count_if(F.col(b) == F.col(f"i{b}") + 0.25).alias("quarter"),
            F.count_if(F.col(b).isNull() & F.col(f"i{b}").isNotNull()).alias("none"),
            F.count_if(F.isnan(b)).alias("nan"),
        ).first()
        assert n["quarter"] > 0 and n["none"] > 0 and n["nan"] == 0 and n["quarter"] + n["none"] == changed[b]

    zoom = build_zoomed(spark, path, "scenes", "web", tile=64, zoom=16, pyramid=False)
    web = layers.read_layer(spark, path, "web", zoom)
    assert dict(web.dtypes)[moved[0]] == "array<double>"
    cells = layout.tiles_to_pixels(web.select("col", "row", moved[0]), 64).select(moved[0]).distinct()
    assert cells.count() > 0
    assert cells.exceptAll(got.select(moved[0]).distinct()).count() == 0


def test_common_cell():
    byte, short, whole, single, double = T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType(), T.DoubleType()
    assert common_cell([byte, short]) == common_cell([whole]) == whole
    assert common_cell([short, single]) == single
    assert common_cell([whole, single]) == common_cell([single, double]) == double


def test_sources_of_other_cells_are_an_error(spark, sources, tmp_path):
    first = split_paths(sources)[0]
    bad = f"{tmp_path}/text"
    spark.read.parquet(first).withColumn("cells", F.col("cells").cast("array<string>")).write.parquet(bad)
    with pytest.raises(ValueError, match="array<string>"):
        read_scenes(spark, bad)
