"""Array kernels against NumPy on small arrays, and their algebra."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rastertable.functions import cells as C
from rastertable.functions import geo
from rastertable.functions import tiles as K
from rastertable.grid import Grid, zorder, zorder_of
from rastertable.operators import extract

RNG = np.random.default_rng(7)


def one(spark, array, expr, **scalars):
    cells = [None if v is None or (isinstance(v, float) and np.isnan(v)) else int(v) for v in np.ravel(array)]
    df = spark.createDataFrame([(cells,)], "a array<int>")
    return df.select(expr(F.col("a")).alias("v")).first()["v"]


@pytest.mark.parametrize("shape", [(3, 5), (4, 4), (1, 6)])
def test_orientation(spark, shape):
    a = RNG.integers(0, 100, shape)
    rows, cols = shape
    cases = []
    for fv in (False, True):
        for fh in (False, True):
            for n in range(5):
                b = a[:, ::-1] if fv else a
                b = b[::-1] if fh else b
                cases.append((fv, fh, n, a.ravel().tolist(), np.rot90(b, n).ravel().tolist()))
    df = spark.createDataFrame(cases, "fv boolean, fh boolean, n int, a array<int>, want array<int>")
    got = K.orient(F.col("a"), F.lit(cols), F.lit(rows), F.col("fv"), F.col("fh"), F.col("n"))
    assert df.where(got != F.col("want")).count() == 0
    fixed = F.array(*[K.rotate90(F.col("a"), F.lit(cols), F.lit(rows), n) for n in range(5)])
    got = df.where("not fv and not fh").select(F.get(fixed, F.col("n")).alias("g"), "want")
    assert got.where("g != want").count() == 0


def test_algebra_of_flips(spark):
    a = RNG.integers(0, 9, (3, 5))
    v = lambda c: K.flip_vertical(c, 5, 3)
    h = lambda c: K.flip_horizontal(c, 5, 3)
    flat = a.ravel().tolist()
    assert one(spark, a, lambda c: v(v(c))) == flat
    assert one(spark, a, lambda c: h(h(c))) == flat
    assert one(spark, a, lambda c: v(h(c))) == one(spark, a, lambda c: K.rotate90(c, 5, 3, 2))
    four = lambda c: K.rotate90(K.rotate90(K.rotate90(K.rotate90(c, 5, 3, 1), 3, 5, 1), 5, 3, 1), 3, 5, 1)
    assert one(spark, a, four) == flat


def test_rectangles(spark):
    a = RNG.integers(0, 99, (4, 6))
    assert one(spark, a, lambda c: K.crop_cells(c, 6, 1, 2, 3, 2)) == a[2:4, 1:4].ravel().tolist()
    padded = np.zeros((5, 8), int)
    padded[:4, :6] = a
    assert one(spark, a, lambda c: K.pad_cells(c, 6, 4, 8, 5)) == padded.ravel().tolist()
    assert one(spark, a, lambda c: K.pad_cells(c, 6, 4, 6, 4)) == a.ravel().tolist()
    with pytest.raises(Exception, match="exceeds"):
        one(spark, a, lambda c: K.pad_cells(c, 6, 4, 5, 4))
    placed = np.full((7, 9), None, object)
    placed[2:6, 1:7] = a
    assert one(spark, a, lambda c: K.place_cells(c, 6, 1, 2, 6, 4, 9, 7)) == placed.ravel().tolist()


def test_dense_cells(spark):
    df = spark.sql("SELECT array(named_struct('k', 1, 'v', 10), named_struct('k', 4, 'v', 40)) AS e")
    assert df.select(K.dense_cells(F.col("e"), "v", 6)).first()[0] == [None, 10, None, None, 40, None]


def test_zscore_cells(spark):
    a = np.array([1, 5, 9, 200, 3, 7])
    want = np.trunc((a - a.mean()) / a.std()).astype(int).tolist()
    assert one(spark, a, K.zscore_cells) == want
    assert one(spark, a, lambda c: K.zscore_cells(c.cast("array<double>"))) == want
    assert one(spark, [4, 4, None], K.zscore_cells) == [0, 0, None]
    assert one(spark, [None, None], lambda c: K.zscore_cells(c, strict=False)) == [None, None]


def test_adjust(spark):
    """Brightness 15, gamma 0.8, contrast 30, each clamped, from the formulas."""
    factor = (259 * (30.0 + 255)) / (255 * (259 - 30.0))

    def want(v):
        clamp = lambda z: min(max(z, 0), 255)
        v = clamp(v + 15 if v > 0 else v)
        v = clamp(int(255 * (v / 255.0) ** (1 / 0.8)))
        return clamp(int(factor * (v - 128) + 128))

    df = spark.range(-300, 900).select(F.col("id").cast("int").alias("v"))
    for r in df.select("v", C.adjust(F.col("v")).alias("a"), C.adjust_lookup(F.col("v")).alias("t")).collect():
        assert r.a == r.t == want(r.v)
    none = spark.sql("SELECT CAST(NULL AS INT) AS v")
    assert none.select(C.adjust(F.col("v")), C.adjust_lookup(F.col("v"))).first()[:] == (None, None)


def test_indices_and_nodata(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 3), (0, 0), (-2, 2), (NULL, 5) AS t(r, n)")
    assert [r[0] for r in df.select(C.ndvi(F.col("r"), F.col("n"))).collect()] == [0.5, None, None, None]
    masks = spark.sql("SELECT * FROM VALUES (0,0,0), (0,0,1), (NULL,0,0) AS t(a, b, c)")
    got = masks.select(C.label_mask(F.col("a"), F.col("b"), F.col("c"))).collect()
    assert [r[0] for r in got] == [0, 1, 1]


def test_classes_are_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (0.0500001,), (1.0,), (1.5,), (None,)], "v double")
    rows = df.select(
        C.class_index(F.col("v"), C.NDVI_BREAKS).alias("k"), C.classify(F.col("v"), C.NDVI_BREAKS).alias("c")
    ).collect()
    assert [r.k for r in rows] == [0, 1, 8, None, None]
    assert rows[0].c == 0xFFFFE5AA and rows[3].c is None


def test_zorder_is_injective(spark):
    df = spark.range(0, 64 * 64).select((F.col("id") % 64).alias("c"), F.floor(F.col("id") / 64).alias("r"))
    z = df.select("c", "r", zorder(F.col("c"), F.col("r")).alias("z"))
    assert z.select("z").distinct().count() == 64 * 64
    assert all(zorder_of(r.c, r.r) == r.z for r in z.collect())
    big = 2**31 - 1
    got = spark.range(1).select(zorder(F.lit(big), F.lit(big))).first()[0]
    assert got == zorder_of(big, big) == 2**62 - 1


HOLED = [
    [[1.0, 1.0], [9.0, 2.0], [8.0, 9.0], [2.0, 8.0], [1.0, 1.0]],
    [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]],
]


def even_odd(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1:
                inside = not inside
    return inside


def test_mask_with_hole(spark):
    """Tile form, point form and unrolled form agree with brute force."""
    edges = geo.polygon_edges(geo.rings_literal(HOLED))
    got = spark.range(1).select(
        geo.mask_cells(
            F.expr("sequence(0, 399)"), edges, F.lit(20), F.lit(20), F.lit(0.0), F.lit(10.0), 0.5, 0.5
        ).alias("m")
    ).first()["m"]
    for k in range(400):
        cx, cy = (k % 20 + 0.5) * 0.5, 10 - (k // 20 + 0.5) * 0.5
        assert (got[k] == k) == even_odd(HOLED, cx, cy)
    pts = spark.range(400).select(
        "id", ((F.col("id") % 20 + 0.5) * 0.5).alias("x"), (F.lit(10) - (F.floor(F.col("id") / 20) + 0.5) * 0.5).alias("y")
    )
    a = geo.contains_point(edges, F.col("x"), F.col("y"))
    b = geo.contains_point_const(HOLED, F.col("x"), F.col("y"))
    for r in pts.select("id", a.alias("a"), b.alias("b")).collect():
        assert r.a == r.b == (got[r.id] is not None)


def test_open_ring_is_closed(spark):
    square = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]]
    assert len(geo.edges_of(square)) == 4
    assert spark.range(1).select(F.size(geo.polygon_edges(geo.rings_literal(square)))).first()[0] == 4


def test_geojson(spark):
    text = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[1,1.5],[0,0]]]}'
    df = spark.createDataFrame([(text,), ('{"type":"Point","coordinates":[1,2]}',), ("no json",)], "t string")
    rows = [r[0] for r in df.select(geo.parse_geojson(F.col("t"))).collect()]
    assert rows[0] == geo.rings_from_geojson(text) and rows[1] is None and rows[2] is None
    with pytest.raises(ValueError):
        geo.rings_from_geojson('{"type":"Point","coordinates":[1,2]}')


def test_projection_values():
    """Published reference points and the central meridian."""
    x, y = geo.project(-180.0, 85.0511287798066, "EPSG:3857", geo.NUM)
    assert abs(x + 20037508.342789244) < 1e-6 and abs(y - 20037508.342789244) < 1e-3
    x, y = geo.project(15.0, 0.0, "EPSG:32633", geo.NUM)
    assert abs(x - 500000) < 1e-6 and abs(y) < 1e-6
    # Length of the WGS84 meridian from the equator to 45 degrees.
    _, y = geo.project(15.0, 45.0, "EPSG:32633", geo.NUM)
    assert abs(y - 0.9996 * 4984944.378) < 2e-3
    for lon in (12.0, 14.1, 15.0, 18.0):
        for lat in (0.5, 38.0, 52.4, 71.0):
            there = geo.project(lon, lat, "EPSG:32633", geo.NUM)
            back = geo.unproject(*there, "EPSG:32633", geo.NUM)
            assert abs(back[0] - lon) < 1e-9 and abs(back[1] - lat) < 1e-9
    with pytest.raises(ValueError):
        geo.project(1.0, 1.0, "EPSG:9999", geo.NUM)


def test_statistics_of_wide_integers(spark):
    """Squares beyond 63 bits in sum, and no data cell."""
    from rastertable.operators.algebra import add_zscore

    df = spark.createDataFrame([([1500000000, 1500000001, 1500000002],), ([2147483647, -2147483648] * 50,)], "b0 array<int>")
    got = [r.z_b0 for r in add_zscore(df, ["b0"]).collect()]
    assert got[0] == [-1, 0, 1] and set(got[1]) == {1, -1}
    with pytest.raises(Exception, match="no statistics"):
        add_zscore(spark.createDataFrame([([None, None],)], "b0 array<int>"), ["b0"]).collect()


def test_many_edges_are_one_constant(spark):
    """No row rebuilds the edges of a polygon parameter."""
    import math

    from rastertable.grid import Grid
    from rastertable.operators.extract import mask_pixels

    grid = Grid(0.0, 40.0, 1.0, 1.0, 8, 40, 40)
    ring = [[20 + 15 * math.cos(t * math.pi / 100), 20 + 15 * math.sin(t * math.pi / 100)] for t in range(200)]
    px = spark.range(1600).selectExpr("cast(id % 40 as int) x", "cast(id div 40 as int) y", "1 b0")
    kept = mask_pixels(px, [ring], grid)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "flatten(" not in plan
    want = sum((x + 0.5 - 20) ** 2 + (y + 0.5 - 20) ** 2 < 15**2 - 0.2 for x in range(40) for y in range(40))
    assert abs(kept.count() - want) <= 4


@pytest.mark.parametrize("scale", [0.25, 0.9, 6.0])
def test_reproject_against_plain(spark, scale):
    """Every target cell holds the source cell under its centre: finer and coarser grids, holes, two cell types."""
    from rastertable.functions import geo
    from rastertable.grid import Grid
    from rastertable.operators import layout

    source = Grid(366000.0, 5808000.0, 1.0, 1.0, 8, 30, 20)
    (x, y) = geo.reproject(366000.0, 5808000.0, source.crs, "EPSG:3857", geo.NUM)
    # Web cells are about 1.6 times as long as they are on the ground.
    target = Grid(x - 40, y + 40, 1.6 * scale, 1.6 * scale, 16, crs="EPSG:3857")
    ints = lambda x, y: None if (x + y) % 7 == 0 else 100 * y + x
    rows = []
    for col in range(4):
        for row in range(3):
            if (col, row) == (1, 1):
                continue  # a tile that is not there
            at = [(col * 8 + k % 8, row * 8 + k // 8) for k in range(64)]
            rows.append((col, row, [ints(*p) for p in at], [p[0] + p[1] / 4 for p in at]))
    tiles = spark.createDataFrame(rows, "col int, row int, b0 array<int>, b1 array<double>")
    keys = layout.target_keys_for(tiles.select("col", "row"), source, target)
    got = {}
    for r in layout.reproject_nn(tiles, source, target, keys).collect():
        assert len(r.b0) == len(r.b1) == 256 and (r.tile_cols, r.tile_rows) == (16, 16)
        for k, (a, b) in enumerate(zip(r.b0, r.b1)):
            if b is not None:
                got[r.col * 16 + k % 16, r.row * 16 + k // 16] = (a, b)
    want = {}
    cells = int(160 / (1.6 * scale))
    for tx in range(cells):
        for ty in range(cells):
            mx, my = target.ox + (tx + 0.5) * target.cw, target.oy - (ty + 0.5) * target.ch
            sx, sy = geo.reproject(mx, my, target.crs, source.crs, geo.NUM)
            cx, cy = int(np.floor(sx - source.ox)), int(np.floor(source.oy - sy))
            if 0 <= cx < 30 and 0 <= cy < 20 and (cx // 8, cy // 8) != (1, 1):
                want[tx, ty] = (ints(cx, cy), cx + cy / 4)
    assert want and got == want
    assert layout.reproject_nn(tiles, source, target, keys.where("false")).count() == 0
    assert layout.reproject_nn(tiles.where("false"), source, target, keys).count() == 0


def test_masked_bands_follow_the_outline_once(spark):
    """All bands of a tile are masked in one Arrow step, by the rule of the one-band form."""
    grid = Grid(0.0, 10.0, 0.5, 0.5, 20, 20, 20)
    cells = F.expr("sequence(0, 399)")
    tiles = spark.range(1).select(F.lit(0).alias("col"), F.lit(0).alias("row"), cells.alias("b0"), F.reverse(cells).cast("array<double>").alias("b1"))
    masked = extract.mask_tiles(tiles, HOLED, grid)
    assert masked._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    edges = geo.polygon_edges(geo.rings_literal(HOLED))
    plain = geo.mask_cells(cells, edges, F.lit(20), F.lit(20), F.lit(0.0), F.lit(10.0), 0.5, 0.5)
    want = spark.range(1).select(plain.alias("m")).first()["m"]
    got = masked.first()
    assert got["b0"] == want
    assert got["b1"] == [None if v is None else 399.0 - v for v in want]


def test_whole_and_unknown_tiles(spark):
    """Tiles wholly inside pass as they are; an empty outline leaves nothing."""
    grid = Grid(0.0, 2.0, 1.0, 1.0, 2, 4, 2)
    kind = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
    df = spark.createDataFrame(
        [(0, 0, "inside", None, [1, None, 3, 4]), (1, 0, "edge", [], [1, 2, 3, 4]), (1, 0, "edge", [], None)],
        f"col int, row int, relation string, edges {kind}, b0 array<int>",
    )
    assert [r.b0 for r in extract.mask_joined(df, grid, ["b0"]).collect()] == [[1, None, 3, 4], [None] * 4, None]


def test_turns_in_one_step_match_expressions(spark):
    """The Arrow kernel turns every band as ``tiles.orient`` does, null choices and bands included."""
    from rastertable.operators.augment import orient_chips

    rows = [
        (c, r, v, h, t, [None if k == 1 else k for k in range(c * r)] if c else None, [k * 0.5 for k in range(c * r)])
        for c, r in ((3, 2), (1, 4), (2, 2), (0, 3))
        for v in (True, False, None) for h in (True, False, None) for t in (*range(5), -1, None)
    ]
    df = spark.createDataFrame(rows, "cols int, rows int, flip_v boolean, flip_h boolean, turns int, b0 array<int>, b1 array<double>").where("cols > 0")
    choice = [F.col(c) for c in ("cols", "rows", "flip_v", "flip_h", "turns")]
    want = df.select(*[K.orient(F.col(b), *choice).alias(b) for b in ("b0", "b1")])
    got = orient_chips(df)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.select("b0", "b1").collect()] == [tuple(r) for r in want.collect()]


def test_bands_share_their_nodata_runs(spark):
    entries = "array(named_struct('k', 1, 'b0', 10, 'b1', 0.5D), named_struct('k', 4, 'b0', null, 'b1', 1.5D))"
    got = spark.range(1).select(K.dense_bands(F.expr(entries), {"b0": "int", "b1": "double"}, 6).alias("d")).select("d.*").first()
    assert got.b0 == [None, 10, None, None, None, None] and got.b1 == [None, 0.5, None, None, 1.5, None]


def test_zscores_and_totals_in_one_step_match_expressions(spark):
    from rastertable.functions.batches import totals
    from rastertable.operators.algebra import add_zscore

    cells = [[1, 2, None, 9], [5, 5, 5], [None, None], [], None, [2147483647, -2147483648, 0], [7]]
    df = spark.createDataFrame([(c, [None if v is None else v * 3 for v in c] if c is not None else None) for c in cells], "b0 array<int>, b1 array<long>")
    want = df.select(*[K.zscore_cells(F.col(b), False).alias(f"z_{b}") for b in ("b0", "b1")])
    got = add_zscore(df, strict=False)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.select("z_b0", "z_b1").collect()] == [tuple(r) for r in want.collect()]
    n, total = totals(pa.array(cells, pa.list_(pa.int32())))
    assert n.to_pylist() == [3, 3, 0, 0, None, 3, 1] and total.to_pylist() == [12, 15, 0, 0, None, -1, 7]
