"""Queries on scene assembly, splits and layer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastertable.catalog import fixtures as X
from rastertable.catalog.cells import exploded
from rastertable.catalog.registry import query
from rastertable.functions import geo
from rastertable.functions.tiles import pad_cells
from rastertable.operators import assemble, layout, splits
from rastertable.schema import TOTAL_BANDS
from rastertable.sources import layers
from rastertable.sources import scenes as src

S = X.SCENE
_DIR_CASE = "CASE src WHEN 0 THEN 'ortho_rgbir' WHEN 1 THEN 'height' WHEN 2 THEN 'labels' ELSE 'labels_nb' END"
_NAME = (
    "CASE src WHEN 0 THEN printf('img_%d_%d_rgbir.tif', i, j) WHEN 1 THEN printf('dsm_%02d_%02d_norm.tif', i, j) "
    "WHEN 2 THEN printf('img_%d_%d_label.tif', i, j) ELSE printf('img_%d_%d_label_nb.tif', i, j) END"
)


@query(
    "source_order",
    f"WITH {X.FILES} SELECT {_DIR_CASE} AS dir, src, count(*) AS files, CAST(sum(n_bands) AS BIGINT) AS bands FROM files GROUP BY src",
)
def source_order(spark, sf):
    """Ordinal of every file by its directory; blank list entries do not count."""
    listed = ",".join([X.DIRS[0], "", *X.DIRS[1:], " "])
    files = X.raw_blocks(spark, sf).select(
        src.parent_dir(F.concat("source_dir", F.lit("/"), "file_name")).alias("dir"),
        src.source_ordinal(F.col("source_dir"), listed).alias("src"), "file_name",
    )
    return (
        files.groupBy("dir", "src", "file_name").agg(F.count("*").alias("n"))
        .groupBy("dir", "src").agg(F.count("*").alias("files"), F.sum("n").alias("bands"))
    )


@query(
    "split_paths",
    f"WITH {X.FILES} SELECT scene, CAST(count(*) AS INTEGER) AS n_paths FROM files GROUP BY scene",
)
def split_paths(spark, sf):
    """Comma-separated path lists with blanks, split again."""
    lists = X.raw_blocks(spark, sf).groupBy("scene").agg(
        F.concat_ws(",,", F.collect_set(F.concat("source_dir", F.lit("/"), "file_name"))).alias("paths")
    )
    return lists.select("scene", F.size(src.split_path_column(F.col("paths"))).alias("n_paths"))


@query("parse_scene_key", f"WITH {X.FILES} SELECT {_NAME} AS file_name, i, j FROM files")
def parse_scene_key(spark, sf):
    names = X.raw_blocks(spark, sf).select("file_name").distinct()
    return src.parse_scene_key(names).select("file_name", "i", "j")


@query(
    "round_extent",
    f"""WITH {X.FILES} SELECT src, i, j,
    CASE WHEN src < 2 THEN round(366000.04 + 4 * j, 1) ELSE 0 END::DOUBLE AS xmin,
    CASE WHEN src < 2 THEN round(5808000.06 - 4 * i - 4, 1) ELSE 0 END::DOUBLE AS ymin,
    CASE WHEN src < 2 THEN round(366000.04 + 4 * j + 4, 1) ELSE 8 END::DOUBLE AS xmax,
    CASE WHEN src < 2 THEN round(5808000.06 - 4 * i, 1) ELSE 8 END::DOUBLE AS ymax FROM files""",
)
def round_extent(spark, sf):
    """Every file's extent, the corrupt ones too."""
    raw = src.parse_scene_key(X.raw_blocks(spark, sf))
    order = (F.array_position(F.array(*[F.lit(d) for d in X.DIRS]), F.col("source_dir")) - 1).cast("int")
    return (
        raw.select(order.alias("src"), "i", "j", geo.round_extent(F.col("extent")).alias("e"))
        .distinct()
        .select("src", "i", "j", "e.*")
    )


@query(
    "corrupt_extent",
    f"WITH {X.FILES} SELECT src, CAST(count(*) FILTER (WHERE src >= 2) AS BIGINT) AS corrupt, count(*) AS files FROM files GROUP BY src",
)
def corrupt_extent(spark, sf):
    files = assemble.file_headers(X.px_blocks(spark, sf))
    bad = assemble.is_corrupt_extent(F.col("extent"), S)
    return files.groupBy("src").agg(F.count_if(bad).alias("corrupt"), F.count("*").alias("files"))


_BOX = """round(366000.04 + 4 * j, 1)::DOUBLE AS xmin, round(5808000.06 - 4 * i - 4, 1)::DOUBLE AS ymin,
    round(366000.04 + 4 * j + 4, 1)::DOUBLE AS xmax, round(5808000.06 - 4 * i, 1)::DOUBLE AS ymax"""


@query(
    "repair_extent",
    f"WITH {X.FILES} SELECT DISTINCT i, j, 'EPSG:32633' AS crs, {_BOX} FROM files",
)
def repair_extent(spark, sf):
    heads = assemble.scene_headers(assemble.file_headers(X.px_blocks(spark, sf)), S)
    return heads.select("i", "j", "crs", "extent.*")


@query(
    "scene_header",
    f"WITH {X.FILES} SELECT i, j, CAST(sum(n_bands) AS INTEGER) AS n_bands, 'int32' AS cell_type FROM files GROUP BY i, j",
)
def scene_header(spark, sf):
    heads = assemble.scene_headers(assemble.file_headers(X.px_blocks(spark, sf)), S)
    return heads.select("i", "j", "n_bands", "cell_type")


@query(
    "pad_cells",
    f"""WITH {X.PX}, g AS (SELECT DISTINCT scene, band, unnest(range(0, 64)) AS k FROM px)
    SELECT g.scene, g.band, CAST(g.k AS INTEGER) AS k, coalesce(px.dn, 0) AS dn
    FROM g LEFT JOIN px ON g.scene = px.scene AND g.k = px.k AND g.band = px.band""",
)
def pad(spark, sf):
    """Every band in scene size; the height band gains a column of zeros."""
    padded = X.raw_blocks(spark, sf).select(
        "scene", F.col("scene_band").alias("band"),
        pad_cells(F.col("cells"), F.col("cols"), F.col("rows"), S, S).alias("dn"),
    )
    return exploded(padded, "dn")


@query(
    "band_offsets",
    f"""WITH {X.FILES} SELECT i, j, src, n_bands, CAST(coalesce(sum(n_bands) OVER
    (PARTITION BY i, j ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS band_offset FROM files""",
)
def band_offsets(spark, sf):
    heads = assemble.band_offsets(assemble.file_headers(X.px_blocks(spark, sf)))
    return heads.select("i", "j", "src", "n_bands", "band_offset")


_SUMS = ", ".join(f"CAST(sum(b{k}) AS BIGINT) AS s{k}, CAST(sum(k * b{k}) AS BIGINT) AS m{k}" for k in range(11))


def _sums(df, *keys):
    bands = [f"b{k}" for k in range(11)]
    flat = exploded(df.select(*keys, "x_off", "y_off", "cols", *bands), *bands)
    y = F.col("y_off") + F.floor(F.col("k") / F.col("cols"))
    flat = flat.withColumn("k", (y * S + F.col("x_off") + F.col("k") % F.col("cols")).cast("bigint"))
    return flat.groupBy(*keys).agg(
        *[a for k in range(11) for a in (F.sum(f"b{k}").alias(f"s{k}"), F.sum(F.col("k") * F.col(f"b{k}")).alias(f"m{k}"))]
    )


_ASSEMBLED = f"""WITH {X.SC}, nb AS (SELECT scene, CAST(count(DISTINCT band) AS INTEGER) AS n_bands FROM px GROUP BY scene)
    SELECT CAST(2 + sc.scene % 6 AS INTEGER) AS i, CAST(7 + sc.scene // 6 AS INTEGER) AS j, n_bands, {_SUMS}
    FROM sc JOIN nb ON sc.scene = nb.scene GROUP BY 1, 2, 3"""


@query("assemble_scenes", _ASSEMBLED)
def assemble_scenes(spark, sf):
    return _sums(assemble.assemble_scenes(X.px_blocks(spark, sf), S, S), "i", "j", "n_bands")


@query("assemble_blocks", _ASSEMBLED)
def assemble_blocks(spark, sf):
    """The same scenes read as blocks of 3 x 3 cells (ragged at the edges)."""
    blocks = src.reblock(X.px_blocks(spark, sf), 3)
    return _sums(assemble.assemble_scenes(blocks, 3, S), "i", "j", "n_bands")


_SLOT = ", ".join(
    f"CAST(sum(b{k}) AS BIGINT) AS s{k}, CAST(sum(k * b{k}) AS BIGINT) AS m{k}" for k in range(11)
)


@query(
    "assemble_slot_padding",
    f"""WITH {X.PX}, sc AS (SELECT scene, k, {", ".join(
        f"coalesce(max(dn) FILTER (WHERE band = {b}), 0) AS b{b}" for b in range(11))}
    FROM px WHERE band <> 4 GROUP BY scene, k)
    SELECT CAST(2 + scene % 6 AS INTEGER) AS i, CAST(7 + scene // 6 AS INTEGER) AS j, {_SLOT} FROM sc GROUP BY 1, 2""",
)
def assemble_slot_padding(spark, sf):
    """Without the height source: its slot becomes a zero band."""
    blocks = X.px_blocks(spark, sf).where("src <> 1")
    return _sums(assemble.assemble_scenes(blocks, S, S, pad="slot"), "i", "j")


@query(
    "assemble_tail_padding",
    f"""WITH {X.PX}, sc AS (SELECT scene, k, {", ".join(
        f"coalesce(max(dn) FILTER (WHERE band = {b if b < 4 else b + 1}), 0) AS b{b}" for b in range(11))}
    FROM px WHERE band <> 4 GROUP BY scene, k)
    SELECT CAST(2 + scene % 6 AS INTEGER) AS i, CAST(7 + scene // 6 AS INTEGER) AS j, {_SLOT} FROM sc GROUP BY 1, 2""",
)
def assemble_tail_padding(spark, sf):
    """Without the height source: later bands move up, the zero band is last."""
    blocks = X.px_blocks(spark, sf).where("src <> 1")
    return _sums(assemble.assemble_scenes(blocks, S, S), "i", "j")


@query(
    "pad_missing_bands",
    f"""WITH {X.FILES} SELECT scene, CAST(sum(n_bands) AS INTEGER) AS n_real,
    CAST(11 - sum(n_bands) AS INTEGER) AS n_padded FROM files GROUP BY scene""",
)
def pad_missing_bands(spark, sf):
    sc = assemble.assemble_scenes(X.px_blocks(spark, sf), S, S)
    return sc.select(
        ((F.col("j") - 7) * 6 + F.col("i") - 2).cast("int").alias("scene"),
        F.col("n_bands").alias("n_real"),
        (F.lit(TOTAL_BANDS) - F.col("n_bands")).alias("n_padded"),
    )


@query(
    "union_sources",
    f"WITH {X.PX} SELECT CASE WHEN band <= 3 THEN 0 WHEN band = 4 THEN 1 WHEN band <= 7 THEN 2 ELSE 3 END AS src, "
    "count(*) AS cells, CAST(sum(dn) AS BIGINT) AS total FROM px GROUP BY 1",
)
def union_sources(spark, sf):
    """The four sources scanned one by one and united by column name."""
    from functools import reduce

    blocks = X.px_blocks(spark, sf)
    parts = [blocks.where(F.col("source_dir") == d) for d in X.DIRS]
    united = reduce(lambda a, b: a.unionByName(b), parts)
    return united.select("src", F.explode("cells").alias("dn")).groupBy("src").agg(
        F.count("*").alias("cells"), F.sum("dn").alias("total")
    )


@query("rekey_scenes", f"WITH {X.FILES} SELECT DISTINCT {_BOX} FROM files")
def rekey_scenes(spark, sf):
    return assemble.rekey(assemble.assemble_scenes(X.px_blocks(spark, sf), S, S)).select("extent.*")


# ------------------------------------------------------------------------- splits
def _heads(spark, sf):
    return assemble.scene_headers(assemble.file_headers(X.px_blocks(spark, sf)), S)


_SPLIT = f"""WITH {X.FILES}, {X.splits_sql()}, h AS (SELECT DISTINCT i, j, {_BOX} FROM files),
    m AS (SELECT h.*, split FROM h JOIN splits ON h.i = splits.i AND h.j = splits.j)"""


@query("assign_split", f"{_SPLIT} SELECT i, j, split FROM m")
def assign_split(spark, sf):
    return splits.assign_split(_heads(spark, sf)).select("i", "j", "split")


_EXTENTS = """SELECT n.split, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
    FROM (VALUES ('training'), ('validation'), ('test')) n(split) LEFT JOIN {m} ON n.split = m.split GROUP BY n.split"""


@query("split_extents", f"{_SPLIT} {_EXTENTS.format(m='m')}")
def split_extents(spark, sf):
    return splits.split_extents(_heads(spark, sf)).select("split", "extent.*")


@query(
    "split_extent_missing",
    f"{_SPLIT} {_EXTENTS.format(m='(SELECT * FROM m WHERE j < 13) m')}",
)
def split_extent_missing(spark, sf):
    """Scenes north of the test area only: the test extent is NULL."""
    return splits.split_extents(_heads(spark, sf).where("j < 13")).select("split", "extent.*")


@query(
    "split_attributes",
    f"""{_SPLIT}, e AS ({_EXTENTS.format(m='m')})
    SELECT 'scenes' AS layer, CAST(0 AS INTEGER) AS zoom, split || 'Extent' AS name, xmin, ymin, xmax, ymax FROM e""",
)
def split_attributes(spark, sf):
    extents = splits.split_extents(_heads(spark, sf))
    zoom0 = layers.split_attributes(extents, "scenes", 0)
    # Attributes exist at zoom 0 only, so the second part adds no row.
    return zoom0.unionByName(layers.split_attributes(extents, "scenes", 3)).select(
        "layer", "zoom", "name", "extent.*"
    )


# ------------------------------------------------------------------------- layout
_META = f"""WITH {X.FILES}, h AS (SELECT DISTINCT i, j, {_BOX} FROM files),
    b AS (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax FROM h),
    d AS (SELECT *, CAST(round((xmax - xmin) / 0.5) AS INTEGER) AS cols, CAST(round((ymax - ymin) / 0.5) AS INTEGER) AS rows FROM b)"""


@query(
    "collect_metadata",
    f"""{_META} SELECT 'scenes' AS layer, 'EPSG:32633' AS crs, 'int32' AS cell_type, xmin, ymin, xmax, ymax,
    CAST(6 AS INTEGER) AS tile_size, CAST((cols - 1) // 6 AS INTEGER) AS col_max, CAST((rows - 1) // 6 AS INTEGER) AS row_max FROM d""",
)
def collect_metadata(spark, sf):
    meta = layout.collect_metadata(_heads(spark, sf), "scenes", 6, 0, S)
    return meta.select("layer", "crs", "cell_type", "extent.*", "tile_size", "col_max", "row_max")


@query(
    "metadata_json",
    f"""{_META} SELECT 'scenes' AS layer, 'EPSG:32633' AS crs, CAST(6 AS INTEGER) AS tile_size,
    CAST((cols - 1) // 6 AS INTEGER) AS col_max, CAST((rows - 1) // 6 AS INTEGER) AS row_max,
    'DSM' AS fifth_band FROM d""",
)
def metadata_json(spark, sf):
    """The JSON text, read back field by field."""
    text = layers.metadata_json(layout.collect_metadata(_heads(spark, sf), "scenes", 6, 0, S))

    def field(path: str, kind: str = "string"):
        return F.get_json_object("json", f"$.{path}").cast(kind)

    return text.select(
        field("layer").alias("layer"), field("crs").alias("crs"),
        *[field(n, "int").alias(n) for n in ("tile_size", "col_max", "row_max")],
        field("band_names[4]").alias("fifth_band"),
    )


def _placed(spark, sf):
    """Scenes on the grid of 0.5 m cells, the grid, and the block footprints."""
    from rastertable.grid import Grid

    meta = layout.collect_metadata(_heads(spark, sf), "scenes", 6, 0, S).first()
    grid = Grid.from_meta(meta)
    sc = assemble.assemble_scenes(X.px_blocks(spark, sf), S, S)
    placed = layout.place_on_grid(sc, grid, S).withColumn("ord", F.struct("i", "j"))
    frame = layout.place_on_grid(assemble.block_frame(_heads(spark, sf), S, S), grid, S)
    return placed, grid, frame


_ALL = [f"b{k}" for k in range(11)]
_LIST = ", ".join(_ALL)
_CELLS = f"""{_META.replace("WITH ", "WITH " + X.SC.strip() + ", ", 1)},
    g AS (SELECT scene, 2 + scene % 6 AS i, 7 + scene // 6 AS j, x, y, {_LIST} FROM sc),
    p AS (SELECT i, j, (j - 7) * 8 + x AS gx,
          CAST(round((d.ymax - round(5808000.06 - 4 * i, 1)) / 0.5) AS INTEGER) + y AS gy, {_LIST} FROM g, d)"""


@query(
    "tile_to_layout",
    f"""{_CELLS} SELECT CAST(gx // 6 AS INTEGER) AS col, CAST(gy // 6 AS INTEGER) AS row, count(*) AS n,
    {", ".join(f"CAST(sum({b} * (gy % 6 * 6 + gx % 6)) AS BIGINT) AS c{b[1:]}" for b in _ALL)} FROM p GROUP BY 1, 2""",
)
def tile_to_layout(spark, sf):
    """Scenes of 8 x 8 cells cut to tiles of 6 x 6, across scene borders."""
    placed, grid, frame = _placed(spark, sf)
    tiles = layout.tile_to_layout(placed, grid, "ord", footprint=frame)
    flat = exploded(tiles.select("col", "row", *_ALL), *_ALL).where("b0 IS NOT NULL")
    return flat.groupBy("col", "row").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(b).cast("bigint") * F.col("k")).alias(f"c{b[1:]}") for b in _ALL],
    )


@query(
    "merge_overlap",
    f"""{_CELLS}, o AS (SELECT i, j, 0 AS s, gx, gy, {_LIST} FROM p UNION ALL SELECT i, j, 1, gx + 3, gy + 2, {_LIST} FROM p),
    q AS (SELECT gx, gy, {", ".join(f"CASE WHEN {b} % 5 = 0 THEN NULL ELSE {b} END AS {b}" for b in _ALL)}, s * 1000000 + i * 1000 + j AS ord FROM o),
    r AS (SELECT gx, gy, {", ".join(f"arg_min({b}, ord) FILTER (WHERE {b} IS NOT NULL) AS {b}" for b in _ALL)} FROM q GROUP BY gx, gy)
    SELECT CAST(gx // 6 AS INTEGER) AS col, CAST(gy // 6 AS INTEGER) AS row,
    {", ".join(f"count({b}) AS n{b[1:]}, CAST(sum({b} * (gy % 6 * 6 + gx % 6)) AS BIGINT) AS c{b[1:]}" for b in _ALL)} FROM r GROUP BY 1, 2""",
)
def merge_overlap(spark, sf):
    """Every scene twice, the copy moved by (3, 2): in each band the first data cell wins."""
    placed, grid, _ = _placed(spark, sf)
    holes = placed.select(
        "i", "j", "x0", "y0", "cols", "rows",
        *[F.transform(b, lambda v: F.when(v % 5 != 0, v)).alias(b) for b in _ALL],
    )
    moved = holes.withColumns({"x0": F.col("x0") + 3, "y0": F.col("y0") + 2})
    both = holes.withColumn("s", F.lit(0)).unionByName(moved.withColumn("s", F.lit(1)))
    tiles = layout.tile_to_layout(both.withColumn("ord", F.struct("s", "i", "j")), grid, "ord")
    flat = exploded(tiles.select("col", "row", *_ALL), *_ALL)
    return flat.groupBy("col", "row").agg(
        *[F.count(b).alias(f"n{b[1:]}") for b in _ALL],
        *[F.sum(F.col(b).cast("bigint") * F.col("k")).alias(f"c{b[1:]}") for b in _ALL],
    )
