"""Ingest job: raw sources -> scenes -> tile layer with split extents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertable.functions.geo import reproject_rings
from rastertable.grid import Grid
from rastertable.operators.assemble import (
    assemble_scenes, block_frame, file_headers, scene_headers,
)
from rastertable.operators.layout import (
    collect_metadata, place_on_grid, pyramid_level, reproject_nn, target_keys_for, tile_to_layout,
)
from rastertable.operators.splits import split_extents
from rastertable.schema import BAND_NAMES, FLOATING_TILE, SCENE_SIZE, TOTAL_BANDS, band_columns
from rastertable.session import large_tiles
from rastertable.sources import layers
from rastertable.sources.scenes import read_scenes


def ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    catalog: str,
    layer: str,
    tile: int = FLOATING_TILE,
    block_size: int = FLOATING_TILE,
    scene_size: int = SCENE_SIZE,
    total_bands: int = TOTAL_BANDS,
    crs: str | None = None,
    partitions: int | None = None,
    max_block: int | None = None,
    band_names: Sequence[str] = BAND_NAMES,
    pad: str = "tail",
    mode: str = "error",
) -> None:
    """Floating layout at zoom 0: tiles, the three split extents, then metadata.

    Extents and metadata come from header rows; the cell data is read once and
    shuffled twice (by scene block, by Z-order cell).  An existing layer is an
    error unless ``mode`` is ``overwrite``; a failed run leaves no readable one.
    """
    layers.begin_layer(spark, catalog, layer, 0, mode)
    blocks = read_scenes(spark, paths, crs, partitions, max_block)
    headers = scene_headers(file_headers(blocks), scene_size)
    meta = spark.createDataFrame(
        [collect_metadata(headers, layer, tile, 0, scene_size, band_names).first()],
        schema=layers.LAYER_META,
    )
    grid = Grid.from_meta(meta.first())
    scenes = assemble_scenes(blocks, block_size, scene_size, total_bands, pad)
    # Later scenes in (i, j) order yield to earlier ones where scenes overlap.
    placed = place_on_grid(scenes, grid, scene_size).withColumn(
        "ord", F.struct("i", "j", "block_x", "block_y")
    )
    footprint = place_on_grid(block_frame(headers, block_size, scene_size), grid, scene_size)
    tiles = tile_to_layout(placed, grid, "ord", footprint=footprint)
    with large_tiles(spark):
        layers.write_layer(tiles, catalog, layer, 0, clustered=True)
    layers.write_attributes(split_extents(headers), catalog, layer, 0)
    layers.write_metadata(meta, catalog, layer, 0)


def build_zoomed(
    spark: SparkSession,
    catalog: str,
    layer: str,
    target: str,
    tile: int = 256,
    zoom: int | None = None,
    pyramid: bool = True,
    mode: str = "error",
) -> int:
    """Web-grid copy of a floating layer, with overviews down to zoom 0.

    Returns the base zoom.  Each level is written before the next one reads it,
    so no level recomputes another.  The split extents go to zoom 0, in the web
    grid's coordinates.
    """
    meta = layers.layer_meta_row(spark, catalog, layer, 0)
    source = Grid.from_meta(meta)
    if zoom is None:
        zoom = Grid.zoom_for(source.cw, tile)
    tiles = layers.read_layer(spark, catalog, layer, 0)
    grid = Grid.zoomed(zoom, tile)
    keys = target_keys_for(tiles, source, grid)
    out = reproject_nn(tiles, source, grid, keys)
    levels = range(zoom, -1, -1) if pyramid else [zoom]
    for z in levels:
        layers.begin_layer(spark, catalog, target, z, mode)
    layers.write_attributes(_web_extents(spark, catalog, layer, meta["crs"]), catalog, target, 0)
    layers.write_layer(out, catalog, target, zoom)
    _zoomed_meta(spark, catalog, target, zoom, tile, meta)
    for z in levels[1:]:
        above = layers.read_layer(spark, catalog, target, z + 1)
        level = pyramid_level(above.select("col", "row", "z", *band_columns(above)), tile, 1)
        layers.write_layer(level, catalog, target, z, clustered=True)
        _zoomed_meta(spark, catalog, target, z, tile, meta)
    return zoom


def _web_extents(spark: SparkSession, catalog: str, layer: str, crs: str) -> DataFrame:
    """(split, extent) of a layer on the web grid: the boxes of the projected corners."""
    rows = []
    for r in layers.layer_attrs(spark, catalog, layer, 0).collect():
        box = r["extent"]
        if box is not None:
            ring = [[x, y] for x in (box["xmin"], box["xmax"]) for y in (box["ymin"], box["ymax"])]
            (points,) = reproject_rings([ring], crs, "EPSG:3857")
            xs, ys = zip(*points)
            box = (min(xs), min(ys), max(xs), max(ys))
        rows.append((r["name"].removesuffix("Extent"), box))
    return spark.createDataFrame(rows, "split string, extent struct<xmin:double,ymin:double,xmax:double,ymax:double>")


def _zoomed_meta(spark, catalog, layer, zoom, tile, base) -> None:
    grid = Grid.zoomed(zoom, tile)
    keys = layers.read_tiles(spark, catalog, layer, zoom).agg(
        *[F.expr(f"{f}({c}) AS {c}_{f}") for c in ("col", "row") for f in ("min", "max")]
    ).first()
    side = tile * grid.cw
    world = (grid.ox, -grid.oy, -grid.ox, grid.oy)
    box = (
        grid.ox + keys["col_min"] * side, grid.oy - (keys["row_max"] + 1) * side,
        grid.ox + (keys["col_max"] + 1) * side, grid.oy - keys["row_min"] * side,
    )
    row = (
        layer, zoom, grid.crs, base["cell_type"], box, world, tile, grid.cw, grid.ch,
        keys["col_min"], keys["col_max"], keys["row_min"], keys["row_max"], base["band_names"],
    )
    layers.write_metadata(spark.createDataFrame([row], layers.LAYER_META), catalog, layer, zoom)
