"""Tile layers on any Hadoop file system: tiles, metadata and attributes.

Every layer and zoom has directories of its own: ``tiles/layer=../zoom=../``,
and the same below ``meta/`` and ``attrs/``.  So layers of different bands and
cell types share a catalog, a scan lists only its own files, and a layer can be
replaced alone.  The metadata row is written last: it is the commit mark, and
without it a layer cannot be read.  The scheme of the path (``file:``,
``hdfs:``, ``s3a:``) chooses the store.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rastertable.grid import zorder
from rastertable.schema import LAYER_ATTRS, LAYER_META


def _at(catalog: str, part: str, layer: str, zoom: int) -> str:
    return f"{catalog.rstrip('/')}/{part}/layer={quote(layer, safe='')}/zoom={zoom}"


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at ``path``; empty if nothing was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def begin_layer(spark: SparkSession, catalog: str, layer: str, zoom: int, mode: str = "error") -> None:
    """Make way for a layer: an existing one is an error, or loses its commit mark (``overwrite``)."""
    if mode not in ("error", "overwrite"):
        raise ValueError("mode must be 'error' or 'overwrite'")
    if layer_meta(spark, catalog, layer, zoom).isEmpty():
        return
    if mode == "error":
        raise FileExistsError(f"layer {layer} at zoom {zoom} exists")
    spark.createDataFrame([], LAYER_META).write.mode("overwrite").parquet(_at(catalog, "meta", layer, zoom))


def write_layer(
    tiles: DataFrame, catalog: str, layer: str, zoom: int, clustered: bool = False, mode: str = "error"
) -> None:
    """Write the tiles of one layer and zoom in Z-order, so row groups and files prune key ranges.

    Tiles that are already partitioned by ranges of z are only sorted, not
    shuffled again: pass ``clustered=True``.  A layer that was committed before
    is an error or, with ``mode="overwrite"``, replaced; what a failed run left
    is always replaced.  ``write_metadata`` commits the layer.
    """
    begin_layer(tiles.sparkSession, catalog, layer, zoom, mode)
    out = tiles if "z" in tiles.columns else tiles.withColumn("z", zorder(F.col("col"), F.col("row")))
    out = out.drop("layer", "zoom")
    if not clustered:
        out = out.repartitionByRange("z")
    out.sortWithinPartitions("z").write.mode("overwrite").parquet(_at(catalog, "tiles", layer, zoom))


def write_metadata(meta: DataFrame, catalog: str, layer: str, zoom: int) -> None:
    """Write the one metadata row of a layer, which commits it."""
    meta.to(LAYER_META).coalesce(1).write.mode("overwrite").parquet(_at(catalog, "meta", layer, zoom))


def split_attributes(extents: DataFrame, layer: str, zoom: int) -> DataFrame:
    """(layer, zoom, "<split>Extent", extent) rows; only for zoom 0."""
    return extents.select(
        F.lit(layer).alias("layer"),
        F.lit(zoom).alias("zoom"),
        F.concat("split", F.lit("Extent")).alias("name"),
        "extent",
    ).where(F.col("zoom") == 0)


def write_attributes(extents: DataFrame, catalog: str, layer: str, zoom: int) -> None:
    """Store the split extents as layer attributes, if ``zoom`` is 0."""
    if zoom == 0:
        attrs = split_attributes(extents, layer, zoom)
        attrs.to(LAYER_ATTRS).coalesce(1).write.mode("overwrite").parquet(_at(catalog, "attrs", layer, zoom))


def read_tiles(spark: SparkSession, catalog: str, layer: str, zoom: int) -> DataFrame:
    """The tiles of one layer and zoom, committed or not; the schema is the layer's own."""
    tiles = spark.read.parquet(_at(catalog, "tiles", layer, zoom))
    return tiles.withColumns({"layer": F.lit(layer), "zoom": F.lit(zoom)})


def read_layer(spark: SparkSession, catalog: str, layer: str, zoom: int) -> DataFrame:
    """Scan one committed layer; any other is an error."""
    layer_meta_row(spark, catalog, layer, zoom)
    return read_tiles(spark, catalog, layer, zoom)


def layer_meta(spark: SparkSession, catalog: str, layer: str, zoom: int) -> DataFrame:
    return _table(spark, _at(catalog, "meta", layer, zoom), LAYER_META)


def layer_meta_row(spark: SparkSession, catalog: str, layer: str, zoom: int) -> Row:
    """The single metadata row of a layer; an unknown layer is an error."""
    row = layer_meta(spark, catalog, layer, zoom).first()
    if row is None:
        raise LookupError(f"no layer {layer} at zoom {zoom}")
    return row


def layer_attrs(spark: SparkSession, catalog: str, layer: str, zoom: int) -> DataFrame:
    return _table(spark, _at(catalog, "attrs", layer, zoom), LAYER_ATTRS)


def split_extent(
    spark: SparkSession, catalog: str, layer: str, zoom: int, split: str
) -> tuple[float, float, float, float]:
    """Extent of a split, or of the whole layer for any other name.

    Attributes are stored at zoom 0 and hold for every zoom of the layer.  A
    split attribute that is missing or empty is an error.
    """
    if split in ("training", "validation", "test"):
        row = layer_attrs(spark, catalog, layer, 0).where(
            F.col("name") == f"{split}Extent"
        ).first()
        if row is None or row["extent"] is None:
            raise LookupError(f"there is no {split}Extent attribute for {layer}")
        return tuple(row["extent"])
    return tuple(layer_meta_row(spark, catalog, layer, zoom)["extent"])


def metadata_json(meta: DataFrame) -> DataFrame:
    """Layer metadata as JSON text."""
    return meta.select(F.to_json(F.struct(*[F.col(c) for c in meta.columns])).alias("json"))
