"""Reading raw scene sources: block tables, one directory per source.

A source table has one row per (file, band, block), so no task ever holds a
whole scene.  The order of the paths fixes the order of the bands.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertable.functions.geo import round_extent
from rastertable.functions.tiles import crop_cells
from rastertable.schema import scene_block_schema

# A scene key in a file name: two numbers joined by an underscore (fixed value).
SCENE_KEY = r"(\d+)_(\d+)"

# Cell types of sources and the names that metadata has for them (fixed values).
CELL_NAMES = {
    "tinyint": "int8", "smallint": "int16", "int": "int32", "float": "float32", "double": "float64",
}


def split_paths(paths: str | Sequence[str]) -> list[str]:
    """Non-blank entries of a comma-separated path list."""
    items = paths.split(",") if isinstance(paths, str) else list(paths)
    return [p.strip() for p in items if p.strip()]


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def source_order(paths: str | Sequence[str]) -> list[tuple[str, int]]:
    """(directory base name, position) of every non-blank path."""
    return [(base_name(p), k) for k, p in enumerate(split_paths(paths))]


def source_ordinal(directory: Column, paths: str | Sequence[str]) -> Column:
    """Position of a row's source directory in the path list.

    The list is an argument, so this is a literal lookup and needs no join.
    Base names are compared, which makes full URIs work too; a directory that
    is not listed is an error.
    """
    names = F.array(*[F.lit(n) for n, _ in source_order(paths)])
    last = F.element_at(F.split(F.rtrim(directory, F.lit("/")), "/"), -1)
    pos = F.array_position(names, last).cast("int") - 1
    return F.when(pos >= 0, pos).otherwise(
        F.raise_error(F.concat(F.lit("unknown source directory: "), directory)).cast("int")
    )


def split_path_column(paths: Column) -> Column:
    """Non-blank entries of a comma-separated path-list column."""
    return F.filter(F.split(paths, ","), lambda p: F.trim(p) != "")


def parent_dir(path: Column) -> Column:
    """Name of the directory that holds a file."""
    return F.element_at(F.split(path, "/"), -2)


def parse_scene_key(df: DataFrame, name: str = "file_name", on_bad: str = "error") -> DataFrame:
    """Add ``i``/``j`` from the single number pair in the file name.

    A name with none or several pairs is an error, or is dropped with
    ``on_bad='drop'``.
    """
    file_name = F.col(name)

    def part(group: int) -> Column:
        return F.regexp_extract(file_name, SCENE_KEY, group).try_cast("int")

    good = (
        (F.regexp_count(file_name, F.lit(SCENE_KEY)) == 1)
        & part(1).isNotNull()
        & part(2).isNotNull()
    )
    if on_bad == "drop":
        return df.where(good).withColumns({"i": part(1), "j": part(2)})
    if on_bad != "error":
        raise ValueError("on_bad must be 'error' or 'drop'")
    bad = F.raise_error(
        F.concat(F.lit("file name without exactly one number pair: "), file_name)
    ).cast("int")
    return df.withColumns(
        {"i": F.when(good, part(1)).otherwise(bad), "j": F.when(good, part(2)).otherwise(bad)}
    )


def stored_cell(spark: SparkSession, path: str) -> T.DataType:
    """Cell type of one source's files, from a file footer; other than numbers is an error."""
    stored = spark.read.parquet(path).schema["cells"].dataType
    cell = stored.elementType if isinstance(stored, T.ArrayType) else stored
    if cell.simpleString() not in CELL_NAMES:
        raise ValueError(f"cells of {path} are {stored.simpleString()}")
    return cell


def common_cell(cells: Sequence[T.DataType]) -> T.DataType:
    """The type that holds the cells of all sources exactly: int, float or double."""
    names = {c.simpleString() for c in cells}
    if not names & {"float", "double"}:
        return T.IntegerType()
    # Not every int is a float of 32 bits; bytes and shorts are.
    return T.DoubleType() if names & {"double", "int"} else T.FloatType()


def read_scenes(
    spark: SparkSession,
    paths: str | Sequence[str],
    crs: str | None = None,
    partitions: int | None = None,
    max_block: int | None = None,
    on_bad: str = "error",
    cell: T.DataType | None = None,
) -> DataFrame:
    """Scan and union the sources; adds ``src`` and the scene key ``i``/``j``.

    ``crs`` overrides the stored CRS, ``partitions`` sets the read parallelism
    and ``max_block`` cuts larger blocks at read time.  Cells get the one type
    that holds those of all sources, or ``cell``.  Floating cells have a cell
    type named after it, and their NaN is NoData.
    """
    listed = split_paths(paths)
    if not listed:
        raise ValueError("no source path given")
    stored = [stored_cell(spark, p) for p in listed]
    cell = common_cell(stored) if cell is None else cell
    parts = [
        spark.read.schema(
            T.StructType([f for f in scene_block_schema(own) if f.name != "source_dir"])
        ).parquet(p).withColumns({"source_dir": F.lit(base_name(p)), "src": F.lit(k)})
        for k, (p, own) in enumerate(zip(listed, stored))
    ]
    if isinstance(cell, (T.FloatType, T.DoubleType)):
        parts = [
            df.withColumns({"cells": float_cells(cell), "cell_type": F.lit(CELL_NAMES[cell.simpleString()])})
            for df in parts
        ]
    else:
        parts = [
            df if own == cell else df.withColumn("cells", F.col("cells").cast(T.ArrayType(cell)))
            for df, own in zip(parts, stored)
        ]
    df = reduce(DataFrame.unionByName, parts)
    if crs is not None:
        df = df.withColumn("crs", F.lit(crs))
    if max_block is not None:
        df = reblock(df, max_block)
    if partitions is not None:
        df = df.repartition(partitions)
    df = df.withColumn("extent", round_extent(F.col("extent")))
    return parse_scene_key(df, on_bad=on_bad)


def float_cells(cell: T.DataType) -> Column:
    """``cells`` as floating numbers; NaN becomes NULL."""
    return F.transform(
        F.col("cells").cast(T.ArrayType(cell)), lambda v: F.when(~F.isnan(v), v)
    )


def reblock(blocks: DataFrame, size: int) -> DataFrame:
    """Cut whole bands (block 0, 0) into blocks of at most ``size`` x ``size``.

    Narrow: every block is sliced where its band is read.
    """
    whole = blocks.withColumns(
        {
            "_bx": F.explode(F.sequence(F.lit(0), F.floor((F.col("cols") - 1) / size).cast("int"))),
        }
    ).withColumn(
        "_by", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / size).cast("int")))
    )
    w = F.least(F.lit(size), F.col("cols") - F.col("_bx") * size)
    h = F.least(F.lit(size), F.col("rows") - F.col("_by") * size)
    only_whole = F.assert_true(
        (F.col("block_x") == 0) & (F.col("block_y") == 0), "reblock needs whole bands"
    )
    cut = whole.withColumns(
        {
            "cells": F.when(
                only_whole.isNull(),
                crop_cells(
                    F.col("cells"), F.col("cols"), F.col("_bx") * size, F.col("_by") * size, w, h
                ),
            ),
            "_w": w,
            "_h": h,
        }
    )
    return cut.drop("cols", "rows", "block_x", "block_y").withColumnsRenamed(
        {"_w": "cols", "_h": "rows", "_bx": "block_x", "_by": "block_y"}
    )
