"""Display values: colour composites and colour classes (no image encoding)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertable.functions import cells as C
from rastertable.functions.tiles import combine_cells, map_cells


def true_color(df: DataFrame, u16: bool) -> DataFrame:
    """Add ``r``, ``g``, ``b`` display values of bands 0, 1, 2.

    16-bit layers are stretched from the display range; 8-bit layers are
    blanked where band 3 is 0.  Then brightness, gamma and contrast apply.
    Works on pixels and on tiles.
    """
    tile = isinstance(df.schema["b0"].dataType, T.ArrayType)
    out = {}
    for name, band in (("r", "b0"), ("g", "b1"), ("b", "b2")):
        if tile and u16:
            out[name] = map_cells(F.col(band), lambda v: C.adjust_lookup(C.stretch_u16(v)))
        elif tile:
            out[name] = combine_cells(
                lambda v, m: C.adjust_lookup(C.apply_mask(v, m)), F.col(band), F.col("b3")
            )
        else:
            v = C.stretch_u16(F.col(band)) if u16 else C.apply_mask(F.col(band), F.col("b3"))
            out[name] = C.adjust(v)
    return df.withColumns(out)


def color_classes(df: DataFrame, value: str, breaks: C.Breaks, out: str = "rgba") -> DataFrame:
    """Add the class colour (0xRRGGBBAA) of a value column, cell by cell."""
    if isinstance(df.schema[value].dataType, T.ArrayType):
        return df.withColumn(out, map_cells(F.col(value), lambda v: C.classify(v, breaks)))
    return df.withColumn(out, C.classify(F.col(value), breaks))


def class_counts(df: DataFrame, value: str, breaks: C.Breaks) -> DataFrame:
    """Cells per class: (class, rgba, n); cells without a class under NULL."""
    return (
        df.select(
            C.class_index(F.col(value), breaks).alias("class"),
            C.classify(F.col(value), breaks).alias("rgba"),
        )
        .groupBy("class", "rgba")
        .agg(F.count(F.lit(1)).alias("n"))
    )
