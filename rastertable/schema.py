"""Fixed table schemas and the constants of the scene data model.

Bands are separate columns (``b0 .. bN``), so choosing bands is plain column
pruning.  A band column holds a row-major array (``k = row * cols + col``,
row 0 is north).  NoData is a NULL element, never a sentinel value.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Number of bands delivered by each of the four sources, in source order:
# red/green/blue/infrared, surface height, labels, labels without boundary.
SOURCE_BANDS = (4, 1, 3, 3)
TOTAL_BANDS = 11
BAND_NAMES = ("R", "G", "B", "IR", "DSM", "L0", "L1", "L2", "LNB0", "LNB1", "LNB2")

# Side of an assembled scene in cells.
SCENE_SIZE = 6000

# Storage tile side of the floating and of the zoomed layout.
FLOATING_TILE = 512
ZOOMED_TILE = 256

# Scenes (i, j) of each split.
TRAINING = (
    (2, 10), (3, 10), (3, 11), (3, 12), (4, 11), (4, 12), (5, 10), (5, 12), (6, 10),
    (6, 11), (6, 12), (6, 8), (6, 9), (7, 11), (7, 12), (7, 7), (7, 9),
)
VALIDATION = ((2, 11), (2, 12), (4, 10), (5, 11), (6, 7), (7, 10), (7, 8))
TEST = (
    (2, 13), (2, 14), (3, 13), (3, 14), (4, 13), (4, 14), (4, 15), (5, 13), (5, 14),
    (5, 15), (6, 13), (6, 14), (6, 15), (7, 13),
)
# ------------------------------------------------------------------------------

SPLITS = {"training": TRAINING, "validation": VALIDATION, "test": TEST}

EXTENT = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")]
)


def scene_block_schema(cell: T.DataType = T.IntegerType()) -> T.StructType:
    """One row per (file, band, block); ``cells`` covers the block only."""
    return T.StructType(
        [
            T.StructField("source_dir", T.StringType()),
            T.StructField("file_name", T.StringType()),
            T.StructField("crs", T.StringType()),
            T.StructField("extent", EXTENT),
            T.StructField("band", T.IntegerType()),
            T.StructField("cell_type", T.StringType()),
            T.StructField("cols", T.IntegerType()),
            T.StructField("rows", T.IntegerType()),
            T.StructField("block_x", T.IntegerType()),
            T.StructField("block_y", T.IntegerType()),
            T.StructField("cells", T.ArrayType(cell)),
        ]
    )


LAYER_META = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("zoom", T.IntegerType()),
        T.StructField("crs", T.StringType()),
        T.StructField("cell_type", T.StringType()),
        T.StructField("extent", EXTENT),
        T.StructField("layout_extent", EXTENT),
        T.StructField("tile_size", T.IntegerType()),
        T.StructField("cell_w", T.DoubleType()),
        T.StructField("cell_h", T.DoubleType()),
        T.StructField("col_min", T.IntegerType()),
        T.StructField("col_max", T.IntegerType()),
        T.StructField("row_min", T.IntegerType()),
        T.StructField("row_max", T.IntegerType()),
        T.StructField("band_names", T.ArrayType(T.StringType())),
    ]
)

LAYER_ATTRS = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("zoom", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("extent", EXTENT),
    ]
)

_BAND = re.compile(r"b(\d+)$")


def band_columns(df: DataFrame) -> list[str]:
    """Names of the band columns of ``df`` in band order."""
    found = [c for c in df.columns if _BAND.match(c)]
    return sorted(found, key=lambda c: int(c[1:]))


def cell_sql_type(df: DataFrame, column: str) -> str:
    """SQL type of one cell of a band column (array element or scalar)."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype.simpleString()
