"""Random flips and quarter turns of sample windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertable.functions.batches import map_bands, oriented
from rastertable.operators.windows import Uniform
from rastertable.schema import band_columns


def augment_choice(ident: Column, uniform: Uniform) -> dict[str, Column]:
    """``flip_v``/``flip_h`` with probability 1/2, ``turns`` uniform over 0..4.

    Four turns are the identity like none, so it comes up in 2 of 5 draws.
    """
    return {
        "flip_v": uniform(ident, 3) > 0.5,
        "flip_h": uniform(ident, 4) > 0.5,
        "turns": F.floor(uniform(ident, 5) * 5).cast("int"),
    }


def augment(chips: DataFrame, uniform: Uniform, ident: str = "window_id") -> DataFrame:
    """Flip and turn whole chips by choices drawn from ``ident``."""
    chosen = chips.withColumns(augment_choice(F.col(ident), uniform))
    return orient_chips(chosen)


def orient_chips(chips: DataFrame) -> DataFrame:
    """Apply ``flip_v``, ``flip_h``, ``turns`` to every band; the extent stays."""
    odd = F.pmod("turns", F.lit(2)) == 1
    size = {
        "cols": F.when(odd, F.col("rows")).otherwise(F.col("cols")),
        "rows": F.when(odd, F.col("cols")).otherwise(F.col("rows")),
    }
    return _turned(chips, "cols", "rows").withColumns(size)


def _turned(chips: DataFrame, cols: str, rows: str) -> DataFrame:
    """All bands flipped and turned in one Arrow step."""
    inputs = {c: F.col(c) for c in (cols, rows, "flip_v", "flip_h", "turns")}
    return map_bands(chips, band_columns(chips), inputs, oriented)


def orient_pieces(pieces: DataFrame) -> DataFrame:
    """The same on unstitched pieces: each is turned and moved to its new place.

    Lets chips of any size be augmented without ever joining their pieces.
    """
    cols = F.col("x1") - F.col("x0") + 1
    rows = F.col("y1") - F.col("y0") + 1
    turns = F.pmod("turns", F.lit(4))
    odd = (turns % 2) == 1
    # Position after the two flips.
    fx = F.when(F.col("flip_v"), cols - F.col("px") - F.col("w")).otherwise(F.col("px"))
    fy = F.when(F.col("flip_h"), rows - F.col("py") - F.col("h")).otherwise(F.col("py"))
    px = (
        F.when(turns == 1, fy)
        .when(turns == 2, cols - fx - F.col("w"))
        .when(turns == 3, rows - fy - F.col("h"))
        .otherwise(fx)
    )
    py = (
        F.when(turns == 1, cols - fx - F.col("w"))
        .when(turns == 2, rows - fy - F.col("h"))
        .when(turns == 3, fx)
        .otherwise(fy)
    )
    moved = {
        "px": px.cast("int"), "py": py.cast("int"),
        "w": F.when(odd, F.col("h")).otherwise(F.col("w")),
        "h": F.when(odd, F.col("w")).otherwise(F.col("h")),
    }
    return _turned(pieces, "w", "h").withColumns(moved)
