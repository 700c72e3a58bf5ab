"""Georeferenced cell grid: the address arithmetic shared by every operator."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, Row
from pyspark.sql import functions as F

# Half the side of the spherical-Mercator world square in metres (fixed value).
WORLD_HALF = 20037508.342789244


@dataclass(frozen=True)
class Grid:
    """Top-left origin, cell size and tile side; row 0 is the northern row.

    ``width``/``height`` (in cells) clamp crops to the layer; None = unbounded.
    """

    ox: float
    oy: float
    cw: float
    ch: float
    tile: int
    width: int | None = None
    height: int | None = None
    crs: str = "EPSG:32633"

    @staticmethod
    def from_meta(meta: Row) -> "Grid":
        """Grid of a stored layer, from its single metadata row."""
        box = meta["extent"]
        lay = meta["layout_extent"]
        cw, ch = meta["cell_w"], meta["cell_h"]
        return Grid(
            lay["xmin"], lay["ymax"], cw, ch, meta["tile_size"],
            round((box["xmax"] - lay["xmin"]) / cw),
            round((lay["ymax"] - box["ymin"]) / ch),
            meta["crs"],
        )

    @staticmethod
    def zoomed(zoom: int, tile: int = 256) -> "Grid":
        """Power-of-two web grid of one zoom level."""
        cell = 2 * WORLD_HALF / (tile * 2**zoom)
        side = tile * 2**zoom
        return Grid(-WORLD_HALF, WORLD_HALF, cell, cell, tile, side, side, "EPSG:3857")

    @staticmethod
    def zoom_for(cell: float, tile: int = 256, max_zoom: int = 30) -> int:
        """Coarsest zoom whose cells are no larger than ``cell`` metres.

        Cells finer than those of ``max_zoom`` are an error.
        """
        z = math.ceil(math.log2(2 * WORLD_HALF / (tile * cell)))
        if z > max_zoom:
            raise ValueError(f"cells of {cell} need zoom {z}, beyond {max_zoom}")
        return max(0, z)

    @property
    def extent(self) -> tuple[float, float, float, float]:
        return (
            self.ox, self.oy - self.height * self.ch,
            self.ox + self.width * self.cw, self.oy,
        )

    # -- map coordinates -> cells ------------------------------------------------
    def x_of(self, mx) -> Column:
        return F.floor((mx - F.lit(self.ox)) / F.lit(self.cw)).cast("bigint")

    def y_of(self, my) -> Column:
        return F.floor((F.lit(self.oy) - my) / F.lit(self.ch)).cast("bigint")

    def crop_bounds(self, xmin, ymin, xmax, ymax) -> dict[str, Column]:
        """Inclusive cell bounds of an extent, clamped to the layer.

        x0 = floor((xmin-ox)/cw), x1 = ceil((xmax-ox)/cw)-1, likewise from the
        top for y.
        """
        ox, oy, cw, ch = (F.lit(v) for v in (self.ox, self.oy, self.cw, self.ch))
        x0 = F.floor((xmin - ox) / cw).cast("bigint")
        x1 = (F.ceil((xmax - ox) / cw) - 1).cast("bigint")
        y0 = F.floor((oy - ymax) / ch).cast("bigint")
        y1 = (F.ceil((oy - ymin) / ch) - 1).cast("bigint")
        zero = F.lit(0).cast("bigint")
        x0, y0 = F.greatest(x0, zero), F.greatest(y0, zero)
        if self.width is not None:
            x1 = F.least(x1, F.lit(self.width - 1).cast("bigint"))
        if self.height is not None:
            y1 = F.least(y1, F.lit(self.height - 1).cast("bigint"))
        return {"x0": x0, "y0": y0, "x1": x1, "y1": y1}

    def bounds_of(self, xmin: float, ymin: float, xmax: float, ymax: float):
        """The same rule for plain numbers (query parameters)."""
        x0 = max(0, math.floor((xmin - self.ox) / self.cw))
        x1 = math.ceil((xmax - self.ox) / self.cw) - 1
        y0 = max(0, math.floor((self.oy - ymax) / self.ch))
        y1 = math.ceil((self.oy - ymin) / self.ch) - 1
        if self.width is not None:
            x1 = min(x1, self.width - 1)
        if self.height is not None:
            y1 = min(y1, self.height - 1)
        return x0, y0, x1, y1

    # -- cells -> map coordinates ------------------------------------------------
    def centre_x(self, x) -> Column:
        return F.lit(self.ox) + (x + F.lit(0.5)) * F.lit(self.cw)

    def centre_y(self, y) -> Column:
        return F.lit(self.oy) - (y + F.lit(0.5)) * F.lit(self.ch)

    # -- tile keys ---------------------------------------------------------------
    def key_extent(self, col, row) -> Column:
        """Map extent of a tile key."""
        tw, th = F.lit(self.tile * self.cw), F.lit(self.tile * self.ch)
        return F.struct(
            (F.lit(self.ox) + col * tw).alias("xmin"),
            (F.lit(self.oy) - (row + F.lit(1)) * th).alias("ymin"),
            (F.lit(self.ox) + (col + F.lit(1)) * tw).alias("xmax"),
            (F.lit(self.oy) - row * th).alias("ymax"),
        )

    def key_of(self, mx, my) -> tuple[Column, Column]:
        """Tile key that holds a map point."""
        col = F.floor((mx - F.lit(self.ox)) / F.lit(self.tile * self.cw))
        row = F.floor((F.lit(self.oy) - my) / F.lit(self.tile * self.ch))
        return col.cast("int"), row.cast("int")


def zorder(col: Column, row: Column) -> Column:
    """Morton code of a tile key: column bits even, row bits odd.

    The binary digits of a number read in base 4 are its bits spread to the
    even positions.  Unlike the usual masked shifts this form names its input
    once, so it stays small wherever the optimizer copies it.
    """

    def spread(v: Column) -> Column:
        return F.conv(F.bin(v), 4, 10).cast("bigint")

    return spread(col) + spread(row) * 2


def zorder_of(col: int, row: int) -> int:
    """Morton code of a literal key (for lookups)."""
    z = 0
    for bit in range(31):
        z |= ((col >> bit) & 1) << (2 * bit) | ((row >> bit) & 1) << (2 * bit + 1)
    return z
