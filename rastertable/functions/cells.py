"""Cell formulas as ``Column -> Column`` builders.

The same builder serves the pixel form (scalar columns, whole-stage codegen)
and the tile form (inside ``transform``/``zip_with`` lambdas on band arrays).
NULL is NoData and stays NULL unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# 16-bit display range, brightness, gamma and contrast of the colour composite.
DISPLAY_MIN, DISPLAY_MAX = 4000, 15176
BRIGHTNESS = 15
GAMMA = 0.8
CONTRAST = 30.0

# Colour classes: upper limit (inclusive) -> RRGGBBAA.
NDVI_BREAKS = (
    (0.05, "ffffe5aa"), (0.1, "f7fcb9ff"), (0.2, "d9f0a3ff"), (0.3, "addd8eff"),
    (0.4, "78c679ff"), (0.5, "41ab5dff"), (0.6, "238443ff"), (0.7, "006837ff"),
    (1.0, "004529ff"),
)
NDWI_BREAKS = (
    (0.0, "aacdff44"), (0.1, "70abffff"), (0.2, "3086ffff"), (0.3, "1269e2ff"),
    (0.4, "094aa5ff"), (1.0, "012c69ff"),
)
NDVI_DIFF_BREAKS = (
    (-0.6, "FF4040FF"), (-0.5, "FF5353FF"), (-0.4, "FF6666FF"), (-0.3, "FF7979FF"),
    (-0.2, "FF8C8CFF"), (-0.1, "FF9F9FFF"), (0.0, "709AB244"), (0.1, "81D3BBFF"),
    (0.2, "67CAAEFF"), (0.3, "4EC2A0FF"), (0.4, "35B993FF"), (0.5, "1CB085FF"),
    (0.6, "03A878FF"),
)
WATER_DIFF_BREAKS = (
    (0.2, "aacdff44"), (0.3, "1269e2ff"), (0.4, "094aa5ff"), (1.0, "012c69ff"),
)
# ------------------------------------------------------------------------------

Breaks = Sequence[tuple[float, str]]


def _ratio(plus: Column, minus: Column) -> Column:
    plus, minus = plus.cast("double"), minus.cast("double")
    return F.try_divide(plus - minus, plus + minus)


def ndvi(red: Column, nir: Column) -> Column:
    """(nir - red) / (nir + red); a zero sum gives NULL."""
    return _ratio(nir, red)


def ndwi(green: Column, nir: Column) -> Column:
    """(green - nir) / (green + nir); a zero sum gives NULL."""
    return _ratio(green, nir)


def label_mask(*bands: Column) -> Column:
    """0 where the label bands sum to zero, 1 elsewhere (also on NoData)."""
    total = bands[0].cast("double")
    for b in bands[1:]:
        total = total + b.cast("double")
    return F.when(total == 0, 0).otherwise(1)


def zscore(v: Column, mean: Column, sd: Column) -> Column:
    """Whole standard deviations from the mean, truncated toward zero.

    A constant band (``sd = 0``) gives 0; NoData stays NULL.
    """
    z = F.try_divide(v.cast("double") - mean, sd).cast("int")
    return F.when(v.isNotNull(), F.coalesce(z, F.lit(0)))


def square_parts(v: Column) -> tuple[Column, Column]:
    """(high, low) halves of the square of an int, whose sums cannot overflow."""
    w = v.cast("bigint")
    square = w * w
    return F.shiftright(square, 32), square.bitwiseAND(F.lit(0xFFFFFFFF))


def square_sum(high: Column, low: Column) -> Column:
    """The exact sum of squares from the sums of both halves."""
    return (high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + low.cast("decimal(20,0)")).cast("decimal(38,0)")


def pop_stddev(n: Column, s: Column, ss: Column) -> Column:
    """Population standard deviation from count, sum and sum of squares.

    The difference is taken in decimals, so wide integers lose nothing.
    """
    d = s.cast("decimal(19,0)")
    spread = n.cast("decimal(19,0)") * ss.cast("decimal(38,0)") - d * d
    return F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0))) / n.cast("double")


def clamp(v: Column, lo: int, hi: int) -> Column:
    """Limit to [lo, hi]; guards NoData because least/greatest skip NULLs."""
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def rescale(v: Column, lo: int, hi: int, new_lo: int = 0, new_hi: int = 255) -> Column:
    """Linear rescale of [lo, hi] to [new_lo, new_hi], truncated to int."""
    return ((v - lo) * (new_hi - new_lo) / F.lit(hi - lo) + new_lo).cast("int")


def brighten(v: Column, amount: int = BRIGHTNESS) -> Column:
    return F.when(v > 0, v + amount).otherwise(v)


def gamma_correct(v: Column, gamma: float = GAMMA) -> Column:
    return (F.lit(255) * F.pow(v / F.lit(255.0), F.lit(1 / gamma))).cast("int")


def contrast_correct(v: Column, contrast: float = CONTRAST) -> Column:
    factor = (259 * (contrast + 255)) / (255 * (259 - contrast))
    return (F.lit(factor) * (v - 128) + 128).cast("int")


def adjust(v: Column) -> Column:
    """Brightness, gamma and contrast, each clamped to 0..255."""
    v = clamp(brighten(v), 0, 255)
    v = clamp(gamma_correct(v), 0, 255)
    return clamp(contrast_correct(v), 0, 255)


def _adjust_table() -> str:
    """``adjust`` of 0..255 as an array literal (it is constant from there on)."""
    factor = (259 * (CONTRAST + 255)) / (255 * (259 - CONTRAST))
    out = []
    for v in range(256):
        v = min(v + BRIGHTNESS, 255) if v else 0
        v = int(255 * (v / 255.0) ** (1 / GAMMA))
        out.append(min(max(int(factor * (v - 128) + 128), 0), 255))
    return "array(" + ",".join(map(str, out)) + ")"


def adjust_lookup(v: Column) -> Column:
    """``adjust`` through a literal 256-entry table.

    Equal to ``adjust`` for every int, because all steps depend on the value
    limited to 0..255 only.  Used on arrays, where one lookup replaces a dozen
    interpreted lambda nodes.
    """
    return F.get(F.expr(_adjust_table()), clamp(v, 0, 255))


def apply_mask(v: Column, mask: Column) -> Column:
    """0 where the mask band is 0, else the value."""
    return F.when(mask == 0, F.lit(0)).otherwise(v)


def stretch_u16(v: Column) -> Column:
    """Display value of a 16-bit cell: clamp to the display range, rescale."""
    return rescale(clamp(v, DISPLAY_MIN, DISPLAY_MAX), DISPLAY_MIN, DISPLAY_MAX)


def class_index(v: Column, breaks: Breaks) -> Column:
    """Position of the first break with ``v <= limit``; above the last: NULL."""
    out = F.when(v <= F.lit(float(breaks[0][0])), F.lit(0))
    for k, (limit, _) in enumerate(breaks[1:], start=1):
        out = out.when(v <= F.lit(float(limit)), F.lit(k))
    return out


def classify(v: Column, breaks: Breaks) -> Column:
    """Colour of the class of ``v`` as 0xRRGGBBAA; NULL is transparent."""
    out = None
    for limit, rgba in breaks:
        cond, value = v <= F.lit(float(limit)), F.lit(int(rgba, 16)).cast("bigint")
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


def rgba_channels(rgba: Column) -> Column:
    """0xRRGGBBAA as an array of four channel values."""
    return F.when(
        rgba.isNotNull(),
        F.array(*[F.shiftright(rgba, s).bitwiseAND(F.lit(255)).cast("int") for s in (24, 16, 8, 0)]),
    )
