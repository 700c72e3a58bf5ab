"""Kernels that visit every cell or cell row of a band, in NumPy over Arrow batches.

Array expressions (``tiles``) move whole rows; what would take one interpreted
expression per cell runs here instead.  Batches are bounded by
``session.bounded_batches``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Pairs of an edge and a cell row that are looked at together.
CROSSINGS = 2_000_000


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _lists(lengths: np.ndarray, values: pa.Array, null: np.ndarray | None = None) -> pa.Array:
    offsets = pa.array(_starts(lengths), pa.int32())
    mask = None if null is None or not null.any() else pa.array(null)
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def cells_inside(edges: pa.Array, cols: np.ndarray, rows: np.ndarray, left: np.ndarray, top: np.ndarray, cw: float, ch: float) -> np.ndarray:
    """Whether the centre of each cell lies inside its tile's edges (even-odd), tile after tile.

    An edge that crosses the centre line of a cell row changes sides for all
    cells of the row whose centre is left of the crossing: one range per
    crossing, summed over all cells at once.
    """
    base = _starts(cols * rows)
    if not len(edges) or not base[-1]:
        return np.zeros(base[-1], bool)
    flat = edges.flatten()
    tile = np.repeat(np.arange(len(edges)), _lengths(edges))
    ends = [flat.field(n) for n in ("x1", "y1", "x2", "y2")]
    known = np.logical_and.reduce([e.is_valid().to_numpy(zero_copy_only=False) for e in ends])
    x1, y1, x2, y2 = (pc.fill_null(e, 0.0).to_numpy(zero_copy_only=False)[known] for e in ends)
    tile = tile[known]
    turns = np.zeros(base[-1] + 1, np.int64)
    height = rows[tile]
    reach = _starts(height)
    lo = 0
    while lo < len(tile):
        hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] + CROSSINGS, "right")) - 1)
        e = np.repeat(np.arange(lo, hi), height[lo:hi])
        y = np.arange(len(e)) - np.repeat(reach[lo:hi] - reach[lo], height[lo:hi])
        cy = top[tile[e]] - (y + 0.5) * ch
        met = np.flatnonzero((y1[e] > cy) != (y2[e] > cy))
        e, y, cy = e[met], y[met], cy[met]
        t = tile[e]
        c = (x2[e] - x1[e]) * ((cy - y1[e]) / (y2[e] - y1[e])) + x1[e]
        # Cells of the row with their centre left of the crossing; rounding may put
        # the guess off by one, and the comparison itself decides.
        guess = np.ceil((c - left[t]) / cw - 0.5)
        before = np.where(left[t] + (guess + 0.5) * cw < c, guess + 1, np.where(left[t] + (guess - 0.5) * cw < c, guess, guess - 1))
        before = np.clip(before, 0, cols[t]).astype(np.int64)
        start = base[t] + y * cols[t]
        turns += np.bincount(start, minlength=len(turns)) - np.bincount(start + before, minlength=len(turns))
        lo = hi
    return np.cumsum(turns[:-1]) % 2 == 1


def _numbers(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)


def map_bands(df: DataFrame, bands: Sequence[str], inputs: dict[str, Column], fn: Callable[..., Iterable[pa.Array]]) -> DataFrame:
    """``df`` with its ``bands`` replaced by ``fn(*inputs, *bands)`` of each Arrow batch; narrow."""
    if not bands:
        return df
    # Any cell of the result may be NoData.
    schema = T.StructType(
        [T.StructField(f.name, T.ArrayType(f.dataType.elementType) if f.name in bands else f.dataType) for f in df.schema]
    )
    names, kept = [f"_in_{n}" for n in inputs], df.columns
    wide = df.withColumns(dict(zip(names, inputs.values())))

    def run(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            columns |= zip(bands, fn(*[columns[n] for n in (*names, *bands)]))
            yield pa.RecordBatch.from_arrays([columns[n] for n in kept], names=kept)

    return wide.mapInArrow(run, schema)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[dict[str, pa.Array]]], schema: T.StructType) -> DataFrame:
    """Rows of ``schema`` from the columns that ``fn`` makes of each Arrow batch; narrow."""
    names = schema.names

    def run(batches):
        for batch in batches:
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return df.mapInArrow(run, schema)


def _taken(lists: pa.Array, owner: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.Array:
    """For each of the ``n`` runs of places ``at`` the cells of list ``owner`` there; places behind its end are left out."""
    have, null = _lengths(lists), lists.is_null().to_numpy(zero_copy_only=False)
    first, size = np.repeat(_starts(have)[owner], n), np.repeat(have[owner], n)
    inside = at < size
    if not inside.all():
        run = np.repeat(np.arange(len(n)), n)[inside]
        at, first, n = at[inside], first[inside], np.bincount(run, minlength=len(n))
    return _lists(n, lists.flatten().take(pa.array(first + at)), null[owner])


def crop_listed(tile: int, keep: Sequence[str], bands: Sequence[str], cells: int) -> Callable[[pa.RecordBatch], Iterator[dict[str, pa.Array]]]:
    """Kernel that cuts every window of ``_keys`` out of the tile beside it: one row per window, as ``crop_tiles`` has it."""

    def crop(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
        keys = batch.column("_keys")
        owner = np.repeat(np.arange(len(keys)), _lengths(keys))
        window = keys.flatten()
        x0, y0, x1, y1 = (window.field(c).cast(pa.int64()).to_numpy() for c in ("x0", "y0", "x1", "y1"))
        col, row = (batch.column(c).cast(pa.int64()).to_numpy()[owner] * tile for c in ("col", "row"))
        left, top = np.maximum(col, x0), np.maximum(row, y0)
        w, h = np.minimum(col + tile - 1, x1) - left + 1, np.minimum(row + tile - 1, y1) - top + 1
        reach = _starts(w * h)
        lo = 0
        while lo < len(owner):
            hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] + max(cells // len(bands), 1), "right")) - 1)
            part = slice(lo, hi)
            n = (w * h)[part]
            place = np.arange(reach[hi] - reach[lo]) - np.repeat(reach[lo:hi] - reach[lo], n)
            wide = np.repeat(w[part], n)
            y = place // wide
            at = place + y * (tile - wide) + np.repeat(((top - row) * tile + left - col)[part], n)
            of = pa.array(owner[part])
            yield (
                {c: window.field(c).slice(lo, hi - lo) for c in (*keep, "x0", "y0", "x1", "y1")}
                | {c: batch.column(c).take(of) for c in ("col", "row")}
                | {c: pa.array(v[part], pa.int32()) for c, v in (("px", left - x0), ("py", top - y0), ("w", w), ("h", h))}
                | {b: _taken(batch.column(b), owner[part], at, n) for b in bands}
            )
            lo = hi

    return crop


def oriented(cols: pa.Array, rows: pa.Array, flip_v: pa.Array, flip_h: pa.Array, turns: pa.Array, *bands: pa.Array) -> Iterator[pa.Array]:
    """Kernel of ``tiles.orient``: left-right flip, top-bottom flip, quarter turns; a null choice moves nothing."""
    unknown = cols.is_null().to_numpy(zero_copy_only=False) | rows.is_null().to_numpy(zero_copy_only=False)
    cols, rows = _numbers(cols), _numbers(rows)
    turned, turns = turns.is_valid().to_numpy(zero_copy_only=False), _numbers(turns) % 4
    odd = turns % 2 == 1
    v, h = flip_v, flip_h
    # A transpose exchanges the two mirror axes.
    known = [np.where(odd, a.is_valid().to_numpy(zero_copy_only=False), b.is_valid().to_numpy(zero_copy_only=False)) & turned for a, b in ((h, v), (v, h))]
    v, h = _numbers(flip_v) != 0, _numbers(flip_h) != 0
    v, h = np.where(odd, h, v), np.where(odd, v, h)
    v, h = (v != np.isin(turns, (2, 3))) & known[0], (h != np.isin(turns, (1, 2))) & known[1]
    wide, high = np.where(odd, rows, cols), np.where(odd, cols, rows)
    # Places in the source of a step to the right and of a step down in the result.
    right, down = np.where(odd, cols, 1), np.where(odd, 1, cols)
    first = np.where(v, (wide - 1) * right, 0) + np.where(h, (high - 1) * down, 0)
    right, down = np.where(v, -right, right), np.where(h, -down, down)
    n = cols * rows
    place = np.arange(n.sum()) - np.repeat(_starts(n)[:-1], n)
    y = place // np.repeat(wide, n)
    at = np.repeat(first, n) + y * np.repeat(down, n) + (place - y * np.repeat(wide, n)) * np.repeat(right, n)
    owner = np.arange(len(n))
    for band in bands:
        moved = _taken(band, owner, at, n)
        yield _lists(_lengths(moved), moved.flatten(), moved.is_null().to_numpy(zero_copy_only=False) | unknown) if unknown.any() else moved


def zscores(cells: pa.Array, strict: bool) -> pa.Array:
    """Kernel of ``tiles.zscore_cells`` for whole-number cells; sums run in cell order as there."""
    n = _lengths(cells)
    owner = np.repeat(np.arange(len(n)), n)
    values = cells.flatten()
    data = values.is_valid().to_numpy(zero_copy_only=False)
    of, v = owner[data], values.drop_null().cast(pa.float64(), safe=False).to_numpy()
    count = np.bincount(of, minlength=len(n))
    null = cells.is_null().to_numpy(zero_copy_only=False)
    if strict and (~null & (count == 0)).any():
        raise ValueError("no statistics: band without data cells")
    some = np.maximum(count, 1)
    mean = np.bincount(of, v, len(n)) / some
    off = v - mean[of]
    sd = np.sqrt(np.bincount(of, off * off, len(n)) / some)
    flat = sd[of] == 0
    z = np.zeros(len(values), np.int32)
    z[data] = np.where(flat, 0, off / np.where(flat, 1, sd[of])).astype(np.int32)
    return _lists(n, pa.array(z, mask=~data), null)


def totals(cells: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Number and sum of the data cells of each list of whole numbers."""
    n, null = _lengths(cells), cells.is_null().to_numpy(zero_copy_only=False)
    values = cells.flatten()
    ends = _starts(n)
    known = _starts(values.is_valid().to_numpy(zero_copy_only=False).astype(np.int64))
    sums = _starts(_numbers(values))
    return tuple(pa.array(v[ends[1:]] - v[ends[:-1]], pa.int64(), mask=null) for v in (known, sums))


def masked(cw: float, ch: float) -> Callable[..., Iterator[pa.Array]]:
    """Kernel that puts NoData where a cell's centre lies outside the edges; tiles that are ``whole`` pass unchanged."""

    def mask(whole: pa.Array, edges: pa.Array, cols: pa.Array, rows: pa.Array, left: pa.Array, top: pa.Array, *bands: pa.Array) -> Iterator[pa.Array]:
        cols, rows = _numbers(cols), _numbers(rows)
        left, top = (v.to_numpy(zero_copy_only=False) for v in (left, top))
        n = cols * rows
        uncut = _numbers(whole) != 0
        keep = cells_inside(edges, cols, rows, left, top, cw, ch) | np.repeat(uncut, n)
        unknown = edges.is_null().to_numpy(zero_copy_only=False) & ~uncut
        for band in bands:
            have = _lengths(band)
            shown = keep
            if not np.array_equal(have, n):
                shown = keep[np.arange(have.sum()) + np.repeat(_starts(n)[:-1] - _starts(have)[:-1], have)]
            values = band.flatten()
            null = unknown | band.is_null().to_numpy(zero_copy_only=False)
            yield _lists(have, pc.if_else(pa.array(shown), values, pa.scalar(None, values.type)), null)

    return mask
