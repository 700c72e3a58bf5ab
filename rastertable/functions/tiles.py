"""Kernels on row-major band arrays, built from Spark array expressions only.

Rows are moved as slices wherever the operation keeps rows together (crop,
flips, padding, stitching): one slice copy per row is about five times cheaper
than one indexed read per cell.  Only the transpose has to gather cell by cell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(v) -> Column:
    return (v if isinstance(v, Column) else F.lit(v)).cast("int")


def _rows(n) -> Column:
    return F.sequence(F.lit(0), _int(n) - 1)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so that it is evaluated once.

    Spark inlines projected expressions into lambdas, where they would be
    evaluated again for every element; every kernel binds its inputs instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ------------------------------------------------------------------ cell lifts
def map_cells(cells: Column, fn: Callable[[Column], Column]) -> Column:
    """Apply a cell formula to every cell of one band."""
    return F.transform(cells, fn)


def combine_cells(fn: Callable[..., Column], *bands: Column) -> Column:
    """Apply a cell formula across several bands, cell by cell."""
    if len(bands) == 1:
        return F.transform(bands[0], fn)
    if len(bands) == 2:
        return F.zip_with(bands[0], bands[1], fn)
    zipped = F.arrays_zip(*[b.alias(f"c{k}") for k, b in enumerate(bands)])
    return F.transform(
        zipped, lambda s: fn(*[s.getField(f"c{k}") for k in range(len(bands))])
    )


def convert_cells(cells: Column, cell_type: str) -> Column:
    """Change the cell type of a band."""
    return cells.cast(f"array<{cell_type}>")


def constant_cells(value, n, cell_type: str = "int") -> Column:
    """A band of ``n`` equal cells; ``value=None`` gives NoData."""
    return F.array_repeat(F.lit(value).cast(cell_type), _int(n))


# ------------------------------------------------------------------ rectangles
def crop_cells(cells: Column, cols, x0, y0, w, h) -> Column:
    """Rectangle (x0, y0, w, h) of a band that is ``cols`` wide."""
    cols, x0, y0, w, h = (_int(v) for v in (cols, x0, y0, w, h))
    return let(
        cells,
        lambda a: F.flatten(
            F.transform(
                F.sequence(y0, y0 + h - 1),
                lambda y: F.slice(a, y * cols + x0 + 1, w),
            )
        ),
    )


def pad_cells(cells: Column, cols, rows, out_cols, out_rows, fill=0,
              cell_type: str = "int") -> Column:
    """Grow to ``out_cols x out_rows``, anchored top-left, filled with ``fill``.

    A band larger than the target is an error.
    """
    cols, rows, oc, orr = (_int(v) for v in (cols, rows, out_cols, out_rows))
    body = let(
        cells,
        lambda a: F.flatten(
            F.transform(
                _rows(rows),
                lambda y: F.concat(
                    F.slice(a, y * cols + 1, cols),
                    constant_cells(fill, oc - cols, cell_type),
                ),
            )
        ),
    )
    padded = F.concat(body, constant_cells(fill, oc * (orr - rows), cell_type))
    too_big = F.raise_error(
        F.format_string("band of %d x %d cells exceeds %d x %d", cols, rows, oc, orr)
    )
    return (
        F.when((cols > oc) | (rows > orr), too_big.cast(f"array<{cell_type}>"))
        .when((cols == oc) & (rows == orr), cells)
        .otherwise(padded)
    )


def place_cells(cells: Column, cols, x0, y0, w, h, out_cols, out_rows,
                cell_type: str = "int") -> Column:
    """Put a ``w x h`` rectangle at (x0, y0) of an otherwise NoData tile."""
    x0, y0, w, h, oc, orr = (_int(v) for v in (x0, y0, w, h, out_cols, out_rows))
    return F.concat(
        constant_cells(None, oc * y0, cell_type),
        let(
            cells,
            lambda a: F.flatten(
                F.transform(
                    _rows(h),
                    lambda y: F.concat(
                        constant_cells(None, x0, cell_type),
                        F.slice(a, y * w + 1, w),
                        constant_cells(None, oc - x0 - w, cell_type),
                    ),
                )
            ),
        ),
        constant_cells(None, oc * (orr - y0 - h), cell_type),
    )


def dense_bands(entries: Column, fields: dict[str, str], n) -> Column:
    """struct of dense bands from sparse ``struct(k, ..)`` entries sorted by ``k``; ``fields`` names their cell types.

    Each entry is followed by the NoData run up to the next one, so the work is
    linear in the number of cells.  All bands of a cell type share the runs.
    """
    n = _int(n)

    def gapped(es: Column) -> Column:
        first = F.get(es, F.lit(0)).getField("k")

        def run(e: Column, i: Column, ctype: str) -> Column:
            nxt = F.coalesce(F.get(es, i + 1).getField("k"), n)
            return constant_cells(None, nxt - e.getField("k") - 1, ctype)

        def band(field: str, ctype: str, runs: Column) -> Column:
            # Pairs that are flattened twice: a concat per entry takes several times as long.
            pairs = F.zip_with(es, runs, lambda e, r: F.array(F.array(e.getField(field).cast(ctype)), r))
            return F.concat(constant_cells(None, first, ctype), F.flatten(F.flatten(pairs))).alias(field)

        def bound(types: list[str], runs: dict[str, Column]) -> Column:
            if not types:
                return F.struct(*[band(f, t, runs[t]) for f, t in fields.items()])
            t = types[0]
            return let(F.transform(es, lambda e, i: run(e, i, t)), lambda r: bound(types[1:], {**runs, t: r}))

        return bound(sorted(set(fields.values())), {})

    def fill(es: Column) -> Column:
        # Without gaps the entries are the cells.
        whole = F.struct(*[es.getField(f).cast(f"array<{t}>").alias(f) for f, t in fields.items()])
        return F.when(F.size(es) == n, whole).otherwise(gapped(es))

    return let(entries, fill)


def dense_cells(entries: Column, field: str, n, cell_type: str = "int") -> Column:
    """One dense band from sparse entries."""
    return dense_bands(entries, {field: cell_type}, n).getField(field)


# ----------------------------------------------------------------- orientation
def flip_vertical(cells: Column, cols, rows) -> Column:
    """Mirror left-right (about the vertical axis)."""
    cols = _int(cols)
    return let(
        cells,
        lambda a: F.flatten(
            F.transform(_rows(rows), lambda y: F.reverse(F.slice(a, y * cols + 1, cols)))
        ),
    )


def flip_horizontal(cells: Column, cols, rows) -> Column:
    """Mirror top-bottom (about the horizontal axis)."""
    cols, rows = _int(cols), _int(rows)
    return let(
        cells,
        lambda a: F.flatten(
            F.transform(_rows(rows), lambda y: F.slice(a, (rows - 1 - y) * cols + 1, cols))
        ),
    )


def transpose(cells: Column, cols, rows) -> Column:
    """Swap rows and columns; the result is ``rows`` wide."""
    cols, rows = _int(cols), _int(rows)
    return let(
        cells,
        lambda a: F.flatten(
            F.transform(
                _rows(cols),
                lambda x: F.transform(_rows(rows), lambda y: F.get(a, y * cols + x)),
            )
        ),
    )


def orient(cells: Column, cols, rows, flip_v: Column, flip_h: Column, turns: Column) -> Column:
    """Left-right flip, then top-bottom flip, then ``turns`` quarter turns.

    Any such sequence equals one optional transpose followed by at most one
    row-slice operation, so a cell is moved twice at most.
    """
    turns = F.pmod(turns, F.lit(4))
    odd = (turns % 2) == 1
    # A transpose exchanges the two mirror axes.
    v = F.when(odd, flip_h).otherwise(flip_v)
    h = F.when(odd, flip_v).otherwise(flip_h)
    v = v != turns.isin(2, 3)
    h = h != turns.isin(1, 2)
    base = F.when(odd, transpose(cells, cols, rows)).otherwise(cells)
    w = F.when(odd, _int(rows)).otherwise(_int(cols))
    r = F.when(odd, _int(cols)).otherwise(_int(rows))
    return let(
        base,
        lambda b: F.when(v & h, F.reverse(b))
        .when(v, flip_vertical(b, w, r))
        .when(h, flip_horizontal(b, w, r))
        .otherwise(b),
    )


def rotate90(cells: Column, cols, rows, n: int | Column = 1) -> Column:
    """``n`` quarter turns counter-clockwise; odd turns exchange the dimensions."""
    if isinstance(n, int):
        n %= 4
        if n == 0:
            return cells
        if n == 2:
            return F.reverse(cells)
        t = transpose(cells, cols, rows)
        return flip_horizontal(t, rows, cols) if n == 1 else flip_vertical(t, rows, cols)
    no = F.lit(False)
    return orient(cells, cols, rows, no, no, n)


# ------------------------------------------------------------------ statistics
def cell_moments(cells: Column) -> Column:
    """struct(n, s, hi, lo) over the data cells of an integer band.

    ``hi`` and ``lo`` are the sums of the halves of the squares.
    """
    from rastertable.functions.cells import square_parts

    names = ("n", "s", "hi", "lo")

    def step(acc: Column, v: Column) -> Column:
        add = (F.lit(1), v.cast("bigint"), *square_parts(v))
        return F.when(
            v.isNotNull(), F.struct(*[(acc[c] + x).alias(c) for c, x in zip(names, add)])
        ).otherwise(acc)

    return F.aggregate(cells, F.struct(*[F.lit(0).cast("bigint").alias(c) for c in names]), step)


def cell_mean_sd(cells: Column) -> Column:
    """struct(mean, sd) of one band, two passes for accuracy: sums of ints are exact
    as doubles, and deviations stay small however large the cells are."""

    def total(data: Column, fn: Callable[[Column], Column]) -> Column:
        return F.aggregate(data, F.lit(0.0), lambda a, v: a + fn(v.cast("double")))

    def stats(data: Column) -> Column:
        n = F.nullif(F.size(data).cast("double"), F.lit(0.0))
        return let(
            total(data, lambda v: v) / n,
            lambda m: F.struct(
                m.alias("mean"),
                F.sqrt(total(data, lambda v: (v - m) * (v - m)) / n).alias("sd"),
            ),
        )

    return let(F.filter(cells, lambda v: v.isNotNull()), stats)


def zscore_cells(cells: Column, strict: bool = True) -> Column:
    """z-score of one band by its own statistics, truncated toward zero.

    A band without data cells has no statistics, which is an error; unless
    ``strict``, it stays without data.
    """
    from rastertable.functions.cells import zscore

    stats = cell_mean_sd(cells)
    if not strict:
        return let(stats, lambda t: F.transform(cells, lambda v: zscore(v, t["mean"], t["sd"])))
    none = F.raise_error(F.lit("no statistics: band without data cells")).cast("array<int>")
    return let(
        stats,
        lambda t: F.when(
            t["mean"].isNotNull() | cells.isNull(), F.transform(cells, lambda v: zscore(v, t["mean"], t["sd"]))
        ).otherwise(none),
    )
