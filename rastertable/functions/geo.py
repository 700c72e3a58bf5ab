"""Polygons, extents and map projections as Column expressions.

A polygon is ``ARRAY<ARRAY<ARRAY<DOUBLE>>>`` (rings -> points -> x, y).  Inside
is decided by the even-odd rule over the edges of all rings, so inner rings are
holes.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertable.functions.tiles import let

# ---------------------------------------------------------------- fixed values
# Spherical Mercator radius; WGS84 ellipsoid; UTM scale, false easting and the
# central meridian of zone 33.
MERCATOR_R = 6378137.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_E0 = 500000.0
# ------------------------------------------------------------------------------

Rings = list[list[list[float]]]


# -------------------------------------------------------------------- polygons
def parse_geojson(text: Column) -> Column:
    """Rings of a GeoJSON polygon; other geometry types give NULL."""
    parsed = F.from_json(
        text, "type string, coordinates array<array<array<double>>>"
    )
    return F.when(parsed["type"] == "Polygon", parsed["coordinates"])


def rings_from_geojson(text: str) -> Rings:
    """Rings of a polygon given as a query parameter."""
    doc = json.loads(text)
    if doc.get("type") == "Feature":
        doc = doc["geometry"]
    if doc.get("type") != "Polygon":
        raise ValueError(f"a Polygon is required, got {doc.get('type')!r}")
    return [[[float(p[0]), float(p[1])] for p in ring] for ring in doc["coordinates"]]


def rings_literal(rings: Rings) -> Column:
    """A parameter polygon as a literal column."""
    body = ",".join(
        "array(" + ",".join(f"array({x!r}D,{y!r}D)" for x, y in ring) + ")" for ring in rings
    )
    return F.expr(f"array({body})")


def polygon_envelope(rings: Column) -> Column:
    """Bounding box of a polygon."""
    pts = F.flatten(rings)
    xs = F.transform(pts, lambda p: F.get(p, F.lit(0)))
    ys = F.transform(pts, lambda p: F.get(p, F.lit(1)))
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"),
    )


def envelope_of(rings: Rings) -> tuple[float, float, float, float]:
    xs = [p[0] for ring in rings for p in ring]
    ys = [p[1] for ring in rings for p in ring]
    return min(xs), min(ys), max(xs), max(ys)


def extent_polygon(extent: Column) -> Column:
    """Closed five-point ring around an extent."""

    def pt(x: str, y: str) -> Column:
        return F.array(extent[x], extent[y])

    return F.array(
        F.array(
            pt("xmin", "ymin"), pt("xmin", "ymax"), pt("xmax", "ymax"),
            pt("xmax", "ymin"), pt("xmin", "ymin"),
        )
    )


def combine_extents(a: Column, b: Column) -> Column:
    """Smallest extent that holds both."""
    return F.struct(
        F.least(a["xmin"], b["xmin"]).alias("xmin"),
        F.least(a["ymin"], b["ymin"]).alias("ymin"),
        F.greatest(a["xmax"], b["xmax"]).alias("xmax"),
        F.greatest(a["ymax"], b["ymax"]).alias("ymax"),
    )


def round_extent(extent: Column, digits: int = 1) -> Column:
    """Round the four sides half-up."""
    return F.struct(
        *[F.round(extent[n], digits).alias(n) for n in ("xmin", "ymin", "xmax", "ymax")]
    )


def polygon_edges(rings: Column) -> Column:
    """Edges of all rings as struct(x1, y1, x2, y2).

    An open ring is closed by an edge from its last point to its first.
    """

    def ring_edges(ring: Column) -> Column:
        def edge(p: Column, i: Column) -> Column:
            q = F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0)))
            return F.struct(
                F.get(p, F.lit(0)).alias("x1"), F.get(p, F.lit(1)).alias("y1"),
                F.get(q, F.lit(0)).alias("x2"), F.get(q, F.lit(1)).alias("y2"),
            )

        return F.transform(ring, edge)

    return F.filter(
        F.flatten(F.transform(rings, ring_edges)),
        lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]),
    )


def edges_of(rings: Rings) -> list[tuple[float, float, float, float]]:
    out = []
    for ring in rings:
        for p, q in zip(ring, ring[1:] + ring[:1]):
            if p != q:
                out.append((p[0], p[1], q[0], q[1]))
    return out


def edges_literal(rings: Rings) -> Column:
    """The edges of a parameter polygon as one constant, so no row rebuilds them."""
    names = ("x1", "y1", "x2", "y2")
    edges = [F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, e)]) for e in edges_of(rings)]
    return F.array(*edges).cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")



def contains_point(edges: Column, cx: Column, cy: Column) -> Column:
    """Even-odd test of a point against an edge array."""
    hits = F.filter(
        edges,
        lambda e: ((e["y1"] > cy) != (e["y2"] > cy))
        & (
            cx
            < (e["x2"] - e["x1"]) * F.try_divide(cy - e["y1"], e["y2"] - e["y1"]) + e["x1"]
        ),
    )
    return F.size(hits) % 2 == 1


def contains_point_const(rings: Rings, cx: Column, cy: Column) -> Column:
    """Even-odd test against a parameter polygon, unrolled for code generation."""
    count = F.lit(0)
    for x1, y1, x2, y2 in edges_of(rings):
        if y1 == y2:
            continue
        cross = F.lit(x2 - x1) * ((cy - F.lit(y1)) / F.lit(y2 - y1)) + F.lit(x1)
        hit = ((F.lit(y1) > cy) != (F.lit(y2) > cy)) & (cx < cross)
        count = count + hit.cast("int")
    return count % 2 == 1


def edge_meets_box(e: Column, box: Column) -> Column:
    """Whether a segment touches a closed rectangle (separating-axis test)."""
    cx, cy = (box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2
    hx, hy = (box["xmax"] - box["xmin"]) / 2, (box["ymax"] - box["ymin"]) / 2
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    side = F.abs(dx * (cy - e["y1"]) - dy * (cx - e["x1"]))
    return (
        (F.least(e["x1"], e["x2"]) <= box["xmax"])
        & (F.greatest(e["x1"], e["x2"]) >= box["xmin"])
        & (F.least(e["y1"], e["y2"]) <= box["ymax"])
        & (F.greatest(e["y1"], e["y2"]) >= box["ymin"])
        & (side <= hx * F.abs(dy) + hy * F.abs(dx))
    )


def box_relation(edges: Column, box: Column) -> Column:
    """'edge' if the boundary touches the box, else 'inside' or 'outside'."""
    cx, cy = (box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2
    return let(
        edges,
        lambda es: F.when(F.exists(es, lambda e: edge_meets_box(e, box)), F.lit("edge"))
        .when(contains_point(es, cx, cy), F.lit("inside"))
        .otherwise(F.lit("outside")),
    )


def mask_cells(cells: Column, edges: Column, cols, rows, left, top, cw: float, ch: float) -> Column:
    """NoData for cells whose centre lies outside.

    ``left``/``top`` is the map position of the top-left corner.  Each cell row
    is cut into runs where it crosses the outline, and whole runs are kept or
    blanked: the work per row depends on the crossings, not on the cells.
    """
    cols, rows = cols.cast("int"), rows.cast("int")

    def cells_before(c: Column) -> Column:
        """How many cells of a row have their centre left of ``c``."""

        def left_of(n: Column) -> Column:
            return left + (n + F.lit(0.5)) * F.lit(cw) < c

        guess = F.ceil((c - left) / F.lit(cw) - F.lit(0.5)).cast("int")
        # Rounding may put the guess off by one; the comparison itself decides.
        n = F.when(left_of(guess), guess + 1).when(~left_of(guess - 1), guess - 1).otherwise(guess)
        return F.least(F.greatest(n, F.lit(0)), cols)

    def masked(a: Column, near: Column, empty: Column) -> Column:
        def nodata(n: Column) -> Column:
            return F.slice(empty, F.lit(1), n)

        def one_row(y: Column) -> Column:
            cy = top - (y + F.lit(0.5)) * F.lit(ch)
            # Cell positions where the row changes sides, in order.
            turns = F.sort_array(
                F.transform(
                    F.filter(near, lambda e: (e["y1"] > cy) != (e["y2"] > cy)),
                    lambda e: let(
                        (e["x2"] - e["x1"]) * F.try_divide(cy - e["y1"], e["y2"] - e["y1"])
                        + e["x1"],
                        cells_before,
                    ),
                )
            )
            # An odd number means that the row starts inside.
            turns = F.when(F.size(turns) % 2 == 1, F.concat(F.array(F.lit(0)), turns)).otherwise(turns)
            return let(
                turns,
                lambda ts: F.concat(
                    F.flatten(
                        F.transform(
                            ts,
                            lambda t, i: let(
                                F.when(i > 0, F.get(ts, i - 1)).otherwise(F.lit(0)),
                                lambda s: F.when(
                                    i % 2 == 1, F.slice(a, y * cols + s + 1, t - s)
                                ).otherwise(nodata(t - s)),
                            ),
                        )
                    ),
                    nodata(cols - F.coalesce(F.get(ts, F.size(ts) - 1), F.lit(0))),
                ),
            )

        return F.flatten(F.transform(F.sequence(F.lit(0), rows - 1), one_row))

    # A ray to the right only meets edges that reach past the left side.
    near = F.filter(
        edges,
        lambda e: (F.greatest(e["y1"], e["y2"]) >= top - rows * F.lit(ch))
        & (F.least(e["y1"], e["y2"]) <= top)
        & (F.greatest(e["x1"], e["x2"]) >= left),
    )
    empty = F.transform(F.slice(cells, F.lit(1), cols), lambda v: F.nullif(v, v))
    bound = F.struct(cells.alias("a"), near.alias("n"), empty.alias("e"))
    return let(bound, lambda t: masked(t["a"], t["n"], t["e"]))


# ------------------------------------------------------------------ projections
class _Num:
    """The math functions of the projection formulas, for plain floats."""

    sin, cos, tan, sinh, cosh = math.sin, math.cos, math.tan, math.sinh, math.cosh
    asin, atan, atan2, sqrt, log, exp = (
        math.asin, math.atan, math.atan2, math.sqrt, math.log, math.exp,
    )
    asinh, atanh = math.asinh, math.atanh
    radians, degrees = math.radians, math.degrees


def _krueger():
    """Series coefficients of the transverse Mercator projection (order 4)."""
    n = WGS84_F / (2 - WGS84_F)
    radius = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    fwd = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    inv = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    )
    lat = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    )
    return 2 * math.sqrt(n) / (1 + n), radius, fwd, inv, lat


def utm_zone(crs: str) -> int | None:
    """Northern UTM zone number of an EPSG:326xx code."""
    code = crs.upper().removeprefix("EPSG:")
    if len(code) == 5 and code.startswith("326") and 1 <= int(code[3:]) <= 60:
        return int(code[3:])
    return None


def _keep(value):
    return value


class _Stages:
    """Turns intermediate values into columns of a growing DataFrame.

    The series reuse their arguments many times; as columns they are computed
    once per row and the generated code stays small.
    """

    def __init__(self, df: DataFrame):
        self.df, self.n = df, 0

    def __call__(self, value: Column) -> Column:
        name = f"_stage{self.n}"
        self.df, self.n = self.df.withColumn(name, value), self.n + 1
        return F.col(name)


def _multiples(xi, eta, m, hold):
    """(sin, cos, sinh, cosh) of 2j times the arguments, j = 1..4.

    Four function calls in all; the higher multiples follow from the angle
    sums.
    """
    s1, c1 = hold(m.sin(xi * 2)), hold(m.cos(xi * 2))
    h1, k1 = hold(m.sinh(eta * 2)), hold(m.cosh(eta * 2))
    s, c, h, k = s1, c1, h1, k1
    out = [(s, c, h, k)]
    for _ in range(3):
        s, c = hold(s * c1 + c * s1), hold(c * c1 - s * s1)
        h, k = hold(h * k1 + k * h1), hold(k * k1 + h * h1)
        out.append((s, c, h, k))
    return out


def project(lon, lat, crs: str, m=F, hold=_keep):
    """Longitude/latitude in degrees to map x, y.

    ``m`` supplies the math functions: ``pyspark.sql.functions`` for columns,
    the default; pass ``NUM`` for plain floats.
    """
    if crs == "EPSG:4326":
        return lon, lat
    phi, lam = m.radians(lat), m.radians(lon)
    if crs == "EPSG:3857":
        x = lam * MERCATOR_R
        y = m.log(m.tan(phi / 2 + math.pi / 4)) * MERCATOR_R
        return x, y
    zone = utm_zone(crs)
    if zone is None:
        raise ValueError(f"unsupported CRS {crs}")
    e, radius, fwd, _, _ = _krueger()
    dl = lam - math.radians(6 * zone - 183)
    dl, sp = hold(dl), hold(m.sin(phi))
    t = hold(m.sinh(m.atanh(sp) - m.atanh(sp * e) * e))
    xi = hold(m.atan2(t, m.cos(dl)))
    eta = hold(m.atanh(m.sin(dl) / m.sqrt(t * t + 1)))
    x, y = eta, xi
    for a, (s, c, sh, ch) in zip(fwd, _multiples(xi, eta, m, hold)):
        x = x + c * sh * a
        y = y + s * ch * a
    return x * (UTM_K0 * radius) + UTM_E0, y * (UTM_K0 * radius)


def unproject(x, y, crs: str, m=F, hold=_keep):
    """Map x, y to longitude/latitude in degrees."""
    if crs == "EPSG:4326":
        return x, y
    if crs == "EPSG:3857":
        lon = m.degrees(x / MERCATOR_R)
        lat = m.degrees(m.atan(m.exp(y / MERCATOR_R)) * 2 - math.pi / 2)
        return lon, lat
    zone = utm_zone(crs)
    if zone is None:
        raise ValueError(f"unsupported CRS {crs}")
    _, radius, _, inv, series = _krueger()
    xi0 = hold(y / (UTM_K0 * radius))
    eta0 = hold((x - UTM_E0) / (UTM_K0 * radius))
    xi, eta = xi0, eta0
    for b, (s, c, sh, ch) in zip(inv, _multiples(xi0, eta0, m, hold)):
        xi = xi - s * ch * b
        eta = eta - c * sh * b
    xi, eta = hold(xi), hold(eta)
    chi = hold(m.asin(m.sin(xi) / m.cosh(eta)))
    phi = chi
    for j, d in enumerate(series, start=1):
        phi = phi + m.sin(chi * (2 * j)) * d
    lam = m.atan2(m.sinh(eta), m.cos(xi))
    return m.degrees(lam) + (6 * zone - 183), m.degrees(phi)


NUM = _Num


def reproject(x, y, source: str, target: str, m=F, hold=_keep):
    """Map coordinates of one CRS to another, through longitude/latitude."""
    if source == target:
        return x, y
    lon, lat = unproject(x, y, source, m, hold)
    return project(hold(lon), hold(lat), target, m, hold)


def reproject_columns(
    df: DataFrame, x: Column, y: Column, source: str, target: str, out: tuple[str, str]
) -> DataFrame:
    """Add the reprojected coordinates of every row as two columns."""
    stages = _Stages(df)
    px, py = reproject(x, y, source, target, F, stages)
    return stages.df.withColumns({out[0]: px, out[1]: py}).drop(
        *[f"_stage{k}" for k in range(stages.n)]
    )


def reproject_rings(rings: Rings, source: str, target: str) -> Rings:
    """Reproject a parameter polygon point by point."""
    if source == target:
        return rings
    return [[list(reproject(p[0], p[1], source, target, NUM)) for p in ring] for ring in rings]
