"""Ellipsoidal distance and planar polygon centroids as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# WGS-84 radius (km) and flattening, and the reference point (latitude, longitude).
EARTH_RADIUS_KM = 6378.137
FLATTENING = 1 / 298.257223563
REFERENCE_POINT = (-15.7975, -47.8919)

SECOND_ECCENTRICITY = 1 / (1 - FLATTENING) ** 2 - 1  # squared
STEPS, SETTLED = 40, 1e-14


def _root_series(terms: int = 7) -> list[float]:
    """sqrt(1 + u) as a power series. Here u is at most SECOND_ECCENTRICITY (0.0067): what seven terms leave out is
    below 1e-17."""
    series = [1.0]
    for k in range(1, terms):
        series.append(series[-1] * (1.5 - k) / k)
    return series


def _slower_series() -> list[float]:
    """(2 - f) / (1 + (1 - f) sqrt(1 + u)) as a power series."""
    below = [(1 - FLATTENING) / (2 - FLATTENING) * v for v in ROOT[1:]]
    series = [1.0]
    for k in range(1, len(ROOT)):
        series.append(-sum(below[j] * series[k - 1 - j] for j in range(k)))
    return series


ROOT = _root_series()
SLOWER = _slower_series()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def polynomial(x: Column, factors: list) -> Column:
    """``factors`` by rising power of ``x``."""
    total, *rest = factors[::-1]
    for factor in rest:
        total = factor + x * total
    return total


def along(arc: Column, series: list[float]) -> Column:
    """Integral of a power series in ``u = k2 sin(s) ** 2`` from the arc's start over its width.

    In closed form: an integral of ``sin ** 2j`` is ``(2j - 1) / 2j`` times that of the power before, less the rise of
    ``sin ** (2j - 1) cos / 2j``. So the width has one factor, a polynomial in k2, and the rises have one each.
    """
    factors = []
    for j in range(len(series)):
        scale, powers = 1.0, []
        for i in range(j, len(series)):
            scale *= (2 * i - 1) / (2 * i) if i > j else 1.0
            powers.append(F.lit(series[i] * scale / (2 * j or 1)))
        factors.append(polynomial(arc["k2"], powers).alias(f"f{j}"))

    def height(of: Column, at: Column) -> Column:
        return let(F.struct(F.sin(at).alias("sine"), F.cos(at).alias("cosine")), lambda p: let(
            arc["k2"] * p["sine"] * p["sine"],
            lambda u: p["sine"] * p["cosine"] * polynomial(u, [of[f"f{j}"] for j in range(1, len(series))])))

    return let(F.struct(*factors), lambda of: of["f0"] * arc["width"] - arc["k2"] * (
        height(of, arc["start"] + arc["width"]) - height(of, arc["start"])))


def great_arc(ends: Column, turn: Column) -> Column:
    """The arc on the auxiliary sphere between reduced latitudes that lie ``turn`` apart in longitude."""
    across = ends["c2"] * F.sin(turn)
    up = ends["c1"] * ends["s2"] - ends["s1"] * ends["c2"] * F.cos(turn)
    sides = F.struct(
        across.alias("across"), up.alias("up"), F.hypot(across, up).alias("sine"),
        (ends["s1"] * ends["s2"] + ends["c1"] * ends["c2"] * F.cos(turn)).alias("cosine"),
    )

    def measured(m: Column) -> Column:
        unit = F.nullif(m["sine"], F.lit(0.0))
        lean = F.coalesce(ends["c1"] * m["across"] / unit, F.lit(0.0))  # sine of the azimuth at the equator
        return F.struct(
            F.atan2(m["sine"], m["cosine"]).alias("width"), lean.alias("lean"),
            F.coalesce(F.atan2(ends["s1"], ends["c1"] * m["up"] / unit), F.lit(0.0)).alias("start"),
            (F.lit(SECOND_ECCENTRICITY) * (F.lit(1.0) - lean * lean)).alias("k2"),
        )

    return let(sides, measured)


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Length of the geodesic on the ellipsoid, to less than a millimetre.

    The longitude difference on the auxiliary sphere is iterated until it moves by less than ``SETTLED``; the
    integrals are series to the last digit. Of points nearly opposite each other (within some 100 km) the
    iteration may not settle in ``STEPS`` steps, and the last step's length is given. NULL where a coordinate is.
    """
    flat = F.lit(1 - FLATTENING)
    b1, b2 = (F.atan(flat * F.tan(F.radians(lat))) for lat in (lat1, lat2))
    turn = lon2 - lon1
    ends = F.struct(
        F.sin(b1).alias("s1"), F.cos(b1).alias("c1"), F.sin(b2).alias("s2"), F.cos(b2).alias("c2"),
        F.radians(turn - F.lit(360.0) * F.round(turn / F.lit(360.0))).alias("turn"),
    )

    def geodesic(e: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            moved = let(great_arc(e, state["turn"]), lambda arc: (
                e["turn"] + F.lit(FLATTENING) * arc["lean"] * along(arc, SLOWER)))
            next_ = let(moved, lambda to: F.struct(to.alias("turn"), F.abs(to - state["turn"]).alias("gap")))
            return F.when(state["gap"] < SETTLED, state).otherwise(next_)

        first = F.struct(e["turn"].alias("turn"), F.lit(1.0).alias("gap"))
        last = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, step, lambda state: state["turn"])
        return let(great_arc(e, last), lambda arc: F.lit(EARTH_RADIUS_KM * (1 - FLATTENING)) * along(arc, ROOT))

    return let(ends, geodesic)


def distance_to_reference(lat: Column, lon: Column, point: tuple[float, float] = REFERENCE_POINT) -> Column:
    return distance_km(lat, lon, F.lit(point[0]), F.lit(point[1]))


def polygon_centroid(parts: Column) -> Column:
    """``struct(lon, lat)`` of a multi-part polygon: parts > rings > vertices ``[lon, lat]``.

    Every ring is closed. The first ring of a part adds area, later rings are holes and take it
    away, whatever their winding. Coordinates are shifted to the first vertex before summing.
    All work stays inside the row; there is no explode and no shuffle.
    """
    first = F.get(F.get(F.get(parts, 0), 0), 0)  # an empty geometry has none: NULL
    x0, y0 = F.get(first, 0), F.get(first, 1)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def edge(v: Column, w: Column) -> Column:
        return F.struct(
            (v[0] - x0).alias("xv"), (v[1] - y0).alias("yv"), (w[0] - x0).alias("xw"), (w[1] - y0).alias("yw")
        )

    def add_edge(acc: Column, e: Column) -> Column:
        cross = e["xv"] * e["yw"] - e["xw"] * e["yv"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (e["xv"] + e["xw"]) * cross).alias("x"),
            (acc["y"] + (e["yv"] + e["yw"]) * cross).alias("y"),
        )

    def measure(ring: Column, index: Column) -> Column:
        steps = F.size(ring) - 1
        edges = F.zip_with(F.slice(ring, F.lit(1), steps), F.slice(ring, F.lit(2), steps), edge)
        return F.struct((index > 0).alias("hole"), F.aggregate(edges, zero, add_edge).alias("sums"))

    def add_ring(acc: Column, ring: Column) -> Column:
        sums = ring["sums"]
        sign = F.when(ring["hole"], -F.signum(sums["a"])).otherwise(F.signum(sums["a"]))
        return F.struct(*[(acc[f] + sums[f] * sign).alias(f) for f in ("a", "x", "y")])

    def centre(total: Column) -> Column:
        area = F.nullif(total["a"] * 3, F.lit(0.0))
        return F.struct((x0 + total["x"] / area).alias("lon"), (y0 + total["y"] / area).alias("lat"))

    rings = F.flatten(F.transform(parts, lambda part: F.transform(part, measure)))
    return F.aggregate(rings, zero, add_ring, centre)
