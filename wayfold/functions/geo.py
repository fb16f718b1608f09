"""Distances on the sphere and on the WGS-84 ellipsoid, radius tests and grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mean Earth radius in metres, WGS-84 semi-major axis and flattening.
EARTH_RADIUS_M = 6371000.0
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563

# A degree of latitude is never shorter than this many kilometres.
KM_PER_DEGREE = 110.5

# The series has settled when a step moves the longitude by less than this many radians, a tenth of a millimetre.
SETTLED = 1e-11

# Ellipsoidal over spherical distance lies inside 1 -/+ this share everywhere.
SPHERE_SLACK = 0.007


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    return 2 * F.lit(EARTH_RADIUS_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


# One step of the series; {k} numbers the step and {j} the one before, so that no name occurs twice.
_STEP = [
    "sin(_lam{j}) AS _sl{k}, cos(_lam{j}) AS _cl{k}",
    "_c2 * _sl{k} AS _p{k}, _cs - _sc * _cl{k} AS _q{k}, _ss + _cc * _cl{k} AS _cos{k}",
    "sqrt(_p{k} * _p{k} + _q{k} * _q{k}) AS _sin{k}",
    "atan2(_sin{k}, _cos{k}) AS _sig{k}, _cc * _sl{k} / (_sin{k} + 1e-300D) AS _az{k}",
    "1D - _az{k} * _az{k} AS _ca{k}",
    "_cos{k} - _ss2 / (_ca{k} + 1e-300D) AS _m{k}, _ca{k} * ({f4} - {f3} * _ca{k}) AS _t{k}",
    "_big + ({f} - {f} * _t{k}) * _az{k} * (_sig{k} + _t{k} * _sin{k} * (_m{k} + _t{k} * _cos{k} * (2D * _m{k} * _m{k} - 1D))) AS _lam{k}",
]


def with_geodesic_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str, out: str, steps: int = 3, far: bool = False) -> DataFrame:
    """Add the WGS-84 distance in kilometres (Vincenty's inverse series) as column ``out``.

    The iteration is unrolled into a chain of projections, so the whole chain runs as generated
    code; as one nested expression it would either blow up or fall back to interpretation. It is
    written as SQL text because that is analysed once, not once per projection. From a first-order
    start, three steps settle the series far below a millimetre up to a few thousand kilometres;
    where it has not settled the result is NULL, or, with ``far``, comes from ``settled_km``.

    A generated method beyond 8 kB of bytecode is not compiled by the JVM. So steps are few, missing
    inputs become NaN at the start, and a tiny addend guards the quotients, which spares a NULL or
    zero test per term.
    """
    f, b = f"{WGS84_F!r}D", f"{1 - WGS84_F!r}D"
    f4, f3 = WGS84_F / 4 * (1 + WGS84_F), WGS84_F * WGS84_F * 3 / 16
    second = 1 / (1 - WGS84_F) ** 2 - 1
    z = steps
    layers = [
        ", ".join(f"coalesce(`{c}`, double('NaN')) AS _in{k}" for k, c in enumerate((lat1, lon1, lat2, lon2))),
        f"atan({b} * tan(radians(_in0))) AS _u1, atan({b} * tan(radians(_in2))) AS _u2, radians(_in3 - _in1) AS _big",
        "sin(_u1) AS _s1, cos(_u1) AS _c1, sin(_u2) AS _s2, cos(_u2) AS _c2",
        f"_big * (1D + {f} * _c1 * _c2) AS _lam0, _c1 * _c2 AS _cc, _c1 * _s2 AS _cs, _s1 * _c2 AS _sc, _s1 * _s2 AS _ss, 2D * _s1 * _s2 AS _ss2",
    ]
    for k in range(1, steps + 1):
        layers += [line.format(k=k, j=k - 1, f=f, f4=f"{f4!r}D", f3=f"{f3!r}D") for line in _STEP]
    layers += [
        f"{second!r}D * _ca{z} AS _k, _m{z} * _m{z} AS _mm",
        "1D + _k * (0.25D + _k * (-0.046875D + _k * (0.01953125D - 0.01068115234375D * _k))) AS _a, "
        "_k * (0.25D + _k * (-0.125D + _k * (0.072265625D - 0.0458984375D * _k))) AS _b",
        f"_b * _sin{z} * (_m{z} + 0.25D * _b * (_cos{z} * (2D * _mm - 1D) - {1 / 6!r}D * _b * _m{z} * (4D * _sin{z} * _sin{z} - 3D) * (4D * _mm - 3D))) AS _shift",
    ]
    # A partition id is never negative; asking for it keeps the optimizer from copying the chain
    # into a filter on the result, which would unfold it exponentially.
    settled = f"abs(_lam{z} - _lam{z - 1}) < {SETTLED!r}D AND spark_partition_id() >= 0"
    km = f"CASE WHEN {settled} THEN {WGS84_A / 1000!r}D * {b} * _a * (_sig{z} - _shift) END"
    keep = ", ".join(f"`{c}`" for c in df.columns if c != out)
    text = "{puntos}"
    for layer in layers:
        text = f"(SELECT *, {layer} FROM {text})"
    result = df.sparkSession.sql(f"SELECT {keep}, {km} AS `{out}` FROM {text}", puntos=df)
    return result.withColumn(out, F.coalesce(out, settled_km(lat1, lon1, lat2, lon2))) if far else result


def _let(fn, **values: Column) -> Column:
    """Name intermediate values inside one expression."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), fn)[0]


def geodesic_km(lat1, lon1, lat2, lon2, steps: int = 3) -> Column:
    """The distance of ``with_geodesic_km`` as a single expression.

    It is evaluated by interpretation, some ten times slower per row, so it suits conditions that
    few rows reach.
    """
    f, b = WGS84_F, 1 - WGS84_F
    zero = F.lit(0.0)

    def start(r: Column) -> Column:
        return _let(
            lambda g: _let(
                lambda p: finish(g, p),
                end=F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first(g), lambda acc, _: step(g, acc["lam"])),
            ),
            s1=F.sin(r["u"]), c1=F.cos(r["u"]), s2=F.sin(r["w"]), c2=F.cos(r["w"]), big=r["big"],
        )

    def first(g: Column) -> Column:
        names = ("prev", "sin", "cos", "sig", "ca", "m")
        return F.struct((g["big"] * (1 + f * g["c1"] * g["c2"])).alias("lam"), *[zero.alias(n) for n in names])

    def step(g: Column, lam: Column) -> Column:
        def trig(t: Column) -> Column:
            side, rest = g["c2"] * t["sl"], g["c1"] * g["s2"] - g["s1"] * g["c2"] * t["cl"]
            return _let(azimuth, sl=t["sl"], sin=F.sqrt(side * side + rest * rest), cos=g["s1"] * g["s2"] + g["c1"] * g["c2"] * t["cl"])

        def azimuth(t: Column) -> Column:
            az = F.coalesce(g["c1"] * g["c2"] * t["sl"] / F.nullif(t["sin"], zero), zero)
            return _let(midpoint, sin=t["sin"], cos=t["cos"], sig=F.atan2(t["sin"], t["cos"]), az=az)

        def midpoint(t: Column) -> Column:
            ca = 1 - t["az"] * t["az"]
            m = F.coalesce(t["cos"] - 2 * g["s1"] * g["s2"] / F.nullif(ca, zero), zero)
            return _let(longitude, sin=t["sin"], cos=t["cos"], sig=t["sig"], az=t["az"], ca=ca, m=m, c=f / 16 * ca * (4 + f * (4 - 3 * ca)))

        def longitude(t: Column) -> Column:
            bend = t["sig"] + t["c"] * t["sin"] * (t["m"] + t["c"] * t["cos"] * (2 * t["m"] * t["m"] - 1))
            return F.struct(
                (g["big"] + (1 - t["c"]) * f * t["az"] * bend).alias("lam"), lam.alias("prev"), *[t[n].alias(n) for n in ("sin", "cos", "sig", "ca", "m")]
            )

        return _let(trig, sl=F.sin(lam), cl=F.cos(lam))

    def finish(g: Column, p: Column) -> Column:
        e = p["end"]

        def arc(t: Column) -> Column:
            shift = t["b"] * e["sin"] * (e["m"] + t["b"] / 4 * (
                e["cos"] * (2 * e["m"] * e["m"] - 1) - t["b"] / 6 * e["m"] * (4 * e["sin"] * e["sin"] - 3) * (4 * e["m"] * e["m"] - 3)
            ))
            return F.when(F.abs(e["lam"] - e["prev"]) < SETTLED, WGS84_A * b / 1000 * t["a"] * (e["sig"] - shift))

        k = e["ca"] * (1 / (b * b) - 1)
        return _let(arc, a=1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k))), b=k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))))

    lat1, lon1, lat2, lon2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    return _let(start, u=F.atan(b * F.tan(lat1)), w=F.atan(b * F.tan(lat2)), big=lon2 - lon1)


def opposite_km(lat1, lon1, lat2, lon2) -> Column:
    """The distance of two points that are almost opposite, for which the series does not settle.

    Any shortest line passes one of the points a quarter circle from its start. Both halves by way
    of such a point settle, and their sum is least on the line; it is searched by direction, in three
    rounds of finer steps. The sum is flat around its least value, so the last step of 0.01 degrees
    leaves less than a centimetre.
    """
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))

    def by_way_of(turn: Column) -> Column:
        theta = F.radians(turn)
        lat = F.asin(F.cos(F.radians(lat1)) * F.cos(theta))
        lon = F.degrees(F.atan2(F.sin(theta) * F.cos(F.radians(lat1)), -F.sin(F.radians(lat1)) * F.sin(lat)))
        return _let(
            lambda m: F.struct(
                (geodesic_km(lat1, F.lit(0.0), m["lat"], m["lon"], 20) + geodesic_km(m["lat"], m["lon"], lat2, lon2 - lon1, 20)).alias("km"), turn.alias("turn")
            ),
            lat=F.degrees(lat), lon=lon,
        )

    def search(centre: Column, step: float, reach: int) -> Column:
        tries = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda k: by_way_of(centre + k * F.lit(step)))
        return F.array_min(F.filter(tries, lambda t: t["km"].isNotNull()))

    return _let(
        lambda a: _let(lambda b: search(b["best"]["turn"], 0.01, 25)["km"], best=search(a["best"]["turn"], 0.25, 20)),
        best=search(F.lit(180.0), 5.0, 36),
    )


def settled_km(lat1, lon1, lat2, lon2) -> Column:
    """The distance of any two points: the series with more steps, else the search for opposite points. NULL for NULLs only."""
    known = F.lit(True)
    for c in (lat1, lon1, lat2, lon2):
        known = known & _col(c).isNotNull()
    return F.when(known, F.coalesce(geodesic_km(lat1, lon1, lat2, lon2, 20), opposite_km(lat1, lon1, lat2, lon2)))


# The series settles within three steps for pairs nearer than this.
NEAR_KM = 2000.0


def is_within_km(lat1, lon1, lat2, lon2, km: float) -> Column:
    """At most ``km`` apart on the ellipsoid, inclusive.

    The great circle settles all pairs but those in a thin ring around the radius; only these pay
    for the ellipsoid. In the ring of a far radius the series takes more steps.
    """
    flat = haversine_m(lat1, lon1, lat2, lon2) / 1000
    exact = geodesic_km(lat1, lon1, lat2, lon2) if km <= NEAR_KM else settled_km(lat1, lon1, lat2, lon2)
    return (flat <= km * (1 + SPHERE_SLACK)) & ((flat <= km * (1 - SPHERE_SLACK)) | (exact <= km))


def fare(km, rate: float = 1.0) -> Column:
    """Price of a ride: kilometres times the rate."""
    return _col(km) * F.lit(rate)


def finished() -> Column:
    """True where the position equals the destination exactly."""
    return (F.col("latitud") == F.col("latitud_final")) & (F.col("longitud") == F.col("longitud_final"))


def is_full(occupied, seats) -> Column:
    return _col(occupied) >= _col(seats)


def is_available(occupied, seats, done) -> Column:
    return ~is_full(occupied, seats) & ~_col(done)


# Grid: latitude bands about ``km`` high, each split into columns about ``km`` wide. The number of
# columns depends on the band, so cells keep their width at every latitude and wrap at the date line.

# Latitude from which a circle may reach around the pole.
POLAR = 89.9


def _columns_in(band: Column, height: float) -> Column:
    middle = F.abs((band + F.lit(0.5)) * F.lit(height) - F.lit(90.0))
    share = F.cos(F.radians(F.least(middle, F.lit(POLAR))))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0 / height) * share)).cast("long")


def cell(lat, lon, km: float) -> Column:
    """The one grid cell (band, column) that holds a point."""
    height = km / KM_PER_DEGREE
    band = F.floor((_col(lat) + 90.0) / height)
    n = _columns_in(band, height)
    return F.struct(band.alias("band"), F.pmod(F.floor((_col(lon) + 180.0) / 360.0 * n), n).alias("column"))


def cells_around(lat, lon, km: float, side: float | None = None) -> Column:
    """Every grid cell that may hold a point at most ``km`` away, as an array without repeats.

    Cells are ``km`` wide, or ``side`` (at least ``km``): wider ones are fewer around a point. Where the radius comes near
    a pole, meridians meet and every column of the band is within reach.
    """
    height, far = (km if side is None else side) / KM_PER_DEGREE, km / KM_PER_DEGREE
    lat, lon = _col(lat), _col(lon)
    polar = F.abs(lat) + far > POLAR
    reach = F.when(polar, F.lit(360.0)).otherwise(F.lit(far) / F.cos(F.radians(F.least(F.abs(lat) + far, F.lit(POLAR)))))
    own = F.floor((lat + 90.0) / height)

    def columns(band: Column) -> Column:
        n = _columns_in(band, height)
        first = F.floor((lon - reach + 180.0) / 360.0 * n)
        last = F.least(F.floor((lon + reach + 180.0) / 360.0 * n), first + n - 1)
        return F.transform(
            F.sequence(first, last),
            lambda i: F.struct(band.alias("band"), F.pmod(i, n).alias("column")),
        )

    if side is None:
        return F.array_distinct(F.concat(*[columns(own + offset) for offset in (-1, 0, 1)]))
    none = F.array().cast("array<struct<band:bigint,column:bigint>>")
    beside = [F.when(F.floor((lat + sign * far + 90.0) / height) != own, columns(own + sign)).otherwise(none) for sign in (-1, 1)]
    return F.array_distinct(F.concat(beside[0], columns(own), beside[1]))
