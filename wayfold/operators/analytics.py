"""Statistics over rides joined with their vehicle and client."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfold.schemas import CLIENT_ATTRIBUTES, VEHICLE_ATTRIBUTES
from wayfold.session import durable


def enrich(rides: DataFrame, vehicles: DataFrame | None = None, clients: DataFrame | None = None) -> DataFrame:
    """Every ride with the attributes of its vehicle and client, NULL where the key is unknown.

    Leave out the table a report does not need: the planner cannot know that a key is unique, so it
    would keep the join and shuffle the rides for nothing. No broadcast hint: a dimension known to be
    small is broadcast, a large one shuffled, and adaptive execution splits a client or vehicle that
    holds very many rides.
    """
    if vehicles is not None:
        rides = rides.join(vehicles.select("vehiculo_id", *VEHICLE_ATTRIBUTES), "vehiculo_id", "left")
    if clients is not None:
        rides = rides.join(clients.select("cliente_id", *CLIENT_ATTRIBUTES), "cliente_id", "left")
    return rides


# One-number indicators.

def total_revenue(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum("pago_viaje"), F.lit(0.0)).alias("recaudacion_total"))


def trip_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("vehiculo_id", "viaje_id").alias("total_viajes"))


def distinct_count(df: DataFrame, col: str, out: str, approximate: bool = False) -> DataFrame:
    return df.agg((F.approx_count_distinct(col) if approximate else F.count_distinct(col)).alias(out))


def mean(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.agg(F.avg(col).alias(out))


def revenue_per_trip(df: DataFrame) -> DataFrame:
    """Revenue over trips. One shuffle: rows collapse to one per (vehicle, trip) before it."""
    per = df.groupBy("vehiculo_id", "viaje_id").agg(F.sum("pago_viaje").alias("_p"))
    trips = F.count(F.when(F.col("vehiculo_id").isNotNull() & F.col("viaje_id").isNotNull(), 1))
    return per.agg((F.coalesce(F.sum("_p"), F.lit(0.0)) / F.nullif(trips, F.lit(0))).alias("recaudacion_por_viaje"))


def mean_of_means(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    """Unweighted mean of the groups' means."""
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(col).alias("_m"))
    return means.agg(F.avg("_m").alias(out))


def kpis(enriched: DataFrame) -> DataFrame:
    """All indicators in one row and one pass over the rides.

    Grouping sets reduce the rides to (vehicle, trip, driver) subtotals and to clients before the
    shuffle. The few rows left are regrouped by trip and by driver, and then added up.
    """
    means = ("rating", "edad_cliente", "anio_registro_app")
    ride, client = ["vehiculo_id", "viaje_id", "nombre_conductor"], ["cliente_id"]
    base = enriched.groupingSets([ride, client], *ride, *client).agg(
        F.grouping("cliente_id").alias("g"), F.sum("pago_viaje").alias("p"),
        *[f(c).alias(f"{n}_{c}") for c in means for n, f in (("s", F.sum), ("n", F.count))],
    )
    measures = ["p", *[f"{n}_{c}" for c in means for n in "sn"]]

    def part(kind: str, k1: Column, k2: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), k1.cast("string").alias("k1"), k2.cast("string").alias("k2"), *measures)

    none, col = F.lit(None), F.col
    by_ride = F.array(part("total", none, none), part("trip", col("vehiculo_id"), col("viaje_id")), part("driver", col("nombre_conductor"), none))
    by_client = F.array(part("client", F.pmod(F.xxhash64("cliente_id"), F.lit(64)), none))
    keyed = base.where((col("g") == 1) | col("cliente_id").isNotNull()).select(F.explode(F.when(col("g") == 1, by_ride).otherwise(by_client)).alias("x")).select("x.*")
    few = keyed.groupBy("kind", "k1", "k2").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures])

    total, driver = col("kind") == "total", (col("kind") == "driver") & col("k1").isNotNull()
    revenue = F.coalesce(F.sum(F.when(total, col("p"))), F.lit(0.0))
    trips = F.count(F.when((col("kind") == "trip") & col("k1").isNotNull() & col("k2").isNotNull(), 1))

    def mean_of(c: str) -> Column:
        return F.sum(F.when(total, col(f"s_{c}"))) / F.nullif(F.sum(F.when(total, col(f"n_{c}"))), F.lit(0))

    return few.agg(
        revenue.alias("recaudacion_total"), trips.alias("total_viajes"), (revenue / F.nullif(trips, F.lit(0))).alias("recaudacion_por_viaje"),
        F.count(F.when(driver, 1)).alias("conductores_activos"), F.coalesce(F.sum(F.when(col("kind") == "client", col("rows"))), F.lit(0)).alias("clientes_unicos"),
        F.avg(F.when(driver, col("s_rating") / F.nullif(col("n_rating"), F.lit(0)))).alias("rating_medio"),
        mean_of("edad_cliente").alias("edad_media"), mean_of("anio_registro_app").alias("anio_registro_medio"),
    )


# Grouped reports. Rows without a key are left out, as a data-frame group-by does.

def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def revenue_by(df: DataFrame, key: str) -> DataFrame:
    return (
        _keyed(df, key).groupBy(key).agg(F.coalesce(F.sum("pago_viaje"), F.lit(0.0)).alias("recaudacion"))
        .orderBy(F.desc("recaudacion"), key)
    )


def top_revenue(df: DataFrame, key: str, n: int = 14) -> DataFrame:
    return revenue_by(df, key).limit(n)


def counts(df: DataFrame, key: str, out: str = "num_viajes", n: int | None = None) -> DataFrame:
    """Rides per key, most first; ties by key."""
    all_rows = _keyed(df, key).groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), key)
    return all_rows if n is None else all_rows.limit(n)


def shares(df: DataFrame, key: str) -> DataFrame:
    """Count and percentage per key; the base is every row, also those without a key. The counts are
    stored, so that the total does not read the rides a second time."""
    per = durable(df.groupBy(key).agg(F.count(F.lit(1)).alias("cantidad")), "shares")
    total = per.agg(F.sum("cantidad").alias("n")).scalar()
    return _keyed(per, key).select(key, "cantidad", (F.col("cantidad") * 100.0 / total).alias("porcentaje"))


def of_top(df: DataFrame, key: str, n: int = 14) -> DataFrame:
    """Rows whose key is among the n most frequent ones."""
    return df.join(F.broadcast(counts(df, key, "_n", n).select(key)), key, "left_semi")


#: Parts into which each round of a selection cuts the range that holds a wanted rank.
PARTS = 1024


def quantiles(seen: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """Exact interpolated quantiles per key as the array ``q``, from a written table of distinct values ``x`` with counts ``n``.

    No task ever holds the values of a key. Each round counts values by ``PARTS`` parts of the range in which a wanted rank
    lies and keeps the part that holds it, shrunk to the values it has; a rank is found when one value is left. A
    range is narrowed by its own extremes too, so the rounds are few: two or three for evenly spread values, and in the worst
    case as many as the digits of a double allow. Values must be finite.
    """
    place = F.col("share") * (F.col("rows") - 1)
    wanted = (
        seen.groupBy(*keys).agg(F.sum("n").alias("rows"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
        .withColumn("before", F.lit(0).cast("long"))
    )
    wanted = durable(wanted, "ranks")
    span = [*keys, "lo", "hi"]
    while wanted.where("hi > lo").limit(1).count():
        ranges = wanted.where("hi > lo").select(*span, "before").distinct()
        part = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS), F.lit(PARTS - 1))
        parts = (
            seen.join(ranges, keys).where(F.col("x").between(F.col("lo"), F.col("hi")))
            .groupBy(*span, "before", part.alias("part")).agg(F.sum("n").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
        )
        upto = F.col("before") + F.sum("n").over(Window.partitionBy(*span, "before").orderBy("part"))
        parts = parts.withColumn("upto", upto).select(*span, "before", "least", "most", (F.col("upto") - F.col("n")).alias("below"), "upto")
        found = wanted.where("hi > lo").join(parts, [*span, "before"]).where((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("upto")))
        narrowed = found.select(*keys, "rows", F.col("least").alias("lo"), F.col("most").alias("hi"), "share", "rank", F.col("below").alias("before"))
        wanted = durable(wanted.where("hi = lo").unionByName(narrowed), "ranks")
    rest = F.col("share") * (F.col("rows") - 1) - F.floor(F.col("share") * (F.col("rows") - 1))
    each = wanted.groupBy(*keys, "share", "rows").agg(F.min("lo").alias("a"), F.max("lo").alias("b"))
    one = each.select(*keys, "share", (F.col("a") + rest * (F.col("b") - F.col("a"))).alias("v"))
    return one.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("share", "v"))), lambda t: t["v"]).alias("q"))


def box_stats(df: DataFrame, key: str, value: str, n: int = 14) -> DataFrame:
    """Five-number summary, whiskers and outliers per key, for the n most frequent keys.

    One pass over the rows: they collapse to (key, value) counts, which are written. Quartiles come from these by
    selection (``quantiles``), and everything else is a sum or an extreme over them.
    """
    seen = durable(_keyed(df, key).groupBy(key, F.col(value).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n")), "box")
    top = durable(seen.groupBy(key).agg(F.sum("n").alias("_rows")).orderBy(F.desc("_rows"), key).limit(n), "box_keys")
    known = durable(seen.where(F.col("x").isNotNull()).join(F.broadcast(top), key), "box_values")  # top has n rows
    quartiles = quantiles(known.select(key, "x", "n"), [key], [0.25, 0.5, 0.75])
    measured = known.join(F.broadcast(quartiles), key).select("*", *[F.col("q")[i].alias(name) for i, name in enumerate(("q1", "mediana", "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    summed = measured.groupBy(key, "q1", "mediana", "q3").agg(
        F.sum("n").alias("n"), F.min("x").alias("minimo"), F.max("x").alias("maximo"),
        F.min(F.when(inside, F.col("x"))).alias("bigote_inferior"), F.max(F.when(inside, F.col("x"))).alias("bigote_superior"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("atipicos"),
    )
    # A key without any value keeps its row.
    return (
        top.join(F.broadcast(summed), key, "left").withColumn("atipicos", F.coalesce("atipicos", F.lit(0)))
        .orderBy(F.desc("_rows"), key)
        .select(key, "n", "minimo", "q1", "mediana", "q3", "maximo", "bigote_inferior", "bigote_superior", "atipicos")
    )


def driver_profile(enriched: DataFrame) -> DataFrame:
    """Mean rating, mileage, client age and licence points per driver, each scaled to [0, 1] over
    all drivers; a measure that does not vary is NULL. The radar shows the smallest name."""
    cols = ["rating", "kilometraje", "edad_cliente", "puntos_carnet"]
    per = _keyed(enriched, "nombre_conductor").groupBy("nombre_conductor").agg(*[F.avg(c).alias(c) for c in cols])
    return min_max(durable(per, "profile"), cols)


def min_max(df: DataFrame, cols: list[str]) -> DataFrame:
    ends = df.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).alias("e")).scalar()
    return df.withColumn("_e", ends).withColumns(
        {c: (F.col(c) - F.col(f"_e.lo_{c}")) / F.nullif(F.col(f"_e.hi_{c}") - F.col(f"_e.lo_{c}"), F.lit(0.0)) for c in cols}
    ).drop("_e")


def per_ride(rides: DataFrame, dimension: DataFrame, key: str, col: str) -> DataFrame:
    """Values of a dimension's measure with the rides they stand for, ``x, n``.

    Rides are counted by key before they meet the dimension, so one row per key is joined and not the facts.
    """
    counted = _keyed(rides, key).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    met = counted.join(dimension.select(key, F.col(col).cast("double").alias("x")), key)
    return met.where(F.col("x").isNotNull()).groupBy("x").agg(F.sum("n").alias("n"))


def mean_of_tally(counts: DataFrame, out: str) -> DataFrame:
    return counts.agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias(out))


def tally(df: DataFrame, col: str) -> DataFrame:
    """Distinct values with their counts."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Quartiles, mean and range of a measure; quartiles by selection (``quantiles``). No values give one row of NULLs."""
    t = durable(tally(df, col).withColumn("_all", F.lit(0)), "tally")
    q = quantiles(t, ["_all"], [0.25, 0.5, 0.75]).agg(F.first("q").alias("q")).scalar()
    whole = t.agg(F.sum("n").alias("n"), F.min("x").alias("minimo"), F.max("x").alias("maximo"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("media"))
    return whole.withColumn("_q", q).select("n", "minimo", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("mediana"), F.col("_q")[2].alias("q3"), "maximo", "media")


def density_curve(df: DataFrame, col: str, grid: int = 100) -> DataFrame:
    """Gaussian kernel density on ``grid`` evenly spaced points from minimum to maximum, with
    Scott's bandwidth.

    Each distinct value, weighted by its count, adds to every grid point, so the cost is distinct
    values x grid whatever the number of rides. The counts are stored and read for both steps.
    """
    t = durable(tally(df, col), "tally")
    s = F.sum("n")
    first, second = F.sum(F.col("x") * F.col("n")), F.sum(F.col("x") * F.col("x") * F.col("n"))
    sd = F.sqrt((second - first * first / s) / (s - 1))
    stats = t.agg(F.struct(s.alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), (sd * F.pow(s, F.lit(-0.2))).alias("h")).alias("s")).scalar()
    points = t.withColumn("_s", stats).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    at = F.col("_s.lo") + F.col("i") * (F.col("_s.hi") - F.col("_s.lo")) / (grid - 1)
    z = (at - F.col("x")) / F.col("_s.h")
    bump = F.col("n") * F.exp(-0.5 * z * z) / (F.col("_s.n") * F.col("_s.h") * math.sqrt(2 * math.pi))
    return points.groupBy(F.col("i").alias("punto")).agg(F.first(at).alias("x"), F.sum(bump).alias("densidad"))


def grid_density(df: DataFrame, lat: str = "latitud", lon: str = "longitud", cell: float = 0.01) -> DataFrame:
    """Rides per map cell."""
    return (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.floor(F.col(lat) / cell).alias("fila"), F.floor(F.col(lon) / cell).alias("columna"))
        .agg(F.count(F.lit(1)).alias("viajes"))
    )


def histogram(df: DataFrame, col: str | None, bins: int, lo: float | None = None, hi: float | None = None, density: bool = False) -> DataFrame:
    """Counts in ``bins`` equal bins of [lo, hi]; the top edge belongs to the last bin.

    Bounds left out are the data's own. ``density`` divides by rows x bin width. Values are counted
    before they are binned; where bounds or the number of rows are needed first, the counts are
    stored, so the rides are read once in any case. With known bounds values are binned at once.
    Without ``col``, ``df`` holds counts already (``x, n``).
    """
    if col is None:
        t = df
    elif lo is not None and hi is not None and not density:
        t = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"), F.lit(1).cast("long").alias("n"))
    else:
        t = tally(df, col)
    if lo is None or hi is None or density:
        t = durable(t, "tally")
        ends = t.agg(F.struct(
            (F.min("x") if lo is None else F.lit(float(lo))).alias("lo"), (F.max("x") if hi is None else F.lit(float(hi))).alias("hi"), F.sum("n").alias("n"),
        ).alias("e")).scalar()
    else:
        ends = F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), F.lit(0).alias("n"))
    t = t.withColumn("_e", ends).where((F.col("x") >= F.col("_e.lo")) & (F.col("x") <= F.col("_e.hi")))
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    index = F.least(F.coalesce(F.floor((F.col("x") - F.col("_e.lo")) / F.nullif(width, F.lit(0.0))), F.lit(0)), F.lit(bins - 1))
    t = t.select(index.cast("long").alias("intervalo"), F.col("_e.lo").alias("_lo"), width.alias("_w"), F.col("_e.n").alias("_all"), "n")
    out = t.groupBy("intervalo", "_lo", "_w", "_all").agg(F.sum("n").alias("cantidad"))
    start = F.col("_lo") + F.col("intervalo") * F.col("_w")
    cols = ["intervalo", start.alias("desde"), (start + F.col("_w")).alias("hasta"), "cantidad"]
    if density:
        cols.append((F.col("cantidad") / (F.col("_all") * F.col("_w"))).alias("densidad"))
    return out.select(*cols)


def mean_rating_histogram(df: DataFrame, bins: int = 7) -> DataFrame:
    """Histogram on [1, 10] of the mean rating per vehicle."""
    means = _keyed(df, "vehiculo_id").groupBy("vehiculo_id").agg(F.avg("rating").alias("puntuacion_promedio"))
    return histogram(means, "puntuacion_promedio", bins, 1.0, 10.0)


def gaussian_curve(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Normal density with the column's mean and sample deviation at evenly spaced points of mean -/+ 3 deviations."""
    stats = df.agg(F.avg(col).alias("mu"), F.stddev_samp(col).alias("sigma"))
    z = -3 + F.col("i") * 6 / (points - 1)
    return stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).select(
        F.col("i").alias("punto"), (F.col("mu") + z * F.col("sigma")).alias("x"),
        (F.exp(-0.5 * z * z) / (F.nullif(F.col("sigma"), F.lit(0.0)) * math.sqrt(2 * math.pi))).alias("densidad"),
    )


def display_kpis(row: DataFrame) -> DataFrame:
    """The indicators as the dashboard prints them."""
    return row.select(
        F.concat(F.format_number("recaudacion_total", 2), F.lit("€")).alias("recaudacion_total"),
        F.col("total_viajes").cast("string").alias("total_viajes"),
        F.concat(F.format_number("recaudacion_por_viaje", 2), F.lit("€")).alias("recaudacion_por_viaje"),
        F.round("rating_medio", 2).alias("rating_medio"), F.round("edad_media", 2).alias("edad_media"),
        F.format_number("anio_registro_medio", 0).alias("anio_registro_medio"),
    )
