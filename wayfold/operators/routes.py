"""Operators over route points (viaje_id, punto_ruta, latitud, longitud)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfold.functions.geo import haversine_m

# Points of a trip that are handled together; longer trips spread over several tasks.
RUN = 10_000


def _next_point(points: DataFrame, cross_trip: bool, run: int) -> DataFrame:
    """Attach the following point as ``_next``.

    A trip is cut into runs of consecutive points so that a very long one is not sorted by a single
    task. Inside a run the neighbour is the next row; the last row takes the head of the next run,
    and across trips the head of the next trip, from a frame with one row per run.
    """
    here = F.struct("latitud", "longitud")
    p = points.withColumn("_run", F.floor((F.col("punto_ruta") - 1) / run))
    heads = p.groupBy("viaje_id", "_run").agg(F.min_by(here, "punto_ruta").alias("_head"))
    ahead = heads.select(
        "viaje_id", "_run",
        F.lead("_head").over(Window.partitionBy("viaje_id").orderBy("_run")).alias("_ahead"),
    )
    if cross_trip:
        following = _next_trip(heads.groupBy("viaje_id").agg(F.min_by("_head", "_run").alias("_first")))
        ahead = ahead.join(following, "viaje_id").select(
            "viaje_id", "_run", F.coalesce("_ahead", "_trip").alias("_ahead")
        )
    inside = F.lead(here).over(Window.partitionBy("viaje_id", "_run").orderBy("punto_ruta"))
    return (
        p.withColumn("_inside", inside).join(ahead, ["viaje_id", "_run"])
        .withColumn("_next", F.coalesce("_inside", "_ahead")).drop("_inside", "_ahead", "_run")
    )


def _next_trip(trips: DataFrame, block: int = 1000) -> DataFrame:
    """First point of the next trip id as ``_trip``: inside blocks of ids in parallel, and over the
    last trip of each block from one row per block."""
    t = trips.withColumn("_block", F.floor(F.col("viaje_id") / block))
    blocks = t.groupBy("_block").agg(F.min_by("_first", "viaje_id").alias("_b"))
    after = blocks.select("_block", F.lead("_b").over(Window.orderBy("_block")).alias("_after"))
    inside = F.lead("_first").over(Window.partitionBy("_block").orderBy("viaje_id"))
    return t.withColumn("_in", inside).join(after, "_block").select("viaje_id", F.coalesce("_in", "_after").alias("_trip"))


def with_leg_distance(points: DataFrame, cross_trip: bool = False, run: int = RUN) -> DataFrame:
    """Metres to the next point as ``distancia``; the last point gets 0.

    With ``cross_trip`` a trip's last point measures to the first point of the next trip id, which
    is what a pass over the whole unsplit table gives; only the very last row gets 0 then.
    """
    leg = haversine_m("latitud", "longitud", F.col("_next.latitud"), F.col("_next.longitud"))
    return _next_point(points, cross_trip, run).withColumn("distancia", F.coalesce(leg, F.lit(0.0))).drop("_next")


def endpoints(points: DataFrame) -> DataFrame:
    """Per trip: first and last point, number of points, largest latitude and longitude."""
    here = F.struct("latitud", "longitud")
    return (
        points.groupBy("viaje_id")
        .agg(
            F.min_by(here, "punto_ruta").alias("_a"), F.max_by(here, "punto_ruta").alias("_z"),
            F.max("punto_ruta").alias("ultimo_punto"), F.count(F.lit(1)).alias("puntos"),
            F.max("latitud").alias("latitud_max"), F.max("longitud").alias("longitud_max"),
        )
        .select(
            "viaje_id", F.col("_a.latitud").alias("latitud_inicio"), F.col("_a.longitud").alias("longitud_inicio"),
            F.col("_z.latitud").alias("latitud_final"), F.col("_z.longitud").alias("longitud_final"),
            "ultimo_punto", "puntos", "latitud_max", "longitud_max",
        )
    )


def trip_ids(points: DataFrame) -> DataFrame:
    return points.select("viaje_id").distinct()


def polyline(points: DataFrame, piece: int = 1000) -> DataFrame:
    """The drawn line per trip, as pieces of at most ``piece`` points in order.

    Each piece ends with the first point of the next one, so the pieces join up; a row never holds
    more than ``piece`` + 1 points however long the trip is.
    """
    first = F.floor((F.col("punto_ruta") - 1) / piece)
    shared = F.when((F.col("punto_ruta") > 1) & ((F.col("punto_ruta") - 1) % piece == 0), F.array(first - 1, first)).otherwise(F.array(first))
    return (
        points.withColumn("pieza", F.explode(shared))
        .groupBy("viaje_id", "pieza")
        .agg(F.sort_array(F.collect_list(F.struct("punto_ruta", "latitud", "longitud"))).alias("_p"))
        .select("viaje_id", "pieza", F.transform("_p", lambda x: F.struct(x["latitud"].alias("latitud"), x["longitud"].alias("longitud"))).alias("linea"))
    )


def join_trips(points: DataFrame, per_trip: DataFrame, run: int = RUN) -> DataFrame:
    """Join rows that have a trip's ``ultimo_punto`` to all its points.

    The key is (trip, run of points), with one copy of the trip's row per run, so the points of a
    very long trip do not meet in one task.
    """
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("ultimo_punto") - 1) / run)))
    left = points.withColumn("_run", F.floor((F.col("punto_ruta") - 1) / run))
    return left.join(per_trip.withColumn("_run", runs).drop("ultimo_punto"), ["viaje_id", "_run"]).drop("_run")


def with_destination(points: DataFrame, run: int = RUN) -> DataFrame:
    """Every point with the last point of its trip as destination."""
    return join_trips(points, endpoints(points).select("viaje_id", "latitud_final", "longitud_final", "ultimo_punto"), run)


def stride(points: DataFrame, n: int = 20) -> DataFrame:
    """Every n-th point, from the first."""
    return points.where((F.col("punto_ruta") - 1) % n == 0)


def centre(df: DataFrame, lat: str = "latitud", lon: str = "longitud") -> DataFrame:
    return df.agg(F.avg(lat).alias("latitud_centro"), F.avg(lon).alias("longitud_centro"))


def of_trip(df: DataFrame, trip: int) -> DataFrame:
    return df.where(F.col("viaje_id") == trip)


def unknown_trips(requested: DataFrame, points: DataFrame) -> DataFrame:
    """Requested trip ids that have no route; such a request yields no positions."""
    return requested.select("viaje_id").distinct().join(trip_ids(points), "viaje_id", "left_anti")
