"""Vehicle positions and ride requests as tables, ready to be matched or published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions import draws as D
from wayfold.operators.routes import endpoints, join_trips
from wayfold.operators.sampling import rank_by_hash
from wayfold.operators.synth import PAYMENT_WEIGHTS, PAYMENTS


def draw_runs(runs: DataFrame, seed: int, trips: int = 38) -> DataFrame:
    """Trip, vehicle and seats of each run (``run_id``, ``start_ts``)."""
    return runs.withColumns({
        "viaje_id": D.int_between(D.uniform("run_id", seed, "viaje"), 1, trips),
        "vehiculo_id": D.int_between(D.uniform("run_id", seed, "vehiculo"), 1, 1000),
        "num_plazas": D.int_between(D.uniform("run_id", seed, "plazas"), 1, 4),
    })


def replay_routes(points: DataFrame, runs: DataFrame, cadence_s: int = 7) -> DataFrame:
    """Positions of every run: the points of its trip in order, one each ``cadence_s`` seconds, with
    the trip's last point as destination. Runs on a trip without route yield nothing.

    The destination is joined to the runs, which are few, and the result to the points once.
    """
    ends = endpoints(points).select("viaje_id", "latitud_final", "longitud_final", "ultimo_punto")
    moved = join_trips(points.select("viaje_id", "punto_ruta", "latitud", "longitud"), runs.join(ends, "viaje_id"))
    return moved.select(
        "run_id", "viaje_id", "vehiculo_id", "punto_ruta", "latitud", "longitud", "num_plazas", "latitud_final", "longitud_final",
        F.timestamp_micros(F.unix_micros(F.col("start_ts").cast("timestamp")) + (F.col("punto_ruta") - 1) * cadence_s * 1000000).alias("ts"),
    )


def request_batches(points: DataFrame, clients: DataFrame, ticks: DataFrame, seed: int, every_s: int = 3, trips: int = 38) -> DataFrame:
    """Ride requests: at every tick each client asks for its own fixed trip from near a route point.

    ``clients`` has ``cliente_id`` and ``posicion`` 1..n; ``ticks`` has ``tick`` and ``start_ts``. A
    tick's points are drawn without repetition and on their own: points get one random ranking, and each tick takes the first
    n ranks of its own permutation of it. So points are ranked once, not once per tick. Ticks are dealt out before they
    meet the clients: few and small as they are, one task would draw all requests.
    """
    ranked = rank_by_hash(points, ["viaje_id", "punto_ruta"], seed, "_rank").select(
        F.col("_rank"), F.col("latitud").alias("_lat"), F.col("longitud").alias("_lon")
    )
    total = points.agg(F.count(F.lit(1)).alias("n")).scalar()
    n = clients.agg(F.max("posicion").alias("n")).scalar()
    spread = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = (
        ticks.repartition(spread, "tick").withColumn("_n", total)
        .withColumn("posicion", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    )
    # More clients than points begin the permutation again.
    asked = D.with_permuted(asked, "_rank", (F.col("posicion") - 1) % F.col("_n"), F.col("_n"), "tick", seed, "punto").withColumn("_rank", F.col("_rank") + 1)
    placed = asked.join(clients, "posicion").join(ranked, "_rank")
    key = ["cliente_id", "tick"]
    return placed.select(
        "tick", "cliente_id", D.int_between(D.uniform("cliente_id", seed, "viaje"), 1, trips).alias("viaje_id"),
        jitter("_lat", key, seed, "lat", 1).alias("latitud"), jitter("_lon", key, seed, "lon", -1).alias("longitud"),
        D.beta_int(key, seed, "rating", 4, 2, 1, 10).alias("rating"),
        D.weighted(D.uniform(key, seed, "pago"), PAYMENTS, PAYMENT_WEIGHTS).alias("metodo_pago"),
        F.timestamp_micros(F.unix_micros(F.col("start_ts").cast("timestamp")) + F.col("tick") * every_s * 1000000).alias("ts"),
    )


def jitter(col: str, key, seed: int, salt: str, sign: int):
    """Move a coordinate by 0.001 to 0.002 degrees."""
    return F.col(col) + sign * (0.001 + 0.001 * D.uniform(key, seed, salt))
