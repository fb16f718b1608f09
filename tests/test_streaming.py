"""Streams give what the batch form gives on the same rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wayfold import schemas
from wayfold.operators import matching as M
from wayfold.plans import proxy
from wayfold.sources import messages as S
from wayfold.sources import tables
from wayfold.streaming.match import match_stream

SHOWN = ["ventana", "viaje_id", "vehiculo_id", "v_event", "cliente_id", "u_event", "plazas_ocupadas", "timestamp"]
MICRO = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def publish(df, fields, folder, batch):
    """One file of messages."""
    S.to_messages(df, fields).coalesce(1).write.mode("append").options(**MICRO).json(f"{folder}/{batch}")


def sentinel(df):
    """A far later record on a trip of its own: it moves the watermark past everything else."""
    return df.limit(1).withColumn("ts", F.lit(dt.datetime(2024, 6, 1))).withColumn("viaje_id", F.lit(999).cast("long"))


POSITION = [f.name for f in schemas.VEHICLE_MESSAGE.fields]
REQUEST = [f.name for f in schemas.CLIENT_MESSAGE.fields]


@pytest.fixture
def feed(spark, small, tmp_path):
    v = proxy.view(spark, small, "vehicle_pings")
    u = proxy.view(spark, small, "client_pings").withColumn("rating", F.col("rating").cast("long"))
    for df, fields, name in ((v, POSITION, "v"), (u, REQUEST, "u")):
        publish(df, fields, tmp_path / name, "first")
        publish(sentinel(df), fields, tmp_path / name, "first")
    streams = []
    for name, schema in (("v", schemas.VEHICLE_MESSAGE), ("u", schemas.CLIENT_MESSAGE)):
        raw = S.read_message_stream(spark, f"{tmp_path}/{name}/*", **MICRO)
        streams.append(S.decode(raw, schema)[0])
    return v, u, *streams, tmp_path


def run(df, folder):
    q = df.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    return q


def same(a, b):
    a, b = a.select(*SHOWN), b.select(*SHOWN)
    assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()


def test_windows_on_their_own_then_late_rows_and_restart(spark, feed):
    v, u, vs, us, folder = feed
    stream = match_stream(vs, us, "6 hours", 2.0)
    run(stream, folder)
    expected = M.greedy_match(v, u, "6 hours", 2.0)
    same(spark.read.parquet(f"{folder}/out"), expected)
    # The same rows once more, now far behind the watermark: dropped, and nothing is emitted twice.
    publish(v.withColumn("event_id", F.col("event_id") + 10**6), POSITION, folder / "v", "late")
    q = run(stream, folder)
    same(spark.read.parquet(f"{folder}/out"), expected)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])
    assert dropped > 0


def test_memory_across_windows(spark, feed):
    v, u, vs, us, folder = feed
    run(match_stream(vs, us, "3 hours", 5.0, remember=True), folder)
    same(spark.read.parquet(f"{folder}/out"), M.greedy_match_remembering(v, u, "3 hours", 5.0))


def test_ride_sink_needs_its_table_and_appends(spark, feed):
    v, u, vs, us, folder = feed
    stream = match_stream(vs, us, "6 hours", 2.0)
    with pytest.raises(ValueError):
        tables.start_append_stream(stream, "sin_tabla", f"{folder}/ck2", schemas.RIDES)
    tables.ensure_table(spark, "viajes_cobrados", schemas.RIDES)
    tables.start_append_stream(stream, "viajes_cobrados", f"{folder}/ck2", schemas.RIDES).awaitTermination(240)
    got = spark.read.table("viajes_cobrados")
    assert got.schema == schemas.RIDES and got.count() == M.greedy_match(v, u, "6 hours", 2.0).count()


V = "event_id long, ts timestamp, viaje_id long, vehiculo_id long, num_plazas long, latitud double, longitud double, latitud_final double, longitud_final double"
U = "event_id long, ts timestamp, viaje_id long, cliente_id long, latitud double, longitud double, rating double, metodo_pago string"
START, PLACE, LATER = dt.datetime(2024, 1, 1), (39.45, -0.4), dt.datetime(2024, 6, 1)


def streams_of(spark, vs, us, folder):
    """File streams of pings, with a far later one on a trip of its own in each."""
    vs, us = [*vs, (-1, LATER, 999, 1, 1, *PLACE, *PLACE)], [*us, (-1, LATER, 999, 1, *PLACE, 5.0, "Bizum")]
    for rows, schema, name in ((vs, V, "v"), (us, U, "u")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
    return [spark.readStream.schema(schema).parquet(f"{folder}/{name}") for schema, name in ((V, "v"), (U, "u"))]


def test_a_busy_trip_is_folded_slice_by_slice(spark, tmp_path):
    rnd = random.Random(5)
    trip = lambda: 1 if rnd.random() < 0.4 else rnd.randint(2, 9)
    at = lambda: START + dt.timedelta(milliseconds=rnd.randrange(90_000))
    place = lambda: (39.45 + rnd.uniform(0, 0.02), -0.40 + rnd.uniform(0, 0.02))
    vs = [(k, at(), trip(), rnd.randint(1, 60), rnd.randint(1, 3), *place(), *place()) for k in range(250)]
    us = [(k, at(), trip(), rnd.randint(1, 300), *place(), 5.0, "Tarjeta") for k in range(500)]
    seen = []
    for remember, window in ((False, "30 seconds"), (True, "15 seconds")):
        folder = tmp_path / window.split()[0]
        stream = match_stream(*streams_of(spark, vs, us, folder), window, 2.0, remember=remember, time_slice="1 second")
        assert "collect_list" not in stream._jdf.queryExecution().toString()
        run(stream, folder)
        v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
        same(spark.read.parquet(f"{folder}/out"), (M.greedy_match_remembering if remember else M.greedy_match)(v, u, window, 2.0))
        seen.append(spark.read.parquet(f"{folder}/out").where("viaje_id = 1").count())
    assert min(seen) > 20


def test_memory_fades_after_its_time(spark, tmp_path):
    minute = lambda k: START + dt.timedelta(seconds=60 * k + 1)
    vs = [(k, minute(k), 1, 100 + k, 1, *PLACE, *PLACE) for k in range(5)]
    us = [(k, minute(k), 1, 7, *PLACE, 5.0, "Bizum") for k in range(5)]
    stream = match_stream(*streams_of(spark, vs, us, tmp_path), "60 seconds", 2.0, remember=True, ttl_ms=120_000)
    run(stream, tmp_path)
    # Taken in minute 0 and again in minutes 2 and 4: a window that ends two minutes later no longer remembers.
    assert sorted(r.v_event for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 2, 4]


def test_loose_rows_and_slices_meet_and_buckets_share_a_timer(spark, tmp_path, monkeypatch):
    from wayfold.streaming import match

    rnd = random.Random(9)
    at = lambda: START + dt.timedelta(milliseconds=rnd.randrange(120_000))
    place = lambda: (39.45 + rnd.uniform(0, 0.02), -0.40 + rnd.uniform(0, 0.02))
    vs = [(k, at(), rnd.randint(1, 6), rnd.randint(1, 9), rnd.randint(1, 3), *place(), *place()) for k in range(300)]
    us = [(k, at(), rnd.randint(1, 6), rnd.randint(1, 90), *place(), 5.0, "Tarjeta") for k in range(600)]
    monkeypatch.setattr(match, "BUCKETS", 2)
    v, u = spark.createDataFrame(vs, V), spark.createDataFrame(us, U)
    # Some rows loose and others filed by slice, then all filed.
    for loose, remember, window in ((1500, False, "30 seconds"), (1500, True, "15 seconds"), (0, True, "15 seconds")):
        folder = tmp_path / f"{loose}-{remember}"
        monkeypatch.setattr(match, "LOOSE", loose)
        with_small_batches = {"spark.sql.execution.arrow.maxRecordsPerBatch": "100"}
        before = {k: spark.conf.get(k) for k in with_small_batches}
        for k, x in with_small_batches.items():
            spark.conf.set(k, x)
        try:
            q = run(match_stream(*streams_of(spark, vs, us, folder), window, 2.0, remember=remember), folder)
        finally:
            for k, x in before.items():
                spark.conf.set(k, x)
        same(spark.read.parquet(f"{folder}/out"), (M.greedy_match_remembering if remember else M.greedy_match)(v, u, window, 2.0))
        timers = [o["customMetrics"]["numRegisteredTimers"] for p in q.recentProgress for o in p["stateOperators"] if "numRegisteredTimers" in o.get("customMetrics", {})]
        # A timer for each window of each trip was 24 or more.
        assert 0 < max(timers) <= 6
