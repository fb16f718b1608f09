"""The streaming matcher run over the event table as a file stream, from message text to a stored table.

Pings are written as JSON text, decoded, matched and appended to a table. All rows arrive, the watermark moves to the last event, and windows that end by then are emitted; the
checks select the same windows.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wayfold.plans import proxy
from wayfold.plans.match_queries import CLOUD, FARE, LOCAL, PINGS, REMEMBER_WINDOW, RIDE_SQL, fold_cte, shown, whole_rating
from wayfold.plans.registry import query
from wayfold.schemas import CLIENT_MESSAGE, VEHICLE_MESSAGE
from wayfold.session import shared_folder
from wayfold.sources import messages, tables
from wayfold.streaming.match import match_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings for the start of a query, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def timed(pings):
    return pings.withColumn("ts", F.col("ts").cast("timestamp"))


def run_stream(i, window: str, km: float, remember: bool):
    spark, folder = i.spark, f"{shared_folder(i.spark)}/stream-{uuid.uuid4().hex}"
    events = spark.readStream.schema(i.events.schema).parquet(f"{i.sf_dir}/*events.parquet")
    v, u = (
        messages.decode(messages.to_messages(sent(spark.sql(proxy.VIEWS[name][1], events=events))), schema)[0]
        for name, sent, schema in (("vehicle_pings", timed, VEHICLE_MESSAGE), ("client_pings", lambda pings: whole_rating(timed(pings)), CLIENT_MESSAGE))
    )
    # Counting the rows of a store costs a lookup before every write; the join's state is most of the disk.
    store = "spark.sql.streaming.stateStore"
    conf = {f"{store}.providerClass": ROCKSDB, f"{store}.rocksdb.trackTotalNumberOfRows": "false", f"{store}.rocksdb.compression": "zstd"}
    rides = match_stream(v, u, window, km, remember=remember)
    table = f"rides_{uuid.uuid4().hex}"
    with settings(spark, **conf):
        tables.ensure_table(spark, table, rides.schema, path=f"{folder}/rides")
        tables.start_append_stream(rides, table, f"{folder}/checkpoint", rides.schema).awaitTermination()
    stored = shown(spark.read.schema(rides.schema).parquet(f"{folder}/rides"))
    spark.sql(f"DROP TABLE {table}")  # its files stay in the folder
    return stored


def closed(hours: int) -> str:
    last = "SELECT least((SELECT max(ts) FROM vehicle_pings), (SELECT max(ts) FROM client_pings))"
    return f"{RIDE_SQL} WHERE h.ventana + INTERVAL {hours} HOUR <= ({last})"


@query("streamed_match", PINGS, closed(6), more=f"{CLOUD},\n{fold_cte(['ventana', 'viaje_id'])},\n{FARE}")
def _(i):
    return run_stream(i, proxy.WINDOW, 2.0, False)


@query("streamed_match_remembering", PINGS, closed(3), more=f"{LOCAL},\n{fold_cte(['viaje_id'])},\n{FARE}")
def _(i):
    return run_stream(i, REMEMBER_WINDOW, 5.0, True)
