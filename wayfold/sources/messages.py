"""JSON messages in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode(df: DataFrame, schema: T.StructType, col: str = "value", keep: tuple[str, ...] = ("ts", "event_id")) -> tuple[DataFrame, DataFrame]:
    """Parse UTF-8 JSON payloads; returns (valid, quarantine).

    A record is valid when every declared field is present. The quarantine keeps the payload with
    the reason, and only the bad record is set aside: its neighbours are matched as usual.
    Works on batch and streaming frames.
    """
    keep = tuple(c for c in keep if c in df.columns)
    text = F.col(col).cast("string")
    # Exploded, the record is parsed once; the optimizer would copy a plain column into every test of a field.
    parsed = df.select(*keep, text.alias("_text"), F.explode(F.array(F.from_json(text, schema, {"mode": "PERMISSIVE"}))).alias("_m"))
    names = [f.name for f in schema.fields]
    absent = F.filter(
        F.array(*[F.when(F.col(f"_m.{n}").isNull(), F.lit(n)) for n in names]), lambda x: x.isNotNull()
    )
    checked = parsed.withColumn("_absent", absent)
    valid = checked.where(F.size("_absent") == 0).select("_m.*", *keep)
    quarantine = checked.where(F.size("_absent") > 0).select(
        *keep,
        F.col("_text").alias("payload"),
        F.when(F.size("_absent") == len(names), F.lit("unreadable"))
        .otherwise(F.concat(F.lit("missing "), F.concat_ws(",", "_absent")))
        .alias("reason"),
    )
    return valid, quarantine


def to_messages(df: DataFrame, fields: list[str] | None = None, keep: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """One JSON text per row in ``value``; the envelope columns stay beside it."""
    keep = tuple(c for c in keep if c in df.columns)
    fields = fields or [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def read_message_stream(spark: SparkSession, path: str, fmt: str = "json", **options: str) -> DataFrame:
    """Streaming frame with ``ts, event_id, value`` from a folder, or any other streaming source
    that offers those columns (``fmt`` and ``options`` are passed on)."""
    envelope = T.StructType([
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("value", T.StringType()),
    ])
    return spark.readStream.format(fmt).schema(envelope).options(**options).load(path)
