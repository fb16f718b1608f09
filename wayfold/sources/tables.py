"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery


def scan(spark: SparkSession, table: str, *columns: str) -> DataFrame:
    """Whole table, or only the named columns (which then reach the file scan)."""
    df = spark.read.table(table)
    return df.select(*columns) if columns else df


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: str | None = None, path: str | None = None) -> None:
    """Create the table unless it exists, in ``path`` if one is named; required columns are declared NOT NULL."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    tail = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    tail += f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{tail}")


def conform(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Columns of ``schema`` by name, in its order, cast to its types; NULL in a required column fails the job."""
    df = df.withColumnsRenamed(dict(rename or {}))

    def field(f: T.StructField):
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{f.name} is required")).cast(f.dataType))
        return value.alias(f.name)

    return df.select(*[field(f) for f in schema.fields])


def append(df: DataFrame, table: str, schema: T.StructType, rename: Mapping[str, str] | None = None) -> None:
    """Append to an existing table; columns are mapped by name, never by position."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    conform(df, schema, rename).write.mode("append").format("parquet").saveAsTable(table)


def replace(df: DataFrame, table: str, schema: T.StructType | None = None, rename: Mapping[str, str] | None = None) -> None:
    """Write a table anew, with the declared schema if one is given."""
    df = df if schema is None else conform(df, schema, rename)
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def start_append_stream(df: DataFrame, table: str, checkpoint: str, schema: T.StructType, **trigger) -> StreamingQuery:
    """Append a stream to a table that must already exist."""
    if not df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    return (
        conform(df, schema)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .toTable(table)
    )
