"""KML routes to route points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfold.session import durable


def lines(documents: DataFrame, document: str = "value") -> DataFrame:
    """Replace a KML text column by the coordinate text of its first LineString as ``coordenadas``.
    Documents without one are left out."""
    others = [c for c in documents.columns if c != document]
    first = F.expr(f"xpath_string(`{document}`, '(//LineString/coordinates)[1]')")
    return documents.select(*others, F.trim(F.regexp_replace(first, r"\s+", " ")).alias("coordenadas")).where(F.length("coordenadas") > 0)


def number_files(lines: DataFrame, file: str = "_file") -> DataFrame:
    """Replace the file by a trip id: its place among the files, by path, that hold a line.

    Lines are numbered before they become points, and by many tasks: files are dealt by ranges of their paths, each range
    numbers its own, and what earlier ranges hold is added (one row per range).
    """
    dealt = durable(lines.select(file).repartitionByRange(file).select(file, F.spark_partition_id().alias("_range")), "files")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    own = dealt.withColumn("_own", F.row_number().over(Window.partitionBy("_range").orderBy(file)))
    numbered = own.join(F.broadcast(earlier), "_range").select(file, (F.col("_before") + F.col("_own")).cast("long").alias("viaje"))
    return lines.join(numbered, file).drop(file)


def points(lines: DataFrame) -> DataFrame:
    """One row per point: ``punto`` (from 1), ``latitude``, ``longitude``, ``altitude``."""
    others = [c for c in lines.columns if c != "coordenadas"]
    each = lines.select(*others, F.posexplode(F.split("coordenadas", " ")).alias("_pos", "_triple"))
    part = F.split("_triple", ",")
    return each.select(
        *others, (F.col("_pos") + 1).cast("long").alias("punto"),
        part[1].cast("double").alias("latitude"), part[0].cast("double").alias("longitude"), part[2].cast("double").alias("altitude"),
    )


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.kml`` files of a folder as (viaje, punto, latitude, longitude, altitude). Files are parsed once: their lines
    are written, and numbered and cut into points from there."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.kml").select("value", F.input_file_name().alias("_file"))
    return points(number_files(durable(lines(raw), "routes")))
