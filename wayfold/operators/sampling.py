"""Samples, splits and permutations that depend on keys and a seed only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfold.functions.draws import hash_hex, uniform
from wayfold.session import durable

# Leading hash digits that form a bucket: 16**4 buckets.
BUCKET_DIGITS = 4


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _with_hash(df: DataFrame, key, seed: int) -> DataFrame:
    return df.withColumn("_h", hash_hex(_keys(key), seed, "orden")).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))


def _offsets(hashed: DataFrame) -> DataFrame:
    """Rows before each bucket; at most 65 536 rows whatever the input, so one task and a broadcast are safe."""
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("_b", "_n", F.coalesce(upto, F.lit(0)).alias("_before"))


def rank_by_hash(df: DataFrame, key, seed: int, out: str = "posicion") -> DataFrame:
    """Place of each row (from 1) in hash order, without sorting everything in one task. Rows that
    share a key take adjoining places in any order, so a key that names one row makes it repeatable.

    The hash spreads rows evenly, so buckets are even too: rank inside the bucket plus the rows
    before it.
    """
    hashed = _with_hash(df, key, seed)
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *_keys(key)))
    ranked = hashed.withColumn("_r", inside).join(F.broadcast(_offsets(hashed)), "_b")
    return ranked.withColumn(out, (F.col("_before") + F.col("_r")).cast("long")).select(*df.columns, out)


def permute(df: DataFrame, key, seed: int, out: str) -> DataFrame:
    """Give every row a different number of 1..n in random order."""
    return rank_by_hash(df, key, seed, out)


def sample_n(df: DataFrame, key: str | Sequence[str], n: int, seed: int) -> DataFrame:
    """Exactly n rows (all, if there are fewer); each task keeps its own best n before merging."""
    return df.orderBy(hash_hex(_keys(key), seed, "orden"), *_keys(key)).limit(n)


def sample_frac(df: DataFrame, key, f: float, seed: int, exact: bool = True) -> DataFrame:
    """The share ``f`` of the rows.

    ``exact`` gives round(f * count) rows: buckets are counted once, whole buckets below the cut are taken
    as they are and only rows of the bucket at the cut are ranked. Otherwise each row is drawn by its own hash, in one scan.
    """
    if not exact:
        return df.where(uniform(_keys(key), seed, "orden") < f)
    hashed = _with_hash(df, key, seed)
    offsets = durable(_offsets(hashed), "offsets")
    wanted = offsets.agg(F.bround(F.sum("_n") * F.lit(float(f)), 0).cast("long").alias("n")).first().n or 0
    cut = offsets.where(F.col("_before") < wanted).orderBy(F.desc("_before")).first()
    if cut is None:
        return df.limit(0)
    # The cut is known by now, so that rows are chosen by a filter on their own hash.
    if cut["_before"] + cut["_n"] <= wanted:
        return hashed.where(F.col("_b") <= cut["_b"]).select(*df.columns)
    rest = hashed.where(F.col("_b") == cut["_b"]).orderBy("_h", *_keys(key)).limit(wanted - cut["_before"])
    return hashed.where(F.col("_b") < cut["_b"]).unionByName(rest).select(*df.columns)


def split(df: DataFrame, key, f: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; a row keeps its side whatever the partitioning."""
    u = uniform(_keys(key), seed, "particion")
    return df.where(u < f), df.where(u >= f)


def preview(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
