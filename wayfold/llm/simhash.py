"""SimHash near-copies by meet-in-the-middle balls.

Two fingerprints that differ in at most r bits have a point between them, at most r // 2 bits from one and the rest from
the other. So every distinct fingerprint emits all points within half the radius; whatever meets at a point is close.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfold.llm.batches import map_batches, raw
from wayfold.llm.graph import components
from wayfold.session import durable

SEED = 42
_PART = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, as a signed integer: a bit is 1 if set in over half the hashes."""
    words = (text or b"").lower().split()  # for bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        begins = [0, *ends[: len(words) - shingle]]
        hashes = [digest(joined[b : e - 1], seed) for b, e in zip(begins, ends[shingle - 1 :])]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _PART):
        part = np.array(hashes[k : k + _PART], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` for every row; null and wordless texts have fingerprint zero. Map only."""

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"), "fp": [fingerprint(t, shingle) for t in raw(batch, "text")]}

        return step

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), make, "doc_id long, fp long")


def _masks(radius: int) -> list[int]:
    """All 64-bit patterns with at most ``radius`` bits set, as signed integers."""
    found = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Verified links ``a, b`` that connect whatever differs in at most ``max_bits`` bits; ``distinct`` has each ``fp`` once.

    A point holds at most a ball of fingerprints, whatever the number of copies. Instead of all pairs at a point, each is
    linked to the smallest one that lies in the inner half: a point's inner fingerprints are within the radius of all
    others there, so the links connect the same groups.
    """
    inner, outer = max_bits // 2, max_bits - max_bits // 2
    spread = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in _masks(outer)])).alias("mask"))
    met = spread.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), (F.bit_count("mask") <= inner).alias("inside"))
    hub = F.min(F.when(F.col("inside"), F.col("fp"))).over(Window.partitionBy("point"))
    return (
        met.select("fp", hub.alias("hub")).where(F.col("hub") != F.col("fp"))
        .where(F.bit_count(F.col("hub").bitwiseXOR(F.col("fp"))) <= max_bits)
        .select(F.greatest("fp", "hub").alias("a"), F.least("fp", "hub").alias("b")).distinct()
    )


def near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: for every row the smallest ``doc_id`` reachable over links of at most ``max_bits`` bits.

    Copies share a fingerprint and are reduced to it, with their smallest id, before anything spreads. Rows with a null
    ``doc_id`` stay and take their group's id (null if the group has none). Repeated rows stay; an empty table gives none.
    """
    marked = durable(fingerprints(docs, shingle), "fingerprints")
    firsts = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(firsts.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stand for their group of near copies: its smallest ``doc_id``.

    Repeated rows of that id stay once. Rows without an id stand for nobody; equal texts among them stay once.
    """
    keep = near_copies(docs, shingle, max_bits).where("doc_id = component_id").select(F.col("component_id").alias("__keep")).distinct()
    named = docs.join(keep, docs["doc_id"].cast("long") == F.col("__keep"), "left_semi").dropDuplicates(["doc_id"])
    return named.union(docs.where(F.col("doc_id").isNull()).dropDuplicates(["text"]))
