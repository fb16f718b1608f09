"""Benchmark decontamination by greedy string tiling.

Every window of a benchmark item's tokens is a seed. Karp-Rabin hashes of a document's windows are looked up among the
seeds; windows that continue each other form matches; the longest match that touches no marked token is marked, again
and again. The share of an item that is marked tells a leak, whatever the order in which its parts appear.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.batches import map_batches, raw, slices

MIN_TILE = 5
#: Items of fewer tokens say too little to be told from chance and match nothing.
MIN_ITEM = 3
COVERAGE = 0.5
#: Benchmark text sent to the executors at once. Larger benchmarks go in several blocks, each held against all documents.
BLOCK_BYTES = 8 << 20
WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15
OUT = "doc_id long, item_id long, n_tokens long, n_covered long, coverage double, n_tiles long, longest long"


def tokens(text: bytes | str | None) -> list[str]:
    """Lower-cased words; punctuation and spacing do not count."""
    text = text or ""
    return WORD.findall((text.decode("utf-8") if isinstance(text, bytes) else text).lower())


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of each window of ``width`` ids, modulo 2**64, advanced for all windows at once."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x, out = ids.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + x[k : n + k] + np.uint64(1)
    return out


class SeedIndex:
    """Seeds of a block of items: window hashes with the items and places where they stand.

    An item of fewer than ``width`` tokens is one seed by itself. Seeds are sorted by hash and by the token before them, so
    that a document's window finds those that begin a match, without listing pairs that only continue one.
    """

    def __init__(self, items: list[tuple[int, str]], width: int = MIN_TILE):
        self.width, self.vocabulary, self.items = width, {}, []
        parts: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens(text)], np.int64)
            if len(ids) >= MIN_ITEM:
                own = min(width, len(ids))
                found = window_hashes(ids, own)
                before = np.concatenate([[-1], ids[: len(found) - 1]])
                parts.setdefault(own, []).append((found, before, np.full(len(found), len(self.items)), np.arange(len(found))))
                self.items.append((item, ids))
        self.seeds = {}
        for own, found in parts.items():
            flat, before, owners, places = (np.concatenate(c) for c in zip(*found))
            hashes, slot = np.unique(flat, return_inverse=True)
            key = slot * (len(self.vocabulary) + 2) + before + 1
            order = np.argsort(key, kind="stable")
            self.seeds[own] = (hashes, key[order], owners[order], places[order])

    def matches(self, words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By item: places in the item and in the document where a common run of tokens begins; and the document's ids."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        found = {}
        for width, seeds in self.seeds.items():
            found.update(self._begins(ids, width, *seeds))
        return found

    def _begins(self, ids: np.ndarray, width: int, hashes: np.ndarray, keys: np.ndarray, owners: np.ndarray, places: np.ndarray) -> dict:
        if len(ids) < width:
            return {}
        at = np.flatnonzero(np.convolve(ids >= 0, np.ones(width, np.int64), "valid") == width)
        if not len(at):
            return {}
        own = window_hashes(ids, width)[at]
        slot = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
        hit = hashes[slot] == own
        at, slot = at[hit], slot[hit]
        if not len(at):
            return {}
        # Of the seeds with this hash, those behind the document's own last token continue a run; unknown tokens have no seeds.
        span = len(self.vocabulary) + 2
        before = np.where(at > 0, ids[at - 1], -1)
        before = np.where(before < 0, span - 2, before) + 1
        first, last = np.searchsorted(keys, slot * span), np.searchsorted(keys, (slot + 1) * span)
        skip, until = np.searchsorted(keys, slot * span + before), np.searchsorted(keys, slot * span + before, "right")
        low, many = np.concatenate([first, until]), np.concatenate([skip - first, last - until])
        post = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        doc, owner, place = np.repeat(np.concatenate([at, at]), many), owners[post], places[post]
        order = np.lexsort((doc, owner))
        owner, place, doc = owner[order], place[order], doc[order]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        return {int(o[0]): (p, d, ids) for o, p, d in zip(np.split(owner, cuts), np.split(place, cuts), np.split(doc, cuts)) if len(o)}


def tile(item: np.ndarray, doc: np.ndarray, place: np.ndarray, at: np.ndarray, width: int, least: float = 0) -> tuple[int, int, int]:
    """Marked tokens, tiles and longest tile of an item against a document, from the places where common runs begin.

    Longest first; ties by place in the item, then in the document. A match that a mark cuts goes back in with what is
    left of it, if that is still ``width`` tokens long. Where all matches together reach fewer than ``least`` tokens nothing
    is marked.
    """
    heap, reached = [], np.zeros(len(item) + 1, np.int64)
    for i, j in zip(place.tolist(), at.tolist()):
        most = min(len(item) - i, len(doc) - j)
        other = item[i : i + most] != doc[j : j + most]
        length = int(other.argmax()) if other.any() else most
        if length >= width:  # hashes may collide
            heap.append((-length, i, j))
            reached[i] += 1
            reached[i + length] -= 1
    if not heap or np.count_nonzero(np.cumsum(reached)) < least:
        return 0, 0, 0
    heapq.heapify(heap)
    in_item, in_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    covered = tiles = longest = 0
    while heap and covered < len(item):
        length, i, j = heapq.heappop(heap)
        length = -length
        taken = in_item[i : i + length] | in_doc[j : j + length]
        if not taken.any():
            in_item[i : i + length] = in_doc[j : j + length] = True
            covered, tiles, longest = covered + length, tiles + 1, max(longest, length)
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for k, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - k >= width:
                heapq.heappush(heap, (k - end, i + k, j + k))
    return covered, tiles, longest


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark in blocks of about ``block_bytes`` of text, one after the other."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        yield [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]


def held_items(index: SeedIndex, text: bytes | None, coverage: float):
    """Items of which the text holds the share ``coverage`` or more: item, tokens, covered tokens, tiles, longest tile."""
    for owner, (place, at, ids) in index.matches(tokens(text)).items():
        item, own = index.items[owner]
        covered, tiles, longest = tile(own, ids, place, at, min(index.width, len(own)), coverage * len(own))
        if covered and covered >= coverage * len(own):
            yield item, len(own), covered, tiles, longest


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, n_tokens, n_covered, coverage, n_tiles, longest`` of every document that holds ``coverage`` of an item.

    Every document is held against every block of the benchmark; a block is sized before it is sent out. Items of fewer
    than ``min_tile`` tokens must stand in the document whole, and those of fewer than ``MIN_ITEM`` match nothing. Null texts and items match nothing; repeated rows of either
    table give repeated rows. Documents are only mapped, never shuffled.
    """
    lean, out = docs.selectExpr("cast(doc_id as long) doc_id", "text"), None
    for items in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def make(shared=shared):
            index = SeedIndex(shared.value, min_tile)

            def step(batch: pa.RecordBatch) -> dict:
                rows = [
                    (doc, item, n, covered, covered / n, tiles, longest)
                    for doc, text in zip(batch.column("doc_id").to_pylist(), raw(batch, "text"))
                    for item, n, covered, tiles, longest in held_items(index, text, coverage)
                ]
                return dict(zip([p.split()[0] for p in OUT.split(", ")], map(list, zip(*rows)) if rows else [[]] * 7))

            return step

        found = map_batches(lean, make, OUT)
        out = found if out is None else out.union(found)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold less than ``coverage`` of every item. Map only."""
    for items in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            index = SeedIndex(shared.value, min_tile)
            for batch in slices(batches):
                yield batch.filter(pa.array([next(held_items(index, t, coverage), None) is None for t in raw(batch, "text")], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
