"""Removal of long repeated byte strings by a distributed merge sort of sampled suffixes.

Every window of ``width`` bytes has an anchor, the k-gram in it with the least hash (the leftmost of equals), so equal
windows have equal anchors at equal places. Only suffixes that start at anchors are sorted, about one in 85 of all; an
anchor whose k-gram is found once has no partner and is dropped before bytes move. The others are sorted within tasks,
exchanged as front-coded runs (length of the prefix shared with the one before, and the rest), and merged by loser trees
that start each comparison behind the prefix known to be shared. The merge gives the common-prefix lengths of
neighbours; together with the same for what stands left of the anchors they tell which windows start anywhere else.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.batches import map_batches, raw
from wayfold.session import durable

WIDTH = 200
GRAM = 32
#: Items per bucket of the exchange, and per sorted run.
BUCKET_ITEMS = 20_000
RUN_ITEMS = 100_000
#: An anchor with more different surroundings than this is resolved window by window, spread over all tasks.
HOT_CLASSES = 50_000
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
ANCHORS = "id long, th long, pos long, h long, nb long"
BLOCK = "bucket long, n int, h binary, nb binary, c binary, shared binary, rest_len binary, rest binary, left_len binary, left binary"


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_BYTES = _mixed((np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15))


def anchor_places(buffer: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """For each window of ``buffer`` the place of its anchor. ``gram`` is a power of two."""
    x, base, reach = _BYTES[buffer], np.uint64(0x9E3779B97F4A7C15), 1
    while reach < gram:
        x = x[:-reach] * base + x[reach:]
        base, reach = base * base, 2 * reach
    least = (_mixed(x) & ~_PLACE) | np.arange(len(x), dtype=np.uint64)
    span, reach = width - gram + 1, 1
    while 2 * reach <= span:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    return (least & _PLACE).astype(np.int64)


def anchors_of(texts: list[bytes], width: int = WIDTH, gram: int = GRAM):
    """Number of the text and place in it for all anchors, piece by piece; long texts are cut into pieces that overlap."""
    parts, size, last = [], 0, (-1, -1)

    def flush():
        nonlocal last
        with np.errstate(over="ignore"):
            places = anchor_places(np.frombuffer(b"".join(p for _, _, p in parts), np.uint8), width, gram)
        begin, texts_at, found = 0, [], []
        for number, offset, part in parts:
            own = places[begin : begin + len(part) - width + 1]
            own = own[np.append(True, own[1:] != own[:-1])] - begin + offset
            if (number, int(own[0])) == last:
                own = own[1:]
            if len(own):
                last = (number, int(own[-1]))
                texts_at.append(np.full(len(own), number))
                found.append(own)
            begin += len(part)
        return (np.concatenate(texts_at), np.concatenate(found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    for number, text in enumerate(texts):
        for offset in range(0, len(text) - width + 1, _PIECE):
            part = text[offset : offset + _PIECE + width - 1]
            parts.append((number, offset, part))
            size += len(part)
            if size >= _PIECE:
                yield flush()
                parts, size = [], 0
    if parts:
        yield flush()


def _anchors(keyed: DataFrame, width: int, gram: int) -> DataFrame:
    """All anchors of ``keyed`` (id, th, text): hash of the k-gram, and of all bytes that its windows can reach."""
    side = width - gram

    def make():
        digest = xxhash.xxh3_64_intdigest

        def step(batch: pa.RecordBatch) -> dict:
            texts = [t or b"" for t in raw(batch, "text")]
            number, place, h, nb = [], [], [], []
            for texts_at, places in anchors_of(texts, width, gram):
                number.append(texts_at)
                place.append(places)
                for t, p in zip(texts_at.tolist(), places.tolist()):
                    text, first = texts[t], max(0, p - side)
                    h.append(digest(text[p : p + gram]))
                    nb.append(digest(text[first : p + width], p - first))
            number = np.concatenate(number) if number else np.zeros(0, np.int64)
            place = np.concatenate(place) if place else np.zeros(0, np.int64)
            return {"id": batch.column("id").take(pa.array(number)), "th": batch.column("th").take(pa.array(number)), "pos": place, "h": _signed(h), "nb": _signed(nb)}

        return step

    return map_batches(keyed, make, ANCHORS)


def _common(strings: list[bytes], longest: int) -> np.ndarray:
    """Length of the prefix that each string shares with the one before; the first shares nothing."""
    if not strings:
        return np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in strings])
    grid = np.frombuffer(b"".join(s.ljust(longest, b"\0") for s in strings), np.uint8).reshape(-1, longest)
    out = np.zeros(len(strings), np.int64)
    differ = grid[1:] != grid[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    out[1:] = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    return out


def _runs(rows: list[tuple], buckets: int, width: int):
    """Front-coded blocks of one sorted run, by bucket. Rows are (h, nb, c, right bytes, left bytes)."""
    rows.sort(key=lambda r: (r[0] % buckets, r[3]))
    cuts = [0, *(k for k in range(1, len(rows)) if rows[k][0] % buckets != rows[k - 1][0] % buckets), len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        own = rows[a:b]
        rights, lefts = [r[3] for r in own], [r[4] for r in own]
        shared = _common(rights, width)
        pack = lambda values, kind: np.array(values, kind).tobytes()
        yield (
            own[0][0] % buckets, len(own), pack([r[0] for r in own], "<i8"), pack([r[1] for r in own], "<i8"), pack([r[2] for r in own], "<i8"),
            pack(shared, "<u2"), pack([len(r) - s for r, s in zip(rights, shared.tolist())], "<u2"), b"".join(r[s:] for r, s in zip(rights, shared.tolist())),
            pack([len(x) for x in lefts], "<u2"), b"".join(lefts),
        )


def _more_common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that are known to share ``known`` bytes."""
    most = min(len(a), len(b))
    step = 16
    while known < most and a[known : known + step] == b[known : known + step]:
        known, step = known + step, 2 * step
    known = min(known, most)
    end = min(known + step, most)
    while known < end:  # the first difference is in here, or both end
        middle = (known + end + 1) // 2
        if a[known:middle] == b[known:middle]:
            known = middle
        else:
            end = middle - 1
    return known


class LoserTree:
    """Merges sorted runs of (shared prefix with the one before, string).

    All strings in the tree have a known common prefix with the last winner. The one that shares more is smaller; only
    equal lengths are compared, from there on, and the loser keeps what it shares with the winner.
    """

    def __init__(self, runs: list[list[tuple[int, bytes]]]):
        self.runs, self.next = runs, [0] * len(runs)
        size = 1
        while size < len(runs):
            size *= 2
        self.size, self.losers = size, [-1] * size
        self.string: list[bytes | None] = [None] * size
        self.shared = [0] * size
        for k in range(len(runs)):
            self._advance(k)
        winners = list(range(size))
        at = size // 2
        while len(winners) > 1:
            up = []
            for k in range(0, len(winners), 2):
                winner, loser = self._play(winners[k], winners[k + 1])
                self.losers[at + k // 2] = loser
                up.append(winner)
            winners, at = up, at // 2
        self.winner = winners[0]

    def _advance(self, k: int) -> None:
        if self.next[k] < len(self.runs[k]):
            self.shared[k], self.string[k] = self.runs[k][self.next[k]]
            self.next[k] += 1
        else:
            self.string[k] = None

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.string[a], self.string[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.shared[a] != self.shared[b]:
            return (a, b) if self.shared[a] > self.shared[b] else (b, a)
        known = _more_common(x, y, self.shared[a])
        if x[known : known + 1] <= y[known : known + 1]:
            self.shared[b] = known
            return a, b
        self.shared[a] = known
        return b, a

    def __iter__(self):
        """(run, place in the run, prefix shared with the string before) in sorted order."""
        while self.string[self.winner] is not None:
            k = self.winner
            yield k, self.next[k] - 1, self.shared[k]
            self._advance(k)
            at, now = (self.size + k) // 2, k
            while at:
                now, self.losers[at] = self._play(now, self.losers[at])
                at //= 2
            self.winner = now


def _classes(shared: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the groups of neighbours that share ``depth``."""
    return np.cumsum(shared < depth)


def resolve(shared: np.ndarray, rights: list[bytes], lefts: list[bytes], counts: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance d such that the window from d bytes left of the anchor starts elsewhere too; -1 for none.

    Items are in the order of their right bytes, of which neighbours share ``shared``. Windows at d are equal if the
    right bytes share ``width - d`` and the left ones share d.
    """
    n, side = len(rights), width - gram
    back = [x[::-1] for x in lefts]
    order = np.array(sorted(range(n), key=back.__getitem__), np.int64)
    left_shared = _common([back[k] for k in order], max(side, 1))
    right_len, left_len = np.array([len(x) for x in rights]), np.array([len(x) for x in lefts])
    least, most = np.full(n, -1), np.full(n, -1)
    left_class = np.empty(n, np.int64)
    for d in range(side + 1):
        fits = np.flatnonzero((left_len >= d) & (right_len >= width - d))
        if not len(fits):
            continue
        left_class[order] = _classes(left_shared, d)
        key = _classes(shared, width - d)[fits] * (n + 1) + left_class[fits]
        _, back_to, often = np.unique(key, return_inverse=True, return_counts=True)
        found = fits[(often[back_to] > 1) | (counts[fits] > 1)]
        least[found] = np.where(least[found] < 0, d, least[found])
        most[found] = d
    return least, most


def _merge(width: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        runs, items = [], []
        for r in table.to_pylist():
            numbers = lambda name, kind: np.frombuffer(r[name], kind)  # noqa: E731, B023
            own, lefts, at, before = [], [], 0, b""
            for s, n in zip(numbers("shared", "<u2").tolist(), numbers("rest_len", "<u2").tolist()):
                before = before[:s] + r["rest"][at : at + n]
                own.append((s, before))
                at += n
            ends = np.cumsum(numbers("left_len", "<u2")).tolist()
            lefts = [r["left"][a:b] for a, b in zip([0, *ends], ends)]
            runs.append(own)
            items.append((numbers("h", "<i8"), numbers("nb", "<i8"), numbers("c", "<i8"), lefts))
        order = list(LoserTree(runs))
        shared = np.array([s for _, _, s in order], np.int64)
        counts = np.array([items[k][2][p] for k, p, _ in order], np.int64)
        least, most = resolve(shared, [runs[k][p][1] for k, p, _ in order], [items[k][3][p] for k, p, _ in order], counts, width, gram)
        h, nb = (np.array([items[k][f][p] for k, p, _ in order], np.int64) for f in (0, 1))
        hit = most >= 0
        return pa.table({"h": h[hit], "nb": nb[hit], "least": least[hit].astype(np.int32), "most": most[hit].astype(np.int32)})

    return run


def _sides(keyed: DataFrame, classes: DataFrame, width: int, gram: int, make_rows, schema: str) -> DataFrame:
    """Meet the texts of classes' representatives and map (h, nb, c, right bytes, left bytes) rows of each batch."""
    side = width - gram
    wanted = classes.groupBy("id", "th").agg(F.collect_list(F.struct("pos", "h", "nb", "c")).alias("items"))  # at most the anchors of one text
    met = keyed.join(wanted, ["id", "th"]).select("text", "items")

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for text, items in zip(raw(batch, "text"), batch.column("items").to_pylist()):
                for x in items:
                    p = x["pos"]
                    held.append((x["h"], x["nb"], x["c"], text[p : p + width], text[max(0, p - side) : p]))
                if len(held) >= RUN_ITEMS:
                    yield make_rows(held)
                    held = []
        if held:
            yield make_rows(held)

    return met.mapInArrow(run, schema)


def repeated_ranges(keyed: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket_items: int = BUCKET_ITEMS, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """``id, th, low, high``: byte ranges of texts that windows starting elsewhere too cover; they may overlap.

    ``keyed`` has ``id, th, text``, where equal keys mean equal texts. Anchors with equal surroundings are one class
    with a count, so a passage that many texts share is sorted once, and the classes of an anchor are bounded by
    ``hot_classes`` before they meet in one bucket.
    """
    side = width - gram
    anchors = _anchors(keyed, width, gram)
    often = anchors.groupBy("h").agg(F.count("*").alias("n"), F.min("nb").alias("nb0"), F.max("nb").alias("nb1")).where("n > 1")
    # Written first: a join that reads the counts from a table deals both sides itself, and can split a hot anchor.
    often = durable(often.select("h", (F.col("nb0") == F.col("nb1")).alias("alike")), "repeated-anchors")
    live = durable(anchors.join(often, "h"), "live-anchors")
    classes = live.where("not alike").groupBy("h", "nb").agg(F.count("*").alias("c"), F.min(F.struct("id", "th", "pos")).alias("rep"))
    classes = durable(classes.select("h", "nb", "c", "rep.*"), "anchor-classes")
    sizes = classes.groupBy("h").agg(F.count("*").alias("k"))
    hot = sizes.where(F.col("k") > hot_classes).select("h")
    n, n_hot = sizes.agg(F.sum("k"), F.sum(F.when(F.col("k") > hot_classes, F.col("k")))).first()
    found = None
    if n:
        calm = classes.join(hot, "h", "left_anti") if n_hot else classes
        buckets = max(1, -(-n // bucket_items))

        def blocks(rows: list[tuple]) -> pa.RecordBatch:
            names = [p.split()[0] for p in BLOCK.split(", ")]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 8]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*_runs(rows, buckets, width)), kinds)], names)

        exchanged = _sides(keyed, calm, width, gram, blocks, BLOCK)
        found = exchanged.groupBy("bucket").applyInArrow(_merge(width, gram), "h long, nb long, least int, most int")
    if n_hot:
        found = found.union(_window_by_window(keyed, classes.join(hot, "h", "left_semi"), width, gram))
    ranges = live.where("alike").select("id", "th", (F.col("pos") - side).alias("low"), (F.col("pos") + width).alias("high"))
    if found is None:
        return ranges
    met = live.where("not alike").join(found, ["h", "nb"])
    return ranges.union(met.select("id", "th", (F.col("pos") - F.col("most")).alias("low"), (F.col("pos") - F.col("least") + width).alias("high")))


def _window_by_window(keyed: DataFrame, classes: DataFrame, width: int, gram: int) -> DataFrame:
    """The same for anchors with very many surroundings: windows are counted by hash, combined before the shuffle."""
    schema = "h long, nb long, c long, d int, w0 long, w1 long"

    def windows(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for h, nb, c, right, left in rows:
            both, at = left + right, len(left)
            for d in range(max(0, width - len(right)), min(width - gram, at) + 1):
                value = xxhash.xxh3_128_intdigest(both[at - d : at - d + width])
                out.append((h, nb, c, d, value >> 64, value & (1 << 64) - 1))
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.RecordBatch.from_arrays([
            pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()), pa.array(_signed(columns[4])), pa.array(_signed(columns[5])),
        ], ["h", "nb", "c", "d", "w0", "w1"])

    each = durable(_sides(keyed, classes, width, gram, windows, schema), "hot-windows")
    same = ["h", "d", "w0", "w1"]  # a window can hold several anchors: it is compared with windows around the same one at the same place
    twice = each.groupBy(*same).agg(F.sum("c").alias("n")).where("n > 1").select(*same)
    return each.join(twice, same).groupBy("h", "nb").agg(F.min("d").alias("least"), F.max("d").alias("most"))


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket_items: int = BUCKET_ITEMS, hot_classes: int = HOT_CLASSES, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept`` (binary).

    Texts are UTF-8 bytes, null is empty; texts shorter than ``width`` lose nothing. Repeated rows are documents like
    others, so both lose what they share. Matches never cross documents.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ranges = repeated_ranges(keyed.select("id", "th", "text"), width, gram, bucket_items, hot_classes)
    # One long per range: where it begins, counted from the furthest that it can reach to the left, and how long it is.
    packed = F.shiftleft(F.col("low") + width, 32) + F.col("high") - F.col("low")
    spans = ranges.groupBy("id", "th").agg(F.collect_set(packed).alias("spans"))
    met = keyed.join(spans, ["id", "th"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            rows = []
            for text, spans in zip(raw(batch, "text"), batch.column("spans").to_pylist()):
                kept, removed, n, end = [], 0, 0, 0
                for low, high in sorted((max(0, (s >> 32) - width), min(len(text), (s >> 32) - width + (s & 0xFFFFFFFF))) for s in spans or ()):
                    if low > end or not n:
                        kept.append(text[end:low])
                        n += 1
                        end = low
                    if high > end:
                        removed, end = removed + high - end, high
                kept = b"".join([*kept, text[end:]])
                rows.append((len(text), removed, n, hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
            names = [p.split()[0] for p in schema.split(", ")]
            return dict(zip(names, [batch.column("doc_id"), *map(list, zip(*rows))]))

        return step

    return map_batches(met, make, schema)
