"""Best-fit packing with certified bin counts.

Pieces are packed group by group with best-fit decreasing, once as they are and once after triples of medium pieces have
been put together; the packing with fewer bins stays. Dual feasible functions give a lower bound on the bins that a group
needs; a group that meets its bound is certified and gives up its emptiest bin only (its share of rounding), one with a gap
gives up several of its emptiest bins, but never more than half of its pieces. What is given up is dealt anew to groups,
half as many at most, and packed again, until one group holds the rest. Each piece tells its group's bound.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.batches import map_batches, raw
from wayfold.session import durable

CAPACITY = 2048
END = 0
GROUP_ROWS = 50_000
_TWO_SPACES = re.compile(r"\s\s")
_CACHE = 400_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary() -> str:
    """The rank file of the byte-level vocabulary: the same ids as byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class _Known(dict):
    """Ids of a space and a run of other characters, four bytes each; forgets all when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, run: str) -> bytes:
        if len(self) >= _CACHE:
            self.clear()
        found = self[run] = self.encode(" " + run)
        return found


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the JSON form that lies beside a rank file, with their ids; none without such a file."""
    path = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError(f"added tokens of {path} that depend on the text around them")
    return {t["content"]: t["id"] for t in found}


def encoder(path: str, specials_as_text: bool = True):
    """A function from text to ids as little-endian 32-bit integers, for a rank file.

    Strings of added tokens are text, or else split the text and give their own ids, as the tokenizers library does by default.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    encode = lambda text: array("I", plain(text)).tobytes()
    known = _Known(encode)

    def ids(text: str) -> bytes:
        # A single space between two other characters always begins a token, so runs between such spaces stand alone.
        if not text or text[0].isspace() or text[-1].isspace() or _TWO_SPACES.search(text):
            return encode(text)
        first, *rest = text.split(" ")
        return encode(first) + b"".join(map(known.__getitem__, rest))

    added = {} if specials_as_text else {t: k.to_bytes(4, "little") for t, k in added_tokens(path).items()}
    if not added:
        return ids
    border = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def split_ids(text: str) -> bytes:
        parts = border.split(text)  # texts and added tokens by turns
        return ids(text) if len(parts) == 1 else b"".join(added[part] if at % 2 else ids(part) for at, part in enumerate(parts))

    return split_ids


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False, specials_as_text: bool = True) -> DataFrame:
    """Token pieces of every document: its ids and an end mark, cut from the back into ``capacity`` tokens.

    The first piece takes the remainder. A null text is an empty one: its only token is the end mark. ``with_ids`` adds the
    ids themselves (``array<int>``). ``specials_as_text`` is that of ``encoder``. Map only; repeated rows give repeated pieces.
    """
    path = path or vocabulary()

    def make():
        encode = encoder(path, specials_as_text)
        end = END.to_bytes(4, "little")

        def step(batch: pa.RecordBatch) -> dict:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), raw(batch, "text")):
                ids = encode((text or b"").decode("utf-8")) + end
                n = len(ids) // 4
                start, length = 0, n % capacity or capacity
                at = 0
                while start < n:
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc, at, start, length, zlib.crc32(own), np.frombuffer(own, "<u4").astype(np.int32) if with_ids else None))
                    at, start, length = at + 1, start + length, capacity
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
            return dict(zip(names, map(list, zip(*rows))))

        return step

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), make, PIECES + ", ids array<int>" * with_ids)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that no packing of these lengths can do without."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of_counts(count: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that no packing can do without, by three families of dual feasible functions; ``count`` is by length.

    One counts items over capacity - e as full bins, leaves out those under e and takes the others as they are, for all
    e; one rounds (k + 1) x / capacity down to k-ths, keeping exact multiples. The third is about triples: items from b on
    (over a third, up to three eighths) are halves, and those that do not fit beside two of them quarters.
    """
    count = np.asarray(count, np.int64)
    size = np.arange(capacity + 1)
    tokens, items = np.cumsum(count * size), np.cumsum(count)
    e = np.arange(0, capacity // 2 + 1)
    big = items[-1] - items[capacity - e]
    middle = tokens[capacity - e] - np.where(e > 0, tokens[np.maximum(e - 1, 0)], 0)
    best = int(np.max(big + -(-middle // capacity)))
    for k in range(1, 33):
        scaled = (k + 1) * size
        exact = scaled % capacity == 0
        total = int((count * np.where(exact, size * k, scaled // capacity * capacity)).sum())  # in units of 1 / (k capacity)
        best = max(best, -(-total // (k * capacity)))
    b = np.arange(capacity // 3 + 1, 3 * capacity // 8)[:, None]
    half = np.where(size >= b, 2, np.where(size > capacity - 2 * b, 1, 0))  # in quarters, for items up to half a bin
    quarters = np.where(2 * size <= capacity, half, 4 - np.take_along_axis(half, np.broadcast_to(capacity - size, half.shape), 1))
    return max(best, *(-(-quarters @ count // 4)).tolist()) if len(b) else best


def _triples(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Which bin each item belongs to when triples of medium items are put together, the largest possible first; -1 for none.

    Items come longest first. Only items from a quarter of a bin to half of it take part.
    """
    inside = np.flatnonzero((4 * lengths >= capacity) & (2 * lengths <= capacity))
    waiting: dict[int, list[int]] = {}
    for at in inside.tolist():
        waiting.setdefault(int(lengths[at]), []).append(at)
    present, bins, made = sum(1 << n for n in waiting), np.full(len(lengths), -1, np.int64), 0

    def take(most: int) -> tuple[int, int] | None:
        """The longest waiting item of at most that length, taken out."""
        nonlocal present
        found = (present & ((1 << (most + 1)) - 1)).bit_length() - 1
        if found < 0:
            return None
        own = waiting[found].pop()
        if not waiting[found]:
            present ^= 1 << found
        return found, own

    def least() -> int:
        return (present & -present).bit_length() - 1

    left = len(inside)
    while left >= 3:
        low = least()
        second = low if len(waiting[low]) > 1 else ((present ^ (1 << low)) & -(present ^ (1 << low))).bit_length() - 1
        first = take(capacity - low - second)
        if first is None:
            break
        # The first may have been one of the two shortest; what is left then is at least as long.
        then = take(capacity - first[0] - least())
        last = then and take(capacity - first[0] - then[0])
        if not last:
            break
        bins[[first[1], then[1], last[1]]] = made
        made, left = made + 1, left - 3
    return bins, made


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY, given: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the order given (longest first), and the fill of each bin.

    ``given`` names bins, from 0 on, of items that are placed already (-1: not placed).
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some open bin has room for exactly r tokens
    fill: list[int] = [] if given is None else [0] * (int(given.max(initial=-1)) + 1)
    waiting = range(len(lengths)) if given is None else np.flatnonzero(given < 0).tolist()
    for at in () if given is None else np.flatnonzero(given >= 0).tolist():
        own = int(given[at])
        bins[at], offsets[at] = own, fill[own]
        fill[own] += int(lengths[at])
    for own, used in enumerate(fill):
        if used < capacity:
            rooms |= 1 << (capacity - used)
            open_by_room[capacity - used].append(own)
    sizes = lengths.tolist()
    for at in waiting:
        length = sizes[at]
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            own = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms ^= 1 << room
        else:
            own, room = len(fill), capacity
            fill.append(0)
        bins[at], offsets[at] = own, fill[own]
        fill[own] += length
        room -= length
        if room:
            if not open_by_room[room]:
                rooms |= 1 << room
            open_by_room[room].append(own)
    return bins, offsets, np.array(fill, np.int64)


def packed_group(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Bin and offset of each item (longest first), the fill of each bin, and the least number of bins there can be."""
    bound = lower_bound(lengths, capacity)
    best = best_fit_decreasing(lengths, capacity)
    if len(best[2]) > bound:
        given, made = _triples(lengths, capacity)
        if made:
            best = min(best, best_fit_decreasing(lengths, capacity, given), key=lambda found: len(found[2]))
    return *best, bound


def place(sized: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, given_up: int = 4) -> DataFrame:
    """Adds ``sequence_id``, ``offset``, ``bound`` and ``certified`` to the rows of ``sized`` (``length`` from 1 to ``capacity``).

    Rows are dealt to groups by a hash of their number, so no key can make a group large. ``bound`` is the least number of
    sequences that the piece's group needed when it was packed, ``certified`` says that it got no more. A group of the last
    round that is above its bound stays as it is. Full pieces are sequences by themselves. Columns of these names are
    replaced. At most half of the rows go on to the next round, so rounds are no more than the doublings of
    ``group_rows`` that the rows make up. No rows give no rows.
    """
    added = ("sequence_id", "offset", "bound", "certified")
    rows = durable(sized.drop(*added).select("*", F.monotonically_increasing_id().alias("__row")), "pieces")
    done = rows.where(F.col("length") >= capacity).select(
        "*", (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("bound"), F.lit(True).alias("certified"),
    )
    left, turn = rows.where(F.col("length") < capacity), 0
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long, bound long, certified boolean, closed boolean"
    n = left.count()
    while n:
        groups = -(-n // group_rows)
        last = groups == 1

        dealt = left.select(*names, (F.pmod(F.xxhash64("__row", F.lit(turn)), F.lit(groups))).alias("__group"))
        packed = durable(dealt.groupBy("__group").applyInArrow(_packer(names, capacity, turn, last, given_up), schema), "packed")
        done = done.union(packed.where("closed").drop("closed"))
        left, turn = packed.where("not closed").select(*names), turn + 1
        n = 0 if last else left.count()
    return done.drop("__row")


def _packer(names: list[str], capacity: int, turn: int, last: bool, given_up: int):
    """Packs one group; without ``last`` it opens its emptiest bin again, and ``given_up`` more for each bin above its bound.

    Opened bins hold half of the group's pieces at most.
    """

    def run(table: pa.Table) -> pa.Table:
        group = table.column("__group")[0].as_py()
        lengths, number = table.column("length").to_numpy(), table.column("__row").to_numpy()
        order = np.lexsort((number, -lengths))
        bins, offsets, fill, bound = packed_group(lengths[order], capacity)
        gap = len(fill) - bound
        opened = np.zeros(len(fill), bool)
        if not last:
            emptiest = np.argsort(fill, kind="stable")[: 1 + given_up * gap]
            held = np.cumsum(np.bincount(bins, minlength=len(fill))[emptiest])
            opened[emptiest[2 * held <= len(lengths)]] = True
        out = table.select(names).take(order)
        out = out.append_column("sequence_id", pa.array((((turn << 32) + group) << 24) + bins)).append_column("offset", pa.array(offsets))
        out = out.append_column("bound", pa.array(np.full(len(bins), bound, np.int64))).append_column("certified", pa.array(np.full(len(bins), gap == 0)))
        return out.append_column("closed", pa.array(~opened[bins]))

    return run


def certificate(placed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """Sequences in use, and the least number that any packing of all pieces needs, from their count by length."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in placed.groupBy("length").count().collect():  # one row per length
        counts[length] = n
    return placed.select("sequence_id").distinct().count(), bound_of_counts(counts, capacity)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and the offset that each is placed at; strings of added tokens get their own ids."""
    return place(pieces(docs, path, capacity, with_ids, specials_as_text=False), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed ids of each sequence in order, from pieces with ids: at most ``capacity`` tokens a row."""
    parts = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
