"""Language-model scores by online logistic mixing of hashed contexts.

A text is the bytes of its lower-cased words, a space behind each, and an end mark. Bit predictors hang on hashed contexts:
the last two and four bytes, and the word so far. What they know are counts of next bytes over all training texts, gathered by
shards of the hash range, so that the table grows with the corpus and never lies whole anywhere: a block of documents sends
its distinct contexts with its own counts to their shards, each shard adds up what all blocks have, and the bit predictions
come back to the blocks that asked. Within a text the predictions are mixed by weights chosen by how many contexts are known
(the gate) and corrected after every byte by the errors of its bits; an adaptive map of the mixed probability refines it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfold.llm.batches import raw, slices
from wayfold.session import durable

#: Byte contexts by length, seven bytes at most; the word so far is one more.
ORDERS = (2, 4)
K = len(ORDERS) + 1
#: Weights and the refining map begin anew after so many bytes of a text, so that long texts are as parallel as short ones.
SEGMENT = 1024
#: Bytes of text in a block (and one text more at most), in what is sorted and in what is laid out for mixing at once, and for a shard of the table.
BLOCK, SORTED, MIXED, SHARD = 1 << 24, 1 << 20, 1 << 20, 1 << 22
#: Segments that are walked at once, bytes of each that are made ready at once, and bytes that are hashed or looked up at once: what caches hold.
LANES, STRETCH, LOOK = 1300, 8, 1 << 15
#: Added to the counts of both sides of a bit; steps of the eight-bit form of a log odds; bounds of the mixed log odds.
PRIOR, STEP, FARTHEST = 0.03, 1 / 12, 11.0
START_WEIGHT, RATE, LEAST_RATE = 0.35, 0.02, 0.004
BUCKETS, MAP_RATE, MAP_SHARE = 25, 0.02, 0.25
BASE_PRIOR = 0.1
END = b"\n"
#: How far each bit of a byte, highest first, is from the sign of a float, and that sign.
TO_SIGN, SIGN = np.arange(24, 32, dtype=np.uint32)[:, None], np.uint32(1 << 31)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
PARTS = (
    "block long, shard int, ids array<long>, learn array<boolean>, sizes array<int>, payload binary, counts binary, words binary, word_counts binary"
)
RESULT = "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PAD = b"\n" * max(ORDERS)


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-cased words (ASCII capitals only), without the end mark."""
    return (text or b"").translate(LOWER).split()


def as_bytes(words: list[bytes]) -> bytes:
    """The byte string that is scored: one string per token sequence."""
    return b" ".join(words) + b" \n" if words else b"\n"


def hash_bits(n_bytes: int) -> int:
    """Bits of a hashed context for a corpus of so many bytes: some ten slots for each byte."""
    return min(max(n_bytes.bit_length() + 4, 32), 48)


def _hashed(h: np.ndarray, order: int, bits: int) -> np.ndarray:
    h += np.uint64(order + 1)
    h *= _MIX
    h ^= h >> np.uint64(32)
    h *= _ODD
    h >>= np.uint64(64 - bits)
    return h


_powers: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd factor and of its inverse modulo 2**64, kept for the next call."""
    if len(_powers[0]) < n:
        for k, base in enumerate((int(_ODD), pow(int(_ODD), -1, 1 << 64))):
            _powers[k] = np.full(n, np.uint64(base), np.uint64)
            _powers[k][0] = 1
            np.multiply.accumulate(_powers[k], out=_powers[k])
    return _powers[0][:n], _powers[1][:n]


def context_codes(data: bytes) -> np.ndarray:
    """The last bytes and the next one, as one number, for every place behind the first ``_PAD`` of joined texts.

    The code of a shorter context is what remains of it without the lowest bytes.
    """
    return np.ndarray((len(data) - len(_PAD),), "<u8", data + bytes(8), 0, (1,)) & np.uint64((1 << 8 * (len(_PAD) + 1)) - 1)


def code_keys(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Context of ``bits`` bits and next byte of codes."""
    h = np.zeros(len(codes), np.uint64)
    for k in reversed(range(order)):
        h *= _ODD
        h += (codes >> np.uint64(8 * k) & np.uint64(255)) + np.uint64(1)
    return _hashed(h, order, bits) << np.uint64(8) | codes >> np.uint64(8 * order)


def word_keys(buffer: np.ndarray, bits: int) -> np.ndarray:
    """Word so far as ``bits`` bits and next byte, for every place of whole words with what closes them."""
    # Differences of a polynomial sum, divided by the power at the word's start.
    n, byte = len(buffer), buffer.astype(np.uint64)
    power, inverse = _powers_of(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((byte + np.uint64(1)) * power[:n], out=total[1:])
    border = (buffer == 32) | (buffer == 10)
    start = np.zeros(n, np.int32)
    start[1:] = np.maximum.accumulate(np.where(border[:-1], np.arange(1, n, dtype=np.int32), 0))
    h = total[:n] - total.take(start)
    h *= inverse.take(start)
    return _hashed(h, 99, bits) << np.uint64(8) | byte


class _Words:
    """The words of texts, each with the space or end that closes it; what hangs on a word alone is worked out once."""

    def __init__(self, texts: list[bytes]):
        data = b"".join(texts)
        buffer = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero((buffer == 32) | (buffer == 10)) + 1
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        every = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        self.ids, different = every.indices.to_numpy(), every.dictionary
        #: Where the words of each text begin in ``ids``, and where the last ones end.
        self.first = np.searchsorted(ends, np.cumsum([0] + [len(t) for t in texts]), side="right")
        _, offsets, data = different.buffers()
        #: Where each different word begins in ``buffer``, and where the last one ends.
        self.starts = np.frombuffer(offsets, np.int32, len(different) + 1)
        self.buffer = np.frombuffer(data, np.uint8, self.starts[-1])

    def listed(self) -> list[bytes]:
        """Different words in the order of their first places, without the space; the end is a word."""
        return self.buffer.tobytes().replace(END, END + b" ").split(b" ")[:-1]

    def keys(self, bits: int) -> Iterator[tuple[slice, np.ndarray]]:
        """Keys of the word so far for a run of different words at a time."""
        start, last = 0, len(self.starts) - 1
        while start < last:
            end = max(int(np.searchsorted(self.starts, self.starts[start] + LOOK, side="right")) - 1, start + 1)
            yield slice(start, end), word_keys(self.buffer[self.starts[start] : self.starts[end]], bits)
            start = end

    def places(self, texts: slice) -> np.ndarray:
        """For every byte of some texts, where its word has it in ``buffer``."""
        starts = self.starts.take(ids := self.ids[self.first[texts.start] : self.first[texts.stop]])
        sizes = self.starts.take(ids + 1) - starts
        ends = np.cumsum(sizes, dtype=np.int32)
        places = np.repeat(starts - (ends - sizes), sizes)
        places += np.arange(len(places), dtype=np.int32)
        return places


def _padded(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """All texts joined, each behind its padding, and which places behind the first padding are scored."""
    data = b"".join(_PAD + t for t in texts)
    scored = np.ones(len(data) - len(_PAD), bool)
    ends = np.cumsum([len(t) + len(_PAD) for t in texts])[:-1] - len(_PAD)
    for k in range(len(_PAD)):
        scored[ends + k] = False
    return data, scored


def _packed(values: np.ndarray) -> bytes:
    """Byte planes, compressed: the planes of high bytes are all but empty."""
    if not len(values):
        return b""
    planes = np.ascontiguousarray(values.reshape(len(values), -1).view(np.uint8).T)
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def _unpacked(data: bytes, dtype, width: int = 1) -> np.ndarray:
    if not data:
        return np.zeros((0, width) if width > 1 else 0, dtype)
    size = np.dtype(dtype).itemsize * width
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    found = np.ascontiguousarray(planes.T).view(dtype)
    return found if width > 1 else found.ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as gaps between contexts, number of next bytes of each, and next bytes."""
    if not len(keys):
        return b""
    contexts = keys >> np.uint64(8)
    at = _runs(contexts)
    gaps = np.diff(contexts[at], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    many = (np.diff(np.append(at, len(keys))) - 1).astype(np.uint8)  # 1 to 256 next bytes
    head = np.array([len(at)], np.int64).tobytes()
    return zstandard.ZstdCompressor(1).compress(head + gaps.tobytes() + many.tobytes() + keys.astype(np.uint8).tobytes())


def _unpack_keys(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n, 8).reshape(8, n).T).view(np.uint64).ravel()
    many = np.frombuffer(data, np.uint8, n, 8 + 8 * n).astype(np.int64) + 1
    return np.repeat(np.cumsum(gaps, dtype=np.uint64), many) << np.uint64(8) | np.frombuffer(data, np.uint8, -1, 8 + 9 * n)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of equal runs in sorted keys."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = _runs(keys)
    return keys[at], np.add.reduceat(counts.astype(np.int64), at).astype(np.uint32) if len(at) else counts


class _Counted:
    """Sorted distinct keys with counts, combined as parts come in."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, learn: bool) -> None:
        keys = np.sort(keys)
        at = _runs(keys)
        counts = np.diff(np.append(at, len(keys))) if learn else np.zeros(len(at), np.int64)
        self._hold(keys[at], counts.astype(np.uint32))

    def add_sums(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._hold(*_summed(keys, counts))

    def _hold(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > 1 << 21:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        found = _summed(*(np.concatenate([p[k] for p in self.parts]) for k in (0, 1)))
        self.parts, self.waiting = [found], 0
        return found


def _codes(texts: list[bytes], learn: bool, counted: _Counted) -> _Counted:
    """Add the codes of texts."""
    for at in _split(texts, SORTED):
        data, scored = _padded(texts[at])
        counted.add(context_codes(data)[scored], learn)
    return counted


def _shorter(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of a shorter context, and which of them each of the sorted codes has."""
    return np.unique(codes >> np.uint64(8 * (max(ORDERS) - order)), return_inverse=True)


def _split(texts: list, size: int) -> Iterator[slice]:
    """Runs of texts of about ``size`` bytes."""
    start = held = 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield slice(start, at + 1)
            start, held = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _by_shard(words: Iterable[bytes], shards: int) -> dict[int, list[int]]:
    """Numbers of words by the shard that counts them, in the order given."""
    found: dict[int, list[int]] = {}
    for number, word in enumerate(words):
        found.setdefault(zlib.crc32(word) * shards >> 32, []).append(number)
    return found


def gather(docs: DataFrame, learn: Column, shards: int, bits: int) -> DataFrame:
    """Blocks of documents: their bytes, and by shard their contexts and words with training counts."""
    schema = to_arrow_schema(StructType.fromDDL(PARTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() << 24

        def rows(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_pydict({f.name: columns.get(f.name, [None] * n) for f in schema}, schema=schema)

        def block(ids: list, learns: list[bool], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            nonlocal turn
            turn += 1
            codes, counted = _Counted(), _Counted()
            for own in (True, False):
                _codes([t for t, l in zip(texts, learns) if l is own], own, codes)
            codes, of_codes = codes.merged()
            for order in ORDERS:
                different, place = _shorter(codes, order)
                counted.add_sums(code_keys(different, order, bits), np.bincount(place, of_codes, len(different)).astype(np.int64))
            del codes, of_codes, different, place
            found = _Words(texts)
            of_words = np.bincount(found.ids[np.repeat(learns, np.diff(found.first))], minlength=len(found.starts) - 1)
            for run_of, keys in found.keys(bits):
                counted.add_sums(keys, np.repeat(of_words[run_of], np.diff(found.starts[run_of.start : run_of.stop + 1])))
            words = found.listed()
            del found
            keys, counts = counted.merged()
            yield rows(
                block=[turn], ids=[ids], learn=[learns], sizes=[[len(t) for t in texts]],
                payload=[zstandard.ZstdCompressor(3).compress(b"".join(texts))],
            )
            shard = ((keys >> np.uint64(16)) * np.uint64(shards) >> np.uint64(bits - 8)).astype(np.int32)
            bounds, named = np.searchsorted(shard, np.arange(shards + 1)), _by_shard(words, shards)
            present = sorted({*shard[_runs(shard)].tolist(), *named})
            for k in range(0, len(present), 256):
                now = present[k : k + 256]
                cuts = [slice(bounds[s], bounds[s + 1]) for s in now]
                yield rows(
                    block=[turn] * len(now), shard=now, payload=[_pack_keys(keys[c]) for c in cuts], counts=[_packed(counts[c]) for c in cuts],
                    words=[zstandard.ZstdCompressor(1).compress(b" ".join([words[w] for w in named.get(s, [])])) for s in now],
                    word_counts=[_packed(of_words[named.get(s, [])]) for s in now],
                )

        ids, learns, texts, held = [], [], [], 0
        for batch in slices(batches):
            for doc, text, own in zip(batch.column("doc_id").to_pylist(), raw(batch, "text"), batch.column("learn").to_pylist()):
                ids.append(doc)
                learns.append(own)
                texts.append(as_bytes(tokens(text)))
                held += len(texts[-1])
                if held >= BLOCK:
                    yield from block(ids, learns, texts)
                    ids, learns, texts, held = [], [], [], 0
        if ids:
            yield from block(ids, learns, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learn")).mapInArrow(run, PARTS)


def bit_predictions(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each sorted distinct key, at each bit of its byte, the log odds of that bit as the byte has it, as a small number.

    A key is a context and a next byte; the count of each bit's two sides is what the keys below them add up to.
    """
    found = np.empty((len(keys), 8), np.int8)
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])

    def below(bits: int) -> np.ndarray:
        """Per key, the sum over all keys that agree but for the last ``bits`` bits."""
        at = _runs(keys >> np.uint64(bits))
        ends = np.append(at[1:], len(keys))
        return np.repeat(total[ends] - total[at], ends - at)

    here = below(8)
    for k in range(8):
        taken = below(7 - k)
        odds = np.log((taken + PRIOR) / (here - taken + PRIOR))
        found[:, k] = np.clip(np.rint(odds / STEP), -127, 127)
        here = taken
    return found


def _word_lists(table: pa.Table) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words of each row with their counts in its block."""
    unpack = zstandard.ZstdDecompressor().decompress
    for words, counts in zip(table.column("words").to_pylist(), table.column("word_counts").to_pylist()):
        yield unpack(words).split(b" ") if counts else [], _unpacked(counts, np.int64)


def _totals(table: pa.Table) -> Counter:
    """Counts of a shard's words over all blocks."""
    total: Counter = Counter()
    for words, counts in _word_lists(table):
        for word, count in zip(words, counts.tolist()):
            total[word] += count
    return total


def _vocabulary(table: pa.Table) -> pa.Table:
    """Number of different words and of words that a shard has from training texts."""
    seen = [c for c in _totals(table).values() if c]
    return pa.table({"n": pa.array([sum(seen)], pa.int64()), "v": pa.array([len(seen)], pa.int64())})


def _answer():
    """A function that adds up a shard's keys and words over all blocks and answers each block."""
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("payload", pa.binary()), ("values", pa.binary()), ("word_counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        asked = [_unpack_keys(p) for p in table.column("payload").to_pylist()]
        counts = np.concatenate([_unpacked(c, np.uint32) for c in table.column("counts").to_pylist()]).astype(np.int64)
        keys = np.concatenate(asked)
        order = np.argsort(keys, kind="stable")
        runs = _runs(keys[order])
        found = bit_predictions(keys[order[runs]], np.add.reduceat(counts[order], runs) if len(runs) else counts)
        place = np.empty(len(keys), np.int64)
        place[order] = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(keys))))
        values = [_packed(found[own]) for own in np.split(place, np.cumsum([len(own) for own in asked])[:-1])]
        total = _totals(table)
        known = [_packed(np.array([total[w] for w in words], np.int64)) for words, _ in _word_lists(table)]
        return pa.Table.from_arrays(
            [table.column("block"), table.column("shard"), table.column("payload"), pa.array(values, pa.binary()), pa.array(known, pa.binary())], schema=schema,
        )

    return run


class _Places:
    """Where each of many keys stands: tables by hash, each for what the one before could not hold."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        left, odd = np.arange(len(keys), dtype=np.int32), int(_ODD)
        while len(left):
            bits = max(int(2 * len(left)).bit_length(), 4)
            h = self._slot(keys[left], odd, bits)
            table = np.zeros(1 << bits, np.int32)
            table[h] = left
            self.tables.append((table, odd, bits))
            left, odd = left[table[h] != left], (odd * 0xD6E8FEB86659FD93 | 1) % (1 << 64)

    @staticmethod
    def _slot(keys: np.ndarray, odd: int, bits: int) -> np.ndarray:
        return (keys * np.uint64(odd)) >> np.uint64(64 - bits)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        found = left = None
        for table, odd, bits in self.tables:
            own = wanted if left is None else wanted[left]
            at = table[self._slot(own, odd, bits)]
            if left is None:
                found, left = at, np.flatnonzero(self.keys[at] != own)
            else:
                found[left] = at
                left = left[self.keys[at] != own]
            if not len(left):
                break
        return found


def mix(buffer: np.ndarray, known: list[tuple[np.ndarray, list[np.ndarray]]], starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of each segment of ``buffer``; all segments are walked at once, a byte at a time.

    ``known`` says for each place of the buffer where in some tables the predictors' bit predictions stand; eight in one whole
    number, none but zeros for a context that is not known. Segments must come longest first. Every segment has its own
    weights, one set for each number of known contexts, and its own refining map for each bit of a byte. All bits of a byte
    are coded before what they teach is added to the weights. Log odds are those of the bit that came, so an error is what
    its probability lacks; only the map is about set bits. What hangs on no weight is made ready for a stretch of bytes.
    """
    n, top = len(starts), len(buffer) - 1
    # Weights are kept negative and times STEP, so that the small numbers serve as they are; the map's probabilities less a
    # half and times their share, cells of one bucket side by side: most bits fall into the outermost.
    weights = np.full((K + 1) * K * n, -START_WEIGHT * STEP, np.float32)
    centres = (np.arange(BUCKETS) + 0.5) * (2 * FARTHEST / BUCKETS) - FARTHEST
    refined = np.repeat((MAP_SHARE * (1 / (1 + np.exp(-centres)) - 0.5)).astype(np.float32), 8 * n)
    found = np.zeros(n)
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left").tolist() if n else []
    sets = np.arange(K)[:, None] * n + np.arange(n)
    cells = np.arange(8 * n, dtype=np.float32).reshape(8, n)  # all cells are far fewer than a float tells apart
    bound, per_bucket, middle, row = (np.float32(c) for c in (FARTHEST - 1e-3, -BUCKETS / (2 * FARTHEST), BUCKETS / 2, 8 * n))
    keep, half, fade, rise = (np.float32(c) for c in (1 - MAP_SHARE, MAP_SHARE / 2, 1 - MAP_RATE, MAP_SHARE * MAP_RATE / 2))
    rise = rise.view(np.uint32)
    for begin in range(0, len(active), STRETCH):
        now = active[begin : begin + STRETCH]
        # Shorter segments read on into what follows them; no step uses that.
        at = np.minimum(starts[: now[0], None] + np.arange(begin, begin + len(now)), top)
        eight = np.empty((K, len(now), now[0]), np.int64)
        k = 0
        for place, tables in known:
            place = place.take(at, mode="clip")
            for odds in tables:
                eight[k] = odds.take(place, mode="clip").T
                k += 1
        of_bits = np.ascontiguousarray(eight.view(np.int8).reshape(K, *eight.shape[1:], 8).transpose(1, 3, 0, 2))
        gates = np.add.reduce(eight != 0, axis=0, dtype=np.int64) * (K * n)
        unset = ~np.ascontiguousarray(buffer.take(at).T).astype(np.uint32)
        chances = np.ones((len(now), now[0]))
        for t, a in enumerate(now):
            x = of_bits[t, :, :, :a].astype(np.float32, order="C")
            # The sign bit of a float, set for bits that are not: to flip it is to turn from a set bit to the one that came.
            sign = unset[t, :a] << TO_SIGN
            sign &= SIGN
            own = sets[:, :a] + gates[t, :a]
            w = weights.take(own, mode="clip")
            total = np.einsum("bka,ka->ba", x, w)
            np.maximum(total, -bound, out=total)
            np.minimum(total, bound, out=total)
            # The map is about set bits: the cell is that of the mixed log odds of a set bit.
            cell = (total.view(np.uint32) ^ sign).view(np.float32)
            cell *= per_bucket
            cell += middle
            np.floor(cell, out=cell)
            cell *= row
            cell += cells[:, :a]
            cell = cell.astype(np.int64)
            np.exp(total, out=total)
            total += 1
            p = np.divide(keep, total, out=total)
            # The chance of what came: the mixed probability, drawn towards the map's.
            set_p = refined.take(cell, mode="clip")
            chance = (set_p.view(np.uint32) ^ sign).view(np.float32)
            chance += p
            chance += half
            # Those of four bits are far from the least float, those of eight from the least double.
            four = np.multiply.reduce(chance.reshape(2, 4, a), axis=1)
            np.multiply(four[0], four[1], out=chances[t, :a], dtype=np.float64)
            set_p *= fade
            sign ^= rise
            set_p += sign.view(np.float32)
            refined[cell] = set_p
            rate = max(RATE / (1 + (begin + t) / 64), LEAST_RATE) * STEP * STEP
            p *= np.float32(rate / keep)
            p -= np.float32(rate)
            w += np.einsum("bka,ba->ka", x, p)
            weights[own] = w
        found[: now[0]] += np.log(chances, out=chances).sum(axis=0)
    return found


def _segments(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in the joined texts, length and text of every segment, longest first."""
    parts, at = [], 0
    for doc, size in enumerate(sizes):
        parts += [(at + s, min(SEGMENT, size - s), doc) for s in range(0, size, SEGMENT)]
        at += size
    starts, lengths, docs = np.array(parts, np.int64).T
    order = np.argsort(-lengths, kind="stable")
    return starts[order], lengths[order], docs[order]


def log_probabilities(texts: list[bytes], words: _Words, keys: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Base-10 log probability of each text, given its words and the bit predictions of all its keys."""
    if not texts:
        return np.zeros(0)
    where, odds, found = _Places(keys), np.ascontiguousarray(values).view(np.int64).ravel(), []
    # Tables in the order of words and codes, which keeps together what is used together.
    of_words = np.concatenate([odds.take(where.of(wanted)) for _, wanted in words.keys(bits)])
    codes, of_codes = _codes(texts, False, _Counted()).merged()[0], []
    for order in ORDERS:
        different, place = _shorter(codes, order)
        of_codes.append(odds.take(where.of(code_keys(different, order, bits))).take(place))
    del where
    codes = _Places(codes)
    for at in _split(texts, MIXED):
        data, scored = _padded(texts[at])
        wanted = context_codes(data)[scored]
        place = np.concatenate([codes.of(wanted[k : k + LOOK]) for k in range(0, len(wanted), LOOK)])
        known = [(place, of_codes), (words.places(at), [of_words])]
        buffer = np.frombuffer(b"".join(texts[at]), np.uint8)
        starts, lengths, docs = _segments([len(t) for t in texts[at]])
        runs = [slice(k, k + LANES) for k in range(0, len(starts), LANES)]
        of_segments = np.concatenate([mix(buffer, known, starts[r], lengths[r]) for r in runs])
        order = np.lexsort((starts, docs))
        found.append(np.add.reduceat(of_segments[order], _runs(docs[order])))
    return np.concatenate(found) / math.log(10)


def _score(n_tokens: int, n_distinct: int, shards: int, bits: int):
    """A function that scores the documents of one block from its bytes, word counts and bit predictions."""
    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def run(table: pa.Table) -> pa.Table:
        head = table.filter(pa.compute.is_valid(table.column("ids"))).to_pylist()[0]
        data, texts, at = zstandard.ZstdDecompressor().decompress(head["payload"]), [], 0
        for size in head["sizes"]:
            texts.append(data[at : at + size])
            at += size
        del data
        answers = table.filter(pa.compute.is_valid(table.column("shard"))).sort_by("shard")
        keys = np.concatenate([_unpack_keys(p) for p in answers.column("payload").to_pylist()])
        values = np.concatenate([_unpacked(v, np.int8, 8) for v in answers.column("values").to_pylist()])
        # What is said of a text hangs on nothing but the text, so copies in a block share it.
        different = {text: k for k, text in enumerate(dict.fromkeys(texts))}
        copies, texts = np.array([different[text] for text in texts]), list(different)
        del different
        words = _Words(texts)
        # The block's words by shard, in the order of their first place, as it asked for them.
        counts, numbers = np.zeros(len(words.starts) - 1, np.int64), _by_shard(words.listed(), shards)
        for shard, known in zip(answers.column("shard").to_pylist(), answers.column("word_counts").to_pylist()):
            counts[numbers.pop(shard, [])] = _unpacked(known, np.int64)
        logs = np.log10((counts + BASE_PRIOR) / (n_tokens + BASE_PRIOR * (n_distinct + 1)))
        del answers, table, numbers
        n, known, base = np.diff(words.first), *(np.add.reduceat(of_word.take(words.ids), words.first[:-1]) for of_word in ((counts > 0).astype(np.int64), logs))
        scores = log_probabilities(texts, words, keys, values, bits)
        return pa.Table.from_pydict({
            "doc_id": head["ids"], "learned": head["learn"], "n_tokens": n[copies], "n_known": known[copies], "train_tokens": [n_tokens] * len(copies),
            "base_score": base[copies], "score": scores[copies], "n_bytes": np.array([len(t) for t in texts])[copies],
        }, schema=schema)

    return run


def score(docs: DataFrame, learn: Column) -> DataFrame:
    """Log probabilities of every text under the mixed model and under smoothed word frequencies, learned where ``learn`` holds.

    A null text is an empty one: its only token is the end. ``learn`` that is null counts as false. Repeated rows count and
    are scored each; without training texts no context is known and every bit is even. No rows give no rows; other columns
    are left out. ``n_bytes`` is the number of bytes that ``score`` covers. A block holds ``BLOCK`` bytes and one text more at
    most, a shard about ``SHARD`` bytes' worth of contexts.
    """
    size = docs.select(F.octet_length("text").cast("long").alias("n"), F.spark_partition_id().alias("p")).agg(F.sum("n").alias("bytes"), F.max("p").alias("last")).first()
    if size["last"] is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    shards = min((size["bytes"] or 0) // SHARD + size["last"] + 1, 1 << 28)
    bits = hash_bits(size["bytes"] or 0)
    parts = durable(gather(docs, learn, shards, bits), "contexts")
    asked = parts.where(F.col("shard").isNotNull())
    words = asked.select("shard", "words", "word_counts").groupBy("shard").applyInArrow(_vocabulary, "n long, v long")
    known = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    answers = asked.select("block", "shard", "payload", "counts", "words", "word_counts").groupBy("shard").applyInArrow(
        _answer(), "block long, shard int, payload binary, values binary, word_counts binary",
    )
    rows = parts.where(F.col("ids").isNotNull()).select("block", "ids", "learn", "sizes", "payload").unionByName(answers, allowMissingColumns=True)
    return rows.groupBy("block").applyInArrow(_score(known["n"], known["v"], shards, bits), RESULT)
