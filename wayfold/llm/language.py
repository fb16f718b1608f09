"""Language ID by bit-sliced Bloom filters of byte n-grams.

One slot of the filter holds a bit per language, so a single look-up of an n-gram's slots, joined by AND, gives the
set of all languages that know the n-gram. A document's n-grams are counted per language; the expected false hits of
that language's filter are taken off; the language with most corrected hits wins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.batches import map_batches, raw, slices

GRAM = 4  # bytes
SLOT_BITS = 21
HASHES = 3
#: An n-gram belongs to a language if it is this share of the language's n-grams, and at least this share of its rate where it is most
#: common. A rate, so that what is known does not grow with the corpus; in small ones it must have been seen this often too.
LEAST_RATE = 1e-5
LEAST_SEEN = 3
LEAST_SHARE = 0.2
#: Below this part of a language's usual corrected share of known n-grams (the median of its own training rows), a text is not in it.
LEAST_KNOWN = 0.5
_BINS = 1000
_PIECE = 1 << 20
_SPACED = bytes.maketrans(bytes(range(65)) + bytes(range(91, 97)) + bytes(range(123, 128)), b" " * 76)


def has_letter(text: str) -> bool:
    """Whether any character is a letter (a Unicode category L: no fractions, circled digits or number forms)."""
    return any(map(str.isalpha, text))


def _buffer(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts in one array, ASCII other than letters as space, and where each begins; a space on either side."""
    parts = [b"   " + (t or b"").decode("utf-8").lower().encode("utf-8").translate(_SPACED) + b" " for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return np.frombuffer(b"".join(parts) + b"   ", np.uint8), starts


def _grams(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that starts at each byte as an integer, and which of them count: not two spaces in a row at either end."""
    b = buffer.astype(np.uint32)
    n = len(b) - GRAM + 1
    grams = b[:n].copy()
    for k in range(1, GRAM):
        grams = (grams << np.uint32(8)) | b[k : n + k]
    space = buffer == 32
    blank = space[:-1] & space[1:]
    good = ~blank[:n] & ~blank[GRAM - 2 : GRAM - 2 + n] & ~blank[1 : n + 1]
    return grams, good


def _slots(grams: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    """Slots of each n-gram, from two halves of a mixed 64-bit product."""
    x = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    one, two = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    mask = np.uint64((1 << bits) - 1)
    return [((one + np.uint64(k) * two) & mask).astype(np.int64) for k in range(hashes)]


def _pieces(texts: list[bytes | None]):
    """Runs of whole texts of a few MB together, so that work arrays stay small."""
    first = size = 0
    for at, text in enumerate(texts):
        size += len(text or b"")
        if size > _PIECE:
            yield first, at + 1
            first, size = at + 1, 0
    if first < len(texts):
        yield first, len(texts)


@dataclass
class LanguageModel:
    """Filter words (64 languages each), languages by bit, their false-hit rates and least known shares, and the commonest language."""

    langs: list[str]
    words: np.ndarray
    false_rate: np.ndarray
    least_known: np.ndarray
    common: str | None
    bits: int = SLOT_BITS
    hashes: int = HASHES


def learn(
    docs: DataFrame, slot_bits: int = SLOT_BITS, hashes: int = HASHES, least_seen: int = LEAST_SEEN, least_share: float = LEAST_SHARE,
    least_rate: float = LEAST_RATE, least_known: float = LEAST_KNOWN,
) -> LanguageModel:
    """Learn from the rows of ``docs`` (``text``, ``lang``) in which neither is null.

    N-grams are counted inside tasks and summed by (language, n-gram), which no hot document or source can skew: a task
    sends at most one row per language and n-gram. The driver gets the filter's slots only, 2**slot_bits at most. A second
    pass over the same rows counts known shares, in ``_BINS`` steps per language.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")

    def count(batches):
        sums: dict[str, dict] = {}
        for batch in slices(batches):
            texts, langs = raw(batch, "text"), batch.column("lang").to_pylist()
            for first, last in _pieces(texts):
                by: dict[str, list] = {}
                for text, lang in zip(texts[first:last], langs[first:last]):
                    by.setdefault(lang, []).append(text)
                for lang, own in by.items():
                    grams, good = _grams(_buffer(own)[0])
                    values, often = np.unique(grams[good], return_counts=True)
                    held = sums.setdefault(lang, {"g": [], "c": [], "n": 0})
                    held["g"].append(values)
                    held["c"].append(often)
                    held["n"] += len(values)
                    if held["n"] > 500_000:
                        _fold(held)
        for lang, held in sums.items():
            _fold(held)
            values, often = held["g"][0], held["c"][0]
            for k in range(0, len(values), 100_000):
                part = slice(k, k + 100_000)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(values[part])), "gram": pa.array(values[part].astype(np.int64)), "seen": pa.array(often[part].astype(np.int64)),
                })

    counts = known.mapInArrow(count, "lang string, gram long, seen long").groupBy("gram", "lang").agg(F.sum("seen").alias("seen"))
    from wayfold.session import durable

    counts = durable(counts, "language-counts")
    totals = {r.lang: r.seen for r in counts.groupBy("lang").agg(F.sum("seen").alias("seen")).collect()}
    langs = sorted(totals)
    if not langs:
        return LanguageModel([], np.zeros((0, 1 << slot_bits), np.uint64), np.zeros(0), np.zeros(0), None, slot_bits, hashes)
    rate = F.lit(0.0)
    for lang in langs:
        rate = F.when(F.col("lang") == lang, F.col("seen") / F.lit(float(totals[lang]))).otherwise(rate)
    at = {lang: k for k, lang in enumerate(langs)}
    place = F.lit(0)
    for lang in langs:
        place = F.when(F.col("lang") == lang, F.lit(at[lang])).otherwise(place)
    per_gram = (
        counts.select("gram", "seen", rate.alias("rate"), place.alias("place"))
        .groupBy("gram").agg(F.collect_list(F.struct("place", "rate", "seen")).alias("by"), F.max("rate").alias("most"))  # a struct per language
        .select("gram", F.explode("by").alias("x"), "most")
        .where((F.col("x.seen") >= least_seen) & (F.col("x.rate") >= least_rate) & (F.col("x.rate") >= least_share * F.col("most")))
        .select("gram", F.col("x.place").alias("place"))
    )

    def slots(batches):
        for batch in batches:
            grams = batch.column("gram").to_numpy().astype(np.uint32)
            place = batch.column("place").to_numpy()
            bit = np.left_shift(np.int64(1), (place % 64).astype(np.int64))
            for s in _slots(grams, slot_bits, hashes):
                yield pa.RecordBatch.from_pydict({"word": pa.array((place // 64).astype(np.int32)), "slot": pa.array(s.astype(np.int32)), "bits": pa.array(bit)})

    filled = per_gram.mapInArrow(slots, "word int, slot int, bits long").groupBy("word", "slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(((len(langs) + 63) // 64, 1 << slot_bits), np.uint64)
    words[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["bits"].to_numpy().astype(np.int64).view(np.uint64)
    fill = np.array([np.count_nonzero(words[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(langs))]) / (1 << slot_bits)
    model = LanguageModel(langs, words, fill**hashes, np.zeros(len(langs)), max(langs, key=lambda x: totals[x]), slot_bits, hashes)
    model.least_known = least_known * _usual_shares(known, model)
    return model


def _usual_shares(known: DataFrame, model: LanguageModel) -> np.ndarray:
    """Per language, the median of its own rows' corrected share of n-grams that it knows."""
    shared = known.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        m = shared.value
        at = {lang: k for k, lang in enumerate(m.langs)}
        sums = np.zeros((len(m.langs), _BINS + 1), np.int64)
        for batch in slices(batches):
            place = np.array([at.get(x, -1) for x in batch.column("lang").to_pylist()])
            total, hits = corrected_hits(m, raw(batch, "text"))
            rows = np.flatnonzero((place >= 0) & (total > 0))
            share = np.minimum(1, hits[rows, place[rows]] / total[rows])
            np.add.at(sums, (place[rows], np.round(share * _BINS).astype(np.int64)), 1)
        place, step = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict({"place": pa.array(place.astype(np.int32)), "step": pa.array(step.astype(np.int32)), "n": pa.array(sums[place, step])})

    steps = known.mapInArrow(count, "place int, step int, n long").groupBy("place", "step").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros((len(model.langs), _BINS + 1), np.int64)
    sums[steps["place"].to_numpy(), steps["step"].to_numpy()] = steps["n"].to_numpy()
    upto = sums.cumsum(axis=1)
    return (2 * upto >= upto[:, -1:]).argmax(axis=1) / _BINS


def _fold(held: dict) -> None:
    values, back = np.unique(np.concatenate(held["g"]), return_inverse=True)
    held["g"], held["c"], held["n"] = [values], [np.bincount(back, np.concatenate(held["c"])).astype(np.int64)], len(values)


def corrected_hits(model: LanguageModel, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the counted n-grams, and per language its hits less the expected false ones (never below zero)."""
    total, hits = np.zeros(len(texts)), np.zeros((len(texts), len(model.langs)))
    for first, last in _pieces(texts):
        buffer, starts = _buffer(texts[first:last])
        grams, good = _grams(buffer)
        edges = starts[:-1]
        good[starts[1:-1] - 1] = False  # over the border of two texts, where the space of one is followed by those of the next
        total[first:last] = np.add.reduceat(good, edges, dtype=np.int64)
        slots = _slots(grams, model.bits, model.hashes)
        for w, word in enumerate(model.words):
            mask = word[slots[0]]
            for s in slots[1:]:
                mask &= word[s]
            mask[~good] = 0
            for k in range(w * 64, min(len(model.langs), w * 64 + 64)):
                hits[first:last, k] = np.add.reduceat((mask >> np.uint64(k - w * 64)).astype(np.uint8) & 1, edges, dtype=np.int64)
    expected = total[:, None] * model.false_rate
    return total, np.maximum(0, (hits - expected) / np.maximum(1e-9, 1 - model.false_rate))


def _judge(m: LanguageModel, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    n = len(texts)
    letters = np.array([t is not None and has_letter(t.decode("utf-8")) for t in texts], bool)
    if not m.langs:
        return ["und"] * n, np.zeros(n), np.zeros(n)
    total, hits = corrected_hits(m, texts)
    best = hits.argmax(axis=1)
    top = hits[np.arange(n), best]
    hits[np.arange(n), best] = 0
    score = np.where(letters & (top > 0), top / np.maximum(top + hits.max(axis=1), 1e-9), 0)
    known = np.where(letters, np.minimum(1, top / np.maximum(total, 1)), 0)
    return [(m.langs[b] if t > 0 else m.common) if ok else "und" for b, t, ok in zip(best, top, letters)], score, known


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, known``: the language with most corrected hits, its lead, and its share of the n-grams.

    ``score`` is the winner's part of the two best languages' corrected hits. Null texts and texts without a letter are
    ``und`` with score 0; a text with letters that no filter knows gets the commonest language with score 0. Ties go to
    the first language by name; without a language learned all are ``und``. The model is of fixed size and goes out once
    per executor; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            langs, score, known = _judge(shared.value, raw(batch, "text"))
            return {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": score, "known": known}

        return step

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), make, "doc_id long, lang_pred string, score double, known double")


def in_known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in one of the languages learned.

    Rejected: null texts, texts without a letter, and texts of whose n-grams the likeliest language knows less than its own
    ``least_known``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    limits = dict(zip(model.langs, model.least_known))

    def run(batches):
        for batch in slices(batches):
            langs, _, known = _judge(shared.value, raw(batch, "text"))
            least = np.array([limits.get(x, np.inf) for x in langs])
            yield batch.filter(pa.array((known > 0) & (known >= least), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
