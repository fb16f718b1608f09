"""Context mixing against plain dictionaries of counts and a loop over bits."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfold.llm import mixing

TEXTS = ["The cat sat on the mat.", "the cat  sat\non THE mat.", None, "", "  \t", "größe 東京 \x00 naïve", "the cat", "zebra " * 40, "x" * 3000, "q" * 2049]


def contexts(data: bytes, at: int):
    """The contexts of one byte, by predictor."""
    before = mixing._PAD + data[:at]
    yield from ((k, before[-k:]) for k in mixing.ORDERS)
    start = max(before.rfind(b" "), before.rfind(b"\n")) + 1
    yield "word", before[start:]


def side(counter: Counter, byte: int, k: int) -> float:
    """Log odds, in steps, that bit ``k`` is as in ``byte``, given the bits before it."""
    here, taken = (sum(c for b, c in counter.items() if b >> s == byte >> s) for s in (8 - k, 7 - k))
    return max(-127, min(127, round(math.log((taken + mixing.PRIOR) / (here - taken + mixing.PRIOR)) / mixing.STEP))) * mixing.STEP


def plain(texts, learned):
    """Counts in a dictionary, then every text by itself, byte by byte and bit by bit."""
    following = {}
    words = Counter()
    data = [mixing.as_bytes(mixing.tokens(t.encode() if t is not None else None)) for t in texts]
    for text, own in zip(data, learned):
        if own:
            words.update(text.split(b" "))
            for at, byte in enumerate(text):
                for context in contexts(text, at):
                    following.setdefault(context, Counter())[byte] += 1
    n, v = sum(words.values()), len(words)
    rows = []
    for text in data:
        split = text.split(b" ")
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split)
        total = 0.0
        for start in range(0, len(text), mixing.SEGMENT):
            weights = np.full((mixing.K + 1, mixing.K), mixing.START_WEIGHT)
            width = 2 * mixing.FARTHEST / mixing.BUCKETS
            refined = [[1 / (1 + math.exp(-((k + 0.5) * width - mixing.FARTHEST))) for k in range(mixing.BUCKETS)] for _ in range(8)]
            for t, byte in enumerate(text[start : start + mixing.SEGMENT]):
                known = [following.get(c, Counter()) for c in contexts(text, start + t)]
                predictions = [[side(counter, byte, k) for k in range(8)] for counter in known]
                gate = sum(any(own) for own in predictions)
                learned = np.zeros(mixing.K)
                rate = max(mixing.RATE / (1 + t / 64), mixing.LEAST_RATE)
                for k in range(8):
                    bit = byte >> (7 - k) & 1
                    x = np.array([own[k] * (1 if bit else -1) for own in predictions])
                    dot = min(max(float(weights[gate] @ x), -mixing.FARTHEST + 1e-3), mixing.FARTHEST - 1e-3)
                    p, cell = 1 / (1 + math.exp(-dot)), int((dot + mixing.FARTHEST) / width)
                    final = p + mixing.MAP_SHARE * (refined[k][cell] - p)
                    total += math.log(final if bit else 1 - final)
                    refined[k][cell] += mixing.MAP_RATE * (bit - refined[k][cell])
                    learned += rate * (bit - p) * x
                weights[gate] += learned
        rows.append((len(split), sum(words[w] > 0 for w in split), n, base, total / math.log(10)))
    return rows


def check(found, want):
    assert [tuple(f)[:3] for f in found] == [w[:3] for w in want]
    for f, w in zip(found, want):
        assert f[3] == pytest.approx(w[3], rel=1e-9) and f[4] == pytest.approx(w[4], rel=5e-3, abs=5e-3)


COLUMNS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_mixing_equals_a_loop_over_bits(spark):
    docs = spark.createDataFrame([(k, t, "w", k) for k, t in enumerate(TEXTS)], "doc_id long, text string, word string, shard int").repartition(3)
    found = {r["doc_id"]: [r[c] for c in COLUMNS] for r in mixing.score(docs, F.col("doc_id") % 3 != 1).collect()}
    check([found[k] for k in range(len(TEXTS))], plain(TEXTS, [k % 3 != 1 for k in range(len(TEXTS))]))


def test_mixing_of_the_documents_beats_word_frequencies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    rows = mixing.score(docs, learn).collect()
    assert len(rows) == docs.count() and all(r["score"] < 0 for r in rows)
    held = [r for r in rows if not r["learned"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_mixing_without_rows_and_without_training_rows(spark, monkeypatch):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert mixing.score(empty, F.lit(True)).collect() == []
    rows = mixing.score(spark.createDataFrame([(1, "ab"), (1, "ab")], "doc_id long, text string"), F.lit(None).cast("boolean")).collect()
    assert len(rows) == 2 and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["n_tokens"] == 2 for r in rows)
    assert rows[0]["score"] == pytest.approx(-4 * 8 * math.log10(2), rel=1e-2)


def test_scores_do_not_hang_on_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    want = {r["doc_id"]: r["score"] for r in mixing.score(docs.coalesce(1), F.lit(True)).collect()}
    shards = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r["score"] for r in mixing.score(shards, F.lit(True)).collect()}
    assert found == pytest.approx(want, rel=1e-5)


def test_predictions_come_from_exact_counts():
    keys = np.array([(5 << 8) | 65, (5 << 8) | 66, (9 << 8) | 65], np.uint64)
    found = mixing.bit_predictions(keys, np.array([3, 1, 0]))
    assert found[2].tolist() == [0] * 8
    odds = lambda own, other: round(math.log((own + mixing.PRIOR) / (other + mixing.PRIOR)) / mixing.STEP)
    assert found[0].tolist() == [odds(4, 0)] * 6 + [odds(3, 1), odds(3, 0)] and found[1].tolist() == [odds(4, 0)] * 6 + [odds(1, 3), odds(1, 0)]


def test_keys_are_packed_without_loss():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 52, 3000, np.uint64), np.arange(300, dtype=np.uint64) + np.uint64(7 << 30)]))
    assert (mixing._unpack_keys(mixing._pack_keys(keys)) == keys).all() and len(mixing._unpack_keys(b"")) == 0
    where = mixing._Places(keys)
    wanted = rng.choice(keys, 5000)
    assert (keys[where.of(wanted)] == wanted).all()


def scored_here(spark, texts):
    """One block's scores, worked out in this process."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    parts = mixing.gather(docs, F.col("doc_id") % 3 != 1, 1, 32).toArrow()
    head, asked = (parts.filter(pa.compute.is_valid(parts.column(name))) for name in ("ids", "shard"))
    known = mixing._vocabulary(asked).to_pylist()[0]

    def run():
        answers = mixing._answer()(asked)
        table = pa.concat_tables([head.select(["block", "ids", "learn", "sizes", "payload"]), answers], promote_options="default")
        return mixing._score(known["n"], known["v"], 1, 32)(table)

    return run


def test_a_block_hashes_each_of_its_contexts_once(spark, monkeypatch):
    texts = [" ".join(f"word{k * j % 20}" for j in range(30)) for k in range(200)]
    run, hashed, plainly = scored_here(spark, texts), [], mixing._hashed
    monkeypatch.setattr(mixing, "_hashed", lambda h, order, bits: (hashed.append(len(h)), plainly(h, order, bits))[1])
    assert run().num_rows == 200 and 0 < sum(hashed) < sum(map(len, texts)) / 4


@pytest.mark.parametrize("texts", [TEXTS, [f"{k} kat{k % 7}" for k in range(90)] + ["same"] * 5])
def test_scores_do_not_hang_on_what_is_done_at_once(spark, monkeypatch, texts):
    run = scored_here(spark, texts)
    rows = [run().to_pylist()]
    for name, value in {"LANES": 3, "STRETCH": 5, "LOOK": 16, "SORTED": 50, "MIXED": 64}.items():
        monkeypatch.setattr(mixing, name, value)
    rows.append(run().to_pylist())
    for found in rows:
        check([[r[c] for c in COLUMNS] for r in found], plain(texts, [k % 3 != 1 for k in range(len(texts))]))
    assert [r["score"] for r in rows[0]] == pytest.approx([r["score"] for r in rows[1]], rel=1e-6)
