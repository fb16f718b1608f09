import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from wayfold.llm import suffixes


def brute(texts, width):
    at = defaultdict(list)
    raws = [(t or "").encode() for t in texts]
    for k, t in enumerate(raws):
        for i in range(len(t) - width + 1):
            at[t[i : i + width]].append((k, i))
    gone = [bytearray(len(t)) for t in raws]
    for places in at.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + width] = b"\1" * width
    out = []
    for t, g in zip(raws, gone):
        kept = bytes(b for b, x in zip(t, g) if not x)
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        out.append((len(t), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    texts = [None, "", "short", "a" * 900, "ab" * 450, "a" * 199, "a" * 200, "z" * 201]
    for _ in range(60):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a, b = sorted((rng.randint(0, len(s)), rng.randint(0, len(s))))
            parts += [rng.choice([s, s[a:b]]), prose(rng.randint(0, 20))]
        texts.append(rng.choice(["", " "]).join(parts))
    texts += texts[10:14] + [texts[12][:-1] + "!"] + [shared[0]] * 3
    return texts


@pytest.mark.parametrize("width,gram,options", [(200, 32, {}), (40, 8, {}), (40, 8, {"bucket_items": 5}), (40, 8, {"hot_classes": 3})])
def test_against_all_windows(spark, width, gram, options):
    texts = corpus(width + gram)
    docs = spark.createDataFrame([(k, t, f"s{k}", 7) for k, t in enumerate(texts)], "doc_id long, text string, id string, spans int")
    got = {r[0]: tuple(r[1:]) for r in suffixes.remove_repeats(docs.repartition(5), width, gram, **options).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, width)


def test_repeated_rows_null_ids_and_kept_bytes(spark):
    prose = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(500))
    docs = spark.createDataFrame([(1, prose), (1, prose), (None, "x" + prose), (2, "y" * 10), (2, prose[:150])], "doc_id long, text string")
    rows = sorted(suffixes.remove_repeats(docs, with_text=True).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes))
    assert [(r.doc_id, r.n_removed, r.n_spans, bytes(r.kept).decode()) for r in rows] == [
        (1, 500, 1, ""), (1, 500, 1, ""), (2, 0, 0, "y" * 10), (2, 0, 0, prose[:150]), (None, 500, 1, "x"),
    ]


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.choice(b"abc") for _ in range(9000))
    whole = [p.tolist() for _, p in suffixes.anchors_of([text, text[:3000]])]
    monkeypatch.setattr(suffixes, "_PIECE", 1000)
    cut = [p.tolist() for _, p in suffixes.anchors_of([text, text[:3000]])]
    assert sum(whole, []) == sum(cut, [])


def test_loser_tree_never_compares_known_prefixes(monkeypatch):
    rng = random.Random(3)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30))) for _ in range(7)]
    coded = [list(zip(suffixes._common(r, 12).tolist(), r)) for r in runs]
    seen = []
    real = suffixes._more_common
    monkeypatch.setattr(suffixes, "_more_common", lambda a, b, k: (seen.append(a[:k] == b[:k]), real(a, b, k))[1])
    out = list(suffixes.LoserTree(coded))
    merged = [runs[k][p] for k, p, _ in out]
    assert merged == sorted(sum(runs, []))
    assert [s for _, _, s in out][1:] == suffixes._common(merged, 12).tolist()[1:]
    assert all(seen) and len(seen) > 10


def test_classes_find_pairs_by_both_sides():
    rights, lefts = [b"abcd", b"abce", b"abxx"], [b"z", b"yz", b"z"]
    least, most = suffixes.resolve(np.array([0, 3, 2]), rights, lefts, np.ones(3, int), width=4, gram=2)
    assert least.tolist() == [1, 1, -1] and most.tolist() == [1, 1, -1]
