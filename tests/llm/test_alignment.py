"""Token alignment against a plain loop over both tokenizers' tokens."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wayfold.llm import alignment

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "plain words of a text", "plain words of a text", None, "", " ", "  two  spaces ", "line\nbreak\r\n\r\nend\t", "▁ is lost", "größe 東京 🙂 naïve",
    "<|endoftext|> and </s> and <0x41>", "x", "a" * 5000, "the the the the\x00the", "1234567890 !!! ???", "word " * 3000 + "end", "é́　wide",
]


def plain(texts):
    """Per text: token counts, links and digest, by walking over ends; then the corpus figures."""
    first, second = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    first.encode_special_tokens = True
    a_bytes, b_bytes = alignment.byte_vocabulary(FIRST), alignment.piece_vocabulary(second)
    rows, links, counts = [], [], Counter()
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if not b"".join(a_bytes[t] for t in a) == b"".join(b_bytes[t] for t in b) == whole:
            a, b = [], []
        ends = [{}, {}]
        for side, ids, vocabulary in ((0, a, a_bytes), (1, b, b_bytes)):
            at = 0
            for place, t in enumerate(ids):
                at += len(vocabulary[t])
                ends[side][at] = place
        own, groups, done = [], [], (0, 0)
        for end in sorted(ends[0].keys() & ends[1].keys()):
            i, j = ends[0][end], ends[1][end]
            own.append((a[i], b[j]))
            groups.append(",".join(map(str, a[done[0] : i + 1])) + "|" + ",".join(map(str, b[done[1] : j + 1])))
            done = i + 1, j + 1
        counts.update(own)
        links.append(own)
        rows.append((len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(*r[:4], sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), r[4]) for r, own in zip(rows, links)]


def test_alignment_equals_a_plain_loop(spark):
    docs = spark.createDataFrame([(k, t, "x", k) for k, t in enumerate(TEXTS)], "doc_id long, text string, block string, n int").repartition(3)
    found = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs).collect()}
    assert [found[k] for k in range(len(TEXTS))] == plain(TEXTS)
    assert found[2] == (0, 0, 0, 0, 0, 0, "") and found[7][0] == 0


def test_alignment_of_the_documents_and_of_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip((r[0] for r in rows), plain([r[1] for r in rows])))
    assert {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs).collect()} == want
    assert alignment.align(docs.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1, 300])
def test_alignment_does_not_hang_on_block_sizes(spark, size, monkeypatch):
    monkeypatch.setattr(alignment, "JOINED", size)
    monkeypatch.setattr(alignment, "BLOCK", 2 * size)
    align = alignment._aligner(FIRST, SECOND)
    docs = spark.createDataFrame([(k % 5, t) for k, t in enumerate(TEXTS * 2)], "doc_id long, text string").coalesce(1)
    assert sorted(map(repr, (tuple(r)[1:] for r in alignment.align(docs).collect()))) == sorted(map(repr, plain(TEXTS * 2)))
    assert align([])[2].tolist() == []
