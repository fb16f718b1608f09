"""Alignment of two tokenizers over the same texts, in Arrow arrays.

Both tokenizers' ids lie flat, with the document of each token as parent index; token lengths taken from the vocabularies
and summed up within documents give byte ends. An Acero hash join on (document, end) finds the tokens that end together:
there the texts are cut into groups, and the two tokens are linked. Each block of documents counts its id pairs by
``Table.group_by``; Spark merges these partial counts, and the merged ones travel back to the blocks that hold the pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfold.llm.batches import raw, slices
from wayfold.llm.packing import encoder
from wayfold.session import durable

#: Bytes of text that one join takes, and that one block of documents holds (each more by one document at most).
JOINED, BLOCK = 1 << 20, 1 << 22
_CACHE = 400_000
_SPACES = re.compile(r"\s\s")
BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, groups_sha256 array<string>, "
    "links binary, a array<int>, b array<int>, n array<long>"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_vocabulary(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary in JSON form; missing ids have none."""
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    # The byte-level alphabet: printable characters stand for themselves, the others are moved behind 255 in order.
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    byte_of = {chr(b): b for b in plain}
    byte_of.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})
    found = [b""] * (max(entries.values()) + 1)
    for token, at in entries.items():
        found[at] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return found


def piece_vocabulary(processor) -> list[bytes]:
    """The bytes of each piece of a sentencepiece model: U+2581 is a space, byte pieces are their byte, control pieces have none."""
    def of(at: int) -> bytes:
        piece = processor.id_to_piece(at)
        if processor.is_control(at):
            return b""
        return bytes([int(piece[1:-1], 16)]) if processor.is_byte(at) else piece.replace("▁", " ").encode()

    return [of(at) for at in range(processor.get_piece_size())]


class _Runs(dict):
    """Ids, four bytes each, of runs of text that stand alone; forgets all when full."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, run: str) -> bytes:
        if len(self) >= _CACHE:
            self.clear()
        found = self[run] = self.encode(run)
        return found


def _both(first: str, second: str):
    """Functions from text to the ids of either tokenizer, and their vocabularies as bytes.

    Where no two white spaces meet and none is at an end, every space begins a token in both, so the runs between
    spaces are looked up; a piece with a space inside would rule that out for the second.
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=second)
    in_bytes = encoder(os.path.splitext(first)[0] + ".tiktoken", specials_as_text=True)
    in_pieces = lambda text: np.array(pieces.encode(text), np.int32).tobytes()
    a_of, b_of = _Runs(lambda run: in_bytes(" " + run)), _Runs(in_pieces)
    b_vocabulary = piece_vocabulary(pieces)
    alone = not any(b" " in token.lstrip(b" ") for token in b_vocabulary)

    def ids(text: str) -> tuple[bytes, bytes]:
        if text[0].isspace() or text[-1].isspace() or _SPACES.search(text):
            return in_bytes(" " + text), in_pieces(text)
        runs = text.split(" ")
        return b"".join(map(a_of.__getitem__, runs)), b"".join(map(b_of.__getitem__, runs)) if alone else in_pieces(text)

    return ids, byte_vocabulary(first), b_vocabulary


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where each part begins, and the end of the last."""
    return np.concatenate([[0], np.cumsum(sizes)])


def _tokens(starts: np.ndarray, ids: np.ndarray, lengths: pa.Array) -> pa.Table:
    """One row per token: its document, the byte at which it ends, its id and its place among all tokens."""
    nested = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
    flat, parent = pc.list_flatten(nested), pc.list_parent_indices(nested)
    total = pc.cumulative_sum(lengths.take(flat))
    before = np.concatenate([[0], total.to_numpy()])[starts[:-1]]  # what all earlier documents add up to
    ends = pc.subtract(total, pa.array(before, pa.int64()).take(parent))
    return pa.table({"doc": parent, "end": ends, "id": flat, "at": pa.array(np.arange(len(flat)), pa.int64())})


def _aligner(first: str, second: str):
    """A function that aligns a list of texts: counts per text, digests, and the linked ids of all texts in order."""
    ids, a_bytes, b_bytes = _both(first, second)
    a_lengths, b_lengths = (pa.array([len(t) for t in v], pa.int64()) for v in (a_bytes, b_bytes))
    a_text, b_text = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
    kinds = [(len(a_bytes), ","), (len(a_bytes), "|"), (len(b_bytes), ","), (len(b_bytes), ";")]
    written = pa.array([f"{k}{mark}".encode() for size, mark in kinds for k in range(size)], pa.large_binary())
    _, a_last, b_inner, b_last = np.cumsum([0] + [size for size, _ in kinds])[:4]
    nothing = (b"", b"")

    def flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _starts(np.array([len(p) // 4 for p in parts], np.int64)), np.frombuffer(b"".join(parts), np.int32)

    def bytes_of(text: pa.Array, starts: np.ndarray, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        joined = text.take(pa.array(ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return memoryview(joined.buffers()[2] or b"").cast("B"), ends[starts]

    def align(texts: list[bytes | None]):
        encoded = [ids(text.decode("utf-8")) if text else nothing for text in texts]
        # Texts that either tokenizer does not give back byte for byte have no tokens.
        (a_at, a_ids), (b_at, b_ids) = (flat([e[k] for e in encoded]) for k in (0, 1))
        (a_joined, a_cut), (b_joined, b_cut) = bytes_of(a_text, a_at, a_ids), bytes_of(b_text, b_at, b_ids)
        lost = [
            bool(text) and not (a_joined[a_cut[k] : a_cut[k + 1]] == b_joined[b_cut[k] : b_cut[k + 1]] == b" " + text)
            for k, text in enumerate(texts)
        ]
        if any(lost):
            encoded = [nothing if gone else e for gone, e in zip(lost, encoded)]
            (a_at, a_ids), (b_at, b_ids) = (flat([e[k] for e in encoded]) for k in (0, 1))
        links = _tokens(a_at, a_ids, a_lengths).join(
            _tokens(b_at, b_ids, b_lengths), keys=["doc", "end"], right_suffix="_b", join_type="inner", use_threads=False,
        ).sort_by("at")
        doc, la, lb = (links.column(c).to_numpy() for c in ("doc", "at", "at_b"))
        # Tokens in the order of their groups, first all of one tokenizer, then all of the other, each with its mark.
        a_end, b_end = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        a_end[la], b_end[lb] = True, True
        a_group, b_group = np.cumsum(a_end) - a_end, np.cumsum(b_end) - b_end
        signs = np.empty(len(a_ids) + len(b_ids), np.int64)
        signs[np.arange(len(a_ids)) + np.concatenate([[0], lb + 1])[a_group]] = a_ids + a_last * a_end
        signs[np.arange(len(b_ids)) + (la + 1)[b_group]] = b_inner + b_ids + (b_last - b_inner) * b_end
        text, cut = bytes_of(written, a_at + b_at, signs)
        digests = [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
        n_links = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
        return np.diff(a_at), np.diff(b_at), n_links, digests, links.column("id").to_numpy(), links.column("id_b").to_numpy()

    return align


def blocks(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Aligned documents, gathered in blocks, with the counts of their id pairs.

    ``links`` holds, for all links of a block in order, which of its pairs it is (32-bit integers, compressed).
    """
    schema = to_arrow_schema(StructType.fromDDL(BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, pack = _aligner(first, second), zstandard.ZstdCompressor(1).compress
        turn = TaskContext.get().partitionId() << 32

        def gathered(docs: list[int], parts: list) -> pa.RecordBatch:
            nonlocal turn
            turn += 1
            n_a, n_b, n_links, _, a, b = (np.concatenate([p[k] for p in parts]) if k != 3 else None for k in range(6))
            pair = pc.dictionary_encode(pa.array(a.astype(np.int64) << 32 | b))
            counts = pa.table({"pair": pair.indices}).group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
            known = pair.dictionary.to_numpy()
            row = {
                "block": turn, "doc_id": docs, "n_a": n_a, "n_b": n_b, "n_links": n_links, "groups_sha256": [d for p in parts for d in p[3]],
                "links": pack(pair.indices.to_numpy().astype(np.int32).tobytes()),
                "a": known >> 32, "b": known & 0xFFFFFFFF, "n": counts.column("pair_count").to_numpy(),
            }
            return pa.RecordBatch.from_pydict({name: [value] for name, value in row.items()}, schema=schema)

        def small() -> Iterator[tuple[list, list]]:
            ids, texts, held = [], [], 0
            for batch in slices(batches, 64):
                for doc, text in zip(batch.column("doc_id").to_pylist(), raw(batch, "text")):
                    ids.append(doc)
                    texts.append(text)
                    held += len(text or b"")
                    if held >= JOINED:
                        yield ids, texts
                        ids, texts, held = [], [], 0
            if ids:
                yield ids, texts

        held, docs, parts = 0, [], []
        for ids, texts in small():
            docs += ids
            parts.append(align(texts))
            held += sum(len(t or b"") for t in texts)
            if held >= BLOCK:
                yield gathered(docs, parts)
                held, docs, parts = 0, [], []
        if docs:
            yield gathered(docs, parts)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, BLOCKS)


def pair_counts(found: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` over the whole corpus, and whether that is the highest of its ``b`` (``best``).

    The window holds at most as many rows of a ``b`` as the other vocabulary has ids.
    """
    of_blocks = found.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    merged = of_blocks.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return merged.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _summed():
    """A function that sums over the links of each document, from blocks with the corpus counts of their pairs."""
    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, 1):
            row = {name: batch.column(name)[0] for name in batch.schema.names}
            of = {name: row[name].values.to_numpy(zero_copy_only=False) for name in ("n_a", "n_b", "n_links")}
            links = np.frombuffer(unpack(row["links"].as_py()), np.int32)
            marks = row["marks"].values  # none for a block without links
            at, count, best = (
                (marks.field(k).to_numpy(zero_copy_only=False) if marks is not None else np.zeros(0, np.int64)) for k in range(3)
            )
            count_of, best_of = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            count_of[at], best_of[at] = count, best
            cut = _starts(of["n_links"])
            sums = [np.concatenate([[0], np.cumsum(values[links])])[cut] for values in (best_of, count_of)]
            n_best, count_sum = (np.diff(s) for s in sums)
            yield pa.RecordBatch.from_arrays(
                [
                    row["doc_id"].values, *(pa.array(v, pa.int64()) for v in (of["n_a"], of["n_b"], of["n_links"], of["n_links"], n_best, count_sum)),
                    row["groups_sha256"].values,
                ],
                schema=schema,
            )

    return run


def align(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Token counts, groups and links of every document, with how its links stand in the whole corpus.

    ``first`` is a byte-level vocabulary in JSON form with its rank file beside it, ``second`` a sentencepiece model.
    Null and empty texts, and those that a tokenizer does not give back, have zeros and an empty digest. A common end closes
    one group and is one link, as no token is empty. Repeated rows are rows of their own; other columns are left out; no rows
    give no rows. A block is bounded by ``BLOCK`` bytes and one document; its marks by the pairs it holds.
    """
    import public_tokenizers

    first, second = first or public_tokenizers.path("byte_bpe_50k.json"), second or public_tokenizers.path("piece_bpe_32k.model")
    found = durable(blocks(docs, first, second), "aligned")
    own = found.select("block", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("block", "at", "p.*")
    marks = own.join(pair_counts(found), ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("marks"))
    return found.drop("a", "b", "n").join(marks, "block", "left").mapInArrow(_summed(), RESULT)
