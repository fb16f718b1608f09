"""Compression bands: Zstandard ratios of whole documents and of fixed chunks.

Text that compresses far better than prose of its length repeats itself; text that hardly compresses is noise. What
is usual depends on the length, so limits are given by length. A document fails when its whole ratio is outside its
band, or when chunks outside the band of their length hold more than ``bad_share`` of its bytes. Chunks cover the whole
text: what is left behind the last full one is judged by its own length.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from wayfold.llm.batches import map_batches, raw

LEVEL = 3
CHUNK_BYTES = 4096
BAD_SHARE = 0.25
#: (bytes from, lowest ratio, highest ratio): original bytes by compressed bytes. Lowest ratios stand between those of random
#: base64 words, which reach 1.12, 1.21, 1.29, 1.33 and 1.35 from 256 to 4096 bytes, and those of labelled good prose, which begin
#: at 1.24, 1.42, 1.61, 1.79 and 1.95; highest ones four to six deviations above the mean of that prose. Below the first length nothing is said.
BANDS = (
    (64, 0.70, 1.70),
    (128, 0.98, 2.02),
    (192, 1.08, 2.02),
    (256, 1.17, 2.05),
    (384, 1.27, 2.10),
    (512, 1.33, 2.15),
    (1024, 1.40, 2.25),
    (2048, 1.43, 2.35),
    (4096, 1.52, 2.45),
    (8192, 1.55, 2.55),
    (16384, 1.55, 2.70),
    (32768, 1.55, 2.85),
    (65536, 1.55, 3.00),
    (262144, 1.55, 3.20),
)
SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, n_chunks long, n_bad_chunks long, in_band boolean"
)


def base_measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated three-word windows."""
    words = text.split()  # for bytes: exactly the six ASCII spaces
    n = len(words)
    spaces = len(text) - sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        reach = 0
        for at, window in enumerate(windows):
            if often[window] > 1:
                repeated += at + 3 - max(reach, at)
                reach = at + 3
    return n, len(text.decode("utf-8")) - spaces, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def band_of(n_bytes: int, bands=BANDS) -> tuple[float, float] | None:
    """Lowest and highest ratio for a length; None where the text is too short to tell."""
    found = None
    for least, low, high in bands:
        if n_bytes >= least:
            found = low, high
    return found


def chunk_spans(n_bytes: int, chunk_bytes: int = CHUNK_BYTES, bands=BANDS) -> list[tuple[int, int]]:
    """Where the chunks of a text begin and end; none below one full chunk. A rest too short for a band is part of the last chunk."""
    rest = n_bytes % chunk_bytes
    edges = [*range(0, n_bytes - rest + 1, chunk_bytes)]
    if len(edges) > 1 and rest:
        edges[len(edges) if band_of(rest, bands) else -1 :] = [n_bytes]
    return list(zip(edges, edges[1:]))


def compression_bands(docs: DataFrame, level: int = LEVEL, chunk_bytes: int = CHUNK_BYTES, bands=BANDS, bad_share: float = BAD_SHARE) -> DataFrame:
    """One row per document with its base measures, whole ratio, chunk counts and verdict ``in_band``.

    Needs ``doc_id`` and ``text``; other columns are not looked at. Null and empty texts have no words, no ratio
    (null) and are in band; repeated rows are judged one by one. Map only: nothing is shuffled, and memory holds one
    batch of documents.
    """

    def make():
        shrink = zstandard.ZstdCompressor(level=level).compress

        def judge(text: bytes):
            size = len(text)
            band = band_of(size, bands)
            if band is None:
                return size, None if not size else size / len(shrink(text)), 0, 0, True
            ratio = size / len(shrink(text))
            chunks = bad = bad_bytes = 0
            for start, end in chunk_spans(size, chunk_bytes, bands):
                low, high = band_of(end - start, bands) or (0.0, float("inf"))
                chunks += 1
                if not low <= (end - start) / len(shrink(text[start:end])) <= high:
                    bad += 1
                    bad_bytes += end - start
            return size, ratio, chunks, bad, band[0] <= ratio <= band[1] and bad_bytes <= bad_share * size

        def step(batch: pa.RecordBatch) -> dict:
            texts = [t or b"" for t in raw(batch, "text")]
            base = list(zip(*map(base_measures, texts)))
            more = list(zip(*map(judge, texts)))
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            return dict(zip(names, [batch.column("doc_id"), *base, *more]))

        return step

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), make, SCHEMA)
