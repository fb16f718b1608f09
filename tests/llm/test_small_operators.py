"""Brute-force versions and corner cases of the map-only operators."""

import re
import zlib
from collections import Counter

import pytest
import zstandard

from wayfold.llm import compression, language, tiling, toxicity
from wayfold.llm import queries as q

ODD = [
    (1, None, None, None, 0), (2, "", "en", "s", 0), (3, " \n\t", "en", "s", 3), (4, "?!", None, "s", 2), (None, "the end of it all", "en", None, 5),
    (5, "the end of it all", "en", "s", 5), (5, "the end of it all", "en", "s", 5), (6, "wort " * 30_000, "de", "s", 1), (7, "a b c d\x0be", "fr", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, score int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_base_measures_and_bands(spark, odd, none, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = sorted((r.doc_id, *base(r.text)) for r in docs.collect())
    assert sorted(tuple(r[:6]) for r in q.op1_compression_bands(spark, small).collect()) == want
    got = compression.compression_bands(odd).collect()
    assert sorted((r.doc_id or -1, *tuple(r)[1:6]) for r in got) == sorted((r[0] or -1, *base(r[1])) for r in ODD)
    long = next(r for r in got if r.doc_id == 6)
    assert not long.in_band and long.ratio == pytest.approx(150_000 / len(zstandard.ZstdCompressor(3).compress(b"wort " * 30_000)))
    assert all(r.in_band for r in got if r.n_bytes == 0)
    assert compression.compression_bands(none).collect() == []


def test_noise_in_chunks_is_out_of_band(spark):
    import random

    rng = random.Random(1)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(4000))
    noise = "".join(chr(rng.randint(33, 126)) for _ in range(10_000))
    rows = {r.doc_id: r for r in compression.compression_bands(spark.createDataFrame([(1, prose), (2, prose[:9000] + noise), (3, (prose[:40] + " ") * 500)], "doc_id long, text string")).collect()}
    assert rows[1].in_band and not rows[2].in_band and not rows[3].in_band
    assert 4 * rows[2].n_bad_chunks > rows[2].n_chunks


def test_chunks_cover_the_whole_text(spark):
    import random

    assert compression.chunk_spans(4095) == [] and compression.chunk_spans(4096) == [(0, 4096)]
    assert compression.chunk_spans(4159) == [(0, 4159)] and compression.chunk_spans(8192 + 64) == [(0, 4096), (4096, 8192), (8192, 8256)]
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    often = [word() for _ in range(50)]
    prose = " ".join(rng.choice(often) if rng.random() < 0.4 else word() for _ in range(4000))
    noise = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(4095))
    rows = [(1, prose[:4096] + noise), (2, prose[:8191]), (3, prose[:8192] + noise[:3000]), (4, prose[:16384] + noise[:4000]), (5, prose[:11000])]
    got = {r.doc_id: r for r in compression.compression_bands(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: (r.n_chunks, r.n_bad_chunks) for k, r in got.items()} == {1: (2, 1), 2: (2, 0), 3: (3, 1), 4: (5, 1), 5: (3, 0)}
    # One bad chunk of three or five: judged by the bytes it holds, 3000 of 11192 and 4000 of 20384.
    assert got[1].ratio > 1.5 and {k: r.in_band for k, r in got.items()} == {1: False, 2: True, 3: False, 4: True, 5: True}


def test_language_held_out_accuracy_and_corner_cases(spark, odd, none, small):
    sf = small.replace("0.001", "0.01")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = q.op3_language_bitmask(spark, sf).collect()
    assert len(rows) == len(docs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.9
    model = language.learn(odd)
    got = {(r.doc_id, r.lang_pred) for r in language.predict(odd, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (6, "de")} <= got
    assert {r.lang_pred for r in language.predict(odd, language.learn(none)).collect()} == {"und"}
    assert language.predict(none, model).collect() == []
    kept = language.in_known_language(odd, model)
    assert kept.columns == odd.columns and 6 in {r.doc_id for r in kept.collect()} and 3 not in {r.doc_id for r in kept.collect()}


def test_filter_hits_equal_sets_but_for_false_ones(spark):
    texts = [(1, "alpha beta gamma " * 9, "aa"), (2, "delta epsilon zeta " * 9, "bb")]
    model = language.learn(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    total, hits = language.corrected_hits(model, [b"alpha beta", b"delta zeta", b"xyzzy"])
    assert model.langs == ["aa", "bb"] and hits[0].argmax() == 0 and hits[1].argmax() == 1 and hits[2].sum() < 0.5
    assert hits[0][0] == pytest.approx(total[0], abs=1.5)


def test_what_is_known_does_not_grow_with_the_corpus(spark):
    import random

    rng = random.Random(5)

    def words(letters, n):
        return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(n)]

    often, rare, foreign = words("abcdefghi", 300), words("rstuvwxyz", 3000), " ".join(words("jklmnopq", 40))
    rows = [(" ".join(rng.choices(often, k=60)), "aa") for _ in range(800)] + [(foreign, "aa")]
    # Of the small language many n-grams are seen too seldom to be known.
    small = [" ".join(rng.choices(rare, [1 / (k + 1) for k in range(3000)], k=50)) for _ in range(40)]
    rows += [(t, "bb") for t in small[:20]]
    docs = spark.createDataFrame([(0, foreign), (1, " ".join(rng.choices(often, k=30))), *enumerate(small[20:], 2)], "doc_id long, text string")
    known = []
    for times in (1, 8):
        model = language.learn(spark.createDataFrame(rows[:801] * times + rows[801:], "text string, lang string"))
        assert {r.doc_id for r in language.in_known_language(docs, model).collect()} == set(range(1, 22))
        known.append((model.words & 1).sum())
        assert 0.1 < model.least_known[1] < model.least_known[0] <= 0.5
    assert known[0] == known[1]


def tile_brute(item, doc, width):
    """The plain algorithm: scan for the longest unmarked match, mark it, repeat."""
    a, b, covered = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < width:
            return covered
        for k in range(n):
            a[i + k] = b[j + k] = True
        covered += n


def test_tiles_against_the_plain_algorithm():
    import random

    rng = random.Random(7)
    for _ in range(150):
        words = "abc" if rng.random() < 0.5 else "abcdefgh"
        item = [rng.choice(words) for _ in range(rng.randint(5, 25))]
        parts = [item[k : k + rng.randint(3, 9)] for k in (rng.randrange(len(item)) for _ in range(4))]
        doc = sum((p + [rng.choice(words)] for p in parts), [])
        index = tiling.SeedIndex([(1, " ".join(item))], 5)
        got = index.matches(doc)
        covered = tiling.tile(index.items[0][1], got[0][2], got[0][0], got[0][1], 5)[0] if got else 0
        assert covered == tile_brute(item, doc, 5)


def test_runs_of_one_word_and_short_items():
    import time

    index = tiling.SeedIndex([(1, "go " * 1200), (2, "paris is the capital"), (3, "a b " * 300)], 5)
    start = time.perf_counter()
    assert list(tiling.held_items(index, b"go " * 12000, 0.5)) == [(1, 1200, 1200, 1, 1200)]
    assert list(tiling.held_items(index, b"b a " * 4000, 0.5)) == [(3, 600, 600, 1, 600)]
    assert time.perf_counter() - start < 1.0
    assert list(tiling.held_items(index, b"Paris is the capital.", 0.5)) == [(2, 4, 4, 1, 4)]
    assert list(tiling.held_items(index, b"Paris is a capital.", 0.5)) == []


def test_leaks_of_documents_against_the_plain_algorithm(spark):
    import random

    rng = random.Random(8)
    items = [[rng.choice("abcdef") for _ in range(rng.randint(1, 14))] for _ in range(12)]
    docs = [sum(([*rng.choice(items)[rng.randint(0, 4) :], rng.choice("abz")] for _ in range(3)), []) for _ in range(40)]
    frames = [spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(rows)], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    found = {(r.doc_id, r.item_id): r.n_covered for r in tiling.leaks(*frames).collect()}
    want = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            covered = tile_brute(item, doc, min(5, len(item)))
            if len(item) >= tiling.MIN_ITEM and covered >= 0.5 * len(item):
                want[d, i] = covered
    assert found == want and want


def test_leaks_reordered_blocks_and_corner_cases(spark, odd, none):
    item = "one two three four five six seven eight nine ten eleven twelve"
    turned = "X seven EIGHT, nine ten eleven twelve! then one two three four five six"
    docs = spark.createDataFrame([(1, turned), (2, "one two three four five and so on"), (3, None), (4, item), (4, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item, 1), (10, "a b", 2), (11, None, 3), (12, "", 4)], "item_id long, text string, doc_id int")
    for size in (tiling.BLOCK_BYTES, 10):
        got = sorted((r.doc_id, r.item_id, r.coverage, r.n_tiles) for r in tiling.leaks(docs, bench, block_bytes=size).collect())
        assert got == [(1, 9, 1.0, 2), (4, 9, 1.0, 1), (4, 9, 1.0, 1)]
        assert sorted(r.doc_id for r in tiling.without_leaks(docs, bench, block_bytes=size).collect()) == [2, 3]
    assert tiling.leaks(none, bench).collect() == [] and tiling.leaks(odd, bench).collect() == [] and tiling.leaks(odd, bench.limit(0)).collect() == []
    assert tiling.without_leaks(odd, bench.limit(0)).count() == len(ODD)


def test_toxic_clauses(spark, odd, none):
    tag = toxicity.Tagger({"zork": 3.0, "blarg*": 2.5})
    weigh = lambda t: toxicity.clause_features(t.encode(), tag)[0]
    assert weigh("you are an idiot") > weigh("an idiot here") > weigh("he said an idiot here") > 0
    assert weigh("this is not stupid") < weigh("this is stupid")
    assert weigh("i will kill you") > weigh("to kill time") > 0
    assert weigh("zork") > 0 and weigh("blargify") > 0 and weigh("nothing here") == 0 and weigh("") == 0
    assert weigh("He said so. You idiot") == weigh("you idiot")
    model = toxicity.learn(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r.predicted == 0 for r in rows)
    assert toxicity.score(none, model).collect() == []


def test_toxicity_held_out(spark, small):
    sf = small.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in q.op8_toxic_grammar(spark, sf).collect() if r.held_out and r.doc_id in labels]
    bad = [r for r in rows if labels[r.doc_id]]
    assert sum(r.predicted for r in bad) / len(bad) > 0.8
    assert sum(r.predicted for r in rows if not labels[r.doc_id]) / (len(rows) - len(bad)) < 0.05


def test_bands_reject_noise_and_keep_labelled_prose(spark, small):
    import base64
    import random

    import zstandard

    rng, shrink = random.Random(9), zstandard.ZstdCompressor(level=compression.LEVEL).compress
    for size in (256, 400, 512, 1000, 1024, 2000, 2048, 4000, 4096, 9000):
        low = compression.band_of(size)[0]
        noise = [" ".join(base64.b64encode(rng.randbytes(rng.randint(3, 9))).decode().rstrip("=") for _ in range(size // 4))[:size].encode() for _ in range(60)]
        assert sum(size / len(shrink(t)) < low for t in noise) > 0.95 * 60
    sf = small.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id")
    kept = compression.compression_bands(spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id")).groupBy("in_band").count().collect()
    kept = {r["in_band"]: r["count"] for r in kept}
    assert kept[True] > 0.99 * sum(kept.values())


def test_only_letters_make_a_language():
    assert language.has_letter("½ é") and language.has_letter("東") and not any(map(language.has_letter, ("½", "² ①", "Ⅷ 12", "", "_!")))
