import random

import pytest

import corpus_pipeline
from test_grouping_operators import base_spans, check_packing, groups_of, print_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double"
ITEM = "which of these seven rivers runs north through the old salt works before it meets the sea"


def corpus():
    rng = random.Random(8)
    sound = {"en": ["the", "ing", "and", "th", "er"], "de": ["sch", "ung", "der", "ein", "ich"]}

    def prose(lang, n):
        return " ".join("".join(rng.choice(sound[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))

    rows = [(k, prose(lang, rng.randint(30, 300)), lang, f"s{k % 5}") for k, lang in enumerate(["en", "de"] * 30)]
    long = prose("en", 2500)
    rows += [
        (100, rows[4][1], "en", "s0"), (101, rows[4][1].upper(), None, None), (102, None, "en", "s1"), (103, "", "de", "s1"), (104, "12 34", "en", "s1"),
        (105, prose("en", 20) + " " + ITEM + " " + prose("en", 20), "en", "s1"), (106, prose("de", 9) + " password = hunter2222 " + prose("de", 9), "de", "s2"),
        (107, prose("en", 40) + " ghp_" + "aB1" * 13, "en", "s3"), (108, long, "en", "s1"), (109, long + " the", "en", "s1"), (110, rows[7][1], "de", "s1"),
        (110, rows[7][1], "de", "s1"), (None, prose("en", 60), "en", "s9"),
    ]
    return rows


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, items):
        spark.createDataFrame([(*r, len(r[1] or ""), "x", 0.5) for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def test_pipeline_against_plain_python(spark, folder):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = corpus()
    sf = folder(rows, [(1, ITEM), (2, None)])
    texts = {r[0]: r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    groups = groups_of({k: print_of(t) for k, t in texts.items() if k is not None}, 2)
    kept = {k: t for k, t in texts.items() if (k is None or groups[k] == k) and ITEM not in t}

    def clean(text):
        out, at = "", 0
        spans = base_spans(text) + ([(text.index("ghp_"), 3, text.index("ghp_") + 43, "github")] if "ghp_" in text else [])
        for start, _, end, kind in sorted(spans):
            out, at = out + text[at:start] + f"[{kind}]", end
        return out + text[at:]

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(kept)
    used, least = check_packing(got, [(k, clean(t)) for k, t in kept.items()], 2048, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert used <= least + 1


def test_stages_keep_the_columns(spark, folder):
    sf = folder(corpus(), [(1, ITEM)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        none = stage(spark, docs.limit(0), sf)
        assert none.columns == docs.columns and none.collect() == []
    assert all(r.n_chars == len(r.text) for r in stage(spark, docs.where("text is not null"), sf).collect())


def test_empty_documents(spark, folder):
    assert corpus_pipeline.run(spark, folder([], [])).collect() == []
