"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import alignment, compression, language, mixing, packing, quotes, secrets, simhash, suffixes, tiling, toxicity, warc, whitening
from wayfold.llm.batches import held_out
from wayfold.session import durable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the compression verdict of every document."""
    found = compression.compression_bands(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("in_band")).alias("kept"), "ratio", "n_chunks", "n_bad_chunks",
    )


def op2_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as a mail archive with nested quotes, and from that back to messages without quotes in reply order."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("thread"), F.col("turn").alias("seq"), "role", "text")
    turns = durable(turns.select("*", F.monotonically_increasing_id().alias("mid")), "turns")
    linked = quotes.link(quotes.as_mail(turns.select("mid", "thread", "seq", "text")))
    at = turns.select(F.col("mid").alias("id"), F.col("thread").alias("conv"), F.col("seq").alias("place"))
    met = linked.join(turns.select("mid", "role"), "mid")
    for name in ("parent", "root"):
        met = met.join(at.toDF(name, f"{name}_conv", f"{name}_turn"), name, "left")
    return met.select(
        F.col("thread").alias("conv_id"), F.col("seq").alias("turn"), "role", F.col("own").alias("text"), "n_quoted", "parent_conv", "parent_turn", "root_conv", "root_turn", "depth",
    )


def op3_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(~held_out(F.col("doc_id"))))
    return language.predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives with revisit records, and read back."""
    pages = table(spark, sf_dir, "pages")
    path = warc.archive_folder(spark)
    warc.write_archives(warc.resolve(pages.select(F.col("page_id").alias("record_id"), "url", F.col("html").cast("binary").alias("payload"))), path)
    return warc.with_originals(warc.read_archives(spark, path)).withColumnRenamed("record_id", "page_id")


def op5_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that stand in a 200-byte string found elsewhere too, removed."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op6_simhash_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_copies(table(spark, sf_dir, "documents"), 3, 2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds half of a benchmark item or more."""
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs.where(~held_out(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_owned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with how many of them look live."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["place"] < len(secrets.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"), "n_live", "n_common",
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all usable embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document, learned from the rows whose id's check sum is no multiple of ten."""
    left_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    found = mixing.score(table(spark, sf_dir, "documents"), ~left_out)
    return found.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.try_divide(-F.col("score") / math.log10(2), F.col("n_bytes")).alias("bits_per_byte"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every document."""
    return alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_compression_bands, op2_quotation_links, op3_language_bitmask, op4_warc_revisits, op5_suffix_merge, op6_simhash_balls,
        op7_string_tiling, op8_toxic_grammar, op9_certified_packing, op10_owned_secrets,
        op11_embedding_whitening, op12_context_mixing, op13_tokenizer_alignment,
    )
}
_BASE32 = " || ".join(f"substr('{warc.ALPHABET}', CAST((v >> {shift}) & 31 AS INT) + 1, 1)" for shift in (15, 10, 5, 0))
WARC_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
 d AS (SELECT h, sha1(h) AS x, max(page_id) AS holder FROM p GROUP BY h),
 g AS (SELECT h, holder, i, CAST('0x' || substr(x, CAST(5 * i + 1 AS INT), 5) AS BIGINT) AS v FROM d, range(8) r(i)),
 b AS (SELECT h, holder, string_agg({_BASE32}, '' ORDER BY i) AS digest FROM g GROUP BY h, holder)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, digest AS payload_digest,
 CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> holder THEN holder END AS refers_to FROM p JOIN b ON p.h = b.h"""


def _kind_sql(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return (
        f"SELECT doc_id, o, {place} AS place, '{kind}' AS kind, {least} AS least, unnest(h) AS h, unnest(v) AS v, unnest(g[1:len(h)]) AS g, unnest(range(len(h))) AS i FROM "
        f"(SELECT doc_id, o, regexp_extract_all(t, {p}, 0) AS h, regexp_extract_all(t, {p}, {group}) AS v, regexp_split_to_array(t, {p}) AS g FROM d)"
    )


SECRETS_SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source AS o FROM documents),
 c AS ({" UNION ALL ".join(_kind_sql(k, *kind) for k, kind in enumerate(secrets.BASE + secrets.PROVIDER))}),
 s AS (SELECT *, CAST(sum(length(g) + length(h)) OVER (PARTITION BY doc_id, place ORDER BY i) AS BIGINT) AS fin FROM c),
 f AS (SELECT doc_id, o, place, kind, v, kind || ':' || (fin - length(h)) || ':' || fin AS span, fin - length(h) AS ini FROM s WHERE length(v) >= least),
 n AS (SELECT v, count(DISTINCT o) <= {secrets.MOST_OWNERS} AS live FROM f GROUP BY v),
 a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY ini, place) FILTER (place < {len(secrets.BASE)}) AS base, string_agg(span, ',' ORDER BY ini, place) FILTER (place < {len(secrets.BASE)} OR live) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_common FROM f JOIN n USING (v) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
 coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_common, 0) AS n_common FROM d LEFT JOIN a USING (doc_id)"""

#: The others need compression, XXH64, byte-pair ids, learned tables or repeated search; tests hold them against plain Python.
SQL: dict[str, str] = {"op4_warc_revisits": WARC_SQL, "op10_owned_secrets": SECRETS_SQL}
