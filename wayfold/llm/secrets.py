"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found in every text; the hash of a candidate's value is counted over distinct repositories and owners.
A value that many owners have is an example that was copied; one that stays with its owner looks live. Base kinds are
always reported; provider kinds only where they look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.session import durable

# Patterns of the base kinds, in the order in which they are listed; which group holds the value; least length of it.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # maximal runs: a shorter run can neither match nor hide a longer one
)
#: Formats that providers publish for their keys; added where they look live.
PROVIDER = (
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 24),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 39),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 26),
)
#: A value that more owners or repositories than this have is an example.
MOST_OWNERS = 2
_SPAN = "struct<start: bigint, place: int, end: bigint, kind: string, value: string>"


def _spans(hits: str, values: str, gaps: str, place: int, kind: str, least: int) -> Column:
    """Spans in code points from what matched and what lay between: both lists are walked once, in step."""
    return F.expr(f"""
        case when size({hits}) = 0 then cast(array() as array<{_SPAN}>) else
        aggregate(
            zip_with(zip_with({hits}, {values}, (h, v) -> named_struct('h', h, 'v', v)), slice({gaps}, 1, size({hits})), (x, g) -> named_struct('h', x.h, 'v', x.v, 'g', g)),
            named_struct('at', 0L, 'out', cast(array() as array<{_SPAN}>)),
            (s, x) -> named_struct(
                'at', s.at + length(x.g) + length(x.h),
                'out', case when length(x.v) >= {least} then
                    array_append(s.out, named_struct('start', s.at + length(x.g), 'place', {place}, 'end', s.at + length(x.g) + length(x.h), 'kind', '{kind}', 'value', x.v))
                    else s.out end),
            s -> s.out) end""")


def candidates(docs: DataFrame, kinds=BASE + PROVIDER) -> DataFrame:
    """Adds ``spans``, an array of all candidates of all kinds by start and kind, to rows with a ``text`` column. Null texts have none."""
    df = docs.withColumn("__text", F.coalesce("text", F.lit("")))
    for k, (kind, pattern, _, _) in enumerate(kinds):
        df = df.withColumn(f"__h{k}", F.regexp_extract_all("__text", F.lit(pattern), F.lit(0)))
    for k, (kind, pattern, group, least) in enumerate(kinds):
        some = F.size(f"__h{k}") > 0
        df = df.withColumn(f"__g{k}", F.when(some, F.split("__text", pattern, -1)))
        df = df.withColumn(f"__v{k}", F.when(some, F.regexp_extract_all("__text", F.lit(pattern), F.lit(group))) if group else F.col(f"__h{k}"))
    for k, (kind, _, _, least) in enumerate(kinds):
        df = df.withColumn(f"__s{k}", _spans(f"__h{k}", f"__v{k}", f"__g{k}", k, kind, least))
    # Structs compare by their fields in order: start, then place in the list of kinds.
    df = df.withColumn("spans", F.array_sort(F.concat(*[F.col(f"__s{k}") for k in range(len(kinds))])))
    return df.drop("__text", *[f"__{x}{k}" for x in "hgvs" for k in range(len(kinds))])


def ownership(found: DataFrame) -> DataFrame:
    """``value_hash, n_owners, n_repos`` over all rows of ``value_hash, owner, repo``.

    Counted in two steps, distinct (value, owner, repo) first and combined inside tasks, so a value that a third of all
    documents hold is a few rows per task.
    """
    once = found.select("value_hash", "owner", "repo").distinct()
    return once.groupBy("value_hash").agg(F.countDistinct("owner").alias("n_owners"), F.countDistinct("repo").alias("n_repos"))


def _judged(found: DataFrame, most_owners: int) -> DataFrame:
    """``row_id, n_live, n_common, spans`` of the rows of ``found`` that have candidates."""
    each = found.where(F.size("spans") > 0).select("row_id", "owner", "repo", F.explode("spans").alias("s"))
    each = each.select("row_id", "owner", "repo", "s", F.sha2("s.value", 256).alias("value_hash"))
    live = (F.col("n_owners") <= most_owners) & (F.col("n_repos") <= most_owners)
    # From a table, so that a value that very many documents hold can be split where it meets its count.
    counted = durable(ownership(each), "secret-owners")
    return each.join(counted, "value_hash").groupBy("row_id").agg(
        F.count(F.when(live, 1)).alias("n_live"), F.count(F.when(~live, 1)).alias("n_common"),
        F.array_sort(F.collect_list(F.when((F.col("s.place") < len(BASE)) | live, F.col("s")))).alias("spans"),
    )


def scan(docs: DataFrame, owner: str = "source", repo: str = "source", most_owners: int = MOST_OWNERS) -> DataFrame:
    """One row per row of ``docs``: ``row_id, doc_id, spans`` (base ones, and provider ones that look live), ``n_live, n_common``.

    Needs ``doc_id``, ``text`` and the owner and repository columns; a null owner or repository counts as none. The
    texts are read once; what follows carries spans and hashes only. An empty table gives no rows.
    """
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(owner).alias("o"), F.col(repo).alias("r"))
    marked = candidates(lean).select("doc_id", F.col("o").cast("string").alias("owner"), F.col("r").cast("string").alias("repo"), "spans", F.monotonically_increasing_id().alias("row_id"))
    found = durable(marked, "secret-candidates")
    out = found.select("row_id", "doc_id").join(_judged(found, most_owners), "row_id", "left")
    return out.select(
        "row_id", "doc_id", F.coalesce("spans", F.expr(f"cast(array() as array<{_SPAN}>)")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_common", F.lit(0)).alias("n_common"),
    )


def redact(docs: DataFrame, owner: str = "source", repo: str = "source", most_owners: int = MOST_OWNERS) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[kind]``; all columns stay, and ``n_chars``, if there, follows.

    Base kinds are replaced row by row. Only rows with a provider's key meet the corpus-wide counts, by row number.
    """
    inside = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text", F.col(owner).cast("string").alias("owner"), F.col(repo).cast("string").alias("repo"))
    found = durable(candidates(inside).drop("text").select("*", F.monotonically_increasing_id().alias("row_id")), "secret-rows")
    some = F.exists("spans", lambda s: s["place"] >= len(BASE))
    kept = found.where(some).drop("spans").join(_judged(found.select("row_id", "owner", "repo", "spans"), most_owners).select("row_id", "spans"), "row_id")
    both = found.where(~some).select("__row", "spans").union(kept.select("__row", "spans"))
    out = both.select(*[F.col(f"__row.`{c}`") for c in docs.columns if c != "text"], redacted(F.col("__row.text"), F.col("spans")).alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def as_text(spans: Column) -> Column:
    """``kind:start:end`` by start and kind, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[kind]``; overlapping spans are replaced once, by the first one's kind."""
    start = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(
            F.when(
                x["start"] >= s["at"],
                F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit("["), x["kind"], F.lit("]")),
            ).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(start["out"], F.substring(text, (start["at"] + 1).cast("int"), F.lit(2**31 - 1))))
