"""Quotation linking: quoted passages point at the messages they come from, and replies follow what they answer."""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfold.llm.batches import raw
from wayfold.session import durable

MARK = re.compile(r"^(?:[ \t]{0,3}>)+ ?")
WROTE = re.compile(r"^.{0,200}\b(?:wrote|writes|schrieb|a écrit|escribió)\s*:\s*$", re.I)
WORD = re.compile(r"\w+")
PARSED = "mid long, thread long, seq long, own string, n_quoted int, quotes array<struct<level: int, unit: string, weight: int>>, units array<string>"


def levels(text: str) -> list[tuple[int, str]]:
    """Each line with its quote level, the number of marks in front, and without them."""
    out = []
    for line in text.split("\n"):
        mark = MARK.match(line)
        out.append((mark.group().count(">"), line[mark.end() :]) if mark else (0, line))
    return out


def unit(text: str) -> tuple[str, int] | None:
    """Hash of a passage in lower-case words, so that spacing, wrapping and punctuation don't count, and its length; None without words."""
    words = " ".join(WORD.findall(text.lower()))
    return (xxhash.xxh3_128_hexdigest(words), len(words)) if words else None


def parse(text: str) -> tuple[str, list[tuple[int, str, int]], int, list[str]]:
    """Own text, quoted units (level, hash, length) and number of quoted passages, and the hashes of own units.

    A passage is a run of lines of one level. It is hashed as a whole and line by line, so a part of a message can be
    quoted; a line that announces a quote goes with it.
    """
    lines = levels(text)
    own, passages = [], []
    for k, (level, line) in enumerate(lines):
        if level:
            if k and lines[k - 1][0] == level:
                passages[-1][1].append(line)
            else:
                passages.append((level, [line]))
        elif not (WROTE.match(line) and k + 1 < len(lines) and lines[k + 1][0]):
            own.append(line)
    mine = "\n".join(own).strip("\n")
    quoted = []
    for level, part in passages:
        found = [unit("\n".join(part))] + ([unit(line) for line in part] if len(part) > 1 else [])
        quoted += [(level, *u) for u in found if u]
    hashes = {u[0] for u in [unit(mine), *map(unit, own)] if u}
    return mine, quoted, len(passages), sorted(hashes)


def link(messages: DataFrame) -> DataFrame:
    """Adds the reply structure to ``mid, thread, seq, text`` (``mid`` unique): ``own, n_quoted, parent, root, depth``.

    The original of a passage is the first message of the thread with these words, else the first of all threads; only
    what stands before the reply by (thread, seq, mid) counts, so there are no circles. A message's parent is the
    original of its least deeply quoted passages, that with most quoted characters, the latest of equals. Without one it
    is the first message of the thread. Messages without thread or place stand alone (parent null, depth 0); a null text
    is empty. ``(root, depth, seq)`` orders a conversation so that replies follow what they answer; it is a sort key, so
    that one endless conversation can be sorted by many tasks.
    """
    parsed = durable(_parsed(messages), "messages")
    placed = parsed.where("thread is not null and seq is not null")
    # Reduced to the first holder before anything is joined: a line that all messages have is one row. What is joined
    # comes from tables, so that a hot line or thread can be split.
    inside = placed.select("thread", F.explode("units").alias("unit"), F.struct("thread", "seq", "mid").alias("at")).groupBy("thread", "unit").agg(F.min("at").alias("near"))
    inside = durable(inside, "originals")
    first = durable(inside.groupBy("unit").agg(F.min("near").alias("far")), "originals")
    quotes = placed.select("mid", "thread", F.struct("thread", "seq", "mid").alias("at"), F.explode("quotes").alias("q")).select("mid", "thread", "at", "q.*")
    met = quotes.join(inside, ["thread", "unit"], "left").join(first, "unit", "left")
    origin = F.when(F.col("near") < F.col("at"), F.col("near")).when(F.col("far") < F.col("at"), F.col("far"))
    votes = met.select("mid", "level", "weight", origin.alias("origin")).where("origin is not null").groupBy("mid", "level", "origin").agg(F.sum("weight").alias("weight"))
    best = votes.groupBy("mid").agg(F.max(F.struct((-F.col("level")).alias("close"), "weight", "origin")).alias("b")).select("mid", F.col("b.origin.mid").alias("quoted"))
    heads = durable(placed.groupBy("thread").agg(F.min(F.struct("seq", "mid")).alias("head")).select("thread", F.col("head.mid").alias("head")), "heads")
    linked = parsed.select("mid", "thread", "seq", "own", "n_quoted").join(best, "mid", "left").join(heads, "thread", "left")
    other = F.when(F.col("seq").isNotNull() & (F.col("head") != F.col("mid")), F.col("head"))
    linked = durable(linked.select("mid", "thread", "seq", "own", "n_quoted", F.coalesce("quoted", other).alias("parent")), "replies")
    return linked.join(_roots(linked.select("mid", "parent")), "mid")


def _parsed(messages: DataFrame) -> DataFrame:
    schema = to_arrow_schema(StructType.fromDDL(PARSED))

    def run(batches):
        for batch in batches:
            found = [parse((t or b"").decode("utf-8")) for t in raw(batch, "text")]
            yield pa.RecordBatch.from_pydict({
                "mid": batch.column("mid"), "thread": batch.column("thread"), "seq": batch.column("seq"), "own": [f[0] for f in found], "n_quoted": [f[2] for f in found],
                "quotes": [[{"level": a, "unit": u, "weight": w} for a, u, w in f[1]] for f in found], "units": [f[3] for f in found],
            }, schema=schema)

    return messages.selectExpr("cast(mid as long) mid", "cast(thread as long) thread", "cast(seq as long) seq", "text").mapInArrow(run, PARSED)


def _roots(parents: DataFrame) -> DataFrame:
    """``mid, root, depth`` by doubling: every round, each message looks past the ancestor that it knows to that one's.

    Messages that have found their root are done and move no more, so a long conversation costs rounds for itself only.
    """
    done = [durable(parents.where("parent is null").select("mid", F.col("mid").alias("root"), F.lit(0).cast("long").alias("depth")), "ancestors")]
    pending = durable(parents.where("parent is not null").select("mid", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps")), "ancestors")
    while not pending.isEmpty():
        known = pending.select(F.col("mid").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.lit(False).alias("end"))
        for part in done:
            known = known.union(part.select("mid", "root", "depth", F.lit(True)))
        moved = durable(pending.join(known, "up").select("mid", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), "end"), "ancestors")
        done.append(moved.where("end").select("mid", F.col("up").alias("root"), F.col("steps").alias("depth")))
        pending = moved.where("not end").drop("end")
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def as_mail(messages: DataFrame) -> DataFrame:
    """Conversations as a mail archive: each of ``mid, thread, seq, text`` quotes the message before it, and at level two the one before that.

    Of several messages at one place the least text is quoted. Message k is quoted by k + 1, so places are joined, not windows sorted.
    """
    places = messages.where("text is not null").groupBy("thread", "seq").agg(F.min("text").alias("said"))
    one = places.select("thread", (F.col("seq") + 1).alias("seq"), F.regexp_replace("said", "(?md)^", "> ").alias("q1"))
    two = places.select("thread", (F.col("seq") + 2).alias("seq"), F.regexp_replace("said", "(?md)^", "> > ").alias("q2"))
    met = messages.join(one, ["thread", "seq"], "left").join(two, ["thread", "seq"], "left")
    return met.select("mid", "thread", "seq", F.concat_ws("\n", F.when(F.col("q1").isNotNull(), "They wrote:"), "q2", "q1", "text").alias("text"))
