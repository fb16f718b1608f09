"""Seeded draws as column expressions.

Every draw is a pure function of (key, seed, salt), so a job gives the same rows however the input
is partitioned, when a task is retried, and in any engine that has md5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_hex(keys: str | Sequence[str], seed: int, salt: str) -> Column:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)), F.lit(salt)))


def uniform(keys: str | Sequence[str], seed: int, salt: str) -> Column:
    """Uniform on [0, 1) from the first 32 bits of the hash."""
    return F.conv(F.substring(hash_hex(keys, seed, salt), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


#: Steps after which a walk back into 0..n-1 is given up. Fewer places than its square lie outside, so only for n above that
#: square could a walk be longer, and then with a chance of less than one in WALK to the power WALK.
WALK = 64


def permuted(place: Column, n: Column, keys: str | Sequence[str], seed: int, salt: str) -> Column:
    """Where a place of 0..n-1 goes in the permutation that belongs to ``keys``; different keys permute differently.

    A Feistel network on a grid of about sqrt(n) x sqrt(n) places: each half is moved by a hash of the other, four times in
    turn. The few places of the grid beyond n walk on until they are inside, so nothing is ranked or sorted.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)

    def let(fn, **values: Column) -> Column:
        return F.transform(F.array(F.struct(*[v.cast("long").alias(k) for k, v in values.items()])), fn)[0]

    def moved(half: Column, other: Column, turn: int, size: Column) -> Column:
        text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], other.cast("string"), F.lit(str(seed)), F.lit(f"{salt}{turn}"))
        return (half + F.floor(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * size)) % size

    def within(size: Column) -> Column:
        def once(x: Column) -> Column:
            return let(
                lambda s: let(
                    lambda t: let(
                        lambda u: let(lambda v: v["left"] * size["b"] + moved(u["right"], v["left"], 4, size["b"]), left=moved(t["left"], u["right"], 3, size["a"])),
                        right=moved(s["right"], t["left"], 2, size["b"]),
                    ),
                    left=moved(s["left"], s["right"], 1, size["a"]),
                ),
                left=F.floor(x / size["b"]), right=x % size["b"],
            )

        def walked(first: Column) -> Column:
            steps = F.sequence(F.lit(2), F.lit(WALK))
            return F.aggregate(steps, first, lambda x, _: F.when(x < size["n"], x).otherwise(once(x)).cast("long"))

        # Almost every place is inside at once.
        return let(lambda f: F.when(f["x"] < size["n"], f["x"]).otherwise(walked(f["x"])), x=once(size["at"]))

    root = F.ceil(F.sqrt(n.cast("double")))
    return let(within, a=root, b=F.ceil(n / root), n=n, at=place)


def with_permuted(df: DataFrame, out: str, place: Column, n: Column, keys: str | Sequence[str], seed: int, salt: str) -> DataFrame:
    """``permuted`` as a column ``out``, one half after the other, so that all but the few walks run as generated code."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    df = df.withColumns({"_p": place.cast("long"), "_m": n.cast("long")}).withColumn("_a", F.ceil(F.sqrt(F.col("_m").cast("double"))))
    df = df.withColumn("_d", F.ceil(F.col("_m") / F.col("_a"))).withColumns({"_h0": F.floor(F.col("_p") / F.col("_d")), "_h1": F.col("_p") % F.col("_d")})
    for turn, size in enumerate(("_a", "_d", "_a", "_d"), 1):
        step = F.floor(uniform([*keys, f"_h{turn}"], seed, f"{salt}{turn}") * F.col(size)).cast("long")
        df = df.withColumn(f"_h{turn + 1}", (F.col(f"_h{turn - 1}") + step) % F.col(size))
    at = F.col("_h4") * F.col("_d") + F.col("_h5")
    df = df.withColumn("_x", at.cast("long"))
    inside = F.when(F.col("_x") < F.col("_m"), F.col("_x")).otherwise(permuted(F.col("_p"), F.col("_m"), keys, seed, salt))
    return df.withColumn(out, inside).drop("_p", "_m", "_a", "_d", "_x", *[f"_h{k}" for k in range(6)])


def _weight_total(weights: Sequence[float]) -> float:
    total = 0.0
    for w in weights:
        total += w
    return total


def weighted(u: Column, values: Sequence, weights: Sequence[float]) -> Column:
    """One of ``values`` with relative ``weights``; they need not sum to one."""
    total, reached, pick = _weight_total(weights), 0.0, None
    for value, weight in list(zip(values, weights))[:-1]:
        reached += weight
        test = u * F.lit(total) < F.lit(reached)
        pick = F.when(test, F.lit(value)) if pick is None else pick.when(test, F.lit(value))
    return F.lit(values[-1]) if pick is None else pick.otherwise(F.lit(values[-1]))


def int_between(u: Column, low, high) -> Column:
    """A whole number in [low, high], both ends included; the bounds may be columns."""
    low, high = (b if isinstance(b, Column) else F.lit(b) for b in (low, high))
    return F.floor(low + u * (high - low + 1)).cast("long")


def bernoulli(u: Column, p) -> Column:
    """True with probability ``p``; NULL where ``p`` is NULL."""
    return u < (p if isinstance(p, Column) else F.lit(p))


def beta_int(keys, seed: int, salt: str, a: int, b: int, low: int, high: int) -> Column:
    """A Beta(a, b) draw stretched to [low, high] and rounded half to even.

    For whole a and b, the a-th smallest of a+b-1 uniforms has exactly that distribution.
    """
    ordered = F.sort_array(F.array(*[uniform(keys, seed, f"{salt}{i}") for i in range(a + b - 1)]))
    return F.bround(ordered[a - 1] * F.lit(float(high - low)) + F.lit(float(low)), 0).cast("long")


def date_between(u: Column, start: str, end: str) -> Column:
    """A date from ``start`` through ``end``."""
    first = F.to_date(F.lit(start))
    days = F.datediff(F.to_date(F.lit(end)), first)
    return F.date_add(first, F.floor(u * (days + 1)).cast("int"))


def choice(u: Column, options: Column) -> Column:
    """One element of an array column."""
    return F.element_at(options, (F.floor(u * F.size(options)) + 1).cast("int"))
