"""Name and address clean-up, recoding, message fields."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"


@lru_cache(1)
def decomposed() -> tuple[str, str, dict[str, str]]:
    """All characters whose compatibility decomposition has one ASCII character, these characters, and the rest with several.

    Characters without an ASCII part are in neither: they are dropped.
    """
    one, many = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode("ascii") if not 0xD800 <= code < 0xE000 else ""
        if len(plain) == 1 and code < 0x10000:
            one[chr(code)] = plain
        elif plain:
            many[chr(code)] = plain
    return "".join(one), "".join(one.values()), many


def strip_accents(col, mode: str = "decompose") -> Column:
    """ASCII form of a text: ``decompose`` keeps base letters of every script's accented Latin letters
    (José -> Jose, Dvořák -> Dvorak), ``drop`` removes such letters altogether (José -> Jos).

    Ligatures, fractions and other characters with several ASCII letters are looked up one by one, in
    texts that have any.
    """
    col = F.col(col) if isinstance(col, str) else col
    if mode == "decompose":
        letters, plain, many = decomposed()
        table = F.map_from_arrays(F.split(F.lit("\x01".join(many)), "\x01"), F.split(F.lit("\x01".join(many.values())), "\x01"))
        spelled = F.array_join(F.transform(F.split(col, ""), lambda c: F.coalesce(F.element_at(table, c), c)), "")
        few = F.translate(col, "".join(many), "\x00" * len(many)) != col
        col = F.translate(F.when(few, spelled).otherwise(col), letters, plain)
    elif mode != "drop":
        raise ValueError(f"unknown mode {mode!r}")
    return F.regexp_replace(col, NON_ASCII, "")


def ascii_any_script(col) -> Column:
    """The same by the Python library, letter for letter, for checks.

    The batch function is local so that it travels to the executors by value.
    """
    def fold(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    return F.pandas_udf(fold, "string")(col)


def email(first, last, domain: str) -> Column:
    return F.concat(F.concat_ws(".", F.lower(first), F.lower(last)), F.lit("@" + domain))


def recode(col, mapping: Mapping[str, str]) -> Column:
    """Replace listed values and keep all others."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(lookup(col, mapping), col)


def lookup(col, mapping: Mapping) -> Column:
    """Value of a fixed dictionary; NULL for a key it does not hold."""
    col = F.col(col) if isinstance(col, str) else col
    pick = None
    for key, value in mapping.items():
        pick = F.when(col == key, F.lit(value)) if pick is None else pick.when(col == key, F.lit(value))
    return pick


def money(col, decimals: int = 2, unit: str = "€") -> Column:
    """Thousands separators and fixed decimals, as the dashboard prints amounts."""
    return F.concat(F.format_number(col, decimals), F.lit(unit))
