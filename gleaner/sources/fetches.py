"""Fetched bodies as text: charsets, sizes and content types, by built-in functions.

``fetches(url, status, content_type, body)`` with bodies as bytes is what a crawler
stores. A body becomes text if the answer was good: it is cut where a reader
stops that takes it in chunks, and decoded by the charset that its content type
names. What can't be decoded becomes U+FFFD, as a lenient decoder has it.
"""

from __future__ import annotations

import codecs
import encodings
import importlib
import pkgutil
from encodings.aliases import aliases
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.functions.dialect import SPARK

#: A reader stops once it has more than so many bytes, and keeps the chunk that took it beyond.
MAX_BYTES, CHUNK_BYTES = 3_000_000, 65_536
#: The name that a content type gives to its charset.
CHARSET = r"(?i);\s*charset\s*=\s*[\"']?([^\s;\"']+)"


def _spelling(name: str) -> str:
    return name.lower().replace("-", "_").replace(" ", "_")


@lru_cache(1)
def charsets() -> dict[str, tuple[str, ...]]:
    """Spellings of the codecs that are known, with ``_`` for ``-``, by the module of the standard library that holds each."""
    out: dict[str, set[str]] = {m.name: {m.name} for m in pkgutil.iter_modules(encodings.__path__) if m.name != "aliases"}
    for alias, module in aliases.items():
        out[module].add(_spelling(alias))
    for module in list(out):
        try:
            out[module].add(_spelling(codecs.lookup(module).name))
        except LookupError:  # of other operating systems
            del out[module]
    return {k: tuple(sorted(v)) for k, v in sorted(out.items())}


@lru_cache(1)
def _single_bytes() -> dict[str, str]:
    """The 256 characters of each codec that has one to a byte, U+FFFD where it has none."""
    tables = [m for m in charsets() if m in ("ascii", "latin_1") or hasattr(importlib.import_module(f"encodings.{m}"), "decoding_table")]
    return {m: "".join(bytes([b]).decode(m, "replace") for b in range(256)) for m in tables}


def charset(content_type: Column) -> Column:
    """The charset that a content type names, in the spelling of ``charsets``; empty where it names none."""
    return F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(content_type, F.lit("")), CHARSET, 1), "[- ]", "_"))


def decoded(body: Column, name: Column) -> Column:
    """Text of a body in UTF-8 or in a charset with one character to a byte; null in any other known charset. Unknown ones count as UTF-8."""
    plain = F.decode(body, "ISO-8859-1")
    utf8 = F.make_valid_utf8(body.cast("string"))
    out = F.when(name.isin("", *charsets()["utf_8"]), utf8)  # most of all bodies
    several = []
    for codec, spellings in charsets().items():
        if codec in _single_bytes():
            changed = [(chr(b), c) for b, c in enumerate(_single_bytes()[codec]) if chr(b) != c]
            text = F.translate(plain, "".join(a for a, _ in changed), "".join(c for _, c in changed)) if changed else plain
            out = out.when(name.isin(*spellings), text)
        elif codec != "utf_8":
            several += spellings
    return out.when(name.isin(*several), F.lit(None)).otherwise(utf8)


def cut(body: Column, max_bytes: int = MAX_BYTES, chunk_bytes: int = CHUNK_BYTES) -> Column:
    """What a reader keeps of a body that comes in chunks of a size."""
    return F.substring(body, 1, (max_bytes // chunk_bytes + 1) * chunk_bytes)


def decode_fetches(fetches: DataFrame, max_bytes: int = MAX_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``fetches`` with ``html`` in place of ``body``; other columns stay.

    Only answers from 200 to 399 have text; for others, and for a null body, it is
    empty. Charsets of several bytes a character other than UTF-8 are decoded in
    Python, in a pass of their own over the rows that name one; if a narrow scan of
    the content types finds none there is no such pass.
    """
    rows = fetches.withColumn("_charset", charset(F.col("content_type")))
    good = F.coalesce(F.col("status").between(200, 399), F.lit(False)) & F.col("body").isNotNull()
    kept = cut(F.col("body"), max_bytes, chunk_bytes)
    columns = [c for c in fetches.columns if c != "body"]
    several = [s for codec, spellings in charsets().items() if codec != "utf_8" and codec not in _single_bytes() for s in spellings]
    other = F.col("_charset").isin(*several)
    out = rows.where(~other).select(*columns, F.when(good, decoded(kept, F.col("_charset"))).otherwise("").alias("html"))
    if rows.select("_charset").where(other).isEmpty():
        return out

    @F.pandas_udf("string")
    def slow(bodies: pd.Series, names: pd.Series) -> pd.Series:
        def one(b, name: str) -> str:
            try:
                return "" if b is None else bytes(b).decode(name, "replace")
            except (LookupError, UnicodeError):
                return ""  # a codec that isn't one of text, or one that can't go on after a fault

        return pd.Series([one(b, n) for b, n in zip(bodies, names, strict=True)])

    return out.unionByName(rows.where(other).select(*columns, slow(F.when(good, kept), F.col("_charset")).alias("html")))


def final_or_own(final_url: str = "final_url", url: str = "url") -> str:
    """Where a fetch ended, or what it asked for."""
    return f"coalesce(nullif({SPARK.strip(f'coalesce({final_url}, {chr(39) * 2})')}, ''), {url})"
