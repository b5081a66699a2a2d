"""Text expressions: cells as text, character classes, header names, hashes."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANK = r"[\s\u00A0\uFEFF]+"
# Texts that count as empty, in any case.
NULLISH = r"(?i)^(null|n/a)$"
# The character classes of a trimmed text; the first that matches holds.
CLASSES = (
    ("RUT", r"^[0-9]{1,8}-[0-9Kk]$"),
    ("EMAIL", r"^[^\s@]+@[^\s@]+\.[^\s@]+$"),
    ("NUMERIC", r"^[0-9]+$"),
    ("ALPHA", r"^[._-]*[A-Za-z][A-Za-z._-]*$"),
    ("ALPHANUM", r"^[A-Za-z0-9._-]+$"),
)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


# What ``_BLANK`` takes.
BLANKS = (" ", "\t", "\n", "\x0b", "\f", "\r", "\u00a0", "\ufeff")


def blank_edged(c: Column) -> Column:
    """Whether ``trimmed`` changes a text."""
    return F.substring(c, 1, 1).isin(*BLANKS) | F.substring(c, -1, 1).isin(*BLANKS)


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end, the no-break space and byte order mark included."""
    return F.regexp_replace(c, rf"^{_BLANK}|{_BLANK}$", "")


def plain_number(c: Column) -> Column:
    """A double as text without an exponent or trailing zeros; '' for NaN and infinities."""
    fixed = F.rtrim(F.rtrim(c.cast("decimal(38,10)").cast("string"), F.lit("0")), F.lit("."))
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit("")).otherwise(fixed)


def cell_text(c: Column, kind: T.DataType) -> Column:
    """A value of any type as a cell's text: '' for null, and for texts that say null or n/a."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = plain_number(c.cast("double"))
    elif isinstance(kind, T.BinaryType):
        text = F.base64(c)
    else:
        text = c.cast("string")
    text = F.coalesce(text, F.lit(""))
    may_say = F.lower(text).contains("null") | F.lower(text).contains("n/a")
    return F.when(may_say & trimmed(text).rlike(NULLISH), F.lit("")).otherwise(text) if isinstance(kind, T.StringType) else text


def char_class(c: Column) -> Column:
    """EMPTY, RUT, EMAIL, NUMERIC, ALPHA, ALPHANUM or PHRASE."""
    t = trimmed(c)
    out = F.when(t == "", F.lit("EMPTY"))
    for name, pattern in CLASSES:
        out = out.when(t.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit("PHRASE"))


def b64_hash(c: Column, length: int) -> Column:
    """The first characters of the URL-safe base64 of the SHA-256."""
    return F.substring(F.translate(F.base64(F.unhex(F.sha2(c, 256))), "+/", "-_"), 1, length)


def header_name(text: str) -> str:
    """A header as an identifier: accents off, blanks to underscores, lower case."""
    flat = "".join(ch for ch in unicodedata.normalize("NFD", text) if not unicodedata.combining(ch))
    flat = re.sub(r"\s+", "_", re.sub(r"\.+$", "", flat.strip()))
    return re.sub(r"^_+|_+$", "", re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9_]", "", flat))).lower()


# Accented Latin letters and their plain forms, for the column expression.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyAAAAAAEEEEIIIIOOOOOUUUUNCY"


def header_name_column(c: Column) -> Column:
    """``header_name`` for a column of headers."""
    flat = F.translate(trimmed(F.coalesce(c, F.lit(""))), ACCENTED, PLAIN)
    flat = F.regexp_replace(F.regexp_replace(flat, r"\.+$", ""), r"\s+", "_")
    flat = F.regexp_replace(F.regexp_replace(flat, r"[^A-Za-z0-9_]", ""), r"_+", "_")
    return F.lower(F.regexp_replace(flat, r"^_+|_+$", ""))


def serial_kind(c: Column) -> Column:
    """Date or Time where a text is a number that a spreadsheet would show as one, else null."""
    x = F.when(c.rlike(r"^[0-9]+(\.[0-9]+)?$"), c.try_cast("double"))
    return F.when((x > 20000) & (x < 80000), F.lit("Date")).when((x >= 0) & (x < 1), F.lit("Time"))
