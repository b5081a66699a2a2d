"""Names: unique headers, short keys, signatures, file names. Input is as small as a table's header."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from base64 import urlsafe_b64encode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import META_TYPE_ABBREVIATION
from ..functions.text import header_name, header_name_column

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def unique_headers(headers: list[str]) -> list[str]:
    """Raw headers as column names: blanks by position, repeats numbered from 2."""
    seen: dict[str, int] = {}
    out = []
    for i, h in enumerate(headers, 1):
        name = str(h or "").strip() or f"col_{i}"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}#{seen[name]}")
    return out


def column_letters(i: int) -> str:
    """0: A, 25: Z, 26: AA."""
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def lettered_headers(headers: list[str]) -> list[str]:
    return [f"{str(h or '').strip() or f'col_{i + 1}'}::{column_letters(i)}" for i, h in enumerate(headers)]


def normalized_headers(headers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(*by, ord, header, normalized) from (*by, ord, header), where ``by`` names a table: as identifiers, with ``#n`` where several are alike, in order of the columns'
    letters (``::AB``), those without letters last in order of appearance."""
    base = header_name_column(F.regexp_replace("header", "::[A-Za-z]+$", ""))
    base = F.when(base == "", F.concat(F.lit("col_"), (F.col("ord") + 1).cast("string"))).otherwise(base)
    rows = headers.withColumn("base", base)
    by = by or []
    same = Window.partitionBy(*by, "base")
    letters = F.regexp_extract("header", "::([A-Za-z]+)$", 1)
    at = F.aggregate(F.split(letters, ""), F.lit(0).cast("long"), lambda n, ch: F.when(ch == "", n).otherwise(n * 26 + F.ascii(ch) - 64))
    n = F.row_number().over(same.orderBy(letters == "", at, "ord"))
    return rows.select(*by, "ord", "header", F.when(F.count("*").over(same) > 1, F.concat_ws("#", "base", n.cast("string"))).otherwise(F.col("base")).alias("normalized"))


def numbered_headers(headers: list[str]) -> dict[str, str]:
    """``normalized_headers`` for the headers of a document."""
    place: dict[str, tuple[float, int]] = {}
    alike: dict[str, list[str]] = {}
    for i, h in enumerate(headers):
        name, _, letters = h.rpartition("::") if re.search("::[A-Za-z]+$", h) else (h, "", "")
        place[h] = (sum(26**k * (ord(ch) - 64) for k, ch in enumerate(reversed(letters))) or math.inf, i)
        alike.setdefault(header_name(name) or "col_x", []).append(h)
    return {h: base if len(own) == 1 else f"{base}#{n}" for base, own in alike.items() for n, h in enumerate(sorted(own, key=place.get), 1)}


def strip_suffix(names: DataFrame) -> DataFrame:
    """(ord, name, stripped): without a ``_$xx`` suffix, unless that name is taken by another column."""
    base = F.regexp_replace("name", r"_\$[A-Za-z]{1,3}$", "")
    rows = names.withColumn("base", base)
    taken = F.row_number().over(Window.partitionBy("base").orderBy(F.col("name") != F.col("base"), "ord"))
    return rows.select("ord", "name", F.when(taken == 1, F.col("base")).otherwise(F.col("name")).alias("stripped"))


def short_key(name: str, letters_only: bool = True) -> str:
    """Six characters: an even share from each word, a second round through all words if that is too few, x to fill up."""
    accepted = _LETTERS if letters_only else _LETTERS + "0123456789"
    words = [w for w in re.split(r"[^a-z0-9]+", header_name(name)) if w]
    words = [w for w in re.split(r"_+", "_".join(words)) if w]
    if not words:
        return "xxxxxx"
    share, more = divmod(6, len(words))
    out = "".join("".join(ch for ch in w if ch in accepted)[: share + (i < more)] for i, w in enumerate(words))
    out += "".join(ch for w in words for ch in w if ch in accepted)
    return out[:6].ljust(6, "x")


def short_key_column(name: Column, digits: bool = False) -> Column:
    """``short_key`` for a column of names, of letters or of letters and digits."""
    words = F.filter(F.split(header_name_column(name), "_+"), lambda w: w != "")
    letters = words if digits else F.transform(words, lambda w: F.regexp_replace(w, "[^a-z]", ""))
    k = F.size(words)
    share = F.transform(letters, lambda w, i: F.substring(w, F.lit(1), F.floor(F.lit(6) / F.greatest(k, F.lit(1))).cast("int") + F.when(i < F.lit(6) % F.greatest(k, F.lit(1)), 1).otherwise(0)))
    return F.rpad(F.substring(F.concat(F.array_join(share, ""), F.array_join(letters, "")), 1, 6), 6, "x")


def short_keys(names: list[str], registry: dict[str, str] | None = None) -> dict[str, str]:
    """A different key for each name of one document, by the rules of ``registry.unique_short_keys``. ``registry`` (alias: key) says
    which keys are given away, and which aliases have one."""
    normal = numbered_headers(names)
    held = dict(registry or {})
    used, out = set(held.values()), {}
    parts = {n: (normal[n].split("#")[0], int((normal[n].split("#") + ["1"])[1])) for n in names}
    for name in names:
        alias = parts[name][0]
        if alias not in held:
            held[alias] = next(k for k in _options(alias, name) if k not in used)
            used.add(held[alias])
    for name in names:
        (alias, nth), main = parts[name], held[parts[name][0]]
        if nth > 1:
            d = str(nth)
            main = next(k for k in [main[: 6 - len(d)] + d, *[main[: 5 - len(d)] + ch + d for ch in _LETTERS]] if k not in used)
            used.add(main)
        out[name] = main
    return out


def _options(alias: str, header: str):
    """What an alias tries, best first: see ``registry.key_options``."""
    hashed = lambda text, n: re.sub("[^a-z0-9]", "", urlsafe_b64encode(hashlib.sha256(text.encode()).digest()).decode()[:n].lower())
    yield short_key(alias)
    last = short_key(alias, False)
    yield last
    h = hashed(header, 8)
    for i in range(len(h) - 5):
        last = h[i : i + 6]
        yield last
    for ch in _LETTERS:
        yield last[:5] + ch
    for k in itertools.count(len(_LETTERS) + 2 + max(0, len(h) - 5)):
        yield hashed(f"{header}#{k}", 20)[:6].ljust(6, "x")


def type_token(kind: str | None, table: dict[str, str] = META_TYPE_ABBREVIATION) -> str:
    if kind and (m := re.fullmatch(r"VARCHAR\((\d+)\)", kind)):
        return f"VC{m[1]}"
    return table.get(kind or "", "UN")


def signature(columns: list[tuple[str, str | None]], keys: list[str], short: bool = False) -> str:
    """``n>token-token``: key columns first; equal tokens numbered. ``short`` uses abbreviated types only."""
    ordered = [c for k in keys for c in columns if c[0] == k] + [c for c in columns if c[0] not in keys]
    tokens = []
    for name, kind in ordered:
        body = type_token(kind) if short else f"{header_name(name)}${kind or 'Unknown'}"
        tokens.append(f"{'PK$' if name in keys else ''}{body}")
    seen: dict[str, int] = {}
    for i, t in enumerate(tokens):
        seen[t] = seen.get(t, 0) + 1
        tokens[i] = t if seen[t] == 1 else f"{t}#{seen[t]}"
    return f"{len(tokens)}>{'-'.join(tokens)}"


def parsed_file_name(name: Column) -> tuple[Column, Column]:
    """(code, segments) of names like X-CODE#..@+key=value@+key=value.xlsx: segments is a map."""
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    code = F.regexp_extract(stem, r"^[^-]*-([^#@]*)", 1)
    parts = F.regexp_extract_all(stem, F.lit(r"@\+([^=@]+=[^@]*)"), F.lit(1))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("key"), F.regexp_replace(p, "^[^=]*=", "").alias("value")))
    return code, F.map_from_entries(pairs)
