"""Dates and times in text: orders of day, month and year, known formats, strict parsing and canonical forms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ProfileConfig
from .text import let

ORDERS = ("DMY", "MDY", "YMD")
_AMPM = r"(?:AM|PM|A\.?M\.?|P\.?M\.?)"
_TIME = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?"
_ORDERED = rf"(?i)^([0-9]{{1,4}}|[A-Z]{{3,}})[/.-]([0-9]{{1,2}}|[A-Z]{{3,}})[/.-]([0-9]{{1,4}})(?:[ T]([0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?(?:\s*{_AMPM}\s*)?))?$"
_NUMERIC = rf"(?i)^([0-9]{{1,4}})[/.-]([0-9]{{1,2}})[/.-]([0-9]{{1,4}})(?:[ T][0-9]{{1,2}}:[0-9]{{2}}(?::[0-9]{{2}})?(?:\s*{_AMPM}\s*)?)?$"
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(?::[0-9]{2})?(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})?$"
_COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})\s*([0-9]{2})([0-9]{2})([0-9]{2})?$"
# Month names by their first three letters.
MONTHS = {"JAN": 1, "FEB": 2, "MAR": 3, "APR": 4, "MAY": 5, "JUN": 6, "JUL": 7, "AUG": 8, "SEP": 9, "OCT": 10, "NOV": 11, "DEC": 12, "ENE": 1, "ABR": 4, "AGO": 8, "DIC": 12}


@dataclass(frozen=True)
class Format:
    key: str
    kind: str
    order: str | None
    pattern: str


# The known formats.
FORMATS = (
    Format("YYYY-MM-DD", "Date", "YMD", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    Format("YYYY/MM/DD", "Date", "YMD", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"),
    Format("YYYY.MM.DD", "Date", "YMD", r"^[0-9]{4}\.[0-9]{1,2}\.[0-9]{1,2}$"),
    Format("YYYYMMDD", "Date", "YMD", r"^[0-9]{8}$"),
    Format("DD/MM/YYYY", "Date", "DMY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    Format("DD-MM-YYYY", "Date", "DMY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
    Format("DD.MM.YYYY", "Date", "DMY", r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"),
    Format("DD/MM/YY", "Date", "DMY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$"),
    Format("DD-MM-YY", "Date", "DMY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$"),
    Format("DD-MMM-YYYY", "Date", "DMY", r"^[0-9]{1,2}-[A-Za-z]{3,}-[0-9]{4}$"),
    Format("DD-MMM-YY", "Date", "DMY", r"^[0-9]{1,2}-[A-Za-z]{3,}-[0-9]{2}$"),
    Format("MM/DD/YYYY", "Date", "MDY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"),
    Format("MM-DD-YYYY", "Date", "MDY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"),
    Format("MM.DD.YYYY", "Date", "MDY", r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$"),
    Format("MM/DD/YY", "Date", "MDY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$"),
    Format("MM-DD-YY", "Date", "MDY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$"),
    Format("HH:mm", "Time", None, r"^[0-9]{1,2}:[0-9]{2}$"),
    Format("HH:mm:ss", "Time", None, r"^[0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("hh:mm AM/PM", "Time", None, r"(?i)^[0-9]{1,2}:[0-9]{2}\s*(?:AM|PM|A\.?M\.?|P\.?M\.?)$"),
    Format("hh:mm:ss AM/PM", "Time", None, r"(?i)^[0-9]{1,2}:[0-9]{2}:[0-9]{2}\s*(?:AM|PM|A\.?M\.?|P\.?M\.?)$"),
    Format("YYYY-MM-DD HH:mm", "DateTime", "YMD", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("YYYY-MM-DD HH:mm:ss", "DateTime", "YMD", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("YYYY/MM/DD HH:mm", "DateTime", "YMD", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("YYYY/MM/DD HH:mm:ss", "DateTime", "YMD", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("YYYYMMDD HHmm", "DateTime", "YMD", r"^[0-9]{8}[ T][0-9]{4}$"),
    Format("YYYYMMDD HHmmss", "DateTime", "YMD", r"^[0-9]{8}[ T][0-9]{6}$"),
    Format("YYYYMMDDHHmm", "DateTime", "YMD", r"^[0-9]{12}$"),
    Format("YYYYMMDDHHmmss", "DateTime", "YMD", r"^[0-9]{14}$"),
    Format("ISO-8601", "DateTime", "YMD", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(?::[0-9]{2})?(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})?$"),
    Format("DD/MM/YYYY HH:mm", "DateTime", "DMY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("DD/MM/YYYY HH:mm:ss", "DateTime", "DMY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("DD-MM-YYYY HH:mm", "DateTime", "DMY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("DD-MM-YYYY HH:mm:ss", "DateTime", "DMY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("DD-MMM-YYYY HH:mm", "DateTime", "DMY", r"^[0-9]{1,2}-[A-Za-z]{3,}-[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("DD-MMM-YYYY HH:mm:ss", "DateTime", "DMY", r"^[0-9]{1,2}-[A-Za-z]{3,}-[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("MM/DD/YYYY HH:mm", "DateTime", "MDY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("MM/DD/YYYY HH:mm:ss", "DateTime", "MDY", r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
    Format("MM-DD-YYYY HH:mm", "DateTime", "MDY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}$"),
    Format("MM-DD-YYYY HH:mm:ss", "DateTime", "MDY", r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}[ T][0-9]{1,2}:[0-9]{2}:[0-9]{2}$"),
)
#: Which format is taken of several that fit: seconds first, then the longer key, then the order above.
RANKED = sorted(range(len(FORMATS)), key=lambda i: (not (":ss" in FORMATS[i].key or "HHmmss" in FORMATS[i].key), -len(FORMATS[i].key), i))


def known_formats(spark: SparkSession) -> DataFrame:
    """(key, kind, order, pattern) of the known formats."""
    return spark.createDataFrame([(f.key, f.kind, f.order, f.pattern) for f in FORMATS], "key string, kind string, order string, pattern string")


def _int(c: Column) -> Column:
    return c.try_cast("int")


_MONTH_MAP = f"map({', '.join(f"'{k}', {v}" for k, v in MONTHS.items())})"


def month_number(c: Column) -> Column:
    return F.try_element_at(F.expr(_MONTH_MAP), F.upper(F.substring(c, 1, 3)))


def full_year(y: Column, config: ProfileConfig = DEFAULT) -> Column:
    return F.when(y.between(0, 99), y + F.when(y >= config.two_digit_pivot, 1900).otherwise(2000)).otherwise(y)


def seconds_of_day(c: Column) -> Column:
    """Of a text like H:mm[:ss][AM/PM]; 24:00 is 0; null if it isn't a time."""
    mark = rf"(?i)\s*({_AMPM})\s*$"

    def total(t: Column) -> Column:
        h = F.when(t["mark"] == "", t["h"]).otherwise(t["h"] % 12 + F.when(t["h"] > 12, 100).otherwise(0) + F.when(t["mark"].startswith("P"), 12).otherwise(0))
        midnight = (h == 24) & (t["m"] == 0) & (t["s"] == 0)
        return F.when(midnight, F.lit(0)).when(h.between(0, 23) & t["m"].between(0, 59) & t["s"].between(0, 59), h * 3600 + t["m"] * 60 + t["s"])

    def parts(core: Column) -> Column:
        h, m, s = (_int(F.regexp_extract(core, f"^{_TIME}$", k)) for k in (1, 2, 3))
        return F.struct(h.alias("h"), m.alias("m"), F.coalesce(s, F.lit(0)).alias("s"), F.upper(F.regexp_extract(c, mark, 1)).alias("mark"))

    return let(let(F.trim(F.regexp_replace(F.trim(c), mark, "")), parts), total)


def parse_ordered(c: Column, order: str, config: ProfileConfig = DEFAULT) -> Column:
    """A timestamp from a date (and time) whose parts come in ``order``; null for anything else, a bad time included."""

    def parts(s: Column) -> Column:
        a, b, y, clock = (F.regexp_extract(s, _ORDERED, k) for k in (1, 2, 3, 4))
        texts = [a, b, y]
        number = lambda k: F.coalesce(month_number(texts[order.index(k)]), _int(texts[order.index(k)]))
        seconds = F.when(clock == "", F.lit(0)).otherwise(seconds_of_day(clock))
        return F.struct(_int(texts[order.index("Y")]).alias("y"), number("M").alias("m"), number("D").alias("d"), seconds.alias("s"))

    def stamp(t: Column) -> Column:
        return let(full_year(t["y"], config), lambda y: F.when(y.between(config.first_year, config.last_year) & t["m"].between(1, 12) & t["d"].between(1, 31), F.try_make_timestamp_ntz(y, t["m"], t["d"], F.floor(t["s"] / 3600).cast("int"), F.floor(t["s"] / 60).cast("int") % 60, (t["s"] % 60).cast("decimal(16,6)"))))

    return F.when(F.trim(c).rlike(_ORDERED), let(let(F.trim(c), parts), stamp))


def orders_that_fit(c: Column, config: ProfileConfig = DEFAULT) -> dict[str, Column]:
    """For each order whether a text may be a date in it."""
    s = F.trim(c)
    name_first, name_second, year_first = s.rlike(r"^[A-Za-z]{3,}[/.-][0-9]{1,2}[/.-][0-9]{1,4}"), s.rlike(r"^[0-9]{1,2}[/.-][A-Za-z]{3,}[/.-][0-9]{1,4}"), s.rlike(r"^[0-9]{1,4}[/.-][A-Za-z]{3,}[/.-][0-9]{1,2}")
    x, y, z = (_int(F.regexp_extract(s, _NUMERIC, k)) for k in (1, 2, 3))
    zero = F.lit(0)

    def valid(year: Column, month: Column, day: Column) -> Column:
        real = lambda t: t["y"].between(config.first_year, config.last_year) & F.try_make_timestamp_ntz(t["y"], t["m"], t["d"], zero, zero, zero.cast("decimal(16,6)")).isNotNull()
        return s.rlike(_NUMERIC) & F.coalesce(let(F.struct(full_year(year, config).alias("y"), month.alias("m"), day.alias("d")), real), F.lit(False))

    return {
        "MDY": F.when(name_first, True).when(name_second | year_first, False).otherwise(valid(z, x, y)),
        "DMY": F.when(name_first, False).when(name_second, True).when(year_first, False).otherwise(valid(z, y, x)),
        "YMD": F.when(name_first | name_second, False).when(year_first, True).otherwise(valid(x, y, z)),
    }


#: Every text that any format, order or parser below takes begins like this.
MAY_BE_DATED = r"^(?:[0-9]{1,4}|[A-Za-z]{3,})[/.-](?:[0-9]{1,2}|[A-Za-z]{3,})[/.-][0-9]{1,4}|^[0-9]{8}(?:[ T]?[0-9]{4,6}|\s*[0-9]{4,6})?$|^[0-9]{1,2}:[0-9]{2}"


def _sql(text: str) -> str:
    """A string literal of SQL."""
    return "r'" + text.replace("'", "\\'") + "'" if "'" not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_date_marks(rows: DataFrame, value: str = "value", config: ProfileConfig = DEFAULT) -> DataFrame:
    """``rows`` and, for each text: mask, the known formats it matches; time_ok; and for each order ordered_, date_ and datetime_, whether
    the parsers of those names take it, and _fits_, whether it counts for that order.

    The text is taken apart once, in steps of SQL, and only if it may be dated at all.
    """
    x, s = f"`{value}`", "_s"
    part = lambda k: f"regexp_extract(_s, {_sql(_ORDERED)}, {k})"
    full = lambda y: f"(CASE WHEN {y} BETWEEN 0 AND 99 THEN {y} + CASE WHEN {y} >= {config.two_digit_pivot} THEN 1900 ELSE 2000 END ELSE {y} END)"
    real = lambda y, m, d: f"({full(y)} BETWEEN {config.first_year} AND {config.last_year} AND {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31 AND try_make_timestamp_ntz({full(y)}, {m}, {d}, 0, 0, CAST(0 AS DECIMAL(16, 6))) IS NOT NULL)"
    mark = rf"(?i)\s*({_AMPM})\s*$"
    rows = rows.withColumn(s, F.expr(f"CASE WHEN trim({x}) RLIKE {_sql(MAY_BE_DATED)} THEN trim({x}) END"))
    rows = rows.withColumns({"_ordered": F.expr(f"coalesce(_s RLIKE {_sql(_ORDERED)}, false)"), "_clock": F.expr(f"coalesce(_s RLIKE '[0-9]{{1,2}}:[0-9]{{2}}', false)")})
    rows = rows.withColumns({f"_p{k}": F.expr(f"CASE WHEN _ordered THEN {part(k)} END") for k in (1, 2, 3)} | {"_t": F.expr(f"CASE WHEN _ordered THEN {part(4)} WHEN NOT _s RLIKE '[/.-]' THEN _s END")})
    rows = rows.withColumns({f"_y{k}": F.expr(f"try_cast(_p{k} AS INT)") for k in (1, 2, 3)} | {"_core": F.expr(f"CASE WHEN _t <> '' THEN trim(regexp_replace(trim(_t), {_sql(mark)}, '')) END"), "_mark": F.expr(f"upper(regexp_extract(_t, {_sql(mark)}, 1))")})
    rows = rows.withColumns({f"_n{k}": F.expr(f"coalesce(try_element_at({_MONTH_MAP}, upper(substring(_p{k}, 1, 3))), _y{k})") for k in (1, 2, 3)} | {f"_c{k}": F.expr(f"try_cast(regexp_extract(_core, {_sql(f'^{_TIME}$')}, {k}) AS INT)") for k in (1, 2, 3)})
    hour = "(CASE WHEN _mark = '' THEN _c1 ELSE _c1 % 12 + CASE WHEN _c1 > 12 THEN 100 ELSE 0 END END)"
    rows = rows.withColumn("_timed", F.expr(f"coalesce(_c2 BETWEEN 0 AND 59 AND coalesce(_c3, 0) BETWEEN 0 AND 59 AND {hour} BETWEEN 0 AND 23 OR (_mark = '' AND _c1 = 24 AND _c2 = 0 AND coalesce(_c3, 0) = 0), false)"))
    compact = [f"try_cast(regexp_extract(_s, {_sql(_COMPACT)}, {k}) AS INT)" for k in range(1, 7)]
    packed = f"(_s RLIKE {_sql(_COMPACT)} AND {compact[0]} BETWEEN {config.first_year} AND {config.last_year} AND try_make_timestamp_ntz({', '.join(compact[:5])}, CAST(coalesce({compact[5]}, 0) AS DECIMAL(16, 6))) IS NOT NULL)"
    iso = f"(_s RLIKE {_sql(_ISO)} AND year(CASE WHEN _s RLIKE '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$' THEN CAST(try_cast(_s AS TIMESTAMP) AS TIMESTAMP_NTZ) ELSE try_cast(_s AS TIMESTAMP_NTZ) END) BETWEEN {config.first_year} AND {config.last_year})"
    first, second, year = (f"_s RLIKE '{r}'" for r in ("^[A-Za-z]{3,}[/.-][0-9]{1,2}[/.-][0-9]{1,4}", "^[0-9]{1,4}[/.-][A-Za-z]{3,}[/.-][0-9]{1,4}", "^[0-9]{1,4}[/.-][A-Za-z]{3,}[/.-][0-9]{1,2}"))
    rows = rows.withColumns({"_fixed": F.expr(f"coalesce({packed}, false) OR coalesce({iso}, false)"), "_named": F.expr(f"CASE WHEN {first} THEN 1 WHEN _s RLIKE '^[0-9]{{1,2}}[/.-][A-Za-z]{{3,}}[/.-][0-9]{{1,4}}' THEN 2 WHEN {year} THEN 3 ELSE 0 END"), "_compact": F.expr("coalesce(_s RLIKE r'^[0-9]{8}\\s*[0-9]{4,6}$', false)")})
    place = {"DMY": (3, 2, 1), "MDY": (3, 1, 2), "YMD": (1, 2, 3)}
    ordered = {o: f"coalesce(_ordered AND (_t = '' OR _timed) AND {real(f'_y{y}', f'_n{m}', f'_n{d}')}, false)" for o, (y, m, d) in place.items()}
    fits = {o: f"coalesce(_ordered AND {real(f'_y{y}', f'_y{m}', f'_y{d}')}, false)" for o, (y, m, d) in place.items()}
    named = {"MDY": "WHEN _named = 1 THEN true WHEN _named > 1 THEN false", "DMY": "WHEN _named IN (1, 3) THEN false WHEN _named = 2 THEN true", "YMD": "WHEN _named IN (1, 2) THEN false WHEN _named = 3 THEN true"}
    rows = rows.withColumns({f"ordered_{o}": F.expr(c) for o, c in ordered.items()} | {f"_fits_{o}": F.expr(f"CASE {named[o]} ELSE {c} END") for o, c in fits.items()})
    bits = " + ".join(f"CASE WHEN _s RLIKE {_sql(f.pattern)} THEN {1 << i}L ELSE 0L END" for i, f in enumerate(FORMATS))
    marks = {"mask": F.expr(f"CASE WHEN _s IS NULL THEN 0L ELSE {bits} END"), "time_ok": F.expr("coalesce(NOT _ordered AND _timed, false)")}
    marks |= {f"date_{o}": F.expr(f"ordered_{o} AND NOT _clock") for o in ORDERS} | {f"datetime_{o}": F.expr(f"(_clock OR _compact) AND (ordered_{o} OR _fixed)") for o in ORDERS}
    rows = rows.withColumns(marks)
    return rows.drop("_s", "_ordered", "_clock", "_t", "_core", "_mark", "_timed", "_fixed", "_named", "_compact", *[f"{a}{k}" for a in ("_p", "_y", "_n", "_c") for k in (1, 2, 3)])


def order_counts() -> list[Column]:
    """Aggregates over the ``_fits_`` columns: seen, and for each order how many fit, and how many fit no other."""
    fit = {k: F.col(f"_fits_{k}") for k in ORDERS}
    only = sum((v.cast("int") for v in fit.values()), F.lit(0)) == 1
    return [F.count("*").alias("seen"), *[F.count_if(fit[k]).alias(f"fit_{k}") for k in ORDERS], *[F.count_if(fit[k] & only).alias(f"dec_{k}") for k in ORDERS]]


def chosen_order(prefer: Column) -> Column:
    """The order, from ``order_counts``: most texts that fit it alone; then most that fit; ``prefer`` among equals."""
    each = F.array(*[F.struct(F.col(f"dec_{k}").alias("dec"), F.col(f"fit_{k}").alias("fit"), F.lit(k).alias("order")) for k in ORDERS])

    def choose(all_: Column) -> Column:
        most = F.array_max(F.transform(all_, lambda x: F.struct(x["dec"], x["fit"])))
        return let(F.filter(all_, lambda x: F.struct(x["dec"], x["fit"]) == most), lambda best: F.when(F.get(best, F.lit(0))["fit"] == 0, F.lit(None)).when(F.size(best) == 1, F.get(best, F.lit(0))["order"]).otherwise(prefer))

    return let(each, choose)


def order_confidence(order: Column) -> Column:
    dec, fit = F.lit(0).cast("long"), F.lit(0).cast("long")
    for k in ORDERS:
        dec, fit = F.when(order == k, F.col(f"dec_{k}")).otherwise(dec), F.when(order == k, F.col(f"fit_{k}")).otherwise(fit)
    return F.when(order.isNull(), F.lit(0.0)).otherwise((dec + 0.5 * (fit - dec)) / F.greatest(F.lit(1), F.col("seen")))


def format_mask(c: Column) -> Column:
    """A bit for each known format that the text matches."""
    s = F.trim(c)
    out = F.lit(0).cast("long")
    for i, f in enumerate(FORMATS):
        out = out.bitwiseOR(F.when(s.rlike(f.pattern), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def chosen_format(mask: Column, order: Column) -> Column:
    """struct(bit, key, kind, order) of the format taken of those in ``mask`` that agree with the inferred ``order``; null if none."""
    text = lambda v: "CAST(NULL AS STRING)" if v is None else f"'{v}'"
    ranked = F.expr(f"array({', '.join(f"named_struct('bit', {1 << i}L, 'key', {text(FORMATS[i].key)}, 'kind', {text(FORMATS[i].kind)}, 'order', {text(FORMATS[i].order)})" for i in RANKED)})")
    agree = {o: sum(1 << i for i, f in enumerate(FORMATS) if f.order in (None, o)) for o in ORDERS}
    allowed = F.lit((1 << len(FORMATS)) - 1).cast("long")
    for o, bits in agree.items():
        allowed = F.when(order == o, F.lit(bits).cast("long")).otherwise(allowed)
    return let(mask.bitwiseAND(allowed), lambda m: F.get(F.filter(ranked, lambda f: m.bitwiseAND(f["bit"]) != 0), F.lit(0)))


def parse_time_strict(c: Column) -> Column:
    """Seconds of the day of a text that is a time only."""
    return F.when(~F.trim(c).rlike("[/.-]"), seconds_of_day(c))


def parse_date_strict(c: Column, order: str) -> Column:
    return F.when(~c.rlike("[0-9]{1,2}:[0-9]{2}"), parse_ordered(c, order))


def parse_datetime_strict(c: Column, order: str, config: ProfileConfig = DEFAULT) -> Column:
    s = F.trim(c)
    part = [_int(F.regexp_extract(s, _COMPACT, k)) for k in range(1, 7)]
    compact = F.when(s.rlike(_COMPACT) & part[0].between(config.first_year, config.last_year), F.try_make_timestamp_ntz(*part[:5], F.coalesce(part[5], F.lit(0)).cast("decimal(16,6)")))
    iso = F.when(s.rlike(_ISO), F.when(s.rlike("(Z|[+-][0-9]{2}:[0-9]{2})$"), s.try_cast("timestamp").cast("timestamp_ntz")).otherwise(s.try_cast("timestamp_ntz")))
    iso = F.when(F.year(iso).between(config.first_year, config.last_year), iso)
    return F.when(s.rlike("[0-9]{1,2}:[0-9]{2}") | s.rlike(r"^[0-9]{8}\s*[0-9]{4,6}$"), F.coalesce(parse_ordered(s, order, config), compact, iso))


def serial_timestamp(n: Column, base_1904: bool = False) -> Column:
    """A spreadsheet's serial number as a timestamp, to the millisecond."""
    base = "1904-01-01" if base_1904 else "1899-12-30"
    return F.timestamp_millis((F.unix_millis(F.lit(f"{base} 00:00:00").cast("timestamp")) + F.round(n * 86_400_000)).cast("long")).cast("timestamp_ntz")


def canonical(c: Column, use: Column, order: Column) -> Column:
    """Text in the canonical form of its use (Date, Time, DateTime); a text that can't be parsed stays."""
    by_order = lambda f: F.when(order == "MDY", f(c, "MDY")).when(order == "YMD", f(c, "YMD")).otherwise(f(c, "DMY"))
    seconds = parse_time_strict(c)
    clock = F.date_format(F.timestamp_seconds(seconds), "HH:mm:ss")
    out = F.when(use == "Date", F.date_format(by_order(parse_date_strict), "yyyy-MM-dd")).when(use == "DateTime", F.date_format(by_order(parse_datetime_strict), "yyyy-MM-dd HH:mm:ss")).when(use == "Time", clock)
    return F.coalesce(out, c)


def parse_flexible(c: Column, order: str | None = None, base_1904: bool = False, config: ProfileConfig = DEFAULT) -> Column:
    """A timestamp from text in any known way; numbers count as serial dates, times since 1970 or parts of a day.

    After a number come ``order`` if one is given, ISO, compact, year first, day first, month first, then a time alone, which is on
    1970-01-01. Anything else is null: there is no engine's own parsing as a last resort.
    """
    from .numbers import plain_double

    s = F.trim(c)
    n = F.when(s.rlike(r"^[\s0-9.,+-]+$"), plain_double(s))
    since = lambda seconds: F.timestamp_seconds(seconds).cast("timestamp_ntz")
    number = let(n, lambda x: F.when((x > 20_000) & (x < 80_000), serial_timestamp(x, base_1904)).when((x > 1e11) & (x < 1e14), since(x / 1000)).when((x > 1e9) & (x < 1e11), since(x)).when((x >= 0) & (x < 1), since(F.round(x * 86_400_000) / 1000)))
    year_first = F.when(s.rlike(r"^[0-9]{4}[/.-]"), parse_ordered(s, "YMD", config))
    whole_year = s.rlike(r"^[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{4}($|[ T])")
    named = s.rlike(r"^[0-9]{1,2}-[A-Za-z]{3,}-[0-9]{2,4}")
    branches = [number, *([parse_ordered(s, order, config)] if order else []), parse_datetime_strict(s, "YMD", config), F.when(s.rlike("^[0-9]{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("timestamp_ntz")), year_first]
    branches += [F.when(whole_year | named, parse_ordered(s, "DMY", config)), F.when(whole_year & ~s.contains("."), parse_ordered(s, "MDY", config)), since(seconds_of_day(s))]
    return F.coalesce(*branches)


def type_family(kind: Column) -> Column:
    """Date, Time or DateTime for an SQL type's name or abbreviation, with or without the mark of a key; else null."""
    k = F.regexp_replace(F.upper(kind), "^K(?=DT|DA|TM|TI)", "")
    return F.when(k.rlike(r"^(DT|DATETIME(\([0-9]+\))?|TIMESTAMP(\([0-9]+\))?)$"), "DateTime").when(k.isin("DA", "DATE"), "Date").when(k.isin("TM", "TIME"), "Time")


# Parts of headers that hint at dates and times, in lower case.
DATE_HINTS = ("date", "fecha", "fech", "fch", "fec")
TIME_HINTS = ("time", "hora", "hr")
DATETIME_HINTS = ("datetime", "timestamp", "fecha hora", "fecha/hora", "time stamp")


def header_hints(header: Column) -> tuple[Column, Column, Column]:
    """Whether a header looks like one of a date, of a time, of both."""
    low = F.lower(F.coalesce(header, F.lit("")))
    return tuple(F.exists(F.array(*[F.lit(x) for x in hints]), lambda x: F.contains(low, x)) for hints in (DATE_HINTS, TIME_HINTS, DATETIME_HINTS))


def format_pattern(key: str) -> str:
    """A known format's key as a pattern for Spark's own date functions."""
    if key == "ISO-8601":
        return "yyyy-MM-dd'T'HH:mm[:ss][.SSS][XXX]"
    return key.replace("YYYY", "yyyy").replace("YY", "yy").replace("DD", "dd").replace(" AM/PM", " a")


def loose_pattern(pattern: Column) -> Column:
    """A pattern that takes days, months and hours of one digit as well."""
    out = F.regexp_replace(F.regexp_replace(pattern, "(?<!d)dd(?!d)", "d"), "(?<!M)MM(?!M)", "M")
    return F.regexp_replace(F.regexp_replace(out, "(?<!H)HH(?!H)", "H"), "(?<!h)hh(?!h)", "h")


def pattern_column(key: Column) -> Column:
    """``format_pattern`` for a column of keys of known formats."""
    return F.try_element_at(F.create_map(*[F.lit(x) for f in FORMATS for x in (f.key, format_pattern(f.key))]), key)
