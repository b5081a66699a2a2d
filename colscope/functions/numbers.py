"""Numbers in text: separators are inferred for a column, then its values are normalized."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ProfileConfig

# What a sample may consist of besides digits and separators.
NUMBER_CHARACTERS = r"^[0-9.,()\s $€£¥%+-]+$"


def sanitized(c: Column) -> Column:
    """Digits, separators, parentheses and minus signs only."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[^0-9.,()-]", "")


def is_negative(s: Column) -> Column:
    """Whether a sanitized text is in parentheses or starts with a minus sign."""
    return s.rlike(r"^\(.*\)$") | s.startswith("-")


def unsigned(s: Column) -> Column:
    """A sanitized text without its sign."""
    return F.regexp_replace(s, r"[()-]", "")


def _count(s: Column, symbol: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(symbol), F.lit("")))


def _tail(s: Column, symbol: str) -> Column:
    """How many digits follow the last ``symbol``."""
    return F.length(F.regexp_extract(F.substring_index(s, symbol, -1), r"^([0-9]*)", 1))


def number_like(cells: DataFrame) -> DataFrame:
    """The cells that look like numbers."""
    return cells.where(F.col("value").rlike("[0-9]") & ~F.col("value").rlike("[A-Za-z]") & F.col("value").rlike(NUMBER_CHARACTERS))


def number_samples(cells: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """The first cells (col_name, value; in order of ord) of each column that look like numbers."""
    first = Window.partitionBy("col_name").orderBy("ord")
    return number_like(cells).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= config.number_samples).drop("_n")


def number_plans(samples: DataFrame) -> DataFrame:
    """(col_name, mode, decimal, thousands, reason): how the numbers of each column are written.

    thousands holds the symbols that group digits; a sample counts n_values times where there is such a column. A column without any sample with a separator has ``thousands_only``.
    """
    s = unsigned(sanitized(F.col("value")))
    weight = F.col("n_values") if "n_values" in samples.columns else F.lit(1).cast("long")
    rows = samples.select("col_name", s.alias("s"), weight.alias("w"))
    dots, commas = _count(F.col("s"), "."), _count(F.col("s"), ",")
    rows = rows.select("col_name", "w", dots.alias("d"), commas.alias("c"), _tail(F.col("s"), ".").alias("dt"), _tail(F.col("s"), ",").alias("ct"), (F.instr(F.reverse("s"), ".") < F.instr(F.reverse("s"), ",")).alias("dot_last"))
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("w"))), F.lit(0))
    d, c = F.col("d") > 0, F.col("c") > 0
    stats = rows.groupBy("col_name").agg(
        n(d | c).alias("any"), n(d).alias("dot"), n(c).alias("com"), n(F.col("d") > 1).alias("dot2"), n(F.col("c") > 1).alias("com2"),
        n(d & (F.col("dt") != 3)).alias("dot_not3"), n(c & (F.col("ct") != 3)).alias("com_not3"),
        n(d & c & F.col("dot_last")).alias("dot_wins"), n(d & c & ~F.col("dot_last")).alias("com_wins"),
    )
    x = F.col
    won = x("dot_wins") != x("com_wins")
    multi = (x("dot2") > 0) | (x("com2") > 0)
    only_dot, only_com = (x("dot2") > 0) & (x("com2") == 0), (x("com2") > 0) & (x("dot2") == 0)
    other = F.when(only_dot & (x("com") > 0) & (x("com_not3") > 0), ",").when(only_com & (x("dot") > 0) & (x("dot_not3") > 0), ".")
    dot3, com3 = (x("dot") > 0) & (x("dot_not3") == 0), (x("com") > 0) & (x("com_not3") == 0)
    fallback = F.when(x("dot_not3") > x("com_not3"), ".").when(x("com_not3") > x("dot_not3"), ",").when(x("dot") > x("com"), ".").otherwise(",")
    decimal = F.when(x("any") == 0, F.lit(None)).when(won, F.when(x("dot_wins") > x("com_wins"), ".").otherwise(",")).when(multi, other).when(dot3 | com3, F.lit(None)).otherwise(fallback)
    reason = F.when(x("any") == 0, "no_sep_in_samples").when(won, "both_separators_last_wins").when(multi, F.when(other.isNotNull(), "thousands_plus_decimal").otherwise("rule1_multi_sep")).when(dot3 | com3, "rule2_const_3").otherwise("fallback_decimal")
    both = F.lit(".,")
    rest = F.when(decimal == ".", ",").when(decimal == ",", ".").otherwise(both)
    thousands = F.when(x("any") == 0, both).when(won, rest).when(multi, F.when(only_dot, ".").when(only_com, ",").otherwise(both)).when(dot3 | com3, F.concat(F.when(dot3, ".").otherwise(""), F.when(com3, ",").otherwise(""))).otherwise(rest)
    return stats.select("col_name", F.when(decimal.isNull(), "thousands_only").otherwise("decimal_present").alias("mode"), decimal.cast("string").alias("decimal"), thousands.alias("thousands"), reason.alias("reason"))


def with_numbers(rows: DataFrame, value: str = "value") -> DataFrame:
    """``rows`` (with mode, decimal, thousands: a column's plan) and norm_dec, norm_int: the text as plain digits with a point, and
    with the fraction cut off; null where it isn't a number.

    A last group of digits that is cut short is filled up, if its separator occurs twice or more. Texts of digits alone are their own
    number by any plan and aren't taken apart.
    """
    count = lambda s, symbol: f"(length({s}) - length(replace({s}, '{symbol}', '')))"
    tail = lambda s, symbol: f"length(regexp_extract(substring_index({s}, '{symbol}', -1), '^([0-9]*)', 1))"
    padded = lambda s, symbol: f"CASE WHEN contains(thousands, '{symbol}') AND {count(s, symbol)} >= 2 AND {tail(s, symbol)} BETWEEN 1 AND 2 THEN rpad({s}, length({s}) + 3 - {tail(s, symbol)}, '0') ELSE {s} END"
    digits = lambda s: f"regexp_replace({s}, '[.,]', '')"
    finished = lambda n: f"CASE WHEN {n} RLIKE '^[0-9]+([.][0-9]+)?$' THEN CASE WHEN _negative AND {n} NOT IN ('0', '0.0') THEN concat('-', {n}) ELSE {n} END END"
    rows = rows.withColumn("_plain", F.coalesce(F.col(f"`{value}`").rlike("^[0-9]+$"), F.lit(False)))
    rows = rows.withColumn("_kept", F.when(~F.col("_plain"), sanitized(F.col(f"`{value}`"))))
    rows = rows.withColumns({"_negative": is_negative(F.col("_kept")), "_u": unsigned(F.col("_kept"))})
    rows = rows.withColumns({"_both": F.expr("contains(_u, '.') AND contains(_u, ',')"), "_full": F.expr(padded("_u", "."))})
    rows = rows.withColumns({"_full": F.expr(padded("_full", ",")), "_point": F.expr("CASE WHEN mode = 'decimal_present' THEN decimal WHEN instr(reverse(_u), '.') < instr(reverse(_u), ',') THEN '.' ELSE ',' END")})
    rows = rows.withColumn("_tail", F.expr("CASE WHEN contains(_u, _point) THEN substring_index(_u, _point, -1) END"))
    rows = rows.withColumn("_head", F.expr(digits("CASE WHEN _tail IS NULL THEN _u ELSE substring(_u, 1, length(_u) - length(_tail) - 1) END")))
    split = f"concat(CASE WHEN _head = '' THEN '0' ELSE _head END, CASE WHEN {digits('_tail')} <> '' THEN concat('.', {digits('_tail')}) ELSE '' END)"
    rows = rows.withColumn("_number", F.expr(f"CASE WHEN mode = 'thousands_only' AND NOT _both THEN {digits('_full')} ELSE {split} END"))
    rows = rows.withColumn("_whole", F.expr("regexp_replace(_number, '[.].*$', '')"))
    own = lambda n: F.when(F.col("_plain"), F.col(f"`{value}`")).otherwise(F.expr(finished(n)))
    out = rows.withColumns({"norm_dec": own("_number"), "norm_int": own("_whole")})
    return out.drop("_plain", "_kept", "_negative", "_u", "_both", "_full", "_point", "_tail", "_head", "_number", "_whole")


def single_numbers(values: DataFrame) -> DataFrame:
    """(value, norm_dec, norm_int, reason) of the different texts of ``value``, each by the plan that it alone gives."""
    own = values.select("value").distinct().withColumn("col_name", F.col("value"))
    planned = own.join(number_plans(number_like(own)), "col_name", "left").withColumns({"mode": F.coalesce("mode", F.lit("thousands_only")), "thousands": F.coalesce("thousands", F.lit(".,")), "reason": F.coalesce("reason", F.lit("no_sep_in_samples"))})
    return with_numbers(planned).select("value", "norm_dec", "norm_int", "reason")


def plain_double(c: Column) -> Column:
    """A text as a double where a comma may be the decimal sign: with both signs points group, with a comma alone it is the decimal sign."""
    s = F.trim(c)
    both = s.contains(".") & s.contains(",")
    text = F.when(both, F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(s.contains(","), F.replace(s, F.lit(","), F.lit("."))).otherwise(F.regexp_replace(s, r"([0-9])\s+(?=[0-9])", "$1"))
    return text.try_cast("double")
