"""Groups of a column's distinct values by length and character class, and what each group is used for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BOOLEAN_PAIRS, DATETIME_USES, DEFAULT, NUMERIC_USES, ProfileConfig
from ..functions.dates import MAY_BE_DATED, ORDERS, chosen_format, chosen_order, order_confidence, order_counts, parse_date_strict, parse_datetime_strict, parse_time_strict, with_date_marks
from ..functions.numbers import number_like, number_plans, with_numbers
from ..functions.text import char_class
from ..storage import Stored

GROUP = ("col_name", "length", "class")


#: What ``with_date_marks`` adds.
MARKS = ("mask", "time_ok", *[f"{k}_{o}" for k in ("ordered", "date", "datetime", "_fits") for o in ORDERS])


def _orders(marked: DataFrame, config: ProfileConfig) -> DataFrame:
    may = marked.where(F.col("value").rlike("[/.-]|[A-Za-z]{3}") & F.col("value").rlike("[0-9]"))
    counted = may.groupBy("col_name").agg(*order_counts()).withColumn("date_order", chosen_order(F.lit(config.prefer_order)))
    return counted.select("col_name", "date_order", order_confidence(F.col("date_order")).alias("confidence"))


def date_orders(vc: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(col_name, date_order, confidence): of all texts with a separator or a month's name."""
    return _orders(with_date_marks(vc, config=config), config)


def plans_of(vc: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """The number plan of each column, from all its distinct values that look like numbers."""
    return number_plans(number_like(vc.select("col_name", "value", *[c for c in vc.columns if c == "n_values"])))


#: Texts up to this length share a kind; their digits are a long.
KIND_LENGTH = 18


def kinds(vc: DataFrame) -> DataFrame:
    """(ord, col_name, value, n_values, n_rows, repeated, low, high): ``vc`` with the values that differ in the digits 1 to 9 only as one
    row, whose ``value`` has a 9 for each of these digits; low and high are the least and largest number that their digits make.

    What groups and plans ask of a text is whether its characters are digits and whether those are zeros, so ``value`` answers for all
    its kind. Others keep a row each, without low and high: texts that may be dates or times (eight digits alone never parse as a
    date), numbers with an exponent, those of one character, and long ones."""
    v = F.col("value")
    dated = F.trim(v).rlike(MAY_BE_DATED) & ~F.trim(v).rlike("^[0-9]{8}$")
    shared = F.length(v).between(2, KIND_LENGTH) & ~dated & ~(v.rlike("[eE]") & v.rlike("^[0-9.eE+-]+$"))
    rows = vc.select("ord", "col_name", "n_rows", "value", shared.alias("shared"))
    digits = F.when(v.rlike("^[0-9]+$"), v).otherwise(F.regexp_replace(v, "[^0-9]+", "")).try_cast("long")
    rows = rows.select("ord", "col_name", "n_rows", F.when(F.col("shared"), F.translate(v, "12345678", "99999999")).otherwise(v).alias("value"), F.when(F.col("shared"), digits).alias("x"))
    repeated = F.bool_or(F.col("n_rows") > 1)
    return rows.groupBy("ord", "col_name", "value").agg(F.count("*").alias("n_values"), F.sum("n_rows").alias("n_rows"), repeated.alias("repeated"), F.min("x").alias("low"), F.max("x").alias("high"))


def _of_kind(number: str) -> Column:
    """The text of the kind ``value`` whose digits make ``number``; ``value`` itself where that is null."""
    before = lambda end: f"length(regexp_replace({end}, '[^0-9]', ''))"
    digits = f"lpad(CAST({number} AS STRING), {before('value')}, '0')"
    one = f"CASE WHEN substring(value, i, 1) RLIKE '[0-9]' THEN substring({digits}, {before('substring(value, 1, i)')}, 1) ELSE substring(value, i, 1) END"
    return F.expr(f"CASE WHEN {number} IS NULL THEN value ELSE array_join(transform(sequence(1, length(value)), i -> {one}), '') END")


def marked_kinds(vc: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """``marked_values`` of the kinds of ``vc``: all that ``profile_groups`` and ``group_ranges`` need. norm_dec and norm_int are
    those of a kind's ``value``."""
    return _marked(kinds(vc), config, "n_values", "repeated", "low", "high", "decimal", "thousands")


def marked_values(vc: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """``vc`` with length, class, norm_dec, norm_int, date_order and the marks of dates. A column has one plan and one order, so both
    tables are as small as the header.

    Plans, orders and several later steps read these rows, so both the marks of dates and the result are written: values are counted
    once and taken apart once."""
    return _marked(vc, config)


def _marked(vc: DataFrame, config: ProfileConfig, *more: str) -> DataFrame:
    stored = Stored(with_date_marks(vc, config=config).withColumns({"length": F.length("value").cast("long"), "class": char_class(F.col("value"))}), "groups-dated")
    dated = stored.df
    plans = F.broadcast(plans_of(dated, config))
    orders = F.broadcast(_orders(dated, config))
    rows = dated.join(plans, "col_name", "left").join(orders, "col_name", "left")
    rows = with_numbers(rows.withColumns({"mode": F.coalesce("mode", F.lit("thousands_only")), "thousands": F.coalesce("thousands", F.lit(".,"))}))
    out = Stored(rows.select("ord", "col_name", "value", "n_rows", "mode", "date_order", *MARKS, "length", "class", "norm_dec", "norm_int", *more), "groups-marked")
    stored.drop()
    return out.df


def length_groups(vc: DataFrame) -> DataFrame:
    """(col_name, length, class, n_values, numeric_only, from_sign): the groups, by value counts alone."""
    v = F.col("value")
    rows = vc.select("col_name", F.length(v).cast("long").alias("length"), char_class(v).alias("class"), v)
    numeric = F.bool_and(F.col("value").rlike("^-?[0-9]+$"))
    return rows.groupBy(*GROUP).agg(F.count("*").alias("n_values"), numeric.alias("numeric_only"), (numeric & F.bool_or(F.col("value").startswith("-"))).alias("from_sign"))


def _fraction(d: Column) -> Column:
    return d.contains(".") & ~d.rlike(r"\.0+$")


def group_flags(marked: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """A row for each group with all that the choice of its use needs, from ``marked_values`` or ``marked_kinds``."""
    if "n_values" not in marked.columns:
        marked = marked.withColumns({"n_values": F.lit(1).cast("long"), "repeated": F.col("n_rows") > 1})
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n_values"))), F.lit(0))
    v, dec, whole = F.col("value"), F.col("norm_dec"), F.col("norm_int")
    words = sorted({w for pair in BOOLEAN_PAIRS for w in pair})
    low = F.lower("value")
    letters = v.rlike("[A-Za-z]")
    full = v != ""
    no_fraction = dec.isNotNull() & ~_fraction(dec)
    fits = [f"{k}_{o}" for k in ("date", "datetime") for o in ORDERS]
    aggregates = [
        F.sum("n_values").alias("n_values"), F.sum("n_rows").alias("n_rows"), F.first("ord").alias("ord"), F.first("date_order").alias("column_order"),
        F.bool_and(v.rlike("^-?[0-9]+$")).alias("numeric_only"), F.bool_or(v.startswith("-")).alias("some_sign"),
        F.bool_and(F.coalesce(v.try_cast("double") == 0, F.lit(False)) & v.rlike("^[0-9.eE+-]+$")).alias("zeros"),
        F.bool_and(low.isin(*words)).alias("boolean_words"), F.sort_array(F.collect_set(F.when(low.isin(*words), low))).alias("words"),
        F.bool_and(v.rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$")).alias("emails"),
        F.bool_and(v.rlike(r"^[A-Za-z0-9_.-]+$")).alias("code"), F.bool_and(v.rlike(r"^[A-Za-z._-]+$")).alias("all_letters"), F.bool_and(v.rlike("^[0-9]+$")).alias("all_digits"),
        F.bool_or(letters).alias("some_letter"), F.bool_or(v.rlike("[0-9]")).alias("some_digit"),
        count(full).alias("full"), count(full & dec.isNotNull()).alias("decimals"), F.bool_or(F.coalesce(full & _fraction(dec), F.lit(False))).alias("fraction"),
        count(full & (no_fraction | whole.isNotNull())).alias("integers"),
        F.bool_or(full & (F.coalesce(no_fraction & (dec.try_cast("double") < 0), F.lit(False)) | F.coalesce(whole.try_cast("double") < 0, F.lit(False)))).alias("negative"),
        F.bool_or("repeated").alias("repeated"),
        F.bit_and("mask").alias("mask"), *[F.bool_and(k).alias(k) for k in ("time_ok", *fits)],
        F.sum("n_values").alias("seen"), *order_counts()[1:],
    ]
    return marked.groupBy(*GROUP).agg(*aggregates)


def with_use(flags: DataFrame, config: ProfileConfig = DEFAULT, live: bool = False) -> DataFrame:
    """Flags of groups with first_use, the first use that fits, and unit. ``live`` leaves StandardText out.

    A group is dates or times if one known format fits all its values and each parses in it.
    """
    x = F.col
    rows = flags.withColumn("_order", chosen_order(F.coalesce("column_order", F.lit(config.prefer_order))))
    rows = rows.withColumn("_format", chosen_format(x("mask"), x("_order")))
    used = F.coalesce(x("_format.order"), x("column_order"), F.lit(config.prefer_order))
    parsed = {"Date": "date", "DateTime": "datetime"}
    ok = F.when(x("_format.kind") == "Time", x("time_ok"))
    for kind, name in parsed.items():
        for o in ORDERS:
            ok = ok.when((x("_format.kind") == kind) & (used == o), x(f"{name}_{o}"))
    rows = rows.withColumn("_kind", F.when(ok, x("_format.kind")))
    pairs = {"|".join(sorted(p)) for p in BOOLEAN_PAIRS if p != ("x", "")} | {"x", "|x"}
    diverse = x("n_values") >= F.when(x("length") > 1, 2).otherwise(3)
    alnum = x("code") & x("some_letter") & x("some_digit")
    mostly = lambda n: (x("full") > 0) & (x(n) / x("full") >= config.mostly)
    code = F.when(x("all_digits"), "NumericCode").when(x("all_letters"), "TextCode").when(alnum, "AlphaNumericCode").otherwise("FreeText")
    use = (
        F.when(x("length") == 0, "Empty").when(x("zeros"), "ZerosOnly").when(x("_kind").isNotNull(), x("_kind"))
        .when(x("boolean_words") & F.array_join("words", "|").isin(*sorted(pairs)), "Boolean").when(x("emails"), "Email")
        .when(mostly("decimals") & x("fraction"), "DecimalValue").when(x("negative"), "IntegerValue").when(x("code") & diverse, code)
        .when(x("all_letters"), "TextCode").when(alnum, "AlphaNumericCode").when(~x("some_letter") & mostly("integers"), "NumericCode")
        .when(x("repeated") & F.lit(not live), "StandardText").otherwise("FreeText")
    )
    return rows.withColumn("first_use", use).withColumn("unit", x("n_values") == 1).drop("_order", "_format", "_kind")


def homogeneity(groups: DataFrame) -> DataFrame:
    """(col_name, entropy, homogeneity) from groups (col_name, length, n_values): how the distinct values spread over lengths."""
    lengths = groups.groupBy("col_name", "length").agg(F.sum("n_values").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("col_name"))
    out = lengths.withColumn("p", p).groupBy("col_name").agg(F.count("*").alias("k"), (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"), F.min("length").alias("least"))
    k = F.col("k")
    penalty = F.when(F.col("least") == 1, 0.4).when(F.col("least") == 2, 0.2).when(F.col("least") == 3, 0.1).otherwise(0.0)
    rate = F.when(k < 2, 0.0).otherwise(F.col("entropy") / F.log2(k) * (k - 1) / 9 + penalty)
    return out.select("col_name", "entropy", rate.alias("homogeneity"))


def numeric_evidence(marked: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(col_name, letters, numeric_share, date_share, row_fraction) over rows: what decides on forcing numbers."""
    full = marked.where(F.col("value") != "")
    is_date = F.lit(False)
    for o in ORDERS:
        is_date = F.when(F.col("date_order") == o, F.col(f"ordered_{o}")).otherwise(is_date)
    n = F.sum("n_rows")
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n_rows"))), F.lit(0))
    return full.groupBy("col_name").agg(
        rows(F.col("value").rlike("[A-Za-z]")).alias("letters"), (rows(F.col("norm_dec").isNotNull() | F.col("norm_int").isNotNull()) / n).alias("numeric_share"),
        (rows(is_date) / n).alias("date_share"), F.bool_or(F.coalesce(_fraction(F.col("norm_dec")), F.lit(False))).alias("row_fraction"),
    )


def profile_groups(vc: DataFrame, config: ProfileConfig = DEFAULT, live: bool = False, marked: DataFrame | None = None) -> DataFrame:
    """(ord, col_name, length, class, n_values, n_rows, unit, numeric_only, from_sign, use, first_use): the groups and their uses.

    ``unit`` groups have one value. Their use becomes a code if all larger groups of the column are codes. Numeric groups of a
    column whose rows are numbers throughout become decimal or integer values. first_use is the use before those steps.
    ``marked`` is ``marked_values`` or ``marked_kinds`` of ``vc``, where there is one already.
    """
    marked = marked_kinds(vc, config) if marked is None else marked
    groups = Stored(with_use(group_flags(marked, config), config, live), "groups-flags").df
    column = Window.partitionBy("col_name")
    real = ~F.col("first_use").isin("Empty", "ZerosOnly")
    large = real & ~F.col("unit")
    all_code = F.coalesce(F.bool_and(F.when(large, F.col("first_use").endswith("Code"))).over(column), F.lit(False))
    forced_code = F.when(F.col("class") == "ALPHANUM", "AlphaNumericCode").when(F.col("class") == "NUMERIC", "NumericCode").otherwise("TextCode")
    groups = groups.withColumn("use", F.when(all_code & real & F.col("unit"), forced_code).otherwise(F.col("first_use")))
    valid = groups.where(~F.col("unit") & ~F.col("use").isin("Empty", "ZerosOnly"))
    proof = numeric_evidence(marked, config).join(homogeneity(valid), "col_name", "left")
    groups = groups.join(F.broadcast(proof), "col_name", "left").withColumn("dated", F.bool_or(~F.col("unit") & F.col("use").isin(*DATETIME_USES)).over(column))
    force = ~F.col("dated") & (F.col("letters") == 0) & (F.col("homogeneity") > config.force_homogeneity) & (F.col("numeric_share") >= config.force_numeric_share) & (F.col("date_share") <= config.force_date_share)
    looks = ~F.col("unit") & ~F.col("use").isin("Empty", "ZerosOnly") & (F.col("use").isin(*NUMERIC_USES) | F.col("numeric_only"))
    use = F.when(F.coalesce(force, F.lit(False)) & looks, F.when(F.col("row_fraction"), "DecimalValue").otherwise("IntegerValue")).otherwise(F.col("use"))
    return groups.select("ord", "col_name", "length", "class", "n_values", "n_rows", "unit", "numeric_only", (F.col("numeric_only") & F.col("some_sign")).alias("from_sign"), use.alias("use"), "first_use")


def group_ranges(marked: DataFrame, groups: DataFrame) -> DataFrame:
    """(col_name, length, class, use, min_number, max_number, min_time, max_time) of numeric and date groups with several values.

    Of a kind only its ends are read: its texts have their digits in the same places, so numbers follow them."""
    wanted = groups.where(~F.col("unit") & F.col("use").isin(*NUMERIC_USES, *DATETIME_USES)).select(*GROUP, "use")
    # Groups are as few as a header has lengths and classes; a group may hold most of all values, so rows stay where they are.
    rows = marked.join(F.broadcast(wanted), list(GROUP))
    if "low" in marked.columns:
        ends = F.array_distinct(F.array(_of_kind("low"), _of_kind("high")))
        rows = with_numbers(rows.select(*GROUP, "use", "date_order", "mode", "decimal", "thousands", F.explode(ends).alias("value")))
    number = F.when(F.col("use") == "DecimalValue", F.col("norm_dec")).when(F.col("use").isin(*NUMERIC_USES), F.coalesce("norm_int", F.when(~F.col("norm_dec").contains("."), F.col("norm_dec")))).try_cast("decimal(38,10)")
    order = F.coalesce("date_order", F.lit("DMY"))
    time = F.lit(None).cast("timestamp_ntz")
    for o in ORDERS:
        time = F.when((order == o) & (F.col("use") == "Date"), parse_date_strict(F.col("value"), o)).when((order == o) & (F.col("use") == "DateTime"), parse_datetime_strict(F.col("value"), o)).otherwise(time)
    time = F.when(F.col("use") == "Time", F.timestamp_seconds(parse_time_strict(F.col("value"))).cast("timestamp_ntz")).otherwise(time)
    rows = rows.withColumns({"x": number, "t": time})
    return rows.groupBy(*GROUP, "use").agg(F.min("x").alias("min_number"), F.max("x").alias("max_number"), F.min("t").alias("min_time"), F.max("t").alias("max_time"))


def column_ranges(ranges: DataFrame, groups: DataFrame) -> DataFrame:
    """Ranges of the columns that have one length and one use."""
    one = groups.where(~F.col("use").isin("Empty", "ZerosOnly")).groupBy("col_name").agg(F.count_distinct("length").alias("lengths"), F.count_distinct("use").alias("uses")).where("lengths = 1 and uses = 1").select("col_name")
    return ranges.join(one, "col_name", "left_semi").groupBy("col_name").agg(F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"))


def outlier_groups(ranges: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """Groups whose numbers spread over more than the outlier range."""
    return ranges.where((F.col("max_number") - F.col("min_number")) > config.outlier_range).select(*GROUP, "min_number", "max_number")


def normalization_failures(marked: DataFrame) -> DataFrame:
    """(col_name, value, n_rows, reason): values of digits and separators, without a letter, that aren't numbers by their column's
    plan. The reason names the way in which they were read."""
    kept = F.regexp_replace("value", "[^0-9.,]", "")
    both = kept.contains(".") & kept.contains(",")
    reason = F.when(F.col("mode") == "decimal_present", "number_parse_failed_decimal_present").when(both, "number_parse_failed_decimal_fallback").otherwise("number_parse_failed_thousands_only")
    return marked.where((kept != "") & ~F.col("value").rlike("[A-Za-z]") & F.col("norm_dec").isNull()).select("col_name", "value", "n_rows", reason.alias("reason"))


def mixed_kinds(marked: DataFrame, by: tuple[str, ...] = ("col_name",)) -> DataFrame:
    """(*by, kind): Date, Time or DateTime of values that needn't share a format, from ``marked_values``; null if some value is none.

    Dates and date-times together are dates if all times are the same and a full hour, else date-times; so is any other mixture.
    """
    order = F.coalesce("date_order", F.lit("DMY"))
    pick = lambda name: F.when(order == "MDY", F.col(f"{name}_MDY")).when(order == "YMD", F.col(f"{name}_YMD")).otherwise(F.col(f"{name}_DMY"))
    kind = F.when(pick("datetime"), "DateTime").when(pick("date"), "Date").when(F.col("time_ok"), "Time")
    time = F.lit(None).cast("timestamp_ntz")
    for o in ORDERS:
        time = F.when(order == o, parse_datetime_strict(F.col("value"), o)).otherwise(time)
    rows = marked.where("value <> ''").withColumn("kind", kind).withColumn("clock", F.when(F.col("kind") == "DateTime", F.date_format(time, "HH:mm:ss")))
    sums = rows.groupBy(*by).agg(F.bool_and(F.col("kind").isNotNull()).alias("all"), F.collect_set("kind").alias("kinds"), F.min("clock").alias("low"), F.max("clock").alias("high"))
    has = lambda k: F.array_contains("kinds", k)
    full_hour = (F.col("low") == F.col("high")) & F.col("low").endswith(":00:00")
    return sums.select(*by, F.when(~F.col("all"), F.lit(None)).when(F.size("kinds") == 1, F.get("kinds", F.lit(0))).when(has("Date") & has("DateTime") & full_hour, "Date").otherwise("DateTime").alias("kind"))


def date_mismatches(vc: DataFrame, columns: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(col_name, data_type, date_share, time_share): columns whose texts look like dates or times, but whose type doesn't say so."""
    v = F.col("value")
    date = v.rlike("^[0-9]{1,4}[/.-][0-9A-Za-z]{1,9}[/.-][0-9]{1,4}")
    clock = v.rlike("[0-9]{1,2}:[0-9]{2}")
    n = F.sum("n_rows")
    share = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n_rows"))), F.lit(0)) / n
    seen = vc.where(v != "").groupBy("col_name").agg(share(date).alias("date_share"), share(clock).alias("time_share"))
    joined = seen.join(columns.select("col_name", "data_type"), "col_name")
    return joined.where((F.greatest("date_share", "time_share") >= config.mismatch_share) & ~F.coalesce("data_type", F.lit("")).isin("DATE", "TIME", "DATETIME", "TIMESTAMP"))
