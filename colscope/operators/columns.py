"""Columns from their groups: content type, SQL type, structure codes, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DATETIME_USES, DEFAULT, NUMERIC_USES, TYPE_ABBREVIATION, USE_ABBREVIATION, ProfileConfig
from ..functions.dates import chosen_format, chosen_order, loose_pattern, order_counts, pattern_column, with_date_marks
from ..functions.text import b64_hash, serial_kind

REAL = ("Empty", "ZerosOnly")


def full_content_type(uses: Column, longest: Column) -> Column:
    """ND, FT[n], DV[n], MC, ST[n], an abbreviation with [n], or MIX[n]."""
    real = F.filter(uses, lambda u: ~u.isin(*REAL))
    size = F.concat(F.lit("["), longest.cast("string"), F.lit("]"))
    has = lambda u: F.array_contains(real, u)
    numeric = F.forall(real, lambda u: u.isin(*NUMERIC_USES))
    code = F.forall(real, lambda u: u.endswith("Code"))
    one = F.lit("XX")
    for use, short in USE_ABBREVIATION.items():
        one = F.when(F.get(real, F.lit(0)) == use, F.lit(short)).otherwise(one)
    n = F.size(real)
    return F.when(n == 0, "ND").when(has("FreeText"), F.concat(F.lit("FT"), size)).when(numeric & has("DecimalValue"), F.concat(F.lit("DV"), size)).when(code & (n > 1), "MC").when(has("StandardText"), F.concat(F.lit("ST"), size)).when(n == 1, F.concat(one, size)).otherwise(F.concat(F.lit("MIX"), size))


def varchar(longest: Column, config: ProfileConfig = DEFAULT) -> Column:
    out = F.lit(f"VARCHAR({config.varchar_sizes[-1]})")
    for size in reversed(config.varchar_sizes):
        out = F.when(longest <= size, F.lit(f"VARCHAR({size})")).otherwise(out)
    return out


def profile_columns(groups: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(ord, col_name, uses, max_length, full_content_type, content_type, data_type) from ``profile_groups``."""
    real = ~F.col("use").isin(*REAL)
    boolean = F.col("use") == "Boolean"
    sums = groups.groupBy("col_name").agg(
        F.min("ord").alias("ord"), F.array_sort(F.collect_set("use")).alias("uses"), F.max("length").alias("max_length"),
        F.max(F.col("length") - F.col("from_sign").cast("long")).alias("effective"),
        F.bool_and(F.when(boolean, F.col("class") == "NUMERIC")).alias("digits"), F.max(F.when(boolean, F.col("length"))).alias("b_max"), F.min(F.when(boolean, F.col("length"))).alias("b_min"),
        F.count_if(real & ~F.col("use").isin(*DATETIME_USES)).alias("others"), F.count_if(real).alias("real"),
    )
    uses = F.filter("uses", lambda u: ~u.isin(*REAL))
    has = lambda u: F.array_contains(F.col("uses"), u)
    all_in = lambda names: F.forall(uses, lambda u: u.isin(*names))
    dated = F.when(has("DateTime"), "DATETIME").when(has("Time") & ~has("Date"), "TIME").otherwise("DATE")
    number = F.when(has("DecimalValue"), "DECIMAL(38,10)").when(F.col("effective") <= config.int_digits, "INT").otherwise("BIGINT")
    size = F.greatest(F.lit(1), F.col("b_max")).cast("string")
    boolean_type = F.when(F.col("digits"), "INT").when((F.col("b_max") == F.col("b_min")) & (F.col("b_max") <= 10), F.concat(F.lit("CHAR("), size, F.lit(")"))).otherwise(F.concat(F.lit("VARCHAR("), size, F.lit(")")))
    # Texts that say null are empty already when they are read, so a date column has none left to tolerate.
    kind = F.when(F.size(uses) == 0, F.lit(None)).when((F.col("others") == 0) & (F.col("real") > 0), dated).when(all_in(NUMERIC_USES), number).when((F.size(uses) == 1) & has("Boolean"), boolean_type).otherwise(varchar(F.col("max_length"), config))
    content = full_content_type(F.col("uses"), F.col("max_length"))
    return sums.select("ord", "col_name", "uses", "max_length", content.alias("full_content_type"), b64_hash(content, 10).alias("content_type"), kind.alias("data_type"))


def _tokens(columns: DataFrame, kind: str, keys: Column, by: list[str]) -> DataFrame:
    """(*by, pk, token, n) of the kinds of columns, keys apart."""
    rows = columns.where(F.col(kind).isNotNull()).select(*by, keys.alias("pk"), F.col(kind).alias("kind"))
    return rows.groupBy(*by, "pk", "kind").agg(F.count("*").alias("n")).select(*by, "pk", F.concat(F.when(F.col("pk"), "PK$").otherwise(""), "kind").alias("token"), "n")


def _joined(tokens: DataFrame, lower: bool, by: list[str]) -> DataFrame:
    text = F.when(F.col("n") > 1, F.concat("token", F.lit("::["), F.col("n").cast("string"), F.lit("]"))).otherwise(F.col("token"))
    order = F.struct((~F.col("pk")).alias("a"), (F.lower("token") if lower else F.col("token")).alias("b"), text.alias("t"))
    return tokens.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda s: s["t"]), "-").alias("tokens"))


def _is_key(keys: list[str] | None) -> Column:
    return F.col("col_name").isin(*keys) if keys else F.lit(False)


def type_structure(columns: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(dt_struct_code): how many columns have a type, then the types, keys first, with how often each occurs."""
    return _type_codes(_joined(_tokens(columns, "data_type", _is_key(keys), []), True, []), [])


def content_structure(columns: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(struct_code, b64url_code) over the content types of columns that have a real use."""
    return _content_codes(_joined(_tokens(columns.where(F.col("full_content_type") != "ND"), "full_content_type", _is_key(keys), []), False, []), [])


def type_structures(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """(table, dt_struct_code) of many tables; ``keys`` is (table, key_columns)."""
    rows = columns.join(keys, "table", "left")
    return _type_codes(_joined(_tokens(rows, "data_type", _in_keys(), ["table"]), True, ["table"]), ["table"])


def content_structures(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """(table, struct_code, b64url_code) of many tables."""
    rows = columns.where(F.col("full_content_type") != "ND").join(keys, "table", "left")
    return _content_codes(_joined(_tokens(rows, "full_content_type", _in_keys(), ["table"]), False, ["table"]), ["table"])


def _in_keys() -> Column:
    return F.coalesce(F.array_contains("key_columns", F.col("col_name")), F.lit(False))


def _type_codes(joined: DataFrame, by: list[str]) -> DataFrame:
    return joined.select(*by, F.concat(F.col("n").cast("string"), F.lit(">"), "tokens").alias("dt_struct_code"))


def _content_codes(joined: DataFrame, by: list[str]) -> DataFrame:
    return joined.select(*by, F.col("tokens").alias("struct_code"), b64_hash(F.col("tokens"), 10).alias("b64url_code"))


def abbreviated(code: Column, table: dict[str, str] = TYPE_ABBREVIATION) -> tuple[Column, Column]:
    """A type structure with abbreviated tokens: with dashes, and without."""
    parts = F.filter(F.split(F.regexp_replace(code, r"^[0-9]+>", ""), "-"), lambda t: t != "")

    def short(t: Column) -> Column:
        key = t.startswith("PK$")
        body = F.regexp_replace(t, r"^PK\$", "")
        times = F.regexp_extract(body, r"::\[([0-9]+)\]$", 1)
        body = F.regexp_replace(body, r"::.*$", "")
        name = F.when(body.startswith("VARCHAR("), F.concat(F.lit("VC"), F.regexp_extract(body, r"\(([0-9,]+)\)", 1))).otherwise(F.lit("UN"))
        for kind, abbreviation in table.items():
            name = F.when(body == kind, F.lit(abbreviation)).otherwise(name)
        return F.concat(F.when(key, "K").otherwise(""), F.when(times == "", "1").otherwise(times), name)

    out = F.transform(parts, short)
    return F.array_join(out, "-"), F.array_join(out, "")


def format_annotations(vc: DataFrame, columns: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(col_name, data_type, pattern, source, annotated): how the texts of date and time columns are to be read.

    The pattern is that of the known format which all distinct texts have, by the order that they imply; it is given only if every
    text comes out of it as it went in (``try_to_timestamp``, then formatted again), or, where days, months or hours have one
    digit, if every text is read by the looser pattern. source is excel-serial or excel-day-fraction where most texts are such
    numbers. annotated is the type, ``::fmt[pattern]`` and ``::src[source]`` as far as there is one.
    """
    dated = columns.where(F.col("data_type").isin("DATE", "TIME", "DATETIME")).select("col_name", "data_type")
    texts = vc.where("value <> ''")
    marked = with_date_marks(texts.join(dated, "col_name", "left_semi"), config=config)
    formed = marked.groupBy("col_name").agg(F.bit_and("mask").alias("mask"), *order_counts()).withColumn("order", chosen_order(F.lit(config.prefer_order)))
    formed = formed.select("col_name", pattern_column(chosen_format(F.col("mask"), F.col("order"))["key"]).alias("exact")).where("exact is not null")
    formed = formed.withColumn("loose", loose_pattern(F.col("exact")))
    tried = texts.join(formed, "col_name").withColumns({"same": F.expr("coalesce(date_format(try_to_timestamp(value, exact), exact) = value, false)"), "fits": F.expr("try_to_timestamp(value, loose) IS NOT NULL")})
    proof = tried.groupBy("col_name").agg(F.bool_and("same").alias("same"), F.bool_and("fits").alias("fits"), F.first("exact").alias("exact"), F.first("loose").alias("loose"))
    proof = proof.select("col_name", F.when(F.col("same"), F.col("exact")).when(F.col("fits"), F.col("loose")).alias("pattern"))
    kind = serial_kind(F.col("value"))
    share = lambda k: F.avg(F.coalesce(kind == k, F.lit(False)).cast("double")) >= config.serial_hint_share
    serial = texts.groupBy("col_name").agg(F.when(share("Date"), "excel-serial").when(share("Time"), "excel-day-fraction").alias("source"))
    serial = serial.where("source is not null")
    typed = columns.select("col_name", "data_type").join(serial, "col_name", "left").where(F.col("data_type").isin("DATE", "TIME", "DATETIME") | F.col("source").isNotNull())
    out = typed.join(proof, "col_name", "left")
    part = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"::{name}["), F.col(c), F.lit("]"))).otherwise("")
    return out.select("col_name", "data_type", "pattern", "source", F.concat("data_type", part("fmt", "pattern"), part("src", "source")).alias("annotated"))


def columns_by_type(columns: DataFrame) -> DataFrame:
    """(data_type, columns): sorted names; Unknown without a type."""
    return columns.groupBy(F.coalesce("data_type", F.lit("Unknown")).alias("data_type")).agg(F.array_join(F.sort_array(F.collect_list("col_name")), ",").alias("columns"))


def differences(columns: DataFrame, top: DataFrame, chains: DataFrame | None = None) -> DataFrame:
    """(col_name, differences, correlation_differences, b64url_code): the frequent values (and chain) that the first column of the
    same content type hasn't. Lists are joined by |."""
    listed = top.groupBy("col_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda s: s["value"]).alias("values"))
    rows = columns.join(listed, "col_name", "left").withColumn("values", F.coalesce("values", F.array().cast("array<string>")))
    chain = F.array().cast("array<string>")
    if chains is not None:
        rows = rows.join(chains, "col_name", "left")
        chain = F.filter(F.split(F.coalesce("correlation_chain", F.lit("")), ">"), lambda x: x != "")
    rows = rows.withColumn("chain", chain)
    first = Window.partitionBy("full_content_type").orderBy("ord")
    known = F.col("full_content_type") != "ND"
    new = lambda c: F.when(known, F.array_except(c, F.first(c).over(first))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns({"d": new("values"), "cd": new("chain")})
    text = F.array_join("d", "|")
    return rows.select("col_name", text.alias("differences"), F.array_join("cd", "|").alias("correlation_differences"), F.concat("content_type", F.lit("$"), b64_hash(text, 10)).alias("b64url_code"))
