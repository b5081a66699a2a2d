"""The registered queries of the profiler, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators import cells, columns, correlate, discovery, groups, keys
from ..storage import Stored
from ..streaming import events as file_events
from . import details, oracle
from .registry import ORACLE, QUERIES, counts, query, table
from .registry import profiled_columns as _columns

__all__ = ["ORACLE", "QUERIES", "details"]

# ---------------------------------------------------------------- scans and text


@query(f"WITH vc AS ({oracle.value_counts('lineitem')}) SELECT col_name, CAST(coalesce(sum(n_rows) FILTER (WHERE value <> ''), 0) AS BIGINT) AS non_empty, CAST(count(*) FILTER (WHERE value <> '') AS BIGINT) AS distinct_values, CAST(sum(n_rows) AS BIGINT) AS total FROM vc GROUP BY 1")
def column_stats_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.column_stats(counts(spark, sf_dir, "lineitem"))


@query(f"SELECT col_name, value, n_rows FROM ({oracle.value_counts('orders')})")
def value_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir, "orders").select("col_name", "value", "n_rows")


@query(f"SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(*) FILTER (WHERE {' OR '.join(f"{oracle.cell('documents', c)} <> ''" for c in oracle.TABLES['documents'])}) AS BIGINT) AS rows_with_data FROM documents")
def row_counts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.row_counts(table(spark, sf_dir, "documents"))


@query(f"WITH vc AS ({oracle.value_counts('orders')}) SELECT col_name, length(value) AS length, {oracle.CLASS} AS class, CAST(count(*) AS BIGINT) AS n_values, bool_and(regexp_matches(value, '^-?[0-9]+$')) AS numeric_only, bool_and(regexp_matches(value, '^-?[0-9]+$')) AND bool_or(starts_with(value, '-')) AS from_sign FROM vc GROUP BY ALL")
def length_groups_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.length_groups(counts(spark, sf_dir, "orders"))


@query(f"WITH vc AS ({oracle.value_counts('documents')}) SELECT col_name, {oracle.CLASS} AS class, CAST(count(*) AS BIGINT) AS n_values, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM vc GROUP BY ALL")
def char_class_counts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    vc = counts(spark, sf_dir, "documents")
    return vc.groupBy("col_name", text.char_class(F.col("value")).alias("class")).agg(F.count("*").alias("n_values"), F.sum("n_rows").alias("n_rows"))


@query(f"WITH vc AS ({oracle.value_counts('orders')}), f AS (SELECT *, sum(n_rows) OVER (PARTITION BY col_name) AS total, row_number() OVER (PARTITION BY col_name ORDER BY n_rows DESC, value) AS rank FROM vc WHERE value <> '') SELECT col_name, CAST(rank AS INTEGER) AS rank, value, round(n_rows / total, 9) AS share FROM f WHERE rank <= 10")
def top10_freq_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.top_values(counts(spark, sf_dir, "orders")).withColumn("share", F.round("share", 9))


@query(oracle.homogeneity("orders"))
def length_entropy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.homogeneity(groups.length_groups(counts(spark, sf_dir, "orders"))).select("col_name", F.round("entropy", 6).alias("entropy"), F.round("homogeneity", 6).alias("homogeneity"))


@query(oracle.homogeneity("part"))
def homogeneity_rate_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.homogeneity(groups.length_groups(counts(spark, sf_dir, "part"))).select("col_name", F.round("entropy", 6).alias("entropy"), F.round("homogeneity", 6).alias("homogeneity"))


@query("""
WITH t AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN ' null ' WHEN 1 THEN 'N/A' WHEN 2 THEN 'none' ELSE role END AS said FROM conversations)
SELECT conv_id, turn, CASE WHEN turn % 4 < 2 THEN '' ELSE said END AS said FROM t""")
def nullish_normalize_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("turn") % 4
    said = F.when(m == 0, " null ").when(m == 1, "N/A").when(m == 2, "none").otherwise(F.col("role"))
    df = table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("said"))
    return df.select("conv_id", "turn", text.cell_text(F.col("said"), df.schema["said"].dataType).alias("said"))


@query("""
SELECT c_custkey, substr(replace(replace(base64(unhex(sha256(c_name))), '+', '-'), '/', '_'), 1, 8) AS hash8,
  substr(replace(replace(base64(unhex(sha256(c_name))), '+', '-'), '/', '_'), 1, 10) AS hash10 FROM customer""")
def hash_fingerprints_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.b64_hash(F.col("c_name"), 8).alias("hash8"), text.b64_hash(F.col("c_name"), 10).alias("hash10"))


@query("""
WITH x AS (SELECT DISTINCT o_orderpriority AS p, o_orderkey AS x FROM orders),
g AS (SELECT p, x, x - row_number() OVER (PARTITION BY p ORDER BY x) AS g FROM x),
r AS (SELECT p, g, min(x) AS a, max(x) AS b FROM g GROUP BY p, g)
SELECT p AS o_orderpriority, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ',' ORDER BY a) AS ranges FROM r GROUP BY p""")
def compress_ranges_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.compressed_ranges(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderkey")


# ---------------------------------------------------------------- numbers


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in three ways of writing numbers, by column."""
    p = F.format_number(F.col("p_retailprice"), 2)
    swapped = F.translate(p, ",.", ".,")
    ways = F.array(F.struct(F.lit("english").alias("col_name"), p.alias("value")), F.struct(F.lit("continental").alias("col_name"), swapped.alias("value")), F.struct(F.lit("whole").alias("col_name"), F.format_number(F.floor(F.col("p_retailprice") * 1000), 0).alias("value")), F.struct(F.lit("signed").alias("col_name"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("("), swapped, F.lit(")"))).otherwise(swapped).alias("value")))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(ways).alias("w")).select("p_partkey", "w.*")


@query(f"{oracle.PRICED} SELECT p_partkey, col_name, regexp_replace(value, '[^0-9.,()-]', '', 'g') AS sanitized, starts_with(value, '(') AS negative FROM priced")
def number_sanitize_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = numbers.sanitized(F.concat(F.lit(" $"), F.col("value")))
    return _priced(spark, sf_dir).select("p_partkey", "col_name", s.alias("sanitized"), numbers.is_negative(s).alias("negative"))


def _price_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers.number_plans(numbers.number_samples(_priced(spark, sf_dir).withColumnRenamed("p_partkey", "ord")))


@query("""
WITH m AS (SELECT CASE WHEN max(p_retailprice) >= 1000 THEN 'both_separators_last_wins' ELSE 'fallback_decimal' END AS r, CASE WHEN max(p_retailprice) >= 1000 THEN 'rule1_multi_sep' ELSE 'rule2_const_3' END AS w FROM part)
SELECT col_name, mode, decimal, thousands, CASE WHEN col_name = 'whole' THEN w ELSE r END AS reason
FROM m, (VALUES ('english', 'decimal_present', '.', ','), ('continental', 'decimal_present', ',', '.'), ('signed', 'decimal_present', ',', '.'), ('whole', 'thousands_only', NULL, ',')) AS t(col_name, mode, decimal, thousands)""")
def number_plan_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _price_plans(spark, sf_dir)


@query(f"{oracle.PRICED} SELECT p_partkey, col_name, CASE WHEN col_name = 'whole' THEN CAST(cents AS VARCHAR) WHEN col_name = 'signed' AND p_partkey % 2 = 0 THEN '-' || plain ELSE plain END AS number FROM priced")
def number_normalize_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _priced(spark, sf_dir).join(F.broadcast(_price_plans(spark, sf_dir)), "col_name")  # one plan for each of four columns
    return numbers.with_numbers(rows).select("p_partkey", "col_name", F.col("norm_dec").alias("number"))


# ---------------------------------------------------------------- dates


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in several ways, by column."""
    d = F.col("o_orderdate")
    ways = {"dmy": "dd/MM/yyyy", "mdy": "MM-dd-yyyy", "ymd": "yyyy.MM.dd", "stamp": "yyyy-MM-dd HH:mm:ss", "clock": "HH:mm", "compact": "yyyyMMdd"}
    parts = F.array(*[F.struct(F.lit(k).alias("col_name"), F.date_format(d, f).alias("value")) for k, f in ways.items()])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(parts).alias("w")).select("o_orderkey", "w.*")


def _rendered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir).groupBy("col_name", "value").agg(F.count("*").alias("n_rows")).withColumn("ord", F.lit(0))


_RENDERED = "r AS (SELECT unnest(['dmy', 'mdy', 'ymd', 'stamp']) AS col_name, unnest([strftime(o_orderdate, '%d/%m/%Y'), strftime(o_orderdate, '%m-%d-%Y'), strftime(o_orderdate, '%Y.%m.%d'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')]) AS value FROM orders)"


@query(f"""
WITH {_RENDERED},
p AS (SELECT DISTINCT col_name, value, regexp_split_to_array(substr(value, 1, 10), '[^0-9]') AS x FROM r),
f AS (SELECT col_name, o, coalesce(CASE o WHEN 'DMY' THEN TRY_CAST(x[3] || '-' || lpad(x[2], 2, '0') || '-' || lpad(x[1], 2, '0') AS DATE) WHEN 'MDY' THEN TRY_CAST(x[3] || '-' || lpad(x[1], 2, '0') || '-' || lpad(x[2], 2, '0') AS DATE)
  ELSE TRY_CAST(x[1] || '-' || lpad(x[2], 2, '0') || '-' || lpad(x[3], 2, '0') AS DATE) END IS NOT NULL AND length(x[CASE o WHEN 'YMD' THEN 1 ELSE 3 END]) = 4, false) AS fit, value FROM p, (VALUES ('DMY'), ('MDY'), ('YMD')) AS t(o)),
n AS (SELECT *, count(*) FILTER (WHERE fit) OVER (PARTITION BY col_name, value) AS fits FROM f),
c AS (SELECT col_name, o, count(*) FILTER (WHERE fit AND fits = 1) AS dec, count(*) FILTER (WHERE fit) AS all_ FROM n GROUP BY ALL),
k AS (SELECT *, rank() OVER (PARTITION BY col_name ORDER BY dec DESC, all_ DESC) AS k FROM c WHERE all_ > 0)
SELECT col_name, CASE WHEN count(*) = 1 THEN min(o) ELSE 'DMY' END AS date_order FROM k WHERE k = 1 GROUP BY 1""")
def date_order_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.date_orders(_rendered_counts(spark, sf_dir)).where("date_order is not null").select("col_name", "date_order")


@query(r"""
WITH r AS (SELECT unnest(['dmy', 'mdy', 'ymd', 'stamp', 'clock', 'compact']) AS col_name, unnest([strftime(o_orderdate, '%d/%m/%Y'), strftime(o_orderdate, '%m-%d-%Y'), strftime(o_orderdate, '%Y.%m.%d'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), strftime(o_orderdate, '%H:%M'), strftime(o_orderdate, '%Y%m%d')]) AS value FROM orders),
b AS (SELECT col_name, count(*) AS n, bool_and(regexp_matches(value, '^\d{1,2}/\d{1,2}/\d{4}$')) AS slashed, max(TRY_CAST(split_part(value, '/', 1) AS INT)) AS first_slash, bool_and(regexp_matches(value, '^\d{1,2}-\d{1,2}-\d{4}$')) AS dashed, max(TRY_CAST(split_part(value, '-', 1) AS INT)) AS first_dash, max(TRY_CAST(split_part(value, '-', 2) AS INT)) AS second_dash,
  bool_and(regexp_matches(value, '^\d{4}\.\d{1,2}\.\d{1,2}$')) AS dotted, bool_and(regexp_matches(value, '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$')) AS stamped, bool_and(regexp_matches(value, '^\d{1,2}:\d{2}$')) AS clocked, bool_and(regexp_matches(value, '^\d{8}$')) AS packed FROM r GROUP BY 1)
SELECT col_name, CASE WHEN slashed THEN CASE WHEN first_slash > 12 THEN 'DD/MM/YYYY' ELSE '?' END WHEN dashed THEN CASE WHEN first_dash <= 12 AND second_dash > 12 THEN 'MM-DD-YYYY' ELSE 'DD-MM-YYYY' END WHEN dotted THEN 'YYYY.MM.DD' WHEN stamped THEN 'YYYY-MM-DD HH:mm:ss' WHEN clocked THEN 'HH:mm' WHEN packed THEN 'YYYYMMDD' END AS key,
  CASE WHEN stamped THEN 'DateTime' WHEN clocked THEN 'Time' ELSE 'Date' END AS kind FROM b""".replace("\\\\", "\\"))
def uniform_format_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dates.with_date_marks(_rendered_counts(spark, sf_dir)).groupBy("col_name").agg(F.bit_and("mask").alias("mask"), *dates.order_counts())
    found = found.withColumn("order", dates.chosen_order(F.lit("DMY")))
    return found.withColumn("form", dates.chosen_format(F.col("mask"), F.col("order"))).select("col_name", "form.key", "form.kind")


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dmy, strftime(o_orderdate, '%Y-%m-%d') AS mdy, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
  CASE WHEN day(o_orderdate) <= 12 THEN strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d') END AS swapped
FROM orders""")
def strict_dates_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day(dates.parse_date_strict(F.date_format(d, "dd/MM/yyyy"), "DMY")).alias("dmy"), day(dates.parse_date_strict(F.date_format(d, "MM-dd-yyyy"), "MDY")).alias("mdy"),
        F.date_format(dates.parse_datetime_strict(F.date_format(d, "yyyy/MM/dd HH:mm:ss"), "YMD"), "yyyy-MM-dd HH:mm:ss").alias("stamp"), day(dates.parse_date_strict(F.date_format(d, "dd/MM/yyyy"), "MDY")).alias("swapped"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%H:%M:%S') AS clock, 'not a date' AS other FROM events")
def canonical_dates_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, order = F.col("ts"), F.lit("DMY")
    stamp = dates.canonical(F.date_format(ts, "dd/MM/yyyy HH:mm:ss"), F.lit("DateTime"), order)
    clock = dates.canonical(F.upper(F.date_format(ts, "h:mm:ss a")), F.lit("Time"), order)
    return table(spark, sf_dir, "events").select("event_id", stamp.alias("stamp"), clock.alias("clock"), dates.canonical(F.lit("not a date"), F.lit("Date"), order).alias("other"))


@query("SELECT o_orderkey, date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS serial, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d 12:00:00') AS noon FROM orders")
def excel_serial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", serial.cast("long").alias("serial"), F.date_format(dates.serial_timestamp(serial + 0.5), "yyyy-MM-dd HH:mm:ss").alias("noon"))


@query("""
WITH p AS (SELECT unnest(['days', 'fractions', 'keys']) AS col_name, unnest([CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR), '0.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), 'k' || o_orderkey]) AS value FROM orders),
x AS (SELECT col_name, CASE WHEN regexp_matches(value, '^[0-9]+([.][0-9]+)?$') THEN TRY_CAST(value AS DOUBLE) END AS x FROM p)
SELECT col_name, CASE WHEN avg(CASE WHEN x > 20000 AND x < 80000 THEN 1 ELSE 0 END) >= 0.8 THEN 'Date' WHEN avg(CASE WHEN x >= 0 AND x < 1 THEN 1 ELSE 0 END) >= 0.8 THEN 'Time' END AS hint FROM x GROUP BY 1""")
def serial_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")).cast("string")
    parts = F.array(F.struct(F.lit("days").alias("col_name"), days.alias("value")), F.struct(F.lit("fractions").alias("col_name"), F.concat(F.lit("0."), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")).alias("value")), F.struct(F.lit("keys").alias("col_name"), F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("value")))
    kind = text.serial_kind(F.col("value"))
    rows = table(spark, sf_dir, "orders").select(F.explode(parts).alias("w")).select("w.*")
    share = lambda k: F.avg(F.coalesce((kind == k).cast("double"), F.lit(0.0)))
    return rows.groupBy("col_name").agg(F.when(share("Date") >= 0.8, "Date").when(share("Time") >= 0.8, "Time").alias("hint"))


# ---------------------------------------------------------------- groups and columns


@query(oracle.uses("orders", "SELECT col_name, length, class, zeros, code, all_letters, all_digits, decimals, fraction, negative FROM f"))
def use_flags_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = groups.group_flags(groups.marked_kinds(counts(spark, sf_dir, "orders")))
    return flags.select("col_name", "length", "class", "zeros", "code", "all_letters", "all_digits", "decimals", "fraction", "negative")


def _groups(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return groups.profile_groups(counts(spark, sf_dir, name))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM ({oracle.uses(t, 'SELECT "col_name", length, class, first_use FROM u')})" for t in ("orders", "customer", "part")))
def column_uses_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_groups(spark, sf_dir, t).select(F.lit(t).alias("table_name"), "col_name", "length", "class", "first_use") for t in ("orders", "customer", "part")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(oracle.uses("lineitem", "SELECT v.col_name, v.length, v.class, min(CAST(norm AS DECIMAL(38,10))) AS min_number, max(CAST(norm AS DECIMAL(38,10))) AS max_number FROM v JOIN u ON v.col_name = u.col_name AND v.length = u.length AND v.class = u.class WHERE u.n_values > 1 AND u.first_use IN ('DecimalValue', 'IntegerValue', 'NumericCode') GROUP BY ALL"))
def group_minmax_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = groups.marked_kinds(counts(spark, sf_dir, "lineitem"))
    found = Stored(groups.with_use(groups.group_flags(marked)).withColumn("use", F.col("first_use")), "query-groups").df
    return groups.group_ranges(marked, found).where("min_number is not null").select("col_name", "length", "class", "min_number", "max_number")


@query(oracle.uses("orders", "SELECT v.col_name, v.length, v.class, min(CAST(norm AS DECIMAL(38,10))) AS min_number, max(CAST(norm AS DECIMAL(38,10))) AS max_number FROM v JOIN u ON v.col_name = u.col_name AND v.length = u.length AND v.class = u.class WHERE u.n_values > 1 AND u.first_use IN ('DecimalValue', 'IntegerValue', 'NumericCode') GROUP BY ALL HAVING max(CAST(norm AS DECIMAL(38,10))) - min(CAST(norm AS DECIMAL(38,10))) > 10000"))
def outlier_groups_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..config import ProfileConfig

    marked = groups.marked_kinds(counts(spark, sf_dir, "orders"))
    found = Stored(groups.with_use(groups.group_flags(marked)).withColumn("use", F.col("first_use")), "query-groups").df
    return groups.outlier_groups(groups.group_ranges(marked, found), ProfileConfig(outlier_range=10_000))


@query(oracle.columns("orders", "SELECT col_name, data_type FROM d"))
def sql_types_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "orders").select("col_name", "data_type")


@query(oracle.columns("orders", "SELECT col_name, full_content_type, substr(replace(replace(base64(unhex(sha256(full_content_type))), '+', '-'), '/', '_'), 1, 10) AS content_type FROM d"))
def content_types_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(spark, sf_dir, "orders").select("col_name", "full_content_type", "content_type")


@query(oracle.columns("orders", "SELECT (SELECT CAST(count(*) AS VARCHAR) FROM d WHERE data_type IS NOT NULL) || '>' || string_agg(token, '-' ORDER BY pk DESC, lower(token)) AS dt_struct_code FROM (SELECT col_name = 'o_orderkey' AS pk, CASE WHEN col_name = 'o_orderkey' THEN 'PK$' ELSE '' END || data_type AS kind, CASE WHEN count(*) > 1 THEN (CASE WHEN col_name = 'o_orderkey' THEN 'PK$' ELSE '' END || data_type) || '::[' || count(*) || ']' ELSE (CASE WHEN col_name = 'o_orderkey' THEN 'PK$' ELSE '' END || data_type) END AS token FROM d WHERE data_type IS NOT NULL GROUP BY col_name = 'o_orderkey', data_type, CASE WHEN col_name = 'o_orderkey' THEN 'PK$' ELSE '' END)"))
def struct_code_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.type_structure(_columns(spark, sf_dir, "orders"), ["o_orderkey"])


@query(oracle.columns("orders", "SELECT coalesce(data_type, 'Unknown') AS data_type, string_agg(col_name, ',' ORDER BY col_name) AS columns FROM d GROUP BY 1"))
def columns_by_datatype(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.columns_by_type(_columns(spark, sf_dir, "orders"))


# ---------------------------------------------------------------- keys and correlations


@query(" UNION ALL ".join(f"SELECT '{c}' AS candidate, CAST(count(*) FILTER (WHERE {oracle.cell('lineitem', c)} NOT IN ('', '0')) AS BIGINT) AS n_rows, CAST(count(DISTINCT {oracle.cell('lineitem', c)}) FILTER (WHERE {oracle.cell('lineitem', c)} NOT IN ('', '0')) AS BIGINT) AS n_distinct FROM lineitem" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")))
def key_single_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.uniqueness(cells.text_table(table(spark, sf_dir, "lineitem")), [(c,) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])


PAIRS = (("l_orderkey", "l_linenumber"), ("l_orderkey", "l_partkey"), ("l_orderkey", "l_suppkey"), ("l_partkey", "l_suppkey"))


@query(" UNION ALL ".join(f"SELECT '{a},{b}' AS candidate, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT ({a}, {b})) AS BIGINT) AS n_distinct FROM lineitem WHERE {a} <> 0 OR {b} <> 0" for a, b in PAIRS))
def key_pair_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.uniqueness(cells.text_table(table(spark, sf_dir, "lineitem")), list(PAIRS))


@query("""
WITH c AS (SELECT DISTINCT * FROM conversations),
s AS (SELECT count(*) AS n, count(DISTINCT conv_id) AS a, count(DISTINCT turn) AS b, count(DISTINCT role) AS c, count(DISTINCT trim(text)) AS d, count(DISTINCT (conv_id, turn)) AS ab FROM c)
SELECT CASE WHEN a = n THEN 'conv_id' WHEN b = n THEN 'turn' WHEN c = n THEN 'role' WHEN d = n THEN 'text' WHEN ab = n THEN 'conv_id,turn' END AS key_columns, false AS cut FROM s""")
def key_search_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "conversations")
    found, cut = keys.find_key(df, groups.profile_groups(cells.value_counts(df)))
    return spark.createDataFrame([(",".join(sorted(found)), cut)], "key_columns string, cut boolean")


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)) AS BIGINT) AS n_distinct_rows FROM lineitem")
def dup_rows_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.repeated_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"])


CORRELATED = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlate.strict_pairs(correlate.value_rows(table(spark, sf_dir, "customer"), list(CORRELATED), ["c_custkey"]))


@query(oracle.correlated("customer", CORRELATED, "SELECT x_column, x_value, y_column, y_value, n_rows FROM p"))
def strict_corr_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(oracle.correlated("customer", CORRELATED, "SELECT x_column, x_value, y_column, y_value, n_rows FROM p WHERE CASE WHEN length(x_value) = 1 THEN regexp_matches(y_value, '(^|[^A-Za-z0-9])' || x_value || '($|[^A-Za-z0-9])') ELSE contains(y_value, x_value) END"))
def contained_corr_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlate.contained_pairs(_pairs(spark, sf_dir))


@query(oracle.correlated("customer", CORRELATED, "SELECT x_column AS col_name, string_agg(DISTINCT y_column, '>' ORDER BY y_column) AS correlation_chain FROM p GROUP BY 1"))
def correlation_chain_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlate.column_chains(correlate.value_rows(table(spark, sf_dir, "customer"), list(CORRELATED), ["c_custkey"]))


# ---------------------------------------------------------------- discovery and events

_FILES = """f AS (SELECT 'in/' || CASE WHEN p_partkey % 2 = 0 THEN 'X-MB51#' ELSE 'x-kob1#' END || (p_partkey // 3) || CASE p_partkey % 3 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.KNFO' ELSE '.meta' END AS path, CAST(CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE p_size * 1000 END AS BIGINT) AS size FROM part
  UNION ALL SELECT 'in/X-MB51#' || p_partkey || '.xlsx', CAST(p_size AS BIGINT) FROM part WHERE p_partkey % 5 = 0),
b AS (SELECT *, lower(regexp_replace(split_part(path, '/', 2), '[.][A-Za-z0-9]+$', '')) AS base, lower(regexp_extract(path, '([.][A-Za-z0-9]+)$', 1)) AS ext FROM f)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheets and documents of some names, by the numbers of parts; some documents are empty."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    stem = F.concat(F.lit("in/"), F.when(key % 2 == 0, "X-MB51#").otherwise("x-kob1#"), F.floor(key / 3).cast("string"), F.when(key % 3 == 0, ".xlsx").when(key % 3 == 1, ".KNFO").otherwise(".meta"))
    files = p.select(stem.alias("path"), F.when(key % 7 == 0, 2).otherwise(F.col("p_size") * 1000).cast("long").alias("size"))
    return files.unionByName(p.where(key % 5 == 0).select(F.concat(F.lit("in/X-MB51#"), key.cast("string"), F.lit(".xlsx")).alias("path"), F.col("p_size").cast("long").alias("size")))


@query(f"WITH {_FILES} SELECT path, size, base FROM b WHERE ext = '.xlsx' AND contains(path, 'MB51') AND NOT (EXISTS (SELECT 1 FROM b k WHERE k.base = b.base AND k.ext = '.knfo' AND k.size > 2) AND EXISTS (SELECT 1 FROM b m WHERE m.base = b.base AND m.ext = '.meta' AND m.size > 2))")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.pending(_files(spark, sf_dir))


@query(f"WITH {_FILES} SELECT DISTINCT base FROM b WHERE ext = '.knfo' AND size > 2 AND NOT EXISTS (SELECT 1 FROM b m WHERE m.base = b.base AND m.ext = '.meta' AND m.size > 2) AND NOT EXISTS (SELECT 1 FROM b x WHERE x.base = b.base AND x.ext = '.xlsx')")
def orphan_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.orphans(_files(spark, sf_dir))


@query("""
WITH f AS (SELECT r_name AS context, p_name || p_partkey AS path, CAST(p_partkey % 40 AS DOUBLE) AS size_mb FROM part JOIN region ON r_regionkey = p_partkey % 5),
n AS (SELECT *, size_mb >= 20 AS large, row_number() OVER (PARTITION BY context, size_mb >= 20 ORDER BY size_mb DESC, path) AS n, count(*) FILTER (WHERE size_mb >= 20) OVER (PARTITION BY context) AS total FROM f)
SELECT context, path, size_mb, large, CAST(CASE WHEN large THEN n ELSE total + ceil(n / 5) END AS BIGINT) AS batch FROM n""")
def admission_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, region = table(spark, sf_dir, "part"), table(spark, sf_dir, "region")
    files = part.join(region, F.col("r_regionkey") == F.col("p_partkey") % 5).select(F.col("r_name").alias("context"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("path"), (F.col("p_partkey") % 40).cast("double").alias("size_mb"))
    return discovery.admission(files)


def _file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages about files."""
    e = table(spark, sf_dir, "events")
    path = F.concat(F.lit("in/"), (F.col("user_id") % 7).cast("string"), F.when(F.col("event_id") % 3 == 0, ".knfo").otherwise(".xlsx"))
    kind = F.when(F.col("event_id") % 4 == 0, "file_deleted").when(F.col("event_id") % 4 == 1, "connected").otherwise("file_created")
    return e.select("ts", F.to_json(F.struct(kind.alias("event"), path.alias("file_path"))).alias("value"))


_EVENTS = "WITH e AS (SELECT ts, 'in/' || (user_id % 7) || CASE WHEN event_id % 3 = 0 THEN '.knfo' ELSE '.xlsx' END AS path, CASE WHEN event_id % 3 = 0 THEN '.knfo' ELSE '.xlsx' END AS extension, event_id % 4 AS m FROM events), r AS (SELECT * FROM e WHERE m <> 1 AND (m = 0 OR extension = '.xlsx'))"


@query(f"{_EVENTS} SELECT extension, CAST(count(*) AS BIGINT) AS n_events FROM r GROUP BY 1")
def event_counts_by_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_events.counts_by_extension(file_events.relevant(file_events.decode(_file_events(spark, sf_dir))))


@query(f"{_EVENTS} SELECT strftime(time_bucket(INTERVAL '5 seconds', ts), '%Y-%m-%d %H:%M:%S') AS batch_start, path, CAST(count(*) AS BIGINT) AS n_events FROM r GROUP BY ALL")
def debounced_batches_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = file_events.batched(file_events.relevant(file_events.decode(_file_events(spark, sf_dir))))
    return rows.select(F.date_format("batch_start", "yyyy-MM-dd HH:mm:ss").alias("batch_start"), "path", "n_events")
