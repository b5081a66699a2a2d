"""SQL for DuckDB that says what the catalogue's queries return."""

from __future__ import annotations

# The driver's tables that are profiled: columns and kinds (i: whole number, d: double, t: timestamp, s: text).
TABLES = {
    "orders": {"o_orderkey": "i", "o_custkey": "i", "o_orderstatus": "s", "o_totalprice": "d", "o_orderdate": "t", "o_orderpriority": "s"},
    "customer": {"c_custkey": "i", "c_name": "s", "c_nationkey": "i", "c_acctbal": "d", "c_mktsegment": "s"},
    "part": {"p_partkey": "i", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "i", "p_retailprice": "d"},
    "documents": {"doc_id": "i", "text": "s", "lang": "s", "source": "s", "n_chars": "i"},
    "lineitem": {"l_orderkey": "i", "l_partkey": "i", "l_suppkey": "i", "l_linenumber": "i", "l_quantity": "d", "l_extendedprice": "d", "l_discount": "d", "l_tax": "d", "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"},
}

CLASS = """CASE WHEN value = '' THEN 'EMPTY' WHEN regexp_matches(value, '^[0-9]{1,8}-[0-9Kk]$') THEN 'RUT'
  WHEN regexp_matches(value, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') THEN 'EMAIL' WHEN regexp_matches(value, '^[0-9]+$') THEN 'NUMERIC'
  WHEN regexp_matches(value, '^[A-Za-z._-]+$') AND regexp_matches(value, '[A-Za-z]') THEN 'ALPHA'
  WHEN regexp_matches(value, '^[A-Za-z0-9._-]+$') THEN 'ALPHANUM' ELSE 'PHRASE' END"""

PRICED = """WITH p AS (SELECT p_partkey, format('{:,.2f}', p_retailprice) AS e, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS plain, CAST(floor(p_retailprice * 1000) AS BIGINT) AS cents FROM part),
q AS (SELECT *, translate(e, ',.', '.,') AS c FROM p),
priced AS (SELECT p_partkey, plain, cents, 'english' AS "col_name", e AS value FROM q UNION ALL SELECT p_partkey, plain, cents, 'continental', c FROM q
  UNION ALL SELECT p_partkey, plain, cents, 'whole', format('{:,}', cents) FROM q
  UNION ALL SELECT p_partkey, plain, cents, 'signed', CASE WHEN p_partkey % 2 = 0 THEN '(' || c || ')' ELSE c END FROM q)"""


def cell(table: str, column: str) -> str:
    """A cell's text, trimmed."""
    kind = TABLES[table][column]
    if kind == "d":
        body = f"regexp_replace(CAST(CAST({column} AS DECIMAL(18,6)) AS VARCHAR), '\\.?0+$', '')"
    elif kind == "t":
        body = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    else:
        body = f"CAST({column} AS VARCHAR)"
    body = f"coalesce({body}, '')"
    if kind != "s":
        return body
    body = f"regexp_replace({body}, '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN lower({body}) IN ('null', 'n/a') THEN '' ELSE {body} END"


def value_counts(table: str, only: tuple[str, ...] | None = None) -> str:
    names = only or tuple(TABLES[table])
    parts = " UNION ALL ".join(f"SELECT {i} AS ord, '{c}' AS col_name, {cell(table, c)} AS value FROM {table}" for i, c in enumerate(names))
    return f"SELECT ord, col_name, value, CAST(count(*) AS BIGINT) AS n_rows FROM ({parts}) GROUP BY ALL"


def homogeneity(table: str) -> str:
    return f"""WITH l AS (SELECT "col_name", length(value) AS length, count(*) AS n FROM ({value_counts(table)}) GROUP BY ALL),
p AS (SELECT *, n / sum(n) OVER (PARTITION BY "col_name") AS p FROM l),
s AS (SELECT "col_name", count(*) AS k, -sum(p * log2(p)) AS entropy, min(length) AS least FROM p GROUP BY 1)
SELECT "col_name", round(entropy + 0.0, 6) AS entropy, round(CASE WHEN k < 2 THEN 0.0 ELSE entropy / log2(k) * (k - 1) / 9
  + CASE least WHEN 1 THEN 0.4 WHEN 2 THEN 0.2 WHEN 3 THEN 0.1 ELSE 0 END END, 6) AS homogeneity FROM s"""


def uses(table: str, select: str) -> str:
    """With tables v (values), f (flags of groups), u (f and first_use). Numbers in these tables have a point for decimals, and dates
    are time stamps."""
    return f"""WITH vc AS ({value_counts(table)}),
w AS (SELECT *, length(value) AS length, {CLASS} AS class, regexp_replace(value, '[^0-9.,()-]', '', 'g') AS s FROM vc),
x AS (SELECT *, regexp_replace(s, '[()-]', '', 'g') AS u FROM w),
v AS (SELECT *, CASE WHEN regexp_matches(u, '^[0-9]*\\.?[0-9]*$') AND regexp_matches(u, '[0-9]') THEN
    CASE WHEN starts_with(s, '-') OR regexp_matches(s, '^\\(.*\\)$') THEN '-' ELSE '' END || CASE WHEN starts_with(u, '.') THEN '0' ELSE '' END || rtrim(u, '.') END AS norm FROM x),
f AS (SELECT "col_name", length, class, min(ord) AS ord, count(*) AS n_values, sum(n_rows) AS n_rows,
  bool_and(regexp_matches(value, '^[0-9.eE+-]+$') AND coalesce(TRY_CAST(value AS DOUBLE) = 0, false)) AS zeros,
  bool_and(regexp_matches(value, '^[A-Za-z0-9_.-]+$')) AS code, bool_and(regexp_matches(value, '^[A-Za-z._-]+$')) AS all_letters,
  bool_and(regexp_matches(value, '^[0-9]+$')) AS all_digits, bool_or(regexp_matches(value, '[A-Za-z]')) AS some_letter, bool_or(regexp_matches(value, '[0-9]')) AS some_digit,
  count(*) FILTER (WHERE value <> '') AS n_full, CAST(count(*) FILTER (WHERE norm IS NOT NULL) AS BIGINT) AS decimals,
  bool_or(coalesce(contains(norm, '.') AND NOT regexp_matches(norm, '\\.0+$'), false)) AS fraction,
  bool_or(coalesce(TRY_CAST(norm AS DOUBLE) < 0 AND (NOT contains(norm, '.') OR regexp_matches(norm, '\\.0+$') OR floor(abs(TRY_CAST(norm AS DOUBLE))) > 0), false)) AS negative,
  bool_or(n_rows > 1) AS repeated, bool_and(TRY_STRPTIME(value, '%Y-%m-%d %H:%M:%S') IS NOT NULL) AS stamps,
  CASE WHEN count(*) = 2 THEN list_sort(list(lower(value))) END AS two, bool_and(regexp_matches(value, '^-?[0-9]+$')) AS numeric_only FROM v GROUP BY "col_name", length, class),
u AS (SELECT *, CASE WHEN length = 0 THEN 'Empty' WHEN zeros THEN 'ZerosOnly' WHEN stamps THEN 'DateTime'
  WHEN two IN (['0', '1'], ['n', 'y'], ['f', 't'], ['no', 'si'], ['n', 's'], ['f', 'v']) OR (n_values = 1 AND two IS NULL AND length = 1 AND class = 'ALPHA' AND false) THEN 'Boolean'
  WHEN class = 'EMAIL' THEN 'Email' WHEN decimals >= 0.9 * n_full AND fraction THEN 'DecimalValue' WHEN negative THEN 'IntegerValue'
  WHEN code AND n_values >= CASE WHEN length > 1 THEN 2 ELSE 3 END THEN CASE WHEN all_digits THEN 'NumericCode' WHEN all_letters THEN 'TextCode' WHEN some_letter AND some_digit THEN 'AlphaNumericCode' ELSE 'FreeText' END
  WHEN all_letters THEN 'TextCode' WHEN code AND some_letter AND some_digit THEN 'AlphaNumericCode'
  WHEN NOT some_letter AND decimals >= 0.9 * n_full THEN 'NumericCode' WHEN repeated THEN 'StandardText' ELSE 'FreeText' END AS first_use FROM f)
{select}"""


def columns(table: str, select: str) -> str:
    """With table d: column, full_content_type, data_type. Further steps that change uses: codes for single values, and numeric
    columns whose lengths are spread out."""
    abbreviations = "CASE list_extract(real, 1) WHEN 'AlphaNumericCode' THEN 'AC' WHEN 'NumericCode' THEN 'NC' WHEN 'TextCode' THEN 'TC' WHEN 'IntegerValue' THEN 'IV' WHEN 'DecimalValue' THEN 'DV' WHEN 'DateTime' THEN 'DT' WHEN 'Boolean' THEN 'BO' WHEN 'Email' THEN 'EM' WHEN 'StandardText' THEN 'ST' ELSE 'XX' END"
    return uses(
        table,
        f""", c AS (SELECT *, n_values = 1 AS unit, coalesce(bool_and(first_use LIKE '%Code') FILTER (WHERE n_values > 1 AND first_use NOT IN ('Empty', 'ZerosOnly')) OVER (PARTITION BY "col_name"), false) AS all_code FROM u),
c2 AS (SELECT *, CASE WHEN all_code AND unit AND first_use NOT IN ('Empty', 'ZerosOnly') THEN CASE class WHEN 'ALPHANUM' THEN 'AlphaNumericCode' WHEN 'NUMERIC' THEN 'NumericCode' ELSE 'TextCode' END ELSE first_use END AS use2 FROM c),
h AS (SELECT "col_name", length, sum(n_values) AS n FROM c2 WHERE NOT unit AND use2 NOT IN ('Empty', 'ZerosOnly') GROUP BY ALL),
hp AS (SELECT *, n / sum(n) OVER (PARTITION BY "col_name") AS p FROM h),
hs AS (SELECT "col_name", CASE WHEN count(*) < 2 THEN 0.0 ELSE -sum(p * log2(p)) / log2(count(*)) * (count(*) - 1) / 9 + CASE min(length) WHEN 1 THEN 0.4 WHEN 2 THEN 0.2 WHEN 3 THEN 0.1 ELSE 0 END END AS rate FROM hp GROUP BY 1),
e AS (SELECT "col_name", bool_or(regexp_matches(value, '[A-Za-z]')) AS letters, sum(n_rows) FILTER (WHERE norm IS NOT NULL) / sum(n_rows) AS share, bool_or(coalesce(contains(norm, '.') AND NOT regexp_matches(norm, '\\.0+$'), false)) AS frac FROM v WHERE value <> '' GROUP BY 1),
g AS (SELECT c2.*, CASE WHEN NOT letters AND rate > 0.3 AND share >= 0.95 AND NOT bool_or(NOT unit AND use2 = 'DateTime') OVER (PARTITION BY c2."col_name")
  AND NOT unit AND use2 NOT IN ('Empty', 'ZerosOnly') AND (use2 IN ('NumericCode', 'IntegerValue', 'DecimalValue') OR numeric_only) THEN CASE WHEN frac THEN 'DecimalValue' ELSE 'IntegerValue' END ELSE use2 END AS use
  FROM c2 LEFT JOIN hs ON c2."col_name" = hs."col_name" LEFT JOIN e ON c2."col_name" = e."col_name"),
k AS (SELECT "col_name", list_sort(list_distinct(list(use))) AS uses, max(length) AS longest, min(length) FILTER (WHERE use = 'Boolean') AS b_min, max(length) FILTER (WHERE use = 'Boolean') AS b_max, bool_and(class = 'NUMERIC') FILTER (WHERE use = 'Boolean') AS digits,
  max(length - CASE WHEN numeric_only AND negative THEN 1 ELSE 0 END) AS effective FROM g GROUP BY 1),
r AS (SELECT *, list_filter(uses, lambda x: x NOT IN ('Empty', 'ZerosOnly')) AS real FROM k),
d AS (SELECT "col_name", CASE WHEN len(real) = 0 THEN 'ND' WHEN list_contains(real, 'FreeText') THEN 'FT[' || longest || ']'
  WHEN len(list_filter(real, lambda x: x NOT IN ('DecimalValue', 'IntegerValue', 'NumericCode'))) = 0 AND list_contains(real, 'DecimalValue') THEN 'DV[' || longest || ']'
  WHEN len(list_filter(real, lambda x: x NOT LIKE '%Code')) = 0 AND len(real) > 1 THEN 'MC' WHEN list_contains(real, 'StandardText') THEN 'ST[' || longest || ']'
  WHEN len(real) = 1 THEN {abbreviations} || '[' || longest || ']' ELSE 'MIX[' || longest || ']' END AS full_content_type,
  CASE WHEN len(real) = 0 THEN NULL WHEN real = ['DateTime'] THEN 'DATETIME'
  WHEN len(list_filter(real, lambda x: x NOT IN ('DecimalValue', 'IntegerValue', 'NumericCode'))) = 0 THEN CASE WHEN list_contains(real, 'DecimalValue') THEN 'DECIMAL(38,10)' WHEN effective <= 6 THEN 'INT' ELSE 'BIGINT' END
  WHEN real = ['Boolean'] THEN CASE WHEN digits THEN 'INT' WHEN b_min = b_max AND b_max <= 10 THEN 'CHAR(' || b_max || ')' ELSE 'VARCHAR(' || b_max || ')' END
  ELSE 'VARCHAR(' || CASE WHEN longest <= 5 THEN 5 WHEN longest <= 20 THEN 20 WHEN longest <= 50 THEN 50 WHEN longest <= 100 THEN 100 WHEN longest <= 150 THEN 150 ELSE 250 END || ')' END AS data_type FROM r)
{select}""",
    )


def correlated(table: str, names: tuple[str, ...], select: str) -> str:
    """With table p: pairs of values with the same rows."""
    key = names[0]
    parts = " UNION ALL ".join(f"SELECT {key} AS id, '{c}' AS c, {cell(table, c)} AS v FROM {table}" for c in names)
    return f"""WITH s AS (SELECT c, v, count(*) AS n, list_sort(list(id)) AS ids FROM ({parts}) WHERE v <> '' GROUP BY c, v),
p AS (SELECT a.c AS x_column, a.v AS x_value, b.c AS y_column, b.v AS y_value, CAST(a.n AS BIGINT) AS n_rows FROM s a JOIN s b ON a.ids = b.ids AND a.c < b.c)
{select}"""
