"""Profiles of many tables in one pass: every step is one job over all of them, and their documents are written by Spark.

A table's name goes with its columns through cells, value counts, groups, columns and keys. So the number of jobs does not depend on
how many tables there are, hot tables are shared out like hot columns, and nothing of a table reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ProfileConfig
from ..functions.text import b64_hash, trimmed
from ..operators import cells, columns, discovery, groups, keys, naming
from ..operators.slim import slim_documents, write_documents
from ..sources.xlsx import workbook_rows
from ..storage import Stored

#: Between a table's name and a column's, where both are one name for the operators that work by column.
SEPARATOR = "\u0001"


@dataclass
class Tables:
    """cells (table, row, ord, col_name, value) that aren't empty, columns (table, ord, col_name), rows (table, total_rows)."""

    cells: DataFrame
    columns: DataFrame
    rows: DataFrame

    @staticmethod
    def of(frames: dict[str, DataFrame]) -> Tables:
        """DataFrames by name."""
        spark = next(iter(frames.values())).sparkSession
        parts, sizes = [], []
        for name, df in frames.items():
            text = cells.text_table(df).withColumn("_row", F.monotonically_increasing_id())
            own = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("col_name"), cells.trimmed_cell(f).alias("value")) for i, (c, f) in enumerate(zip(df.columns, df.schema.fields, strict=True))])
            parts.append(text.select(F.lit(name).alias("table"), F.col("_row").alias("row"), F.explode(own).alias("c")).select("table", "row", "c.*").where("value <> ''"))
            sizes.append(df.agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("table"), "total_rows"))
        header = spark.createDataFrame([(t, i, c) for t, df in frames.items() for i, c in enumerate(df.columns)], "table string, ord int, col_name string")
        return Tables(_union(parts), header, _union(sizes))

    @staticmethod
    def of_workbooks(spark: SparkSession, path: str) -> Tables:
        """All spreadsheets below a path, each by its file's name; a file is read once, by one task, and written as rows."""
        rows = Stored(workbook_rows(spark, path).withColumn("table", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.xlsx$", "")), "batch-rows").df
        pairs = rows.select("table", "row", F.explode("cells").alias("col_name", "value"))
        header = pairs.where("row = 0").select("table", F.col("value").cast("int").alias("ord"), "col_name")
        values = pairs.where("row > 0").join(header, ["table", "col_name"]).select("table", "row", "ord", "col_name", _cell("value"))
        sizes = rows.groupBy("table").agg(F.count_if(F.col("row") > 0).alias("total_rows"))
        return Tables(values.where("value <> ''"), header, sizes)


def _cell(c: str) -> Column:
    from pyspark.sql.types import StringType

    from ..functions.text import cell_text

    return trimmed(cell_text(F.col(c), StringType())).alias("value")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_counts(tables: Tables) -> DataFrame:
    """``cells.value_counts`` of all tables, the table's name before the column's; empty cells are what rows lack."""
    name = F.concat_ws(SEPARATOR, "table", "col_name").alias("col_name")
    full = tables.cells.groupBy("table", "ord", "col_name", "value").agg(F.count("*").alias("n_rows"))
    filled = full.groupBy("table", "col_name").agg(F.sum("n_rows").alias("filled"))
    empty = tables.columns.join(tables.rows, "table").join(filled, ["table", "col_name"], "left").withColumn("n_rows", F.col("total_rows") - F.coalesce("filled", F.lit(0)))
    empty = empty.where("n_rows > 0").select("table", "ord", "col_name", F.lit("").alias("value"), "n_rows")
    return full.unionByName(empty).select("ord", name, "value", "n_rows")


def apart(df: DataFrame) -> DataFrame:
    """Table and column as two columns again."""
    parts = F.split("col_name", SEPARATOR)
    return df.withColumns({"table": parts[0], "col_name": parts[1]})


@dataclass
class Profiles:
    """What was found in all tables: a row for each column in ``columns``, for each group in ``groups``, for each table in ``meta``."""

    value_counts: DataFrame
    groups: DataFrame
    columns: DataFrame
    top: DataFrame
    meta: DataFrame


def profile_tables(tables: Tables, config: ProfileConfig = DEFAULT, live: bool = False) -> Profiles:
    """Profiles of all tables. meta has (table, total_rows, rows_with_data, total_columns, key_columns, dt_struct_code, with_dash,
    no_dash, struct_code, b64url_code, data_repo, tcode, segments, columns_by_type, date_orders)."""
    vc = Stored(value_counts(tables), "batch-counts").df
    found = Stored(groups.profile_groups(vc, config, live), "batch-groups").df
    cols = Stored(columns.profile_columns(found, config), "batch-columns").df
    uses = apart(keys.main_uses(found, config)).select("table", "ord", "col_name", "main_use")
    key = Stored(keys.find_keys(tables.cells, uses, config), "batch-keys").df
    by = apart(cols)
    data = tables.cells.select("table", "row").distinct().groupBy("table").agg(F.count("*").alias("rows_with_data"))
    many = tables.columns.groupBy("table").agg(F.count("*").alias("total_columns"))
    structure = columns.type_structures(by, key)
    with_dash, no_dash = columns.abbreviated(F.col("dt_struct_code"))
    content = columns.content_structures(by, key)
    kinds = by.groupBy("table", F.coalesce("data_type", F.lit("Unknown")).alias("data_type")).agg(F.sort_array(F.collect_list("col_name")).alias("names"))
    kinds = kinds.groupBy("table").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("data_type", "names")))).alias("columns_by_type"))
    orders = apart(groups.date_orders(vc, config)).where("date_order is not null").groupBy("table").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("col_name", F.struct(F.col("date_order").alias("order"), "confidence"))))).alias("date_orders"))
    code, segments = naming.parsed_file_name(F.concat(F.col("table"), F.lit(".xlsx")))
    kept = _segments(tables, vc, segments)
    meta = tables.rows.join(many, "table", "left").join(data, "table", "left").join(key, "table", "left").join(structure, "table", "left").join(content, "table", "left").join(kinds, "table", "left").join(orders, "table", "left").join(kept, "table", "left")
    meta = meta.select(
        "table", "total_rows", F.coalesce("rows_with_data", F.lit(0)).cast("long").alias("rows_with_data"), F.coalesce("total_columns", F.lit(0)).cast("long").alias("total_columns"), F.coalesce("key_columns", F.array().cast("array<string>")).alias("key_columns"),
        "dt_struct_code", with_dash.alias("with_dash"), no_dash.alias("no_dash"), "struct_code", "b64url_code", b64_hash(no_dash, 8).alias("data_repo"), code.alias("tcode"), "segments", "columns_by_type", "date_orders",
    )
    return Profiles(vc, found, cols, cells.top_values(vc, config), meta)


def _segments(tables: Tables, vc: DataFrame, segments: Column) -> DataFrame:
    """(table, segments): what file names say beyond what a constant column of the same name says."""
    said = tables.rows.select("table", F.explode(segments).alias("key", "value"))
    constant = apart(vc).groupBy("table", "col_name").agg(F.count("*").alias("n"), F.min("value").alias("value")).where("n = 1").select("table", F.lower("col_name").alias("low"), "value").distinct()
    left = said.withColumn("low", F.lower("key")).join(constant, ["table", "low", "value"], "left_anti")
    return left.groupBy("table").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("segments"))


# ---------------------------------------------------------------- documents


def _full(c: Column, empty: str) -> Column:
    """Null where there is nothing, so that JSON leaves it out."""
    return F.when(F.size(c) > 0, c) if empty == "list" else F.when(c != "", c)


def profile_documents(p: Profiles) -> DataFrame:
    """(table, data_repo, document): the full profile of each table as JSON, ``__meta__`` first, nothing that is empty."""
    shape = apart(p.groups).select("table", "col_name", "unit", "length", "class", F.struct(F.col("length").alias("charLength"), "class", F.col("n_values").alias("totalCount"), F.array("use").alias("possibleUses"), F.col("numeric_only").alias("numericOnly"), F.col("from_sign").alias("charLenFromNegSign")).alias("g"))
    # As many groups as a column has lengths and classes.
    listed = lambda cond: _full(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("length", "class", "g")))), lambda s: s["g"]), "list")
    shape = shape.groupBy("table", "col_name").agg(listed(~F.col("unit")).alias("lengthGroups"), listed(F.col("unit")).alias("ungroupable"))
    top = apart(p.top).groupBy("table", "col_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value", "share"))), lambda s: F.struct(s["value"].alias("v"), s["share"].alias("p"))).alias("top10freq"))
    cols = apart(p.columns).join(shape, ["table", "col_name"], "left").join(top, ["table", "col_name"], "left")
    body = F.struct("ord", _full(F.col("uses"), "list").alias("uses"), "max_length", "full_content_type", "content_type", "data_type", "lengthGroups", "ungroupable", "top10freq")
    named = cols.groupBy("table").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("ord", "col_name", body.alias("body")))), lambda s: F.struct(s["col_name"].alias("key"), s["body"].alias("value")))).alias("columns"))
    m = p.meta
    text = lambda c: _full(F.col(c), "text")
    head = F.struct(
        F.col("total_rows").alias("totalRows"), F.col("rows_with_data").alias("rowsWithData"), F.col("total_columns").alias("totalColumns"), _full(F.col("key_columns"), "list").alias("keyColumns"), text("tcode").alias("tcode"), F.col("segments").alias("segmentFields"),
        text("dt_struct_code").alias("dtStructCode"), F.struct(text("with_dash").alias("withDash"), text("no_dash").alias("noDash")).alias("abrDtStruct"), text("struct_code").alias("structCode"), text("b64url_code").alias("b64urlCode"), F.col("data_repo").alias("dataRepo"), F.col("date_orders").alias("dateOrderByColumn"), F.col("columns_by_type").alias("columnsByDataType"),
    )
    whole = F.struct(head.alias("__meta__"), F.lit(".knfo").alias("extension"), F.coalesce("columns", F.create_map().cast("map<string, struct<ord:int,uses:array<string>,max_length:int,full_content_type:string,content_type:string,data_type:string,lengthGroups:array<struct<charLength:bigint,class:string,totalCount:bigint,possibleUses:array<string>,numericOnly:boolean,charLenFromNegSign:boolean>>,ungroupable:array<struct<charLength:bigint,class:string,totalCount:bigint,possibleUses:array<string>,numericOnly:boolean,charLenFromNegSign:boolean>>,top10freq:array<struct<v:string,p:double>>>>")).alias("columns"))
    return m.join(named, "table", "left").select("table", "data_repo", F.to_json(whole).alias("document"))


def profile_folder(spark: SparkSession, folder: str, out: str, files: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """Profile the pending spreadsheets of ``folder`` (of ``files`` (path, size), by ``discovery.pending``) in one pass, write their full and
    slim documents below ``out``, and give (table, key_columns, total_rows). Registry keys of earlier runs lie in ``<out>/registry``.

    Spark reads, profiles and writes all files together and repeats what fails; a run that is broken off leaves no document
    behind, and its files stay pending.
    """
    wanted = discovery.pending(files, config=config).select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[A-Za-z0-9]+$", "").alias("table"))
    tables = Tables.of_workbooks(spark, folder)
    tables = Tables(*(t.join(wanted, "table", "left_semi") for t in (tables.cells, tables.columns, tables.rows)))
    found = profile_tables(tables, config)
    documents = Stored(profile_documents(found), "batch-documents").df
    registry = None
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/registry")
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        registry = spark.read.parquet(f"{out}/registry")
    slim, after = slim_documents(documents.select("table", "document"), registry)
    write_documents(documents, out, "knfo")
    write_documents(slim, out, "meta")
    after.write.mode("overwrite").parquet(f"{out}/registry")
    return found.meta.select("table", "key_columns", "total_rows")
