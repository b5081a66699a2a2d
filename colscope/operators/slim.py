"""Slim documents of many profiles at once, and documents as files."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import META_TYPE_ABBREVIATION
from ..functions.text import b64_hash, header_name_column
from ..storage import Stored
from .registry import unique_short_keys


def slim_documents(profiles: DataFrame, registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, data_repo, document) with the slim schema of each profile in ``profiles`` (table, document), and the registry after.

    Profiles are read as VARIANT, so they may differ in shape: a column's own fields stay as they are, but for its groups; columns
    without a type go. Short keys are unique by code, for all tables at once; ``registry`` (code, alias, key) holds those given.
    """
    v = profiles.select("table", F.try_parse_json("document").alias("v")).where("v is not null")
    get = lambda c, path, kind: F.try_variant_get(F.col(c), path, kind)
    head = v.select("table", F.coalesce(get("v", "$.__meta__.tcode", "string"), F.lit("")).alias("tcode"), F.coalesce(get("v", "$.__meta__.keyColumns", "array<string>"), F.array().cast("array<string>")).alias("keys"), get("v", "$.__meta__.segmentFields", "map<string,string>").alias("segments"), get("v", "$.__meta__.dtStructCode", "string").alias("dt_struct_code"), get("v", "$.__meta__.totalRows", "bigint").alias("total_rows"), get("v", "$.__meta__.rowsWithData", "bigint").alias("rows_with_data"))
    each = v.select("table", F.explode(get("v", "$.columns", "map<string,variant>")).alias("header", "c"))
    each = each.select("table", "header", "c", get("c", "$.ord", "int").alias("ord"), get("c", "$.data_type", "string").alias("data_type")).where("data_type is not null")
    each = Stored(each.join(head.select("table", "tcode", "keys"), "table").withColumn("pk", F.array_contains("keys", F.col("header"))), "slim-columns").df
    headers = each.select(F.col("tcode").alias("code"), "table", F.row_number().over(Window.partitionBy("table").orderBy(F.col("ord").asc_nulls_last(), "header")).alias("ord"), "header")
    short, after = unique_short_keys(headers, registry)
    named = each.join(short.select(F.col("code").alias("tcode"), "table", "header", "normalized", "key"), ["tcode", "table", "header"])
    place = F.when(F.col("pk"), F.array_position("keys", F.col("header"))).otherwise(F.lit(2**31))
    order = F.struct(place.alias("a"), "ord", "header")
    abbreviated = F.when(F.col("data_type").rlike(r"^VARCHAR\([0-9]+\)$"), F.concat(F.lit("VC"), F.regexp_extract("data_type", "([0-9]+)", 1))).otherwise(F.coalesce(F.try_element_at(_abbreviations(), F.col("data_type")), F.lit("UN")))
    prefix = F.when(F.col("pk"), F.lit("PK$")).otherwise("")
    tokens = named.select("table", order.alias("order"), F.concat(prefix, header_name_column(F.col("header")), F.lit("$"), "data_type").alias("long"), F.concat(prefix, abbreviated).alias("short"))
    signed = _signature(tokens, "long").join(_signature(tokens, "short"), "table")
    pairs = lambda a, b: F.map_from_entries(F.array_sort(F.collect_list(F.struct(a, b))))
    # A variant can't be sorted by, so its text goes along and becomes one again.
    own = F.to_json(F.map_filter(F.try_variant_get("c", "$", "map<string,variant>"), lambda k, _: ~k.isin("lengthGroups", "ungroupable")))
    lists = named.groupBy("table").agg(pairs("header", "key").alias("rep"), pairs("header", "normalized").alias("norm"), F.count("*").alias("n"), pairs("header", own.alias("own")).alias("own"))
    kinds = named.groupBy("table", "data_type").agg(F.sort_array(F.collect_list("header")).alias("names")).groupBy("table").agg(pairs("data_type", "names").alias("kinds"))
    both = head.join(lists, "table", "left").join(kinds, "table", "left").join(signed, "table", "left")
    known = F.filter("keys", lambda k: F.map_contains_key(F.coalesce("rep", F.create_map().cast("map<string,string>")), k))
    repo = b64_hash(F.coalesce("short", F.lit("0>")), 8)
    document = F.struct(
        "tcode", known.alias("keyColumns"), F.col("segments").alias("segmentFields"), F.transform_keys("segments", lambda k, _: header_name_column(k)).alias("segmentFieldsNorm"), F.col("dt_struct_code").alias("dtStructCode"), F.col("long").alias("signature"), F.col("short").alias("shortSignature"), repo.alias("dataRepo"),
        F.col("rep").alias("repKeyByColumn"), F.col("norm").alias("normHdrByColumn"), F.col("kinds").alias("columnsByDataType"), F.col("total_rows").alias("totalRows"), F.col("rows_with_data").alias("rowsWithData"), F.coalesce("n", F.lit(0)).alias("totalColumns"), F.transform_values("own", lambda _, x: F.try_parse_json(x)).alias("columns"),
    )
    return both.select("table", repo.alias("data_repo"), F.to_json(document).alias("document")), after


def _abbreviations() -> Column:
    return F.create_map(*[F.lit(x) for pair in META_TYPE_ABBREVIATION.items() for x in pair])


def _signature(tokens: DataFrame, kind: str) -> DataFrame:
    """(table, kind): ``n>token-token`` in order; equal tokens numbered."""
    nth = F.row_number().over(Window.partitionBy("table", kind).orderBy("order"))  # a table's equal tokens: as many as its columns at most
    numbered = tokens.withColumn("nth", nth)
    text = F.when(F.col("nth") > 1, F.concat_ws("#", kind, F.col("nth").cast("string"))).otherwise(F.col(kind))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("order", text.alias("t")))), lambda s: s["t"])
    return numbered.groupBy("table").agg(F.concat(F.count("*").cast("string"), F.lit(">"), F.array_join(listed, "-")).alias(kind))


def write_documents(documents: DataFrame, folder: str, kind: str) -> list[str]:
    """Documents (table, data_repo, document) as one file each: ``<folder>/<table>.knfo``, or slim ones as
    ``<folder>/meta/<data_repo>/<table>.meta``; their paths.

    Spark writes them all below a temporary name, and only then does each get its own by renaming; so a reader sees a document whole
    or not at all, and a run that is broken off leaves none.
    """
    spark = documents.sparkSession
    own = F.concat("table", F.lit(f".{kind}"))
    place = F.concat_ws("/", F.lit("meta"), "data_repo", own) if kind == "meta" else own
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    hidden = path(f"{folder}/_writing-{uuid.uuid4().hex}")
    documents.select(place.alias("place"), F.col("document").alias("value")).repartition("place").write.partitionBy("place").text(hidden.toString())
    out = []
    for made in files.listStatus(hidden):
        name = made.getPath().getName()
        if not name.startswith("place="):
            continue
        target = path(folder + "/" + unquote(name.removeprefix("place=")))
        files.mkdirs(target.getParent())
        if files.exists(target):
            files.delete(target, True)
        [part] = [f.getPath() for f in files.listStatus(made.getPath()) if f.getPath().getName().startswith("part-")]
        files.rename(part, target)
        out.append(target.toString())
    files.delete(hidden, True)
    return sorted(out)


def read_documents(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(table, document) of the documents below a folder, each a file or a folder of one part, of more than two bytes."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"{{*.{kind},part-*}}").load(folder).where(F.col("length") > 2)
    name = F.regexp_extract("path", rf"([^/]+)\.{kind}(/part-[^/]*)?$", 1)
    return found.select(name.alias("table"), F.decode("content", "UTF-8").alias("document")).where("table <> ''")
