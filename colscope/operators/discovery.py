"""What is to be profiled: pending files, orphans, admission, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ProfileConfig


def base_name(path: Column) -> Column:
    return F.lower(F.regexp_replace(F.substring_index(path, "/", -1), r"\.[A-Za-z0-9]+$", ""))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1))


def by_pattern(files: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """The files whose path has one of the patterns, case counting; all without patterns."""
    if not config.file_patterns:
        return files
    wanted = F.lit(False)
    for p in config.file_patterns:
        wanted = wanted | F.contains("path", F.lit(p))
    return files.where(wanted)


def in_context(files: DataFrame, context: str) -> DataFrame:
    return files.where(F.lower("path").contains(context.lower()))


def existing(files: DataFrame, kind: str) -> DataFrame:
    """(base) of the files of an extension that have more than two bytes."""
    return files.where((extension(F.col("path")) == kind) & (F.col("size") > 2)).select(base_name(F.col("path")).alias("base")).distinct()


def pending(files: DataFrame, processed: DataFrame | None = None, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(path, size, base): spreadsheets without both documents, largest first. ``processed`` (base) are left out unless only the
    slim document is missing."""
    sheets = by_pattern(files.where(extension(F.col("path")) == ".xlsx"), config).withColumn("base", base_name(F.col("path")))
    profile, meta = existing(files, ".knfo"), existing(files, ".meta")
    left = sheets.join(profile.join(meta, "base", "left_semi"), "base", "left_anti")
    if processed is not None:
        half = left.join(profile, "base", "left_semi")
        left = left.join(processed.select("base").distinct(), "base", "left_anti").unionByName(half).distinct()
    return left.select("path", "size", "base").orderBy(F.desc("size"), "path")


def half_done(files: DataFrame) -> DataFrame:
    """(base) of profiles without a slim document."""
    return existing(files, ".knfo").join(existing(files, ".meta"), "base", "left_anti")


def orphans(files: DataFrame) -> DataFrame:
    """(base) of profiles with neither a slim document nor a spreadsheet."""
    sheets = files.where(extension(F.col("path")) == ".xlsx").select(base_name(F.col("path")).alias("base")).distinct()
    return half_done(files).join(sheets, "base", "left_anti")


def admission(files: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(context, path, size_mb, large, batch): a large file is a batch of its own, small ones go some at a time, large first."""
    large = F.col("size_mb") >= config.large_file_mb
    rows = files.withColumn("large", large)
    n = F.row_number().over(Window.partitionBy("context", "large").orderBy(F.desc("size_mb"), "path"))
    total = F.count_if("large").over(Window.partitionBy("context"))
    batch = F.when(F.col("large"), n).otherwise(total + F.ceil(n / config.small_files))
    return rows.select("context", "path", "size_mb", "large", batch.cast("long").alias("batch"))


def retry_ledger(attempts: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(path, failures, skip) from (path, at, ok, seconds, size_mb): failures since the last success, in order of ``at``.

    An attempt that took longer than its file's size allows has failed. Attempts at one time count as one success if any is.
    """
    limit = F.when(F.col("size_mb") >= config.large_file_mb, config.large_seconds).otherwise(config.small_seconds)
    fine = F.coalesce(F.col("ok") & (F.col("seconds") <= limit), F.lit(False))
    by_time = attempts.groupBy("path", "at").agg(F.bool_or(fine).alias("fine"), F.count_if(~fine).alias("n"))
    last = by_time.groupBy("path").agg(F.max(F.when(F.col("fine"), F.col("at"))).alias("last"))
    failed = (~F.col("fine")) & (F.col("last").isNull() | (F.col("at") > F.col("last")))
    sums = by_time.join(last, "path").groupBy("path").agg(F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("failures"))
    return sums.select("path", "failures", (F.col("failures") >= config.most_failures).alias("skip"))


def monitored_files(spark, path: str) -> DataFrame:
    """(path, name, extension, size) of a monitor's JSON document, a map from path to attributes; no rows where it is missing or
    isn't such a document."""
    text = spark.read.text(path, wholetext=True)
    attributes = "map<string, struct<nombre:string, extension:string, `tamaño`:long, fecha_creacion:string, fecha_modificacion:string, ruta_relativa:string>>"
    found = text.select(F.from_json("value", attributes).alias("m")).where("m is not null")
    return found.select(F.explode("m").alias("path", "a")).select("path", F.col("a.nombre").alias("name"), F.col("a.extension").alias("extension"), F.col("a.tamaño").alias("size"))


def segments_kept(segments: DataFrame, vc: DataFrame) -> DataFrame:
    """(key, value) segments of a file name, less those that a column of the same name says in every row."""
    constant = vc.groupBy("col_name").agg(F.count("*").alias("n"), F.min("value").alias("value")).where("n = 1").select(F.lower("col_name").alias("k"), F.col("value").alias("v"))
    return segments.join(constant, (F.lower("key") == F.col("k")) & (F.col("value") == F.col("v")), "left_anti")


def list_files(spark, path: str) -> DataFrame:
    """(path, size) of all files below a folder, their contents unread."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))


def status(files: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(state, n_files) of spreadsheets: pending or done."""
    sheets = by_pattern(files.where(extension(F.col("path")) == ".xlsx"), config).select(base_name(F.col("path")).alias("base")).distinct()
    waiting = pending(files, config=config).select("base", F.lit("pending").alias("state"))
    return sheets.join(waiting, "base", "left").groupBy(F.coalesce("state", F.lit("done")).alias("state")).agg(F.count("*").alias("n_files"))
