"""The representation everything is built on: cells, and counts of distinct values by column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, ProfileConfig
from ..functions.text import blank_edged, cell_text, trimmed


def text_table(df: DataFrame) -> DataFrame:
    """All columns as cell texts."""
    return df.select(*[cell_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def trimmed_cell(field: T.StructField) -> Column:
    """A cell's text in ``text_table``, trimmed; texts of numbers, dates and truth values have nothing to trim."""
    bare = isinstance(field.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType))
    c = F.col(f"`{field.name}`")
    return c if bare else F.when(blank_edged(c), trimmed(c)).otherwise(c)


def cells(df: DataFrame) -> DataFrame:
    """(ord, col_name, value): a row for each cell, value trimmed; ord is the column's position. No null."""
    text = text_table(df)
    parts = [F.struct(F.lit(i).alias("ord"), F.lit(c).alias("col_name"), trimmed_cell(f).alias("value")) for i, (c, f) in enumerate(zip(df.columns, df.schema.fields, strict=True))]
    return text.select(F.explode(F.array(*parts)).alias("c")).select("c.*") if parts else df.sparkSession.createDataFrame([], "ord int, col_name string, value string")


def value_counts(df: DataFrame) -> DataFrame:
    """(ord, col_name, value, n_rows): distinct trimmed texts of each column."""
    return cells(df).groupBy("ord", "col_name", "value").agg(F.count("*").alias("n_rows"))


def column_stats(vc: DataFrame) -> DataFrame:
    """(col_name, non_empty, distinct_values, total) from value counts."""
    full = F.col("value") != ""
    return vc.groupBy("col_name").agg(F.coalesce(F.sum(F.when(full, F.col("n_rows"))), F.lit(0)).alias("non_empty"), F.count_if(full).alias("distinct_values"), F.sum("n_rows").alias("total"))


def row_counts(df: DataFrame) -> DataFrame:
    """(total_rows, rows_with_data): a row has data if any cell isn't empty."""
    text = text_table(df)
    some = F.exists(F.array(*[trimmed(F.col(f"`{c}`")) for c in df.columns]), lambda x: x != "")
    return text.agg(F.count("*").alias("total_rows"), F.count_if(some).alias("rows_with_data"))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    text = F.array(*[trimmed(cell_text(F.col(f"`{f.name}`"), f.dataType)) for f in df.schema.fields])
    return df.where(F.exists(text, lambda x: x != ""))


def top_values(vc: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(col_name, rank, value, share): the most frequent values that aren't empty, ties by value."""
    full = vc.where(F.col("value") != "")
    total = full.groupBy("col_name").agg(F.sum("n_rows").alias("total"))
    best = Window.partitionBy("col_name").orderBy(F.desc("n_rows"), "value")
    ranked = full.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= config.top_values)
    return ranked.join(total, "col_name").select("col_name", "rank", "value", (F.col("n_rows") / F.col("total")).alias("share"))


def value_runs(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(*keys, first, last): the runs of successive whole numbers of each key, a row each.

    Numbers are joined within blocks of 2**16 first; runs that touch a block's border go on to blocks of 2**32, then 2**48, then to
    their key. A block gets two runs at most from each of the 2**16 below, so no window holds more, however many numbers a key has.
    """
    one = df.select(*keys, F.col(number).cast("long").alias("first")).where("first is not null").distinct()
    runs, done = one.withColumn("last", F.col("first")), None
    for bits in (16, 32, 48, 64):
        block = F.shiftright("first", bits) if bits < 64 else F.lit(0).cast("long")
        order = Window.partitionBy(*keys, "block").orderBy("first")
        split = F.coalesce(F.lag("last").over(order) + 1 < F.col("first"), F.lit(True))
        marked = runs.withColumn("block", block).withColumn("new", split.cast("int"))
        joined = marked.withColumn("run", F.sum("new").over(order)).groupBy(*keys, "block", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        edge = (F.shiftleft(F.shiftright("first", bits), bits) == F.col("first")) | (F.shiftright("last", bits) != F.shiftright(F.col("last") + F.when(F.col("last") < 2**63 - 1, 1).otherwise(0), bits)) if bits < 64 else F.lit(False)
        closed = joined.where(~edge).select(*keys, "first", "last")
        done = closed if done is None else done.unionByName(closed)
        runs = joined.where(edge).select(*keys, "first", "last")
    return done


def compressed_ranges(df: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The runs of each key as one text like 3-6,9 in order, for a report: the text is as long as the key has runs."""
    text = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", F.col("first").cast("string"), F.col("last").cast("string")))
    ordered = F.array_sort(F.collect_list(F.struct("first", text.alias("t"))))
    return value_runs(df, keys, number).groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), ",").alias("ranges"))


def value_positions(df: DataFrame, row_key: list[str]) -> DataFrame:
    """(col_name, value, row): where each text that isn't empty occurs; ``row_key`` names the columns that tell rows apart."""
    text = text_table(df)
    key = F.concat_ws("\u0001", *[F.col(f"`{c}`") for c in row_key])
    parts = F.array(*[F.struct(F.lit(c).alias("col_name"), trimmed(F.col(f"`{c}`")).alias("value")) for c in df.columns])
    return text.select(key.alias("row"), F.explode(parts).alias("c")).select("c.col_name", "c.value", "row").where("value <> ''")
