"""Correlations between values of a table: pairs of values that occur in exactly the same rows.

Each value's rows are summed up as a count and two sums of row hashes (``value_rows``), or held exactly as bitmaps by bucket
(``row_sets``), so that finding equal sets of rows is one equality join of distinct values, not a self-join of all cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import text_table

_RX = r"([\\^$.|?*+()\[\]{}])"


def value_rows(df: DataFrame, columns: list[str], row_key: list[str]) -> DataFrame:
    """(ord, col_name, value, n_rows, a, b): the texts that aren't empty and the signature of their rows. ``row_key`` names the
    columns that tell rows apart."""
    text = text_table(df)
    key = [F.col(f"`{c}`") for c in row_key]
    wide = text.select(F.xxhash64(*key).alias("h"), F.xxhash64(F.lit(1), *key).alias("g"), *[F.trim(F.col(f"`{c}`")).alias(c) for c in columns])
    parts = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("col_name"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(columns)])
    rows = wide.select("h", "g", F.explode(parts).alias("c")).select("h", "g", "c.*").where("value <> ''")
    sums = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    return rows.groupBy("ord", "col_name", "value").agg(F.count("*").alias("n_rows"), sums("h").alias("a"), sums("g").alias("b"))


def strict_pairs(values: DataFrame, left: list[str] | None = None, right: list[str] | None = None) -> DataFrame:
    """(x_column, x_value, y_column, y_value, n_rows): values of two columns with the same rows, the column with the lesser name
    as x where both may be either. ``left`` and ``right`` limit the columns of x and y."""
    side = lambda p, only: (values if only is None else values.where(F.col("col_name").isin(*only))).select(*[F.col(c).alias(f"{p}_{'column' if c == 'col_name' else c}") for c in ("col_name", "value", "n_rows", "a", "b")])
    x, y = side("x", left), side("y", right)
    pairs = x.join(y, (F.col("x_n_rows") == F.col("y_n_rows")) & (F.col("x_a") == F.col("y_a")) & (F.col("x_b") == F.col("y_b")))
    twice = left is None or right is None or bool(set(left) & set(right))
    pairs = pairs.where(F.col("x_column") < F.col("y_column") if twice else F.col("x_column") != F.col("y_column"))
    return pairs.select("x_column", "x_value", "y_column", "y_value", F.col("x_n_rows").alias("n_rows"))


#: Rows of a value in a bucket of 32768 from which they are held as a bitmap, not as a list of places.
DENSE = 256


def row_sets(df: DataFrame, columns: list[str]) -> DataFrame:
    """(ord, col_name, value, n_rows, rows): the texts that aren't empty and exactly the rows they occur in.

    Rows are numbered. Of each bucket of 32768 rows a value has a bitmap, or where it is in few of them, their places; equal ones
    of a bucket get the name of the least value that has them, and ``rows`` lists (bucket, name). So two values have
    equal ``rows`` if and only if they occur in the same rows, however many, and nothing rests on a hash.
    """
    text = text_table(df.select(*[f"`{c}`" for c in columns])).withColumn("_row", F.monotonically_increasing_id())
    parts = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("col_name"), F.trim(F.col(f"`{c}`")).alias("value")) for i, c in enumerate(columns)])
    places = text.select(F.bitmap_bucket_number("_row").alias("bucket"), F.bitmap_bit_position("_row").alias("place"), F.explode(parts).alias("c")).select("bucket", "place", "c.*").where("value <> ''")
    # A bucket's rows come from one scan, in order; a list is as long as DENSE, a bitmap 4096 bytes.
    own = ["ord", "col_name", "value", "bucket"]
    counts = places.groupBy(*own).agg(F.count("*").alias("n"))
    marked = places.join(counts, own)
    few = marked.where(F.col("n") < DENSE).groupBy(*own, "n").agg(F.array_join(F.array_sort(F.collect_list("place")), ",").cast("binary").alias("bits"))
    many = marked.where(F.col("n") >= DENSE).groupBy(*own, "n").agg(F.bitmap_construct_agg("place").alias("bits"))
    bits = few.unionByName(many)
    least = Window.partitionBy("bucket", "bits")  # values of one bucket with the same rows: one of each column at most
    named = bits.select("ord", "col_name", "value", "bucket", "n", F.min(F.struct("ord", "value")).over(least).alias("name"))
    return named.groupBy("ord", "col_name", "value").agg(F.sum("n").alias("n_rows"), F.array_sort(F.collect_list(F.struct("bucket", "name"))).alias("rows"))


def exact_pairs(sets: DataFrame) -> DataFrame:
    """(x_column, x_value, y_column, y_value, n_rows): values of two columns with the same rows, the column with the lesser name
    as x, from ``row_sets``; cells are not joined."""
    side = lambda p: sets.select(F.col("col_name").alias(f"{p}_column"), F.col("value").alias(f"{p}_value"), "n_rows", "rows")
    pairs = side("x").join(side("y"), ["n_rows", "rows"]).where("x_column < y_column")
    return pairs.select("x_column", "x_value", "y_column", "y_value", "n_rows")


def contains_value(x: Column, y: Column) -> Column:
    """Whether ``y`` contains ``x``; an ``x`` of one character must stand alone."""
    alone = F.concat(F.lit("(^|[^A-Za-z0-9])"), F.regexp_replace(x, _RX, r"\\$1"), F.lit("($|[^A-Za-z0-9])"))
    return F.when(F.length(x) == 1, F.regexp_like(y, alone)).otherwise(F.contains(y, x))


def contained_pairs(pairs: DataFrame) -> DataFrame:
    """The strict pairs in which y contains x."""
    return pairs.where(contains_value(F.col("x_value"), F.col("y_value")))


def correlations(values: DataFrame, uses: DataFrame) -> DataFrame:
    """(kind, x_column, x_value, y_column, y_value, n_rows) of code columns with standard, free and code columns.

    uses: (col_name, uses). The kinds are code_standard, code_free and code_code, each with _strict or _contained.
    """
    has = lambda name: F.exists("uses", lambda u: u.endswith("Code") if name == "code" else u == name)
    marked = uses.select("col_name", has("code").alias("code"), has("StandardText").alias("standard"), has("FreeText").alias("free"))
    rows = values.join(F.broadcast(marked), "col_name")  # as many rows as the table has columns
    side = lambda p: rows.select(*[F.col(c).alias(f"{p}_{'column' if c == 'col_name' else c}") for c in ("col_name", "value", "n_rows", "a", "b", "code", "standard", "free")])
    joined = side("x").where("x_code").join(side("y"), (F.col("x_n_rows") == F.col("y_n_rows")) & (F.col("x_a") == F.col("y_a")) & (F.col("x_b") == F.col("y_b")) & (F.col("x_column") != F.col("y_column")))
    other = F.when(F.col("y_code"), F.when(F.col("x_column") < F.col("y_column"), "code_code")).when(F.col("y_standard"), "code_standard").when(F.col("y_free"), "code_free")
    named = joined.withColumn("pairing", other).where("pairing is not null")
    kinds = F.array(F.lit("strict"), F.when(contains_value(F.col("x_value"), F.col("y_value")), "contained"))
    return named.withColumn("k", F.explode(F.filter(kinds, lambda k: k.isNotNull()))).select(F.concat_ws("_", "pairing", "k").alias("kind"), "x_column", "x_value", "y_column", "y_value", F.col("x_n_rows").alias("n_rows"))


def column_chains(values: DataFrame) -> DataFrame:
    """``correlation_chains`` of all strict pairs, without making the pairs: values with the same rows give sets of columns, and the
    different sets, as few as the header allows, give pairs of columns."""
    sets = values.groupBy("n_rows", "a", "b").agg(F.array_sort(F.collect_set("col_name")).alias("c")).where(F.size("c") > 1).select("c").distinct()
    pairs = sets.select(F.posexplode("c").alias("i", "x_column"), "c").select("x_column", F.explode(F.slice("c", F.col("i") + 2, F.size("c"))).alias("y_column")).distinct()
    return correlation_chains(pairs)


def use_chains(values: DataFrame, uses: DataFrame) -> DataFrame:
    """``correlation_chains`` of ``correlations``, from sets of columns that have values with the same rows, not from pairs of values:
    code columns go with standard and free ones, and with code columns of a greater name. ``uses`` is as small as the header."""
    sets = values.groupBy("n_rows", "a", "b").agg(F.array_sort(F.collect_set("col_name")).alias("c")).where(F.size("c") > 1).select("c").distinct()
    pairs = sets.select(F.explode("c").alias("x_column"), "c").select("x_column", F.explode("c").alias("y_column")).where("x_column <> y_column").distinct()
    has = lambda name: F.exists("uses", lambda u: u.endswith("Code") if name == "code" else u == name)
    side = lambda p: uses.select(F.col("col_name").alias(f"{p}_column"), has("code").alias(f"{p}_code"), (has("StandardText") | has("FreeText")).alias(f"{p}_text"))
    both = pairs.join(side("x"), "x_column").join(side("y"), "y_column").where("x_code")
    return correlation_chains(both.where(F.when(F.col("y_code"), F.col("x_column") < F.col("y_column")).otherwise(F.col("y_text"))))


def nested_pairs(pairs: DataFrame) -> DataFrame:
    """(x_column, x_value, others): the pairs of each x as a sorted list of (y_column, y_value, n_rows)."""
    return pairs.groupBy("x_column", "x_value").agg(F.array_sort(F.collect_list(F.struct("y_column", "y_value", "n_rows"))).alias("others"))


def correlation_chains(pairs: DataFrame) -> DataFrame:
    """(col_name, correlation_chain): the columns that a column's values go with, sorted, joined by >."""
    return pairs.groupBy(F.col("x_column").alias("col_name")).agg(F.array_join(F.array_sort(F.collect_set("y_column")), ">").alias("correlation_chain"))
