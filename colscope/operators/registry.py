"""Short keys of columns for all tables at once, unique in their code's registry.

Every alias has a list of keys that it would take, best first. Aliases propose in rounds: a key that the registry holds refuses all,
any other keeps the first of its proposers (by table, then position) and sends the rest on to their next key. As all keys rank
aliases alike, this ends with what taking them one by one would give, whatever the number of rounds. Each round is a job over
the aliases that are new, and no alias reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import b64_hash
from ..storage import Stored
from .naming import normalized_headers, short_key_column

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _cleaned(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))


def key_options(alias: Column, header: Column) -> Column:
    """The keys an alias tries: from its letters, its letters and digits, stretches of its header's hash, then other last letters."""
    h = _cleaned(b64_hash(header, 8))
    stretches = F.when(F.length(h) >= 6, F.transform(F.sequence(F.lit(1), F.length(h) - 5), lambda i: F.substring(h, i, F.lit(6)))).otherwise(F.array().cast("array<string>"))
    first = F.array(short_key_column(alias), short_key_column(alias, digits=True))
    last = F.element_at(F.concat(first, stretches), -1)
    others = F.transform(F.split(F.lit(_LETTERS), ""), lambda ch: F.concat(F.substring(last, 1, 5), ch))
    return F.concat(first, stretches, F.filter(others, lambda k: F.length(k) == 6))


def _option(options: Column, header: Column, k: Column) -> Column:
    """Option number ``k``, from 0; beyond the list, stretches of further hashes, without end."""
    more = F.rpad(F.substring(_cleaned(b64_hash(F.concat_ws("#", header, k.cast("string")), 20)), 1, 6), 6, "x")
    return F.coalesce(F.get(options, k), more)


def _settled(names: DataFrame, taken: DataFrame, by: list[str], name: str) -> Stored:
    """(*names, key): the options of ``names`` (*by, prio, options, header) by rounds; ``taken`` (*by, key) are given away."""
    now = Stored(names.withColumns({"k": F.lit(0), "key": _option(F.col("options"), F.col("header"), F.lit(0)), "moved": F.lit(True)}), name)
    taken = taken.select(*by, "key").distinct().withColumn("held", F.lit(True))
    while now.df.where("moved").limit(1).count():
        best = now.df.groupBy(*by, "key").agg(F.min("prio").alias("best"))
        judged = now.df.join(best, [*by, "key"]).join(taken, [*by, "key"], "left")
        lost = F.col("held").isNotNull() | (F.col("prio") != F.col("best"))
        judged = judged.withColumns({"moved": lost, "k": F.when(lost, F.col("k") + 1).otherwise(F.col("k"))})
        judged = judged.withColumn("key", F.when(F.col("moved"), _option(F.col("options"), F.col("header"), F.col("k"))).otherwise(F.col("key")))
        after = Stored(judged.select(*now.df.columns), name)
        now.drop()
        now = after
    return now


def unique_short_keys(headers: DataFrame, registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Keys for all columns, and the registry after them, from ``headers`` (code, table, ord, header) and ``registry`` (code, alias, key).

    The keys are (code, table, ord, header, normalized, alias, key). An alias (the normalized name without ``#n``) keeps the key that
    the registry has for it, whichever table it comes from; others get one that no alias of the code has. The nth column
    of an alias in a table has the key's end replaced by n, or a letter before n where that is taken too. The second
    table is (code, alias, key) of all aliases, old and new.
    """
    spark = headers.sparkSession
    if registry is None:
        registry = spark.createDataFrame([], "code string, alias string, key string")
    registry = registry.select("code", "alias", "key")
    named = normalized_headers(headers.select("code", "table", "ord", "header"), by=["code", "table"])
    named = named.withColumns({"alias": F.regexp_replace("normalized", "#[0-9]+$", ""), "nth": F.coalesce(F.regexp_extract("normalized", "#([0-9]+)$", 1).try_cast("int"), F.lit(1))})
    columns = Stored(named, "registry-columns")
    first = columns.df.groupBy("code", "alias").agg(F.min(F.struct("table", "ord", "header")).alias("prio"))
    new = first.join(registry, ["code", "alias"], "left_anti").withColumn("header", F.col("prio.header"))
    new = new.withColumn("options", key_options(F.col("alias"), F.col("header")))
    settled = _settled(new.select("code", "alias", "prio", "header", "options"), registry, ["code"], "registry-keys")
    after = Stored(registry.unionByName(settled.df.select("code", "alias", "key")), "registry")
    settled.drop()
    # Columns beyond the first of an alias: keys of their table, beside all keys of the code.
    main = columns.df.join(after.df, ["code", "alias"])
    digits = F.col("nth").cast("string")
    core = lambda n: F.substring("key", F.lit(1), F.greatest(F.lit(0), F.lit(6) - F.length(digits) - n))
    ways = F.concat(F.array(F.concat(core(0), digits)), F.transform(F.split(F.lit(_LETTERS), ""), lambda ch: F.concat(core(1), ch, digits)))
    again = main.where("nth > 1").select("code", "table", "ord", F.struct("ord").alias("prio"), "header", ways.alias("options"))
    held = main.select("code", "table").distinct().join(after.df.select("code", "key"), "code")
    dups = _settled(again, held, ["code", "table"], "registry-repeats")
    keys = main.where("nth = 1").select("code", "table", "ord", "header", "normalized", "alias", "key")
    keys = keys.unionByName(main.drop("key").join(dups.df.select("code", "table", "ord", "key"), ["code", "table", "ord"]).select(*keys.columns))
    out = Stored(keys, "registry-result")
    columns.drop()
    dups.drop()
    return out.df, after.df
