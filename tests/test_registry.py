"""Short keys of many tables against taking aliases one by one; exact sets of rows; runs of numbers by levels."""

import random

from colscope.operators import cells, correlate
from colscope.operators.naming import _options, numbered_headers, short_keys
from colscope.operators.registry import unique_short_keys

HEADERS = "code string, table string, ord int, header string"


def one_by_one(rows, registry):
    """Aliases in order of tables and columns, each taking its first free key."""
    held = {(c, a): k for c, a, k in registry}
    used = {(c, k) for c, _, k in registry}
    tables = {}
    for code, table, _, header in sorted(rows):
        tables.setdefault((code, table), []).append(header)
    normal = {t: numbered_headers(h) for t, h in tables.items()}
    first = {}
    for code, table, order, header in rows:
        alias = normal[code, table][header].split("#")[0]
        first[code, alias] = min(first.get((code, alias), ("~",)), (table, order, header))
    for (code, alias), (_, _, header) in sorted(first.items(), key=lambda x: (x[0][0], x[1])):
        if (code, alias) not in held:
            held[code, alias] = next(k for k in _options(alias, header) if (code, k) not in used)
            used.add((code, held[code, alias]))
    return held


def test_keys_of_all_tables_as_if_one_by_one(spark):
    r = random.Random(6)
    words = ["posting", "row", "date", "amount", "Ámount", "qty", "no.", "code", "2nd", "x"]
    rows = [(f"T{t % 2}", f"table{t}", i, " ".join(r.choice(words) for _ in range(r.randrange(1, 4))) + f"::{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'[i]}") for t in range(6) for i in range(24)]
    registry = [("T0", "amounts", "amount"), ("T0", "posting_row", "zzzzzz"), ("T1", "old", "postin")]
    keys, after = unique_short_keys(spark.createDataFrame(rows, HEADERS), spark.createDataFrame(registry, "code string, alias string, key string"))
    found = {(x.code, x.alias): x.key for x in after.collect()}
    assert found == one_by_one(rows, registry)
    assert len({(c, k) for (c, _), k in found.items()}) == len(found)
    own = keys.collect()
    assert len(own) == len(rows) and all(len(x.key) == 6 for x in own)
    for table in {x.table for x in own}:
        mine = [x.key for x in own if x.table == table]
        assert len(set(mine)) == len(mine)
    for x in own:
        if "#" not in x.normalized or x.normalized.endswith("#1"):
            assert x.key == found[x.code, x.alias]
    # A second file under the same code: aliases keep their keys, new ones clash with none.
    more = [("T0", "later", i, h) for i, h in enumerate(["amount", "amount total", "posting row", "posting row", "Posting  Row", "brand new"])]
    keys2, after2 = unique_short_keys(spark.createDataFrame(more, HEADERS), after)
    second = {(x.code, x.alias): x.key for x in after2.collect()}
    assert second.items() >= found.items() and len({(c, k) for (c, _), k in second.items()}) == len(second)
    repeats = [x.key for x in keys2.where("alias = 'posting_row'").orderBy("ord").collect()]
    assert repeats == ["zzzzzz", "zzzzz2", "zzzzz3"]
    empty = unique_short_keys(spark.createDataFrame([], HEADERS))
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_keys_of_one_document_follow_the_same_rules(spark):
    names = ["amount", "posting row", "posting_row", "Amount ", "é", "9"]
    registry = {"amounts": "amount", "posting_row": "prowxx"}
    got = short_keys(names, registry)
    assert got["posting row"] == "prowxx" and got["posting_row"] == "prowx2" and got["amount"] != "amount"
    keys, _ = unique_short_keys(spark.createDataFrame([("c", "t", i, h) for i, h in enumerate(names)], HEADERS), spark.createDataFrame([("c", a, k) for a, k in registry.items()], "code string, alias string, key string"))
    assert {x.header: x.key for x in keys.collect()} == got


def test_row_sets_are_exact(spark):
    """Dense and sparse sets, over several buckets and partitions; sets that differ in one row differ."""
    n = 69_999
    rows = [(str(i), "a" if i % 2 else "b", "x" if i % 2 else "y", "p" if i % 2 or i == 4 else "q", f"r{i}", f"s{i // 3}", "all", "") for i in range(n)]
    df = spark.createDataFrame(rows, "id string, m string, n string, o string, r string, s string, t string, e string").repartition(3)
    pairs = correlate.exact_pairs(correlate.row_sets(df, df.columns))
    by = {(x.x_column, x.y_column): x["count"] for x in pairs.groupBy("x_column", "y_column").count().collect()}
    assert by == {("id", "r"): n, ("m", "n"): 2}
    assert {(x.x_value, x.y_value, x.n_rows) for x in pairs.where("x_column = 'm'").collect()} == {("a", "x", n // 2), ("b", "y", n // 2 + 1)}
    assert correlate.exact_pairs(correlate.row_sets(df.limit(0), df.columns)).count() == 0


def test_runs_of_numbers_by_levels(spark):
    r = random.Random(3)
    far = 2**63
    numbers = {"hot": [*range(60_000, 70_000), *range(2**32 - 5, 2**32 + 5), *range(2**48 - 2, 2**48 + 2), -far, -far + 1, far - 1, far - 2, *range(-3, 4), 65536 * 7, 65536 * 7 - 1], "few": [r.randrange(40) for _ in range(30)], "none": [None]}
    rows = [(k, v) for k, vs in numbers.items() for v in vs] + [("few", 3), ("few", 3)]
    df = spark.createDataFrame(rows, "k string, v long")
    want = set()
    for k, vs in numbers.items():
        vs = sorted({v for v in vs if v is not None} | ({3} if k == "few" else set()))
        start = 0
        for i in range(len(vs)):
            if i + 1 == len(vs) or vs[i + 1] != vs[i] + 1:
                want.add((k, vs[start], vs[i]))
                start = i + 1
    got = cells.value_runs(df, ["k"], "v").collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert {x.k for x in cells.compressed_ranges(df, ["k"], "v").collect()} == {"hot", "few"}


def test_chains_from_sets_of_columns(spark):
    """The chains of all correlated pairs of values, without making the pairs."""
    rows = [(f"C{i % 7}", f"N{i % 7:03d}", f"name of {i % 7}", f"free text {i % 5} here", f"D{i % 5}", str(i)) for i in range(70)]
    df = spark.createDataFrame(rows, "code string, other string, label string, note string, tag string, id string")
    uses = spark.createDataFrame([("code", ["TextCode"]), ("other", ["AlphaNumericCode"]), ("label", ["StandardText"]), ("note", ["FreeText"]), ("tag", ["TextCode", "FreeText"]), ("id", ["NumericCode"])], "col_name string, uses array<string>")
    values = correlate.value_rows(df, df.columns, ["id"])
    want = {tuple(r) for r in correlate.correlation_chains(correlate.correlations(values, uses)).collect()}
    assert {tuple(r) for r in correlate.use_chains(values, uses).collect()} == want and ("code", "label>other") in want
