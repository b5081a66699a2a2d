"""Key search by partition refinement, against brute force and on odd tables."""

import itertools
import random

from colscope.config import ProfileConfig
from colscope.operators import cells, groups, keys


def brute(rows, names, width):
    rows = list(dict.fromkeys(tuple("" if v is None else str(v).strip() for v in r) for r in rows))
    found = []
    for k in range(1, width + 1):
        for c in itertools.combinations(range(len(names)), k):
            own = [tuple(r[i] for i in c) for r in rows]
            own = [v for v in own if any(x not in ("", "0") for x in v)]
            if own and len(set(own)) == len(own) and not any(set(f) <= set(c) for f in found):
                found.append(c)
    return {(len(c), ",".join(names[i] for i in c)) for c in found}


def test_unique_sets_against_brute_force(spark):
    r = random.Random(1)
    names = ["a", "b", "c", "d", "e", "f"]
    for n, values in ((40, 4), (60, 3), (25, 9)):
        rows = [tuple(r.choice([None, "", "0", " x ", *range(values)]) if r.random() < 0.9 else "hot" for _ in names) for _ in range(n)]
        rows = [tuple(None if v is None else str(v) for v in x) for x in rows] + [(None,) * 6] * 3 + [("0",) * 6]
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
        for width in (2, 4):
            assert set(map(tuple, keys.unique_sets(df, names, width).collect())) == brute(rows, names, width)
    assert keys.unique_sets(df.limit(0), names, 3).count() == 0
    assert keys.unique_sets(spark.createDataFrame([("", "0")], "a string, b string"), ["a", "b"], 2).count() == 0


def test_one_value_in_most_rows(spark):
    """A hot class is summed up before it is joined; each width keeps fewer rows than the one before."""
    rows = [("hot", str(i // 2), str(i % 2), "k" if i < 900 else str(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    r = keys.Refinement(df, df.columns)
    left = []
    for k in (1, 2, 3):
        r.add(k, {0, 1, 2, 3})
        left.append(r.parts[k][-1].df.groupBy("set").count().agg({"count": "min"}).first()[0])
    assert ("b", "c") not in {tuple(df.columns[i] for i in x["set"]) for x in r.parts[2][-1].df.select("set").distinct().collect()}
    assert left[0] >= left[1]
    r.drop()
    assert set(map(tuple, keys.unique_sets(df, df.columns, 3).collect())) == {(2, "b,c")}


def test_search_by_levels_of_filled_cells(spark):
    """A less filled column takes part only after all combinations of fuller ones; a limit is told."""
    rows = [(f"A{i % 10}", f"B{i // 10}", f"C{i}" if i % 2 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    found = groups.profile_groups(cells.value_counts(df))
    assert keys.find_key(df, found) == (["x", "y"], False)
    assert keys.find_key(df, found, ProfileConfig(key_width=1)) == ([], False) or keys.find_key(df, found, ProfileConfig(key_width=1)) == (["z"], False)
    assert keys.find_key(df, found, ProfileConfig(key_candidates=1)) == ([], True)
    assert keys.find_key(df.limit(0), groups.profile_groups(cells.value_counts(df.limit(0)))) == ([], False)


def test_unique_sets_by_parts(spark, monkeypatch):
    """parts of the rows come first, and no width is written: the different rows are all that is stored."""
    written = []
    stored = keys.Stored
    monkeypatch.setattr(keys, "Stored", lambda df, name: written.append(name) or stored(df, name))
    monkeypatch.setattr(keys, "_FIRST_PART", 5)
    r = random.Random(2)
    names = ["a", "b", "c", "d", "e"]
    rows = [tuple(r.choice(["", "0", *map(str, range(v))]) for v in (200, 60, 9, 3, 400)) for _ in range(300)]
    rows.append(("0", "0", "1", "1", "1"))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    assert set(map(tuple, keys.unique_sets(df, names, 4).collect())) == brute(rows, names, 4)
    assert written == ["sets-rows"]
    # All hashes alike: texts decide.
    monkeypatch.setattr(keys.F, "xxhash64", lambda *c: keys.F.lit(1).cast("long"))
    assert set(map(tuple, keys.unique_sets(df, names, 2).collect())) == brute(rows, names, 2)


def test_rows_of_a_large_class_are_dealt(spark, monkeypatch):
    """the rows of a class that is most of the table go to many tasks."""
    rows = spark.range(4000).selectExpr("id AS row", "IF(id < 3900, 'hot', CAST(id % 7 AS STRING)) AS value")
    sums = rows.groupBy("value").agg(keys.F.count("*").alias("n"), keys.F.min("row").alias("class"))
    plain = sorted(map(tuple, rows.join(sums.drop("n"), "value").select("row", "value", "class").collect()))
    monkeypatch.setattr(keys, "_HOT", 500)
    found = keys._with_classes(rows, sums, ["value"])
    assert "deal" in found._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, found.select("row", "value", "class").collect())) == plain


def test_uniqueness_needs_no_wide_expansion(spark):
    """F16: a row for each combination holds that combination alone; ('1', '23') and ('12', '3') differ."""
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("0", ""), ("0", "5"), ("0", "5")], "a string, b string")
    found = keys.uniqueness(df, [("a", "b"), ("a",), ("b",)])
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {("a,b", 4, 3), ("a", 2, 2), ("b", 4, 3)}
    assert {tuple(r) for r in keys.uniqueness(df.limit(0), [("a",)]).collect()} == {("a", 0, 0)}


def test_sets_around_a_lead_move_rows_once(spark, monkeypatch):
    """rows are dealt once for each lead, not for each set that is left to be proven; equal rows are one."""
    monkeypatch.setattr(keys, "_FIRST_PART", 500)
    n, r = 12_000, random.Random(3)
    rows = [tuple(str(r.randrange(3000)) for _ in range(6)) for _ in range(n)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")

    def stages():
        sc = spark.sparkContext
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

    before = max(stages(), default=-1)
    found = set(map(tuple, keys.unique_sets(df, df.columns, 3).collect()))
    moved = sum(x for i, x in stages().items() if i > before)
    assert found == brute(rows, df.columns, 3) and len(found) == 20
    assert moved < 16 * n  # one row a set and each: 32 * n
    twice = spark.createDataFrame(rows[:2000] * 2, df.schema)
    assert set(map(tuple, keys.unique_sets(twice, df.columns, 3).collect())) == brute(rows[:2000], df.columns, 3)


def test_blank_leads(spark, monkeypatch):
    """Most rows say nothing in a set that tells the others apart; pairs of such rows still count for larger sets."""
    monkeypatch.setattr(keys, "_FIRST_PART", 100)
    monkeypatch.setattr(keys, "_PAIRS", 2)
    rows = [("" if i % 10 else str(i // 100), "0" if i % 10 else str(i // 10 % 10), str(i % 60), str(i % 45)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    for width in (2, 3, 4):
        assert set(map(tuple, keys.unique_sets(df, df.columns, width).collect())) == brute(rows, df.columns, width)
    assert ("a", "b") in {tuple(x["columns"].split(",")) for x in keys.unique_sets(df, df.columns, 2).collect()}
