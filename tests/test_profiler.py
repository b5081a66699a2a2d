"""Hand-derived cells for the parsers and classifiers, and properties of whole profiles."""

import zipfile

import pytest
from pyspark.sql import functions as F


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")


def column(spark, values, f):
    return [r[0] for r in texts(spark, values).orderBy("i").select(f(F.col("value"))).collect()]


def uses(spark, **columns):
    """Uses by (column, length)."""
    from colscope.operators.cells import value_counts
    from colscope.operators.groups import profile_groups

    n = max(map(len, columns.values()))
    df = spark.createDataFrame([tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)], ", ".join(f"{c} string" for c in columns))
    return {(r.col_name, r.length): r.use for r in profile_groups(value_counts(df)).collect() if r.length}


def test_character_classes(spark):
    from colscope.functions.text import char_class

    values = {"12345678-9": "RUT", "7-K": "RUT", "a@b.cl": "EMAIL", "AB_c-d.e": "ALPHA", "A1_b": "ALPHANUM", "--": "ALPHANUM", "two words": "PHRASE", "1,5": "PHRASE", "  ": "EMPTY", "12": "NUMERIC"}
    assert column(spark, list(values), char_class) == list(values.values())


def test_nullish_and_headers(spark):
    from pyspark.sql.types import StringType

    from colscope.functions.text import cell_text, header_name
    from colscope.operators.naming import lettered_headers, short_key, short_keys, signature, unique_headers

    assert column(spark, [" null ", "N/A", "none", None], lambda c: cell_text(c, StringType())) == ["", "", "none", ""]
    assert header_name("Código  Año.") == "codigo_ano"
    assert unique_headers(["name", "", "name", "name"]) == ["name", "col_2", "name#2", "name#3"]
    assert lettered_headers(["a"] * 27)[-1] == "a::AA"
    assert short_key("posting_row") == "posrow" and short_key("a") == "aaxxxx"
    keys = short_keys(["posting_row", "posting row", "posting-row"])
    assert len(set(keys.values())) == 3 and all(len(k) == 6 for k in keys.values())
    assert signature([("a", "INT"), ("b", "INT"), ("c", "VARCHAR(20)")], ["c"], short=True) == "3>PK$VC20-IN-IN#2"


@pytest.mark.parametrize(
    ("values", "plan", "first"),
    [
        (["12", "7"], ("thousands_only", None, "no_sep_in_samples"), "12"),
        (["1.234,56", "1.234,56", "9.000,10"], ("decimal_present", ",", "both_separators_last_wins"), "1234.56"),
        (["1.234.567"], ("thousands_only", None, "rule1_multi_sep"), "1234567"),
        (["1.234", "5.678"], ("thousands_only", None, "rule2_const_3"), "1234"),
        (["1.5", "22.75"], ("decimal_present", ".", "fallback_decimal"), "1.5"),
        (["(12)"], ("thousands_only", None, "no_sep_in_samples"), "-12"),
        (["1.234.5"], ("thousands_only", None, "rule1_multi_sep"), "1234500"),
    ],
)
def test_numbers(spark, values, plan, first):
    from colscope.functions.numbers import number_plans, number_samples, single_numbers, with_numbers

    cells = spark.createDataFrame([("x", v, i) for i, v in enumerate(values)], "col_name string, value string, ord int")
    p = number_plans(number_samples(cells)).first()
    assert (p.mode, p.decimal, p.reason) == plan
    rows = texts(spark, values[:1]).withColumns({"mode": F.lit(p.mode), "decimal": F.lit(p.decimal).cast("string"), "thousands": F.lit(p.thousands)})
    assert with_numbers(rows).first().norm_dec == first
    if len(values) == 1:
        assert single_numbers(texts(spark, values)).first().norm_dec == first


def test_dates(spark):
    from colscope.functions.dates import FORMATS, canonical, parse_date_strict, parse_datetime_strict, parse_time_strict

    day = lambda order: lambda c: F.date_format(parse_date_strict(c, order), "yyyy-MM-dd")
    assert column(spark, ["13/02/49", "13/02/95", "05-ENE-2024", "13/02/1980", "31/02/2024", "20240213", "1/2/2024"], day("DMY")) == ["2049-02-13", "1995-02-13", "2024-01-05", None, None, None, "2024-02-01"]
    stamp = lambda c: F.date_format(parse_datetime_strict(c, "DMY"), "yyyy-MM-dd HH:mm:ss")
    assert column(spark, ["01/02/2024 25:00", "01/02/2024 12:30 AM", "20240213101500", "2024-02-13T10:15:00Z", "01/02/2024"], stamp) == [None, "2024-02-01 00:30:00", "2024-02-13 10:15:00", "2024-02-13 10:15:00", None]
    assert column(spark, ["10:15", "24:00", "1:05 PM", "12:00AM", "25:00", "13:00 PM"], parse_time_strict) == [36900, 0, 47100, 0, None, None]
    assert column(spark, ["24:00", "nope"], lambda c: canonical(c, F.lit("Time"), F.lit("DMY"))) == ["00:00:00", "nope"]
    assert len(FORMATS) == 39


def test_marks_of_dates_agree_with_the_parsers(spark):
    """What is taken apart once for all orders, against each parser by itself, on texts with every kind of flaw."""
    import random

    from colscope.functions import dates

    r = random.Random(3)
    number = lambda: r.choice([str(r.randint(0, 40)), f"{r.randint(0, 40):02d}", str(r.randint(1980, 2160)), f"{r.randint(0, 99):02d}", r.choice(["ENE", "jan", "Xyz", "Sept"])])
    clock = lambda: r.choice([f"{r.randint(0, 25)}:{r.randint(0, 61):02d}", f"{r.randint(0, 25):02d}:{r.randint(0, 61):02d}:{r.randint(0, 61):02d}"]) + r.choice(["", " AM", "PM", " p.m.", "x"])
    values = {"", "abc", "12.50", "1,234.5", "-5", "a-b-c", " 2024-01-02 "}
    for _ in range(700):
        a = r.choice("/.-")
        values.add(number() + a + number() + r.choice([a, a, "/"]) + number() + r.choice(["", " ", "T"]) + r.choice(["", clock()]) + r.choice(["", "", "Z", "+02:00"]))
        values |= {clock(), "".join(r.choice("0123456789") for _ in range(r.choice([7, 8, 12, 14]))), f"{r.randint(1985, 2030)}{r.randint(1, 13):02d}{r.randint(1, 31):02d}{r.choice(['', ' ', 'T'])}{r.randint(0, 24):02d}{r.randint(0, 60):02d}"}
        values.add(f"{r.randint(1985, 2030)}-{r.randint(1, 13):02d}-{r.randint(1, 31):02d}T{r.randint(0, 24):02d}:{r.randint(0, 60):02d}{r.choice(['', ':30', ':30.5'])}{r.choice(['', 'Z', '+01:00'])}")
    v = F.col("value")
    plain = {"mask": dates.format_mask(v), "time_ok": dates.parse_time_strict(v).isNotNull()}
    for o in dates.ORDERS:
        plain |= {f"ordered_{o}": dates.parse_ordered(v, o).isNotNull(), f"date_{o}": dates.parse_date_strict(v, o).isNotNull(), f"datetime_{o}": dates.parse_datetime_strict(v, o).isNotNull(), f"_fits_{o}": F.coalesce(dates.orders_that_fit(v)[o], F.lit(False))}
    df = spark.createDataFrame([(x,) for x in values], "value string")
    both = dates.with_date_marks(df).select("value", *[F.struct(F.col(k).alias("a"), x.alias("b")).alias(k) for k, x in plain.items()])
    for x in both.collect():
        assert {k: x[k].a for k in plain} == {k: x[k].b for k in plain}, x.value


def test_uses(spark):
    found = uses(
        spark, dmy=["13/02/2024", "01/02/2024"], mdy=["02/13/2024", "02/01/2024"], iso=["2024-02-13", "2024-03-01"], compact=["20240213", "20240301"], compact14=["20240213101500", "20240301101500"], time=["10:15", "24:00"],
        yn=["y", "n"], words=["true", "false"], zeros=["0", "0"], codes=["1001", "1002"], two=["A", "B"], three=["A", "B", "C"], mixed=["A1", "B2"], mail=["a@b.cl", "c@d.cl"], free=["two words", "ten words"], dec=["1.5", "2.7"], old=["13/02/1980", "14/02/1980"],
    )
    assert found["dmy", 10] == found["mdy", 10] == found["iso", 10] == "Date" and found["compact", 8] == "NumericCode" and found["compact14", 14] == "DateTime" and found["time", 5] == "Time"
    assert found["yn", 1] == "Boolean" and {found["words", 4], found["words", 5]} == {"TextCode"} and found["zeros", 1] == "ZerosOnly" and found["codes", 4] == "NumericCode" and found["two", 1] == "TextCode"
    assert found["three", 1] == "TextCode" and found["mixed", 2] == "AlphaNumericCode" and found["mail", 6] == "Email" and found["free", 9] == "FreeText" and found["dec", 3] == "DecimalValue" and found["old", 10] not in ("Date", "DateTime")


def test_keys_and_documents(spark, tmp_path):
    from colscope.operators.documents import read_document, slim_document, write_document
    from colscope.plans.profile import profile

    df = spark.createDataFrame([(a, b, f"{a}{b} text", "k") for a in ("x1", "x2", "x3") for b in ("p1", "p2")], "a string, b string, c string, d string").withColumn("c", F.concat("a", F.lit(" and more")))
    p = profile(df, "X-MB51#1@+plant=AB1@+d=k.xlsx")
    assert p.meta["keyColumns"] == ["a", "b"] and p.meta["tcode"] == "MB51" and p.meta["segmentFields"] == {"plant": "AB1"}
    assert p.meta["totalRows"] == p.meta["rowsWithData"] == 6
    full = p.document()
    ranged = profile(spark.range(10, 40).selectExpr("cast(id as string) as n", "cast(date_add(date'2024-01-01', cast(id as int)) as string) as d")).document()["columns"]
    assert (int(ranged["n"]["min_number"]), int(ranged["n"]["max_number"])) == (10, 39) and str(ranged["d"]["min_time"]).startswith("2024-01-11") and "min_number" not in ranged["d"]
    slim = slim_document(full)
    assert slim["signature"].startswith("4>PK$a$") and len(set(slim["repKeyByColumn"].values())) == 4
    write_document(spark, slim, str(tmp_path / "x.meta"))
    assert read_document(spark, str(tmp_path / "x.meta"))["signature"] == slim["signature"]
    rows = sum(r.n_rows for r in p.value_counts.where("col_name = 'a'").collect())
    assert rows == 6 and sum(r.n_values for r in p.groups.where("col_name = 'a'").collect()) == 3


def write_xlsx(path, rows, styles=None, base1904=False):
    """Texts are inline strings; (style, number) is a number cell of that style."""
    body = lambda ref, v: f'<c r="{ref}" s="{v[0]}"><v>{v[1]}</v></c>' if isinstance(v, tuple) else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    cells = lambda n, row: "".join(body(f"{chr(65 + i)}{n}", v) for i, v in enumerate(row) if v != "")
    sheet = "<worksheet xmlns='m'><sheetData>" + "".join(f'<row r="{n}">{cells(n, r)}</row>' for n, r in enumerate(rows, 1) if any(r)) + "</sheetData></worksheet>"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook xmlns='m' xmlns:r='{rel}'>{'<workbookPr date1904="1"/>' if base1904 else ''}<sheets><sheet name='S' sheetId='1' r:id='r1'/></sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships><Relationship Id='r1' Target='worksheets/sheet1.xml'/></Relationships>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        if styles:
            own = "".join(f"<numFmt numFmtId='{170 + i}' formatCode='{c}'/>" for i, c in enumerate(styles) if isinstance(c, str))
            z.writestr("xl/styles.xml", f"<styleSheet xmlns='m'><numFmts>{own}</numFmts><cellXfs>{''.join(f'<xf numFmtId="{170 + i if isinstance(c, str) else c}"/>' for i, c in enumerate(styles))}</cellXfs></styleSheet>")


def test_spreadsheets(spark, tmp_path):
    from colscope.sources.xlsx import XlsxSource, unify_decimal

    write_xlsx(tmp_path / "a.xlsx", [["name", "name", ""], ["x", " y ", "z"], ["", "", ""], ["1", "", "2", "wide"]])
    spark.dataSource.register(XlsxSource)
    df = spark.read.format("xlsx").load(str(tmp_path / "a.xlsx"))
    assert df.columns == ["_row", "name", "name#2", "col_3", "col_4"] and [tuple(r) for r in df.orderBy("_row").collect()] == [(2, "x", "y", "z", ""), (4, "1", "", "2", "wide")]
    kept = spark.read.format("xlsx").option("dropBlank", "false").option("headerStyle", "letter").load(str(tmp_path))
    assert kept.columns == ["_row", "name::A", "name::B", "col_3::C", "col_4::D"] and kept.count() == 3
    assert column(spark, ["1,5", "1,2,3", "1.5", "a,1"], unify_decimal) == ["1.5", "1.2,3", "1.5", "a,1"]


def test_spreadsheets_of_several_layouts(spark, tmp_path):
    """No cell of any file is left out, dates are texts, decimals are rewritten on demand, and any store's path will do."""
    from colscope.sources.xlsx import XlsxSource, read_workbooks

    write_xlsx(tmp_path / "a.xlsx", [["when", "n", "t"], [(1, 45000), (0, "1.50"), (2, 0.5)], [(3, 45000.25), "1,5", "2,3 m"]], styles=[0, 14, 21, 'yyyy"d"\\-mm', '"day" 0.00'])
    write_xlsx(tmp_path / "b.xlsx", [["n", "more", ""], ["7", "x", "y"]])
    spark.dataSource.register(XlsxSource)
    rows = [tuple(r) for r in spark.read.format("xlsx").option("unifyDecimal", "true").load(str(tmp_path)).orderBy("when", "n").collect()]
    assert rows == [(2, "", "7", "", {"more": "x", "col_3": "y"}), (2, "2023-03-15T00:00:00.000Z", "1.5", "1899-12-30T12:00:00.000Z", {}), (3, "2023-03-15T06:00:00.000Z", "1.5", "2,3 m", {})]
    found = {(r.path.rpartition("/")[2], r.row): r.cells for r in read_workbooks(spark, f"file://{tmp_path}").collect()}
    assert found == {("a.xlsx", 2): {"when": "2023-03-15T00:00:00.000Z", "n": "1.5", "t": "1899-12-30T12:00:00.000Z"}, ("a.xlsx", 3): {"when": "2023-03-15T06:00:00.000Z", "n": "1,5", "t": "2,3 m"}, ("b.xlsx", 2): {"n": "7", "more": "x", "col_3": "y"}}
    write_xlsx(tmp_path / "c.xlsx", [["d"], [(1, 1)]], styles=[0, 14, "0"], base1904=True)
    assert spark.read.format("xlsx").load(str(tmp_path / "c.xlsx")).first().d == "1904-01-02T00:00:00.000Z"


def test_event_stream(spark, tmp_path):
    import json

    from colscope.streaming.events import decode, relevant, trigger

    source = tmp_path / "in"
    source.mkdir()
    messages = [{"event": "files_changed", "files": {"created": [{"file_path": "a/X.xlsx"}, {"file_path": "a/X.txt"}], "deleted": [{"file_path": "b.meta"}]}}, {"event": "file_created", "file_path": "a/X.xlsx"}, {"event": "connected"}, {"event": "file_modified", "file_path": "c.knfo"}]
    (source / "1.txt").write_text("\n".join(map(json.dumps, messages)))
    got = []
    q = trigger(relevant(decode(spark.readStream.text(str(source)))), got.extend, str(tmp_path / "check"), seconds=0)
    q.processAllAvailable()
    q.stop()
    assert got == ["a/X.xlsx", "b.meta"]


def test_windows_of_a_stream(spark, tmp_path):
    """The first event of a listener opens a window, later ones join it, and late ones are put in order; statistics follow."""
    import datetime

    from colscope.streaming.events import Statistics, debounced_stream, flush

    at = lambda s: datetime.datetime(2024, 1, 1, 12) + datetime.timedelta(seconds=s)
    parts = [[(1, at(0), "a"), (1, at(4), "b"), (2, at(1), "a")], [(1, at(3), "a"), (1, at(5.5), "c"), (1, at(9), "d")], [(1, at(200), "z"), (2, at(200), "z")], [(1, at(400), "y"), (2, at(400), "y")]]
    stats = Statistics()
    spark.streams.addListener(stats)
    try:
        for i, rows in enumerate(parts):
            spark.createDataFrame(rows, "listener long, ts timestamp, path string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            if i == 0:
                source = spark.readStream.schema("listener long, ts timestamp, path string").parquet(str(tmp_path / "in"))
                query = debounced_stream(source, "listener", late="10 seconds").writeStream.format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "check")).start()
            query.processAllAvailable()
        flush(query)
    finally:
        spark.streams.removeListener(stats)
    found = {(r.listener, r.batch_start, tuple(r.paths)) for r in spark.table("windows").collect()}
    assert {(1, at(0), ("a", "b")), (1, at(5.5), ("c", "d")), (2, at(1), ("a",)), (1, at(200), ("z",)), (2, at(200), ("z",))} <= found


def test_slim_documents_of_profiles(spark, tmp_path):
    from colscope.operators.discovery import half_done
    from colscope.operators.documents import load_registry, read_document, save_registry, slim_missing, write_document
    from colscope.operators.naming import numbered_headers, short_keys

    assert numbered_headers(["Item::D", "Item::C", "Código  Año.", "item", "::B"]) == {"Item::D": "item#2", "Item::C": "item#1", "Código  Año.": "codigo_ano", "item": "item#3", "::B": "col_x"}
    profile = {"__meta__": {"keyColumns": ["a::A"], "totalRows": 2, "tcode": "T"}, "columns": {"a::A": {"data_type": "INT"}, "a::B": {"data_type": "VARCHAR(20)"}, "none": {}}}
    write_document(spark, profile, str(tmp_path / "x.knfo"))
    files = spark.createDataFrame([(f"{tmp_path}/x.knfo", 90), (f"{tmp_path}/y.knfo", 90), (f"{tmp_path}/y.meta", 90)], "path string, size long")
    left = half_done(files)
    assert [r.base for r in left.collect()] == ["x"]
    [path] = slim_missing(spark, str(tmp_path), left)
    slim = read_document(spark, path)
    assert path.endswith(f"/meta/{slim['dataRepo']}/x.meta") and slim["normHdrByColumn"] == {"a::A": "a#1", "a::B": "a#2"} and slim["totalColumns"] == 2
    keys = {"a": short_keys(["a::A", "a::B"])["a::A"]}  # by alias
    save_registry(spark, str(tmp_path / "registry"), "T", keys)
    save_registry(spark, str(tmp_path / "registry"), "U", {"b": "bbxxxx"})
    assert load_registry(spark, str(tmp_path / "registry"), "T") == keys and short_keys(["new", "a::B"], keys)["a::B"] == keys["a"]


def test_monitored_files_and_runs(spark, tmp_path):
    import json

    from colscope.config import ProfileConfig
    from colscope.operators.discovery import monitored_files
    from colscope.plans.profile import run_pending, track

    path = tmp_path / "monitor.json"
    path.write_text(json.dumps({"in/a.xlsx": {"nombre": "a", "extension": ".xlsx", "tamaño": 7}, "in/b.txt": {"nombre": "b", "extension": ".txt", "tamaño": 1}}), encoding="utf-8")
    assert {(r.path, r.name, r.size) for r in monitored_files(spark, str(path)).collect()} == {("in/a.xlsx", "a", 7), ("in/b.txt", "b", 1)}
    path.write_text("[]")
    assert monitored_files(spark, str(path)).count() == 0
    files = spark.createDataFrame([("a.xlsx", 9), ("b.xlsx", 8), ("b.knfo", 9)], "path string, size long")
    tried = []

    def act(p):
        tried.append(p)
        if p == "b.xlsx":
            raise ValueError("broken")

    out = run_pending(files, act, config=ProfileConfig(file_patterns=()))
    assert out == {"a.xlsx": "done", "b.xlsx": "failed 3: broken"} and tried == ["a.xlsx"] + ["b.xlsx"] * 3
    assert track(files, "x/B.xlsx") == {"profile": True, "meta": False}


def test_flexible_dates(spark):
    from colscope.functions.dates import format_pattern, header_hints, parse_flexible, type_family

    show = lambda c: F.date_format(parse_flexible(c), "yyyy-MM-dd HH:mm:ss")
    values = {"45000": "2023-03-15 00:00:00", "0,5": "1970-01-01 12:00:00", "1700000000": "2023-11-14 22:13:20", "2024-02-13 10:15": "2024-02-13 10:15:00", "20240213": "2024-02-13 00:00:00", "13/02/2024": "2024-02-13 00:00:00", "02/13/2024": "2024-02-13 00:00:00", "5-ENE-24": "2024-01-05 00:00:00", "10:15": "1970-01-01 10:15:00", "2024-02-13T10:15:00Z": "2024-02-13 10:15:00", "hello": None}
    assert column(spark, list(values), show) == list(values.values())
    assert column(spark, ["KDT", "DATE", "TIME", "INT"], type_family) == ["DateTime", "Date", "Time", None]
    assert column(spark, ["Posting Date", "Hora", "x"], lambda c: header_hints(c)[0]) == [True, False, False]
    assert format_pattern("DD/MM/YYYY HH:mm:ss") == "dd/MM/yyyy HH:mm:ss"


def test_listing(spark, tmp_path):
    from colscope.config import ProfileConfig
    from colscope.operators.discovery import list_files, status

    for name, size in (("a.xlsx", 9), ("b.xlsx", 9), ("a.knfo", 9), ("a.meta", 9)):
        (tmp_path / name).write_bytes(b"x" * size)
    files = list_files(spark, str(tmp_path))
    assert files.count() == 4 and {r.state: r.n_files for r in status(files, ProfileConfig(file_patterns=())).collect()} == {"done": 1, "pending": 1}


def test_order_and_plan_from_all_values(spark):
    """The least texts of a column alone would mislead: days up to 10 only, fractions of three digits only."""
    from colscope.operators.groups import date_orders, plans_of

    when = F.timestamp_seconds(F.lit(1_577_836_800) + F.col("id") * 6001)
    dates = spark.range(36600).select(F.lit("d").alias("col_name"), F.date_format(when, "MM/dd/yyyy HH:mm:ss").alias("value"))
    assert date_orders(dates).first().date_order == "MDY"
    numbers = spark.createDataFrame([("n", f"{i // 1000}.{i % 1000:03d}") for i in range(2000)] + [("n", "10.5")], "col_name string, value string")
    plan = plans_of(numbers).first()
    assert (plan["mode"], plan["decimal"]) == ("decimal_present", ".")


def test_values_are_counted_and_taken_apart_once(spark):
    """F3, F5-F15, F17: later steps read the written marks, not the table, and rows of large groups stay where they are."""
    df = spark.createDataFrame([(str(i), f"{i}.5", "2024-01-%02d" % (i % 28 + 1), "007", "-5") for i in range(50)], "a string, b string, c string, d string, e string")
    from colscope.operators import cells, groups

    marked = groups.marked_values(cells.value_counts(df))
    found = groups.profile_groups(None, marked=marked)
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "LogicalRDD" not in plan(marked) and "Scan ExistingRDD" not in plan(marked) and "Aggregate" not in plan(marked)
    assert "SortMergeJoin" not in plan(groups.group_ranges(marked, found)) and "groups-marked" in plan(groups.group_ranges(marked, found))
    got = {(r.col_name, r.value): (r.norm_dec, r.norm_int) for r in marked.collect()}
    assert got["a", "7"] == ("7", "7") and got["b", "7.5"] == ("7.5", "7") and got["d", "007"] == ("007", "007") and got["e", "-5"] == ("-5", "-5")


def test_kinds_stand_for_their_values(spark):
    """F6-F14: numbers of one form are one row of what is taken apart, with the same groups, plans and ranges as all values."""
    from colscope.operators import cells, groups

    many = [(f"{i}", f"{i * 37 % 5000}.{i % 100:02d}", f"C#{i:05d}", f"{i % 12 + 1:02d}/{i % 28 + 1:02d}/2021") for i in range(3000)]
    odd = "0|00|0.0|1e5|0e5|1e-324|9e-324|-0|-7|-00|007|12,5|1.234.567|1.234,50|(12)|(-3)|12345678|20240131|20240131 1200|1-9|1/2/2024|12:30|99:99|24:00|10%|$ 5|x|1|yes|a@b1.cl|A.1|A1|7-K|٥|1.50|2.00|12.3.4|--5|5-|3.|.5|0.000|+4|-1.250|123456789012345678|1234567890123456789|000000000000000000"
    odd = [(v, v, v, v) for v in odd.split("|")]
    for rows in (many + odd, odd):
        vc = cells.value_counts(spark.createDataFrame(rows, "n string, p string, c string, d string"))
        by_value, by_kind = groups.marked_values(vc), groups.marked_kinds(vc)
        got = lambda df: sorted(map(str, df.collect()))
        found = [groups.profile_groups(None, marked=m).localCheckpoint() for m in (by_value, by_kind)]
        assert got(found[0]) == got(found[1])
        assert got(groups.group_flags(by_value)) == got(groups.group_flags(by_kind))
        assert got(groups.group_ranges(by_value, found[0])) == got(groups.group_ranges(by_kind, found[0]))
        if rows is not odd:
            assert by_kind.where("col_name <> 'd'").count() < 900 < 8000 < by_value.where("col_name <> 'd'").count()


def test_cells_are_trimmed_as_before(spark):
    from colscope.operators.cells import value_counts

    values = {" a": "a", "a ": "a", "﻿b\t": "b", " NULL ": "", "n/A": "", "nullable": "nullable", "": "", "  ": "", "x y": "x y", " c": " c"}
    assert {r.value for r in value_counts(spark.createDataFrame([(k,) for k in values], "v string")).collect()} == set(values.values())
    numbers = {r.value for r in value_counts(spark.createDataFrame([(x,) for x in (100.0, 0.0, 1.5, -2.05, float("nan"), 1e-10)], "v double")).collect()}
    assert numbers == {"100", "0", "1.5", "-2.05", "", "0.0000000001"}
