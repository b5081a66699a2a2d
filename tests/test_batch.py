"""Profiles of several tables in one pass: the same as one by one; documents written and read; slim ones from any shape."""

import json

from colscope.operators import cells, columns, groups, keys
from colscope.operators import slim as slim_
from colscope.plans import batch

SF = "/root/testdata/sf0.001"


def frames(spark):
    empty = spark.createDataFrame([], "a string, b string")
    blank = spark.createDataFrame([(None, "")] * 3, "x string, y string")
    dup = spark.createDataFrame([("A1", "0", "x")] * 4 + [("A2", None, "y"), ("A2", "7", "y")], "code string, n string, note string")
    return {"X-T1#a@+size=7": dup, "nation": spark.read.parquet(f"{SF}/nation.parquet"), "supplier": spark.read.parquet(f"{SF}/supplier.parquet"), "empty": empty, "blank": blank}


def test_many_tables_as_one_by_one(spark, tmp_path):
    tables = frames(spark)
    p = batch.profile_tables(batch.Tables.of(tables))
    meta = {r["table"]: r for r in p.meta.collect()}
    cols = {}
    for r in batch.apart(p.columns).collect():
        cols.setdefault(r["table"], {})[r["col_name"]] = (r["uses"], r["max_length"], r["full_content_type"], r["data_type"])
    assert set(meta) == set(tables)
    for name, df in tables.items():
        vc = cells.value_counts(df)
        found = groups.profile_groups(vc)
        one = columns.profile_columns(found)
        assert cols.get(name, {}) == {r["col_name"]: (r["uses"], r["max_length"], r["full_content_type"], r["data_type"]) for r in one.collect()}
        key = keys.find_key(df, found)[0]
        m = meta[name]
        assert (m["key_columns"], m["total_rows"], m["total_columns"]) == (key, df.count(), len(df.columns))
        assert m["rows_with_data"] == cells.row_counts(df).first()["rows_with_data"]
        if found.count():
            assert (m["dt_struct_code"] or "0>") == columns.type_structure(one, key).first()[0]
            assert (m["struct_code"] or "") == columns.content_structure(one, key).first()["struct_code"]
    assert meta["X-T1#a@+size=7"]["tcode"] == "T1" and meta["X-T1#a@+size=7"]["segments"] == {"size": "7"}
    documents = batch.profile_documents(p)
    slim_.write_documents(documents, str(tmp_path), "knfo")
    read = {r["table"]: json.loads(r["document"]) for r in slim_.read_documents(spark, str(tmp_path), "knfo").collect()}
    assert set(read) == set(tables) and list(read["nation"]) == ["__meta__", "extension", "columns"]
    nation = read["nation"]["columns"]["n_name"]
    assert nation["data_type"] == cols["nation"]["n_name"][3] and sum(g["totalCount"] for g in nation.get("lengthGroups", []) + nation.get("ungroupable", [])) == 25 and len(nation["top10freq"]) == 10
    slim, registry = slim_.slim_documents(slim_.read_documents(spark, str(tmp_path), "knfo"))
    slim_.write_documents(slim, str(tmp_path), "meta")
    out = {r["table"]: json.loads(r["document"]) for r in slim_.read_documents(spark, str(tmp_path), "meta").collect()}
    s = out["supplier"]
    assert set(s["columns"]) == {c for c, x in cols["supplier"].items() if x[3]} and s["totalRows"] == tables["supplier"].count()
    assert all("lengthGroups" not in c for c in s["columns"].values()) and s["columns"]["s_name"]["top10freq"]
    assert len(set(s["repKeyByColumn"].values())) == len(s["repKeyByColumn"]) and s["shortSignature"].startswith(f"{s['totalColumns']}>PK$")
    assert registry.where("code = ''").count() >= len(s["repKeyByColumn"])


def test_pending_spreadsheets_of_a_folder(spark, tmp_path):
    from test_profiler import write_xlsx

    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    write_xlsx(src / "X-A#1.xlsx", [["id", "name", "name"], ["1", "x", "u"], ["2", "y", "u"], ["", "", ""], ["3", "y", ""]])
    write_xlsx(src / "X-A#2.xlsx", [["ID", "names"], ["7", "x"]])
    write_xlsx(src / "X-done.xlsx", [["a"], ["1"]])
    files = spark.createDataFrame([(f"{src}/X-A#1.xlsx", 9), (f"{src}/X-A#2.xlsx", 9), (f"{src}/X-done.xlsx", 9), ("x-done.knfo", 9), ("x-done.meta", 9)], "path string, size long")
    from colscope.config import ProfileConfig

    found = {r["table"]: r for r in batch.profile_folder(spark, str(src), str(out), files, ProfileConfig(file_patterns=())).collect()}
    assert {t: (r["key_columns"], r["total_rows"]) for t, r in found.items()} == {"X-A#1": (["id"], 3), "X-A#2": (["ID"], 1)}
    slim = {r["table"]: json.loads(r["document"]) for r in slim_.read_documents(spark, str(out), "meta").collect()}
    assert set(slim) == {"X-A#1", "X-A#2"} and slim["X-A#1"]["normHdrByColumn"] == {"id": "id", "name": "name#1", "name#2": "name#2"} or slim["X-A#1"]["tcode"] == "A"
    keys_ = [k for s in slim.values() for k in s["repKeyByColumn"].values()]
    assert slim["X-A#1"]["repKeyByColumn"]["id"] == slim["X-A#2"]["repKeyByColumn"]["ID"] and len(set(keys_)) == len(keys_) - 1
    before = {(r.code, r.alias, r.key) for r in spark.read.parquet(str(out / "registry")).collect()}
    assert {c for c, _, _ in before} == {"A"}


def test_slim_documents_of_profiles_of_other_shapes(spark):
    """Fields that another version wrote stay; broken texts and columns without a type go."""
    rows = [
        ("a", json.dumps({"__meta__": {"tcode": "T", "keyColumns": ["id", "gone"], "new": [1]}, "columns": {"id": {"data_type": "INT", "extra": {"deep": [1, "x"]}, "lengthGroups": [1]}, "no": {"uses": []}, "t": {"data_type": "DATE"}}})),
        ("b", "{broken"),
        ("c", json.dumps({"columns": {}})),
        ("d", json.dumps({"__meta__": {"tcode": "T"}, "columns": {"ID": {"data_type": "VARCHAR(20)"}}})),
        ("e", None),
    ]
    slim, registry = slim_.slim_documents(spark.createDataFrame(rows, "table string, document string"))
    out = {r["table"]: json.loads(r["document"]) for r in slim.collect()}
    assert set(out) == {"a", "c", "d"} and out["c"]["totalColumns"] == 0
    assert out["a"]["columns"] == {"id": {"data_type": "INT", "extra": {"deep": [1, "x"]}}, "t": {"data_type": "DATE"}}
    assert out["a"]["keyColumns"] == ["id"] and out["a"]["signature"] == "2>PK$id$INT-t$DATE" and out["a"]["shortSignature"] == "2>PK$IN-UN"
    assert out["a"]["repKeyByColumn"]["id"] == out["d"]["repKeyByColumn"]["ID"]  # one alias, one key
    assert {(r.code, r.alias) for r in registry.collect()} == {("T", "id"), ("T", "t")}
