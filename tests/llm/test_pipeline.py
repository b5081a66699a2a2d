"""The pipeline against a plain version of its decisions."""

import collections


def test_pipeline(spark):
    import re

    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(900001, "12 34 !!", "en", "x", 8), (900002, docs.where("doc_id = 3").first().text, "fr", "x", 1), (900003, None, "en", "x", None)], docs.schema)
    now = docs.unionByName(extra)
    seen = {}
    for name, stage in cp.STAGES:
        now = cp.Kept(stage(spark, now, sf), f"test-{name}").df
        seen[name] = now
        if name != cp.STAGES[-1][0]:
            assert now.columns == docs.columns
    ids = lambda n: {x.doc_id for x in seen[n].select("doc_id").collect()}
    everything = {x.doc_id: x.text for x in docs.unionByName(extra).collect()}
    assert ids("language") == set(everything) - {900001, 900003}
    shingles = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))})(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    sets = {d: shingles(everything[d]) for d in ids("language")}
    root = {d: d for d in sets}
    for _ in range(5):
        for a in sorted(sets):
            for b in sorted(sets):
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert ids("near_dedup") == {d for d in root if root[d] == d} and 900002 not in ids("near_dedup")
    items = [re.findall(r"\w+", x.text.lower()) for x in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {d for d in ids("near_dedup") if any(" ".join(i) in " ".join(re.findall(r"\w+", everything[d].lower())) for i in items)}
    assert ids("decontamination") == ids("near_dedup") - whole
    assert ids("secrets") == ids("decontamination")
    changed = {x.doc_id for x in seen["secrets"].collect() if x.text != everything[x.doc_id]}
    assert all(re.search(r"(?i)(password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}", everything[d]) for d in changed)
    assert ids("packing") == ids("secrets")
    total = collections.Counter()
    for x in seen["packing"].collect():
        total[x.sequence_id] += x.length
    assert max(total.values()) <= 2048


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    rows = [(1, "the cat sat on the mat and the dog lay by the door", "en", None, None), (1, "the cat sat on the mat and the dog lay by the door", "en", None, None), (None, "an unnamed text of some words about the weather in town", "en", "s", 3), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "eine lange zeile " * 20_000, "de", "s", 9)]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, h long, rid long, _row long, lang_pred string"
    df = spark.createDataFrame([(*x, 0.5, 1, 2, 3, "zz") for x in rows], names)
    now = df
    for _, stage in cp.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == df.columns
    assert sorted((x.doc_id or 0, x.h, x.lang_pred) for x in now.collect()) == [(0, 1, "zz"), (1, 1, "zz"), (1, 1, "zz"), (5, 1, "zz")]
    assert {x.doc_id for x in cp.STAGES[-1][1](spark, now, str(tmp_path)).collect()} == {None, 1, 5}


def test_texts_that_near_dedup_keeps_do_not_move(spark, monkeypatch):
    import corpus_pipeline as cp

    same = "a text of several words that comes more than once in here"
    rows = [(i, " ".join(f"w{i * 7 + k}x{i}" for k in range(9)), "en") for i in range(40)] + [(50, same, "en"), (51, same, "en"), (51, same, "fr"), (52, same, None), (53, "", "en"), (None, same, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if too many went to be sent by Spark's own choice
    try:
        for sent in (50_000, 0):
            monkeypatch.setattr("colscope.llm.neardup.SENT_ROWS", sent)
            left = cp.near_dedup_stage(spark, docs, "")
            plan = left._jdf.queryExecution().executedPlan().toString() if sent else left._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
            assert ("SortMergeJoin" if sent else "LeftAnti") not in plan
            assert left.columns == docs.columns
            assert sorted((x.doc_id if x.doc_id is not None else -1, x.text) for x in left.collect()) == sorted([(d if d is not None else -1, t) for d, t, _ in rows if d not in (51, 52)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
