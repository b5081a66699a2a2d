"""A whole profile of a table: all result tables, the two documents, and loops over pending files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ProfileConfig
from ..operators import cells, columns, correlate, discovery, documents, groups, keys, naming
from ..storage import Stored


@dataclass
class Profile:
    value_counts: DataFrame
    groups: DataFrame
    columns: DataFrame
    ranges: DataFrame
    column_ranges: DataFrame
    top: DataFrame
    outliers: DataFrame
    correlations: DataFrame
    chains: DataFrame
    differences: DataFrame
    mismatches: DataFrame
    meta: dict[str, Any]

    def document(self) -> dict[str, Any]:
        full = self.columns.join(self.differences, "col_name", "left").join(self.chains, "col_name", "left").join(self.column_ranges, "col_name", "left")
        return documents.profile_document(self.meta, full, self.groups, self.top)


def profile(df: DataFrame, file_name: str = "", config: ProfileConfig = DEFAULT, live: bool = False) -> Profile:
    """Profile a table. The value counts are computed once and kept for all that follows.

    ``live`` leaves out what only the intended semantics have: StandardText, correlations and chains.
    """
    spark = df.sparkSession
    vc = Stored(cells.value_counts(df), "profile-counts").df
    marked = groups.marked_kinds(vc, config)
    found = Stored(groups.profile_groups(vc, config, live, marked), "profile-groups").df
    cols = Stored(columns.profile_columns(found, config), "profile-columns").df
    ranges = groups.group_ranges(marked, found)
    top = cells.top_values(vc, config)
    key, cut = keys.find_key(df, found, config)
    pairs = correlate.correlations(rows_of := correlate.value_rows(df, df.columns, df.columns), uses := cols.select("col_name", "uses"))
    pairs = pairs.limit(0) if live else pairs
    chains = correlate.use_chains(rows_of, uses)
    chains = chains.limit(0) if live else chains
    rows = cells.row_counts(df).first()
    structure = columns.type_structure(cols, key)
    with_dash, no_dash = columns.abbreviated(F.col("dt_struct_code"))
    types = structure.select("dt_struct_code", with_dash.alias("a"), no_dash.alias("b")).first()
    content = columns.content_structure(cols, key).first()
    code, segments = naming.parsed_file_name(F.lit(file_name))
    named = spark.range(1).select(code.alias("code"), segments.alias("segments")).first()
    kept = {}
    if named["segments"]:
        listed = spark.createDataFrame(list(named["segments"].items()), "key string, value string")
        kept = {r["key"]: r["value"] for r in discovery.segments_kept(listed, vc).collect()}
    meta = {
        "totalRows": rows["total_rows"], "rowsWithData": rows["rows_with_data"], "totalColumns": len(df.columns), "keyColumns": key, "keySearchCut": cut, "tcode": named["code"], "segmentFields": kept,
        "dtStructCode": types["dt_struct_code"], "abrDtStruct": {"withDash": types["a"], "noDash": types["b"]}, "structCode": content["struct_code"], "b64urlCode": content["b64url_code"], "dataRepo": documents.short_hash(types["b"]),
        "dateOrderByColumn": {r["col_name"]: {"order": r["date_order"], "confidence": r["confidence"]} for r in groups.date_orders(vc, config).collect()},
        "columnsByDataType": {r["data_type"]: r["columns"].split(",") for r in columns.columns_by_type(cols).collect()},
    }
    return Profile(vc, found, cols, ranges, groups.column_ranges(ranges, found), top, groups.outlier_groups(ranges, config), pairs, chains, columns.differences(cols, top, chains), groups.date_mismatches(vc, cols, config), meta)


def run_pending(files: DataFrame, act: Callable[[str], None], attempts: int = 3, config: ProfileConfig = DEFAULT) -> dict[str, str]:
    """Call ``act`` for each pending file, largest first, until it succeeds or has failed ``attempts`` times; what became of each."""
    out: dict[str, str] = {}
    for r in discovery.pending(files, config=config).toLocalIterator():
        for k in range(attempts):
            try:
                act(r["path"])
                out[r["path"]] = "done"
                break
            except Exception as e:
                out[r["path"]] = f"failed {k + 1}: {e}"
    return out


def track(files: DataFrame, name: str) -> dict[str, bool]:
    """Which steps of a file are done: profile, slim document."""
    base = files.sparkSession.range(1).select(discovery.base_name(F.lit(name)).alias("base"))
    has = lambda kind: bool(discovery.existing(files, kind).join(base, "base", "left_semi").limit(1).count())
    return {"profile": has(".knfo"), "meta": has(".meta")}
