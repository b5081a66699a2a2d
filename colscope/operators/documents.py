"""The two documents of a table: the full profile and the slim schema. Their rows are as many as the header's columns."""

from __future__ import annotations

import hashlib
import json
from base64 import urlsafe_b64encode
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import header_name
from .naming import numbered_headers, short_keys, signature
from .slim import read_documents, slim_documents, write_documents


def short_hash(text: str, length: int = 8) -> str:
    return urlsafe_b64encode(hashlib.sha256(text.encode()).digest()).decode()[:length]


def pruned(value: Any) -> Any:
    """Without nulls, empty texts, and what is empty then."""
    if isinstance(value, dict):
        out = {k: pruned(v) for k, v in value.items() if k != "frequencySingles"}
        return {k: v for k, v in out.items() if v not in (None, "", [], {})}
    if isinstance(value, (list, tuple)):
        return [x for x in (pruned(v) for v in value) if x not in (None, "", [], {})]
    return value


def profile_document(meta: dict[str, Any], columns: DataFrame, groups: DataFrame, top: DataFrame) -> dict[str, Any]:
    """The full profile: ``__meta__`` first, then each column with its groups and most frequent values."""
    out: dict[str, Any] = {}
    for r in columns.orderBy("ord").collect():
        row = r.asDict(recursive=True)
        out[row.pop("col_name")] = row | {"lengthGroups": [], "ungroupable": [], "top10freq": []}
    for g in groups.orderBy("ord", "length", "class").collect():
        own = {"charLength": g["length"], "class": g["class"], "totalCount": g["n_values"], "possibleUses": [g["use"]], "numericOnly": g["numeric_only"], "charLenFromNegSign": g["from_sign"]}
        out[g["col_name"]]["ungroupable" if g["unit"] else "lengthGroups"].append(own)
    for t in top.orderBy("col_name", "rank").collect():
        out[t["col_name"]]["top10freq"].append({"v": t["value"], "p": t["share"]})
    return {"__meta__": meta, "extension": ".knfo", "columns": pruned(out)}


def slim_document(profile: dict[str, Any], registry: dict[str, str] | None = None) -> dict[str, Any]:
    """The slim schema document from a profile: no groups, only columns with a type, short keys and signatures."""
    meta, columns = profile["__meta__"], {c: v for c, v in profile["columns"].items() if v.get("data_type")}
    typed = [(c, v["data_type"]) for c, v in columns.items()]
    keys = [k for k in meta.get("keyColumns", []) if k in columns]
    by_type: dict[str, list[str]] = {}
    for c, kind in typed:
        by_type.setdefault(kind, []).append(c)
    short = signature(typed, keys, short=True)
    return {
        "tcode": meta.get("tcode", ""), "keyColumns": keys, "segmentFields": meta.get("segmentFields", {}), "segmentFieldsNorm": {header_name(k): v for k, v in meta.get("segmentFields", {}).items()},
        "dtStructCode": meta.get("dtStructCode", ""), "signature": signature(typed, keys), "shortSignature": short, "dataRepo": short_hash(short),
        "repKeyByColumn": short_keys(list(columns), registry), "normHdrByColumn": numbered_headers(list(columns)),
        "columnsByDataType": {k: sorted(v) for k, v in sorted(by_type.items())}, "totalRows": meta.get("totalRows"), "rowsWithData": meta.get("rowsWithData"), "totalColumns": len(columns),
        "columns": {c: {k: v for k, v in x.items() if k not in ("lengthGroups", "ungroupable")} for c, x in columns.items()},
    }


def write_document(spark: SparkSession, document: dict[str, Any], path: str) -> None:
    """One JSON file by Spark's committer, so that a reader sees all of it or nothing."""
    text = json.dumps(document, indent=2, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path, lineSep="\n")


def read_document(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """A written document; None if it has two characters or fewer."""
    text = "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    return json.loads(text) if len(text.strip()) > 2 else None


def write_slim(spark: SparkSession, profile: dict[str, Any], base: str, folder: str, registry: dict[str, str] | None = None) -> str:
    """The slim document of a profile, written where its repository's name says: ``meta/<dataRepo>/<base>.meta`` below ``folder``."""
    slim = slim_document(profile, registry)
    path = f"{folder}/meta/{slim['dataRepo']}/{base}.meta"
    write_document(spark, slim, path)
    return path


def slim_missing(spark: SparkSession, folder: str, bases: DataFrame) -> list[str]:
    """Write the slim documents of the profiles below ``folder`` that ``bases`` (base) names, such as ``discovery.half_done`` finds; where
    they are. Profiles may differ in shape; all are read, taken apart and written by Spark together."""
    profiles = read_documents(spark, folder, "knfo")
    left = profiles.join(bases.select(F.col("base").alias("low")).distinct(), F.lower("table") == F.col("low"), "left_semi")
    slim, _ = slim_documents(left)
    return write_documents(slim, folder, "meta")


def load_registry(spark: SparkSession, path: str, code: str) -> dict[str, str]:
    """Short keys of a code's aliases from a registry table (code, alias, key)."""
    return {r["alias"]: r["key"] for r in spark.read.parquet(path).where(F.col("code") == code).collect()}


def save_registry(spark: SparkSession, path: str, code: str, keys: dict[str, str]) -> None:
    """Put a code's keys in the registry's partition of that code; other codes' partitions stay."""
    rows = spark.createDataFrame([(code, a, k) for a, k in keys.items()], "code string, alias string, key string")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("code").parquet(path)
