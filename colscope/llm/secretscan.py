"""Secret scans with linked credential parts, with DataFrame functions only.

1. Regular expressions find spans in each whole text. Three kinds are strong and always reported: ``assign`` (a named secret
   and its value), ``access`` (access identifiers with a fixed prefix) and ``hex`` (long hexadecimal runs). Others are weak:
   ``ident`` (a named user, client or account), ``key40`` (40 characters of mixed case and digits) and ``endpoint`` (a URL or a
   host with a port).
2. Linking is an interval join within scopes: a weak span is reported when a complementary part lies at most ``SCOPE`` code
   points away in the same text: an ``ident`` or ``endpoint`` beside a secret (assign, hex, key40), a ``key40`` beside an identifier
   (access, ident) or endpoint. The join is a range window over the spans' positions that looks for each part on both
   sides, so no pairs are made, however many spans a text has.

Positions are code points. A text's matches and the pieces between them come from one pattern, and running sums of their lengths
(a window over exploded matches) give the positions.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Code points between two parts of a credential.
SCOPE = 160

# The patterns of the strong kinds, with the least length of what they find (of the value, for assign).
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

# Weak kinds.
IDENT = r"""(?:[uU][sS][eE][rR](?:_?[nN][aA][mM][eE])?|[cC][lL][iI][eE][nN][tT]_?[iI][dD]|[aA][cC][cC][oO][uU][nN][tT](?:_?[iI][dD])?|[lL][oO][gG][iI][nN])["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,}"""
KEY40 = r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"(?:https?|wss?|s3|redis|postgres(?:ql)?|mysql|mongodb|amqp|ftp)://[A-Za-z0-9@_.:/?&=%~+-]{4,}|\b(?:[a-z0-9-]{1,63}\.){1,8}[a-z]{2,24}:[0-9]{2,5}\b"

#: Kinds in order, and whether they are reported by themselves.
KINDS = (("assign", ASSIGN, True), ("access", ACCESS, True), ("hex", HEX, True), ("ident", IDENT, False), ("key40", KEY40, False), ("endpoint", ENDPOINT, False))
#: What each weak kind needs within its scope.
COMPLEMENTS = {"ident": ("assign", "hex", "key40"), "key40": ("access", "ident", "endpoint"), "endpoint": ("assign", "hex", "key40")}


def _may_match(text: Column, number: int) -> Column:
    """Whether a text has what the pattern can't do without (a sign, a prefix, a long run), and then the pattern itself. The first is
    quick to tell, and most texts lack it."""
    kind, pattern, _ = KINDS[number]
    if kind in ("assign", "ident"):
        quick = text.contains("=") | text.contains(":")
    elif kind == "access":
        quick = text.contains("AKIA")
    elif kind == "endpoint":
        quick = text.contains(":")
    else:
        quick = text.rlike("[A-Za-z0-9+/]{24}")
    return quick & text.rlike(pattern)


def _whole_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def _steps(text: Column, number: int, pattern: str) -> Column:
    """For each match, in order: (kind, nth, gap before it, its length, does it count). Null where there is none."""
    matches = _whole_matches(text, pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))

    def step(m: Column, i: Column) -> Column:
        counts = F.lit(True)
        if pattern == ASSIGN:
            counts = F.length(m) - F.length(F.regexp_extract(m, ASSIGN_HEAD, 0)) >= ASSIGN_VALUE
        if pattern == KEY40:
            counts = m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
        return F.struct(F.lit(number).cast("int").alias("kind"), i.cast("int").alias("nth"), F.get(gaps, i).alias("gap"), F.length(m).alias("size"), counts.alias("counts"))

    return F.when(_may_match(text, number), F.transform(matches, step))


def found_spans(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """(row, doc_id, kind, start, end, reported): a row for each match, and one with a null kind for a text without any.

    ``row`` numbers the rows of ``docs``. reported: whether the match counts and is strong or has a complementary part in
    scope.
    """
    parts = F.filter(F.array(*[_steps(F.col("_text"), k, p) for k, (_, p, _) in enumerate(KINDS)]), lambda x: x.isNotNull())
    rows = docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    rows = rows.select("row", "doc_id", F.explode_outer(F.flatten(parts)).alias("s")).select("row", "doc_id", "s.*")
    sums = Window.partitionBy("row", "kind").orderBy("nth")
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(sums)
    spans = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    number = {k: i for i, (k, _, _) in enumerate(KINDS)}
    # The interval join: how far the nearest counting span of each complementary kind lies, on either side. Both windows
    # only grow, so their cost is in proportion to the spans.
    before = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = sorted({x for v in COMPLEMENTS.values() for x in v})
    of = {k: (F.col("kind") == number[k]) & F.col("counts") for k in wanted}
    spans = spans.withColumns({f"left_{k}": F.max(F.when(of[k], F.col("end"))).over(before) for k in wanted})
    spans = spans.withColumns({f"right_{k}": F.min(F.when(of[k], F.col("start"))).over(after) for k in wanted})
    near = {k: F.coalesce(F.col("start") - F.col(f"left_{k}") <= SCOPE, F.lit(False)) | F.coalesce(F.col(f"right_{k}") - F.col("end") <= SCOPE, F.lit(False)) for k in wanted}
    linked = F.col("kind").isin(*[i for i, (_, _, strong) in enumerate(KINDS) if strong])
    for kind, parts_wanted in COMPLEMENTS.items():
        for w in parts_wanted:
            linked = linked | ((F.col("kind") == number[kind]) & near[w])
    return spans.select("row", "doc_id", "kind", "start", "end", F.coalesce(F.col("counts") & linked, F.lit(False)).alias("reported"))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, spans: array of (start, end, kind), by start, then kind as listed.

    Strong spans always count; weak ones only beside a complementary part. A null or empty text has no spans. Rows that repeat
    a doc_id, or have none, keep a row each. Very long texts are scanned whole. Other columns are not read. An empty
    table gives no rows.
    """
    spans = found_spans(docs)
    span = F.struct(F.col("start"), F.col("kind"), F.col("end"))
    kept = spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.when(F.col("reported"), span))).alias("s"))
    names = F.array(*[F.lit(k) for k, _, _ in KINDS])
    return kept.select("doc_id", F.transform("s", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(names, s["kind"]).alias("kind"))).alias("spans"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every reported span of text replaced by ``mark``; overlapping spans become one. Other columns stay.

    A text without spans (or null) is unchanged. Rows are not merged, whatever they repeat.
    """
    columns = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    may = functools.reduce(operator.or_, [_may_match(text, k) for k in range(len(KINDS))])
    # All texts are numbered and kept, with what was found out about them: patterns cost more than writing.
    every = materialize(docs.select(F.monotonically_increasing_id().alias("_row"), may.alias("_may"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_all")), "secrets-marked")
    marked = every.where("_may")
    spans = found_spans(marked.select("_row", F.col("_all.doc_id").alias("doc_id"), F.col("_all.text").alias("text")), F.col("_row"))
    spans = spans.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list(F.when(F.col("reported"), F.struct("start", "end")))).alias("s"))
    grouped = marked.join(spans, "_row")
    text = F.col("_all.text")
    # Going from left to right: what was cut off so far, and where the next clear part begins.
    start = F.struct(F.array().cast("array<struct<a:long,b:long>>").alias("clear"), F.lit(0).cast("long").alias("at"))
    walked = F.aggregate("s", start, lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(F.array_append(acc["clear"], F.struct(acc["at"].alias("a"), s["start"].alias("b"))).alias("clear"), s["end"].alias("at"))).otherwise(F.struct(acc["clear"].alias("clear"), F.greatest(acc["at"], s["end"]).alias("at"))))
    cut = grouped.withColumn("w", walked)
    pieces = F.transform("w.clear", lambda c: F.concat(F.substring(text, c["a"].cast("int") + 1, (c["b"] - c["a"]).cast("int")), F.lit(mark)))
    tail = F.substring(text, F.col("w.at").cast("int") + 1, F.length(text))
    redacted = F.concat(F.array_join(pieces, ""), tail)
    return every.where("not _may").select("_all.*").unionByName(cut.select(*[redacted.alias("text") if c == "text" else F.col(f"_all.`{c}`").alias(c) for c in columns]))
