"""Chat formatting by schema fingerprints, with DataFrame functions only.

A layout is a declarative mapping: the nested field paths it needs and may use, and how its fields become canonical turns
(conv_id, turn, role, text). The fingerprint of a table (or of a JSON record) is the hash of those of its paths that any
layout knows, so that further columns don't matter; a lookup of the hash selects the layout. Known paths that no layout
combines are those of several layouts at once: then the first layout in order that has all it needs is selected.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash becomes ``\\b``, ``<|``
becomes ``<\\p`` and, in roles, a line feed ``\\l``; so ``<|`` occurs in a formatted conversation only where the template put
it, and reading undoes this exactly. The loss mask lists the spans (code points, end exclusive) of the assistant's texts.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts are under the loss mask.
LEARNED = "assistant"


# ---------------------------------------------------------------- layouts


@dataclass(frozen=True)
class Layout:
    """``needs`` and ``may``: field paths (``a.b``; ``a[].b`` inside an array). Either ``rows`` says that a row is one turn, or
    ``turns`` gives the array of (role, text) of a record, from a function that reads a path or gives null if it's absent."""

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    turns: Callable[[Callable[[str], Column]], Column] | None = None
    rows: bool = False
    roles: dict[str, str] = field(default_factory=dict, hash=False)


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.cast("string").alias("text"))


def _present(*turns: Column) -> Column:
    """The turns whose text isn't null."""
    return F.filter(F.array(*turns), lambda t: t["text"].isNotNull())


def _list(array: str, role: str, text: str) -> Callable[[Callable[[str], Column]], Column]:
    return lambda get: F.transform(get(array), lambda t: F.struct(t[role].cast("string").alias("role"), t[text].cast("string").alias("text")))


def _question(get: Callable[[str], Column]) -> Column:
    asked = F.when(F.coalesce(get("input"), F.lit("")) == "", get("instruction")).otherwise(F.concat_ws("\n\n", get("instruction"), get("input")))
    return _present(_turn("system", get("system")), _turn("user", asked), _turn("assistant", get("output")))


NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), rows=True),
    Layout("messages", ("messages[].role", "messages[].content"), ("conv_id", "messages"), _list("messages", "role", "content"), roles=NAMES),
    Layout("from and value", ("conversations[].from", "conversations[].value"), ("conv_id", "conversations"), _list("conversations", "from", "value"), roles=NAMES),
    Layout("instruction", ("instruction", "output"), ("conv_id", "input", "system"), _question),
    Layout("prompt", ("prompt", "response"), ("conv_id", "system"), lambda get: _present(_turn("system", get("system")), _turn("user", get("prompt")), _turn("assistant", get("response")))),
    Layout("prompt and completion", ("prompt", "completion"), ("conv_id", "system"), lambda get: _present(_turn("system", get("system")), _turn("user", get("prompt")), _turn("assistant", get("completion")))),
    Layout("question", ("question", "answer"), ("conv_id", "context"), lambda get: _present(_turn("system", get("context")), _turn("user", get("question")), _turn("assistant", get("answer")))),
)
_KNOWN = {p for x in LAYOUTS for p in (*x.needs, *x.may)}


def _paths(kind: T.DataType, prefix: str = "") -> Iterable[str]:
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            yield path
            yield from _paths(f.dataType, path)
    elif isinstance(kind, T.ArrayType):
        yield from _paths(kind.elementType, f"{prefix}[]")


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of the known paths among ``paths``."""
    return hashlib.sha256("\n".join(sorted(_KNOWN & {*paths})).encode()).hexdigest()


def _registry() -> dict[str, Layout]:
    """Every fingerprint a layout can have: its needed paths with any choice of those it may have."""
    found: dict[str, Layout] = {}
    for x in LAYOUTS:
        lists = {p.split("[")[0] for p in x.needs if "[" in p}
        fixed = {*x.needs, *(p for p in x.may if p in lists)}
        free = [p for p in x.may if p not in lists]
        for n in range(len(free) + 1):
            for more in itertools.combinations(free, n):
                found.setdefault(fingerprint(fixed | {*more}), x)
    return found


REGISTRY = _registry()


def layout_of(schema: T.StructType) -> Layout:
    """The layout of a table."""
    paths = {*_paths(schema)}
    if found := REGISTRY.get(fingerprint(paths)):
        return found
    for x in LAYOUTS:
        if {*x.needs} <= paths:
            return x
    raise ValueError(f"no layout fits the fields {sorted(paths)}")


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    role = F.coalesce(role, F.lit(""))
    for a, b in roles.items():
        role = F.when(F.lower(role) == a, F.lit(b)).otherwise(role)
    return role


def to_turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of a table in any known layout, other columns left out.

    A record without a conv_id column is named by a hash of its turns. A null role or text is empty; a record whose list of
    turns is null or empty has no turn.
    """
    layout = layout_of(df.schema)
    if layout.rows:
        return df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    there = {f.name for f in df.schema.fields}
    turns = layout.turns(lambda p: F.col(f"`{p}`") if p in there else F.lit(None).cast("string"))
    conv = F.col("conv_id").cast("long") if "conv_id" in there else F.xxhash64(turns)
    return df.select(conv.alias("conv_id"), F.posexplode(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long").alias("turn"), _renamed(F.col("t.role"), layout.roles).alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))


def json_to_turns(records: DataFrame, column: str = "payload") -> DataFrame:
    """(conv_id, turn, role, text, layout) of JSON records of any mixture of layouts (not turn rows).

    Each record's paths (its keys, and those of all elements of its lists) are hashed, and the hash selects the mapping, by the
    rule that holds for tables. A null role or text, or one that an element of a list doesn't have, is empty. A null,
    unreadable or unknown record gives one row with layout null and turn null; one without turns a row with turn null.
    """
    text = F.col(column)
    none = F.array().cast("array<string>")
    keys = F.coalesce(F.json_object_keys(text), none)
    lists = sorted({p.split("[")[0] for p in _KNOWN if "[" in p})

    def inside(a: str) -> Column:
        elements = F.coalesce(F.from_json(F.get_json_object(text, f"$.{a}"), "array<string>"), none)
        found = F.flatten(F.transform(elements, lambda e: F.coalesce(F.json_object_keys(e), none)))
        return F.transform(found, lambda k: F.concat(F.lit(f"{a}[]."), k))

    nested = F.concat(*[inside(a) for a in lists])
    known = F.filter(F.array_distinct(F.concat(keys, nested)), lambda p: p.isin(*sorted(_KNOWN)))
    marked = records.withColumn("_paths", known).withColumn("_print", F.sha2(F.array_join(F.array_sort("_paths"), "\n"), 256))
    kinds = {x.name: x for x in LAYOUTS if not x.rows}
    by_print = F.create_map(*[F.lit(v) for h, x in REGISTRY.items() if not x.rows for v in (h, x.name)])
    has_all = [F.when(F.size(F.array_except(F.array(*map(F.lit, x.needs)), F.col("_paths"))) == 0, F.lit(x.name)) for x in kinds.values()]
    name = F.coalesce(F.try_element_at(by_print, F.col("_print")), *has_all)

    def mapped(x: Layout) -> Column:
        fields = []
        for p in sorted({p.split("[")[0] for p in (*x.needs, *x.may)} - {"conv_id"}):
            inner = [q.split(".")[1] for q in x.needs if q.startswith(f"{p}[].")]
            fields.append(f"{p} array<struct<{','.join(f'`{q}`:string' for q in inner)}>>" if inner else f"{p} string")
        parsed = F.from_json(text, ", ".join(fields))
        return F.transform(x.turns(lambda p: parsed[p]), lambda t: F.struct(_renamed(t["role"], x.roles).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))

    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for x in kinds.values():
        turns = F.when(F.col("layout") == x.name, mapped(x)).otherwise(turns)
    conv = F.coalesce(F.get_json_object(text, "$.conv_id").try_cast("long"), F.xxhash64(text))
    return marked.withColumn("layout", name).select(conv.alias("conv_id"), "layout", F.posexplode_outer(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text", "layout")


# ---------------------------------------------------------------- template


def _literal(s: Column, find: str, put: str) -> Column:
    return F.replace(s, F.lit(find), F.lit(put))


def escape(s: Column, header: bool = False) -> Column:
    s = _literal(_literal(s, "\\", "\\b"), "<|", "<\\p")
    return _literal(s, "\n", "\\l") if header else s


def unescape(s: Column) -> Column:
    return _literal(_literal(_literal(s, "\\p", "|"), "\\l", "\n"), "\\b", "\\")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): each conversation's text by the template, and the spans of the assistant's texts in it.

    Turns come in order of turn (null first), then role and text; equal rows each stay. A null role or text is empty. Turns
    with a null conv_id form one conversation with a null id. A conversation is one string, so its size is that of its turns.
    An empty table gives no rows.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escape(F.col("role"), header=True), F.lit("\n"))
    body = escape(F.col("text"))
    rows = rows.withColumns({"piece": F.concat(head, body, F.lit(f"{END}\n")), "head": F.length(head), "body": F.length(body)})
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumns({"n": F.row_number().over(order), "before": F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))})
    at = F.coalesce("before", F.lit(0)) + F.col("head")
    part = F.struct("n", "piece", F.when(F.col("role") == LEARNED, F.struct(at.alias("start"), (at + F.col("body")).alias("end"))).alias("span"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.select("conv_id", F.array_join("parts.piece", "").alias("formatted"), F.filter("parts.span", lambda s: s.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn of a formatted conversation."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")
    body = lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p))
    return F.transform(pieces, lambda p: F.struct(unescape(F.substring_index(body(p), "\n", 1)).alias("role"), unescape(F.substring(body(p), F.length(F.substring_index(body(p), "\n", 1)) + 2, F.length(p))).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")
