"""Candidate keys: the first combination of columns, in order of preference, that tells all rows apart."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, USE_RANK, ProfileConfig
from ..storage import Stored
from .cells import text_table

_CATEGORY = {"Boolean": 2, "IntegerValue": 1, "DecimalValue": 1, "Date": 3, "Time": 3, "DateTime": 3}


def main_uses(groups: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(ord, col_name, main_use): the most generic use of a column; blocked uses only where there is no other."""
    rank = F.lit(0)
    for use, r in USE_RANK.items():
        rank = F.when(F.col("use") == use, r).otherwise(rank)
    blocked = F.col("use").isin(*config.blocked_key_uses)
    return groups.groupBy("col_name").agg(F.min("ord").alias("ord"), F.max_by("use", F.struct(~blocked, rank)).alias("main_use"))


def _has_key(columns: list[str]) -> Column:
    """Whether any of the cells says more than '' or 0; other rows don't count."""
    return F.exists(F.array(*[F.col(f"`{c}`") for c in columns]), lambda x: ~x.isin("", "0"))


def uniqueness(text: DataFrame, candidates: list[tuple[str, ...]]) -> DataFrame:
    """(candidate, n_rows, n_distinct) of combinations of columns, all in one aggregation; rows without a key don't count."""
    # One text for a combination, each cell but the last behind its length, so that no two combinations give the same.
    cell = lambda x: F.concat(F.length(f"`{x}`").cast("string"), F.lit(":"), F.col(f"`{x}`"))
    whole = lambda c: F.when(_has_key(list(c)), F.concat(*map(cell, c[:-1]), F.col(f"`{c[-1]}`")))
    keys = F.array(*[F.struct(F.lit(i).alias("i"), whole(c).alias("key")) for i, c in enumerate(candidates)])
    each = text.select(F.explode(keys).alias("x")).select("x.*").where("key is not null").groupBy("i", "key").agg(F.count("*").alias("n"))
    found = each.groupBy("i").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct"))
    names = text.sparkSession.createDataFrame([(i, ",".join(c)) for i, c in enumerate(candidates)], "i int, candidate string")
    zero = F.lit(0).cast("long")
    return names.join(F.broadcast(found), "i", "left").select("candidate", F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("n_distinct", zero).alias("n_distinct"))


def repeated_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(n_rows, n_distinct_rows) of the texts of some columns."""
    text = text_table(df).select(*(columns or df.columns))
    return text.groupBy(*text.columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct_rows"))


def key_collisions(df: DataFrame, columns: list[str], limit: int = 10) -> DataFrame:
    """The combinations that occur most often beyond once: a report of at most ``limit`` rows."""
    return text_table(df).groupBy(*columns).agg(F.count("*").alias("n_rows")).where("n_rows > 1").orderBy(F.desc("n_rows"), *columns).limit(limit)


#: Rows of a class from which on its rows are dealt to many tasks, and to how many.
_HOT, _DEALS = 200_000, 64


def _with_classes(rows: DataFrame, sums: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` (with row) that are in a class of ``sums`` (by, n and others), with what it says of the class. The rows of a large class
    are dealt to many tasks; there are at most as many such classes as rows by ``_HOT``, so their names are broadcast."""
    large = F.col("n") > _HOT
    hot = F.broadcast(sums.where(large).select(*by, F.lit(True).alias("hot")))
    dealt = rows.join(hot, by, "left").withColumn("deal", F.when(F.col("hot"), F.pmod(F.xxhash64("row"), F.lit(_DEALS)).cast("int")).otherwise(0)).drop("hot")
    each = sums.withColumn("deal", F.explode(F.when(large, F.sequence(F.lit(0), F.lit(_DEALS - 1))).otherwise(F.array(F.lit(0))))).drop("n")
    return dealt.join(each, [*by, "deal"]).drop("deal")


class Refinement:
    """Which sets of columns tell rows apart, by partitions refined column by column.

    A column's partition holds, of the different rows, only those whose value occurs again, each with the number of its class (the
    least row number in it). The partition of a set is that of the set without its last column, joined with that column's by
    row; classes of one row go. So a row leaves as soon as a set tells it apart, and each width reads what the width before it
    has left. Rows whose cells are all '' or 0 don't count: their classes are ``blank``, and stay only to be refined.

    Columns are numbered in order of ``names``. Sums come before joins, so a class of a third of all rows is no task's.
    """

    def __init__(self, text: DataFrame, names: list[str]):
        self.names = names
        self.rows = Stored(text.select(*names).distinct().withColumn("row", F.monotonically_increasing_id()), "keys-rows")
        parts = F.array(*[F.struct(F.lit(i).alias("last"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(names)])
        cells_ = self.rows.df.select("row", F.explode(parts).alias("c")).select("row", "c.*")
        sums = cells_.groupBy("last", "value").agg(F.count("*").alias("n"), F.min("row").alias("class"))
        facts = sums.groupBy("last").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct"), F.sum(F.when(F.col("value") == "", F.col("n"))).alias("empty"), F.sum(F.when(F.col("value") == "0", F.col("n"))).alias("zero"))
        #: Of each column: the filled cells, those that are 0, and the distinct values.
        self.facts = {names[r["last"]]: {"filled": r["rows"] - (r["empty"] or 0), "zeros": r["zero"] or 0, "distinct": r["distinct"]} for r in facts.collect()}
        again = sums.where("n > 1").withColumn("blank", F.col("value").isin("", "0"))
        self.single = Stored(_with_classes(cells_, again, ["last", "value"]).select("last", "row", "class", "blank"), "keys-classes")
        #: Of each width the tables (set, last, row, class, blank); ``set`` lists the columns.
        self.parts: dict[int, list[Stored]] = {}

    def singles(self, new: set[int]) -> DataFrame:
        return self.single.df.where(F.col("last").isin(*new)).select(F.array("last").alias("set"), "last", "row", "class", "blank")

    def add(self, width: int, new: set[int]) -> DataFrame:
        """(set): the sets of ``width`` columns, the last of them in ``new``, that leave rows together. Their partition is kept."""
        if width == 1:
            parts = self.singles(new)
        else:
            before = self.parts[width - 1][0].df
            for p in self.parts[width - 1][1:]:
                before = before.unionByName(p.df)
            one = self.single.df.where(F.col("last").isin(*new)).select(F.col("last").alias("next"), "row", F.col("class").alias("own"), F.col("blank").alias("own_blank"))
            both = before.join(one, "row").where("next > last").select("set", "next", "row", "class", "own", (F.col("blank") & F.col("own_blank")).alias("blank"))
            sums = both.groupBy("set", "next", "class", "own").agg(F.count("*").alias("n"), F.min("row").alias("least")).where("n > 1")
            left = _with_classes(both, sums, ["set", "next", "class", "own"])
            parts = left.select(F.concat("set", F.array("next")).alias("set"), F.col("next").alias("last"), "row", F.col("least").alias("class"), "blank")
        kept = Stored(parts, f"keys-width-{width}")
        self.parts.setdefault(width, []).append(kept)
        return kept.df.where("not blank").select("set").distinct()

    def counted(self, column: str) -> bool:
        """Whether some row of the column says more than '' or 0."""
        own = self.facts.get(column)  # none where there is no row
        return own is not None and own["filled"] > own["zeros"]

    def drop(self) -> None:
        for p in (self.rows, self.single, *[x for t in self.parts.values() for x in t]):
            p.drop()


def _trimmed(df: DataFrame, names: list[str]) -> DataFrame:
    return text_table(df).select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in names])


#: Rows of the first part in which rows that agree are looked for; each next part is so many times as large.
_FIRST_PART, _LARGER = 100_000, 16
#: Pairs of rows with the same lead, for each row of the table, that are compared one by one; and rows of a task that pairs them.
_PAIRS, _TASK_ROWS = 64, 500_000
#: Columns whose bits are in one number.
_WORD = 62


def _at(bits: int) -> list[int]:
    """The columns of a set, which is a number with a bit for each."""
    return [i for i in range(bits.bit_length()) if bits >> i & 1]


def _agree(sets: list[int], equal: Callable[[int], Column]) -> Column:
    """Whether all columns of any of the sets are equal; the columns that many sets have come first."""
    if 0 in sets or not sets:
        return F.lit(bool(sets))
    first = max(_at(functools.reduce(int.__or__, sets)), key=lambda i: sum(c >> i & 1 for c in sets))
    found = equal(first) & _agree([c & ~(1 << first) for c in sets if c >> first & 1], equal)
    rest = [c for c in sets if not c >> first & 1]
    return found | _agree(rest, equal) if rest else found


class _Agreement:
    """Which sets of columns some different rows agree on, by pairs of rows as proof.

    A first part of the rows is looked through: all rows of some values of the columns with many values, and rows at random. There each
    set is hashed for itself. Sets without a pair there go on to a larger part and at last to all rows, where not sets but pairs are
    made: sets share a lead, columns with few pairs of rows that agree on them. Rows are dealt by lead once, whatever the number of
    sets; rows of one lead are compared in pairs, and only which columns agree leaves the task, with a pair of each kind. So all
    sets around a lead are settled at once. Pairs are found by hashes and compared by their texts, on the driver: one pair a set or kind.
    """

    def __init__(self, text: DataFrame, names: list[str]):
        self.names, self.own = names, [F.col(f"`{c}`") for c in names]
        numbered = lambda df: Stored(df.withColumn("row", F.monotonically_increasing_id()), "sets-rows")
        self.rows = numbered(text.select(*names))
        # Whole rows are only moved if two of them may be equal.
        each = self.rows.df.groupBy(F.xxhash64(*self.own).alias("h")).agg(F.count("*").alias("n"))
        if each.agg(F.coalesce(F.sum("n"), F.lit(0)) > F.count("*")).first()[0]:
            every, self.rows = self.rows, numbered(self.rows.df.select(*names).distinct())
            every.drop()
        facts = self.rows.df.agg(F.count("*").alias("n"), *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(self.own)], *[F.count_if(~c.isin("", "0")).alias(f"s{i}") for i, c in enumerate(self.own)]).first()
        self.n = facts["n"]
        self.distinct = [facts[f"d{i}"] for i in range(len(names))]
        self.says = sum(1 << i for i in range(len(names)) if facts[f"s{i}"] > 0)  # columns in which some row says more than '' or 0
        self.pairs: set[tuple[int, int]] = set()  # columns in which two rows agree, and those of them that say something
        self.counted: dict[int, bool] = {}  # sets whose texts were counted, and whether rows agree on them
        self.doubtful: list[int] = []  # columns in which hashes of two rows agree and texts don't
        # The first part, and what share of the rows it is.
        self.share = max(self.n // _FIRST_PART, 1)
        self.leads = [i for i, d in enumerate(self.distinct) if d >= 64 * self.share] if self.share > 1 else []
        mine = {i: self._in_part(i, self.share) for i in (-1, *self.leads)}
        part = self.rows.df.where(functools.reduce(Column.__or__, mine.values())).withColumn("leads", F.array_compact(F.array(*[F.when(x, F.lit(i)) for i, x in mine.items()])))
        self.part = part.repartition(part.sparkSession.sparkContext.defaultParallelism).persist()  # a row of it is hashed for many sets
        self.pairs_of: dict[int, float] = {}  # estimated pairs of rows that agree on a lead

    def drop(self) -> None:
        self.part.unpersist()
        self.rows.drop()

    def _in_part(self, i: int, share: int) -> Column:
        """Whether a row is in one of ``share`` parts, by its value in a column, or at random."""
        return F.pmod(F.xxhash64(F.col("row") if i < 0 else F.xxhash64(self.own[i])), F.lit(share)) == 0

    def known(self, c: int) -> bool:
        return self.counted.get(c, False) or any(c & same == c and c & full for same, full in self.pairs)

    def candidates(self, width: int) -> list[int]:
        """The sets of at most ``width`` columns that no known rows agree on, without those that have a smaller one inside."""
        found: list[int] = []
        for k in range(1, min(width, len(self.names)) + 1):
            sets = [sum(1 << i for i in c) for c in itertools.combinations(range(len(self.names)), k)]
            found += [c for c in sets if c & self.says and not any(f & c == f for f in found) and not self.known(c)]
        return found

    def minimal(self, width: int) -> list[int]:
        """The sets that tell all rows apart which say something in them, without those that have a smaller one inside."""
        share = self.share
        while share:
            #: (set, columns, whether all sets of these columns that contain it are settled too)
            settled: list[tuple[int, int, bool]] = []
            while left := [c for c in self.candidates(width) if not any(c == s or (more and s & c == s and c & cols == c) for s, cols, more in settled)]:
                if share == self.share:
                    self.look(left)
                    settled += [(c, c, False) for c in left]
                else:
                    settled += self.compare(left, share)
                if share == 1:
                    self._count_doubtful(width)
            share = share // _LARGER if share >= 2 * _LARGER else int(share > 1)
        return self.candidates(width)

    def _count_doubtful(self, width: int) -> None:
        """Count the texts of the sets in which two rows have the same hashes and other texts."""
        while left := [c for c in self.candidates(width) if c not in self.counted and any(c & m == c for m in self.doubtful)]:
            for c in left:
                own = [self.own[i] for i in _at(c)]
                self.counted[c] = self.rows.df.where(_has_key([self.names[i] for i in _at(c)])).groupBy(*own).count().where("count > 1").limit(1).count() > 0

    def _verify(self, found: list[tuple[int, int, int]], rows: DataFrame, whole: bool) -> None:
        """Compare the texts of pairs (columns whose hashes agree, a row, another row)."""
        wanted = rows.sparkSession.createDataFrame([(x,) for x in sorted({x for _, *p in found for x in p})], "row long")
        texts = {r["row"]: r for r in rows.join(F.broadcast(wanted), "row").select("row", *self.own).collect()}
        for hashed, a, b in found:
            same = sum(1 << i for i, c in enumerate(self.names) if texts[a][c] == texts[b][c])
            if hashed & same != hashed and whole:
                self.doubtful.append(hashed)
            self.pairs.add((same, sum(1 << i for i in _at(same) if texts[a][self.names[i]] not in ("", "0"))))

    def _keyed(self, rows: DataFrame, sets: list[int], lead: dict[int, int]) -> DataFrame:
        """(at, key, row): the hash of each row for each set, among the rows of the set's lead."""
        asked = rows.sparkSession.createDataFrame([(at, lead.get(c, -1), _at(c)) for at, c in enumerate(sets)], "at int, lead int, cols array<int>")
        rows = rows.select("row", F.array(*[F.xxhash64(c) for c in self.own]).alias("h"), F.array(*[~c.isin("", "0") for c in self.own]).alias("says"), F.explode("leads").alias("lead"))
        both = rows.join(F.broadcast(asked), "lead")
        return both.select("at", F.xxhash64(F.transform("cols", lambda i: F.get("h", i))).alias("key"), "row", F.exists("cols", lambda i: F.get("says", i)).alias("says"))

    def look(self, sets: list[int]) -> None:
        """Look for a pair of each set in the first part."""
        lead = {c: max(own, key=lambda i: self.distinct[i]) for c in sets if (own := [i for i in _at(c) if i in self.leads])}
        again = self._keyed(self.part, sets, lead).where("says").groupBy("at", "key").agg(F.min("row").alias("a"), F.max("row").alias("b")).where("a < b")
        found = [(sets[r["at"]], r["p"]["a"], r["p"]["b"]) for r in again.groupBy("at").agg(F.min(F.struct("a", "b")).alias("p")).collect()]  # a pair a set
        if found:
            self._verify(found, self.part, self.share == 1)

    def _leads(self, sets: list[int]) -> list[tuple[int, bool, list[int]]]:
        """(lead, whether rows that say nothing in it count, sets): the fewest of a set's most distinct columns that few pairs agree on, by
        the rows at random of the first part. A set whose rows agree often where it says nothing leads itself."""
        dealt: dict[tuple[int, bool], list[int]] = {}
        order = {c: sorted(_at(c), key=lambda i: (-self.distinct[i], i)) for c in sets}
        left, k = sets, 1
        while left:
            first = {c: sum(1 << i for i in order[c][:k]) for c in left}
            new = sorted({f for c, f in first.items() if f != c} - set(self.pairs_of))
            if new:
                each = self._keyed(self.part.withColumn("leads", F.filter("leads", lambda i: i < 0)), new, {}).groupBy("at", "key").agg(F.count("*").alias("n"))
                pairs = {r["at"]: r["pairs"] for r in each.groupBy("at").agg(F.sum(F.expr("n * (n - 1) / 2")).alias("pairs")).collect()}
                self.pairs_of |= {f: pairs.get(at, 0) * self.share**2 for at, f in enumerate(new)}
            for c, f in first.items():
                if f == c or self.pairs_of[f] <= _PAIRS * self.n:
                    dealt.setdefault((f, f != c), []).append(c)
            done = {c for own in dealt.values() for c in own}
            left, k = [c for c in left if c not in done], k + 1
        # All sets of a lead may share more columns than those.
        return [(functools.reduce(int.__and__, own), more, own) for (_, more), own in dealt.items()]

    def compare(self, sets: list[int], share: int) -> list[tuple[int, int, bool]]:
        """Find all kinds of pairs for ``sets`` in one of ``share`` parts of the rows, or in all if that is 1. What is settled with that:
        (set, columns, whether all sets of these columns that contain it are settled too)."""
        settled, found = [], {}
        for lead, more, own in self._leads(sets):
            cols = _at(functools.reduce(int.__or__, own))
            settled += [(c, sum(1 << i for i in cols), more) for c in own]
            words = [cols[i : i + _WORD] for i in range(0, len(cols), _WORD)]
            says = [sum((F.when(self.own[i].isin("", "0"), 0).otherwise(1 << j) for j, i in enumerate(w)), F.lit(0).cast("long")).alias(f"says{at}") for at, w in enumerate(words)]
            rows = self.rows.df
            if share > 1:
                top = max(_at(lead), key=lambda i: self.distinct[i])
                rows = rows.where(self._in_part(top if self.distinct[top] >= 64 * share else -1, share))
            if not more:
                rows = rows.where(_has_key([self.names[i] for i in _at(lead)]))
            rows = rows.select("row", *[F.xxhash64(self.own[i]).alias(f"h{i}") for i in cols], *says)
            # The two sides read the same columns, so rows are moved once.
            tasks = max(rows.sparkSession.sparkContext.defaultParallelism, self.n // share // _TASK_ROWS)
            rows = rows.repartition(tasks, *[f"h{i}" for i in _at(lead)])
            a, b = rows.alias("a"), rows.alias("b")
            equal = lambda i: F.col(f"a.h{i}") == F.col(f"b.h{i}")
            # Pairs that agree on no set are left out by the join; what is left is little.
            pairs = a.join(b, [*map(equal, _at(lead)), F.col("a.row") < F.col("b.row"), _agree([c & ~lead for c in own], equal)])
            same = [sum((F.when(equal(i), 1 << j).otherwise(0) for j, i in enumerate(w)), F.lit(0).cast("long")).alias(f"same{at}") for at, w in enumerate(words)]
            both = [F.col(f"a.says{at}").bitwiseAND(F.col(f"b.says{at}")).alias(f"says{at}") for at in range(len(words))]
            pairs = pairs.select(*same, *both, F.struct("a.row", F.col("b.row").alias("other")).alias("pair"))
            for r in pairs.groupBy(*[f"{x}{at}" for x in ("same", "says") for at in range(len(words))]).agg(F.min("pair").alias("pair")).collect():
                kind = [sum(1 << i for at, w in enumerate(words) for j, i in enumerate(w) if r[f"{x}{at}"] >> j & 1) for x in ("same", "says")]
                if full := kind[0] & kind[1]:
                    found[kind[0], full] = (r["pair"]["row"], r["pair"]["other"])
        # A kind inside another says nothing new.
        best: list[tuple[int, int]] = []
        for kind in sorted(found, key=lambda x: (-x[0].bit_count(), -x[1].bit_count())):
            if not any(kind[0] & s == kind[0] and kind[1] & f == kind[1] for s, f in (*self.pairs, *best)):
                best.append(kind)
        if best:
            self._verify([(kind[0], *found[kind]) for kind in best], self.rows.df, share == 1)
        return settled


def unique_sets(df: DataFrame, columns: list[str], width: int = 5) -> DataFrame:
    """(n_columns, columns): the sets of at most ``width`` columns that tell the different rows apart and have no smaller such set
    inside. Rows whose cells are all '' or 0 don't count for a set; a set without any other row tells nothing apart."""
    seen = _Agreement(_trimmed(df, columns), columns)
    try:
        found = [_at(c) for c in seen.minimal(width)]
    finally:
        seen.drop()
    return df.sparkSession.createDataFrame([(len(c), ",".join(columns[i] for i in c)) for c in found], "n_columns int, columns string")


def find_key(df: DataFrame, groups: DataFrame, config: ProfileConfig = DEFAULT) -> tuple[list[str], bool]:
    """(columns of the key, whether ``key_candidates`` cut the search short); no column if no combination of up to ``key_width`` is unique.

    Columns come by level of how many cells are filled, then code before number, boolean, date and others, then by
    position; single columns before pairs, and so on. Equal rows count once. All combinations of one width are tested in one
    job on what the width before has left; their number alone reaches the driver, unless one of them is a key.
    """
    uses = {r["col_name"]: (r["ord"], r["main_use"]) for r in main_uses(groups, config).collect()}
    names = [c for c in df.columns if c in uses and uses[c][1] not in config.blocked_key_uses]
    if not names:
        return [], False
    text = _trimmed(df, names)
    counts = text.distinct().agg(*[F.count_if(F.col(f"`{c}`") != "").alias(f"f{i}") for i, c in enumerate(names)]).first()
    filled = {c: counts[f"f{i}"] for i, c in enumerate(names)}
    category = {c: 0 if uses[c][1].endswith("Code") else _CATEGORY.get(uses[c][1], 4) for c in names}
    # By level first: the combinations that are new at a level are those with one of its columns as the last.
    names = sorted((c for c in names if filled[c] > 0), key=lambda c: (-filled[c], category[c], uses[c][0]))
    if not names:
        return [], False
    r, tried = Refinement(text, names), 0
    try:
        for level in sorted({filled[c] for c in names}, reverse=True):
            pool = [c for c in names if filled[c] >= level]
            new = {i for i, c in enumerate(pool) if filled[c] == level}
            for width in range(1, min(config.key_width, len(pool)) + 1):
                many = math.comb(len(pool), width) - math.comb(len(pool) - len(new), width)
                cut = config.key_candidates is not None and tried + many > config.key_candidates
                together = r.add(width, new)
                n = together.count()
                if n < many or cut:
                    bad = {tuple(x["set"]) for x in together.collect()}
                    ordered = itertools.combinations(sorted(pool, key=lambda c: (category[c], uses[c][0])), width)
                    ordered = (c for c in ordered if any(filled[x] == level for x in c))
                    for c in itertools.islice(ordered, config.key_candidates - tried) if cut else ordered:
                        if tuple(sorted(names.index(x) for x in c)) not in bad and any(r.counted(x) for x in c):
                            return list(c), False
                    if cut:
                        return [], True
                tried += many
        return [], False
    finally:
        r.drop()


def find_keys(cells_: DataFrame, uses: DataFrame, config: ProfileConfig = DEFAULT) -> DataFrame:
    """(table, key_columns): ``find_key`` for many tables in the same jobs. ``cells_`` (table, row, ord, col_name, value) are those that
    aren't empty, ``uses`` is (table, ord, col_name, main_use). Tables without a key aren't there.

    One step tests, in every table that has no key yet, all combinations of one width that are new at its level of filled cells;
    so there are as many steps as the table with the most levels asks for, however many tables.
    """
    spark = cells_.sparkSession
    wanted = uses.where(~F.col("main_use").isin(*config.blocked_key_uses))
    category = F.when(F.col("main_use").endswith("Code"), 0)
    for use, c in _CATEGORY.items():
        category = category.when(F.col("main_use") == use, c)
    wanted = wanted.select("table", "ord", "col_name", category.otherwise(4).alias("category"))
    own = cells_.join(wanted.select("table", "ord"), ["table", "ord"])
    # Equal rows are one; a row has as many cells as its table columns at most.
    whole = own.groupBy("table", "row").agg(F.array_sort(F.collect_list(F.struct("ord", "value"))).alias("own")).select("table", "own").distinct()
    rows = Stored(whole.withColumn("row", F.monotonically_increasing_id()), "keys-rows")
    filled = rows.df.select("table", F.explode("own").alias("c")).groupBy("table", F.col("c.ord").alias("ord")).agg(F.count("*").alias("filled"), F.count_if(F.col("c.value") != "0").alias("telling"))
    by_level = Window.partitionBy("table").orderBy(F.desc("filled"))
    facts = wanted.join(filled, ["table", "ord"])
    facts = facts.withColumns({"last": (F.row_number().over(Window.partitionBy("table").orderBy(F.desc("filled"), "category", "ord")) - 1).cast("int"), "level": F.dense_rank().over(by_level), "place": F.row_number().over(Window.partitionBy("table").orderBy("category", "ord"))})
    facts = Stored(facts, "keys-columns")
    columns = facts.df.groupBy("table").agg(F.collect_list(F.struct("last", "ord", "level")).alias("columns"))
    value = lambda c: F.coalesce(F.get(F.filter("own", lambda x: x["ord"] == c["ord"]), F.lit(0))["value"], F.lit(""))
    every = rows.df.join(columns, "table").select("table", "row", F.explode(F.transform("columns", lambda c: F.struct(c["last"].alias("last"), c["level"].alias("level"), value(c).alias("value")))).alias("c")).select("table", "row", "c.*")
    sums = every.groupBy("table", "last", "value").agg(F.count("*").alias("n"), F.min("row").alias("class")).where("n > 1")
    single = Stored(_with_classes(every, sums, ["table", "last", "value"]).select("table", "last", "level", "row", "class", F.col("value").isin("", "0").alias("blank")), "keys-classes")
    #: Columns of each table up to each level, which say how many combinations there are.
    sizes = {}
    for r in facts.df.groupBy("table", "level").agg(F.count("*").alias("n")).collect():  # as many as headers have levels
        sizes.setdefault(r["table"], {})[r["level"]] = r["n"]
    found: dict[str, list[str]] = {}
    parts: dict[int, list[Stored]] = {}
    names: dict[str, list] = {}
    for level in range(1, max((max(x) for x in sizes.values()), default=0) + 1):
        for width in range(1, config.key_width + 1):
            open_ = [t for t, x in sizes.items() if t not in found and level in x and sum(n for k, n in x.items() if k <= level) >= width]
            if not open_:
                continue
            left = spark.createDataFrame([(t,) for t in open_], "table string")
            new = single.df.where(F.col("level") == level).join(left, "table", "left_semi")
            if width == 1:
                part = new.select("table", F.array("last").alias("set"), "last", "row", "class", "blank")
            else:
                before = parts[width - 1][0].df
                for p in parts[width - 1][1:]:
                    before = before.unionByName(p.df)
                one = new.select("table", F.col("last").alias("next"), "row", F.col("class").alias("own"), F.col("blank").alias("own_blank"))
                both = before.join(one, ["table", "row"]).where("next > last").select("table", "set", "next", "row", "class", "own", (F.col("blank") & F.col("own_blank")).alias("blank"))
                again = both.groupBy("table", "set", "next", "class", "own").agg(F.count("*").alias("n"), F.min("row").alias("least")).where("n > 1")
                part = _with_classes(both, again, ["table", "set", "next", "class", "own"]).select("table", F.concat("set", F.array("next")).alias("set"), F.col("next").alias("last"), "row", F.col("least").alias("class"), "blank")
            kept = Stored(part, f"keys-width-{width}")
            parts.setdefault(width, []).append(kept)
            together = kept.df.where("not blank").select("table", "set").distinct()
            seen = {r["table"]: r["n"] for r in together.groupBy("table").agg(F.count("*").alias("n")).collect()}
            many = {t: math.comb(sum(n for k, n in sizes[t].items() if k <= level), width) - math.comb(sum(n for k, n in sizes[t].items() if k < level), width) for t in open_}
            short = [t for t in open_ if seen.get(t, 0) < many[t]]
            if not short:
                continue
            some = spark.createDataFrame([(t,) for t in short], "table string")
            bad: dict[str, set] = {}
            for r in together.join(some, "table", "left_semi").collect():
                bad.setdefault(r["table"], set()).add(tuple(r["set"]))
            for r in facts.df.join(some, "table", "left_semi").where(F.col("table").isin(*[t for t in short if t not in names])).orderBy("table", "place").collect():
                names.setdefault(r["table"], []).append(r)
            for t in short:
                pool = [c for c in names[t] if c["level"] <= level]
                for c in itertools.combinations(pool, width):
                    if any(x["level"] == level for x in c) and any(x["telling"] for x in c) and tuple(sorted(x["last"] for x in c)) not in bad.get(t, set()):
                        found[t] = [x["col_name"] for x in c]
                        break
    for p in (rows, facts, single, *[x for ps in parts.values() for x in ps]):
        p.drop()
    return spark.createDataFrame(list(found.items()), "table string, key_columns array<string>")
