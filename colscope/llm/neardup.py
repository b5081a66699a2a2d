"""MinHash near-duplicate detection with exact confirmation and connected components.

1. One pass turns each text into its set of word shingles: ``bands * 5`` minima of universal hashes (multiply-shift)
   over the set, banded by fives, and a 128-bit name of the whole set, half of it from hashes of another family. Equal sets
   collapse to one representative.
2. Representatives that share a band form candidate clusters (alternating large-star and small-star on band stars).
   A cluster of up to ``unit`` texts is one unit of work, so each of its sets is shipped once. In larger clusters the
   band buckets are the units. A bucket above ``unit`` is first dealt into blocks, each with the bucket's least text; a text
   takes part in two such buckets at most here, as that finds nearly all links, and the rest comes in step 5.
3. In a unit, signatures rule out pairs (six standard deviations below the threshold); no text has moved yet. Only texts of a pair
   that is left are fetched, past a bounded filter, to units of at most ``UNIT_BYTES`` (beyond that in pairs of blocks). Full sets
   confirm pairs by both families of hashes, and only a spanning forest of the confirmed links leaves the unit.
4. Connected components of the links, again by alternating large-star and small-star.
5. A bucket above ``unit`` whose texts are not of one component yet is cut into blocks, and those pairs of blocks that hold
   more than its largest component are units of a second pass. Where the bands of a cluster gather much the same texts, its buckets
   are taken as one, so that a pair is compared once and not in each band; each cluster goes the way that ships fewer rows. Texts of
   one component need no check, so in the end every pair of every bucket is compared or known to be connected.

A pair at the threshold is missed by all bands with a probability below 1e-7; the number of bands follows from the
threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ODD, U64, Kept, Words, chunks, components, mix, release, run_chains, run_sums, ship
from .substring import _filter, _may_hold

ROWS = 5
MISS = 1e-7
#: Bytes of text of a unit; a single text may have more.
UNIT_BYTES = 24_000_000
#: Names of texts to fetch up to which they are sent to all; more go past a filter.
SENT_ROWS = 50_000


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def universal(k: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(0, 2**63, k, dtype=U64) * U64(2) + U64(1), r.integers(0, 2**64, k, dtype=U64)


def shingle_sets(column, width: int) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each text, hashes of another family in the same order) for runs of rows.

    Words are lower-cased in A-Z only. A text with fewer words than ``width`` has its whole sequence as one shingle,
    one without words has none.
    """
    for a, b, data, offsets in chunks(column):
        w = Words(data, offsets, lower=True)
        count = np.diff(w.first)
        many = np.maximum(count - width + 1, np.minimum(count, 1))
        doc = np.repeat(np.arange(b - a), many)
        start = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + w.first[:-1][doc]
        end = np.minimum(start + width, w.first[1:][doc])
        one, two = run_sums(w.sums(), start, end), run_chains(w.chains(), start, end)
        order = np.lexsort((one, doc))
        one, two, doc = one[order], two[order], doc[order]
        keep = np.ones(len(one), bool)
        keep[1:] = (one[1:] != one[:-1]) | (doc[1:] != doc[:-1])
        one, two, doc = one[keep], two[keep], doc[keep]
        cut = np.searchsorted(doc, np.arange(b - a + 1))
        yield a, [one[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)], [two[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]


def minima(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over ``x``."""
    best = np.full(len(a), np.iinfo(U64).max, U64)
    for i in range(0, len(x), 256):
        part = x[i : i + 256, None] * a[None, :]
        part += b
        np.minimum(best, part.min(axis=0), out=best)
    return best


SIGNED = "doc_id long, h long, n_bytes long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"


def _signer(width: int, bands: int):
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_bytes", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])
    name = lambda x: int(mix(x).sum(dtype=U64).astype(np.int64))

    def run(batches):
        a, b = universal(bands * ROWS)
        for batch in batches:
            ids, hashes, size = (x.to_pylist() for x in (batch.column("doc_id"), batch.column("h"), pc.binary_length(batch.column("text"))))
            for first, ones, twos in shingle_sets(batch.column("text"), width):
                out = []
                for k, (x, y) in enumerate(zip(ones, twos, strict=True), first):
                    if not len(x):
                        out.append((ids[k], hashes[k], size[k], 0, 0, 0, None, None))
                        continue
                    least = minima(x, a, b)
                    band = mix((least.reshape(bands, ROWS) * _ODD[:ROWS]).sum(axis=1, dtype=U64))
                    out.append((ids[k], hashes[k], size[k], len(x), name(x), name(y), band.astype(np.int64).tolist(), (least >> U64(56)).astype(np.uint8).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _partners(i: int, other: np.ndarray, root: np.ndarray, sides: np.ndarray, blocks: np.ndarray, size: np.ndarray, signatures: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``other`` that ``i`` may be linked to, by sizes and signatures, beyond what is connected already."""
    k = signatures.shape[1]
    floor = k * (percent / 100 - 6 * math.sqrt(percent / 100 * (1 - percent / 100) / k))
    ok = (root[other] != root[i]) & (100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i]))
    for apart in (sides, blocks):
        if apart[i]:
            ok &= apart[other] != apart[i]
    other = other[ok]
    return other[(signatures[other] == signatures[i]).sum(axis=1) >= floor] if len(other) else other


def confirmed_links(ids: np.ndarray, sides: np.ndarray, blocks: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], others: list[np.ndarray], signatures: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of a unit, beyond what equal ``parts`` connect.

    ``sides`` and ``blocks`` are 0 for members that are compared with all, else 1 and 2 for those compared with each other only.
    ``others`` are the sets by another family of hashes, which has to agree. Pairs already connected need no check: the forest has
    the same components.
    """
    n = len(ids)
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if n else np.zeros(0, U64)
    cut = np.concatenate([[0], np.cumsum(size)])
    _, flat = np.unique(flat, return_inverse=True)
    mark = np.zeros(int(flat.max()) + 1 if len(flat) else 1, bool)
    root = np.unique(parts, return_inverse=True)[1]
    enough = lambda both, i, j: 100 * both >= percent * (size[i] + size[j] - both)
    found = []
    for i in range(n - 1):
        other = _partners(i, np.arange(i + 1, n), root, sides, blocks, size, signatures, percent)
        if not len(other):
            continue
        mark[flat[cut[i] : cut[i + 1]]] = True
        for j in other:
            if root[j] != root[i] and enough(int(mark[flat[cut[j] : cut[j + 1]]].sum()), i, j) and enough(len(np.intersect1d(others[i], others[j])), i, j):
                found.append((int(ids[i]), int(ids[j])))
                root[root == root[j]] = root[i]
        mark[flat[cut[i] : cut[i + 1]]] = False
    return found


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(table.num_rows, -1)


def _left_over(percent: int):
    """The members of a unit that signatures leave a possible link."""

    def run(table: pa.Table) -> pa.Table:
        side, size, signatures = table.column("side").to_numpy(), table.column("n_shingles").to_numpy(), _signatures(table)
        root = np.unique(table.column("part").to_numpy(), return_inverse=True)[1]
        left, none = np.zeros(table.num_rows, bool), np.zeros(table.num_rows, np.int32)
        for i in range(table.num_rows - 1):
            other = _partners(i, np.arange(i + 1, table.num_rows), root, side, none, size, signatures, percent)
            left[other] = True
            left[i] |= len(other) > 0
        return table.filter(pa.array(left)).select(["unit", "side", "rid", "part", "n_bytes"])

    return run


def _linker(width: int, percent: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid")
        sets, others = [None] * table.num_rows, [None] * table.num_rows
        for first, ones, twos in shingle_sets(table.column("text"), width):
            sets[first : first + len(ones)], others[first : first + len(ones)] = ones, twos
        links = confirmed_links(*(table.column(c).to_numpy() for c in ("rid", "side", "block", "part")), sets, others, _signatures(table), percent)
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def _needed(bits):
    """The rows whose key the filter may hold."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_may_hold(bits.value, batch.column("key").to_numpy())))

    return run


def _in_bytes(members: Kept, most: int) -> DataFrame:
    """(unit, side, block, rid, part): units of more than ``most`` bytes in pairs of blocks, those of ``block`` 1 against 2."""
    total = members.df.groupBy("unit").agg(F.sum("n_bytes").alias("total")).where(F.col("total") > most)
    rows = members.df.join(total, "unit", "left")
    small = rows.where("total is null").select("unit", "side", F.lit(0).alias("block"), "rid", "part")
    count = F.ceil(F.col("total") / (most // 2)).cast("int")
    large = rows.where("total is not null").withColumns({"mine": F.pmod(F.xxhash64("rid", F.lit(9)), count).cast("int"), "with": F.explode(F.sequence(F.lit(0), count - 1))})
    block = F.when(F.col("mine") == F.col("with"), 0).when(F.col("mine") < F.col("with"), 1).otherwise(2)
    return small.unionByName(large.select(F.xxhash64("unit", F.least("mine", "with"), F.greatest("mine", "with")).alias("unit"), "side", block.alias("block"), "rid", "part"))


def _block_pairs(rows: DataFrame, count: str) -> DataFrame:
    """(unit, side, rid, part): rows of a key, each in its ``block``, for each pair of blocks; ``count`` blocks stand against each."""
    rows = rows.select("rid", "part", "key", "block", F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias("with"))
    return rows.select(F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with")).alias("unit"), F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2).alias("side"), "rid", "part")


def _one_of_each(members: DataFrame) -> DataFrame:
    """(key): one of the keys with the same members. A sum of hashes names the membership."""
    named = members.groupBy("key").agg(F.sum(F.xxhash64("rid").cast("decimal(38,0)")).alias("a"), F.sum(F.xxhash64("rid", F.lit(1)).cast("decimal(38,0)")).alias("b"))
    return named.groupBy("a", "b").agg(F.min("key").alias("key")).select("key")


def _units(reps: DataFrame, unit: int) -> tuple[Kept, Kept]:
    """(unit, side, rid, part): what is compared together, and (key, rid, cluster): the buckets above ``unit`` of large clusters, of which
    some pairs are left for the second pass. See the module's docstring, steps 2 and 5."""
    keyed = reps.select("rid", F.posexplode("bands").alias("band", "value")).select("rid", F.xxhash64("band", "value").alias("key"))
    sizes = Kept(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("low")).where("n > 1"), "neardup-sizes")
    inside = Kept(keyed.join(sizes.df, "key"), "neardup-buckets")
    sizes.drop()
    cluster = components(inside.df.select(F.col("rid").alias("u"), F.col("low").alias("v")), "neardup-clusters")
    large = cluster.df.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > unit).select("component")
    whole = cluster.df.join(large, "component", "left_anti").select(F.xxhash64(F.lit("c"), "component").alias("unit"), F.col("node").alias("rid"))
    heavy = cluster.df.join(large, "component", "left_semi").select(F.col("node").alias("rid"))
    pieces = inside.df.join(heavy, "rid", "left_semi")
    wide = Kept(pieces.where(F.col("n") > unit).join(cluster.df.select(F.col("node").alias("low"), F.col("component").alias("cluster")), "low"), "neardup-wide")
    # Two buckets of a text, the same ones as far as it shares them with others.
    two = wide.df.groupBy("rid").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("key").alias("order"), "key", "n", "low"))), 1, 2).alias("two"))
    two = two.select("rid", F.explode("two").alias("b")).select("rid", "b.low", F.xxhash64("b.key", F.pmod(F.xxhash64("rid", F.lit(5)), F.ceil(F.col("b.n") / (unit // 2)))).alias("key"))
    small = pieces.where(F.col("n") <= unit).select("key", "rid").unionByName(two.select("key", "rid")).unionByName(two.select("key", F.col("low").alias("rid")).distinct())
    # Bands often gather the same texts; such buckets are one unit.
    small = small.join(_one_of_each(small), "key", "left_semi").select(F.col("key").alias("unit"), "rid").distinct()
    units = Kept(whole.unionByName(small).select("unit", F.lit(0).alias("side"), "rid", F.col("rid").alias("part")), "neardup-units")
    for x in (inside, cluster):
        x.drop()
    return units, wide


def _in_blocks(members: DataFrame, unit: int) -> DataFrame:
    """(cluster, key, rid, part, block, against): the members of keys of several components, dealt to blocks. A key's largest component
    has blocks of its own, which are compared with those of the rest only."""
    sizes = members.groupBy("key", "part").agg(F.count("*").alias("n"))
    most = sizes.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n")).where("n > n_main")
    blocks = lambda n: F.ceil(n / (unit // 2)).cast("int")
    members = members.join(most, "key").withColumns({"rest": blocks(F.col("n") - F.col("n_main")), "mains": blocks(F.col("n_main")), "hash": F.xxhash64("rid", F.lit(5))})
    inner = F.col("part") == F.col("main")
    block = F.when(inner, F.col("rest") + F.pmod("hash", "mains")).otherwise(F.pmod("hash", "rest")).cast("int")
    return members.select("cluster", "key", "rid", "part", block.alias("block"), F.when(inner, F.col("rest")).otherwise(F.col("rest") + F.col("mains")).alias("against"))


def _left_units(wide: DataFrame, reached: DataFrame, unit: int) -> Kept:
    """(unit, side, rid, part): what large buckets still have to compare. See the module's docstring, step 5."""
    members = Kept(wide.select("cluster", "key", "rid").join(reached, F.col("rid") == F.col("node"), "left").select("cluster", "key", "rid", F.coalesce("component", "rid").alias("part")), "neardup-left-members")
    whole = members.df.select("cluster", F.xxhash64(F.lit("w"), "cluster").alias("key"), "rid", "part").distinct()
    ways = [Kept(_in_blocks(x, unit), "neardup-left-blocks") for x in (members.df.join(_one_of_each(members.df), "key", "left_semi"), whole)]
    cost = [x.df.groupBy("cluster").agg(F.sum(F.col("against").cast("long")).alias(name)) for x, name in zip(ways, ("apart", "together"), strict=True)]
    fewer = F.broadcast(cost[0].join(cost[1], "cluster").where("together < apart").select("cluster"))
    rows = ways[0].df.join(fewer, "cluster", "left_anti").unionByName(ways[1].df.join(fewer, "cluster", "left_semi"))
    left = Kept(_block_pairs(rows, "against"), "neardup-left-units")
    for x in (members, *ways):
        x.drop()
    return left


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, unit: int = 512) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id, component_id, kept.

    Two texts are linked when the intersection of their shingle sets is at least ``threshold`` of the union
    (in whole percents). component_id is the smallest doc_id that links reach, the text's own included; class_id the
    smallest doc_id with the same set; kept is doc_id = component_id.

    Null, empty and blank texts have n_shingles 0, stand alone and are kept. A null doc_id keeps its row, with
    class_id, component_id null and kept true, and links nothing. Rows that repeat a doc_id each keep their row; a doc_id
    whose rows hold different texts joins what any of them joins. Other columns are not read. An empty table gives none.
    """
    spark = docs.sparkSession
    ship(spark)
    percent = round(threshold * 100)
    bands = bands_for(percent / 100)
    # h tells texts of one doc_id apart.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text", F.lit(3)).alias("h"))
    signed = Kept(rows.select("doc_id", "h", "text").mapInArrow(_signer(width, bands), SIGNED), "neardup-signed")
    full = signed.df.where("doc_id is not null and n_shingles > 0")
    names = ["set_a", "set_b", "n_shingles"]
    # Written before it is joined, so that a set that many texts share can be split among tasks.
    classes = Kept(full.groupBy(*names).agg(F.min(F.struct("doc_id", "h")).alias("f"), F.count("*").alias("copies")).select(*names, F.col("f.doc_id").alias("class_id"), F.col("f.h").alias("class_h"), "copies"), "neardup-classes")
    # A text is named by its doc_id, unless some doc_id has several texts.
    several = full.select("doc_id", "h").distinct().groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0
    rid = F.xxhash64("doc_id", "h") if several else F.col("doc_id")
    firsts = classes.df.select(F.col("class_id").alias("doc_id"), F.col("class_h").alias("h"))
    reps = Kept(full.join(firsts, ["doc_id", "h"]).select(rid.alias("rid"), "doc_id", "h", "n_bytes", "n_shingles", "bands", "signature").dropDuplicates(["doc_id", "h"]), "neardup-reps")
    units, wide = _units(reps.df, unit)
    release(spark)

    def links_of(units: DataFrame) -> Kept:
        signed = units.join(reps.df.select("rid", "n_bytes", "n_shingles", "signature"), "rid").select("unit", "side", "rid", "part", "n_bytes", "n_shingles", "signature")
        left = Kept(signed.groupBy("unit").applyInArrow(_left_over(percent), "unit long, side int, rid long, part long, n_bytes long"), "neardup-left")
        chosen = Kept(left.df.select("rid").distinct().join(reps.df.select("rid", "doc_id", "h", "signature"), "rid"), "neardup-chosen")
        n, bits, there, text = chosen.df.count(), None, rows.where("doc_id is not null").select("doc_id", "h", "text"), ["doc_id", "h"]
        # Past either sieve a text moves to its name, where the names of its units meet it, and from there to its units.
        if n <= SENT_ROWS:
            near = there.join(F.broadcast(chosen.df.select(*text)), text)
        else:
            key = F.xxhash64(*text).alias("key")
            bits = _filter(chosen.df.select(key), n)
            near = there.withColumn("key", key).mapInArrow(_needed(bits), "doc_id long, h long, text string, key long")
        near = near.groupBy(*text).agg(F.first("text").alias("text"))
        work = _in_bytes(left, UNIT_BYTES).join(chosen.df, "rid").join(near, text).select("unit", "side", "block", "rid", "part", "text", "signature")
        found = Kept(work.groupBy("unit").applyInArrow(_linker(width, percent), "u long, v long"), "neardup-linked")
        if bits is not None:
            bits.unpersist()
        left.drop()
        chosen.drop()
        release(spark)
        return found

    links = [links_of(units.df)]
    reached = components(links[0].df, "neardup-links")
    if wide.df.limit(1).count():
        left = _left_units(wide.df, reached.df, unit)
        if left.df.limit(1).count():
            links.append(links_of(left.df))
            reached.drop()
            reached = components(links[0].df.unionByName(links[1].df), "neardup-left-links")
        left.drop()
    # A class is a star around its representative, whose component the links give: copies need no round of their own.
    # Only a doc_id with several texts can belong to several classes; then the classes are linked as well.
    if several:
        edges = full.select("doc_id", *names).join(classes.df.select(*names, "class_id"), names).select(F.col("doc_id").alias("u"), F.col("class_id").alias("v"))
        named = lambda end: reps.df.select(F.col("rid").alias(end), F.col("doc_id").alias(f"{end}_doc"))
        for x in links:
            edges = edges.unionByName(x.df.join(named("u"), "u").join(named("v"), "v").select(F.col("u_doc").alias("u"), F.col("v_doc").alias("v")))
        reached.drop()
        reached = components(edges, "neardup-all-links")
    own = F.coalesce("component", "class_id", "doc_id")
    result = signed.df.select("doc_id", *names).join(classes.df.select(*names, "class_id"), names, "left")
    result = result.withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))).join(reached.df, F.col("class_id") == F.col("node"), "left")
    result = Kept(result.select("doc_id", "n_shingles", "class_id", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")), "neardup-result")
    for x in (signed, classes, reps, units, wide, reached, *links):
        x.drop()
    release(spark)
    return result.df


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id isn't in ``gone`` (doc_id long, distinct). Rows without a doc_id stay.

    Few ids are sent to all. Past more of them a filter passes most rows where they are, and only those it may hold are joined, so
    texts that stay don't move.
    """
    n = gone.count()
    if n <= SENT_ROWS:
        return docs.join(F.broadcast(gone), "doc_id", "left_anti").select(*docs.columns)
    key = lambda: F.xxhash64(F.col("doc_id").cast("long"))
    bits = _filter(gone.select(key().alias("key")), n)
    held = F.arrow_udf(lambda keys: pa.array(_may_hold(bits.value, keys.to_numpy())), "boolean")
    return docs.where(~held(key())).unionByName(docs.where(held(key())).join(gone, "doc_id", "left_anti").select(*docs.columns))
