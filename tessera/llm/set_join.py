"""Jaccard join of word-shingle sets, light sets by subsets and heavy ones by inverted lists.

Sets of n and m elements are linked if they share at least o(n, m) elements
(:func:`needed`). Copies become one class (node) first.

* Light sets (up to a boundary): each enumerates its subsets of o(n, m)
  elements, for every size m that a partner may have. Sets that meet in a
  subset share enough, so all of size n in it are linked with all of size m:
  tying each to the least of the other side links the same documents.
* Heavy sets: each scans the inverted lists of its prefix, the n - o + 1
  elements that come first in one fixed order, rarer ones first; two linked
  sets meet in one list at least. Sets met are counted over all scanned lists,
  and a pair stays only if its count leaves room for o(n, m).
* Lists longer than ``CROWD`` are not paired out: their members are compared
  with the list's centre, and those of lists that do not end in one component
  meet by how they differ from it (``near_duplicates.unlike_pairs``).
* The boundary is the size up to which subsets cost fewer rows than scans.

How rare an element is comes from ``CELLS`` counters over all documents.
Elements that share a counter get the same place in the order, then go by
hash: any fixed order gives right results, a good one short lists.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import _cut, release, rows_of, small_batches, stored
from tessera.llm.graph import components
from tessera.llm.near_duplicates import unlike_pairs, verified_pairs
from tessera.llm.shingles import mix, shingle_sets

CELL_BITS = 22
CELLS = 1 << CELL_BITS
#: Counters travel in blocks of this many, as packed 16-bit numbers.
BLOCK = 4096
#: Largest set that may be light; its subsets are enumerated if that is cheaper.
MOST_LIGHT = 30
#: Lists up to this length are paired out.
CROWD = 24

DIGESTS = "doc_id long, n_shingles long, c1 long, c2 long, block int, times binary"
HEADS = "doc_id long, n_shingles long, c1 long, c2 long, scan long, elements array<long>"
SUBSETS = "k1 long, k2 long, lo int, hi int, n int, node long"


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap o with 100 * o >= percent * (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def needed_column(n: Column, m: Column, percent: int) -> Column:
    return F.ceil((n + m) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9))


def least_partner(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Size of the smallest set that can be linked with one of ``n`` elements."""
    return -(-percent * n // 100)


def partner_sizes(n: int, percent: int) -> range:
    return range(least_partner(n, percent), 100 * n // percent + 1)


def n_subsets(n: int, percent: int) -> int:
    """Rows that a light set of ``n`` elements emits."""
    return sum(comb(n, needed(n, m, percent)) for m in partner_sizes(n, percent))


def digest(flat: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    run = np.r_[np.uint64(0), np.cumsum(mix(flat ^ np.uint64(salt)))]
    return (run[at[1:]] - run[at[:-1]]).view(np.int64)


SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def digests(texts: DataFrame, k: int) -> DataFrame:
    """Size and digest of each row's set, and (rows with a block) a task's element counters."""
    schema = to_arrow_schema(StructType.fromDDL(DIGESTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in _cut(batch, "text", 2_000_000):
                flat, at = shingle_sets(part.column("text"), k)
                counters += np.bincount((flat >> np.uint64(64 - CELL_BITS)).astype(np.int64),
                                        minlength=CELLS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(at)),
                     *(pa.array(digest(flat, at, s)) for s in SALTS),
                     pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())], schema=schema)
        yield from packed_counters(counters, schema)
        del counters
        release()

    return texts.mapInArrow(run, DIGESTS)


def packed_counters(counters: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Counters as rows (..., block, times); the columns before these two are null."""
    rows = np.minimum(counters, 65535).astype(np.uint16).reshape(-1, BLOCK)
    used = np.flatnonzero(rows.any(1))
    none = [pa.nulls(len(used), f.type) for f in list(schema)[:-2]]
    yield pa.RecordBatch.from_arrays(
        [*none, pa.array(used.astype(np.int32)),
         pa.array([zlib.compress(rows[i].tobytes(), 1) for i in used], pa.binary())], schema=schema)


def rarity(blocks: DataFrame) -> bytes:
    """A byte a counter, growing with its sum over all tasks (eight steps a doubling)."""
    schema = to_arrow_schema(StructType.fromDDL("block int, level binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            level = np.minimum(np.floor(8 * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()),
                                               pa.array([level.tobytes()], pa.binary())], schema=schema)
        at, total = None, None
        for batch in batches:
            for block, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != at:
                    if at is not None:
                        yield row()
                    at, total = block, np.zeros(BLOCK, np.int64)
                total += np.frombuffer(zlib.decompress(times), np.uint16)
        if at is not None:
            yield row()

    merged = (blocks.repartition("block").sortWithinPartitions("block")
              .mapInArrow(run, "block int, level binary").toArrow())  # CELLS bytes at most
    levels = np.zeros((CELLS // BLOCK, BLOCK), np.uint8)
    for block, level in zip(merged["block"].to_pylist(), merged["level"].to_pylist(), strict=True):
        levels[block] = np.frombuffer(level, np.uint8)
    return levels.tobytes()


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - least_partner(n, percent) + 1


def heads(texts: DataFrame, k: int, percent: int, levels: bytes) -> DataFrame:
    """Each row's prefix in the common order (a light set's elements all), and what scanning costs."""
    schema = to_arrow_schema(StructType.fromDDL(HEADS))
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(shared.value, np.uint8)
        length = np.exp2(np.arange(256) / 8)  # rows about, in the list of an element of a level
        for batch in batches:
            for part in _cut(batch, "text", 2_000_000):
                flat, at = shingle_sets(part.column("text"), k)
                cell = (flat >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                # the counter's level leads, the hash's low bits follow: one number orders both
                element = ((level[cell].astype(np.uint64) << np.uint64(56))
                           | (flat & np.uint64((1 << 56) - 1)))
                sizes = np.diff(at)
                own, scans = [], np.zeros(len(sizes), np.int64)
                for i, n in enumerate(sizes):
                    order = np.argsort(element[at[i]:at[i + 1]])
                    first = order[:prefix_length(n, percent)] if n else order
                    scans[i] = length[level[cell[at[i]:at[i + 1]][first]]].sum()
                    own.append(element[at[i]:at[i + 1]][order if n <= MOST_LIGHT else first])
                offsets = np.r_[0, np.cumsum([len(x) for x in own])]
                values = np.concatenate([*own, np.empty(0, np.uint64)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes),
                     *(pa.array(digest(flat, at, s)) for s in SALTS), pa.array(scans),
                     lists.cast(schema.field("elements").type)], schema=schema)
        release()

    return texts.mapInArrow(run, HEADS)


def boundary(sizes: list, percent: int) -> int:
    """Size up to which enumerating subsets costs fewer rows than scanning lists.

    ``sizes``: (n, sets, scan) with the rows that all scans of sets of n elements read.
    """
    gain, best, most = 0, 0, 0
    for n, sets, scan in sorted(sizes):
        gain += scan - sets * n_subsets(n, percent)
        if gain > most:
            best, most = n, gain
    return best


def subset_links(nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among light ``nodes`` (node, n, elements)."""
    schema = to_arrow_schema(StructType.fromDDL(SUBSETS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            out = [[] for _ in range(6)]
            for node, n, elements in zip(*(batch.column(c).to_pylist() for c in (
                    "node", "n", "elements")), strict=True):
                hashes = np.array(elements, np.int64).view(np.uint64)
                salted = [mix(hashes ^ np.uint64(s)) for s in SALTS]
                for m in partner_sizes(n, percent):
                    gone = n - needed(n, m, percent)
                    if (n, gone) not in left_out:
                        left_out[n, gone] = np.array(list(combinations(range(n), gone)),
                                                     np.int64).reshape(comb(n, gone), gone)
                    keys = [(s.sum() - s[left_out[n, gone]].sum(1, dtype=np.uint64)).view(np.int64)
                            for s in salted]
                    for column, values in zip(out, (*keys, *(np.full(len(keys[0]), x) for x in (
                            min(n, m), max(n, m), n, node))), strict=True):
                        column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*c, np.empty(0, np.int64)]), f.type)
                 for c, f in zip(out, schema, strict=True)], schema=schema)
        release()

    rows = stored(nodes.select("node", "n", "elements").mapInArrow(run, SUBSETS), "subsets")
    key = ["k1", "k2", "lo", "hi"]
    met = (rows.groupBy(*key).agg(F.min(F.when(F.col("n") == F.col("lo"), F.col("node"))).alias("least"),
                                  F.min(F.when(F.col("n") == F.col("hi"), F.col("node"))).alias("other"),
                                  F.max("node").alias("last"))
           .filter("least is not null and other is not null and (lo < hi or least < last)"))
    links = rows.join(met, key).select(
        "node", F.when(F.col("n") == F.col("lo"), F.col("other")).otherwise(F.col("least")).alias("to"))
    return (links.filter("node <> to")
            .select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")).distinct())


def list_pairs(lists: DataFrame, crowded: DataFrame, light: int, percent: int) -> DataFrame:
    """Pairs (a, b) that meet in lists of up to ``CROWD`` and may share enough.

    ``lists`` has (element, node, n). What two sets share is at most the
    elements counted in their scanned prefixes, plus those that both hold in
    crowded lists, plus what the longer rest behind the prefix may hold.
    """
    side = lambda x: lists.select("element", F.col("node").alias(x), F.col("n").alias(f"n_{x}"))
    larger = (F.col("n_x") > F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("x") < F.col("y")))
    pairs = (side("x").join(side("y"), "element")
             .filter(larger & (F.col("n_x") > light) & (F.col("n_y") * 100 >= F.col("n_x") * percent))
             .groupBy("x", "y", "n_x", "n_y").agg(F.count(F.lit(1)).alias("met")))
    rest = F.ceil(F.col("n_x") * F.lit(percent) / F.lit(100) - F.lit(1e-9)) - F.lit(1)
    short = F.col("met") + rest < needed_column(F.col("n_x"), F.col("n_y"), percent)
    hidden = crowded.groupBy("node").agg(F.count(F.lit(1)).alias("hidden"))
    for x in ("x", "y"):
        pairs = pairs.join(hidden.select(F.col("node").alias(x), F.col("hidden").alias(f"h_{x}")), x, "left")
    more = F.least(F.coalesce("h_x", F.lit(0)), F.coalesce("h_y", F.lit(0)))
    short = F.col("met") + more + rest < needed_column(F.col("n_x"), F.col("n_y"), percent)
    return pairs.filter(~short).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def ngram_join(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Documents are linked if 100 * |intersection| >= ``percent`` * |union| for
    their sets of ``k``-word shingles (A-Z lower-cased, split at ASCII blanks);
    component_id is the least id reachable by links.

    Defined cases: a text without words (or null) has the empty set and is
    linked with nothing; with fewer than ``k`` words the whole sequence is the
    only shingle; rows that share an id are one document that has the links of
    all its rows, each row with its own n_shingles; a null id gets component
    null and links nothing; other columns are not read; an empty table gives an
    empty result. Shingles are compared by 64-bit hashes, sets by 128 bits.
    """
    texts = _texts(docs, id_col, text_col)
    found = stored(digests(texts, k), "digests")
    rows = found.filter("block is null").select("doc_id", "n_shingles", "c1", "c2")
    same = ["n_shingles", "c1", "c2"]
    levels = rarity(found.filter("block is not null").select("block", "times"))

    reps = (rows.filter("doc_id is not null and n_shingles > 0").groupBy(*same)
            .agg(F.min("doc_id").alias("doc_id")))
    head = heads(texts, k, percent, levels).filter("doc_id is not null and n_shingles > 0")
    # one row a class, before anything is emitted for its copies
    one = (head.join(reps, [*same, "doc_id"]).groupBy(*same, "doc_id")
           .agg(F.first("scan").alias("scan"), F.first("elements").alias("elements")))
    nodes = stored(one.withColumn("node", F.monotonically_increasing_id())
                   .withColumn("n", F.col("n_shingles").cast("int")), "nodes")

    sizes = (nodes.filter(F.col("n") <= MOST_LIGHT).groupBy("n")
             .agg(F.count(F.lit(1)).alias("sets"), F.sum("scan").alias("scan")).collect())
    light = boundary([tuple(r) for r in sizes], percent)
    links = subset_links(nodes.filter(F.col("n") <= light), percent)

    keep = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100) - F.lit(1e-9)) + F.lit(1)
    scanned = (nodes.filter(F.col("n") >= least_partner(light + 1, percent))
               .select("node", "n", F.explode(F.slice("elements", F.lit(1), keep.cast("int")))
                       .alias("element")))
    lengths = scanned.groupBy("element").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    lists = stored(scanned.join(lengths, "element"), "lists")
    crowded = lists.filter(F.col("length") > CROWD).select("element", "node", "n")
    pairs = stored(list_pairs(lists.filter(F.col("length") <= CROWD), crowded, light, percent), "pairs")

    # crowded lists: each member with the member that most crowded lists share
    met = crowded.groupBy("node").agg(F.count(F.lit(1)).alias("met"))
    centres = (crowded.join(met, "node").groupBy("element")
               .agg(F.max_by(F.struct("node", "n"), F.struct("met", "node")).alias("c"))
               .select("element", F.col("c.node").alias("centre"), F.col("c.n").alias("n_centre")))
    live = stored(crowded.join(centres, "element"), "live")
    sizes_fit = (F.least("n", "n_centre") * 100 >= F.greatest("n", "n_centre") * F.lit(percent))
    stars = live.filter((F.col("node") != F.col("centre")) & sizes_fit).select(
        F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()

    # full sets of those that are compared, one row a node
    asked = stored(pairs.select(F.explode(F.array("a", "b")).alias("node"))
                   .union(live.select("node")).distinct().join(nodes.select("node", "doc_id", *same), "node"),
                   "asked")
    sets = stored(_full_sets(texts, asked, k), "sets")
    links = stored(links.union(verified_pairs(pairs.union(stars).distinct(), sets, percent)), "links")
    labels = components(links)
    live = stored(live.join(labels, "node", "left")
                  .withColumn("component", F.coalesce("component", "node")), "live")
    left = (live.groupBy("element").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo < hi").select("element"))
    own = live.filter("node = centre").select("element", F.col("component").alias("of_centre"))
    open_stars = (live.join(left, "element").filter("node <> centre").join(own, "element")
                  .select("centre", F.col("node").alias("rep"), "component",
                          (F.col("component") != F.col("of_centre")).alias("outside")).distinct())
    more = stored(unlike_pairs(stored(open_stars, "stars"), sets, percent), "pairs")
    links = links.union(verified_pairs(more, sets, percent))

    # rows that share an id tie their sets together; then the least id of each component
    every = (rows.filter("doc_id is not null and n_shingles > 0").distinct()
             .join(nodes.select(*same, "node"), same).select("doc_id", "node", "n_shingles", "c1", "c2"))
    every = stored(every, "members")
    ties = (every.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z"))
            .filter("a < z").join(every, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b"))
    labels = components(stored(links.union(ties), "links"))
    every = (every.join(labels, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = every.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = (every.select("doc_id", "component").distinct().join(least, "component")
             .groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    return rows.join(named, "doc_id", "left").select("doc_id", "n_shingles", F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _full_sets(texts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles): the full set of each node in ``asked``, under its node's number."""
    fields = "doc_id long, n_shingles long, c1 long, c2 long, shingles binary"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _cut(batch, "text", 2_000_000):
                flat, at = shingle_sets(part.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(at)),
                     *(pa.array(digest(flat, at, s)) for s in SALTS),
                     pa.array([flat[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:], strict=True)],
                              pa.binary())], schema=schema)
        release()

    ids = stored(asked.select("doc_id").distinct(), "ids")
    made = rows_of(texts.select("doc_id", "text"), ids).mapInArrow(run, fields)
    return (made.join(asked, ["doc_id", "n_shingles", "c1", "c2"]).groupBy("node")
            .agg(F.first("shingles").alias("shingles")).withColumnRenamed("node", "doc_id"))
