"""Near-duplicate documents by SetSketch registers, banding, likelihood and exact checks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import _cut, release, small_batches, stored
from tessera.llm.graph import components
from tessera.llm.shingles import SetSketch, mix, shingle_sets

REGISTERS, BAND = 128, 4
#: Registers are compared by likelihood first; only pairs estimated this far
#: below the threshold (over six standard errors of 128 registers) are let go.
ESTIMATE_MARGIN = 0.2
#: Bytes of text hashed at once: hashing takes 50 times as much memory, sketching goes over it 128 times.
PART = 500_000
SKETCHES = "doc_id long, n_shingles long, c1 long, c2 long, registers binary"
SETS = "doc_id long, shingles binary"


def _map_texts(docs: DataFrame, id_col: str, text_col: str, schema: str, make) -> DataFrame:
    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in _cut(batch, "text", PART):
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(make(part), out_schema, strict=True)],
                    schema=out_schema)
        release()

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def sketches(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, a 128-bit digest of the shingle set and its registers, per row."""
    sketch = SetSketch(REGISTERS)

    def make(part: pa.RecordBatch) -> list[pa.Array]:
        flat, at = shingle_sets(part.column(1), k)
        sums = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            run = np.r_[np.uint64(0), np.cumsum(mix(flat ^ np.uint64(salt)))]
            sums.append(pa.array((run[at[1:]] - run[at[:-1]]).view(np.int64)))
        rows = sketch.of(flat, at)
        return [part.column(0), pa.array(np.diff(at)), *sums,
                pa.array([r.tobytes() for r in rows], pa.binary())]

    return _map_texts(docs, id_col, text_col, SKETCHES, make)


def full_sets(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    def make(part: pa.RecordBatch) -> list[pa.Array]:
        flat, at = shingle_sets(part.column(1), k)
        return [part.column(0), pa.array([flat[lo:hi].tobytes() for lo, hi in
                                          zip(at[:-1], at[1:], strict=True)], pa.binary())]

    return _map_texts(docs, id_col, text_col, SETS, make)


def _pair_filter(pairs: DataFrame, keep) -> DataFrame:
    """Rows (a, b) of ``pairs`` for which ``keep`` (batch -> mask) holds."""
    schema = to_arrow_schema(StructType.fromDDL("a long, b long"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                mask = pa.array(keep(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").filter(mask), batch.column("b").filter(mask)], schema=schema)
        release()

    return pairs.mapInArrow(run, "a long, b long")


def likely_pairs(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose registers make it likely."""
    sketch = SetSketch(REGISTERS)
    side = lambda x: nodes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                  F.col("registers").alias(f"r_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9))

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        rows = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                .reshape(-1, REGISTERS) for c in ("r_a", "r_b")]
        sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
        return sketch.similarity(*rows, *sizes) >= threshold - ESTIMATE_MARGIN

    return _pair_filter(joined, keep)


def verified_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * |intersection| >= percent * |union| on their full sets."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def keep(batch: pa.RecordBatch) -> list[bool]:
        out = []
        for one, two in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(),
                            strict=True):
            one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
            both = len(np.intersect1d(one, two, assume_unique=True))
            out.append(100 * both >= percent * (len(one) + len(two) - both))
        return out

    return _pair_filter(joined, keep)


def unlike_pairs(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of unfinished buckets that may still be linked.

    ``stars`` has (centre, rep, component, outside): every member of a bucket
    that is not in one component, with its centre and whether it is outside the
    centre's component (so not linked to it). Let D be the elements in which a
    member differs from the centre. For x outside and y any member, a link
    needs D_x and D_y to share more than (|D_x| + |D_y| - e) / 2 elements,
    where e is how much linked sets of their sizes may differ; and |D_x| alone
    exceeds what a link to the centre allows, so this is above half of |D_y|,
    about, and of |D_x| all but e. Hence, with D ordered by how rarely an
    element is a difference from this centre, the first e elements of D_x and
    the first half of D_y have one in common, and only such pairs are made.
    What most members share with each other or have lost comes last and brings
    nobody together.
    """
    t = percent / 100
    fields = ("centre long, rep long, component long, outside boolean, n int, d int, first int, "
              "half int, elements array<long>")
    schema = to_arrow_schema(StructType.fromDDL(fields))
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s_{x}"))
    joined = stars.join(side("centre"), "centre").join(side("rep"), "rep") \
        .select("centre", "rep", "component", "outside", "s_centre", "s_rep")

    def run(batches):
        for batch in batches:
            sizes, firsts, halves, elements = [], [], [], []
            for one, two in zip(batch.column("s_centre").to_pylist(),
                                batch.column("s_rep").to_pylist(), strict=True):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                own = np.setxor1d(one, two, assume_unique=True)
                shared = (len(own) + (1 - t) / (1 + t) * (len(one) - len(two))) / 2
                halves.append(max(len(own) - max(1, int(np.floor(shared - 1e-9)) + 1) + 1, 0))
                firsts.append(int(len(two) * (1 - t) / t + 1e-9) + 1)
                elements.append(own.view(np.int64))
                sizes.append(len(two))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(sizes, pa.int32()),
                 pa.array([len(e) for e in elements], pa.int32()), pa.array(firsts, pa.int32()),
                 pa.array(halves, pa.int32()), pa.array(elements, pa.list_(pa.int64()))],
                schema=schema)
        release()

    rows = stored(joined.mapInArrow(run, fields), "differences")
    each = rows.select("centre", "rep", F.explode("elements").alias("element"))
    often = each.groupBy("centre", "element").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    order = (each.join(often, ["centre", "element"], "left")
             .groupBy("centre", "rep")
             .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"),
                                                       "element"))).alias("order")))
    rows = rows.drop("elements").join(order, ["centre", "rep"]).withColumn(
        "order", F.slice("order", 1, F.greatest(F.when(F.col("outside"), F.col("first"))
                                                .otherwise(F.lit(0)), "half")))
    spread = rows.select("centre", "rep", "component", "outside", "n", "d", "first", "half",
                         F.posexplode("order").alias("at", "e")).filter("e.n > 1")
    spread = stored(spread.withColumn("element", F.col("e.element")).drop("e"), "spread")
    side = lambda x: ["centre", "element", F.col("rep").alias(x), *(
        F.col(c).alias(f"{c}_{x}") for c in ("component", "n", "d", "at"))]
    one, two = (spread.filter("outside and at < first").select(*side("x")),
                spread.filter("at < half").select(*side("y")))
    # the first element they share must leave room for all that a link shares
    shared = F.floor((F.col("d_x") + F.col("d_y")
                      - F.lit((1 - t) / (1 + t)) * (F.col("n_x") + F.col("n_y"))) / 2 - F.lit(1e-9))
    room = F.least(F.col("d_x") - F.col("at_x"), F.col("d_y") - F.col("at_y"))
    return (one.join(two, ["centre", "element"])
            .filter((F.col("component_x") != F.col("component_y"))
                    & (F.least("n_x", "n_y") >= F.greatest("n_x", "n_y") * F.lit(t - 1e-9))
                    & (room >= F.greatest(F.lit(0), shared) + F.lit(1)))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked if the Jaccard similarity of their ``k``-word shingle
    sets is at least ``percent`` / 100; components are those of all links.

    Rows with equal sets become one class first, so copies cost one row each.
    Classes that agree on all registers of some band are candidates. Within a
    bucket of candidates, not all pairs are made: every class is paired with
    the bucket's centre (the class that meets most others), and a bucket is
    done if all its classes are then in one component. The members of other
    buckets meet by how they differ from the centre, see :func:`unlike_pairs`.
    So each pair of a bucket is connected, checked or ruled out. Pairs pass an
    estimate by joint likelihood of the registers and then the exact check on
    full sets.

    Defined cases: a text without words (or null) has no shingle and is linked
    with nothing; with fewer than ``k`` words the whole sequence is the only
    shingle; rows that share an id are one document, each with its own
    n_shingles; a null id gets component null and is kept; an empty table gives
    an empty result; other columns are not read.
    """
    found = stored(sketches(docs, k, id_col, text_col), "sketches")
    same_set = ["n_shingles", "c1", "c2"]
    classes = stored(found.filter("n_shingles > 0 and doc_id is not null").groupBy(*same_set)
                     .agg(F.min("doc_id").alias("rep"), F.first("registers").alias("registers")),
                     "classes")
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 1 + 2 * BAND * i, 2 * BAND))
                     for i in range(REGISTERS // BAND)])
    bands = classes.select("rep", F.explode(keys).alias("key"))
    shared = (bands.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"),
                                       F.count(F.lit(1)).alias("size"))
              .filter("lo < hi").select("key", "size"))
    buckets = stored(bands.join(shared, "key").select("key", "rep", "size"), "buckets")
    candidates = stored(buckets.groupBy("rep").agg(F.sum("size").alias("met")), "candidates")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")) \
        .join(candidates.select("rep"), "rep")
    # rows that share id and text give one set
    texts = texts.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), "text")) \
        .dropDuplicates(["rep", "t1", "t2"])
    sets = stored(full_sets(texts, k, "rep", "text"), "sets")
    nodes = stored(classes.join(candidates, "rep")
                   .select("rep", "met", "n_shingles", "registers"), "nodes")
    met = nodes.groupBy("rep").agg(F.max("met").alias("met"))
    buckets = buckets.select("key", "rep").distinct()

    # every class with its bucket's centre
    centres = (buckets.join(met, "rep").groupBy("key")
               .agg(F.max_by("rep", F.struct("met", "rep")).alias("centre")))
    live = stored(buckets.join(centres, "key"), "live")
    pairs = (live.filter("rep <> centre").select(F.least("rep", "centre").alias("a"),
                                                 F.greatest("rep", "centre").alias("b")).distinct())
    links = stored(verified_pairs(likely_pairs(pairs, nodes, percent / 100), sets, percent), "links")
    labels = components(links).withColumnRenamed("node", "rep")
    # buckets that are not in one component yet
    live = stored(live.join(labels, "rep", "left")
                  .withColumn("component", F.coalesce("component", "rep")), "live")
    left = (live.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo < hi").select("key"))
    own = live.filter("rep = centre").select("key", F.col("component").alias("of_centre"))
    stars = (live.join(left, "key").filter("rep <> centre").join(own, "key")
             .select("centre", "rep", "component",
                     (F.col("component") != F.col("of_centre")).alias("outside")).distinct())
    more = stored(unlike_pairs(stars, sets, percent), "pairs")
    more = stored(verified_pairs(likely_pairs(more, nodes, percent / 100), sets, percent), "links")
    labels = components(links.union(more)).withColumnRenamed("node", "rep")

    rows = found.select("doc_id", *same_set).join(classes.select(*same_set, "rep"), same_set, "left")
    rows = rows.join(labels, "rep", "left")
    whole = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(
        F.coalesce("component", "rep", "doc_id"))
    return rows.select("doc_id", "n_shingles", whole.cast("long").alias("component_id"),
                       F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"))

