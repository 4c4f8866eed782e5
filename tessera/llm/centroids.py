"""Centroid clustering in exact integers, with Orchard's search for the nearest centroid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.llm.common import release, stored

#: Below this, a component's integer squares and sums exactly in 64 bits.
SMALL = 1 << 27
LIMB = 32
RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")


class Orchard:
    """Nearest of a few centroids: per centroid, the others in order of their distance from it.

    A query holds its best centroid so far and walks down that one's list; a
    centroid that is closer (or as close with a smaller number) becomes the
    best and the walk goes over to its list. Centroids seen are marked, so each
    distance is taken once. The walk ends when the next centroid lies strictly
    beyond twice the current distance (four times, squared): by the triangle
    inequality it and all after it are farther from the query. Queries of a
    batch walk side by side.
    """

    def __init__(self, centroids: list[list[int]]) -> None:
        small = all(abs(x) < SMALL for c in centroids for x in c)
        self.centroids = np.array(centroids, np.int64 if small else object)
        gaps = self.centroids[:, None, :] - self.centroids[None, :, :]
        apart = (gaps * gaps).sum(2)
        k = len(centroids)
        self.lists = np.array([sorted((j for j in range(k) if j != i), key=lambda j: (apart[i, j], j))
                               for i in range(k)], np.int64).reshape(k, max(k - 1, 0))
        self.beyond = np.take_along_axis(apart, self.lists, 1) if k > 1 else apart[:, :0]

    def _squared(self, rows: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        gaps = rows - self.centroids[numbers]
        return (gaps * gaps).sum(1)

    def nearest(self, rows: np.ndarray, start: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid; ties take the smaller number."""
        n, k = len(rows), len(self.centroids)
        best = np.full(n, start, np.int64)
        far = self._squared(rows, best)
        seen = np.zeros((n, k), bool)
        seen[:, start] = True
        place = np.zeros(n, np.int64)
        walking = np.arange(n) if k > 1 else np.empty(0, np.int64)
        while len(walking):
            here, at = best[walking], place[walking]
            walking = walking[(self.beyond[here, at] <= 4 * far[walking]).astype(bool)]
            here, at = best[walking], place[walking]
            other = self.lists[here, at]
            place[walking] += 1
            new = ~seen[walking, other]
            asked, other = walking[new], other[new]
            seen[asked, other] = True
            squared = self._squared(rows[asked], other)
            closer = ((squared < far[asked])
                      | ((squared == far[asked]) & (other < best[asked]))).astype(bool)
            moved = asked[closer]
            best[moved], far[moved], place[moved] = other[closer], squared[closer], 0
            walking = walking[place[walking] < k - 1]
        return best, far


def integers(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, one row a vector: int64 if that is exact, else Python's."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)
    if not flat.size or np.abs(flat).max() < SMALL // (2 * scale):
        return np.floor(rows * scale).astype(np.int64)

    def exact(x: float) -> int:
        over, under = float(x).as_integer_ratio()
        return over * scale // under
    return np.array([[exact(x) for x in row] for row in rows], object)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of ``value`` in base 2**32, the top digit signed."""
    place = 0
    while value not in (0, -1):
        value, digit = divmod(value, 1 << LIMB)
        if digit:
            yield place, digit
        place += 1
    if value:
        yield place, -1


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(vector_col).alias("vector"))
            .filter((F.size("vector") == size) & F.forall("vector", whole)))


def _start_order(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def moved_sums(kept: DataFrame, centroids: list[list[int]], scale: int) -> DataFrame:
    """(cluster, component, place, digit): sums of each cluster's vectors, component -1 their count.

    A task adds its own vectors up first, so a few rows a cluster are shuffled
    whatever its share of the rows. Sums beyond 64 bits travel in base 2**32.
    """
    fields = "cluster int, component int, place int, digit long"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, totals = Orchard(centroids), {}
        for batch in batches:
            rows = integers(batch.column("vector"), scale)
            best, _ = search.nearest(rows)
            for c in np.unique(best):
                own = rows[best == c]
                before = totals.get(int(c))
                sums = [int(x) for x in own.sum(0)]
                totals[int(c)] = ([len(own), *sums] if before is None else
                                  [a + b for a, b in zip(before, [len(own), *sums], strict=True)])
        out = [(c, i - 1, place, digit) for c, sums in totals.items()
               for i, x in enumerate(sums) for place, digit in limbs(x)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
        release()

    return (kept.select("vector").mapInArrow(run, fields).groupBy("cluster", "component", "place")
            .agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")))


def assigned(kept: DataFrame, centroids: list[list[int]], scale: int) -> DataFrame:
    """vec_id, cluster and squared distance of each vector (null beyond 64 bits)."""
    fields = "vec_id long, cluster int, distance long"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for batch in batches:
            best, far = search.nearest(integers(batch.column("vector"), scale))
            if far.dtype == object:
                far = [int(x) if x < 1 << 63 else None for x in far]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(far, pa.int64())],
                schema=schema)
        release()

    return kept.select("vec_id", "vector").mapInArrow(run, fields)


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3,
                      size: int = 64, scale: int = 1024, id_col: str = "vec_id",
                      vector_col: str = "embedding") -> DataFrame:
    """Lloyd's rounds over integer vectors, each vector's centroid found by Orchard's search.

    Vectors of exactly ``size`` finite components are kept, each component x as
    floor(``scale`` * x). Centroids start as the ``k`` vectors whose id has the
    least SHA-256 after ``seed``; a round gives each vector its nearest
    centroid (ties: smaller number) and replaces each centroid that has vectors
    by the floor of their mean. One more assignment follows the rounds.

    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256 (of the final centroid's components). Only ``k`` centroids
    and their sums reach the driver.

    Defined cases: null, short, long or non-finite vectors give no row; rows
    that share an id are vectors of their own (equal hashes go by the vector);
    vectors without an id are assigned but start no centroid unless ids run
    out; with fewer than ``k`` vectors there are as many centroids; no vector:
    an empty result. Components of any size are exact; a distance or inertia
    beyond 64 bits is null. Other columns are not read.
    """
    kept = stored(kept_vectors(vectors, id_col, vector_col, size), "vectors")
    first = kept.withColumn("h", _start_order(seed)).orderBy(F.asc_nulls_last("h"), "vector").limit(k)
    column = first.select("vector").toArrow()["vector"].combine_chunks()  # k rows
    centroids = [[int(x) for x in row] for row in integers(column, scale)]
    if not centroids:
        return kept.sparkSession.createDataFrame([], RESULT)
    for _ in range(rounds):
        sums: dict[tuple[int, int], int] = {}
        for r in moved_sums(kept, centroids, scale).collect():  # a few rows a centroid
            at = (r.cluster, r.component)
            sums[at] = sums.get(at, 0) + int(r.digit) * (1 << LIMB * r.place)
        centroids = [[sums.get((c, i), 0) // sums[c, -1] for i in range(size)]
                     if (c, -1) in sums else old for c, old in enumerate(centroids)]
    out = stored(assigned(kept, centroids, scale), "assigned")
    per = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                     F.max(F.col("distance").isNull()).alias("unknown")).collect()
    inertia = {r.cluster: None if r.unknown else int(r.s) for r in per}  # a row a centroid
    whole = None if None in inertia.values() else sum(inertia.values())
    fits = lambda x: x if x is not None and x < 1 << 63 else None
    rows = [(c, fits(inertia.get(c, 0)), fits(whole),
             hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
            for c, x in enumerate(centroids)]
    each = kept.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(each), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
