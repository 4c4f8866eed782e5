"""Silver kept up to date batch by batch, and the city indicator kept by deltas.

A merged table is cut into areas: rows fall into an area by a hash of the
``within`` columns (the year: a batch of one year touches that year's areas
only) and of the key. An area is stored in segments, one a run that changed it.
A merge

1. keeps the newest row of each key in the batch;
2. opens the areas that the batch's keys fall in, no others, and looks the keys
   up there: only key and digest of the stored rows are moved to meet the batch;
3. writes the batch's rows that are not stored yet under the run's folder, by
   area, each marked if its key has a stored row (it is contested then);
4. compares contested rows with the stored ones and finds the keys that change;
5. writes a manifest that names each area's segments, and commits the run.
   Readers take the newest committed manifest, so a crash before the commit
   changes nothing for them.

A reader takes the rows of all segments as they are, but for keys that may be
contested: of those the newest row counts. These are told by a bitmap of key
hashes that is broadcast (2 bytes a contested key, about); rows it hits by
chance are compared too, so it decides nothing. Wide stored rows stay where
they are. Segments of an area are put together when they are many, or small.

What a run reads and writes grows with its batch, up to the keys of the areas
it touches. "Newest" is the total order of :func:`tessera.operators.dedup.keep_latest`,
a maximum: late, repeated and reordered batches give the same table as one build
over all of them. Rows are taken as equal if their keys and 64-bit digests are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.constants import CITY_KEYS
from tessera.contracts import EntityContract
from tessera.functions import rate
from tessera.operators.audit import RunClock, silver_audit
from tessera.operators.clean import fill_text, string_columns
from tessera.operators.dedup import drop_missing_keys, keep_latest
from tessera.operators.indicators import city_indicator, indicator_base
from tessera.plans.publish import commit_run, latest_commit, new_run_id, run_path
from tessera.plans.silver import clean
from tessera.session import written
from tessera.sources.parquet import partition_values, try_read_parquet
from tessera.sources.sinks import delete_folder, write_table

AREA = "_area"
#: Whether a row's key had a stored row when the row was written.
CONTESTED = "_contested"
#: Slots for the values of the ``within`` columns.
SLOTS = 64
#: Segments of an area at most, and if it has fewer rows than ``SMALL``.
MOST, MOST_SMALL, SMALL = 8, 2, 20_000
#: Bits of one bitmap of ``bitmap_construct_agg``; bits a key aimed at; bits of all bitmaps at most.
BITS, BITS_A_KEY, MOST_BITS = 1 << 15, 16, 1 << 31


@dataclass(frozen=True)
class Merged:
    run_id: str | None       # None: nothing changed, nothing was written
    rows_in: int = 0         # keys in the batch
    changed: int = 0
    areas_read: int = 0
    areas_written: int = 0


def area(keys: Sequence[str], within: Sequence[str], buckets: int) -> Column:
    """The area of a row; at most ``SLOTS * buckets`` areas. Aim at about 1 GB an area."""
    slot = F.pmod(F.xxhash64(*within), F.lit(SLOTS)) if within else F.lit(0)
    return (slot * F.lit(buckets) + F.pmod(F.xxhash64(*keys), F.lit(buckets))).cast("int")


def _paths(root: str) -> tuple[str, str, str]:
    root = root.rstrip("/")
    return f"{root}/rows", f"{root}/manifests", f"{root}/commits"


@dataclass(frozen=True)
class Manifest:
    segments: Mapping[int, Mapping[str, int]]   # area -> run that wrote a segment -> rows of it
    keys: Sequence[str] = ()
    order: Sequence[str] = ()


def manifest(spark: SparkSession, root: str, run: str | None = None) -> Manifest:
    """The segments as of the newest commit (or ``run``); at most ``MOST`` rows an area."""
    _, manifests, commits = _paths(root)
    run = run or latest_commit(spark, commits)
    if run is None:
        return Manifest({})
    rows = spark.read.parquet(run_path(manifests, run)).collect()
    segments: dict[int, dict[str, int]] = {}
    for r in rows:
        segments.setdefault(r["area"], {})[r["run"]] = r["rows"]
    return Manifest(segments, rows[0]["keys"], rows[0]["order_by"])


def _write_manifest(spark: SparkSession, root: str, run: str, m: Manifest) -> None:
    rows = [(a, r, n, list(m.keys), list(m.order)) for a, runs in sorted(m.segments.items())
            for r, n in sorted(runs.items())]
    write_table(spark.createDataFrame(rows, "area int, run string, rows long, keys array<string>, "
                                            "order_by array<string>").coalesce(1),
                run_path(_paths(root)[1], run))


def _segments(spark: SparkSession, root: str, wanted: Mapping[int, Sequence[str]]) -> DataFrame | None:
    """Rows of the named segments as stored, several a key if contested."""
    rows = _paths(root)[0]
    paths = [f"{run_path(rows, run)}/{AREA}={a}" for a, runs in sorted(wanted.items()) for run in sorted(runs)]
    return spark.read.parquet(*paths) if paths else None


def _hits(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], n_wanted: int) -> DataFrame:
    """``rows`` with ``_hit``: true for every row whose key is in ``wanted``, and for a few others."""
    bits = BITS
    while bits < min(BITS_A_KEY * n_wanted, MOST_BITS):
        bits *= 2
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    bit = (place % BITS).alias("bit")
    maps = (wanted.select(F.floor(place / BITS).alias("_block"), bit).groupBy("_block")
            .agg(F.bitmap_construct_agg("bit").alias("_bits")))
    byte = F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")
    rows = rows.withColumn("_block", F.floor(place / BITS)).withColumn("_bit", place % BITS)
    one = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))"))
    return (rows.join(F.broadcast(maps), "_block", "left")
            .withColumn("_hit", F.coalesce(one != 0, F.lit(False))).drop("_block", "_bit", "_bits"))


def _current(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key of stored segments."""
    wanted = rows.where(CONTESTED).select(*keys)
    n = wanted.count()
    cols = [c for c in rows.columns if c not in (AREA, CONTESTED)]
    rows = rows.select(*cols)
    if n == 0:
        return rows
    rows = _hits(rows, wanted, keys, n)
    return rows.where(~F.col("_hit")).select(*cols).union(
        keep_latest(rows.where("_hit").select(*cols), keys, order))


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    """The whole merged table as of its newest commit."""
    m = manifest(spark, root)
    df = _segments(spark, root, m.segments)
    if df is None:
        raise FileNotFoundError(f"nothing merged in {root}")
    return _current(df, m.keys, m.order)


def merge_batch(spark: SparkSession, root: str, rows: DataFrame, keys: Sequence[str],
                order_by: Sequence[str] = (), within: Sequence[str] = (), buckets: int = 64,
                on_changes: Callable[[DataFrame, str], None] | None = None) -> Merged:
    """Merge a batch of rows into the table at ``root``.

    ``on_changes`` gets the changed keys as (old struct or null, new struct) and
    the run's id before the run is committed. ``buckets``, ``keys`` and ``order_by``
    must not change over a table's life. One merge at a time a table. ``rows`` are
    computed twice: for the areas they fall in (a narrow pass), then as a whole.
    """
    at_rows, _, commits = _paths(root)
    order = [c for c in order_by if c in rows.columns]
    where = area(keys, within, buckets)
    rows = drop_missing_keys(rows, keys)
    areas = [r[0] for r in rows.select(where.alias(AREA)).distinct().collect()]
    stored = manifest(spark, root)
    touched = {a: stored.segments[a] for a in areas if a in stored.segments}
    old = _segments(spark, root, touched)
    cols = rows.columns
    if old is not None:
        _same_columns(cols, old.columns, root)
        cols = [c for c in old.columns if c not in (AREA, CONTESTED)]
    seen = Observation()
    batch = keep_latest(rows.select(*cols), keys, order).observe(seen, F.count(F.lit(1)).alias("rows"))
    if old is None:
        batch = batch.withColumn(CONTESTED, F.lit(False))
    else:
        # a key has one stored row, or a few: equal to the least or greatest digest is stored already
        digest = F.xxhash64(*cols)
        have = (old.select(*keys, digest.alias("_d")).repartition(*keys).groupBy(*keys)
                .agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi")))
        batch = (batch.join(have, list(keys), "left")
                 .where(F.col("_lo").isNull() | ((digest != F.col("_lo")) & (digest != F.col("_hi"))))
                 .withColumn(CONTESTED, F.col("_lo").isNotNull()))
    whole, run = sorted((new_run_id(), new_run_id()))
    path = run_path(at_rows, run)
    batch.select(*cols, CONTESTED, where.alias(AREA)).write.partitionBy(AREA).parquet(path)
    n_in = seen.get["rows"]
    wrote = [int(a) for a in partition_values(spark, path, AREA)]
    if not wrote:
        delete_folder(spark, path)
        return Merged(None, n_in, 0, len(touched))
    new = _segments(spark, root, {a: [run] for a in wrote}).withColumn(AREA, where)
    counts = new.groupBy(AREA).agg(F.count(F.lit(1)).alias("n"), F.count_if(CONTESTED).alias("met")).collect()
    n_rows = {r[AREA]: r["n"] for r in counts}
    changed = {r[AREA]: r["n"] - r["met"] for r in counts}
    n_met = sum(r["met"] for r in counts)
    as_new = (AREA, F.struct(*cols).alias("new"))
    changes = new.where(~F.col(CONTESTED)).select(*as_new)
    if n_met:
        met = new.where(CONTESTED).select(*keys, *as_new)
        opened = _hits(old.select(*cols), met, keys, n_met).where("_hit").select(*cols)
        now = keep_latest(opened, keys, order).select(*keys, F.struct(*cols).alias("old"))
        rest = [*order, *[c for c in cols if c not in order and c not in keys]]
        rank = lambda side: F.struct(*[f"{side}.{c}" for c in rest])
        newer = met.join(now, list(keys))
        newer = written((newer.where(rank("new") > rank("old")) if rest else newer.limit(0))
                        .select(AREA, "old", "new"), "newer")
        for r in newer.groupBy(AREA).agg(F.count(F.lit(1)).alias("n")).collect():
            changed[r[AREA]] += r["n"]
        changes = changes.withColumn("old", F.lit(None).cast(newer.schema["old"].dataType)) \
            .select(AREA, "old", "new").union(newer)
    else:
        changes = changes.withColumn("old", F.lit(None).cast(changes.schema["new"].dataType))
    changed = {a: n for a, n in changed.items() if n}
    if not changed:
        delete_folder(spark, path)
        return Merged(None, n_in, 0, len(touched))
    if on_changes is not None:
        on_changes(changes.select("old", "new"), run)
    after = {a: dict(s) for a, s in stored.segments.items()}
    for a in changed:
        after.setdefault(a, {})[run] = n_rows[a]
    many = {a: after[a] for a in changed if len(after[a]) > (
        MOST_SMALL if sum(after[a].values()) < SMALL else MOST)}
    if many:
        # one task an area, which has the size it was cut for: keys are spread by their hash
        (_current(_segments(spark, root, many), keys, order).select(*cols)
         .withColumn(CONTESTED, F.lit(False)).withColumn(AREA, where)
         .repartition(AREA).write.partitionBy(AREA).parquet(run_path(at_rows, whole)))
        sizes = _segments(spark, root, {a: [whole] for a in many}).groupBy(where.alias(AREA)).count()
        after |= {r[AREA]: {whole: r["count"]} for r in sizes.collect()}
    _write_manifest(spark, root, run, Manifest(after, keys, order))
    commit_run(spark, commits, run, ["rows"])
    return Merged(run, n_in, sum(changed.values()), len(touched), len(changed))


def _same_columns(new: Sequence[str], old: Sequence[str], root: str) -> None:
    old = [c for c in old if c not in (AREA, CONTESTED)]
    if sorted(new) != sorted(old):
        raise ValueError(f"the batch's columns {sorted(new)} are not those of {root}: {sorted(old)}")


def expire_merged(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete area folders that none of the newest ``keep`` manifests names; how many went.

    A reader that planned on one of those manifests keeps its files. Folders of a
    run later than the newest commit may belong to a merge under way and stay.
    """
    at_rows, manifests, commits = _paths(root)
    log = try_read_parquet(spark, commits)
    if log is None:
        return 0
    runs = [r["run_id"] for r in log.select("run_id").distinct().orderBy(F.desc("run_id")).limit(keep).collect()]
    named = {(a, run) for r in runs for a, s in manifest(spark, root, r).segments.items() for run in s}
    gone = 0
    for run in partition_values(spark, at_rows, "run_id"):
        if run > runs[0]:
            continue
        own = partition_values(spark, run_path(at_rows, run), AREA)
        left = [a for a in own if (int(a), run) in named]
        for a in own if left else []:
            if a not in left:
                delete_folder(spark, f"{run_path(at_rows, run)}/{AREA}={a}")
        if not left:
            delete_folder(spark, run_path(at_rows, run))
        gone += len(own) - len(left)
    for run in partition_values(spark, manifests, "run_id"):
        if run < runs[-1]:
            delete_folder(spark, run_path(manifests, run))
    return gone


# --- silver entities -------------------------------------------------------------------
def _filled(df: DataFrame) -> DataFrame:
    return fill_text(df, string_columns(df))


def merge_silver(spark: SparkSession, root: str, bronze: DataFrame, contract: EntityContract,
                 buckets: int = 64) -> Merged:
    """Merge one bronze batch of an entity, and for students their city counts.

    Rows are stored cleaned but unfilled, as the full build deduplicates them
    before it fills text; :func:`read_silver_merged` fills them.
    """
    rows = clean(bronze, contract)
    keys = [k for k in contract.keys or () if k in rows.columns]
    if not keys:
        raise ValueError(f"{contract.name} has no business key to merge by")
    counts = city_deltas(root) if {*CITY_KEYS, "id_aluno", "in_presenca_lp"} <= set(rows.columns) else None
    return merge_batch(spark, root, rows, keys, contract.order_by,
                       [k for k in keys if k == "ano"], buckets, counts)


def read_silver_merged(spark: SparkSession, root: str, clock: RunClock,
                       processed_at: bool = True) -> DataFrame:
    """The silver table as :func:`tessera.plans.silver.build_silver` gives it over all batches."""
    return silver_audit(_filled(read_merged(spark, root)), clock, processed_at=processed_at)


# --- indicators by deltas --------------------------------------------------------------
COUNTS = ("total_avaliados", "total_alfabetizados")


def _counted(rows: DataFrame, sign: int) -> DataFrame:
    cities = city_indicator(indicator_base(_filled(rows)))
    return cities.select(*CITY_KEYS, *[(F.col(c) * F.lit(sign)).alias(c) for c in COUNTS])


def _summed(counts: DataFrame) -> DataFrame:
    out = counts.groupBy(*CITY_KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return out.where(" OR ".join(f"{c} <> 0" for c in COUNTS))


def city_deltas(root: str) -> Callable[[DataFrame, str], None]:
    """AGG-1: what a run changes in the city counts: new rows count, the rows they replace count off.

    Written under the run's id before the run is committed, so deltas and rows
    become visible together.
    """
    def write(changes: DataFrame, run: str) -> None:
        added = _counted(changes.select("new.*"), 1)
        taken = _counted(changes.where("old is not null").select("old.*"), -1)
        write_table(_summed(added.union(taken)), run_path(f"{root.rstrip('/')}/cities", run))
    return write


def _city_counts(spark: SparkSession, root: str) -> tuple[DataFrame, str]:
    root = root.rstrip("/")
    newest = latest_commit(spark, f"{root}/commits")
    if newest is None:
        raise FileNotFoundError(f"nothing merged in {root}")
    folded = latest_commit(spark, f"{root}/cities_folded_commits")
    committed = spark.read.parquet(f"{root}/commits").select("run_id").distinct()
    counts = spark.read.parquet(f"{root}/cities").join(committed, "run_id")
    if folded is not None:
        counts = counts.where(F.col("run_id") > folded)
    counts = counts.select(*CITY_KEYS, *COUNTS)
    if folded is not None:
        counts = counts.union(spark.read.parquet(run_path(f"{root}/cities_folded", folded))
                              .select(*CITY_KEYS, *COUNTS))
    return counts, newest


def maintained_cities(spark: SparkSession, root: str) -> DataFrame:
    """AGG-1 / PRJ-20 from the deltas of all committed runs: no student row is read.

    The state view (AGG-2) follows by ``indicators.state_evolution_from_cities``.
    """
    counts, _ = _city_counts(spark, root)
    return _summed(counts).withColumn("taxa_alfabetizacao_real",
                                      rate("total_alfabetizados", "total_avaliados"))


def fold_cities(spark: SparkSession, root: str) -> str:
    """Sum the deltas so far into one table, so readers open one folder and the later runs'."""
    root = root.rstrip("/")
    counts, newest = _city_counts(spark, root)
    before = latest_commit(spark, f"{root}/cities_folded_commits")
    if before != newest:
        write_table(_summed(counts), run_path(f"{root}/cities_folded", newest))
        commit_run(spark, f"{root}/cities_folded_commits", newest, ["cities"])
        for run in partition_values(spark, f"{root}/cities", "run_id"):
            if before is not None and run <= before:   # folded one fold ago: no reader plans on it
                delete_folder(spark, run_path(f"{root}/cities", run))
    return newest
