"""Measure hot-key handling: one key holding a third of all rows.

Builds the student rows of ``sf_dir`` with every third row moved onto ONE key
(same year, student, city), then runs the dedup, the city aggregate and the
uniqueness check. From Spark's event log (scratch folder) it reports, per
operator, the shuffle records read by the busiest reduce task against all
records shuffled: if the hot key were shuffled whole, the busiest task would
read at least a third of the input rows.

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.contracts import Check  # noqa: E402
from tessera.operators import indicators as ind  # noqa: E402
from tessera.operators import quality as dq  # noqa: E402
from tessera.operators.dedup import keep_latest  # noqa: E402
from tessera.plans import adapters  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tessera-skew-events-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    s = adapters.students(spark, sf_dir)
    hot = (F.col("id_aluno") % 3 == 0)
    skewed = s.select(
        F.when(hot, F.lit(1999)).otherwise(F.col("ano")).alias("ano"),
        F.when(hot, F.lit(0)).otherwise(F.col("id_aluno")).alias("id_aluno"),
        F.when(hot, F.lit("ZZ")).otherwise(F.col("sigla_uf")).alias("sigla_uf"),
        F.when(hot, F.lit(0)).otherwise(F.col("id_municipio")).alias("id_municipio"),
        F.when(hot, F.lit("hot city")).otherwise(F.col("nome_municipio")).alias("nome_municipio"),
        "in_presenca_lp", "in_alfabetizado", "vl_proficiencia_lp", "_ingestion_timestamp")
    path = os.path.join(log_dir, "skewed")
    skewed.write.parquet(path)
    data = spark.read.parquet(path)
    total = data.count()
    hot_rows = data.where("id_aluno = 0").count()
    runs = {
        "dedup keep_latest": keep_latest(data, ("ano", "id_aluno"), ("_ingestion_timestamp",)),
        "city indicator": ind.city_indicator(ind.indicator_base(data)),
        "unique check": dq.check_report(data, [Check("unique", "id_aluno")]),
    }
    for name, df in runs.items():
        sc.setJobGroup(f"skew:{name}", name)
        df.write.format("noop").mode("overwrite").save()

    # shuffle join with a hot key: a third of lineitem rows on supplier 1, no
    # broadcast; AQE's skew thresholds are scaled down to this data size (at
    # scale the defaults apply) so the hot partition is split across tasks.
    # AQE splits a skewed partition along map-task boundaries; sf0.1 lineitem
    # is 3 row groups (3 map tasks), while 100 TB arrives as thousands of
    # splits, so the input is spread over 24 map tasks first to stand for that.
    li = adapters.table(spark, sf_dir, "lineitem").repartition(24).select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_suppkey"))
         .alias("l_suppkey"), "l_orderkey", "l_extendedprice", "l_shipdate")
    sup = adapters.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    for k, v in {"spark.sql.shuffle.partitions": "32",
                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}.items():
        spark.conf.set(k, v)
    name = "shuffle join"
    runs[name] = None
    sc.setJobGroup(f"skew:{name}", name)
    li.join(sup, li.l_suppkey == sup.s_suppkey).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group, reads = {}, defaultdict(list)
    files = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and "events_" in os.path.basename(p)]
    for p in files:
        with open(p) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    if g.startswith("skew:"):
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = g[5:]
                elif ev.get("Event") == "SparkListenerTaskEnd" and ev.get("Stage ID") in stage_group:
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if n:
                        reads[stage_group[ev["Stage ID"]]].append(n)
    print(f"rows={total} hot-key rows={hot_rows} ({hot_rows / total:.0%})")
    for name in runs:
        r = reads.get(name, [])
        print(f"{name:18s} shuffled records={sum(r)} busiest reduce task={max(r) if r else 0} "
              f"tasks={len(r)}")


if __name__ == "__main__":
    main()
