"""Session helpers: partition sizing and the shared checkpoint folder."""

from tessera.session import checkpoint_dir, partition_settings, scratch_path


def test_partition_settings_scale_with_input():
    small = partition_settings(10 * 2**20)
    big = partition_settings(100 * 2**40)                 # 100 TiB
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert big["spark.sql.shuffle.partitions"] == "65536"  # capped
    mid = partition_settings(1 * 2**40)                    # 1 TiB -> 2048 x 512 MiB
    assert mid["spark.sql.shuffle.partitions"] == "2048"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)


def test_checkpoint_folder_is_kept_and_scratch_under_it(spark):
    first = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == first
    p = scratch_path(spark, "x")
    assert p.startswith(first.rstrip("/") + "/tables/x-")
    assert scratch_path(spark, "x") != p


def test_queries_do_not_depend_on_caller_time_zone(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    q = entry.queries()
    utc = sorted(map(tuple, q["stream_daily_indicator"](spark, sf).collect()))
    audit_utc = q["bronze_audit"](spark, sf).select("_ingestion_timestamp").first()[0]
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        other = sorted(map(tuple, q["stream_daily_indicator"](spark, sf).collect()))
        audit_other = q["bronze_audit"](spark, sf).select("_ingestion_timestamp").first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc and audit_other == audit_utc
