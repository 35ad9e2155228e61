"""Sources, sinks, streaming and the driver contract."""

import os

from pyspark.sql import functions as F

from support import SF001
from txlens.operators.clean import clean_transactions
from txlens.schema import CLEANED_COLUMNS, RAW_COLUMNS
from txlens.session import scratch_path
from txlens.sources import adapters as ad
from txlens.sources import readers, sinks

BAD_ROWS = [
    "TRANSACTION_ID,TX_DATETIME,CUSTOMER_ID,TERMINAL_ID,TX_AMOUNT,TX_TIME_SECONDS,TX_TIME_DAYS,TX_FRAUD,TX_FRAUD_SCENARIO",
    '1,2018-04-01 10:00:00,5,7,12.5,36000,0,0,0',
    '#VALUE!,2018-04-01 10:00:00,5,7,12.5,36000,0,0,0',
    ',2018-04-01 10:00:00,5,7,12.5,36000,0,0,0',
    '2,bad date,5,7,,36000,0,0,0',
    '3,"2018-04-02 11:00:00",6,7,"1,5",40000,1,1,1',
]


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_csv_reader_and_cleaning_of_bad_rows(spark):
    d = scratch_path(spark, "t-csv")
    os.makedirs(_local(d), exist_ok=True)
    with open(os.path.join(_local(d), "transactions_month_2018-04.csv"), "w") as f:
        f.write("\n".join(BAD_ROWS) + "\n")
    raw = readers.read_raw_csv(spark, f"{d}/*.csv")
    assert raw.columns == RAW_COLUMNS and raw.count() == 5
    out = {r["TRANSACTION_ID"]: r for r in clean_transactions(raw).collect()}
    assert sorted(out) == [1, 2, 3]
    assert out[2]["TX_DATETIME"] is None and out[2]["TX_AMOUNT"] == 0.0
    assert out[3]["TX_AMOUNT"] == 0.0  # "1,5" is not a number -> NULL -> 0.0


def test_file_audit_missing_empty_and_ok(spark):
    assert readers.audit_files(spark, scratch_path(spark, "nothing-here")).count() == 0
    d = scratch_path(spark, "t-audit")
    os.makedirs(_local(d), exist_ok=True)
    open(os.path.join(_local(d), "a.csv"), "w").write("x\n1\n")
    open(os.path.join(_local(d), "b.csv"), "w").close()
    audit = readers.audit_files(spark, d)
    got = {os.path.basename(r["path"]): r["ok"] for r in audit.collect()}
    assert got == {"a.csv": True, "b.csv": False}
    assert readers.files_ok(audit).first()["integrity_ok"] is False


def test_file_audit_walks_folders(spark):
    d = scratch_path(spark, "t-audit-tree")
    want = {}
    for folder, files in (("", {"a.csv": 3, "b.txt": 2}), ("x y/deep", {"c.csv": 0, "a[1].csv": 5}), ("é", {"d.csv": 1}), ("none", {})):
        os.makedirs(os.path.join(_local(d), folder), exist_ok=True)
        for name, size in files.items():
            with open(os.path.join(_local(d), folder, name), "w") as f:
                f.write("1" * size)
            want[f"{folder}/{name}".lstrip("/")] = size
    audit = readers.audit_files(spark, d, recursive=True)
    rows = audit.collect()
    root = _local(d).rstrip("/") + "/"
    assert {r["path"].removeprefix("file:").removeprefix(root): r["bytes"] for r in rows} == {
        k: v for k, v in want.items() if k.endswith(".csv")}
    assert all(r["ok"] == (r["bytes"] > 0) and r["modified"] is not None for r in rows)
    assert {r["path"].rsplit("/", 1)[1] for r in readers.audit_files(spark, [d, d + "/missing"], "?.*").collect()} == {"a.csv", "b.txt"}


def test_dynamic_overwrite_replaces_only_present_months(spark):
    path = scratch_path(spark, "t-parquet")
    tx = ad.lineitem_tx(spark, SF001, True)
    sinks.write_parquet(tx, path)
    b = {r["tx_year_month"]: r["count"] for r in
         readers.read_cleaned_parquet(spark, path).groupBy("tx_year_month").count().collect()}
    month = min(b)
    staged = scratch_path(spark, "t-stage")
    sinks.write_parquet(readers.read_cleaned_parquet(spark, path, [month]).limit(1).select(*CLEANED_COLUMNS), staged)
    sinks.write_parquet(readers.read_cleaned_parquet(spark, staged).select(*CLEANED_COLUMNS), path)
    after = {r["tx_year_month"]: r["count"] for r in readers.read_cleaned_parquet(spark, path).groupBy("tx_year_month").count().collect()}
    assert after[month] == 1
    assert all(after[m] == b[m] for m in b if m != month)


def test_month_filter_prunes_partitions(spark):
    path = scratch_path(spark, "t-prune")
    sinks.write_parquet(ad.lineitem_tx(spark, SF001, True), path)
    df = readers.read_cleaned_parquet(spark, path, ["1998-04"]).select("TRANSACTION_ID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tx_year_month" in plan and "1998-04" in plan


def test_streaming_ingest_equals_batch(spark):
    from txlens.streaming.ingest import ingest_available
    src = scratch_path(spark, "t-stream")
    raw = ad.raw_from_events(ad.read_table(spark, SF001, "events"))
    raw.repartitionByRange(3, "TX_DATETIME").write.option("header", "true").csv(src)
    got = ingest_available(spark, src, max_files_per_trigger=1)
    exp = clean_transactions(raw)
    r = lambda df: df.select(*CLEANED_COLUMNS).withColumn("customer_avg_amount", F.round("customer_avg_amount", 6))
    assert got.count() == exp.count() == 1000
    assert r(got).exceptAll(r(exp)).count() == 0


def test_driver_contract(spark):
    import __spark_entry__ as entry
    from txlens.plans import queries as own
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs) and set(own()) <= set(qs) and len(own()) >= 90
    assert all(fn.__doc__ for fn in qs.values())
    assert not any(k.startswith("op") or "pipeline" in k for k in own())
    df = entry.entry(spark)
    assert df.count() == 100 and df.columns[0] == "dst"


def test_etl_and_ml_jobs(spark):
    from txlens.jobs import run_etl, run_ml
    src = scratch_path(spark, "t-etl-src")
    raw = ad.raw_from_events(ad.read_table(spark, SF001, "events"))
    raw.repartition(3).write.option("header", "true").csv(src)
    out = run_etl(spark, src, scratch_path(spark, "t-etl-out"), "txlens_test_db.cleaned_transactions")
    assert out.count() == 1000 and set(CLEANED_COLUMNS) == set(out.columns)
    rep = run_ml(spark, "txlens_test_db.cleaned_transactions")
    assert rep["source"].startswith("table:") and 0.0 <= rep["metrics"]["areaUnderROC"] <= 1.0


def test_streaming_late_file_recomputes_its_month(spark):
    """A later drop for a month already ingested: that month's features are recomputed."""
    from txlens.streaming.ingest import start_ingest
    root = scratch_path(spark, "t-stream2")
    src, bronze, silver, ckpt = f"{root}/src", f"{root}/bronze", f"{root}/silver", f"{root}/_ckpt"
    raw = ad.raw_from_events(ad.read_table(spark, SF001, "events"))
    first = raw.filter(F.col("TX_DATETIME") < F.lit("2024-01-15"))
    later = raw.filter(F.col("TX_DATETIME") >= F.lit("2024-01-15"))
    first.coalesce(1).write.option("header", "true").csv(f"{src}/part1")
    q = start_ingest(spark, f"{src}/*", bronze, silver, ckpt)
    q.awaitTermination()
    mid = readers.read_cleaned_parquet(spark, silver)
    assert mid.count() == first.count()
    later.coalesce(1).write.option("header", "true").csv(f"{src}/part2")
    q = start_ingest(spark, f"{src}/*", bronze, silver, ckpt)      # same checkpoint: only the new file
    q.awaitTermination()
    got = readers.read_cleaned_parquet(spark, silver).select(*CLEANED_COLUMNS)
    exp = clean_transactions(raw)
    r = lambda df: df.select(*CLEANED_COLUMNS).withColumn("customer_avg_amount", F.round("customer_avg_amount", 6))
    assert got.count() == 1000
    assert r(got).exceptAll(r(exp)).count() == 0
