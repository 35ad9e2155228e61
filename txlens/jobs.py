"""Batch jobs: the ETL (audit -> read raw CSV -> clean -> write once -> register)
and the ML job (load -> class balance -> train -> evaluate).

    python -m txlens.jobs etl <csv_dir> <parquet_dir> [db.table]
    python -m txlens.jobs ml  <db.table | parquet_dir> [csv_dir ...]

(on a cluster: ship the package with ``spark-submit --py-files txlens.zip``
and call ``txlens.jobs.main([...])`` from the submitted script)

Unlike a clean-then-write-twice flow, the cleaned plan runs exactly once:
it is written as month-partitioned Parquet and the catalog table is then
declared over that directory (no recomputation from CSV).
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators.clean import clean_transactions
from txlens.operators.ml import prep, train
from txlens.session import ensure_checkpoint_dir
from txlens.sources import readers, sinks


def run_etl(spark: SparkSession, csv_dir: str, out_path: str, table: str | None = None) -> DataFrame:
    audit = readers.audit_files(spark, csv_dir)
    summary = readers.files_ok(audit).first()
    if not summary["integrity_ok"]:
        raise ValueError(f"input check failed for {csv_dir}: {summary.asDict()}")
    cleaned = clean_transactions(readers.read_raw_csv(spark, f"{csv_dir.rstrip('/')}/*.csv"))
    sinks.write_parquet(cleaned, out_path)
    if table:
        db = table.split(".")[0] if "." in table else None
        if db:
            sinks.create_database(spark, db)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        sinks.register_external_table(spark, table, out_path)
        return spark.table(table)
    return readers.read_cleaned_parquet(spark, out_path)


def run_ml(spark: SparkSession, source: str, csv_dirs: list[str] | None = None, model: str = "logistic") -> dict:
    if "/" in source:
        df, label = readers.read_cleaned_parquet(spark, source), f"parquet:{source}"
    else:
        df, label = readers.load_transactions(spark, source, csv_dirs or [])
    balance = {str(r[0]): (r["count"], r["ratio"]) for r in prep.class_balance(df).collect()}
    res = train.train_and_evaluate(df, model=model)
    return {"source": label, "class_balance": balance, "metrics": res.metrics}


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in ("etl", "ml"):
        raise SystemExit(__doc__)
    # the cluster (spark-submit) provides master and configuration
    spark = SparkSession.builder.appName(f"txlens-{argv[0]}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if argv[0] == "etl":
        out = run_etl(spark, argv[1], argv[2], argv[3] if len(argv) > 3 else None)
        print(json.dumps({"rows": out.count(), "months": out.select(F.countDistinct("tx_year_month")).first()[0]}))
    elif argv[0] == "ml":
        print(json.dumps(run_ml(spark, argv[1], argv[2:]), default=str))
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
