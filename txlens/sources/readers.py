"""Readers (S1-S6): raw CSV, Parquet directory, catalog table, fallback chain, file audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.operators.clean import clean_transactions
from txlens.schema import RAW_SCHEMA
from txlens.session import written
from txlens.sources.sinks import CSV_OPTIONS


def read_raw_csv(spark: SparkSession, paths, multiline: bool = False) -> DataFrame:
    """Headered CSV, every column a string (explicit schema, no inference).

    ``paths`` may be one path, a glob, or a list; Spark expands globs itself.
    ``multiline`` keeps quoted newlines inside a field, but makes each file one
    task, so it must be asked for.
    """
    if isinstance(paths, str):
        paths = [paths]
    return (spark.read.schema(RAW_SCHEMA)
                 .option("header", "true")
                 .option("multiLine", "true" if multiline else "false")
                 .option("escape", '"')
                 .option("mode", "PERMISSIVE")
                 .csv(list(paths)))


def read_monthly_csv(spark: SparkSession, path: str, month_col: str = "TX_MONTH", schema: T.StructType = RAW_SCHEMA,
                     multiline: bool = False) -> DataFrame:
    """K5 read back: the folder of ``sinks.write_monthly_csv`` with its month column, every text as it was written."""
    full = T.StructType([*schema.fields, T.StructField(month_col, T.StringType())])
    options = CSV_OPTIONS | {"multiLine": "true" if multiline else "false"}
    return spark.read.schema(full).options(**options).csv(path)


def read_cleaned_parquet(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """S3: the month-partitioned Parquet directory; month filter = partition pruning."""
    df = spark.read.parquet(path)
    if months:
        df = df.filter(F.col("tx_year_month").isin(*months))
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by (qualified) name."""
    return spark.table(name)


def load_transactions(spark: SparkSession, table: str | None, csv_dirs: list[str]) -> tuple[DataFrame, str]:
    """The catalog table if it exists and has a row, else the first CSV
    directory holding CSV files (cleaned on the fly), else an error.
    Returns (frame, source label)."""
    if table and spark.catalog.tableExists(table):
        df = spark.table(table)
        if not df.isEmpty():
            return df, f"table:{table}"
    for d in csv_dirs:
        files = audit_files(spark, d)
        if files.filter(F.col("ok")).limit(1).count() > 0:
            return clean_transactions(read_raw_csv(spark, f"{d.rstrip('/')}/*.csv")), f"csv:{d}"
    raise FileNotFoundError(f"no transactions in table {table!r} nor CSV under {csv_dirs}")


_LISTING = "path string, is_folder boolean, bytes long, modified timestamp"


def _lister():
    """(open, list): both travel to the workers by value, so these need no copy of this package."""

    def open_uri(uri: str):
        """(file system, path there, what stands before that path in ``uri``)."""
        import re
        from urllib.parse import quote

        from pyarrow import fs

        local = re.match(r"file:(//)?(?=/)", uri)
        if local:
            return fs.LocalFileSystem(), uri[local.end():], "file:"
        system, path = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
        return system, path, uri[:len(uri) - len(path)]

    def list_folders(batches):
        """What lies in each folder of a batch; a folder that is missing holds nothing."""
        import pyarrow as pa
        from pyarrow import fs

        types = {"path": pa.string(), "is_folder": pa.bool_(), "bytes": pa.int64(), "modified": pa.timestamp("us", tz="UTC")}
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path, before = open_uri(uri)
                infos = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
                infos = [x for x in infos if not (x.base_name.startswith(".") and x.extension == "crc")]
                for at in range(0, len(infos), 10_000):
                    part = infos[at:at + 10_000]
                    columns = ([before + x.path for x in part], [x.type == fs.FileType.Directory for x in part],
                               [x.size or 0 for x in part], [x.mtime_ns and x.mtime_ns // 1000 for x in part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))

    return open_uri, list_folders


def _list_on_driver(spark: SparkSession, uris: list[str]) -> DataFrame:
    """The same through Hadoop, for file systems that the workers' own client does not know."""
    import datetime as dt

    jvm, rows = spark.sparkContext._jvm, []
    for uri in uris:
        path = jvm.org.apache.hadoop.fs.Path(uri)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for st in system.listStatus(path) if system.exists(path) else []:
            rows.append((st.getPath().toString(), st.isDirectory(), int(st.getLen()),
                         dt.datetime.fromtimestamp(st.getModificationTime() / 1000.0, dt.timezone.utc)))
    return spark.createDataFrame(rows, _LISTING)


def audit_files(spark: SparkSession, directory: str | list[str], pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(path, bytes, modified, ok) for each matching file; ok = non-empty.

    Folders are rows and each is listed inside a task, so no file passes the driver; ``recursive``
    takes one pass per level, whose folders are the next pass's rows.  A metadata listing: no file
    is read.  (A ``binaryFile`` scan would skip zero-byte files, which are exactly what this audit has
    to report.)  A missing folder gives no rows.  Only a file system that the workers'
    client (pyarrow) cannot open is listed on the driver, through Hadoop.
    """
    import fnmatch

    import pyarrow as pa

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    roots = []
    for d in [directory] if isinstance(directory, str) else directory:       # those that the caller names
        path = jvm.org.apache.hadoop.fs.Path(d)
        roots.append(path.getFileSystem(conf).makeQualified(path).toString())
    open_uri, list_folders = _lister()
    try:
        for r in roots:
            open_uri(r)
        known = True
    except (pa.ArrowException, OSError, ValueError):
        known = False

    def level(folders: DataFrame) -> DataFrame:
        if known:
            return folders.mapInArrow(list_folders, _LISTING)
        return _list_on_driver(spark, [r["path"] for r in folders.collect()])

    listed = level(spark.createDataFrame([(r,) for r in roots], "path string"))
    if recursive:
        width = spark.sparkContext.defaultParallelism
        below, listed = written(listed, "listing"), None
        while True:
            listed = below if listed is None else listed.unionByName(below)
            folders = below.filter("is_folder").select("path")
            if folders.isEmpty():
                break
            below = written(level(folders.repartition(width, "path")), "listing")
    matching = ~F.col("is_folder") & F.regexp_extract("path", "[^/]*$", 0).rlike("^" + fnmatch.translate(pattern))
    return listed.filter(matching).select("path", "bytes", "modified", (F.col("bytes") > 0).alias("ok"))


def files_ok(audit: DataFrame) -> DataFrame:
    """S6 summary: one row — files found, empty files, and whether the input is usable."""
    return audit.agg(F.count(F.lit(1)).alias("n_files"),
                     F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("n_empty"),
                     ((F.count(F.lit(1)) > 0) & (F.coalesce(F.sum(F.when(F.col("ok"), 0).otherwise(1)), F.lit(0)) == 0))
                     .alias("integrity_ok"))
