"""Sinks (A7–A9): Parquet stage tables, tables laid out for later passes,
versioned tables, and CSV reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    jp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jp, jp.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    jp, fs = _path(spark, path)
    fs.delete(jp, True)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether some file or folder has a name like ``pattern``."""
    jp, fs = _path(spark, pattern)
    return bool(fs.globStatus(jp))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """One stage table per call, overwritten as a whole (a table that is
    also read is a versioned one)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# --- versioned tables (A9) ----------------------------------------------------

#: Names the folder of the current version; replaced as a whole.
POINTER = "_CURRENT"


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as a new version below ``root``; readers still get the old one."""
    version = f"{root.rstrip('/')}/_version-{uuid.uuid4().hex}"
    df.write.parquet(version)
    return version


def switch_version(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the current one by one atomic rename, then delete the
    versions that are neither current nor newer."""
    old = current_version(spark, root)
    jvm = spark.sparkContext._jvm
    root_path, fs = _path(spark, root)
    fresh, pointer = (jvm.org.apache.hadoop.fs.Path(root_path, n) for n in (f"{POINTER}-{uuid.uuid4().hex}", POINTER))
    out = fs.create(fresh, True)
    out.write(bytearray(version.rsplit("/", 1)[-1].encode()))
    out.close()
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root_path.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fc.rename(fresh, pointer, overwrite)
    if old and old != version:
        remove(spark, old)


def current_version(spark: SparkSession, root: str) -> str | None:
    root_path, fs = _path(spark, root)
    pointer = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root_path, POINTER)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return f"{root.rstrip('/')}/{name}"


def write_table(df: DataFrame, root: str) -> None:
    """A versioned table: a crash leaves the old version or the new one."""
    switch_version(df.sparkSession, root, write_version(df, root))


def read_table(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version of {root} was finished")
    return spark.read.parquet(version)


# --- tables laid out for later passes (A7) ------------------------------------


def write_bucketed(df: DataFrame, path: str, name: str, keys: list[str], sort: list[str], buckets: int) -> None:
    """A table whose files hold one hash bucket of ``keys`` each, sorted: passes
    over ``keys`` read it without an exchange.  ``name`` is its name in the
    session's catalog; the files lie under ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *sort)
     .option("path", path).saveAsTable(name))


def read_bucketed(spark: SparkSession, path: str, name: str, keys: list[str], sort: list[str], buckets: int) -> DataFrame:
    """The table with its layout; a session that did not write it enters the
    files into its own catalog first."""
    if not spark.catalog.tableExists(name):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        cols, order = ", ".join(keys), ", ".join([*keys, *sort])
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({cols}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


# --- reports (A8, J9) ----------------------------------------------------------


#: A file of fewer rows than this is small beside a partition, so such files are many.
SMALL_FILE_ROWS = 10_000


def write_csv(df: DataFrame, path: str, order_by: list | None = None, rows_per_file: int = 1_000_000) -> None:
    """CSV with header.  With ``order_by`` the rows are sorted over range
    partitions; files follow each other by name in that order, each with at most
    ``rows_per_file`` rows.  No task gets the whole report; of many small files
    every partition of the session's shuffles writes its share."""
    if order_by and rows_per_file < SMALL_FILE_ROWS:
        # a sort's own partitions would be put together by their bytes, to a few tasks that write file after file
        df = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order_by).sortWithinPartitions(*order_by)
    elif order_by:
        df = df.orderBy(*order_by)
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)
