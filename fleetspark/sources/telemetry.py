"""Telemetry ping scan (declared types, rows known by their place in the files).

Required columns are added as typed NULL when a file lacks them; optional
sensor columns that no file has stay absent, so that operators can choose the
"column absent" branch at plan-build time.

Files of different device generations may lie in one folder.  Their footers
are read and merged by Spark in a distributed job; only where types conflict
are the files split into groups, each a scan of its own that is conformed to
the declared types before the groups are united by name.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import nan_to_null
from ..functions.ranking import global_row_number
from ..params import DEFAULT, DPR_COLS

REQUIRED = {
    "vehicle": "string",
    "ts": "timestamp",
    "longitude": "double",
    "latitude": "double",
    "altitude": "double",
    "speed": "double",
    "angle": "double",
    "satellites": "int",
    "gnss_hdop": "double",
    "gnss_pdop": "double",
    "ignition": "int",
    "mine_anon": "string",
    "shift_dpr": "string",
    "date_dpr": "date",
    "operator_id": "bigint",
}
OPTIONAL = {
    "gsm_operator": "string",
    "fuel_volume": "double",
    "disthav": "double",
    "cumdist": "double",
    "total_trip": "double",
    "analog_input_1": "double",
    "rain_loss": "double",
    "dense_fog": "double",
    "utm_x": "double",
    "utm_y": "double",
    **{c: "double" for c in DPR_COLS},
}

#: A ping id is the number of its file, then the number of its row in the file.
ROW_BITS = 40


def conform(raw: DataFrame, ping_id: Column | None = None) -> DataFrame:
    """Cast to declared types, NaN -> NULL, add ``ts_us`` and the tie-break
    ``ping_id``: the one given, else the column of that name, else (frames that
    come from no file) a hash of the row."""
    cols = []
    present = set(raw.columns)
    ntz = "ts" in present and dict(raw.dtypes).get("ts") == "timestamp_ntz"
    for name, typ in {**REQUIRED, **OPTIONAL}.items():
        if name not in present:
            if name in REQUIRED:
                cols.append(F.lit(None).cast(typ).alias(name))
            continue
        c = F.col(name)
        if name == "ts":
            # naive timestamps are UTC wall-clock: convert without the session zone
            c = (F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"))
                 if ntz else c.cast("timestamp"))
        elif name == "date_dpr":
            c = F.to_date(F.trim(c.cast("string")))
        elif typ == "string":
            c = F.trim(c.cast("string"))
        elif typ == "double":
            c = nan_to_null(c.cast("double"))
        else:
            c = c.cast(typ)
        cols.append(c.alias(name))
    if ping_id is None and "ping_id" in present:
        ping_id = F.col("ping_id").cast("bigint")
    df = raw.select(*cols, *([ping_id.alias("ping_id")] if ping_id is not None else []))
    df = df.withColumn("ts_us", F.unix_micros("ts"))
    if ping_id is None:
        keyed = [F.col(c) for c in sorted(df.columns) if c != "ts"]
        df = df.withColumn("ping_id", F.xxhash64(*keyed))
    return df


def file_numbers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file, file_no)`` of every file under ``paths`` (files, folders,
    globs): in the order of the paths, inside one by name.  Spark lists the
    files; their content is not read."""
    parts = [spark.read.format("binaryFile").load(p).select(F.lit(i).alias("_p"), F.col("path").alias("file")) for i, p in enumerate(paths)]
    listed = reduce(lambda a, b: a.unionByName(b), parts).groupBy("file").agg(F.min("_p").alias("_p"))
    return global_row_number(listed, ["_p", "file"], "file_no").select("file", (F.col("file_no") - 1).alias("file_no"))


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes of the files under ``paths``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return sum(spark.read.format("binaryFile").load(p).agg(F.sum("length")).first()[0] or 0 for p in paths)


def in_file_order(raw: DataFrame, files: DataFrame, max_broadcast_bytes: int = DEFAULT.max_broadcast_bytes) -> DataFrame:
    """``conform`` with ``ping_id`` from the place of a row: ties in time keep
    the order of the files and of their rows, and equal pings differ.  Only
    hidden file columns are read for it.  The file list is broadcast while its
    paths stay under the byte bound."""
    size = files.agg(F.sum(F.length("file") + 40)).first()[0] or 0
    files = files.select(F.col("file").alias("_file"), "file_no")
    located = raw.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    joined = located.join(F.broadcast(files) if size <= max_broadcast_bytes else files, F.col("_path") == F.col("_file"), "left")
    place = F.when(F.col("file_no").isNull(), F.raise_error(F.concat(F.lit("file not listed: "), "_path")).cast("bigint")).otherwise(
        F.shiftleft(F.col("file_no"), ROW_BITS) + F.col("_row"))
    return conform(joined, place)


def merged_schema(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The united schema of ``files``, read from all footers by Spark tasks;
    None where a column has types that cannot be merged."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*files).schema
    except (Py4JJavaError, PySparkException) as e:
        if "CANNOT_MERGE" in str(e):
            return None
        raise


def _united(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Columns of both, if those they share have one type."""
    types = {f.name: f.dataType for f in a}
    if any(types.get(f.name, f.dataType) != f.dataType for f in b):
        return None
    return T.StructType([*a, *[f for f in b if f.name not in types]])


def schema_groups(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The files of ``path`` as few groups with one schema each.  If all footers
    merge, the path is a group as it stands.  Else its files are halved until
    the halves merge, and groups that agree are put together again: the number
    of merges follows the changes of generation along the file names."""
    whole = merged_schema(spark, [path])
    if whole is not None:
        return [(whole, [path])]
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").orderBy("path").collect()]

    def halves(part: list[str]) -> list[tuple[T.StructType, list[str]]]:
        schema = merged_schema(spark, part)
        if schema is not None:
            return [(schema, part)]
        if len(part) == 1:
            raise ValueError(f"{part[0]}: no readable schema")
        out = halves(part[:len(part) // 2])
        for schema, more in halves(part[len(part) // 2:]):
            for i, (known, have) in enumerate(out):
                both = _united(known, schema)
                if both is not None:
                    out[i] = (both, have + more)
                    break
            else:
                out.append((schema, more))
        return out

    return halves(files)


def read_telemetry(spark: SparkSession, paths) -> DataFrame:
    """A1: telemetry files as one table.  Files whose schemas agree are one
    scan, whichever paths they come from; the others are conformed to the
    declared types and united by name.  Pings of files that lack a column that
    others have get NULL there.  Files that all bring a ``ping_id`` keep it;
    otherwise it is the place of the row."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups: list[tuple[T.StructType, list[str]]] = []
    for p in paths:
        for schema, files in schema_groups(spark, p):
            for i, (known, have) in enumerate(groups):
                both = _united(known, schema)
                if both is not None:
                    groups[i] = (both, have + files)
                    break
            else:
                groups.append((schema, files))
    scans = [spark.read.schema(schema).parquet(*have) for schema, have in groups]
    if all("ping_id" in s.columns for s in scans):
        parts = [conform(s) for s in scans]
    else:
        files = file_numbers(spark, paths)
        parts = [in_file_order(s, files) for s in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
