"""Compaction of a running stream's output (K8): small files to few, without stopping the stream or its readers.

The stream's file sink commits each batch's files in its log. ``compact_stream`` takes the committed files that no
earlier run has taken, rewrites the partitions they touch (rows compacted before and new ones) into a folder of
its own, and then publishes a manifest: which folder holds each partition, and which runs' file lists are in it.
The manifest is written aside and renamed, so a reader sees the state before or after, never between.
``read_compacted`` reads the manifest's folders and every committed file that they do not hold yet: each row once,
before, during and after a run. A run that fails leaves a folder that no manifest names; the next run starts anew
from the last manifest. Of two runs at once the second fails to publish. Nothing is deleted: the stream's small
files stay its own, and older folders serve readers that began before.

The rename is atomic on file systems that have one (local, HDFS); the driver sees names of files and partitions only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return [str(f.getPath().getName()) for f in fs.listStatus(p)] if fs.exists(p) else []


def manifest(spark: SparkSession, compacted: str) -> dict:
    """The latest published state: its number, the folder of each partition, the runs that it is made of."""
    numbers = [int(n) for n in _names(spark, f"{compacted}/manifests") if n.isdigit()]
    if not numbers:
        return {"number": 0, "partitions": {}, "runs": []}
    text = spark.read.text(f"{compacted}/manifests/{max(numbers)}", wholetext=True).first()[0]
    return json.loads(text)


def _publish(spark: SparkSession, compacted: str, state: dict) -> None:
    target = f"{compacted}/manifests/{state['number']}"
    fs, aside = _fs(spark, f"{compacted}/manifests/.{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    place = _fs(spark, target)[1]
    if fs.exists(place) or not fs.rename(aside, place):
        raise RuntimeError(f"another compaction has published {target}")


def committed_files(spark: SparkSession, output: str) -> DataFrame:
    """(path): files of all committed batches, as Spark lists them by the sink's log."""
    names = spark.read.text(output).inputFiles() if _names(spark, f"{output}/_spark_metadata") else []
    return spark.createDataFrame([(n,) for n in names], "path string")


def _open_files(spark: SparkSession, output: str, compacted: str, state: dict) -> DataFrame:
    files = committed_files(spark, output)
    if state["runs"]:
        taken = spark.read.schema("path string").parquet(*[f"{compacted}/runs/{r}" for r in state["runs"]])
        files = files.join(taken, "path", "left_anti")
    return files


def _rows(spark: SparkSession, schema: StructType, fmt: str, base: str, paths: list[str]) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", base)
    return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(paths)


def _compacted_rows(spark, compacted, state, schema, fmt, partitions) -> DataFrame | None:
    """Rows of the named partitions in the manifest's folders."""
    folders: dict[str, list[str]] = {}
    for name in partitions:
        if name in state["partitions"]:
            folder = state["partitions"][name]
            folders.setdefault(folder, []).append(f"{compacted}/data/{folder}/{name}")
    out = None
    for folder, paths in folders.items():
        rows = _rows(spark, schema, fmt, f"{compacted}/data/{folder}", paths)
        out = rows if out is None else out.unionByName(rows)
    return out


def compact_stream(spark: SparkSession, output: str, compacted: str, schema: StructType, column: str = "date", fmt: str = "csv",
                   rows_per_file: int = 1_000_000) -> int:
    """Rewrite the partitions that got files since the last run; how many files were taken."""
    state, run = manifest(spark, compacted), uuid.uuid4().hex
    _open_files(spark, output, compacted, state).write.parquet(f"{compacted}/runs/{run}")
    paths = [r.path for r in spark.read.schema("path string").parquet(f"{compacted}/runs/{run}").collect()]  # names only
    if not paths:
        return 0
    changed = sorted({p.rsplit("/", 2)[1] for p in paths})
    rows = _rows(spark, schema, fmt, output, paths)
    before = _compacted_rows(spark, compacted, state, schema, fmt, changed)
    rows = rows if before is None else before.unionByName(rows)
    files = rows.groupBy(F.col(column).alias("_k")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.col("_files"))
    out = rows.join(files, rows[column].eqNullSafe(files["_k"])).drop("_k").withColumn("_salt", salt).repartition(column, "_salt").drop("_files", "_salt")
    w = out.write.partitionBy(column)
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(f"{compacted}/data/{run}")
    _publish(spark, compacted, {"number": state["number"] + 1, "partitions": state["partitions"] | dict.fromkeys(changed, run), "runs": [*state["runs"], run]})
    return len(paths)


def read_compacted(spark: SparkSession, output: str, compacted: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """All committed rows of the stream, each once: compacted partitions, and the files that came since."""
    state = manifest(spark, compacted)  # first: files committed later are still open in this state
    paths = [r.path for r in _open_files(spark, output, compacted, state).collect()]
    parts = [_compacted_rows(spark, compacted, state, schema, fmt, state["partitions"]), _rows(spark, schema, fmt, output, paths) if paths else None]
    out = None
    for rows in parts:
        if rows is not None:
            out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], schema) if out is None else out
