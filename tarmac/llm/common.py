"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def files(folder: str):
    """(file system, path in it) of a folder URI, for readers and writers inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def shipped(spark: SparkSession) -> None:
    """Give executors this package, as ``--py-files`` does, once a context: tasks import it by name. The archive
    lies in the shared folder."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_package_shipped", None) != package:
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.writestr(str(f.relative_to(package.parent)), f.read_bytes())
        folder = f"{checkpoint_dir(spark).rstrip('/')}/package-{uuid.uuid4().hex}"
        system, path = files(folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{package.name}.zip") as out:
            out.write(archive.getvalue())
        sc.addPyFile(f"{folder}/{package.name}.zip")
        sc._package_shipped = package


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Only A-Z change, whatever the locale or the script."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    shipped(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors and fixes
    whatever an expression that depends on partitioning has returned."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *wanted: str) -> list[str]:
    """Names that do not clash, whatever case, with ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for w in wanted:
        while w.lower() in taken:
            w = f"_{w}"
        taken.add(w.lower())
        out.append(w)
    return out


def keep_columns(df: DataFrame, new: list[str]) -> list[str]:
    """Columns of ``df`` that an operator passes on: all but those its own results replace."""
    return [c for c in df.columns if c.lower() not in {n.lower() for n in new}]


def highest(df: DataFrame, value: Column, most: int) -> DataFrame:
    """Rows of the highest positive ``value``, at most ``most``: whole classes of values that agree to about one
    percent, from the top. Only a count for each class reaches the driver."""
    step = F.floor(F.log2(value) * 64)
    steps = {r.s: r["count"] for r in df.where(value > 0).groupBy(step.alias("s")).count().collect()}
    least, n = None, 0
    for s in sorted(steps, reverse=True):
        n += steps[s]
        if n > most:
            break
        least = s
    return df.limit(0) if least is None else df.where((value > 0) & (step >= int(least)))


_worker_cache: dict = {}


def worker_cache(name, make):
    """What a Python worker keeps between its tasks. Only the last one asked for is kept, so that the caches of
    operators that run one after another do not add up."""
    if name not in _worker_cache:
        _worker_cache.clear()
        _worker_cache[name] = make()
    return _worker_cache[name]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected ``edges`` (src, dst): the smallest node reachable.

    Every node points to its smallest neighbour, pointers are followed to their roots, and the edges
    are contracted to roots, until none is left. Both steps are grouped minima and joins on node ids;
    a node with very many neighbours is reduced map-side. Rounds grow with the logarithm of the
    longest chain. Nodes without an edge do not appear.
    """
    e = written(edges.select(F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b"))
                     .where("a is not null and b is not null and a <> b").distinct(), "edges")
    labels = None
    while not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        p = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("p"))
        p = written(p, "parents")
        while True:  # pointers only fall, so their chains have no cycle; each jump halves them
            up = p.select(F.col("n").alias("p"), F.col("p").alias("pp"))
            q = written(p.join(up, "p").select("n", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")), "parents")
            p = q.select("n", "p")
            if q.where("moved").isEmpty():
                break
        to = p.select(F.col("n").alias("a"), F.col("p").alias("ra"))
        e = e.join(to, "a").join(to.select(F.col("a").alias("b"), F.col("ra").alias("rb")), "b")
        e = written(e.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if labels is None:
            labels = p.select(F.col("n").alias("node"), F.col("p").alias("component"))
        else:
            labels = (labels.join(p.select(F.col("n").alias("component"), F.col("p").alias("root")), "component", "left")
                      .select("node", F.coalesce("root", "component").alias("component")))
            labels = written(labels, "labels")
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
