"""Shared plumbing of the text operators: scratch tables, connected components, hot-bucket tiling, label folds."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``; where it is unset, a temp folder in local mode, an error otherwise."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        path = tempfile.mkdtemp(prefix="casebook-")
        atexit.register(shutil.rmtree, path, True)
        _LOCAL[app] = "file://" + path
    return _LOCAL[app]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _sweep(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        try:
            _delete(spark, p)
        except Exception:  # the session has ended; nothing is left to ask
            return


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages start from files that outlive any executor.

    The table is dropped with :func:`drop` or when the driver ends.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/casebook-{app}/{uuid.uuid4().hex}"
    if app not in _MADE:
        _MADE[app] = []
        atexit.register(_sweep, spark, _MADE[app])
    _MADE[app].append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._casebook_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by :func:`cut` that no later plan reads."""
    path = getattr(df, "_casebook_path", None)
    if path:
        _delete(df.sparkSession, path)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id's decimal text, modulo ``k`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(k)


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, root)`` with root the smallest node reachable.

    Each round every node takes the smallest label two steps up that it or a neighbour has, and hands it on to its own label, too, so that
    whole trees are hooked at once; the rounds grow with the logarithm of a path's length. Labels travel into a combining ``min``, so a
    hub of any degree costs one row a task, and the joins are plain equi-joins that adaptive execution may split.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(both.where("a <> b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    none = F.lit(None).cast("long")
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        far = labels.join(up, "root").select("node", "root", "top")
        told = both.join(far.select(F.col("node").alias("b"), F.col("top").alias("low")), "b").select(F.col("a").alias("node"), none.alias("root"), none.alias("top"), "low")
        own = far.withColumn("low", none).unionByName(told).groupBy("node").agg(F.max("root").alias("root"), F.max("top").alias("top"), F.min("low").alias("low"))
        mine = F.struct("node", F.least("low", "top").alias("root"), F.col("root").alias("was"))
        hooked = F.struct(F.col("root").alias("node"), F.col("low").alias("root"), none.alias("was"))
        new = cut(own.select(F.inline(F.array(mine, hooked))).groupBy("node").agg(F.min("root").alias("root"), F.max("was").alias("was")))
        changed = not new.where("root <> was").isEmpty()
        drop(labels)
        labels = new
        if not changed:
            drop(both)
            return labels.select("node", "root")


def tiled(df: DataFrame, keys: list[str], tile: int, salt: Column) -> DataFrame:
    """Split every key's rows into tiles of about ``tile`` rows and give each row to each pair of tiles it is in.

    Adds ``ti <= tj`` (the pair) and ``side`` (-1: the pair is one tile; 0/1: of the first or second). A key with no
    more than ``tile`` rows keeps each row once. Every two rows of a key meet in exactly one pair.
    """
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile)
    big = big.select(*keys, F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    out = df.join(big, keys, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    out = out.withColumn("own", F.pmod(salt, F.col("tiles")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return out.select(
        *df.columns, F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"),
        F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )


def stretches(text: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of runs of rows that hold about ``most`` bytes of text, or one longer row: what a worker has in Python at a time.

    Memory that the last run needed goes back to the system.
    """
    total = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(text):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield at, end - at
        at = end
    pa.default_memory_pool().release_unused()
    _trim()


@lru_cache(maxsize=1)
def _libc():
    import ctypes

    try:
        lib = ctypes.CDLL("libc.so.6")
        return lib if hasattr(lib, "malloc_trim") else None
    except OSError:  # another C library
        return None


def _trim() -> None:
    if lib := _libc():
        lib.malloc_trim(0)
