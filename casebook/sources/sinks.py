"""Sinks: files, slices, objects by key, versioned tables with an atomic switch."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header, absent values empty. ``mode``: errorifexists, overwrite, append."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_slices(df: DataFrame, path: str, date: str) -> None:
    """One directory for each month of ``date``; months in ``df`` are replaced, others stay."""
    sliced = df.withColumn("slice", F.trunc(F.col(date).cast("date"), "MM"))
    sliced.repartition("slice", F.pmod(F.xxhash64(*df.columns[:1]), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(path)


def write_objects(df: DataFrame, path: str, keys: tuple[str, ...] = ("item_id", "celex")) -> None:
    """One JSON object for each key, ``<key>.json``, through the cluster's file system; keys are unique, a later run replaces."""
    key = F.coalesce(*[F.col(k) for k in keys if k in df.columns])
    rows = df.select(F.regexp_replace(key, r"[^\w.-]", "_").alias("key"), F.to_json(F.struct(*df.columns)).alias("body")).where("key is not null")
    rows.repartition("key").write.mode("overwrite").partitionBy("key").text(path)


def _uri(path: str) -> str:
    """A path as a URI that pyarrow's file systems know, too."""
    if "://" not in path and not path.startswith("file:"):
        return "file://" + path
    return "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path


def put_objects(df: DataFrame, path: str, keys: tuple[str, ...] = ("item_id", "celex")) -> int:
    """One file ``<key>.json`` for each row with a key, put by the tasks themselves; how many.

    Keys are unique and percent-encoded in names. An object is written aside and moved into place, so a repeated task or a later run replaces it whole.
    """
    key = F.coalesce(*[F.col(k) for k in keys if k in df.columns])
    rows = df.select(F.url_encode(key.cast("string")).alias("key"), F.to_json(F.struct(*df.columns)).alias("body")).where("key is not null")
    uri = _uri(path)

    def put(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(uri)
        store.create_dir(folder, recursive=True)
        for b in batches:
            for k, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                aside = f"{folder}/.{k}.{uuid.uuid4().hex}"
                with store.open_output_stream(aside) as f:
                    f.write(body.encode())
                store.move(aside, f"{folder}/{k}.json")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return rows.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def append_documents(df: DataFrame, path: str) -> None:
    """Add documents to a folder of JSON lines; ``read_documents(lines=True)`` reads all of them."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def remove(spark: SparkSession, paths: list[str]) -> list[str]:
    """Delete source files or slices once they are loaded; those that were there."""
    gone = []
    for path in paths:
        p, fs = _fs(spark, path)
        if fs.exists(p) and fs.delete(p, True):
            gone.append(path)
    return gone


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated, no header."""
    df.write.mode(mode).option("sep", "\t").csv(path)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file whole: written aside, then renamed."""
    p, fs = _fs(spark, path)
    aside, _ = _fs(spark, path + ".new")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"{path} can't be replaced")


def publish(tables: dict[str, DataFrame], root: str, checks: dict[str, DataFrame] | None = None) -> str:
    """Write all tables as a new version and then switch a pointer to it; readers see the old version or the new one whole.

    ``checks`` are frames that must be empty (rule breaches), looked at on what was written before the switch.
    """
    spark = next(iter(tables.values())).sparkSession
    version = datetime.now(timezone.utc).strftime("v%Y%m%dT%H%M%S%f")
    for name, df in tables.items():
        df.write.parquet(f"{root}/{version}/{name}")
    for name, df in (checks or {}).items():
        if not df.isEmpty():
            raise ValueError(f"{name}: the new version breaks a rule, the old one stays")
    _write_text(spark, f"{root}/CURRENT", json.dumps({"version": version, "tables": sorted(tables)}))
    return version


def current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the version that is published."""
    pointer = json.loads(spark.read.text(f"{root}/CURRENT", wholetext=True).first().value)
    return spark.read.parquet(f"{root}/{pointer['version']}/{table}")


def merge_publish(df: DataFrame, root: str, table: str) -> str:
    """Union of the published lines and new ones, published as a new version; the first call creates it."""
    spark = df.sparkSession
    old = current(spark, root, table) if exists(spark, f"{root}/CURRENT") else None
    return publish({table: df.distinct() if old is None else old.unionByName(df).distinct()}, root)


def export(df: DataFrame, folder: str, name: str, kind: str = "csv") -> str:
    """A file set with the time in its name."""
    path = f"{folder}/{name}_{datetime.now(timezone.utc):%Y-%m-%d_%H-%M-%S}.{kind}"
    write_csv(df, path) if kind == "csv" else df.write.json(path)
    return path


def prepare(spark: SparkSession, outputs: list[str], source: str | None = None) -> None:
    """Fail early where an output exists or the input doesn't."""
    if found := [p for p in outputs if exists(spark, p)]:
        raise FileExistsError(f"exists already: {found}")
    if source and not exists(spark, source):
        raise FileNotFoundError(source)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """``df``, or an error where it is empty: a download that brought nothing must not be loaded."""
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


@dataclass(frozen=True)
class Layout:
    """Where a pipeline keeps its data under one root."""

    root: str

    def raw(self, source: str, name: str = "") -> str:
        return "/".join(x for x in (self.root, "raw", source, name) if x)

    def processed(self, source: str, name: str = "") -> str:
        return "/".join(x for x in (self.root, "processed", source, name) if x)

    def full_text(self, source: str) -> str:
        return f"{self.root}/full_text/{source}"
