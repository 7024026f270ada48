"""Relational building blocks: pruning, predicates, joins, set operations, dedup, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions import fixed
from casebook.functions import scalars as S


def prune_eu(df: DataFrame) -> DataFrame:
    """Columns of the drop list go, missing ones don't matter; then the row rules for EU cases."""
    df = df.drop(*[c for c in fixed.EU_DROPPED if c not in fixed.EU_KEPT])
    df = df.withColumn("WORK HAS RESOURCE TYPE", F.coalesce("WORK HAS RESOURCE TYPE", F.lit("Unknown")))
    return df.where(F.contains(F.col("ECLI"), F.lit("ECLI:EU:C")) & F.col("CELEX IDENTIFIER").startswith("6") & F.col("WORK HAS RESOURCE TYPE").rlike("|".join(fixed.EU_TYPES)))


def unless_missing(df: DataFrame, target: str, witness: str) -> DataFrame:
    """``target`` is null where ``witness`` is."""
    return df.withColumn(target, F.when(F.col(witness).isNotNull(), F.col(target)))


def not_none(df: DataFrame, columns: list[str] | None = None, number: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (default: any), the first ``number`` of them in ``order``."""
    df = df.dropna(subset=columns or df.columns)
    return df if number is None else df.orderBy(*(order or df.columns)).limit(number)


def not_na(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null or the text ``<NA>``."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull() & (F.col(c) != "<NA>")
    return df.where(cond)


def from_year(df: DataFrame, ecli: str, least: int) -> DataFrame:
    return df.where(S.ecli_year(F.col(ecli)).try_cast("int") >= least)


def merge(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Equi-join with overlapping columns told apart by ``_x`` and ``_y``."""
    both = [c for c in left.columns if c in right.columns and c != on]
    left = left.withColumnsRenamed({c: c + "_x" for c in both})
    return left.join(right.withColumnsRenamed({c: c + "_y" for c in both}), on, how)


def missing(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks."""
    return left.join(right.select(on), on, "left_anti")


def map_cases(a: DataFrame, b: DataFrame, on: str = "ECLI") -> DataFrame:
    """Rows with keys in both, columns side by side; overlapping names raise."""
    if both := sorted(set(a.columns) & set(b.columns) - {on}):
        raise ValueError(f"columns overlap: {both}")
    return a.join(b, on)


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def first_wins(df: DataFrame, key: list[Column | str], order: list[Column | str], nulls_differ: bool = False) -> DataFrame:
    """One row of each key, the first in ``order``; with ``nulls_differ`` rows with a null in the key all stay.

    The order must be total. The aggregate keeps one row a key and task before the exchange.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    keys = [F.col(k) if isinstance(k, str) else k for k in key]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    named = df.select(F.struct(*cols).alias("row"), rank.alias("rank"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    ks = [F.col(f"k{i}") for i in range(len(keys))]
    some_null = F.lit(False)
    for k in ks:
        some_null = some_null | k.isNull()
    keyed = named.where(~some_null) if nulls_differ else named
    out = keyed.groupBy(*ks).agg(F.min_by("row", "rank").alias("row")).select("row.*")
    return out.unionByName(named.where(some_null).select("row.*")) if nulls_differ else out


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the last in ``order``."""
    rank = F.struct(*order)
    out = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), rank).alias("row"))
    return out.select("row.*")


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once for plans that read it several times: a checkpoint where the cluster names a folder for them, else a cache that spills to disk."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        return df.persist()
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def dense_ids(df: DataFrame, key: str, out: str = "id", ranges: int = 64) -> DataFrame:
    """Adds 1, 2, 3, ... in order of the unique ``key``, without one task seeing all rows.

    A bounded sample of keys gives fixed boundaries; each range is numbered on its own and shifted by the counts before it.
    """
    df = kept(df)  # read three times
    picked = df.select(F.col(key).alias("k")).where("k is not null").orderBy(F.xxhash64("k"), "k").limit(ranges * 16).collect()
    keys = sorted((r.k for r in picked), key=lambda x: x.encode() if isinstance(x, str) else x)
    bounds = [keys[i] for i in range(16, len(keys), 16)]
    cuts = F.array(*map(F.lit, bounds)) if bounds else None
    part = F.size(F.filter(cuts, lambda b: b <= F.col(key))) if bounds else F.lit(0)
    ranged = df.withColumn("__part", part)
    counts = {r[0]: r[1] for r in ranged.groupBy("__part").count().collect()}  # one row a range
    before, shift = 0, []
    for p in range(len(bounds) + 1):
        shift.append(before)
        before += counts.get(p, 0)
    n = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    return ranged.withColumn(out, (n + F.get(F.array(*[F.lit(s).cast("long") for s in shift]), F.col("__part"))).cast("long")).drop("__part")


def expand_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each element of each list column (rows with none stay)."""
    for c in columns:
        df = df.withColumn(c, F.explode_outer(c))
    return df


def flatten(df: DataFrame) -> DataFrame:
    """Nested fields as columns named by their leaves; of equal names the last wins."""
    leaves: dict[str, Column] = {}

    def walk(schema, path: list[str]) -> None:
        for f in schema.fields:
            if hasattr(f.dataType, "fields"):
                walk(f.dataType, [*path, f.name])
            else:
                at = F.col(f"`{path[0]}`") if path else F.col(f"`{f.name}`")
                for p in [*path[1:], f.name] if path else []:
                    at = at.getField(p)
                leaves.pop(f.name, None)
                leaves[f.name] = at.alias(f.name)

    walk(df.schema, [])
    return df.select(*leaves.values())
