"""Keyed items: one case as several items under a compound key, and their merge into a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import scalars as S

SETS = ("predecessor_successor_cases", "referenced_legislation_titles", "domains")
#: pk, ItemType, SourceDocDate, attrs map<string,string>, sets map<string,array<string>>, seq
COLUMNS = ("pk", "ItemType", "SourceDocDate", "attrs", "sets", "seq")


def _map(pairs, kind: str):
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs]), lambda e: e["value"].isNotNull())
    return F.map_from_entries(entries) if pairs else F.lit(None).cast(kind)


def fan_out(cases: DataFrame, source: str = "RS", doc_type: str = "DEC", key: str = "ECLI", date: str = "date_decision", seq: str = "seq") -> DataFrame:
    """Items of each case: ``DATA`` with all attributes and sets, and ``DOM_<domain>`` for each domain. Empty domains and keys give none."""
    stamp = S.keyed(source, doc_type, F.coalesce(F.col(date).cast("string"), F.lit("")))
    plain = [(c, F.col(c).cast("string")) for c in cases.columns if c not in (*SETS, seq)]
    sets = [(c, S.as_set(F.col(c))) for c in SETS if c in cases.columns]
    none, no_sets = "map<string,string>", "map<string,array<string>>"
    data = F.struct(F.lit("DATA").alias("ItemType"), stamp.alias("SourceDocDate"), _map(plain, none).alias("attrs"), _map(sets, no_sets).cast(no_sets).alias("sets"))
    domains = F.filter(S.as_set(F.col("domains")), lambda d: d != "")
    dom = F.transform(F.coalesce(domains, F.array().cast("array<string>")), lambda d: F.struct(S.keyed("DOM", d).alias("ItemType"), stamp.alias("SourceDocDate"), F.create_map(F.lit("domain"), d).alias("attrs"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>")).alias("sets")))
    kept = cases.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return kept.select(F.col(key).alias("pk"), F.col(seq).alias("seq"), F.inline(F.concat(F.array(data), dom))).select(*COLUMNS)


def upsert(store: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The store after all of ``batch`` in order of ``seq``: a put replaces its item whole, items that aren't put again stay.

    As a case's sets are added after its put, the last row of a key decides attributes and sets alike. One aggregate on the key; put rows beat the store's.
    """
    tagged = batch.withColumn("gen", F.lit(1))
    if store is not None:
        tagged = store.select(*COLUMNS).withColumn("gen", F.lit(0)).unionByName(tagged)
    rank = F.struct("gen", "seq")
    last = tagged.groupBy("pk", "ItemType").agg(F.max_by(F.struct("SourceDocDate", "attrs", "sets", "seq"), rank).alias("x"))
    return last.select("pk", "ItemType", "x.SourceDocDate", "x.attrs", "x.sets", "x.seq")


def accumulate(sets: DataFrame, key: list[str], column: str) -> DataFrame:
    """Union of the sets in ``column`` for each key."""
    long = sets.select(*key, F.explode(column).alias("value")).distinct()
    return long.groupBy(*key).agg(F.array_sort(F.collect_list("value")).alias(column))


def index_range(items: DataFrame, item_type: str, low: str, high: str) -> DataFrame:
    """Items of a type whose ``SourceDocDate`` lies between two prefixes, both included."""
    return items.where((F.col("ItemType") == item_type) & (F.col("SourceDocDate") >= low) & (F.col("SourceDocDate") <= high + "￿"))

