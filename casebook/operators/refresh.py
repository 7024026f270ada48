"""Citation refresh: metadata joined with its base extraction, enriched with landed citations, reduced to sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions import scalars as S
from casebook.operators.tables import missing, not_na, unless_missing

#: Citation columns, and the field of their entries that becomes a set.
CITATIONS = {"citations_incoming": "target_ecli", "citations_outgoing": "target_ecli", "legislations_cited": "legal_provision"}


def base_metadata(metadata: DataFrame, base: DataFrame) -> DataFrame:
    """Cases in both deliveries: the base's ``id`` is the key, its summary goes, a link without full text goes, too."""
    b = base.withColumnRenamed("id", "ecli").drop("summary")
    both = [c for c in b.columns if c in metadata.columns and c != "ecli"]
    return unless_missing(metadata.join(b.drop(*both), "ecli"), "link", "full_text")


def enrich(cases: DataFrame, citations: DataFrame) -> DataFrame:
    """Citation columns of the landed citations, replacing those that the cases have; cases without keep nulls."""
    return cases.drop(*CITATIONS).join(citations.select("ecli", *CITATIONS), "ecli", "left")


def citation_sets(cases: DataFrame) -> DataFrame:
    """Python-literal lists as sorted sets of their key field; empty fields go, other columns stay."""
    def one(c: str, field: str):
        return F.array_sort(F.array_distinct(F.filter(S.citation_fields(F.col(c), field), lambda x: x != "")))

    return cases.select(*[one(c, CITATIONS[c]).alias(c) if c in CITATIONS else F.col(f"`{c}`") for c in cases.columns])


def needing(cases: DataFrame, done: DataFrame) -> DataFrame:
    """Cases whose three citation columns are all there and that aren't in ``done``."""
    return missing(not_na(cases, list(CITATIONS)), done, "ecli")
