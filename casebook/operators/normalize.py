"""Declarative normalisation of source records into the canonical one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions import fixed
from casebook.functions import scalars as S


@dataclass(frozen=True)
class SourceSpec:
    """A source as data: ``fields`` are (source column, canonical name) pairs, ``tools`` clean source columns by name."""

    name: str
    fields: tuple[tuple[str, str], ...]
    tools: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    key: str = "ECLI"

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(n for _, n in self.fields))


DUTCH = SourceSpec(
    "RS", fixed.DUTCH_FIELDS,
    {
        "language": S.jurisdiction, "creator": S.cascade, "procedure": S.unify_list, "subject": S.label_domains, "relation": S.unify_list,
        "references": S.unify_list, "hasVersion": S.alternative_sources, "inhoudsindicatie": S.xml_text, "info": S.xml_text, "full_text": S.xml_text,
    },
)
DUTCH_OPINIONS = SourceSpec("RS_OPI", fixed.DUTCH_OPINION_FIELDS, DUTCH.tools)
EU = SourceSpec("CELLAR", fixed.EU_FIELDS, {"YEAR OF THE LEGAL RESOURCE": S.first_year, "CELEX IDENTIFIER": S.pick_celex})
RIGHTS = SourceSpec("ECHR", fixed.RIGHTS_FIELDS, {"judgementdate": lambda c: S.any_date(c).cast("string")})
#: The dispatch on a source's name; a new source is one more entry.
SOURCES = {s.name: s for s in (DUTCH, DUTCH_OPINIONS, EU, RIGHTS)}


def normalize(df: DataFrame, spec: SourceSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename, prune and clean in one projection; rows without a key go.

    Of columns that share a canonical name the last non-empty one in the frame's order wins. Columns that the frame lacks are null.
    ``keep``: columns that pass through as they are.
    """
    sources = dict(spec.fields)
    by_name: dict[str, list[Column]] = {n: [] for n in spec.names}
    for c in df.columns:
        if c in sources:
            text = S.none_if_empty(F.col(f"`{c}`").cast("string"))
            cleaned = spec.tools.get(c, lambda x: x)(text)
            by_name[sources[c]].append(F.when(text.isNotNull(), F.struct(S.strip(cleaned).alias("v"))))
    picked = [(F.coalesce(*reversed(cols))["v"] if cols else F.lit(None).cast("string")).alias(n) for n, cols in by_name.items()]
    out = df.select(*picked, *[F.col(f"`{c}`") for c in keep])
    return out.where(F.col(spec.key).isNotNull() & (F.col(spec.key) != ""))


def per_column(df: DataFrame, columns: list[str], f: Callable[[Column], Column]) -> DataFrame:
    """``f`` over the listed columns, the others as they are."""
    return df.select(*[f(F.col(f"`{c}`")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def rejects(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with ``reason``: the names of all broken ones."""
    names = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(None)).otherwise(F.lit(n)) for n, c in conditions.items()]), lambda x: x.isNotNull())
    return df.withColumn("reason", F.array_join(names, ",")).where(F.col("reason") != "")


def within_budget(df: DataFrame, conditions: dict[str, Column], most: int) -> DataFrame:
    """Rows that break no rule; raises where ``most`` or more do (one count before any result)."""
    bad = rejects(df, conditions).limit(most).count()
    if bad >= most:
        raise ValueError(f"{bad} or more rows are rejected; the budget is under {most}")
    return df.where(reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conditions.values()]))
