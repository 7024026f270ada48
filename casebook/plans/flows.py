"""End-to-end flows: each is one lazy plan up to its publishing step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casebook.operators import items, linked, network, refresh, tables
from casebook.operators.normalize import SOURCES, normalize
from casebook.sources import relational, sinks


#: Columns of the four relations in a relational store.
RELATIONS = {
    "law_element": 'id bigint, type varchar(32), bwb_id varchar(64), bwb_label_id bigint, lido_id varchar(512), jc_id varchar(512), number varchar(256), title varchar(4000)',
    "legal_case": "id bigint, ecli_id varchar(128), title varchar(4000), celex_id varchar(64), zaaknummer varchar(1000), uitspraakdatum date",
    "case_law": "case_id bigint, law_id bigint, source varchar(64), jc_id varchar(512), lido_id varchar(512), opschrift varchar(4000)",
    "law_alias": "alias varchar(1000), bwb_id varchar(64), source varchar(64)",
}


def load_slice(spark: SparkSession, raw: DataFrame, source: str, root: str, seq: str, edges: DataFrame | None = None) -> str:
    """Normalise a slice, fan it out, merge it into the published store and edges, and publish both together.

    ``seq`` numbers the rows in order of arrival.
    """
    cases = normalize(raw, SOURCES[source], (seq,)).withColumnRenamed(seq, "seq")
    there = sinks.exists(spark, f"{root}/CURRENT")
    store = sinks.current(spark, root, "items") if there else None
    tables = {"items": items.upsert(store, items.fan_out(cases, "RS" if source.startswith("RS") else source))}
    if edges is not None:
        tables["edges"] = network.merge_lines(sinks.current(spark, root, "edges") if there else None, edges)
    return sinks.publish(tables, root)


def load_linked(lines: DataFrame, titles: DataFrame, root: str) -> str:
    """N-Triples and title lists to the four relations, published together once no rule is broken."""
    t = linked.triples(lines)
    law, case = linked.laws(t), linked.cases(t)
    bridge, alias = linked.case_laws(t, case, law), linked.aliases(titles)
    broken = linked.violations(law, bridge, alias).where("n > 0")
    return sinks.publish({"law_element": law, "legal_case": case, "case_law": bridge, "law_alias": alias}, root, {"rules": broken})


def export_linked(spark: SparkSession, root: str, url: str, types: dict[str, str] = RELATIONS) -> None:
    """The published relations into a relational store, all switched in one transaction."""
    relational.replace_all({t: (sinks.current(spark, root, t), k) for t, k in types.items()}, url)


def refresh_citations(spark: SparkSession, metadata: DataFrame, base: DataFrame, citations: DataFrame, root: str) -> str:
    """Citation sets of the cases that have all three citation columns and aren't published yet, added to the published ones.

    Keys of ``metadata`` that ``base`` lacks are published, too, as ``not_found``. Each delivery holds a case once.
    """
    old = sinks.current(spark, root, "citations") if sinks.exists(spark, f"{root}/CURRENT") else None
    cases = refresh.enrich(refresh.base_metadata(metadata, base), citations)
    todo = tables.not_na(cases, list(refresh.CITATIONS)) if old is None else refresh.needing(cases, old)
    new = refresh.citation_sets(todo)
    lost = tables.missing(metadata, base.withColumnRenamed("id", "ecli"), "ecli").select("ecli").distinct()
    return sinks.publish({"citations": new if old is None else tables.union_all(old, new), "not_found": lost}, root)
