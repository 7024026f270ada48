"""Queries over linked data, the citation network, slices and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casebook.operators import linked as L
from casebook.operators import network as N
from casebook.plans.registry import query
from casebook.plans.roles import CASES, EDGES, TITLES, TRIPLES, table, view
from casebook.streaming import slices as M

_P = "http://linkeddata.overheid.nl/terms/"
_LAWP = "http://linkeddata.overheid.nl/terms/bwb/id/"
_first = lambda p, n: f"min(o) FILTER (WHERE p = '{p}') AS {n}"
_TITLE, _PREF, _LABEL, _TYPE = "http://purl.org/dc/terms/title", "http://www.w3.org/2004/02/skos/core#prefLabel", "http://www.w3.org/2000/01/rdf-schema#label", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"

_LAWS = f"""
SELECT row_number() OVER (ORDER BY lido_id) AS id, * FROM (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, CASE WHEN jc_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY jc_id ORDER BY lido_id) END AS rn FROM (
      SELECT CASE ty WHEN '{_P}Wet' THEN 'wet' WHEN '{_P}Boek' THEN 'boek' WHEN '{_P}Deel' THEN 'deel' WHEN '{_P}Hoofdstuk' THEN 'hoofdstuk' WHEN '{_P}SubParagraaf' THEN 'subparagraaf' WHEN '{_P}Artikel' THEN 'artikel' END AS type,
        split_part(path, '/', 1) AS bwb_id, TRY_CAST(split_part(path, '/', 2) AS BIGINT) AS bwb_label_id, path AS lido_id, jc_id,
        CASE WHEN nn = 1 THEN num END AS number, coalesce(t, pl, lb) AS title
      FROM (SELECT substr(s, 44) AS path, {_first(_TYPE, 'ty')}, {_first(_TITLE, 't')}, {_first(_PREF, 'pl')}, {_first(_LABEL, 'lb')},
          min(o) FILTER (WHERE p = '{_P}heeftJuriconnect' AND o LIKE 'jci1.3%') AS jc_id, {_first(_P + 'heeftOnderdeelNummer', 'num')}, count(*) FILTER (WHERE p = '{_P}heeftOnderdeelNummer') AS nn
        FROM ({TRIPLES}) WHERE starts_with(s, '{_LAWP}') AND length(s) > 54 GROUP BY s)
    ) WHERE type IS NOT NULL AND title IS NOT NULL
  ) WHERE rn = 1)
"""
_CASES = f"""
SELECT row_number() OVER (ORDER BY ecli_id) AS id, ecli_id, coalesce(t, lb, pl) AS title, CAST(NULL AS VARCHAR) AS celex_id, no AS zaaknummer, CAST(d AS DATE) AS uitspraakdatum FROM (
  SELECT split_part(s, '/', 7) AS ecli_id, {_first(_TITLE, 't')}, {_first(_LABEL, 'lb')}, {_first(_PREF, 'pl')}, {_first(_P + 'heeftUitspraakdatum', 'd')},
    string_agg(o, ',' ORDER BY o) FILTER (WHERE p = '{_P}heeftZaaknummer') AS no
  FROM ({TRIPLES}) WHERE starts_with(s, '{_P}jurisprudentie/id/') GROUP BY s)
"""
_LINKS = f"""
WITH laws AS ({_LAWS}), cs AS ({_CASES}), t AS ({TRIPLES}), l AS (
  SELECT split_part(s, '/', 7) AS ecli_id, 'lido-linkt' AS source, CAST(NULL AS VARCHAR) AS jc_id, o AS iri, CAST(NULL AS VARCHAR) AS opschrift FROM t WHERE p = '{_P}linkt'
  UNION ALL SELECT split_part(s, '/', 7), 'lido-ref', regexp_extract(o, 'uri=([^|]*)', 1), regexp_extract(o, 'lido-id=([^|]*)', 1), regexp_extract(o, 'opschrift=([^|]*)', 1) FROM t WHERE p = '{_P}refereertAan'
), x AS (SELECT *, substr(iri, 44) AS path, split_part(substr(iri, 44), '/', 1) AS bwb, split_part(substr(iri, 44), '/', 2) AS label FROM l WHERE starts_with(iri, '{_LAWP}')),
l2 AS (SELECT bwb_id, CAST(bwb_label_id AS VARCHAR) AS label, min(id) AS id FROM laws GROUP BY ALL),
l3 AS (SELECT bwb_id, arg_min(id, (bwb_label_id, id)) AS id FROM laws GROUP BY ALL)
SELECT cs.id AS case_id, coalesce(a.id, b.id, c.id) AS law_id, x.source, x.jc_id, CASE WHEN a.id IS NOT NULL THEN x.path WHEN b.id IS NOT NULL THEN x.bwb || '/' || x.label ELSE x.bwb END AS lido_id, x.opschrift
FROM x JOIN cs USING (ecli_id) LEFT JOIN laws a ON a.lido_id = x.path LEFT JOIN l2 b ON b.bwb_id = x.bwb AND b.label = x.label LEFT JOIN l3 c ON c.bwb_id = x.bwb
WHERE coalesce(a.id, b.id, c.id) IS NOT NULL
"""


def _triples(spark, sf_dir):
    return view(spark, sf_dir, TRIPLES)


@query(f"SELECT s, p, o FROM ({TRIPLES})")
def triples_parse(spark, sf_dir):
    iri = F.col("o").startswith("http")
    line = F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), F.when(iri, F.concat(F.lit("<"), "o", F.lit(">"))).otherwise(F.concat(F.lit('"'), "o", F.lit('"@nl'))), F.lit(" ."))
    return L.triples(_triples(spark, sf_dir).select(line.alias("value")))


@query(f"SELECT s, array_to_string(list_sort(list(o) FILTER (WHERE p = '{_P}heeftJuriconnect')), ',') AS jci, array_to_string(list_sort(list(o) FILTER (WHERE p = '{_P}heeftOnderdeelNummer')), ',') AS num FROM ({TRIPLES}) WHERE p IN ('{_P}heeftJuriconnect', '{_P}heeftOnderdeelNummer') GROUP BY s")
def triples_pivot(spark, sf_dir):
    v = L.subject_values(_triples(spark, sf_dir), {"jci": _P + "heeftJuriconnect", "num": _P + "heeftOnderdeelNummer"})
    return v.select("s", F.array_join("jci", ",").alias("jci"), F.array_join("num", ",").alias("num"))


@query(_LAWS)
def law_elements(spark, sf_dir):
    return L.laws(_triples(spark, sf_dir))


@query(_CASES)
def legal_cases(spark, sf_dir):
    return L.cases(_triples(spark, sf_dir))


@query(_LINKS)
def case_law_links(spark, sf_dir):
    t = _triples(spark, sf_dir).persist()  # read by several jobs; spills to disk
    return L.case_laws(t, L.cases(t), L.laws(t))


_ALIAS = f"""SELECT alias, bwb_id, 'bwbidlist' AS source FROM (SELECT *, row_number() OVER (PARTITION BY bwb_id, lower(alias) ORDER BY pos, alias) AS rn FROM (
  SELECT bwb_id, pos, regexp_replace(regexp_replace(raw, '^[\\s.,;:]+', ''), '\\s+', ' ', 'g') AS alias
  FROM (SELECT bwb_id, 0 AS pos, t0 AS raw FROM ({TITLES}) UNION ALL SELECT bwb_id, 1, t1 FROM ({TITLES}) UNION ALL SELECT bwb_id, 2, t2 FROM ({TITLES})) WHERE raw IS NOT NULL)) WHERE rn = 1"""


def _aliases(spark, sf_dir):
    return L.aliases(view(spark, sf_dir, TITLES).select("bwb_id", F.array("t0", "t1", "t2").alias("titles")))


@query(_ALIAS)
def law_alias_nocase(spark, sf_dir):
    return _aliases(spark, sf_dir)


@query("SELECT 'case_id' AS reference, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'law_id', 0")
def fk_violations(spark, sf_dir):
    t = _triples(spark, sf_dir).persist()  # read by several jobs; spills to disk
    law, case = L.laws(t), L.cases(t)
    bridge = L.case_laws(t, case, law)
    count = lambda c, p: L.orphans(bridge, c, p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("reference"), "n")
    return count("case_id", case).unionByName(count("law_id", law))


@query("SELECT * FROM (VALUES ('law_type', CAST(0 AS BIGINT)), ('law_lido_id', 0), ('law_jc_id', 0), ('case_law_source', 0), ('alias_source', 0), ('alias', 0)) AS t(rule, n)")
def rule_violations(spark, sf_dir):
    t = _triples(spark, sf_dir).persist()  # read by several jobs; spills to disk
    law = L.laws(t)
    return L.violations(law, L.case_laws(t, L.cases(t), law), _aliases(spark, sf_dir))


_NET = f"({CASES}) WHERE date_decision BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND document_type = 'DEC' AND domain IN ('BUILDING', 'MACHINERY')"


def _network_cases(spark, sf_dir):
    return view(spark, sf_dir, CASES).withColumn("domains", F.array("domain"))


@query(f"SELECT ecli, domain FROM {_NET}")
def network_filter(spark, sf_dir):
    return N.filter_cases(_network_cases(spark, sf_dir), date_start="1996-01-01", date_end="1999-12-31", domains=["BUILDING", "MACHINERY"]).select("ecli", "domain")


@query(f"SELECT ecli FROM ({CASES}) WHERE document_type = 'DEC' AND ((lower(title) LIKE '%1-urgent%' AND NOT regexp_matches(lower(summary), '1')) OR regexp_matches(lower(title), '(^|[^a-z0-9])med'))")
def keyword_search(spark, sf_dir):
    c = N.filter_cases(_network_cases(spark, sf_dir), date_start="1900-01-01", date_end="2100-01-01", keywords='"1-urgent"', searched=("title",))
    c = c.where(~F.lower("summary").rlike("1"))
    m = N.filter_cases(_network_cases(spark, sf_dir), date_end="2100-01-01", keywords="med* | medium", searched=("title",))
    return c.select("ecli").unionByName(m.select("ecli")).distinct()


_SEED = "SELECT o_orderkey AS id FROM {orders} WHERE o_orderkey % 100 = 0"
_FWD = "SELECT target FROM e WHERE source IN (SELECT id FROM {0})"


def _expanded(spark, sf_dir, back, ahead):
    return N.expand(view(spark, sf_dir, _SEED), view(spark, sf_dir, EDGES), back, ahead)


@query(f"WITH e AS ({EDGES}), s AS ({_SEED}) SELECT id FROM s UNION SELECT target FROM e WHERE source IN (SELECT id FROM s)")
def network_expand_targets_1(spark, sf_dir):
    return _expanded(spark, sf_dir, 0, 1)


@query(f"WITH e AS ({EDGES}), s AS ({_SEED}) SELECT id FROM s UNION SELECT source FROM e WHERE target IN (SELECT id FROM s)")
def network_expand_sources_1(spark, sf_dir):
    return _expanded(spark, sf_dir, 1, 0)


@query(f"WITH e AS ({EDGES}), s AS ({_SEED}), h AS (SELECT target AS id FROM e WHERE source IN (SELECT id FROM s)) SELECT id FROM s UNION SELECT id FROM h UNION SELECT target FROM e WHERE source IN (SELECT id FROM h)")
def network_expand_2hop(spark, sf_dir):
    return _expanded(spark, sf_dir, 0, 2)


@query(f"WITH e AS ({EDGES}), s AS ({_SEED}), n AS (SELECT id FROM s UNION SELECT target FROM e WHERE source IN (SELECT id FROM s)) SELECT CAST(source AS VARCHAR) || '_' || CAST(target AS VARCHAR) AS id, source, target FROM e WHERE source IN (SELECT id FROM n) AND target IN (SELECT id FROM n)")
def network_edges(spark, sf_dir):
    e = view(spark, sf_dir, EDGES)
    return N.induced(_expanded(spark, sf_dir, 0, 1), e).select(F.concat_ws("_", "source", "target").alias("id"), "source", "target")


@query(f"SELECT ecli AS id, date_decision, instance FROM ({CASES}) WHERE ecli LIKE '%00'")
def node_fetch(spark, sf_dir):
    c = view(spark, sf_dir, CASES).withColumn("id", F.col("ecli"))
    return N.fetch(c.where(F.col("id").like("%00")).select("id"), c, "NETWORKSTATS")


@query(f"SELECT id, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i + o) AS BIGINT) AS degree FROM (SELECT source AS id, 0 AS i, 1 AS o FROM ({EDGES}) UNION ALL SELECT target, 1, 0 FROM ({EDGES})) GROUP BY id")
def degree_stats(spark, sf_dir):
    return N.degrees(view(spark, sf_dir, EDGES))


_RANK = f"WITH e AS ({EDGES}), v AS (SELECT source AS id FROM e UNION SELECT target FROM e), k AS (SELECT count(*) AS n FROM v), g AS (SELECT source AS id, count(*) AS c FROM e GROUP BY 1), r0 AS (SELECT v.id, g.c, 1.0::DOUBLE / k.n AS rank FROM v LEFT JOIN g USING (id), k)"
for _i in range(3):
    _RANK += f""", r{_i + 1} AS (SELECT r.id, r.c, (1 - 0.85::DOUBLE) / k.n + 0.85::DOUBLE * (coalesce(h.got, 0) + (SELECT coalesce(sum(rank), 0) FROM r{_i} WHERE c IS NULL) / k.n) AS rank
      FROM r{_i} r LEFT JOIN (SELECT e.target AS id, sum(x.rank / x.c) AS got FROM e JOIN r{_i} x ON x.id = e.source GROUP BY 1) h ON h.id = r.id, k)"""


@query(_RANK + " SELECT id, round(rank, 9) AS rank FROM r3")
def pagerank_fixed_iters(spark, sf_dir):
    e = view(spark, sf_dir, EDGES)
    ids = e.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    return N.pagerank(ids, e, 3).select("id", F.round("rank", 9).alias("rank"))


@query("SELECT c_custkey, first, least(last_day(first), b) AS last FROM (SELECT c_custkey, greatest(CAST(m AS DATE), a) AS first, b FROM (SELECT c_custkey, a, b, unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS m FROM (SELECT c_custkey, DATE '1996-01-15' + CAST(c_custkey % 40 AS INTEGER) AS a, DATE '1996-04-10' + CAST(c_custkey % 50 AS INTEGER) AS b FROM {customer})))")
def month_slices(spark, sf_dir):
    t = table(spark, sf_dir, "customer").select("c_custkey", F.expr("date_add(DATE '1996-01-15', cast(c_custkey % 40 as int))").alias("a"), F.expr("date_add(DATE '1996-04-10', cast(c_custkey % 50 as int))").alias("b"))
    return M.month_slices(t, "a", "b").select("c_custkey", "first", "last")


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS slice, count(*) AS n FROM {orders} GROUP BY 1")
def month_slice_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(M.slice_of(F.col("o_orderdate")).alias("slice")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM {orders} WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-30'")
def incremental_since_mark(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return M.since(t, "day", "2000-06-30")


@query("SELECT DISTINCT slice, lead(slice) OVER (ORDER BY slice) AS next FROM (SELECT DISTINCT CAST(date_trunc('year', o_orderdate) AS DATE) AS slice FROM {orders})")
def back_fill_ranges(spark, sf_dir):
    years = table(spark, sf_dir, "orders").select(F.trunc(F.col("o_orderdate").cast("date"), "YEAR").alias("slice")).distinct()
    ordered = years.agg(F.array_sort(F.collect_set("slice")).alias("a"))  # one value a year
    return ordered.select(F.posexplode("a").alias("i", "slice"), "a").select("slice", F.get("a", F.col("i") + 1).alias("next"))


@query("SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, count(*) AS n FROM {events} GROUP BY 1, 2")
def monthly_events(spark, sf_dir):
    import tempfile

    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
    shared = shared or "file://" + tempfile.mkdtemp(prefix="casebook-")
    at = f"{shared.rstrip('/')}/casebook-stream-{uuid.uuid4().hex}"
    return M.monthly_events(spark, f"{sf_dir}/events.parquet", f"{at}/checkpoint", f"{at}/out")
