"""Legal roles derived from the star-schema tables: the same text runs in Spark SQL and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations", "labels", "pages")

ECLI = "'ECLI:NL:' || o_orderstatus || ':' || CAST(year(o_orderdate) AS STRING) || ':' || CAST(o_orderkey AS STRING)"
BWB = "'BWBR' || replace(p_brand, 'Brand#', '000')"
LIDO = f"{BWB} || '/' || CAST(p_size AS STRING) || '/' || CAST(p_partkey AS STRING)"
LAW = "'http://linkeddata.overheid.nl/terms/bwb/id/'"
CASE = "'http://linkeddata.overheid.nl/terms/jurisprudentie/id/'"
TERM = "'http://linkeddata.overheid.nl/terms/"

#: Raw Dutch case metadata.
RAW = f"""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE {ECLI} END AS ecli,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_decision,
  CASE o_orderkey % 3 WHEN 0 THEN 'NL' WHEN 1 THEN 'Nederland' ELSE '' END AS language,
  CASE o_orderkey % 9 WHEN 0 THEN 'Sector kanton Rechtbank Zwolle-Lelystad' WHEN 1 THEN 'Gerechtshof Arnhem' WHEN 2 THEN 'Rechtbank Leeuwarden'
    WHEN 3 THEN 'Kantongerecht Haarlemmermeer' WHEN 4 THEN 'Rechtbank ''s-Hertogenbosch' WHEN 5 THEN 'Rechtbank Den Haag'
    WHEN 6 THEN 'Hoge Raad' WHEN 7 THEN 'Gerechtshof Arnhem-Leeuwarden' ELSE n_name END AS creator,
  o_orderpriority || ', ' || c_mktsegment || ', ' || o_orderpriority AS procedure,
  CASE WHEN o_orderkey % 2 = 0 THEN c_mktsegment ELSE c_mktsegment || '; ' || n_name END AS subject,
  n_name || ', ' || c_mktsegment || ', ' || n_name AS "references",
  '<li>' || n_name || '  ' || chr(10) || '  ' || c_mktsegment || '</li>' AS "hasVersion",
  CASE WHEN o_orderkey % 7 = 0 THEN '-' WHEN o_orderkey % 11 = 0 THEN '<p>' || c_name WHEN o_orderkey % 13 = 0 THEN ''
    ELSE '<p>a<b>' || c_name || '</b>c &amp; d</p>' END AS inhoudsindicatie,
  CASE WHEN o_orderkey % 5 = 0 THEN 'sum ' || c_mktsegment ELSE '' END AS summary,
  '  ' || c_name || chr(9) AS title, CAST(o_orderkey AS STRING) AS zaaknummer
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
"""

#: The same metadata's second delivery: other columns, some cases missing.
BASE = f"""
SELECT {ECLI} AS ecli, 'http://x/' || CAST(o_orderkey AS STRING) AS link, CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS full_text,
  CAST(o_totalprice AS STRING) AS summary FROM {{orders}} WHERE o_orderkey % 3 <> 0
"""

#: Cases with typed attributes, as the network queries see them.
CASES = f"""
SELECT {ECLI} AS ecli, CAST(o_orderdate AS DATE) AS date_decision, 'RS' AS source, CASE WHEN o_orderkey % 10 = 0 THEN 'OPI' ELSE 'DEC' END AS document_type,
  n_name AS instance, c_mktsegment AS domain, o_orderpriority AS title, c_name AS summary
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
"""

#: Citations between numbered cases.
EDGES = "SELECT DISTINCT l_orderkey AS source, l_partkey AS target FROM {lineitem} WHERE l_orderkey <> l_partkey"

#: Linked-data triples of law elements and cases.
TRIPLES = f"""
SELECT {LAW} || {LIDO} AS s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p,
  {TERM}' || CASE p_partkey % 11 WHEN 0 THEN 'Wet' WHEN 1 THEN 'Boek' WHEN 2 THEN 'Deel' WHEN 3 THEN 'Hoofdstuk' WHEN 4 THEN 'SubParagraaf' WHEN 5 THEN 'Onbekend' ELSE 'Artikel' END AS o FROM {{part}}
UNION ALL SELECT {LAW} || {LIDO}, 'http://purl.org/dc/terms/title', p_name FROM {{part}} WHERE p_partkey % 4 = 0
UNION ALL SELECT {LAW} || {LIDO}, 'http://www.w3.org/2004/02/skos/core#prefLabel', 'pref ' || p_name FROM {{part}} WHERE p_partkey % 4 IN (0, 1)
UNION ALL SELECT {LAW} || {LIDO}, 'http://www.w3.org/2000/01/rdf-schema#label', 'label ' || p_name FROM {{part}} WHERE p_partkey % 4 = 2
UNION ALL SELECT {LAW} || {LIDO}, {TERM}heeftJuriconnect', 'jci1.0:c:' || {BWB} FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL SELECT {LAW} || {LIDO}, {TERM}heeftJuriconnect', 'jci1.3:c:' || {BWB} || '&artikel=' || CAST(p_partkey % 7 AS STRING) FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL SELECT {LAW} || {LIDO}, {TERM}heeftOnderdeelNummer', CAST(p_size AS STRING) FROM {{part}}
UNION ALL SELECT {LAW} || {LIDO}, {TERM}heeftOnderdeelNummer', CAST(p_size + 1 AS STRING) FROM {{part}} WHERE p_partkey % 5 = 0
UNION ALL SELECT {LAW} || {BWB}, 'http://purl.org/dc/terms/title', 'root' FROM {{part}} WHERE p_size = 1
UNION ALL SELECT {CASE} || {ECLI}, 'http://purl.org/dc/terms/title', 'case ' || o_orderpriority FROM {{orders}} WHERE o_orderkey % 4 = 0
UNION ALL SELECT {CASE} || {ECLI}, 'http://www.w3.org/2000/01/rdf-schema#label', 'label ' || o_orderpriority FROM {{orders}} WHERE o_orderkey % 4 IN (0, 1)
UNION ALL SELECT {CASE} || {ECLI}, {TERM}heeftZaaknummer', 'C/' || CAST(o_custkey AS STRING) FROM {{orders}}
UNION ALL SELECT {CASE} || {ECLI}, {TERM}heeftZaaknummer', 'A/' || CAST(o_orderkey AS STRING) FROM {{orders}} WHERE o_orderkey % 6 = 0
UNION ALL SELECT {CASE} || {ECLI}, {TERM}heeftUitspraakdatum', CAST(CAST(o_orderdate AS DATE) AS STRING) FROM {{orders}}
UNION ALL SELECT {CASE} || {ECLI}, {TERM}linkt',
  CASE l_linenumber % 4 WHEN 0 THEN {LAW} || {LIDO} WHEN 1 THEN {LAW} || {BWB} || '/' || CAST(p_size AS STRING) || '/0' WHEN 2 THEN {LAW} || {BWB} || '/9999' ELSE {CASE} || 'ECLI:NL:X:2000:1' END
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey
UNION ALL SELECT {CASE} || {ECLI}, {TERM}refereertAan',
  'linktype=x|target=bwb|uri=jci1.3:c:' || {BWB} || '&g=' || CAST(l_quantity AS STRING) || '|lido-id=' || {LAW} || {LIDO} || '|opschrift=artikel ' || CAST(p_size AS STRING)
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey
"""

#: Title lists of laws: titles in order, some null, some equal but for case.
TITLES = f"""
SELECT {BWB} AS bwb_id, p_partkey AS k, '.,; ' || upper(p_type) || '  Wet' AS t0, lower(p_type) || ' wet' AS t1,
  CASE WHEN p_partkey % 2 = 0 THEN p_name END AS t2 FROM {{part}}
"""


def spark_text(sql: str) -> str:
    return sql.replace('"', "`")


def duck(sql: str) -> str:
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of a role."""
    used = [t for t in TABLES if "{" + t + "}" in sql]
    return spark.sql(spark_text(sql), **{t: table(spark, sf_dir, t) for t in used})
