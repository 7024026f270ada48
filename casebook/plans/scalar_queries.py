"""Queries over the cleaning functions and the normaliser."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.functions import fixed
from casebook.functions import scalars as S
from casebook.operators import normalize as N
from casebook.plans.registry import query
from casebook.plans.roles import BASE, BWB, ECLI, LIDO, RAW, table, view

_CASCADE = "creator"
for _old, _new in fixed.INSTANCES:
    _o, _n = (x.replace("'", "''") for x in (_old, _new))
    _CASCADE = f"replace({_CASCADE}, '{_o}', '{_n}')"
_UNIFY = "array_to_string(list_sort(list_distinct(string_split({0}, ', '))), '; ')"
_DOMAINS = "CASE WHEN contains(subject, '; ') THEN subject ELSE subject || '; ' || subject || '-Algemeen/Overig/Niet-gelabeld' END"
_XML = "CASE WHEN inhoudsindicatie LIKE '<p>a%' THEN 'a ' || regexp_extract(inhoudsindicatie, '<b>(.*)</b>', 1) || ' c & d' END"
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"

_NORMAL = f"""
SELECT ecli AS "ECLI", nullif(CASE WHEN language <> '' THEN 'NL' END, '') AS language, {_CASCADE} AS instance, date_decision, zaaknummer AS case_number,
  {_UNIFY.format('procedure')} AS procedure_type, {_DOMAINS} AS domains, {_UNIFY.format('"references"')} AS referenced_legislation_titles,
  regexp_extract("hasVersion", '<li>(.*?) *\\n', 1) || '; ' || regexp_extract("hasVersion", '\\n *(.*)</li>', 1) AS alternative_publications,
  {_STRIP.format('title')} AS title, coalesce(nullif(summary, ''), {_XML}) AS summary
FROM ({RAW}) WHERE ecli <> ''
"""
_NAMES = ("ECLI", "language", "instance", "date_decision", "case_number", "procedure_type", "domains", "referenced_legislation_titles", "alternative_publications", "title", "summary")


def normal(spark, sf_dir):
    """Canonical Dutch records with their number ``seq``."""
    raw = view(spark, sf_dir, RAW)
    return N.normalize(raw.drop("k"), N.DUTCH)


@query(_NORMAL)
def normalize_cases(spark, sf_dir):
    return normal(spark, sf_dir).select(*_NAMES)


@query(f"SELECT k, {_XML} AS text FROM ({RAW})")
def xml_strip(spark, sf_dir):
    return view(spark, sf_dir, RAW).select("k", S.xml_text(F.col("inhoudsindicatie")).alias("text"))


@query(f"SELECT k, {_UNIFY.format('procedure')} AS unified FROM ({RAW})")
def list_unify(spark, sf_dir):
    return view(spark, sf_dir, RAW).select("k", S.unify_list(F.col("procedure")).alias("unified"))


@query("SELECT p_partkey, p_name || '; ' || p_brand AS unified FROM {part}")
def list_text_unify(spark, sf_dir):
    t = table(spark, sf_dir, "part").withColumn("c", F.concat(F.lit("['"), "p_name", F.lit("', '"), "p_brand", F.lit("']")))
    return t.select("p_partkey", S.unify_list_text(F.col("c")).alias("unified"))


_CELEX = "CASE p_partkey % 4 WHEN 0 THEN p_brand || '_x;' || p_type || ';z' WHEN 1 THEN p_brand || '_x' WHEN 2 THEN 'a_b;c_d' ELSE p_type END"


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN p_brand || '_x' WHEN 2 THEN NULL ELSE p_type END AS celex FROM {part}")
def celex_pick(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.pick_celex(F.expr(_CELEX)).alias("celex"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year FROM {orders}")
def year_prefix(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", S.first_year(F.col("o_orderdate").cast("date").cast("string")).alias("year"))


@query(f"SELECT k, {_CASCADE} AS instance FROM ({RAW})")
def instance_cascade(spark, sf_dir):
    return view(spark, sf_dir, RAW).select("k", S.cascade(F.col("creator")).alias("instance"))


@query(f"""SELECT k, regexp_extract("hasVersion", '<li>(.*?) *\\n', 1) || '; ' || regexp_extract("hasVersion", '\\n *(.*)</li>', 1) AS sources FROM ({RAW})""")
def alt_sources(spark, sf_dir):
    return view(spark, sf_dir, RAW).select("k", S.alternative_sources(F.col("hasVersion")).alias("sources"))


@query(f"SELECT k, CASE WHEN language IN ('NL', 'Nederland') THEN 'NL' END AS jurisdiction FROM ({RAW})")
def jurisdiction_lookup(spark, sf_dir):
    return view(spark, sf_dir, RAW).select("k", S.jurisdiction(F.col("language")).alias("jurisdiction"))


@query(f"SELECT k, reason FROM (SELECT k, concat_ws(',', CASE WHEN ecli = '' THEN 'ecli' END, CASE WHEN language = '' THEN 'language' END) AS reason FROM ({RAW})) WHERE reason <> ''")
def dead_letters(spark, sf_dir):
    raw = view(spark, sf_dir, RAW)
    return N.rejects(raw, {"ecli": F.col("ecli") != "", "language": S.jurisdiction(F.col("language")).isNotNull()}).select("k", "reason")


@query(f"SELECT k, CASE WHEN ecli <> '' THEN string_split(ecli, ':')[4] END AS year, ecli <> '' AS valid FROM ({RAW})")
def ecli_year(spark, sf_dir):
    return view(spark, sf_dir, RAW).select("k", S.ecli_year(F.col("ecli")).alias("year"), S.is_ecli(F.col("ecli")).alias("valid"))


@query(f"SELECT p_partkey, {LIDO} AS lido_id, {BWB} AS bwb_id, CAST(p_size AS VARCHAR) AS label, CAST(p_partkey AS VARCHAR) AS tail FROM {{part}}")
def law_id_strip(spark, sf_dir):
    path = S.law_path(F.concat(F.lit(fixed.LAW_PREFIX), F.expr(LIDO)))
    return table(spark, sf_dir, "part").select("p_partkey", path.alias("lido_id"), S.segment(path, 0).alias("bwb_id"), S.segment(path, 1).alias("label"), S.segment(path, -1).alias("tail"))


_REF = "'uri=' || o_orderpriority || '|flag|opschrift=' || o_orderstatus || '=' || CAST(o_orderkey AS STRING) || '|uri=' || o_orderstatus"


@query("SELECT o_orderkey, o_orderstatus AS uri, o_orderstatus || '=' || CAST(o_orderkey AS VARCHAR) AS opschrift, CAST(NULL AS VARCHAR) AS flag, CAST(3 AS INTEGER) AS keys FROM {orders}")
def ref_props_parse(spark, sf_dir):
    t = table(spark, sf_dir, "orders").withColumn("m", S.reference_fields(F.expr(_REF)))
    return t.select("o_orderkey", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("uri", "opschrift", "flag")], F.size("m").alias("keys"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(x, '^[\\s.,;:]+', ''), '\\s+', ' ', 'g') AS title FROM (SELECT p_partkey, '.,; ' || p_name || '   ' || chr(10) || p_type AS x FROM {part})")
def title_clean(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.clean_title(F.expr("'.,; ' || p_name || '   ' || chr(10) || p_type")).alias("title"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM {orders}")
def li_date_parse(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".0")))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.numeric_date(text).alias("day"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM {orders}")
def echr_date_parse(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.when(k % 9 == 0, "soon").when(k % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")).when(k % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.any_date(text).alias("day"))


_LITERAL = "'[{''target_ecli'': ''' || o_orderpriority || ''', ''label'': ' || CASE WHEN o_orderkey % 2 = 0 THEN 'None' ELSE '''x''' END || '}, {''label'': ''y''}]'"


@query("SELECT o_orderkey, o_orderpriority || '; ' AS targets, CAST(2 AS INTEGER) AS n FROM {orders}")
def literal_citations(spark, sf_dir):
    found = S.citation_fields(F.expr(_LITERAL), "target_ecli")
    return table(spark, sf_dir, "orders").withColumn("c", found).select("o_orderkey", F.array_join("c", "; ").alias("targets"), F.size("c").alias("n"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{k: ' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS bare FROM {events}")
def json_props(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), S.unquote(F.to_json(F.struct(k.alias("k")))).alias("bare")).withColumn("bare", F.regexp_replace("bare", ":", ": "))


@query("SELECT c_custkey, array_to_string(list_sort(list_distinct(string_split(c_mktsegment || '; ' || c_name || '; ' || c_mktsegment, '; '))), '|') AS elements FROM {customer}")
def set_split(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(S.as_set(F.expr("c_mktsegment || '; ' || c_name || '; ' || c_mktsegment")), "|").alias("elements"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'A; B' WHEN 'MACHINERY' THEN 'C; C-Algemeen/Overig/Niet-gelabeld' END AS domains FROM {customer}")
def domain_dictionary(spark, sf_dir):
    text = F.concat(F.lit("['"), "c_mktsegment", F.lit("']"))
    return table(spark, sf_dir, "customer").select("c_custkey", S.expand_domains(text, {"BUILDING": ["A", "B"], "MACHINERY": ["C"]}).alias("domains"))


@query(f"SELECT ecli, 'http://x%20y/' || link AS iri FROM ({BASE})")
def iri_escape(spark, sf_dir):
    line = F.concat(F.lit("<http://x y/"), "link", F.lit("> a b"))
    return view(spark, sf_dir, BASE).select("ecli", F.regexp_extract(S.escape_iri(line), "<([^>]*)>", 1).alias("iri"))


@query(f"SELECT o_orderkey, 'RS_DEC_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS stamp, last_day(CAST(o_orderdate AS DATE)) AS month_end, {ECLI} AS ecli FROM {{orders}}")
def composite_key(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.keyed("RS", "DEC", day.cast("string")).alias("stamp"), S.month_end(day).alias("month_end"), F.expr(ECLI).alias("ecli"))
