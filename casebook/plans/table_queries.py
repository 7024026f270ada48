"""Queries over predicates, joins, sets, profiling, dedup and items."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.functions import scalars as S
from casebook.operators import items as I
from casebook.operators import profile as P
from casebook.operators import refresh as R
from casebook.operators import tables as T
from casebook.plans.registry import query
from casebook.plans.roles import BASE, CASES, ECLI, RAW, table, view
from casebook.plans.scalar_queries import _NORMAL, normal
from casebook.sources.readers import strings

_EU = """SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'ECLI:EU:T:1' ELSE 'ECLI:EU:C:' || CAST(o_orderkey AS STRING) END AS "ECLI",
  CASE WHEN o_orderkey % 5 = 0 THEN '8' ELSE '6' END || CAST(o_orderkey AS STRING) AS "CELEX IDENTIFIER",
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Judgment; x' WHEN 2 THEN 'Order' ELSE 'Opinion of the Advocate General' END AS "WORK HAS RESOURCE TYPE",
  'v' AS "WORK VERSION", o_orderstatus AS "SECTOR IDENTIFIER" FROM {orders}"""


@query(f"""SELECT "ECLI" AS ecli, "CELEX IDENTIFIER" AS celex, coalesce("WORK HAS RESOURCE TYPE", 'Unknown') AS type, "SECTOR IDENTIFIER" AS sector FROM ({_EU})
  WHERE "ECLI" LIKE '%ECLI:EU:C%' AND "CELEX IDENTIFIER" LIKE '6%' AND regexp_matches(coalesce("WORK HAS RESOURCE TYPE", 'Unknown'), 'Unknown|Opinion of the Advocate General|Judgment')""")
def eu_case_filter(spark, sf_dir):
    return T.prune_eu(view(spark, sf_dir, _EU)).toDF("ecli", "celex", "type", "sector")


@query("SELECT c_custkey, c_name FROM {customer}")
def keep_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_nationkey", "c_acctbal", "c_mktsegment", "no such column")


@query(f"SELECT ecli, CASE WHEN full_text IS NOT NULL THEN link END AS link FROM ({BASE})")
def null_link_on_missing_text(spark, sf_dir):
    return T.unless_missing(view(spark, sf_dir, BASE), "link", "full_text").select("ecli", "link")


@query(f"SELECT ecli, full_text FROM ({BASE}) WHERE full_text IS NOT NULL ORDER BY ecli LIMIT 100")
def not_none_rows(spark, sf_dir):
    return T.not_none(view(spark, sf_dir, BASE).select("ecli", "full_text"), ["full_text"], 100, ["ecli"])


@query(f"SELECT k, a, b FROM (SELECT k, CASE WHEN k % 2 = 0 THEN '<NA>' ELSE ecli END AS a, CASE WHEN k % 3 = 0 THEN NULL ELSE title END AS b FROM ({RAW})) WHERE a IS NOT NULL AND a <> '<NA>' AND b IS NOT NULL AND b <> '<NA>'")
def na_reject(spark, sf_dir):
    t = view(spark, sf_dir, f"SELECT k, CASE WHEN k % 2 = 0 THEN '<NA>' ELSE ecli END AS a, CASE WHEN k % 3 = 0 THEN NULL ELSE title END AS b FROM ({RAW})")
    return T.not_na(t, ["a", "b"])


@query(f"SELECT ecli, link FROM ({BASE}) WHERE TRY_CAST(string_split(ecli, ':')[4] AS INTEGER) >= 1998")
def year_floor(spark, sf_dir):
    return T.from_year(view(spark, sf_dir, BASE), "ecli", 1998).select("ecli", "link")


@query("SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT'")
def isin_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "P") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_orderstatus")


@query(f'SELECT r.ecli, r.title, r.summary AS summary_x, b.summary AS summary_y, b.link FROM ({RAW}) r JOIN ({BASE}) b ON r.ecli = b.ecli')
def metadata_inner(spark, sf_dir):
    out = T.merge(view(spark, sf_dir, RAW).select("ecli", "title", "summary"), view(spark, sf_dir, BASE).drop("full_text"), "ecli")
    return out.select("ecli", "title", "summary_x", "summary_y", "link")


@query(f"SELECT r.k, r.ecli FROM ({RAW}) r WHERE r.ecli <> '' AND NOT EXISTS (SELECT 1 FROM ({BASE}) b WHERE b.ecli = r.ecli)")
def missing_anti(spark, sf_dir):
    return T.missing(view(spark, sf_dir, RAW).select("k", "ecli").where("ecli <> ''"), view(spark, sf_dir, BASE), "ecli")


@query(f'SELECT r.ecli AS "ECLI", r.k, b.link FROM ({RAW}) r JOIN ({BASE}) b ON r.ecli = b.ecli')
def map_cases(spark, sf_dir):
    a, b = view(spark, sf_dir, RAW).select(F.col("ecli").alias("ECLI"), "k"), view(spark, sf_dir, BASE).select(F.col("ecli").alias("ECLI"), "link")
    return T.map_cases(a, b)


@query("SELECT c_name AS name, CAST(c_custkey AS BIGINT) AS customer, CAST(NULL AS BIGINT) AS supplier FROM {customer} UNION ALL SELECT s_name, NULL, s_suppkey FROM {supplier}")
def union_all_by_name(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("customer")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name"))
    return T.union_all(c, s)


@query("SELECT DISTINCT line FROM (SELECT CAST(l_orderkey AS VARCHAR) || chr(9) || CAST(l_partkey AS VARCHAR) AS line FROM {lineitem} WHERE l_linenumber <= 3 UNION ALL SELECT CAST(l_orderkey AS VARCHAR) || chr(9) || CAST(l_partkey AS VARCHAR) FROM {lineitem} WHERE l_linenumber >= 2)")
def edges_union_distinct(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").withColumn("line", F.concat_ws("\t", "l_orderkey", "l_partkey"))
    return T.union_distinct(t.where("l_linenumber <= 3").select("line"), t.where("l_linenumber >= 2").select("line"))


@query("SELECT 'left' AS side, value FROM (SELECT CAST(c_custkey AS BIGINT) AS value FROM {customer} EXCEPT SELECT s_suppkey FROM {supplier}) UNION ALL SELECT 'right', value FROM (SELECT s_suppkey AS value FROM {supplier} EXCEPT SELECT c_custkey FROM {customer})")
def value_set_difference(spark, sf_dir):
    return P.differences(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "supplier").select("s_suppkey"))


@query("SELECT c_nationkey AS value FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}")
def value_intersection(spark, sf_dir):
    return P.intersection(table(spark, sf_dir, "customer").select("c_nationkey"), table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("SELECT p_brand AS value, count(*) AS n FROM {part} WHERE p_brand IS NOT NULL GROUP BY p_brand")
def value_counts(spark, sf_dir):
    return P.value_counts(table(spark, sf_dir, "part"), "p_brand")


@query(f"SELECT DISTINCT coalesce(trim(full_text), '') AS value FROM ({BASE})")
def unique_values(spark, sf_dir):
    return P.unique_values(view(spark, sf_dir, BASE), "full_text")


@query(f"SELECT DISTINCT unnest(string_split(subject, '; ')) AS value FROM ({RAW})")
def unique_list_elements(spark, sf_dir):
    return P.unique_elements(view(spark, sf_dir, RAW), "subject")


_DESCRIBE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", arg_min(v, (-n, v)) AS top, max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM {{part}} WHERE {c} IS NOT NULL GROUP BY {c})"
    for c in ("p_brand", "p_type", "p_name")
)


@query(_DESCRIBE)
def describe_strings(spark, sf_dir):
    return P.describe_strings(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"])


@query("SELECT coalesce(l_discount <= l_tax, false) AS holds, count(*) AS n FROM {lineitem} GROUP BY 1")
def compare_columns(spark, sf_dir):
    return P.compare(table(spark, sf_dir, "lineitem"), "l_discount", "l_tax", "<=")


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM {lineitem} WHERE NOT l_discount <= l_tax ORDER BY l_orderkey, l_linenumber LIMIT 5")
def compare_counter_examples(spark, sf_dir):
    return P.counter_examples(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), "l_discount", "l_tax", "<=", 5, ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM {lineitem}) WHERE rn = 1")
def first_wins_dedup(spark, sf_dir):
    return T.first_wins(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_linenumber", "l_partkey"])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {orders}) WHERE rn = 1")
def last_wins_dedup(spark, sf_dir):
    return T.last_wins(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS numbers FROM {orders} GROUP BY o_custkey")
def string_agg_numbers(spark, sf_dir):
    t = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.col("o_orderkey").cast("string"))).alias("a"))
    return t.select("o_custkey", S.none_if_empty(F.array_join("a", ",")).alias("numbers"))


@query("SELECT l_orderkey, CASE WHEN count(*) = 1 THEN min(l_partkey) END AS only_part FROM {lineitem} GROUP BY l_orderkey")
def exactly_one(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.when(F.count(F.lit(1)) == 1, F.min("l_partkey")).alias("only_part"))


@query(f"SELECT count(*) AS cases, count(*) FILTER (WHERE ecli = '') AS errors, count(*) FILTER (WHERE summary <> '') AS summaries FROM ({RAW})")
def load_counters(spark, sf_dir):
    return P.counters(view(spark, sf_dir, RAW), cases=F.lit(True), errors=F.col("ecli") == "", summaries=F.col("summary") != "")


@query("SELECT event_type AS label, count(*) AS runs, CAST(sum(event_id) AS DOUBLE) / count(*) AS average, CAST(sum(event_id) AS BIGINT) AS total FROM {events} GROUP BY event_type")
def timing_stats(spark, sf_dir):
    return P.timings(table(spark, sf_dir, "events"), "event_type", "event_id")


@query("SELECT n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey")
def dictionary_lookup(spark, sf_dir):
    return table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS at FROM {orders} ORDER BY CAST(o_orderdate AS DATE), o_orderkey LIMIT 50 OFFSET 100")
def offset_page(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("at"))
    return t.orderBy("at", "o_orderkey").offset(100).limit(50)


@query("SELECT o_custkey AS id, unnest([o_orderstatus, o_orderpriority]) AS tag, o_orderkey FROM {orders}")
def explode_lists(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.array("o_orderstatus", "o_orderpriority").alias("tag"), "o_orderkey")
    return T.expand_columns(t, ["tag"])


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM {orders}")
def flatten_nested(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.struct("o_custkey", F.struct("o_orderstatus").alias("inner")).alias("data"))
    return T.flatten(t)


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id FROM {orders}")
def surrogate_ids(spark, sf_dir):
    return T.dense_ids(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


_MONTHS = f'SELECT x."ItemType", substr(date_decision, 1, 7) AS month FROM ({_NORMAL}) c, LATERAL (SELECT unnest(list_distinct(string_split(c.domains, \'; \'))) AS d) t, LATERAL (SELECT \'DOM_\' || t.d AS "ItemType") x'


def _items(spark, sf_dir):
    return I.fan_out(normal(spark, sf_dir).withColumn("seq", F.col("case_number").cast("long")))


@query(f'SELECT "ItemType", month, count(*) AS n FROM ({_MONTHS} UNION ALL SELECT \'DATA\', substr(date_decision, 1, 7) FROM ({_NORMAL})) GROUP BY ALL')
def domain_fan_out(spark, sf_dir):
    t = _items(spark, sf_dir).select("ItemType", F.split_part("SourceDocDate", F.lit("_"), F.lit(3)).substr(1, 7).alias("month"))
    return t.groupBy("ItemType", "month").agg(F.count(F.lit(1)).alias("n"))


_ITEMS = """SELECT 'C' || CAST(o_custkey AS STRING) AS "ECLI", o_orderkey AS seq, CAST(CAST(o_orderdate AS DATE) AS STRING) AS date_decision, o_orderpriority AS domains, o_orderstatus || '; ' || o_orderpriority AS referenced_legislation_titles, CAST(o_totalprice AS STRING) AS title FROM {orders}"""


@query(f"""WITH t AS ({_ITEMS}), r AS (SELECT *, row_number() OVER (PARTITION BY "ECLI" ORDER BY seq DESC) AS rn FROM t), d AS (SELECT *, row_number() OVER (PARTITION BY "ECLI", domains ORDER BY seq DESC) AS rn FROM t)
  SELECT "ECLI" AS pk, 'DATA' AS "ItemType", 'RS_DEC_' || date_decision AS "SourceDocDate", title AS value, array_to_string(list_sort(string_split(referenced_legislation_titles, '; ')), '; ') AS refs, domains AS doms FROM r WHERE rn = 1
  UNION ALL SELECT "ECLI", 'DOM_' || domains, 'RS_DEC_' || date_decision, domains, NULL, NULL FROM d WHERE rn = 1""")
def items_upsert(spark, sf_dir):
    all_items = I.fan_out(view(spark, sf_dir, _ITEMS)).crossJoin(F.broadcast(table(spark, sf_dir, "orders").agg(F.avg("o_orderkey").alias("middle"))))
    earlier, later = (all_items.where(c).drop("middle") for c in ("seq <= middle", "seq > middle"))
    out = I.upsert(I.upsert(None, earlier), later)
    get = lambda c, k: F.try_element_at(c, F.lit(k))
    return out.select("pk", "ItemType", "SourceDocDate", F.coalesce(get("attrs", "domain"), get("attrs", "title")).alias("value"), F.array_join(get("sets", "referenced_legislation_titles"), "; ").alias("refs"), F.array_join(get("sets", "domains"), "; ").alias("doms"))


@query("SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '; ') AS members FROM {orders} GROUP BY o_custkey")
def set_union_accumulate(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_custkey", F.array("o_orderpriority").alias("s"))
    return I.accumulate(t, ["o_custkey"], "s").select("o_custkey", F.array_join("s", "; ").alias("members"))


@query("""SELECT 'C' || CAST(o_custkey AS VARCHAR) AS pk, 'RS_DEC_' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "SourceDocDate", CAST(o_orderkey AS BIGINT) AS seq FROM {orders} WHERE o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def gsi_range_lookup(spark, sf_dir):
    out = I.index_range(I.fan_out(view(spark, sf_dir, _ITEMS)), "DOM_1-URGENT", "RS_DEC_1996-01", "RS_DEC_1996-12")
    return out.select("pk", "SourceDocDate", "seq")


@query(f"""SELECT ecli, summary FROM ({CASES}) WHERE ecli IN ('ECLI:NL:F:1996:1', 'ECLI:NL:F:1997:1')""")
def point_lookup(spark, sf_dir):
    return view(spark, sf_dir, CASES).where(F.col("ecli").isin("ECLI:NL:F:1996:1", "ECLI:NL:F:1997:1")).select("ecli", "summary")


@query(f"SELECT count(*) AS n, CAST(count(DISTINCT {ECLI}) AS BIGINT) AS keys FROM {{orders}}")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.expr(ECLI)).alias("keys"))


@query("SELECT CAST(doc_id AS VARCHAR) AS item_id, lang, md5(text) AS digest FROM {documents} WHERE NOT starts_with(CAST(doc_id AS VARCHAR), '8')")
def fulltext_documents(spark, sf_dir):
    t = table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("item_id"), "lang", "text")).alias("j"))
    d = t.select(F.from_json("j", strings(["item_id", "lang", "text"])).alias("d")).select("d.*")
    return d.where(~F.col("item_id").startswith("8")).select("item_id", "lang", F.md5(F.col("text").cast("binary")).alias("digest"))


_LISTS = {
    "citations_incoming": "'[{''target_ecli'': ''' || link || '''}, {''target_ecli'': ''a''}, {''x'': ''y''}]'",
    "citations_outgoing": "'[]'",
    "legislations_cited": "'[{''legal_provision'': ''' || coalesce(full_text, '') || '''}]'",
}


@query(f"""SELECT r.ecli, CASE WHEN b.full_text IS NOT NULL THEN b.link END AS link, 'a; ' || b.link AS incoming, '' AS outgoing, coalesce(b.full_text, '') AS provisions
  FROM ({RAW}) r JOIN ({BASE}) b ON r.ecli = b.ecli""")
def refresh_citations(spark, sf_dir):
    base = view(spark, sf_dir, BASE).withColumnRenamed("ecli", "id")
    cases = R.base_metadata(view(spark, sf_dir, RAW).select("ecli", "title", "summary"), base)
    cited = view(spark, sf_dir, BASE).select("ecli", *[F.expr(e).alias(c) for c, e in _LISTS.items()])
    out = R.citation_sets(R.enrich(cases, cited))
    return out.select("ecli", "link", *[F.array_join(c, "; ").alias(n) for c, n in (("citations_incoming", "incoming"), ("citations_outgoing", "outgoing"), ("legislations_cited", "provisions"))])
