"""Semantics that need care: order, keys, levels, replay."""

import pytest
from casebook.functions import fixed
from casebook.operators import items as I
from casebook.operators import linked as L
from casebook.operators import network as N
from casebook.operators import normalize as Z
from casebook.operators import profile as P
from casebook.operators import tables as T
from pyspark.sql import functions as F


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_normalize_last_non_empty_wins(spark):
    df = spark.createDataFrame([("E1", "A", "B"), ("E2", "A", ""), ("", "A", "B"), (None, "A", "B")], "ecli string, inhoudsindicatie string, summary string")
    out = Z.normalize(df, Z.DUTCH)
    assert rows(out.select("ECLI", "summary")) == [("E1", "B"), ("E2", "A")]
    assert len(out.columns) == 24 and "domains" in out.columns


def test_other_sources(spark):
    eu = spark.createDataFrame([("ECLI:EU:C:1", "6_X;6", "2019-01-01")], "`ECLI` string, `CELEX IDENTIFIER` string, `YEAR OF THE LEGAL RESOURCE` string")
    assert Z.normalize(eu, Z.EU).select("celex", "judgement_year").first() == ("6", "2019")
    rights = spark.createDataFrame([("E", "3/4/2020 12:00:00 AM", "8;13")], "ecli string, judgementdate string, article string")
    assert Z.normalize(rights, Z.SOURCES["ECHR"]).select("date_decision", "domains").first() == ("2020-03-04", "8;13")


def test_error_budget(spark):
    df = spark.range(10)
    assert Z.within_budget(df, {"small": F.col("id") < 8}, 3).count() == 8
    with pytest.raises(ValueError):
        Z.within_budget(df, {"small": F.col("id") < 8}, 2)


def test_upsert_replaces_data_and_keeps_domains(spark):
    df = spark.createDataFrame([("E", 1, "2020-01-01", "a; b", "T1"), ("E", 2, "2020-02-01", "b", "T2"), ("F", 1, None, "", "T")], "ECLI string, seq long, date_decision string, domains string, title string")
    batch = I.fan_out(df)
    out = I.upsert(None, batch)
    got = {(r.pk, r.ItemType): r for r in out.collect()}
    assert set(got) == {("E", "DATA"), ("E", "DOM_a"), ("E", "DOM_b"), ("F", "DATA")}
    assert got["E", "DATA"].sets["domains"] == ["b"] and got["E", "DATA"].attrs["title"] == "T2"
    assert got["E", "DOM_a"].SourceDocDate == "RS_DEC_2020-01-01" and got["E", "DOM_b"].SourceDocDate == "RS_DEC_2020-02-01"
    again = I.upsert(out, batch)
    plain = lambda d: sorted(str(r.asDict(True)) for r in d.collect())
    assert plain(again) == plain(out)


def law_triples(spark):
    law, t = fixed.LAW_PREFIX, fixed.TERMS
    subjects = {"BWBR1/5/2000-01-01/2000-01-01": "jci1.3:x", "BWBR1/3/2000-01-01/2000-01-01": "jci1.3:x", "BWBR1/7/2000-01-01/2000-01-01": None, "BWBR2/1/2000-01-01/2000-01-01": None}
    data = []
    for s, j in subjects.items():
        data += [(law + s, fixed.RDF_TYPE, t + "Artikel"), (law + s, fixed.PREF_LABEL, "p"), (law + s, fixed.LABEL, "l"), (law + s, t + "heeftOnderdeelNummer", "1")]
        data += [(law + s, t + "heeftJuriconnect", j)] if j else []
    data += [(law + "BWBR2/1/2000-01-01/2000-01-01", t + "heeftOnderdeelNummer", "2")]
    case = fixed.CASE_PREFIX + "ECLI:NL:HR:2020:1"
    links = ["BWBR1/7/2000-01-01/2000-01-01", "BWBR1/7/x/y", "BWBR1/99/z", "BWBR1", "BWBR9/1"]
    data += [(case, t + "linkt", law + x) for x in links] + [(case, t + "linkt", fixed.CASE_PREFIX + "ECLI:NL:HR:2020:2"), (case, fixed.LABEL, "L"), (case, fixed.PREF_LABEL, "P"), (case, t + "heeftZaaknummer", "2"), (case, t + "heeftZaaknummer", "1")]
    data += [(case, t + "refereertAan", f"target=bwb|uri=jci|lido-id={law}BWBR1/3/q|opschrift=a=b")]
    return spark.createDataFrame(data, "s string, p string, o string")


def test_laws_cases_and_links(spark):
    t = law_triples(spark)
    law, case = L.laws(t), L.cases(t)
    assert rows(law.select("id", "lido_id", "title", "number")) == [
        (1, "BWBR1/3/2000-01-01/2000-01-01", "p", "1"), (2, "BWBR1/7/2000-01-01/2000-01-01", "p", "1"), (3, "BWBR2/1/2000-01-01/2000-01-01", "p", None)]
    assert rows(case.select("ecli_id", "title", "zaaknummer")) == [("ECLI:NL:HR:2020:1", "L", "1,2")]
    assert rows(L.case_laws(t, case, law).select("law_id", "source", "lido_id", "opschrift")) == [
        (1, "lido-linkt", "BWBR1", None), (1, "lido-linkt", "BWBR1", None), (1, "lido-ref", "BWBR1/3", "a=b"), (2, "lido-linkt", "BWBR1/7", None), (2, "lido-linkt", "BWBR1/7/2000-01-01/2000-01-01", None)]


def test_aliases_first_of_equal_but_for_case(spark):
    df = spark.createDataFrame([("B", ["BW", "bw", "", None, ".,; Wet  X", "y" * 3000]), ("C", ["bw"])], "bwb_id string, titles array<string>")
    assert rows(L.aliases(df).select("alias", "bwb_id")) == [("BW", "B"), ("Wet X", "B"), ("bw", "C")]


def test_ntriples(spark):
    lines = ["<s a> <p> <o b> .", '<s> <p> "x \\"y\\" <z>"@nl .', "# no", "", "_:b <p> <o> ."]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert rows(L.triples(df)) == sorted([("s", "p", 'x "y" <z>'), ("s%20a", "p", "o%20b")], key=str)


def test_network(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 4)], "source long, target long")
    seeds = spark.createDataFrame([(1,)], "id long")
    assert [x[0] for x in rows(N.expand(seeds, e, 0, 2))] == [1, 2, 3]
    assert [x[0] for x in rows(N.expand(seeds, e, 1, 0))] == [1, 3, 4]
    assert rows(N.induced(N.expand(seeds, e, 1, 1), e)) == [(1, 2), (2, 3), (3, 1), (4, 1)]
    ids = spark.range(1, 6)
    rank = dict(N.pagerank(ids, e, 30).collect())
    assert abs(sum(rank.values()) - 1) < 1e-9
    a, n = {k: 0.2 for k in range(1, 6)}, {1: [2], 2: [3], 3: [1], 4: [1], 5: [4]}
    for _ in range(30):
        a = {k: 0.03 + 0.85 * sum(a[s] / len(ts) for s, ts in n.items() if k in ts) for k in a}
    assert all(abs(rank[k] - a[k]) < 1e-9 for k in a)


def test_query_network(spark):
    cases = spark.createDataFrame([("a", "Hoge Raad", "lease of land"), ("b", "Rechtbank Limburg", "land"), ("c", "Hoge Raad", "tax")], "ecli string, instance string, summary string")
    cases = cases.withColumns({"date_decision": F.lit("2020-01-01").cast("date"), "source": F.lit("RS"), "document_type": F.lit("DEC")})
    e = spark.createDataFrame([("a", "b"), ("b", "c")], "source string, target string")
    with pytest.raises(ValueError):
        N.query_network(cases, e)
    nodes, edges, message = N.query_network(cases, e, keywords='lease "of land" -tax')
    assert [r.id for r in nodes.orderBy("id").collect()] == ["a", "b"] and rows(edges) == [("a_b", "a", "b")] and message == ""
    assert N.query_network(cases, e, instances=["RECHTBANKEN"], degrees_targets=1)[0].count() == 2
    assert N.query_network(cases, e, eclis="a c", degrees_targets=0, limit=1)[2] != ""


def test_tables(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, "x"), (None, 3, "y"), (None, 4, "z")], "a string, b int, c string")
    assert rows(T.first_wins(df, ["a"], ["b"], nulls_differ=True)) == sorted([(None, 3, "y"), (None, 4, "z"), ("k", 1, None)], key=str)
    assert rows(T.last_wins(df, ["a"], ["b"])) == sorted([(None, 4, "z"), ("k", 2, "x")], key=str)
    assert rows(T.dense_ids(df, "b", ranges=2).select("b", "id")) == [(k, k) for k in range(1, 5)]
    with pytest.raises(ValueError):
        T.map_cases(df.toDF("ECLI", "b", "c"), df.toDF("ECLI", "b", "d"))
    assert rows(P.compare(df.withColumn("d", F.lit(2)), "b", "d", "<=")) == [(False, 2), (True, 2)]
    assert rows(P.describe_strings(df, ["a", "c"])) == [("a", 2, 1, "k", 2), ("c", 3, 3, "x", 1)]
