"""Worked cases of the cleaning functions."""

import pytest
from casebook.functions import fixed
from casebook.functions import scalars as S
from pyspark.sql import functions as F

NB, EM = " ", " "

CASES = [
    (S.xml_text, "a<b>bb</b>c", "a bb c"), (S.xml_text, "<p>", None), (S.xml_text, "-", None), (S.xml_text, "", None), (S.xml_text, "a & b", None), (S.xml_text, "x &amp; y", "x & y"),
    (S.xml_text, "plain", "plain"), (S.xml_text, None, None), (S.unify_list, "b, a, b", "a; b"), (S.unify_list_text, "['x', 'y']", "x; y"),
    (S.pick_celex, "62019CJ0100_SUM;62019CJ0100", "62019CJ0100"), (S.pick_celex, "62019CJ0100", "62019CJ0100"), (S.pick_celex, "a_b;c_d", None), (S.pick_celex, "a_b", "a_b"),
    (lambda c: S.numeric_date(c).cast("string"), "20200131.0", "2020-01-31"), (lambda c: S.numeric_date(c).cast("string"), "x", None),
    (lambda c: S.any_date(c).cast("string"), "03/04/2020 00:00:00", "2020-03-04"), (lambda c: S.any_date(c).cast("string"), "25/04/2020", "2020-04-25"), (lambda c: S.any_date(c).cast("string"), "soon", None),
    (S.label_domains, "Strafrecht", "Strafrecht; Strafrecht-Algemeen/Overig/Niet-gelabeld"), (S.label_domains, "Civiel recht; Arbeidsrecht", "Civiel recht; Arbeidsrecht"),
    (S.first_year, "2019-01-01", "2019"), (S.cascade, "Rechtbank Zwolle-Lelystad", "Rechtbank Overijssel-Midden-Nederland"),
    (lambda c: S.cascade(c, longest_first=True), "Rechtbank Zwolle-Lelystad", "Rechtbank Overijssel"), (S.cascade, "Gerechtshof Arnhem-Leeuwarden", "Gerechtshof Arnhem-Leeuwarden"),
    (S.cascade, "Haarlemmermeer", "Noord-Hollandmermeer"), (S.alternative_sources, "A  \n  B", "A; B"), (S.jurisdiction, "NL", "NL"), (S.jurisdiction, "Nederland", "NL"), (S.jurisdiction, "DE", None),
    (S.ecli_year, "ECLI:NL:HR:2023:1234", "2023"), (S.ecli_year, "ECLI:NL", None), (S.clean_title, ".,; Wet  op X", "Wet op X"), (S.clean_title, f".{NB}Wet{EM}op", "Wet op"),
    (S.law_path, fixed.LAW_PREFIX + "BWBR0001831/799354/1827-12-13/1827-12-13", "BWBR0001831/799354/1827-12-13/1827-12-13"), (S.law_path, fixed.LAW_PREFIX, None), (S.law_path, "http://x", None),
    (lambda c: S.segment(c, 1), "BWBR0001831/799354/1827", "799354"), (lambda c: S.segment(c, 1), "BWBR0001831", None), (S.strip, f"{NB} a b{EM}\n", "a b"),
    (lambda c: F.array_join(S.citation_fields(c, "target_ecli"), "|"), "[{'target_ecli': 'E1'}, {'x': 'y'}]", "E1|"), (lambda c: F.array_join(S.citation_fields(c, "a"), "|"), "[{'a': None}, {'a': \"it's\"}]", "|it's"),
    (lambda c: S.citation_fields(c, "a").cast("string"), "no list", None), (S.escape_iri, "<a b> <c> \"d e\"", "<a%20b> <c> \"d e\""), (lambda c: S.month_end(c.cast("date")).cast("string"), "2024-02-03", "2024-02-29"),
]


def test_values(spark):
    df = spark.createDataFrame([(i, v) for i, (_, v, _) in enumerate(CASES)], "i int, v string")
    row = {r.i: r for r in df.select("i", *[F.when(F.col("i") == k, f(F.col("v"))).alias(f"c{k}") for k, (f, _, _) in enumerate(CASES)]).collect()}
    for k, (_, v, want) in enumerate(CASES):
        assert row[k][f"c{k}"] == want, (k, v)


@pytest.mark.parametrize(("text", "want"), [("flag|a=b=c|a=2", {"flag": None, "a": "2"}), ("uri=jci1.3:c:B&z=1|opschrift=artikel 5:1 BW", {"uri": "jci1.3:c:B&z=1", "opschrift": "artikel 5:1 BW"})])
def test_reference_fields(spark, text, want):
    assert spark.range(1).select(S.reference_fields(F.lit(text)).alias("m")).first().m == want


def test_unify_is_idempotent_up_to_format(spark):
    df = spark.createDataFrame([("b, a, b",), ("x",)], "v string").select(S.unify_list(F.col("v")).alias("v"))
    assert df.select("v", S.unify_list(F.replace("v", F.lit("; "), F.lit(", "))).alias("w")).where("v <> w").isEmpty()


def test_names():
    assert S.clean_name("a/x.csv") == "a/x_clean.csv"
