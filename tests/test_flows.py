"""End-to-end flows and the oracle of a few queries."""

import duckdb
import pytest
from casebook.functions import fixed
from casebook.plans import flows
from casebook.plans.catalog import QUERIES, SQL
from casebook.sources import sinks


def test_load_slices(spark, tmp_path):
    root = str(tmp_path / "db")
    kind = "ecli string, subject string, date_decision string, title string, n long"
    a = spark.createDataFrame([("E1", "a; b", "2020-01-01", "first", 1), ("E1", "b; c", "2020-01-01", "second", 2), ("", "x", "2020-01-01", "no key", 3)], kind)
    e = spark.createDataFrame([("E1", "E2")], "source string, target string")
    flows.load_slice(spark, a, "RS", root, seq="n", edges=e)
    b = spark.createDataFrame([("E2", "a; d", "2020-02-01", "third", 4)], kind)
    flows.load_slice(spark, b, "RS", root, seq="n", edges=e)
    got = {(r.pk, r.ItemType): r for r in sinks.current(spark, root, "items").collect()}
    assert set(got) == {("E1", "DATA"), ("E1", "DOM_a"), ("E1", "DOM_b"), ("E1", "DOM_c"), ("E2", "DATA"), ("E2", "DOM_a"), ("E2", "DOM_d")}
    assert got["E1", "DATA"].attrs["title"] == "second" and got["E1", "DATA"].sets["domains"] == ["b", "c"]
    assert sinks.current(spark, root, "edges").count() == 1


def test_load_linked(spark, tmp_path):
    s = f"<{fixed.LAW_PREFIX}BWBR1/5/2000-01-01/2000-01-01>"
    lines = [f"{s} <{fixed.RDF_TYPE}> <{fixed.TERMS}Wet> .", f'{s} <{fixed.DC_TITLE}> "T"@nl .', f"<{fixed.CASE_PREFIX}ECLI:NL:HR:2020:1> <{fixed.TERMS}linkt> {s} ."]
    root = str(tmp_path / "db")
    titles = spark.createDataFrame([("BWBR1", ["T", "t"])], "bwb_id string, titles array<string>")
    flows.load_linked(spark.createDataFrame([(x,) for x in lines], "value string"), titles, root)
    assert [sinks.current(spark, root, t).count() for t in ("law_element", "legal_case", "case_law", "law_alias")] == [1, 1, 1, 1]


@pytest.mark.parametrize("name", ["normalize_cases", "refresh_citations", "items_upsert", "case_law_links", "network_expand_2hop", "describe_strings"])
def test_against_oracle(spark, sf, name):
    con = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    rel = con.sql(SQL[name])
    df = QUERIES[name](spark, sf)
    cols = sorted(rel.columns)
    assert sorted(df.columns) == cols
    want = sorted(map(str, rel.select(*[f'"{c}"' for c in cols]).fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want


def test_items_upsert_merges_into_a_filled_store(spark, sf, monkeypatch):
    from casebook.plans import table_queries as Q

    seen, upsert = [], Q.I.upsert
    monkeypatch.setattr(Q.I, "upsert", lambda store, batch: seen.append((store, batch)) or upsert(store, batch))
    Q.items_upsert(spark, sf)
    keys = lambda df: {tuple(r) for r in df.select("pk", "ItemType").collect()}
    old, new = map(keys, next(pair for pair in seen if pair[0] is not None))
    assert old - new and old & new and new - old


def test_every_query_is_named_in_the_oracle():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 75
