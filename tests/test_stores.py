"""Relational store, objects by key, large archives, named sources, citation refresh."""

import json
import zipfile

import pytest
from casebook.functions import fixed
from casebook.plans import flows
from casebook.sources import harvest, readers, relational, sinks

TYPES = 'id bigint, name varchar(20), price decimal(10, 2)'


@pytest.fixture
def url(tmp_path):
    return f"jdbc:derby:{tmp_path}/store;create=true"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_insert_or_ignore(spark, url):
    kind = "id long, name string, price decimal(10,2)"
    one = spark.createDataFrame([(1, "a", None), (2, None, None)], kind)
    relational.insert_or_ignore(one, url, "things", TYPES, ["id"])
    relational.insert_or_ignore(spark.createDataFrame([(2, "late", None), (3, "c", None)], kind), url, "things", TYPES, ["id"])
    assert rows_of(relational.read(spark, url, "things").select("id", "name")) == [(1, "a"), (2, None), (3, "c")]
    assert not relational.create(spark, url, "things", TYPES) and not relational.has_table(spark, url, "things_staging")
    relational.truncate(spark, url, "things")
    assert relational.read(spark, url, "things").isEmpty()


def test_switch_is_one_transaction(spark, url):
    a = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    relational.replace_all({"x": (a, "id bigint"), "y": (a, "id bigint")}, url)
    assert rows_of(relational.read(spark, url, "x")) == [(1,), (2,)]
    with pytest.raises(Exception):
        relational.execute(spark, url, ["DELETE FROM x", "DELETE FROM nowhere"])
    assert relational.read(spark, url, "x").count() == 2


def test_linked_relations_reach_the_store(spark, tmp_path, url):
    s = f"<{fixed.LAW_PREFIX}BWBR1/5/2000-01-01/2000-01-01>"
    lines = [f"{s} <{fixed.RDF_TYPE}> <{fixed.TERMS}Wet> .", f'{s} <{fixed.DC_TITLE}> "T"@nl .', f"<{fixed.CASE_PREFIX}ECLI:NL:HR:2020:1> <{fixed.TERMS}linkt> {s} ."]
    root = str(tmp_path / "db")
    titles = spark.createDataFrame([("BWBR1", ["T", "t"])], "bwb_id string, titles array<string>")
    flows.load_linked(spark.createDataFrame([(x,) for x in lines], "value string"), titles, root)
    for _ in range(2):
        flows.export_linked(spark, root, url)
        assert [relational.read(spark, url, t).count() for t in flows.RELATIONS] == [1, 1, 1, 1]
    assert relational.read(spark, url, "law_element").first().title == "T"


def test_objects_by_key(spark, tmp_path):
    df = spark.createDataFrame([("a/b", None, "x"), (None, "a_b", "y"), (None, None, "z")], "item_id string, celex string, t string")
    for _ in range(2):
        assert sinks.put_objects(df, str(tmp_path / "o")) == 2
    assert {p.name for p in (tmp_path / "o").iterdir()} == {"a%2Fb.json", "a_b.json"}
    assert json.loads((tmp_path / "o" / "a_b.json").read_text())["t"] == "y"
    assert sinks.put_objects(df.limit(0), str(tmp_path / "none")) == 0
    assert sinks.remove(spark, [str(tmp_path / "o"), str(tmp_path / "gone")]) == [str(tmp_path / "o")]
    with pytest.raises(ValueError):
        sinks.require_rows(df.limit(0), "df")
    assert sinks.Layout("r").raw("echr", "x") == "r/raw/echr/x" and sinks.Layout("r").processed("echr") == "r/processed/echr"


def test_archives_in_pieces(spark, tmp_path):
    for k in (1, 2):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w") as z:
            z.writestr("in/L.xml", f"<a>{k}</a>" * 1000)
    got = readers.unzip_to(spark, str(tmp_path / "*.zip"), "in/L.xml", str(tmp_path / "out"), piece=64)
    assert [r.size for r in got.collect()] == [8000, 8000] and len(list((tmp_path / "out").iterdir())) == 2
    assert spark.read.text([r.path for r in got.collect()], wholetext=True).count() == 2


def test_named_source(spark, tmp_path):
    fetch = {"base": "tests.test_sources:days", "metadata": "tests.test_sources:days"}
    ask = lambda **o: harvest.extract(spark, "rechtspraak", fetch, dict.fromkeys(fetch, ["id", "x"]), str(tmp_path / "rs"), start_date="2023-01-01", end_date="2023-01-05", **o)
    got = ask(count=3)
    assert set(got) == {"base", "metadata"} and readers.read_csv(spark, got["base"], ["id", "x"]).count() == 3
    assert ask() == got and readers.read_csv(spark, got["base"], ["id", "x"]).count() == 3
    ask(skip_if_exists=False)
    assert readers.read_csv(spark, got["base"], ["id", "x"]).count() == 5
    pages = harvest.extract(spark, "echr", {"full_text": "tests.test_sources:pages", "edges": "tests.test_sources:pages"}, {"full_text": ["id", "x"], "edges": ["id", "x"]}, str(tmp_path / "e"), count=7, total="12", page="5")
    assert readers.read_documents(spark, pages["full_text"], ["id", "x"], lines=True).count() == 7 and readers.read_edges(spark, pages["edges"]).count() == 7


def test_citation_refresh(spark, tmp_path):
    root = str(tmp_path / "c")
    meta = spark.createDataFrame([("E1", "s"), ("E2", "s"), ("E3", "s"), ("E4", "s")], "ecli string, summary string")
    base = spark.createDataFrame([("E1", "l", "f", ""), ("E2", "l", None, ""), ("E3", "l", "f", "")], "id string, link string, full_text string, summary string")
    one = "[{'target_ecli': 'b'}, {'target_ecli': 'a'}, {'target_ecli': 'a'}]"
    cited = spark.createDataFrame([("E1", one, "[]", "[{'legal_provision': 'p'}]")], "ecli string, citations_incoming string, citations_outgoing string, legislations_cited string")
    flows.refresh_citations(spark, meta, base, cited, root)
    first = sinks.current(spark, root, "citations").collect()
    assert [(r.ecli, r.citations_incoming, r.legislations_cited) for r in first] == [("E1", ["a", "b"], ["p"])]
    assert rows_of(sinks.current(spark, root, "not_found")) == [("E4",)]
    more = spark.createDataFrame([("E1", "[]", "[]", "[]"), ("E2", one, "[]", "[]")], cited.schema)
    flows.refresh_citations(spark, meta, base, more, root)
    got = {r.ecli: r for r in sinks.current(spark, root, "citations").collect()}
    assert set(got) == {"E1", "E2"} and got["E1"].citations_incoming == ["a", "b"] and got["E2"].link is None
