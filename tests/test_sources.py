"""Readers, sinks, harvest, streams."""

import json
import zipfile

import pytest
from casebook.sources import harvest, readers, sinks
from casebook.streaming import slices
from pyspark.sql import functions as F


def pages(start, end, options):
    for k in range(int(start), int(end)):
        yield {"id": k, "x": None if k % 2 else f"v{k}"}


def days(start, end, options):
    yield {"id": start, "x": options["languages"]}


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ecli,text\nE1,"two\nlines, ""quoted"""\nE2,\n')
    df = readers.read_csv(spark, str(tmp_path / "a.csv"), ["ecli", "text"], fail_fast=True)
    assert [tuple(r) for r in df.orderBy("ecli").collect()] == [("E1", 'two\nlines, "quoted"'), ("E2", None)]
    assert readers.header(spark, str(tmp_path / "a.csv")) == ["ecli", "text"]
    sinks.write_csv(df, str(tmp_path / "out"))
    again = readers.read_csv(spark, str(tmp_path / "out"), ["ecli", "text"])
    assert again.exceptAll(df).isEmpty() and again.count() == 2
    sinks.write_csv(df, str(tmp_path / "out"), "append")
    assert readers.read_csv(spark, str(tmp_path / "out"), ["ecli", "text"]).count() == 4


def test_tree(spark, tmp_path):
    for y in (2019, 2020):
        (tmp_path / str(y)).mkdir()
        (tmp_path / str(y) / "base_x.csv").write_text(f"a\n{y}\n")
        (tmp_path / str(y) / "other.csv").write_text("a\n0\n")
    assert readers.read_tree(spark, str(tmp_path), "base_*.csv", ["a"]).count() == 2
    assert readers.read_tree(spark, str(tmp_path), "base_*.csv", ["a"], part="/2020/").first().a == "2020"


def test_documents_lists_and_objects(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"item_id": "1", "t": "x"}, {"celex": "8/2"}]))
    df = readers.read_documents(spark, str(tmp_path / "d.json"), ["item_id", "celex", "t"])
    sinks.write_objects(df, str(tmp_path / "o"))
    assert {p.name for p in (tmp_path / "o").iterdir() if p.is_dir()} == {"key=1", "key=8_2"}
    (tmp_path / "p.json").write_text(json.dumps([["B1", ["t1", "t2"]], ["B2", []]]))
    assert [tuple(r) for r in readers.read_pairs(spark, str(tmp_path / "p.json")).orderBy("bwb_id").collect()] == [("B1", ["t1", "t2"]), ("B2", [])]


def test_law_list_in_zip(spark, tmp_path):
    xml = """<a:Lijst xmlns:a="http://x"><a:RegelingInfoLijst><a:RegelingInfo><a:BWBId>B1</a:BWBId><a:OfficieleTitel>Off</a:OfficieleTitel>
    <a:CiteertitelLijst><a:Citeertitel><a:titel>C1</a:titel></a:Citeertitel><a:Citeertitel><a:titel>C2</a:titel></a:Citeertitel></a:CiteertitelLijst>
    <a:AfkortingLijst><a:Afkorting>BW</a:Afkorting></a:AfkortingLijst><a:NietOfficieleTitelLijst/></a:RegelingInfo></a:RegelingInfoLijst></a:Lijst>"""
    with zipfile.ZipFile(tmp_path / "l.zip", "w") as z:
        z.writestr("L.xml", xml)
    raw = readers.unzip(spark, str(tmp_path / "l.zip"), "L.xml").first().content
    (tmp_path / "L.xml").write_bytes(raw)
    assert tuple(readers.read_law_titles(spark, str(tmp_path / "L.xml")).first()) == ("B1", ["Off", "C1", "C2", "BW"])


def test_turtle(spark, tmp_path):
    (tmp_path / "t.ttl").write_text('@prefix d: <http://d/> .\n<http://s a> a d:T ; d:p "x; y"@nl , <http://o> .\nd:s2 d:q "z"^^<http://x> .\n')
    got = sorted(tuple(r) for r in readers.turtle(spark, str(tmp_path / "t.ttl")).collect())
    assert got == [("http://d/s2", "http://d/q", "z"), ("http://s%20a", "http://d/p", "http://o"), ("http://s%20a", "http://d/p", "x; y"), ("http://s%20a", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://d/T")]


def test_harvest(spark):
    spark.dataSource.register(harvest.Harvest)
    read = lambda **o: spark.read.format("harvest").schema("id string, x string").options(**o).load()
    df = read(fetch="tests.test_sources:pages", by="pages", total="12", page="5", count="11")
    assert df.rdd.getNumPartitions() == 3 and df.count() == 11 and df.where("x is null").count() == 5
    df = read(fetch="tests.test_sources:days", start_date="2023-01-30", end_date="2023-02-02", skip_dates="2023-01-31")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("2023-01-30", "ENG,FRE"), ("2023-02-01", "ENG,FRE"), ("2023-02-02", "ENG,FRE")]


def test_date_arguments():
    assert harvest.date_range(fresh=True, start="2000-01-01", today="2020-01-01") == ("1990-01-01", "2020-01-01")
    assert harvest.date_range(mark="2019-01-01", end="2019-02-01") == ("2019-01-01", "2019-02-01")
    assert harvest.back_fill(["2000-01-01", "2001-01-01"]) == [(None, "1999-12-31"), ("2000-01-01", "2000-12-31"), ("2001-01-01", None)]


def test_publish(spark, tmp_path):
    root = str(tmp_path / "db")
    a = spark.createDataFrame([("x", "y"), ("y", "z")], "source string, target string")
    sinks.merge_publish(a, root, "edges")
    sinks.merge_publish(spark.createDataFrame([("y", "z"), ("z", "x")], "source string, target string"), root, "edges")
    assert sorted(tuple(r) for r in sinks.current(spark, root, "edges").collect()) == [("x", "y"), ("y", "z"), ("z", "x")]
    with pytest.raises(ValueError):
        sinks.publish({"edges": a}, root, {"rule": a})
    assert sinks.current(spark, root, "edges").count() == 3
    sinks.write_lines(a, str(tmp_path / "lines"))
    assert readers.read_edges(spark, str(tmp_path / "lines")).exceptAll(a).isEmpty()
    with pytest.raises(FileExistsError):
        sinks.prepare(spark, [root])
    with pytest.raises(FileNotFoundError):
        sinks.prepare(spark, [], str(tmp_path / "none"))


def test_slices(spark, tmp_path):
    df = spark.createDataFrame([("a", "2023-01-15"), ("b", "2023-02-01")], "k string, day string")
    sinks.write_slices(df, str(tmp_path / "s"), "day")
    sinks.write_slices(df.where("k = 'b'").withColumn("k", F.lit("c")), str(tmp_path / "s"), "day")
    assert sorted(r.k for r in readers.read_slices(spark, str(tmp_path / "s")).collect()) == ["a", "c"]
    assert [r.k for r in readers.read_slices(spark, str(tmp_path / "s"), start="2023-02-01").collect()] == ["c"]
    got = slices.month_slices(spark.createDataFrame([("2023-01-15", "2023-03-10")], "a string, b string"), "a", "b")
    assert [tuple(map(str, r)) for r in got.select("first", "last").orderBy("first").collect()] == [("2023-01-15", "2023-01-31"), ("2023-02-01", "2023-02-28"), ("2023-03-01", "2023-03-10")]


def test_streams(spark, sf, tmp_path):
    path = f"{sf}/events.parquet"
    out = slices.monthly_events(spark, path, str(tmp_path / "c"), str(tmp_path / "o"))
    assert out.agg(F.sum("n")).first()[0] == spark.read.parquet(path).count()
    daily = slices.daily_windows(spark, path, str(tmp_path / "c2"), str(tmp_path / "o2"))
    assert 0 < daily.agg(F.sum("n")).first()[0] <= spark.read.parquet(path).count()
    assert slices.next_mark(spark.range(3), "id") == "2" and slices.since(spark.range(3), "id", "1").count() == 1
