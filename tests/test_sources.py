"""File sources and sinks: round trips, missing paths, feeds; streams of files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entities as E
from tidemark.operators import facts as X
from tidemark.sources import feeds, files
from tidemark.streaming.windows import counted, fresh_rows

RSS = """<rss><channel><item><title>A &amp; B</title><link>https://a.example/1</link><description>d</description>
<pubDate>Tue, 02 Jan 2024 10:00:00 +0100</pubDate></item><item><title>undated</title><link>https://a.example/2</link></item></channel></rss>"""
ATOM = """<feed><entry><title>C</title><link href="https://a.example/3"/><id>n3</id><updated>2024-01-05T08:00:00Z</updated></entry></feed>"""


def test_tables_round_trip(spark, tmp_path):
    schema = files.CATALOGUE["runs"]
    rows = [("1", "2024-01-01", 'say "x"', None, ""), ("2", "2024-01-02", "two\nlines, and é", "5", None)]
    root = str(tmp_path)
    assert files.load_table(spark, root, "runs").collect() == []
    df = spark.createDataFrame(rows, schema)
    files.save_table(df, root, "runs")
    assert sorted(map(tuple, files.load_table(spark, root, "runs").collect())) == sorted(rows)
    state = spark.createDataFrame(files.snapshot_state(spark, root, ("runs",)).collect())
    assert files.snapshot_faults(spark, root, state).collect() == []
    files.append_csv(spark.createDataFrame([("3", "", "", "", "")], schema), f"{root}/runs", schema)
    assert [r.fault for r in files.snapshot_faults(spark, root, state).collect()] == ["COUNT"]


def test_json_shapes(spark, tmp_path):
    schema = files.text_schema("a", "b")
    for i, shape in enumerate(([{"a": "1"}], {"incidents": [{"a": "2", "b": "x"}]}, {"records": []}, {"other": [1]})):
        (tmp_path / f"{i}.json").write_text(json.dumps(shape))
    assert sorted(r.a for r in files.read_json_records(spark, str(tmp_path), schema).collect()) == ["1", "2"]
    files.write_json(spark.createDataFrame([("x", "y")], "b string, a string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '{"a":"y","b":"x"}'


def test_catalogue(spark):
    specs = files.parse_catalogue('[{"id":"A","layer":"x"},{"id":"B","layer":"y","active":false},{"id":"C","layer":"y"}]')
    assert {r.id for r in files.active_sources(files.source_table(spark, specs), ["y"]).collect()} == {"C"}
    with pytest.raises(ValueError):
        files.parse_catalogue('[{"id":"A"},{"id":"A"}]')


def test_feeds(spark, tmp_path):
    (tmp_path / "rss.xml").write_text(RSS)
    (tmp_path / "atom.xml").write_text(ATOM)
    got = sorted((r.title, r.link, str(r.day), r.native_id) for r in feeds.read_feed(spark, str(tmp_path)).collect())
    assert got == [("A & B", "https://a.example/1", "2024-01-02", "https://a.example/1"), ("C", "https://a.example/3", "2024-01-05", "n3")]


def test_conflicting_alias_and_unlike_rows_are_errors(spark):
    items = spark.createDataFrame([("k",)], "base string")
    with pytest.raises(ValueError, match="several canonical"):
        E.organisation_key(items, spark.createDataFrame([("k", "a"), ("k", "b")], "alias string, canonical string"), "base")
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, c string, seen int")
    with pytest.raises(Exception, match="rows of one key differ"):
        X.collapsed(rows, "k", ["c"], "seen").collect()


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:10:00", "a"), (2, "2024-01-02 00:00:00", "b")], "id int, t string, k string").coalesce(1).write.json(str(source))
    stream = spark.readStream.schema("id int, t timestamp, k string").json(str(source))
    for name, df, mode in (("fresh", fresh_rows(stream, ["id"], "t"), "append"), ("counted", counted(stream, "t", ["k"], "1 day", "1 day"), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(60)
    assert sorted(r.id for r in spark.table("fresh").collect()) == [1, 2]
    assert {(r.k, r.n) for r in spark.table("counted").select("k", "n").collect()} == {("a", 2), ("b", 1)}


def test_set_hash_ignores_order(spark):
    a = spark.range(100).select(F.col("id"))
    assert X.set_hash(a, F.col("id")).first() == X.set_hash(a.orderBy(F.desc("id")), F.col("id")).first()


def test_absolute_urls(spark):
    base = "https://a.example/x/y/z.html?q=1#f"
    want = {
        "https://b.example/1": "https://b.example/1", "//b.example/1": "https://b.example/1", "/r?s=/../": "https://a.example/r?s=/../", "n": "https://a.example/x/y/n", "./n": "https://a.example/x/y/n",
        "../n#k": "https://a.example/x/n#k", "../../../n": "https://a.example/n", "?p=2": "https://a.example/x/y/z.html?p=2", "mailto:a@b": "mailto:a@b", "../": "https://a.example/x/",
    }
    df = spark.createDataFrame([(i, base, h) for i, h in enumerate(want)], "i int, base string, href string")
    assert [r.u for r in df.select("i", feeds.absolute_url(F.col("base"), F.col("href")).alias("u")).orderBy("i").collect()] == list(want.values())


def test_dated_links_by_distance(spark):
    def link(name, label="A label long enough"):
        return f'<a href="/{name}">{label} {name}</a>'

    cases = [
        (f"{link('a')} 2024-01-02 ........ {link('b')}", {("2024-01-02", "a")}),
        (f"{link('a')} ................ 2024-01-02 {link('b')}", {("2024-01-02", "b")}),
        (f"{link('a', '2024-01-03 a label with a day')} {link('b')}", {("2024-01-03", "a")}),
        (f"{link('a')} 2024-01-02 x 2024-01-03 {'.' * 99} {link('b')} 3 mars 2024", {("2024-01-02", "a"), ("2024-03-03", "b")}),
        (f"{link('a')}{'.' * 1600}2024-01-02{'.' * 1600}{link('b')}", set()),
        (f"{link('a')}{'é' * 1400}2024-01-02{'.' * 1350}{link('b')}", {("2024-01-02", "b")}),
        ("2024-01-02 <a href='javascript:x()'>A label long enough</a> <a href='#p'>A label long enough</a> <a href='/c'>short</a>", set()),
        (f"12024-01-02 2024-01-02-03 99/99/2024 1er mai 2024 June 9, 2024 {link('a')}", set()),
        ("", set()),
        (None, set()),
    ]
    df = spark.createDataFrame([(i, "https://z.example/p", h) for i, (h, _) in enumerate(cases)], "id int, url string, html string")
    got = {i: set() for i in range(len(cases))}
    for r in feeds.dated_links(df, "id", "url", "html").collect():
        got[r.id].add((str(r.day), r.url.removeprefix("https://z.example/")))
    assert list(got.values()) == [want for _, want in cases]
