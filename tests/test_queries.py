"""Every registered query of the engine's own operators against its SQL twin, and the clustering fold against a plain one."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import aggregate as A
from tidemark.operators import dedup as D
from tidemark.plans import ORACLE_SQL, QUERIES
from tidemark.session import TABLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(rows) -> list[tuple]:
    def one(v):
        if v is None:
            return ""
        if isinstance(v, float):
            return f"{v:.9g}"
        return str(list(v)) if isinstance(v, list | tuple) else str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(columns).collect()
    if name not in ORACLE_SQL:
        assert got
    else:
        assert plain(got) == plain(duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall())


def decision(a: dict, b: dict, r: D.MergeRules) -> tuple[str, str]:
    days = abs((a["day"] - b["day"]).days) if a["day"] and b["day"] else None
    if a["source"] == b["source"] and a["native"] and b["native"]:
        return ("MERGE", "SOURCE_ITEM_ID") if a["native"] == b["native"] else ("KEEP_SEPARATE", "CONFLICTING_SOURCE_ITEM_ID")
    if days and (a if a["day"] > b["day"] else b)["recurs"]:
        return "KEEP_SEPARATE", "RECURRENCE_MARKER"
    if not a["key"] or a["key"] != b["key"]:
        return "NO_DECISION", "NO_DECISION"
    if a["event"] and b["event"] and a["event"] != b["event"]:
        return "KEEP_SEPARATE", "CONFLICTING_EVENT_DATE"
    if days is None:
        return "NO_DECISION", "NO_DECISION"
    if a["event"] and a["event"] == b["event"] and a["source"] != b["source"]:
        return "MERGE", "EVENT_DATE"
    if days <= r.near_days:
        return "MERGE", "CANONICAL_NAME"
    pair = {a["source"]: a, b["source"]: b}
    if set(pair) == {r.claim_source, r.report_source} and a["threat"] == b["threat"] == r.claimed:
        if (pair[r.report_source]["day"] - pair[r.claim_source]["day"]).days == r.report_days:
            return "MERGE", "CLAIM_REPORTED"
    if days <= r.gap_days and a["source"] == b["source"] and a["source"] in r.url_sources and a["url"] and a["url"] == b["url"]:
        return "MERGE", "UNIQUE_URL"
    return "KEEP_SEPARATE", "TIME_GAP"


def clusters(rows: list[dict], r: D.MergeRules) -> dict[str, str]:
    out, held = {}, {}
    for x in sorted(rows, key=lambda v: (v["key"], v["best"], v["source"], v["url"], v["id"])):
        if not x["key"]:
            continue
        now = held.setdefault(x["key"], [])
        vetoed = any(decision(m, x, r)[1] in D.VETOES for m in now)
        first = [m["day"] for m in now if m["day"]]
        extends = bool(first and x["day"]) and (x["day"] - min(first)).days <= r.gap_days and any(
            m["day"] and m["source"] != x["source"] and abs((x["day"] - m["day"]).days) <= 1 and decision(m, x, r)[0] == "MERGE" for m in now
        )
        if now and not vetoed and (decision(now[0], x, r)[0] == "MERGE" or extends):
            now.append(x)
        else:
            held[x["key"]] = now = [x]
        out[x["id"]] = now[0]["id"]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_a_plain_fold(spark, seed):
    rng = random.Random(seed)
    rules = D.MergeRules(url_sources=("b",), claim_source="a", report_source="c")
    rows = []
    for i in range(250):
        day = (dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(90))).isoformat() if rng.random() < 0.97 else ""
        event = day if rng.random() < 0.3 else ""
        rows.append(
            {
                "key": rng.choice(["k1", "k2", "k3", "k4", ""]), "id": f"i{i:04}", "source": rng.choice("abc"), "published": day, "event": event,
                "native": rng.choice(["", "", "", f"n{i // 40}"]), "url": rng.choice(["", "u1", "u2"]), "threat": rng.choice(["Ransomware", "x"]),
                "recurs": rng.random() < 0.05,
            }
        )
    df = spark.createDataFrame(rows)
    got = {r.id: r.component for r in D.components(D.observations(df, **{c: F.col(c) for c in df.columns}), rules).collect()}
    for x in rows:
        x["best"] = x["event"] or x["published"]
        x["day"] = dt.date.fromisoformat(x["best"]) if x["best"] else None
    assert got == clusters(rows, rules)


def test_no_chaining_over_the_gap(spark):
    days = ["2026-01-01", "2026-01-03", "2026-01-05", "2026-01-15", "2026-01-29"]
    df = spark.createDataFrame([(d, f"i{k}") for k, d in enumerate(days)], "published string, id string")
    rows = D.observations(df, key=F.lit("k"), id=F.col("id"), source=F.lit("s"), published=F.col("published"))
    assert {r.id: r.component for r in D.components(rows).collect()} == {"i0": "i0", "i1": "i0", "i2": "i2", "i3": "i3", "i4": "i4"}


def test_one_item_id_merges_over_any_gap(spark):
    days = ["2026-01-01", "2026-03-01", "", ""]
    df = spark.createDataFrame([(d, f"i{k}", "n1" if d else "") for k, d in enumerate(days)], "published string, id string, native string")
    rows = D.observations(df, key=F.lit("k"), **{c: F.col(c) for c in ("id", "published", "native")})
    assert {r.id: r.component for r in D.components(rows).collect()} == {"i0": "i0", "i1": "i0", "i2": "i2", "i3": "i3"}


def test_a_large_key_is_not_gathered(spark):
    day = F.date_add(F.lit("2026-01-01").cast("date"), F.floor(F.col("n") / 500).cast("int")).cast("string")
    source, url = F.when(F.col("n") % 3 == 0, "b").otherwise("a"), F.concat(F.lit("u"), "n")
    df = spark.range(60000).select(F.format_string("i%06d", "id").alias("id"), F.col("id").alias("n"))
    rows = D.observations(df, key=F.lit("k"), id=F.col("id"), source=source, published=day, url=url)
    out = D.components(rows)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    got = {r.id: r.component for r in out.collect()}
    # One row a day and source decides for its like; they stand as the large key does.
    few = rows.groupBy("key", "source", "best", "published", "event", "native", "threat", "recurs").agg(F.min_by("id", "url").alias("id"), F.min("url").alias("url"))
    few = [r.asDict() | {"day": dt.date.fromisoformat(r.best)} for r in few.collect()]
    wanted = clusters(few, D.MergeRules())
    by = {(x["source"], x["best"]): wanted[x["id"]] for x in few}
    assert got == {r.id: by[r.source, r.best] for r in rows.select("id", "source", "best").collect()}


def test_plain_decisions_equal_the_columns(spark):
    rng = random.Random(7)
    rules = D.MergeRules(url_sources=("b",), claim_source="a", report_source="c")
    made = []
    for k in range(3000):
        for side in "ab":
            day = (dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(20))).isoformat() if rng.random() < 0.9 else ""
            made.append((k, side, rng.choice("abc"), rng.choice(["", "", "n1", "n2"]), day if rng.random() < 0.4 else "", day, rng.choice(["", "u1"]), rng.choice(["Ransomware", "x"]), rng.random() < 0.1))
    df = spark.createDataFrame(made, "k int, id string, source string, native string, event string, published string, url string, threat string, recurs boolean")
    fields = {c: F.col(c) for c in df.columns if c != "k"}
    rows = D.observations(df.withColumn("id", F.concat_ws("-", "k", "id")), key=F.lit("k"), **fields).withColumn("k", F.substring_index("id", "-", 1))
    whole = F.struct(*[c for c in rows.columns if c not in ("k", "id")])
    pairs = rows.groupBy("k").agg(F.min_by(whole, "id").alias("a"), F.max_by(whole, "id").alias("b"))
    for r in pairs.select("a", "b", D.decide(F.col("a"), F.col("b"), rules).alias("d")).collect():
        a, b = (D.Member(x.source, x.native, x.event, x.url, x.day and x.day.toordinal(), x.threat == rules.claimed, x.recurs) for x in (r.a, r.b))
        assert D.decided(a, b, rules) == tuple(r.d)


def test_every_recurrence_marker_is_found(spark, tmp_path):
    texts = [*(f"Vu : {m.upper()} !" for m in D.RECURRENCE_MARKERS), "une attaque", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.again for r in QUERIES["F12_recurrence_markers"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == dict(con.execute(ORACLE_SQL["F12_recurrence_markers"]).fetchall())
    assert [got[k] for k in range(len(texts))] == [True] * len(D.RECURRENCE_MARKERS) + [False] * 3


@pytest.mark.parametrize("name", ["T15_public_link", "O07_queue_order"])
def test_no_group_or_task_holds_all(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SinglePartition" not in plan


def test_numbers_run_over_ranges(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 13).alias("n"))
    got = {r.id: r.at for r in A.numbered(df, [F.desc("n"), F.col("id")], "at").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(range(5000), key=lambda k: (-(k * 7919 % 13), k)))}
    assert A.numbered(df.limit(0), [F.col("id")], "at").count() == 0


def test_redirects_follow_to_the_end_and_leave_loops(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "y"), ("y", "x")]
    got = {r.id: r.target for r in D.flatten_redirects(spark.createDataFrame(links, "id string, target string"), max_rounds=6).collect()}
    assert {k: got[k] for k in "abcd"} == dict.fromkeys("abcd", "e")
    assert not {"x", "y"} & set(got)


def test_searchable_and_keys(spark):
    row = spark.sql("SELECT 'Éco-le  À BÂle, n°5' AS t").select(X.searchable(F.col("t")).alias("s"), X.contains_words(X.searchable(F.col("t")), "a bale").alias("c")).first()
    assert row.s == "eco le a bale n 5" and row.c


def test_territories_with_two_keys_are_an_error(spark):
    from tidemark.operators import policies as X

    rows = spark.createDataFrame([("CD33",), (None,)], "name string")
    fine = spark.createDataFrame([("departement", "33", "a"), ("departement", "33", "a")], "kind string, value string, key string")
    assert sorted(plain(X.territorial_keys(rows, "name", fine, "k").collect())) == [("", ""), ("CD33", "a")]
    clash = fine.union(spark.createDataFrame([("departement", "33", "b")], fine.schema))
    with pytest.raises(Exception, match="two keys for departement 33"):
        X.territorial_keys(rows, "name", clash, "k").collect()


def test_next_run_ids_fill_gaps(spark):
    from tidemark.operators import policies as X

    log = spark.createDataFrame([("R",), ("R-2",), ("R-4",), ("S-2",), ("T-1",), ("T",), ("U-02",)], "run string")
    wanted = spark.createDataFrame([("R",), ("S",), ("T",), ("U",)], "base string")
    assert {r.base: r.run_id for r in X.next_run_ids(wanted, log, "base", "run").collect()} == {"R": "R-3", "S": "S", "T": "T-2", "U": "U"}
