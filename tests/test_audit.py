"""Audit pairs (J-13) against a brute force over all pairs, and a key of very many rows."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.test_queries import decision
from tidemark.operators import audit as A
from tidemark.operators import dedup as D

RULES = D.MergeRules(url_sources=("b",), claim_source="a", report_source="c")


def observed(df):
    return D.observations(df, **{c: F.col(c) for c in df.columns})


def plain(rows: list[dict], companies: dict[str, str], member: dict[str, str], days: int = 14) -> Counter:
    def reason(x: dict, y: dict) -> tuple[str, str] | None:
        if companies.get(x["key"]) and companies.get(x["key"]) == companies.get(y["key"]):
            return A.COMPANY, companies[x["key"]]
        if x["source"] == y["source"] or not x["key"] or not y["key"]:
            return None
        short, long = sorted((x["key"].split(), y["key"].split()), key=len)
        if len(short) < len(long) and any(long[i : i + len(short)] == short for i in range(len(long))):
            return A.CONTAINMENT, ""
        if len(short) < len(long) and "".join(short) == "".join(long):
            return A.CONCATENATION, ""
        return (A.PERMUTATION, "") if len(short) > 1 and sorted(short) == sorted(long) else None

    out: Counter = Counter()
    for i, x in enumerate(rows):
        for y in rows[i + 1 :]:
            if not x["day"] or not y["day"] or abs((x["day"] - y["day"]).days) > days:
                continue
            action, why = decision(x, y, RULES)
            first, second = sorted((x, y), key=lambda r: (r["best"], r["source"], member[r["id"]]))
            pair = (member[first["id"]], member[second["id"]], abs((x["day"] - y["day"]).days))
            if action == "NO_DECISION" and x["key"] != y["key"] and (told := reason(x, y)):
                out[(A.MISSED, told[0], *pair, told[1])] += 1
            elif action == "MERGE" and why in A.WEAK and not (x["source"] == y["source"] and x["url"] and x["url"] == y["url"]):
                out[(A.FALSE, why, *pair, "")] += 1
    return out


@pytest.mark.parametrize("seed, n, span", [(0, 600, 60), (1, 2000, 400)])
def test_pairs_equal_a_brute_force(spark, seed, n, span):
    rng = random.Random(seed)
    names = ["ville lyon", "lyon ville", "villelyon", "lyon", "ville lyon nord", "acme", "ac me", "beta", "gamma delta epsilon", "delta", ""]
    rows = []
    for i in range(n):
        day = (dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(span))).isoformat() if rng.random() < 0.97 else ""
        event = rng.random() < 0.3
        rows.append({
            "key": rng.choice(names), "id": f"i{i:05}", "source": rng.choice("abc"), "native": rng.choice(["", "", "n1", f"n{i}"]), "event": day if event else "",
            "published": "" if event else day, "url": rng.choice(["", "u1", "u2", f"u{i}"]), "threat": rng.choice(["Ransomware", ""]), "recurs": rng.random() < 0.05,
        })
    companies = {"acme": "1", "beta": "1", "lyon": "2", "ville lyon": "2"}
    df = observed(spark.createDataFrame(rows))
    member = {r.id: r.audit_class for r in A.audit_members(df).collect()}
    for r in rows:
        r["best"] = r["event"] or r["published"]
        r["day"] = dt.date.fromisoformat(r["best"]) if r["best"] else None
    held = spark.createDataFrame([*companies.items(), ("delta", "")], "key string, company string")
    got = {(r.risk, r.reason, r.left_id, r.right_id, r.days_apart, r.company): r.pairs for r in A.audit_pairs(df, RULES, held).collect()}
    assert got == dict(plain(rows, companies, member))
    assert {k[:2] for k in got} >= {(A.MISSED, A.COMPANY), (A.MISSED, A.CONTAINMENT), (A.MISSED, A.CONCATENATION), (A.MISSED, A.PERMUTATION), (A.FALSE, "CANONICAL_NAME")}


def test_a_key_of_many_rows_makes_few_pairs(spark):
    i = F.col("id")
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (i % 30).cast("int")), "yyyy-MM-dd")
    rows = spark.range(100_000).select(
        F.lit("one").alias("key"), i.cast("string").alias("id"), F.element_at(F.array(*map(F.lit, "abc")), (i % 3 + 1).cast("int")).alias("source"),
        F.concat(F.lit("n"), i).alias("native"), day.alias("published"), F.concat(F.lit("u"), i).alias("url"),
    )
    got = A.audit_pairs(observed(rows), RULES).collect()
    # day d has source d % 3 alone; neighbours within three days of another source merge
    assert len(got) == sum(1 for a in range(30) for b in range(a + 1, min(30, a + 4)) if a % 3 != b % 3)
    assert {r.reason for r in got} == {"CANONICAL_NAME"} and sum(r.pairs for r in got) == sum(r.pairs for r in got if r.days_apart in (1, 2))


def test_audit_of_an_empty_table(spark):
    df = observed(spark.createDataFrame([], "key string, id string, source string, published string"))
    assert A.audit_pairs(df, RULES).collect() == [] and A.audit_members(df).collect() == []
