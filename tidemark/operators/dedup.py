"""Observations into incidents (D-*): pairwise decisions, anchored components and their roll-up.

Components are no transitive closure. Within a key, observations are read by day; one joins the open component if it
merges with its first member (the anchor) or corroborates a member of another source within a day, unless any member
forbids it; else it opens a new component. Rows are dealt by ranges of that order, so a large key is spread over tasks,
and neighbours that decide alike become one run. Only the runs of a key meet in one task, which folds them in Arrow batches
as they come and holds no more than the open component, one entry for all members that decide alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import any_of, searchable
from tidemark.session import cut, measured_broadcast

# Phrases that tell of another attack on the same victim, searched as they stand.
RECURRENCE_MARKERS = (
    "nouvelle cyberattaque", "nouvelle attaque", "nouvelle fuite", "a nouveau", "de nouveau", "une nouvelle fois",
    "frappe une nouvelle fois", "deuxieme cyberattaque", "deuxieme attaque", "deuxieme fuite", "2eme cyberattaque", "2e cyberattaque",
    "2eme attaque", "2e attaque", "2eme fuite", "2e fuite", "second incident", "new attack", "attacked again", "breached again",
    "another breach", "second attack", "new breach",
)
VETOES = ("CONFLICTING_SOURCE_ITEM_ID", "CONFLICTING_EVENT_DATE", "RECURRENCE_MARKER")


@dataclass(frozen=True)
class MergeRules:
    """What pairs may merge: sources whose URLs name one item, and a source of claims that another reports later."""

    near_days: int = 3
    gap_days: int = 14
    url_sources: tuple[str, ...] = ()
    claim_source: str | None = None
    report_source: str | None = None
    report_days: int = 4
    claimed: str = "Ransomware"


def recurs(*texts: Column, markers: tuple[str, ...] = RECURRENCE_MARKERS) -> Column:
    """F-12: whether a text tells of another attack: one of the markers stands in it, anywhere."""
    blob = searchable(F.concat_ws(" ", *texts))
    return any_of([F.contains(blob, F.lit(m)) for m in markers])


def observations(df: DataFrame, **fields: Column) -> DataFrame:
    """Rows with the fields of a decision: key, id, source, native, event, published, url, threat, recurs, renamed.

    Missing ones are empty; days are ISO strings. `renamed` tells that an alias gave the key.
    """
    texts = ("key", "id", "source", "native", "event", "published", "url", "threat")
    columns = [F.coalesce(fields[t].cast("string") if t in fields else F.lit(""), F.lit("")).alias(t) for t in texts]
    flags = [F.coalesce(fields.get(f, F.lit(False)), F.lit(False)).alias(f) for f in ("recurs", "renamed")]
    rows = df.select(*columns, *flags)
    rows = rows.withColumn("best", F.when(F.col("event") != "", F.col("event")).otherwise(F.col("published")))
    return rows.withColumn("day", F.col("best").try_cast("date"))


def decide(a: Column, b: Column, rules: MergeRules) -> Column:
    """D-01: struct<action, reason> of two observations; the first rule that applies decides."""
    days = F.abs(F.datediff(a["day"], b["day"]))
    dated = a["day"].isNotNull() & b["day"].isNotNull()
    same_source, natives = a["source"] == b["source"], (a["native"] != "") & (b["native"] != "")
    later = F.when(b["day"] > a["day"], b["recurs"]).otherwise(a["recurs"])
    events = (a["event"] != "") & (b["event"] != "")

    def told(action: str, reason: str) -> Column:
        return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))

    out = F.when(same_source & natives & (a["native"] == b["native"]), told("MERGE", "SOURCE_ITEM_ID"))
    out = out.when(same_source & natives, told("KEEP_SEPARATE", "CONFLICTING_SOURCE_ITEM_ID"))
    out = out.when(dated & (a["day"] != b["day"]) & later, told("KEEP_SEPARATE", "RECURRENCE_MARKER"))
    out = out.when((a["key"] == "") | (a["key"] != b["key"]), told("NO_DECISION", "NO_DECISION"))
    out = out.when(events & (a["event"] != b["event"]), told("KEEP_SEPARATE", "CONFLICTING_EVENT_DATE"))
    out = out.when(~dated, told("NO_DECISION", "NO_DECISION"))
    out = out.when(events & ~same_source, told("MERGE", "EVENT_DATE"))
    near = days <= rules.near_days
    out = out.when(near & (a["renamed"] | b["renamed"]), told("MERGE", "ALIAS")).when(near, told("MERGE", "CANONICAL_NAME"))
    if rules.claim_source and rules.report_source:
        lag = F.when((a["source"] == rules.claim_source) & (b["source"] == rules.report_source), F.datediff(b["day"], a["day"]))
        lag = lag.when((b["source"] == rules.claim_source) & (a["source"] == rules.report_source), F.datediff(a["day"], b["day"]))
        both = (a["threat"] == rules.claimed) & (b["threat"] == rules.claimed)
        out = out.when(both & (lag == rules.report_days), told("MERGE", "CLAIM_REPORTED"))
    if rules.url_sources:
        one_url = same_source & a["source"].isin(*rules.url_sources) & (a["url"] != "") & (a["url"] == b["url"])
        out = out.when(one_url & (days <= rules.gap_days), told("MERGE", "UNIQUE_URL"))
    return out.otherwise(told("KEEP_SEPARATE", "TIME_GAP"))


class Member(NamedTuple):
    """What a decision within a key looks at; `day` counts days, `claimed` tells that the threat is the claimed one."""

    source: str
    native: str
    event: str
    url: str
    day: int | None
    claimed: bool
    recurs: bool


def decided(a: Member, b: Member, rules: MergeRules) -> tuple[str, str]:
    """`decide` of two observations of one key, as plain values; an alias is not told from a name."""
    same_source = a.source == b.source
    if same_source and a.native and b.native:
        return ("MERGE", "SOURCE_ITEM_ID") if a.native == b.native else ("KEEP_SEPARATE", "CONFLICTING_SOURCE_ITEM_ID")
    lag = None if a.day is None or b.day is None else b.day - a.day
    if lag and (b if lag > 0 else a).recurs:
        return "KEEP_SEPARATE", "RECURRENCE_MARKER"
    if a.event and b.event and a.event != b.event:
        return "KEEP_SEPARATE", "CONFLICTING_EVENT_DATE"
    if lag is None:
        return "NO_DECISION", "NO_DECISION"
    if a.event and b.event and not same_source:
        return "MERGE", "EVENT_DATE"
    if abs(lag) <= rules.near_days:
        return "MERGE", "CANONICAL_NAME"
    if rules.claim_source and rules.report_source and a.claimed and b.claimed:
        forth, back = (a.source, b.source) == (rules.claim_source, rules.report_source), (b.source, a.source) == (rules.claim_source, rules.report_source)
        if (forth and lag == rules.report_days) or (back and not forth and -lag == rules.report_days):
            return "MERGE", "CLAIM_REPORTED"
    if same_source and a.source in rules.url_sources and a.url and a.url == b.url and abs(lag) <= rules.gap_days:
        return "MERGE", "UNIQUE_URL"
    return "KEEP_SEPARATE", "TIME_GAP"


class _Open:
    """The open component of a key: its anchor, and its members once each."""

    def __init__(self, x: Member, id_: str) -> None:
        self.anchor, self.id, self.first = x, id_, x.day
        self.members = {x._replace(url=""): None}

    def takes(self, x: Member, rules: MergeRules) -> bool:
        # Urls count between rows of one source alone, and corroboration asks for two: of members they mean nothing.
        made = [(m, *decided(m, x, rules)) for m in self.members]
        if any(reason in VETOES for *_, reason in made):
            return False
        if decided(self.anchor, x, rules)[0] == "MERGE":
            return True
        if x.day is None or self.first is None or x.day - self.first > rules.gap_days:
            return False
        return any(m.source != x.source and m.day is not None and abs(x.day - m.day) <= 1 and action == "MERGE" for m, action, _ in made)

    def add(self, x: Member) -> None:
        self.members[x._replace(url="")] = None
        if x.day is not None:
            self.first = x.day if self.first is None else min(self.first, x.day)


Batches = Iterable[pa.RecordBatch]


def _members(batch: pa.RecordBatch) -> Iterator[Member]:
    return map(Member._make, zip(*(batch.column(f).to_pylist() for f in Member._fields), strict=True))


def _runs(url_sources: tuple[str, ...]) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Numbers the runs of neighbours that decide alike; `opens` marks the first row of each."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        last, number = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            runs, opens = [], []
            for key, x in zip(batch.column("key").to_pylist(), _members(batch), strict=True):
                now = key, x if x.source in url_sources else x._replace(url="")
                opens.append(now != last)
                number += now != last
                runs.append(number)
                last = now
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(runs, pa.int64()), pa.array(opens, pa.bool_())], [*batch.schema.names, "run", "opens"]
            )

    return run


def _fold(rules: MergeRules) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            out = []
            for key, id_, x in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist(), _members(batch), strict=True):
                if held is not None and key == at and held.takes(x, rules):
                    held.add(x)
                else:
                    at, held = key, _Open(x, id_)
                out.append(held.id)
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(out, pa.string())], ["run", "component"])

    return run


def components(rows: DataFrame, rules: MergeRules = MergeRules()) -> DataFrame:
    """D-02: id, key, component (the id of its anchor) of `observations`; rows without a key are left out."""
    order = ["key", "best", "source", "url", "id"]
    rows = rows.filter(F.col("key") != "").select(
        *order, "native", "event", F.unix_date("day").alias("day"), (F.col("threat") == rules.claimed).alias("claimed"), "recurs"
    )
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    marked = cut(dealt.mapInArrow(_runs(rules.url_sources), f"{kind}, run bigint, opens boolean"))
    first = marked.filter("opens").drop("opens").repartition("key").sortWithinPartitions(*order)
    folded = cut(first.mapInArrow(_fold(rules), "run bigint, component string"))
    # Rows with neither a day nor an item id merge with nothing, not even with their like.
    alone = F.col("day").isNull() & (F.col("native") == "")
    named = marked.join(measured_broadcast(folded), "run")
    return named.select("id", "key", F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component"))


def incidents(
    members: DataFrame, *, preferred: str | None = None, silent: tuple[str, ...] = (), unknown: tuple[str, str, str] = ("Inconnu", "Inconnu", "Inconnu"),
    threats: tuple[str, ...] = (),
) -> DataFrame:
    """D-05, D-10, D-11: one row per component.

    `members` are `observations` with their component, and, if they have them, name, sector, threat, place, collected.

    * date, basis: the earliest event day, else the earliest publication (D-05). key: the smallest. items, n_sources.
    * name: the commonest one other than that of the first member (by source, published, key, url, id), the smallest on a tie;
      that member's where no other is known.
    * sector, place: the commonest known label among members of the `preferred` source, else among all; a tie goes to the
      smallest, but to unknown for sectors of all members. `unknown` names the unknown sector, place and threat.
    * threat: the first of `threats` that a member has.
    * sources, urls: sorted and joined, of members whose source is not `silent`, or of all where all are.
    * first_seen, last_seen: of the days of collection; empty for none.

    Labels are counted before they meet, so a component's members never do; what is listed is its sources and urls.
    """
    have = set(members.columns)
    rows = members.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("") for c in ("name", "sector", "threat", "place", "collected")})
    event = F.min(F.nullif("event", F.lit("")))
    published = F.min(F.nullif("published", F.lit("")))
    speaks = ~F.col("source").isin(*silent) if silent else F.lit(True)

    def joined(c: str) -> Column:
        told = F.collect_set(F.when(speaks, F.nullif(F.col(c), F.lit(""))))
        every = F.collect_set(F.nullif(F.col(c), F.lit("")))
        return F.array_join(F.array_sort(F.when(F.count_if(speaks) > 0, told).otherwise(every)), " | ")

    order = F.array(*[F.lit(t) for t in threats]) if threats else F.array().cast("array<string>")
    rank = F.min(F.when(F.array_position(order, F.col("threat")) > 0, F.array_position(order, F.col("threat"))))
    whole = rows.groupBy("component").agg(
        F.min("key").alias("key"), F.coalesce(event, published, F.lit("")).alias("date"),
        F.when(event.isNotNull(), "EVENT").otherwise("PUBLICATION").alias("basis"), joined("source").alias("sources"),
        joined("url").alias("urls"), F.count(F.lit(1)).alias("items"), F.countDistinct("source").alias("n_sources"),
        F.min_by("name", F.struct("source", "published", "key", "url", "id")).alias("_first"), F.coalesce(F.get(order, (rank - 1).cast("int")), F.lit(unknown[2])).alias("threat"),
        F.coalesce(F.min(F.nullif("collected", F.lit(""))), F.lit("")).alias("first_seen"), F.coalesce(F.max(F.nullif("collected", F.lit(""))), F.lit("")).alias("last_seen"),
    )

    liked = (F.col("source") == preferred) if preferred else F.lit(False)
    fields = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("label")) for f in ("name", "sector", "place")]))
    counts = rows.select("component", liked.alias("_liked"), fields).filter("label <> ''").groupBy("component", "field", "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_liked").alias("liked")
    )
    counts = counts.filter(~(((F.col("field") == "sector") & (F.col("label") == unknown[0])) | ((F.col("field") == "place") & (F.col("label") == unknown[1]))))
    counts = counts.join(whole.select("component", "_first"), "component").filter("NOT (field = 'name' AND label = _first)")
    by_liked, by_all = F.struct(-F.col("liked"), "label"), F.struct(-F.col("n"), "label")
    chosen = counts.groupBy("component", "field").agg(
        F.max("liked").alias("liked"), F.min_by("label", by_liked).alias("of_liked"), F.min_by("label", by_all).alias("of_all"),
        # the same label is first and last among the commonest ones only if it has no equal
        F.max_by("label", F.struct("n", "label")).alias("last_of_all"),
    )
    single = (F.col("field") != "sector") | (F.col("of_all") == F.col("last_of_all"))
    best = F.when((F.col("field") != "name") & (F.col("liked") > 0), F.col("of_liked")).when(single, F.col("of_all"))
    told = chosen.groupBy("component").agg(*[F.max(F.when(F.col("field") == f, best)).alias(f) for f in ("name", "sector", "place")])
    out = whole.join(told, "component", "left")
    out = out.withColumns({"name": F.coalesce("name", "_first"), "sector": F.coalesce("sector", F.lit(unknown[0])), "place": F.coalesce("place", F.lit(unknown[1]))})
    return out.select(
        "component", "key", "date", "basis", "name", "sector", "threat", "place", "sources", "urls", "items", "n_sources", "first_seen", "last_seen"
    )


def priority_label(df: DataFrame, by: str, label: str, order: tuple[str, ...], unknown: str) -> DataFrame:
    """D-09: the first label of `order` that a group has."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(label))
    best = F.min(F.when(rank > 0, rank))
    return df.groupBy(by).agg(F.coalesce(F.get(F.array(*[F.lit(x) for x in order]), (best - 1).cast("int")), F.lit(unknown)).alias(label))


def flatten_redirects(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """D-14, D-15: id, target of `links` (id, target), each target followed to its end; ids on a loop go.

    Pointer doubling: every round joins the table with itself, so chains of 2**k links take k rounds.
    """
    rows = links.select("id", "target").filter("id <> target")
    for _ in range(max_rounds):
        onward = rows.select(F.col("id").alias("target"), F.col("target").alias("further"))
        stepped = rows.join(onward, "target", "left").select("id", F.coalesce("further", "target").alias("target"), F.col("further").isNotNull().alias("moved"))
        stepped = cut(stepped.filter("id <> target"))
        if not stepped.filter("moved").limit(1).count():
            return stepped.select("id", "target")
        rows = stepped.select("id", "target")
    # What still moves runs into a loop.
    return rows.join(rows.select(F.col("id").alias("target")), "target", "left_anti").select("id", "target")
