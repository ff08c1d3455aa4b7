r"""WARC archives: writing records with revisits for equal payloads, and reading them by boundary-chain verification.

A record is written as a line whose end completes its closing CRLF CRLF, so Spark's text writer makes real archives.

Reading splits on the version line `WARC/1.1\r\n`, wherever it stands. Each piece is a candidate record: its offset is a
sum of lengths (within a file split, then over the splits of a file), and header length plus Content-Length give the
offset of its successor. Payloads may hold the version line too, so candidates are believed only if a chain of successors
from the start of the file reaches them. Every split first follows its own candidates to where their chains leave it;
pointer jumping over splits then finds where each split is entered from the start of the file, in a number of rounds that
grows with the logarithm of the splits of a file; and each split keeps the candidates on the chain from its entry.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast

VERSION = "WARC/1.1\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits at a time, five hex digits to four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, BASE32)


def plan_records(pages: DataFrame, min_payload: int = 0, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least `min_payload` bytes the one with the largest id is the response and the others revisit
    it. Rows without an id are responses. A null payload is an empty one.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload")
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("payload_digest", sha1_base32(F.encode("payload", "UTF-8")))
    keys = rows.filter((F.col("payload_bytes") >= min_payload) & F.col("page_id").isNotNull())
    keys = keys.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
    keys = cut(keys.filter("n > 1").select("payload_digest", "payload_bytes", "target"))
    roles = rows.drop("payload", "url").filter(F.col("page_id").isNotNull()).dropDuplicates(["page_id", "payload_digest"])
    roles = roles.join(keys, ["payload_digest", "payload_bytes"]).filter("page_id <> target")
    roles = cut(roles.select("page_id", F.col("payload_digest").alias("d"), "target"))
    on = (F.col("page_id") == F.col("p")) & (F.col("payload_digest") == F.col("d"))
    rows = rows.join(measured_broadcast(roles.withColumnRenamed("page_id", "p"), 1_000_000), on, "left")
    return rows.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(F.col("target").isNotNull(), "revisit").otherwise("response").alias("record_type"),
        F.col("target").alias("refers_to"),
    )


def _clean(value: Column) -> Column:
    """A header value: line ends as %0D and %0A."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_warc(planned: DataFrame, path: str) -> None:
    """Archives of `plan_records` rows under `path`. A revisit holds no payload but names its digest and length."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise("")
    eol = F.lit("\r\n")

    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), eol)).otherwise("")

    record = F.concat(
        F.lit(VERSION),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.url_encode(F.col("page_id").cast("string")), F.lit(">"))),
        header("WARC-Target-URI", _clean(F.col("url"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("WARC-Payload-Length", F.col("payload_bytes")),
        header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.url_encode(F.col("refers_to").cast("string")), F.lit(">"))),
        header("Content-Length", F.octet_length(body)),
        eol, body, F.lit("\r\n\r"),
    )
    planned.select(record.alias("value")).write.option("lineSep", "\n").text(path)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """file, split, order, value, head, head_bytes, declared, value_bytes, digest of each piece between version lines.

    `head` and what follows from it is null where no header can be read.
    """
    raw = spark.read.option("lineSep", VERSION).text(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("order"), "value",
    )
    at = F.instr("value", "\r\n\r\n")
    head = F.when(at > 0, F.substring("value", F.lit(1), at + 1))
    rows = rows.withColumn("head", head)
    rows = rows.withColumn("head_bytes", F.octet_length("head") + 2)
    declared = F.regexp_extract("head", r"(?i)(?:^|\n)Content-Length:[ \t]*([0-9]{1,18})\r\n", 1)
    rows = rows.withColumn("declared", F.when(declared != "", declared.cast("long")))
    rows = rows.withColumn("value_bytes", F.octet_length("value").cast("long"))
    # The payload of a piece that holds its whole record, digested while the bytes are at hand.
    return rows.withColumn("digest", sha1_base32(_payload(F.col("value"))))


def _payload(value: Column) -> Column:
    return F.substring(F.encode(value, "UTF-8"), F.col("head_bytes") + 1, F.col("declared").cast("int"))


def _placed(rows: DataFrame) -> DataFrame:
    """Adds `offset` of each piece's version line and `successor`.

    The reader drops version lines, so every piece but a file's first stands behind one more; what precedes the first
    version line of a file is a piece without one.
    """
    step = F.col("value_bytes") + len(VERSION)
    inside = Window.partitionBy("file", "split").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum(step).over(inside), F.lit(0)))
    splits = rows.groupBy("file", "split").agg(F.sum(step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_base", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    splits = cut(splits.select(F.col("file").alias("f"), F.col("split").alias("s"), "_base"))
    rows = rows.join(splits, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s"))).drop("f", "s")
    # The first piece of a file has no version line before it, so later ones stand that much earlier.
    offset = F.col("_base") + F.col("_in") - len(VERSION)
    jump = len(VERSION) + F.col("head_bytes") + F.col("declared") + 4
    return rows.withColumn("offset", offset).withColumn("successor", offset + jump).drop("_in", "_base")


def _chains(rows: DataFrame) -> DataFrame:
    """file, offset of the candidates that a chain from offset 0 of their file reaches. `rows`: file, split, offset, successor."""
    links = rows.select("file", "split", "offset", "successor")
    kind = "file string, split bigint, offset bigint, leaves bigint"

    def exits(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("offset").to_numpy())
        offset = table.column("offset").to_numpy()[order]
        successor = table.column("successor").to_pandas().to_numpy(dtype=float, na_value=-1)[order].astype(np.int64)
        place = {int(o): i for i, o in enumerate(offset)}
        leaves = successor.copy()
        for i in range(len(offset) - 1, -1, -1):
            j = place.get(int(successor[i]))
            if j is not None and j > i:
                leaves[i] = leaves[j]
        return pa.table({"file": table.column("file").take(order), "split": table.column("split").take(order), "offset": offset, "leaves": leaves})

    out = cut(links.groupBy("file", "split").applyInArrow(exits, kind))
    # Pointer jumping from the file starts: `leap` takes an offset to where 2**k splits further its chain arrives.
    reached = cut(out.filter("offset = 0").select("file", "offset"))
    leap = out.select("file", "offset", F.col("leaves").alias("to"))
    while True:
        onward = reached.join(leap, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        onward = onward.join(out.select("file", "offset"), ["file", "offset"], "left_semi")
        grown = cut(reached.unionByName(onward).distinct())
        if grown.count() == reached.count():
            break
        reached = grown
        far = leap.select("file", F.col("offset").alias("to"), F.col("to").alias("next"))
        leap = cut(leap.join(far, ["file", "to"]).select("file", "offset", F.col("next").alias("to")))
    entries = links.join(reached.withColumn("entry", F.lit(True)), ["file", "offset"], "left")

    def kept(table: pa.Table) -> pa.Table:
        offset = table.column("offset").to_numpy()
        successor = table.column("successor").to_pandas().to_numpy(dtype=float, na_value=-1).astype(np.int64)
        entry = table.column("entry").to_pandas().notna().to_numpy()
        order = np.argsort(offset)
        place = {int(offset[i]): i for i in order}
        on = entry.copy()
        for i in order:
            j = place.get(int(successor[i]))
            if on[i] and j is not None and offset[j] > offset[i]:
                on[j] = True
        mask = pa.array(on)
        return pa.table({"file": table.column("file").filter(mask), "offset": offset[on]})

    return entries.groupBy("file", "split").applyInArrow(kept, "file string, offset bigint")


def read_warc(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of each record of the archives under `path`.

    Lengths and digests of responses are those of the payload as read; a revisit gives what its header says of the full
    payload. A record whose payload holds version lines is put together from its pieces. Bytes that no chain reaches,
    and everything behind a damaged header, are not records. Ids come back as `id_type`, null where a record's id is none
    of that type: give the type of the pages written.
    """
    # Payloads stay behind: only lengths, headers and digests are shuffled.
    slim = _placed(candidates(spark, path).drop("value"))
    slim = slim.select("file", "split", "offset", "successor", "head", "head_bytes", "declared", "value_bytes", "digest")
    slim = cut(slim)
    real = cut(_chains(slim))
    records = slim.join(real, ["file", "offset"])
    whole = records.filter(F.col("value_bytes") >= F.col("head_bytes") + F.col("declared"))
    broken = records.filter(F.col("value_bytes") < F.col("head_bytes") + F.col("declared"))
    broken = cut(broken.select("file", "offset", "successor", "head", "head_bytes", "declared"))
    if broken.limit(1).count():
        pieces = _placed(candidates(spark, path).join(measured_broadcast(broken.select("file").distinct()), "file", "left_semi"))
        parts = pieces.select("file", F.col("offset").alias("at"), "value")
        inside = (F.col("at") >= F.col("offset")) & (F.col("at") < F.col("successor"))
        parts = parts.join(broken, "file").filter(inside)
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda p: p["value"]), VERSION)
        joined = parts.groupBy("file", "offset", "head", "head_bytes", "declared").agg(text.alias("value"))
        joined = joined.withColumn("digest", sha1_base32(_payload(F.col("value"))))
        whole = whole.select("head", "declared", "digest").unionByName(joined.select("head", "declared", "digest"))

    def field(name: str, pattern: str) -> Column:
        found = F.regexp_extract("head", rf"(?:^|\n){name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    def page(name: str) -> Column:
        return F.url_decode(field(name, "<urn:page:([^>\r\n]*)>")).try_cast(id_type)

    revisit = field("WARC-Type", "([a-z]+)") == "revisit"
    return whole.select(
        page("WARC-Record-ID").alias("page_id"),
        field("WARC-Target-URI", "([^\r\n]*)").alias("url"),
        F.when(revisit, field("WARC-Payload-Length", "([0-9]+)").cast("long")).otherwise(F.col("declared")).alias("payload_bytes"),
        F.when(revisit, field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)")).otherwise(F.col("digest")).alias("payload_digest"),
        field("WARC-Type", "([a-z]+)").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )
