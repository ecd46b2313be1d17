"""WARC archives: writing pages with revisits, and reading by a verified chain of record boundaries.

Spark's text sink writes the records, so any store that Spark reaches will do and a lost task leaves nothing behind.
A task of the reader sees a byte range of a file, cut at every occurrence of the record's magic, and emits for each
occurrence a candidate record and the offset of its successor. Pointer jumping from offset 0 keeps the records that
the chain reaches; magic inside payloads is never reached.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import lean
from .work import new_path, stored

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Records with payloads of at least so many bytes are held against each other.
LEAST_BYTES = 0
#: Rows of a file at most.
FILE_ROWS = 20_000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four letters for each five hex digits."""
    digest = F.sha1(payload)
    letters = []
    for k in range(0, 40, 5):
        number = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), (F.shiftright(number, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for j in range(4)]
    return F.concat(*letters)


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """One record for each row of pages (page_id, url, html).

    Of equal payloads of least_bytes or more that with the largest page_id is the response; null page_ids are smallest.
    Rows that share page_id and payload are each written, alike. A null html is an empty payload, a null url `about:blank`;
    control characters of a url become `%20`.
    """
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("about:blank")), r"[\x00-\x20\x7F]", "%20").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    page = page.withColumn("digest", base32_sha1(F.encode("html", "UTF-8"))).withColumn("size", F.octet_length("html").cast("long"))
    #: One row for each payload that several pages have; written first, so that Spark knows its size and broadcasts it only if small.
    shared = page.groupBy("digest", "size").agg(F.max("page_id").alias("response_id"), F.count("*").alias("rows")).where((F.col("size") >= least_bytes) & (F.col("rows") > 1))
    shared = stored(shared.select(F.col("digest").alias("_digest"), F.col("size").alias("_size"), "response_id"), "shared")
    page = page.join(shared, (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size")), "left")
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), line("WARC-Record-ID", uri(F.col("page_id"))), line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.lit("2000-01-01T00:00:00Z")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), line("X-Payload-Bytes", F.col("size").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", uri(F.col("response_id"))))).otherwise(F.lit("")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))), F.lit("\r\n"),
    )
    out = page.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("html"))).alias("value"))
    out.write.option("lineSep", END).option("maxRecordsPerFile", FILE_ROWS).text(path)


_HEAD = re.compile(rb"((?:[!-9;-~]+:[^\r\n]*\r\n)+)\r\n")


def _headers(raw: bytes) -> tuple[dict[str, str], int] | None:
    """The headers after a magic, and their length with the blank line."""
    m = _HEAD.match(raw)
    if not m:
        return None
    pairs = (x.split(b":", 1) for x in m[1].split(b"\r\n") if x)
    return {k.decode().lower(): v.strip().decode("utf-8", "replace") for k, v in pairs}, m.end()


_PIECE = "file string, block long, number long, size long, length long, headers map<string,string>, body_sha1 string, body_bytes long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece behind a magic: its size, the length of the record that its headers claim, and the payload's SHA-1 where the piece holds all of it."""
    number = 0
    for batch in batches:
        size, length, heads, sha, count = [], [], [], [], []
        for value in batch.column("value"):
            raw = value.as_py()
            found = _headers(raw)
            #: At most 18 digits, 0 to 9: no file is longer, and payloads may claim anything.
            claimed = int(found[0]["content-length"]) if found and re.fullmatch(r"[0-9]{1,18}", found[0].get("content-length", "")) else None
            end = None if claimed is None else found[1] + claimed
            size.append(len(raw))
            length.append(None if end is None else len(MAGIC) + end + len(END))
            heads.append(None if end is None else list(found[0].items()))
            whole = end is not None and raw[end : end + len(END)] == END.encode()
            sha.append(base64.b32encode(hashlib.sha1(raw[found[1] : end]).digest()).decode() if whole else None)
            count.append(claimed if whole else None)
        n = len(size)
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(range(number, number + n), pa.int64()), pa.array(size, pa.int64()), pa.array(length, pa.int64()), pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(sha, pa.string()), pa.array(count, pa.int64())], names=["file", "block", "number", "size", "length", "headers", "body_sha1", "body_bytes"])
        number += n


def _raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """file, at (offset of the magic), next (offset of the claimed successor), headers and payload digest of every piece behind a magic.

    A piece's offset is the sum of the sizes before it: of the blocks before, and of the block's pieces before.
    """
    pieces = stored(_raw(spark, path).mapInArrow(lean(_pieces), _PIECE), "pieces")
    blocks = pieces.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0))).select("file", "block", "start")
    own = Window.partitionBy("file", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    #: What stands before a file's first magic is a piece too, an empty one in a whole archive; so offsets lag by one magic.
    at = F.col("start") + F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(own), F.lit(0)) - len(MAGIC)
    placed = pieces.join(blocks, ["file", "block"]).withColumn("at", at)
    return placed.where("at >= 0 AND length IS NOT NULL").select("file", "block", "at", (F.col("at") + F.col("length")).alias("next"), "headers", "body_sha1", "body_bytes")


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """In one block: for each candidate the first offset beyond the block's last candidate that its chain comes to, by pointer jumping."""
    rows = rows.sort_values("at")
    at, far = rows["at"].to_numpy(), rows["next"].to_numpy().copy()
    while True:
        k = np.minimum(np.searchsorted(at, far), len(at) - 1)
        inside = at[k] == far
        if not inside.any():
            return rows[["file", "block", "at"]].assign(exit=far)
        far = np.where(inside, far[k], far)


def _walk(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """In one block: the candidates that chains from its entries come to. Successors only lie ahead, so doubling ends."""
    rows = rows.sort_values("at")
    at = rows["at"].to_numpy()
    reached = np.isin(at, entries["at"].to_numpy())
    k = np.searchsorted(at, rows["next"].to_numpy())
    jump = np.where((k < len(at)) & (at[np.minimum(k, len(at) - 1)] == rows["next"].to_numpy()), k, len(at)) if len(at) else k
    jump, reached = np.append(jump, len(at)), np.append(reached, False)
    while len(at) and (jump[:-1] < len(at)).any():
        ahead = jump[reached]
        reached[ahead[ahead < len(at)]] = True
        jump = jump[jump]
    return rows[reached[:-1]][["file", "at"]]


def reachable(records: DataFrame) -> DataFrame:
    """Of rows (file, block, at, next) those (file, at) that the chain from at = 0 of each file reaches.

    Chains are first shortened to one jump a block; jumps between blocks are then doubled, in rounds that grow with the
    logarithm of the blocks in a file; at last each block follows its chain from the entries found.
    """
    every = records.select("file", "block", "at", "next")
    exits = stored(every.groupBy("file", "block").applyInPandas(_exits, "file string, block long, at long, exit long"), "exits")
    nodes = exits.select("file", F.col("exit").alias("at")).distinct()
    entry = exits.where("at = 0").select("file", "block", "at", "exit").unionByName(exits.where("at > 0").join(nodes, ["file", "at"], "left_semi").select("file", "block", "at", "exit"))
    jumps = stored(entry, "jumps")
    entry = jumps.select("file", "block", "at")
    jumps = jumps.select("file", "at", F.col("exit").alias("next"))
    reached = jumps.where("at = 0").select("file", "at")
    while True:
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = stored(reached.unionByName(ahead).distinct(), "reached")
        jumps = stored(jumps.join(jumps.select("file", F.col("at").alias("next"), F.col("next").alias("far")), ["file", "next"]).select("file", "at", F.col("far").alias("next")), "jumps")
        if not jumps.where("at = 0").limit(1).count():
            break
    ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
    entry = entry.join(reached.unionByName(ahead).distinct(), ["file", "at"], "left_semi")
    return every.groupBy("file", "block").cogroup(entry.groupBy("file", "block")).applyInPandas(_walk, "file string, at long")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, at, headers, payload_digest, payload_bytes of each true record.

    Payloads that hold the magic are put together from their pieces; the others' digests were taken where they were read.
    """
    every = stored(candidates(spark, path), "candidates")
    true = reachable(every).join(every, ["file", "at"])
    return true.select("file", "at", "next", "headers", "body_sha1", "body_bytes")


def payload_spans(spark: SparkSession, path: str, split: DataFrame) -> DataFrame:
    """SHA-1 and bytes of records (file, at, next) whose payloads hold the magic, from the pieces between at and next."""

    def digest(batches):
        for rows in batches:
            out = []
            for pieces in rows.column("pieces").to_pylist():
                raw = MAGIC.encode().join(p["value"] for p in sorted(pieces, key=lambda p: p["at"]))
                found = _headers(raw)
                body = raw[found[1] : found[1] + int(found[0]["content-length"])]
                out.append((base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)))
            yield pa.RecordBatch.from_arrays([rows.column("file"), rows.column("at"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], names=["file", "at", "sha1", "bytes"])

    def numbered(batches):
        number = 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(range(number, number + n), pa.int64()), b.column("value")], names=["file", "block", "number", "value"])
            number += n

    files = split.select("file").distinct()
    pieces = _raw(spark, path).mapInArrow(lean(numbered), "file string, block long, number long, value binary").join(files, "file", "left_semi").withColumn("size", F.length("value") + len(MAGIC))
    blocks = pieces.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.coalesce(F.sum("bytes").over(before), F.lit(0))).select("file", "block", "start")
    own = Window.partitionBy("file", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.join(blocks, ["file", "block"]).withColumn("place", F.col("start") + F.coalesce(F.sum("size").over(own), F.lit(0)) - len(MAGIC))
    within = placed.select("file", "place", "value").join(split.select("file", "at", "next"), "file").where("place >= at AND place < next")
    return within.groupBy("file", "at").agg(F.collect_list(F.struct(F.col("place").alias("at"), "value")).alias("pieces")).mapInArrow(lean(digest), "file string, at long, sha1 string, bytes long")


def records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, url, record_type, refers_to, payload_bytes, payload_digest of each true record; a digest that differs from the header's is an error."""
    true = stored(read_warc(spark, path), "records")
    claimed = F.regexp_replace(F.col("headers")["warc-payload-digest"], "^sha1:", "")
    revisit = F.col("headers")["warc-type"] == "revisit"
    split = true.where(~revisit & F.col("body_sha1").isNull()).select("file", "at", "next")
    if split.limit(1).count():
        mended = payload_spans(spark, path, split)
        true = true.join(mended, ["file", "at"], "left").withColumn("body_sha1", F.coalesce("body_sha1", "sha1")).withColumn("body_bytes", F.coalesce("body_bytes", "bytes"))
    number = lambda name: F.regexp_extract(F.col("headers")[name], r"<urn:page:(-?\d+)>", 1).try_cast("long")
    digest = F.when(revisit | (F.col("body_sha1") == claimed), claimed).otherwise(F.raise_error(F.concat(F.lit("payload and digest differ: "), F.col("file"), F.lit(" "), F.col("at").cast("string"))))
    size = F.when(revisit, F.col("headers")["x-payload-bytes"].cast("long")).otherwise(F.col("body_bytes"))
    return true.select(number("warc-record-id").alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), F.col("headers")["warc-type"].alias("record_type"), number("warc-refers-to").alias("refers_to"), F.col("headers")["warc-target-uri"].alias("url"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages to a new archive in the shared folder and reads it back."""
    path = new_path(pages.sparkSession, "warc")
    write_warc(pages, path)
    return records(pages.sparkSession, path)


_CHARS = ", ".join(f"substr('{ALPHABET}', 1 + CAST((CAST(('0x' || substr(h, {k + 1}, 5)) AS BIGINT) >> {15 - 5 * j}) & 31 AS BIGINT), 1)" for k in range(0, 40, 5) for j in range(4))
#: DuckDB.
SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, payload_bytes, concat({_CHARS}) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to FROM m
"""
