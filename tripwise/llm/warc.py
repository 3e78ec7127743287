"""WARC archives: writing pages as records, and reading with boundary-chain verification.

Writing is a text write whose line separator is the blank line that ends a
record, so Spark's committer keeps the files whole when executors are lost.

Reading never trusts the record magic alone, which payloads may contain.  Files
are cut into blocks; a task looks at one block, takes every place where the magic
stands as a candidate, and reads from its header where its successor must begin.
Within the block it follows these links and emits each candidate's exit: the
first place at or beyond the block's end.  Blocks of a file are then linked by
pointer jumping over the exits, from the file's start; what stays reachable is
the one place at which the true chain enters each block.  A second pass reads the
records of each block from that place on.

Payload digests are checked while reading; a record whose block doesn't match
its digest raises an error, as does a chain that breaks before a file's end.

Null html is an empty payload.  Null urls leave the target out; control
characters and spaces in urls are percent-encoded.  Rows that repeat a page_id
are several records of it; equal payloads of at least 100 bytes are stored once,
by the smallest page_id (each row that holds it, if it repeats).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.llm.common import bit_filter, scratch_path, stored, table

#: payloads from this many bytes on are stored once
LEAST_BYTES = 100
RECORDS_PER_FILE = 20_000
#: bytes of a file that one task looks at
BLOCK = 8 << 20
#: rows of one payload that one task joins
COPIES_PER_TASK = 4096
MAGIC = b"WARC/1.0\r\n"
_DATE = "2026-01-01T00:00:00Z"
_RECORD = re.compile(rb"WARC/1\.0\r\n((?:[!-9;-~]+:[^\r\n]*\r\n)+)\r\n")
#: what may become a record's header when more is read
_OPEN = re.compile(rb"WARC/1\.0\r\n(?:[!-9;-~]+:[^\r\n]*\r\n)*[^\r\n]*\r?\Z")
#: bytes of a header read first, where it goes on beyond a block
HEADER = 1 << 16


def with_responses(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Every row with ``payload``, ``digest``, ``size`` and ``refers_to`` (null for a response).

    A row with a null id revisits the smallest id of its payload; where all ids are
    null there is none, and all rows are responses.

    Payload groups are aggregated before they are joined, and groups of many rows
    are joined in parts, so one payload of a third of all rows is no single task.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = (pages.withColumn("payload", payload).withColumn("digest", F.sha2("payload", 256))
            .withColumn("size", F.octet_length("payload").cast("long")))
    groups = (rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest")
              .agg(F.min(page_id).alias("first_id"), F.count("*").alias("n")).where("n > 1"))
    groups = groups.select("digest", "first_id", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("n") - 1) / COPIES_PER_TASK).cast("int"))).alias("part"), "n")
    # rows pick one of the parts their group has; groups of one part are all at 0
    parts = groups.groupBy("digest").agg(F.max("part").alias("last")).where("last > 0")
    large = {r.digest: r["last"] for r in parts.orderBy(F.desc("last")).limit(1000).toLocalIterator()}
    dealt = F.lit(0)
    if large:
        last = F.element_at(F.create_map(*[x for k, v in large.items() for x in (F.lit(k), F.lit(v))]), F.col("digest"))
        dealt = F.when(last.isNotNull(), F.pmod(F.xxhash64(page_id, F.monotonically_increasing_id()), last + 1).cast("int")).otherwise(F.lit(0))
    # payloads whose digest cannot be in a group stay where they are; only the others are shuffled
    shared = bit_filter(groups.select("digest").distinct(), "digest")
    alone = rows.where(~shared).withColumn("refers_to", F.lit(None).cast(rows.schema[page_id].dataType))
    copies = (rows.where(shared).withColumn("part", dealt).join(groups.select("digest", "part", "first_id"), ["digest", "part"], "left").drop("part")
              .withColumn("refers_to", F.when(~F.col("first_id").eqNullSafe(F.col(page_id)), F.col("first_id"))).drop("first_id"))
    return copies.unionByName(alone)


def _encoded(url: Column) -> Column:
    return F.replace(F.regexp_replace(F.url_encode(url), r"%(21|23|24|26|27|28|29|2A|2B|2C|2F|3A|3B|3D|3F|40|7E)", "%$1"), F.lit("+"), F.lit("%20"))


def record_text(page_id: Column, url: Column, payload: Column, digest: Column, size: Column, refers_to: Column) -> Column:
    """One record as text, without the blank line that ends it."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    name = lambda number: F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))
    revisit = refers_to.isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, payload.cast("string")))
    return F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(name(page_id), F.lit("<urn:page:>"))), line("WARC-Date", F.lit(_DATE)),
        F.coalesce(line("WARC-Target-URI", _encoded(url)), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(revisit, F.concat(line("WARC-Refers-To", name(refers_to)),
                                 line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """The pages as uncompressed WARC files in a new folder."""
    rows = with_responses(pages, page_id, html)
    text = record_text(F.col(page_id), F.col(url).cast("string"), F.col("payload"), F.col("digest"), F.col("size"), F.col("refers_to"))
    (rows.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path))


class _Source:
    """Byte ranges of one file of any store that pyarrow knows."""

    def __init__(self, path: str):
        system, name = pafs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()

    def read(self, begin: int, end: int) -> bytes:
        return self.file.read_at(min(end, self.size) - begin, begin) if begin < min(end, self.size) else b""

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()


def _header(source: _Source, at: int, data: bytes, begin: int) -> tuple[int, dict[bytes, bytes]] | None:
    """End of the header at a place and its fields, or None where no header stands; ``data`` starts at ``begin``."""
    found = _RECORD.match(data, at - begin)
    if not found and (at - begin + HEADER > len(data) or _OPEN.match(data, at - begin)):  # the header may go on beyond what has been read
        size, begin = HEADER, at
        data = source.read(at, at + size)
        while not (found := _RECORD.match(data)) and at + len(data) < source.size and _OPEN.match(data):
            size *= 2
            data = source.read(at, at + size)
    if not found:
        return None
    fields = dict(line.split(b":", 1) for line in found[1].split(b"\r\n") if line)
    fields = {k.strip().lower(): v.strip() for k, v in fields.items()}
    return (begin + found.end(), fields) if fields.get(b"content-length", b"").isdigit() else None


def _exits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block (path, begin, end): where the chain from each of its candidates leaves it."""
    for frame in frames:
        for path, begin, end in zip(frame["path"], frame["begin"], frame["end"]):
            with _Source(path) as source:
                data = source.read(begin, end + len(MAGIC) - 1)
                nxt = {}
                for found in re.finditer(re.escape(MAGIC), data):
                    at = begin + found.start()
                    if at < end and (head := _header(source, at, data, begin)):
                        nxt[at] = head[0] + int(head[1][b"content-length"]) + 4
                exits: dict[int, int] = {}
                for at in sorted(nxt, reverse=True):  # successors come first
                    after = nxt[at]
                    exits[at] = after if after >= end else exits.get(after, -1)
            yield pd.DataFrame({"path": path, "at": list(exits), "exit": list(exits.values())}).astype({"at": "int64", "exit": "int64"})


def _records(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of each block from the place where the chain enters it."""
    for frame in frames:
        for path, entry, end in zip(frame["path"], frame["entry"], frame["end"]):
            rows, held = [], 0
            with _Source(path) as source:
                at, end = int(entry), int(end)
                data, begin = source.read(at, end), at
                while at < end:
                    head = _header(source, at, data, begin)
                    if not head:
                        raise ValueError(f"{path}: no record at {at}, where the one before ends")
                    body_at, fields = head
                    after = body_at + int(fields[b"content-length"])
                    body = data[body_at - begin:after - begin] if after - begin <= len(data) else source.read(body_at, after)
                    rows.append(_row(path, at, fields, body))
                    held += len(body)
                    at = after + 4
                    if held > 4 << 20:
                        yield pd.DataFrame(rows, columns=_COLUMNS)
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=_COLUMNS)


_COLUMNS = ["path", "at", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
_SCHEMA = ("path string, at long, page_id string, url string, record_type string, refers_to string, "
           "payload_bytes long, payload_digest string, payload binary")


def _row(path: str, at: int, fields: dict[bytes, bytes], body: bytes) -> tuple:
    split = body.find(b"\r\n\r\n") + 4
    http, payload = body[:split], body[split:]
    size = int(re.search(rb"(?i)content-length: *([0-9]+)", http)[1])
    digest = fields[b"warc-payload-digest"].removeprefix(b"sha256:").decode()
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{path}: the record at {at} does not match its digest")
    number = lambda v: None if v is None else v.decode().removeprefix("<urn:page:").removesuffix(">") or None
    url = fields.get(b"warc-target-uri")
    return (path, at, number(fields[b"warc-record-id"]), url and url.decode(), kind, number(fields.get(b"warc-refers-to")),
            size, digest, payload if kind == "response" else None)


def read_archives(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """One row per record of the archives in a folder; the payload is null for revisits."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    blocks = stored(files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block))).alias("begin"))
                    .withColumn("end", F.least(F.col("begin") + block, "length")), "warc-blocks")
    n = max(1, blocks.count())
    dealt = blocks.repartition(min(n, 100_000), "path", "begin")
    exits = stored(dealt.mapInPandas(_exits, "path string, at long, exit long"), "warc-exits")

    # the places where a chain may enter a block: a file's start and the exits
    entries = exits.select("path", F.col("exit").alias("at")).where(F.col("at") >= 0).distinct()
    jumps = stored(exits.join(entries.union(files.select("path", F.lit(0).cast("long"))).distinct(), ["path", "at"]), "warc-jumps")
    reached = jumps.where("at = 0").select("path", "at")
    most = blocks.groupBy("path").count().agg(F.max("count")).first()[0] or 0
    hops = 1
    while hops < most:  # after each round, what lies up to twice as many blocks ahead is reached
        ahead = reached.join(jumps, ["path", "at"]).select("path", F.col("exit").alias("at"))
        reached = stored(reached.union(ahead).distinct(), "warc-reached")
        far = jumps.select("path", F.col("at").alias("exit"), F.col("exit").alias("beyond"))
        jumps = stored(jumps.join(far, ["path", "exit"], "left").select("path", "at", F.coalesce("beyond", "exit").alias("exit")), "warc-jumps")
        hops *= 2

    # each file's chain must end where the file ends
    last = reached.join(jumps, ["path", "at"]).groupBy("path").agg(F.max("exit").alias("last"), F.min("exit").alias("least"))
    broken = files.join(last, "path", "left").where("last IS NULL OR least < 0 OR last <> length").select("path").head(1)
    if broken:
        raise ValueError(f"the chain of records breaks in {broken[0][0]}")
    entered = (blocks.join(reached.withColumn("begin", (F.floor(F.col("at") / block) * block).cast("long")), ["path", "begin"])
               .select("path", F.col("at").alias("entry"), "end"))
    return entered.repartition(min(n, 100_000), "path", "entry").mapInPandas(_records, _SCHEMA)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, as read back from archives written from all pages: payload size, digest, record type and reference."""
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read_archives(spark, path).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
             min(page_id) OVER (PARTITION BY sha256(html)) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
"""
