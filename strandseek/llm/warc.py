"""Operator 5, WARC: writes pages as gzip members of archives, and reads archives in splits.

Writing: a page is a ``response`` record; of pages with equal payloads of at least 100 bytes all but
that of the least id are ``revisit`` records, which carry the HTTP head and the response's id.
Reading: each task has a byte range of a file. It looks for gzip's magic bytes, takes a candidate for
a member only if it inflates to a WARC header, and owns the records that start inside its range,
reading past its end for the last one. Nobody needs an index, and no record is read twice.

Archives go to a folder that all executors share, by any file system that pyarrow knows; a task that
is run again writes another file, and only files of tasks that ended are read.

Defined cases: null html is an empty payload; a null id comes back null, and counts as greater than
all others when equal payloads are compared; rows of one id are each a response where that id is
the least; a null url has no URI header; a very long payload is one record, which a split reads past its
end; an empty table writes nothing and reads as an empty table; other columns may have any names.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandseek.llm._text import Shelf, column, opened

MAGIC = b"\x1f\x8b\x08"
LEAST_PAYLOAD = 100
SPLIT_BYTES, READ_BYTES = 16 << 20, 1 << 18
#: Digests of repeated payloads (80 bytes each) that are broadcast at most; more are joined by a shuffle of the pages.
BROADCAST_DIGESTS = 200_000
#: Splits that a task reads one after the other, where there are more than three times as many as cores.
PACKED = 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def name_of(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def page_of(name: str) -> int | None:
    return int(x) if (x := name.removeprefix("<urn:x-page:").removesuffix(">")) else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool, level: int = 1) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name_of(page)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: {name_of(refers)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + END + body + END) + z.flush()


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> list[tuple[str, int]]:
    """Writes one archive a partition; (path, bytes) of each."""
    base = pages.select(column(key).cast("long").alias("page"), column(url).cast("string").alias("url"), F.coalesce(column(html).cast("string"), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha2("html", 256))
    # equal digests have equal sizes, so the size is tested once
    again = base.select("digest", "page", F.octet_length("html").alias("size")).where(F.col("size") >= LEAST_PAYLOAD)
    again = again.groupBy("digest").agg(F.count("*").alias("n"), F.min("page").alias("least")).where("n > 1").select(F.col("digest").alias("of"), "least")
    shelf = Shelf(pages.sparkSession, "digests")
    again, n = shelf.counted(again)
    again = F.broadcast(again) if n <= BROADCAST_DIGESTS else again  # so pages stay where they are
    rows = base.join(again, F.col("digest") == F.col("of"), "left").select("page", "url", "html", "digest", F.col("least").alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, path, size = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        for b in batches:
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if sink is None:
                    system, at = opened(path)
                    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
                    sink = system.open_output_stream(at, compression=None)  # not by the name: members are compressed already
                data = record(page, url, html.encode(), digest, refers, refers is not None and refers != page)
                sink.write(data)
                size += len(data)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "size": [size]})

    try:
        return [(r["path"], r["size"]) for r in rows.mapInArrow(run, "path string, size long").collect()]
    finally:
        shelf.clear()


def headers(data: bytes) -> dict[str, str]:
    out = {}
    for line in data.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode().lower()] = value.decode().strip()
    return out


class Split:
    """A byte range of a file, read piece by piece."""

    def __init__(self, file, start: int, end: int):
        self.file, self.start, self.end = file, start, end
        self.at, self.data = start, b""  # data begins at byte ``at`` of the file

    def more(self) -> bool:
        self.file.seek(self.at + len(self.data))
        part = self.file.read(READ_BYTES)
        self.data += part
        return bool(part)

    def drop(self, to: int) -> None:
        self.data, self.at = self.data[to - self.at :], to

    def member(self) -> tuple[bytes, int] | None:
        """What the member at ``at`` inflates to and where it ends; nothing if it is no WARC record."""
        z, out, used = zlib.decompressobj(31), [], 0
        checked = False
        try:
            while not z.eof:
                if used == len(self.data) and not self.more():
                    return None
                part = self.data[used:]
                out.append(z.decompress(part))
                used += len(part) - len(z.unused_data)
                if not checked and sum(map(len, out)) >= 7:
                    checked = True
                    if not b"".join(out).startswith(b"WARC/1."):
                        return None
        except zlib.error:
            return None
        return (b"".join(out), self.at + used) if checked else None

    def records(self) -> Iterator[bytes]:
        while True:
            k = self.data.find(MAGIC)
            if k < 0:
                if self.at + max(0, len(self.data) - 2) >= self.end:
                    return
                self.drop(self.at + max(0, len(self.data) - 2))
                if not self.more():
                    return
                continue
            if self.at + k >= self.end:
                return
            self.drop(self.at + k)
            if (found := self.member()) is None:
                self.drop(self.at + 1)
            else:
                yield found[0]
                self.drop(found[1])


def parsed(data: bytes) -> dict:
    """A record's fields; a response's digest is that of its payload, which its header must name."""
    head, body = data.split(END, 1)
    h = headers(head)
    http, payload = body[: int(h["content-length"])].split(END, 1)
    said = h["warc-payload-digest"].removeprefix("sha256:")
    revisit = h["warc-type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != said:
        raise ValueError(f"payload of {h['warc-record-id']} doesn't match its digest")
    return {
        "page_id": page_of(h["warc-record-id"]), "payload_bytes": int(headers(http)["content-length"]) if revisit else len(payload), "payload_digest": said,
        "record_type": h["warc-type"], "refers_to": page_of(h["warc-refers-to"]) if revisit else None, "url": h.get("warc-target-uri"), "payload": None if revisit else payload,
    }


def read_archives(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, and if asked for url and payload, of all records of the files (path, bytes)."""
    fields = [("page_id", "long", pa.int64()), ("payload_bytes", "long", pa.int64()), ("payload_digest", "string", pa.string()), ("record_type", "string", pa.string()), ("refers_to", "long", pa.int64())]
    fields += [("url", "string", pa.string()), ("payload", "binary", pa.binary())] if payloads else []
    arrow, ddl = pa.schema([(n, t) for n, _, t in fields]), ", ".join(f"{n} {d}" for n, d, _ in fields)
    n_splits = sum(-(-size // split_bytes) for _, size in files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                system, at = opened(path)
                with system.open_input_file(at) as file:
                    rows, size = [], 0
                    for data in Split(file, start, end).records():
                        rows.append(parsed(data))
                        size += len(data) if payloads else 200
                        if size > READ_BYTES * 32:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    held = spark.createDataFrame([x for x in files if x[1]], "path string, size long")
    splits = held.select("path", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(split_bytes))).alias("start"))
    splits = splits.select("path", "start", F.least(F.col("start") + split_bytes, F.col("size")).alias("end"))
    tasks = min(n_splits, max(3 * spark.sparkContext.defaultParallelism, n_splits // PACKED))
    return splits.repartition(max(1, tasks)).mapInArrow(run, ddl)


def remove_archives(files: list[tuple[str, int]]) -> None:
    for path, _ in files:
        system, at = opened(path)
        system.delete_file(at)


#: What writing and reading back must give, in SQL.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT payload_digest, min(page_id) AS least FROM q WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN least IS NULL OR page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM q LEFT JOIN f USING (payload_digest)
"""
