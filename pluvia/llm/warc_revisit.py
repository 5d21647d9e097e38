"""WARC revisit resolution.

Pages are written as gzipped WARC response records (one gzip member each) into archives of bounded size in
the shared folder.  Resolution reads the archives' headers, shuffles them by payload digest, joins each
duplicate to the original response, and rewrites every archive with fresh headers: duplicates become
``revisit`` records without payload that refer to the original by record id, URI and date.  A rewritten record keeps
its capture date; its id follows from the old one, so that revisits name ids that exist in the new archives.

Archives are named once by the task attempt that writes them and only those named in the written manifest
are read, so a retried task leaves no doubled records.  A task holds one record at a time.

Defined cases: a null payload is empty; payloads under ``min_bytes`` are always responses; of equal payloads
that with the largest page_id, a whole number, is the response (null ids are smallest; among equal ids the last written); a
null URL or id leaves its header out; repeated rows are separate records; no pages give no archives and no
records; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import pin, shared_dir

MANIFEST = "file string, records long, bytes long"
HEADERS = ("file string, offset long, record_type string, record_id string, date string, page_id long, target_uri string, "
           "payload_digest string, payload_bytes long, refers_to long")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROLL_BYTES, ROLL_RECORDS = 512 << 20, 1_000_000
#: Archives are read and rewritten by at most so many tasks at once; each takes several where there are more.
MOST_TASKS = 20_000


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(uri: str, mode: str):
    """A stream of the shared store, whatever its scheme."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if mode == "r":
        return store.open_input_stream(path)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path)


def fresh_id(old: str) -> str:
    """The id of the rewritten form of a record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, old)}>"


def make_record(kind: str, page_id, url, digest: str, size: int, payload: bytes | None = None, record_id: str | None = None, date: str | None = None,
                original: dict | None = None) -> bytes:
    """One WARC record as a gzip member.  A revisit's block is the HTTP head alone; ``original`` is the record it revisits."""
    block = HTTP % size + (payload or b"" if kind == "response" else b"")
    clean = lambda x: re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", x)
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id or f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)),
            ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if url is not None:
        head.append(("WARC-Target-URI", clean(url)))
    if kind == "revisit":
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", fresh_id(original["record_id"])), ("WARC-Refers-To-Date", original["date"])]
        if original["page_id"] is not None:
            head.append(("X-Refers-To-Page", str(original["page_id"])))
        if original["target_uri"] is not None:
            head.append(("WARC-Refers-To-Target-URI", clean(original["target_uri"])))
    head.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def records_of(uri: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record, streamed."""
    with _open(uri, "r") as source:
        data, offset = b"", 0
        while True:
            unpack, parts, used = zlib.decompressobj(31), [], 0
            while not unpack.eof:
                if not data and not (data := source.read(1 << 20)):
                    break
                parts.append(unpack.decompress(data))
                used += len(data) - len(unpack.unused_data)
                data = unpack.unused_data
            if not unpack.eof:
                if parts:
                    raise EOFError(f"{uri}: a record is cut off at byte {offset}")
                return
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield offset, fields, rest[: int(fields["Content-Length"])]
            offset += used


class _Roller:
    """Writes records into archives of bounded size; ``done`` holds the manifest rows."""

    def __init__(self, folder: str, roll: bool = True):
        self.folder, self.roll, self.out, self.done = folder, roll, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name, self.records, self.bytes = f"{self.folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
            self.out = _open(self.name, "w")
        self.out.write(record)
        self.records, self.bytes = self.records + 1, self.bytes + len(record)
        if self.roll and (self.bytes >= ROLL_BYTES or self.records >= ROLL_RECORDS):
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.bytes))
            self.out = None

    def manifest(self) -> pd.DataFrame:
        rows, self.done = self.done, []
        return pd.DataFrame(rows, columns=["file", "records", "bytes"])


def write_archives(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a response record per row; returns the manifest of the archives (file, records, bytes)."""
    folder = shared_dir(pages.sparkSession, "warc-raw")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roller = _Roller(folder)
        for rows in batches:
            for pid, uri, body in zip(rows["page_id"], rows["url"], rows["html"], strict=True):
                payload = b"" if body is None else body.encode("utf-8", "surrogatepass")
                roller.add(make_record("response", pid, uri, digest_of(payload), len(payload), payload))
            yield roller.manifest()
        roller.close()
        yield roller.manifest()

    # Ids travel as strings: pandas would turn a nullable long into a float.
    rows = pages.select(F.col(page_id).cast("string").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return pin(rows.mapInPandas(write, MANIFEST), "warc-raw-manifest")


def _spread(manifest: DataFrame) -> DataFrame:
    """The archives' names over the tasks."""
    return manifest.select("file").repartition(max(1, min(MOST_TASKS, manifest.count())))


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_headers(manifest: DataFrame) -> DataFrame:
    """Headers of all records of the archives; payload digests are recomputed where there is a payload."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for uri in rows["file"]:
                found = []
                for offset, h, block in records_of(uri):
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if h["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if digest_of(payload) != digest or len(payload) != int(h["X-Payload-Length"]):
                            raise ValueError(f"{uri}: the payload at byte {offset} differs from its digest")
                    found.append((uri, offset, h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Date"], _number(h.get("X-Page-ID")), h.get("WARC-Target-URI"),
                                  digest, int(h["X-Payload-Length"]), _number(h.get("X-Refers-To-Page"))))
                    if len(found) >= 10_000:
                        yield _frame(found)
                        found = []
                yield _frame(found)

    return _spread(manifest).mapInPandas(read, HEADERS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in HEADERS.split(", ")])
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "offset": "int64", "payload_bytes": "int64"})


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """headers -> adds ``original`` (struct of the response's page_id, file, offset, record_id, date, target_uri), null
    for responses.  Only digests with several records are joined; where one payload holds any share of the records,
    Spark divides its side of the join."""
    place = F.struct("page_id", "file", "offset", "record_id", "date", "target_uri")
    winners = (
        headers.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest").agg(F.max(place).alias("original"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )
    own = (F.col("original.file") == F.col("file")) & (F.col("original.offset") == F.col("offset"))
    return (
        headers.join(winners, "payload_digest", "left")
        .withColumn("original", F.when((F.col("payload_bytes") >= min_bytes) & ~own, F.col("original")))
    )


def rewrite_archives(manifest: DataFrame, resolved: DataFrame) -> DataFrame:
    """Each archive again, duplicates as revisit records; returns the new manifest."""
    folder = shared_dir(manifest.sparkSession, "warc-deduplicated")

    def rewrite(key, rows: pd.DataFrame) -> pd.DataFrame:
        roller = _Roller(folder, roll=False)
        twice = rows[rows["original_id"].notna()]
        known = {o: {"record_id": rid, "date": date, "page_id": pid, "target_uri": uri}
                 for o, rid, date, pid, uri in zip(*(twice[c] for c in ("offset", "original_id", "original_date", "original_page", "original_uri")), strict=True)}
        for offset, h, block in records_of(key[0]):
            digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
            same = (h.get("X-Page-ID"), h.get("WARC-Target-URI"), digest, size)
            kept = {"record_id": fresh_id(h["WARC-Record-ID"]), "date": h["WARC-Date"]}
            if offset in known:
                roller.add(make_record("revisit", *same, original=known[offset], **kept))
            else:
                roller.add(make_record("response", *same, block.partition(b"\r\n\r\n")[2], **kept))
        roller.close()
        return roller.manifest()

    plans = resolved.select(
        "file", "offset", F.col("original.record_id").alias("original_id"), F.col("original.date").alias("original_date"),
        F.col("original.page_id").cast("string").alias("original_page"), F.col("original.target_uri").alias("original_uri"))
    spread = plans.repartition(max(1, min(MOST_TASKS, manifest.count())), "file")
    return pin(spread.groupBy("file").applyInPandas(rewrite, MANIFEST), "warc-manifest")


def op4_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC, resolved, and read back from the deduplicated archives."""
    raw = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    final = rewrite_archives(raw, resolve(pin(read_headers(raw), "warc-headers")))
    return read_headers(final).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
