"""WARC archives of pages, and captures put together again from their records.

Every page is written as three records: its request, the response or a revisit of an
equal payload, and metadata. Records of one transaction name each other in their
concurrent-to fields, and only by those are they joined after reading: a record
belongs to the response or revisit that it names, that names it, or that a record
any chain of records beside it leads to. One nested row comes out per capture.

A writing task makes one file of gzip members under a name of its own and reports it;
only reported files are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import new_path, stage

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("5b0f7c52-6d0c-4f7e-9a55-0e6a3f1c2d11")
BROADCAST_PAYLOADS = 400_000
LEVEL = 3
LISTED = 1000
MAIN = ("response", "revisit", "resource")
REPORT_DDL = "name string, records long, bytes long"
RECORD_DDL = (
    "record_id string, kind string, concurrent_to array<string>, refers_to string, uri string, "
    "date string, payload_digest string, payload_bytes long, payload binary, fields map<string,string>"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    lines = [f"{k}: {v}" for k, v in head if v is not None]
    return ("\r\n".join(["WARC/1.1", *lines]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def clean_url(url: str | None, page_id: int | None) -> str:
    """A URL without characters that a header cannot hold."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"


def transaction(
    key: str, page_id: int | None, url: str | None, payload: bytes, digest: str, first: dict | None
) -> list[bytes]:
    """The records of one capture. ``first`` describes the response that a revisit repeats."""
    uri = clean_url(url, page_id)
    own = f"<urn:uuid:{uuid.uuid5(SPACE, key)}>"

    def named(part: str) -> str:
        return f"<urn:uuid:{uuid.uuid5(SPACE, f'{part}|{key}')}>"

    common = [("WARC-Target-URI", uri), ("WARC-Date", DATE)]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    answer = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if first is None:
        main = record("response", [("WARC-Record-ID", own), *common, *answer], http + payload)
    else:
        repeats = [("WARC-Profile", PROFILE), ("WARC-Refers-To", first["record"])]
        main = record("revisit", [("WARC-Record-ID", own), *common, *answer, *repeats], http)
    parts = urlsplit(uri)
    asked = f"GET {parts.path or '/'}{'?' + parts.query if parts.query else ''} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n"
    known = [("page-id", page_id), ("refers-to-page", first and first["page_id"])]
    notes = "".join(f"{k}: {v}\r\n" for k, v in known if v is not None)
    beside = [("WARC-Concurrent-To", own), *common]
    return [
        main,
        record("request", [("WARC-Record-ID", named("request")), *beside,
                           ("Content-Type", "application/http; msgtype=request")], asked.encode()),
        record("metadata", [("WARC-Record-ID", named("metadata")), *beside,
                            ("Content-Type", "application/warc-fields")], notes.encode()),
    ]


def repeated_payloads(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Payloads of several pages: ``(digest, first_id, ties)``.

    ``ties`` counts the rows with the smallest page_id. Rows are counted by page before
    payloads meet, so a payload that many pages share is many small counts.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    sized = pages.select("page_id", payload.alias("payload")).where(F.octet_length("payload") >= least_bytes)
    counted = (
        sized.groupBy(F.sha1("payload").alias("digest"), "page_id").agg(F.count("*").alias("n"))
    )
    return (
        counted.groupBy("digest")
        .agg(
            F.sum("n").alias("n"),
            F.min(F.struct(F.col("page_id").isNull(), "page_id", "n")).alias("first"),
        )
        .where("n > 1")
        .selectExpr("digest", "first.page_id AS first_id", "first.n AS ties")
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    broadcast_payloads: int = BROADCAST_PAYLOADS,
) -> tuple[str, DataFrame]:
    """Write all pages ``(page_id, url, html)``; the folder and the files written.

    Of pages with equal payloads of at least ``least_bytes`` that with the smallest
    page_id is the response and the others revisit it. A null html is an empty payload,
    a null url is named by its page, a page with a null page_id comes after all others
    in its group, rows that repeat the smallest page_id of a group are responses each.
    Other columns are not read, and an empty table writes nothing.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    first = stage(repeated_payloads(pages, least_bytes), "warc-first")
    few = first.count() <= broadcast_payloads
    rows = pages.select(
        "page_id", "url", "html", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest")
    ).join(F.broadcast(first) if few else first, "digest", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, size, out = TaskContext.get().partitionId(), 0, 0, None
        name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
        files, root = fs.FileSystem.from_uri(folder)
        names = ("page_id", "url", "html", "first_id", "ties")
        for batch in batches:
            for page_id, url, html, first_id, ties in zip(
                *(batch[c].to_pylist() for c in names), strict=True
            ):
                if out is None:
                    files.create_dir(root, recursive=True)
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                payload = (html or "").encode()
                digest = digest_of(payload)
                again = None
                if ties is not None and page_id != first_id:
                    # Which of several equal rows would be meant is not known.
                    known = f"<urn:uuid:{uuid.uuid5(SPACE, f'{first_id}|{digest}')}>"
                    again = {"page_id": first_id, "record": known if ties == 1 else None}
                key = f"{page_id}|{digest}"
                if again is not None or (ties or 1) > 1 or page_id is None:
                    key = f"{part}|{row}|{key}"
                for data in transaction(key, page_id, url, payload, digest, again):
                    size += out.write(member(data))
                row += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "records": [3 * row], "bytes": [size]})

    return folder, stage(rows.mapInArrow(write, REPORT_DDL), "warc-report")


def records_of(stream) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields, by lower-case name, and block of every record of a file."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins here: {line[:40]!r}")
        fields: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        yield fields, stream.read(int(fields["content-length"][0]))


def read_records(folder: str, report: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the reported files; a task reads one file at a time."""

    def row(fields: dict[str, list[str]], block: bytes) -> dict:
        kind = fields["warc-type"][0]
        out = dict.fromkeys(
            ("refers_to", "payload_digest", "payload_bytes", "payload", "fields"), None
        )
        one = {k: v[0] for k, v in fields.items()}
        out |= {
            "record_id": one["warc-record-id"],
            "kind": kind,
            "concurrent_to": fields.get("warc-concurrent-to", []),
            "refers_to": one.get("warc-refers-to"),
            "uri": one.get("warc-target-uri"),
            "date": one.get("warc-date"),
        }
        if kind in ("response", "revisit"):
            head, _, payload = block.partition(b"\r\n\r\n")
            out["payload_digest"] = one["warc-payload-digest"].removeprefix("sha1:")
            if kind == "response":
                if digest_of(payload) != out["payload_digest"]:
                    raise ValueError(f"damaged payload in {out['record_id']}")
                out["payload_bytes"] = len(payload)
                out["payload"] = payload if payloads else None
            else:
                lines = (x.partition(b":") for x in head.split(b"\r\n")[1:])
                held = {k.strip().lower(): v for k, _, v in lines}
                out["payload_bytes"] = int(held[b"content-length"])
        elif kind == "metadata":
            lines = (x.partition(":") for x in block.decode().splitlines())
            out["fields"] = [(k.strip(), v.strip()) for k, _, v in lines]
        return out

    kinds = pa.schema(
        [(c, pa.string()) for c in ("record_id", "kind")]
        + [("concurrent_to", pa.list_(pa.string()))]
        + [(c, pa.string()) for c in ("refers_to", "uri", "date", "payload_digest")]
        + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
        + [("fields", pa.map_(pa.string(), pa.string()))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch["name"].to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    for fields, block in records_of(gzip.GzipFile(fileobj=raw)):
                        rows.append(row(fields, block))
                        size += 500 + len(rows[-1]["payload"] or b"")
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    tasks = max(1, min(report.count(), 10_000))
    return report.select("name").repartition(tasks, "name").mapInArrow(read, RECORD_DDL)


def record_captures(records: DataFrame) -> DataFrame:
    """The capture of every record that leads to one: ``(record_id, capture_id)``.

    Records beside a response or revisit belong to the one fewest links away, the smallest id
    among equals; links are followed, through records beside, until no record is reached
    for the first time. Only records of the last step look for their next ones. Records with
    a null id have no links, repeated records share one row.
    """
    spark = records.sparkSession
    ends = records.select("record_id", F.explode("concurrent_to").alias("peer")).dropna()
    links = ends.union(ends.select("peer", "record_id")).distinct()
    is_main = F.col("kind").isin(*MAIN)
    mains = records.where(is_main).select(F.col("record_id").alias("peer"), F.col("record_id").alias("capture_id"))
    beside = records.where(~is_main).select("record_id")
    path = new_path(spark, "warc-steps")
    kept = "record_id string, capture_id string"

    def step(left: DataFrame, reached: DataFrame, number: int) -> DataFrame:
        found = left.join(reached, "peer").groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
        found.write.parquet(f"{path}/step={number}")
        return spark.read.schema(kept).parquet(f"{path}/step={number}")

    left = stage(links.join(beside, "record_id", "left_semi"), "warc-links")
    found, number = step(left, mains.distinct(), 0), 0
    while True:
        left = stage(left.join(found, "record_id", "left_anti"), "warc-links")
        # Links among reached records lead to nothing new.
        if left.isEmpty() or found.isEmpty():
            return spark.read.schema(kept).parquet(path).select("record_id", "capture_id")
        number += 1
        found = step(left, found.withColumnRenamed("record_id", "peer"), number)


def placed_records(records: DataFrame) -> DataFrame:
    """All records with their ``capture_id``, the own id of those that lead to no response."""
    return records.join(record_captures(records), "record_id", "left").withColumn(
        "capture_id", F.coalesce("capture_id", "record_id")
    )


def captures(records: DataFrame, listed: int = LISTED) -> DataFrame:
    """One nested row per capture from stored records.

    ``capture_id`` is the id of the response or revisit. ``requests`` and ``metadata`` hold
    the records beside it by ascending id; a nested row is one value, so it holds the
    first ``listed`` of each kind, while ``n_requests``, ``n_metadata`` and ``n_records``
    count all and ``placed_records`` gives all as rows. Records that lead to no response
    make a row of their own without one. Of records that repeat an id of a response one is
    shown. An empty table gives none.
    """
    placed = placed_records(records)
    main = F.struct("record_id", "kind", "refers_to", "uri", "date", "payload_digest", "payload_bytes", "payload")
    is_request, is_notes = F.col("kind") == "request", F.col("kind") == "metadata"
    heads = placed.groupBy("capture_id").agg(
        F.min(F.when(F.col("kind").isin(*MAIN), main)).alias("response"),
        F.count_if(is_request).alias("n_requests"),
        F.count_if(is_notes).alias("n_metadata"),
        F.count("*").alias("n_records"),
    )
    by_id = Window.partitionBy("capture_id", "kind").orderBy("record_id")
    asked = F.struct("record_id", "uri", "date")
    notes = F.struct("record_id", F.map_entries("fields").alias("fields"))
    lists = (
        placed.where(is_request | is_notes)
        .select("capture_id", "kind", "record_id", "uri", "date", "fields")
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= listed)
        .groupBy("capture_id")
        .agg(
            F.sort_array(F.collect_list(F.when(is_request, asked))).alias("requests"),
            F.sort_array(F.collect_list(F.when(is_notes, notes))).alias("metadata"),
        )
    )
    nothing = lists.schema
    return heads.join(lists, heads["capture_id"].eqNullSafe(lists["capture_id"]), "left").select(
        heads["capture_id"],
        "response",
        *[F.coalesce(c, F.array().cast(nothing[c].dataType)).alias(c) for c in ("requests", "metadata")],
        "n_requests",
        "n_metadata",
        "n_records",
    )


def page_captures(pages: DataFrame, least_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Write the pages to archives, read them back and put the captures together."""
    folder, report = write_archives(pages, least_bytes=least_bytes)
    return captures(stage(read_records(folder, report, payloads), "warc-records"))
