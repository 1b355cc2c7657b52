"""WARC archives: writing them as one gzip stream, and a normaliser that makes every record its own member.

A writer task packs its records into archives of bounded size, each one gzip stream over the whole file. The normaliser
inflates such a stream once, piece by piece, writes every record again as a gzip member of its own, and writes a
sidecar index with offset and length of each member. Readers then open single records by offset.

Archives are files in a shared folder (any file system that pyarrow opens). Names follow from the content that a task
writes, and a file is published by renaming, so a task that runs again leaves the same files.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import raw_texts, store

#: Payload bytes after which a writer starts the next archive.
ARCHIVE_BYTES = 64 << 20
#: Payloads shorter than this are always stored.
SHORTEST_SHARED = 1000
_PIECE = 1 << 20


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path behind a folder's address."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    for hadoop, own in (("s3a://", "s3://"), ("s3n://", "s3://")):
        uri = own + uri[len(hadoop) :] if uri.startswith(hadoop) else uri
    return pafs.FileSystem.from_uri(uri)


def record_head(fields: dict[str, str], size: int) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items()], f"Content-Length: {size}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def record_id(page_id: int | None, url: str | None, digest: str, *more: int) -> str:
    """The id of the first record of a page in a task; ``more`` tells further equal rows apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page_id, url, digest, *more]))}>"


def _uri(url: str) -> str:
    return "".join(c if " " < c < "\x7f" else "%" + "%".join(f"{b:02X}" for b in c.encode()) for c in url)


def page_record(page: dict, payload: bytes, date: str) -> bytes:
    """One record of a page; a revisit has no payload of its own and names the record that has it."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(page["digest"])).decode()
    fields = {
        "WARC-Type": page["record_type"], "WARC-Record-ID": record_id(page["page_id"], page["url"], page["digest"], *page["more"]), "WARC-Date": date,
        "WARC-Payload-Digest": digest, "X-Payload-Length": str(page["payload_bytes"]), "X-Page": json.dumps([page["page_id"], page["refers_to"]]),
    }
    if page["url"]:
        fields["WARC-Target-URI"] = _uri(page["url"])
    if page["record_type"] == "revisit":
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = record_id(page["refers_to"], page["refers_url"], page["digest"])
        if page["refers_url"]:
            fields["WARC-Refers-To-Target-URI"] = _uri(page["refers_url"])
        payload = b""
    return record_head(fields, len(payload)) + payload + b"\r\n\r\n"


class RecordReader:
    """Records of a WARC stream, from pieces of any size: (head fields, raw record)."""

    def __init__(self) -> None:
        self.waiting = bytearray()

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.waiting += piece
        begin = 0
        while True:
            end = self.waiting.find(b"\r\n\r\n", begin)
            if end < 0:
                break
            fields = parse_head(bytes(self.waiting[begin:end]))
            stop = end + 4 + int(fields["Content-Length"]) + 4
            if stop > len(self.waiting):
                break
            yield fields, bytes(self.waiting[begin:stop])
            begin = stop
        del self.waiting[:begin]


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record must begin with its version")
    return dict(line.split(": ", 1) for line in lines[1:])


def inflate(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a gzip stream of one or more members, piece by piece."""
    stream = zlib.decompressobj(wbits=31)
    for piece in pieces:
        while piece:
            out = stream.decompress(piece, _PIECE)
            if out:
                yield out
            piece = stream.unconsumed_tail
            if stream.eof:
                piece = stream.unused_data
                stream = zlib.decompressobj(wbits=31)
            elif not piece and not out:
                break
    out = stream.flush()
    if out:
        yield out


def _chunks(file) -> Iterator[bytes]:
    while chunk := file.read(_PIECE):
        yield chunk


def normalise(folder: pafs.FileSystem, source: str, target: str) -> list[tuple[int, int]]:
    """Rewrite a whole-file stream with one member per record; returns (offset, length) of each, also in ``target``.idx."""
    places, offset, reader = [], 0, RecordReader()
    mark = uuid.uuid4().hex
    with folder.open_input_stream(source, compression=None) as file, folder.open_output_stream(f"{target}.{mark}", compression=None) as out, folder.open_output_stream(f"{target}.idx.{mark}", compression=None) as index:
        for piece in inflate(_chunks(file)):
            for fields, record in reader.feed(piece):
                squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = squeeze.compress(record) + squeeze.flush()
                out.write(member)
                index.write(f"{offset} {len(member)} {fields['WARC-Type']} {fields['WARC-Record-ID']}\n".encode())
                places.append((offset, len(member)))
                offset += len(member)
    if reader.waiting:
        raise ValueError(f"{source} ends inside a record")
    folder.move(f"{target}.{mark}", target)
    folder.move(f"{target}.idx.{mark}", f"{target}.idx")
    return places


def read_records(folder: pafs.FileSystem, path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, payload) of every record of a normalised archive, by the offsets of its index."""
    with folder.open_input_stream(f"{path}.idx", compression=None) as file:
        lines = file.read().decode().splitlines()
    with folder.open_input_file(path) as file:
        for line in lines:
            offset, length = map(int, line.split(" ")[:2])
            file.seek(offset)
            record = zlib.decompress(file.read(length), wbits=31)
            head, _, rest = record.partition(b"\r\n\r\n")
            fields = parse_head(head)
            yield fields, rest[: int(fields["Content-Length"])]


def plan_records(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """page_id, url, html, digest, payload_bytes, record_type, refers_to and refers_url of every page.

    Null html is the empty payload. Of equal payloads of at least 1000 bytes the row with the largest id is the
    response (all of them, if rows repeat that id; null is the smallest id); the others revisit it.
    """
    raw = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"), F.sha1(raw).alias("digest"), F.octet_length(raw).cast("long").alias("payload_bytes"))
    # Only digests and ids are moved and counted; a hot payload is combined before the shuffle.
    shared = rows.where(F.col("payload_bytes") >= SHORTEST_SHARED).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("_f"), F.count("*").alias("_n")).where("_n > 1").select(F.col("digest").alias("_digest"), F.col("_f.page_id").alias("_first"), F.col("_f.url").alias("_url"))
    joined = rows.join(shared, (rows.digest == shared._digest) & (rows.payload_bytes >= SHORTEST_SHARED), "left")
    revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "html", "digest", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("_first")).alias("refers_to"), F.when(revisit, F.col("_url")).alias("refers_url"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """Write the planned records into archives, one gzip stream each, and return their paths (one row per archive).

    ``date`` is the time of capture (default: now), the same for all records of a run. The first record of a page in a
    task has an id made of page, address and digest, which revisits refer to; equal rows after it have ids with the
    numbers of the task and of the row, so ids differ in and across the archives of a task. Rows equal in id, address
    and payload that lie in different tasks share their first id, as their records are equal too.
    """
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        paths: list[str] = []
        stream = file = mark = name = None
        size = 0

        def close() -> None:
            file.write(stream.flush())
            file.close()
            path = f"{base}/{name.hexdigest()[:40]}.warc.gz"
            files.move(mark, path)
            paths.append(path)

        task, number = TaskContext.get().partitionId(), 0
        seen: set[bytes] = set()
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("page_id", "url", "digest", "payload_bytes", "record_type", "refers_to", "refers_url")}
            for i, raw in enumerate(raw_texts(batch.column("html"))):
                page = {k: v[i] for k, v in columns.items()}
                key = xxhash.xxh3_128_digest(record_id(page["page_id"], page["url"], page["digest"]))
                number += 1
                page["more"] = (task, number) if key in seen else ()
                seen.add(key)
                if file is None:
                    mark = f"{base}/{uuid.uuid4().hex}.open"
                    file, stream, name, size = files.open_output_stream(mark, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1(), 0
                record = page_record(page, raw or b"", date)
                name.update(record)
                file.write(stream.compress(record))
                size += len(record)
                if size >= archive_bytes:
                    close()
                    file = None
        if file is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return records.mapInArrow(run, "path string")


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def normalise_archives(paths: DataFrame, folder: str) -> DataFrame:
    """Normalise every archive in a task of its own and return the paths of the normalised ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            done = []
            for path in batch.column("path").to_pylist():
                target = f"{base}/{path.rsplit('/', 1)[1]}"
                normalise(files, path, target)
                done.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["path"])

    return paths.mapInArrow(run, "path string")


def round_trip(planned: DataFrame, base: str, archive_bytes: int = ARCHIVE_BYTES, date: str | None = None) -> DataFrame:
    """Write planned records below ``base``, normalise the archives, and read them back by offset (without payloads).

    Paths are stored after each step, so a step is not run twice; every archive is a task's work of its own.
    """
    raw = store(write_archives(planned, f"{base}/streams", archive_bytes, date), "warc-streams")
    tasks = max(1, min(10_000, raw.count()))
    members = store(normalise_archives(raw.repartition(tasks), f"{base}/members"), "warc-members")
    return read_archives(members.repartition(tasks), f"{base}/members", payload=False).drop("payload")


def read_archives(paths: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Every record of the normalised archives, checked against its digest: page_id, sizes, type and payload.

    ``payload`` False checks the payload but does not return it.
    """

    wanted = payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for fields, payload in read_records(files, path):
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].split(":", 1)[1]).hex()
                    page, refers = json.loads(fields["X-Page"])
                    kind = fields["WARC-Type"]
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of page {page} in {path} does not match its digest")
                    rows.append((page, int(fields["X-Payload-Length"]), digest, kind, refers, payload if wanted else None))
                    size += len(payload)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

    return paths.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
d AS (SELECT page_id, octet_length(raw) AS payload_bytes, sha1(raw) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN keeper <> d.page_id AND payload_bytes >= 1000 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> d.page_id AND payload_bytes >= 1000 THEN keeper END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)
"""
