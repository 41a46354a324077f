"""WARC archives: write pages, normalise monolithic gzip files to one member per record, read them back by index.

Archives live in the shared folder, reached through pyarrow's file systems (file://, hdfs://, s3://, ...). A task
writes under a name that no other attempt uses and reports it in its rows, so the files of lost or repeated attempts
are never listed. One record is in memory at a time, not one file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import Workspace, only

#: Bytes of payload, with 512 for a record's head, after which a task starts another archive.
ARCHIVE_BYTES = 64_000_000
_READ = 1 << 20


def _open(uri: str, mode: str):
    if "://" not in uri:
        uri = "file://" + uri
    store, path = fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri)
    return store.open_input_file(path) if mode == "r" else store.open_output_stream(path, compression=None)


def make_folder(uri: str) -> None:
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: the response with its payload, or a revisit with the HTTP head alone."""
    url = "".join(c for c in url or "about:blank" if c.isprintable() and c != " ")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        fields.insert(3, f"WARC-Refers-To: <urn:page:{refers_to}>")
        fields.insert(4, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's fields, with the payload's own length and digest for a response and the stated ones for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(next(line for line in http.decode().split("\r\n") if line.startswith("Content-Length: "))[16:])
    number = lambda name: int(fields[name][10:-1]) if name in fields and fields[name] != "<urn:page:>" else None
    out = {"page_id": number("WARC-Record-ID"), "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To")}
    out |= {"payload_bytes": stated, "payload_digest": fields["WARC-Payload-Digest"][5:]}
    if out["record_type"] == "response" and (len(payload) != stated or digest(payload) != out["payload_digest"]):
        raise ValueError(f"payload of page {out['page_id']} doesn't match its header")
    return out


class GzipStream:
    """Reads one gzip stream (or several members) of a whole file, forwards only."""

    def __init__(self, source):
        self.source, self.buffer, self.unzip = source, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        raw = self.unzip.unused_data
        if self.unzip.eof:
            self.unzip = zlib.decompressobj(31)
        raw = raw or self.source.read(_READ)
        if not raw:
            return False
        self.buffer += self.unzip.decompress(raw)
        return True

    def records(self) -> Iterator[bytes]:
        """Whole records, by the lengths that their heads state."""
        while True:
            while (end := self.buffer.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    if self.buffer:
                        raise ValueError("archive ends inside a record")
                    return
            head = bytes(self.buffer[:end]).decode()
            length = int(next(x for x in head.split("\r\n") if x.lower().startswith("content-length:")).split(":", 1)[1])
            whole = end + 4 + length + 4
            while len(self.buffer) < whole:
                if not self._more():
                    raise ValueError("archive ends inside a record")
            yield bytes(self.buffer[:whole])
            del self.buffer[:whole]


def _writer(folder: str):
    def run(batches):
        out = zipper = None
        name, held, records = "", 0, 0

        def close():
            out.write(zipper.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"file": [name], "records": [records]})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                page_id, url, html, refers_to = row
                if out is None:
                    name = f"{folder}/mono-{uuid.uuid4().hex}.warc.gz"
                    out, zipper, held, records = _open(name, "w"), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                payload = (html or "").encode()
                out.write(zipper.compress(record(page_id, url, payload, refers_to)))
                # empty payloads count too, so that every archive ends
                held, records = held + len(payload) + 512, records + 1
                if held >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


def _normaliser(folder: str):
    """Rewrite each listed file; the sidecar has a line `offset length` for each record."""

    def run(batches):
        for batch in batches:
            for source in batch.column(0).to_pylist():
                name = f"{folder}/members-{uuid.uuid4().hex}.warc.gz"
                offset = n = 0
                with _open(source, "r") as old, _open(name, "w") as new, _open(name + ".idx", "w") as index:
                    for raw in GzipStream(old).records():
                        zipper = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = zipper.compress(raw) + zipper.flush()
                        new.write(member)
                        index.write(f"{offset} {len(member)}\n".encode())
                        offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_pydict({"file": [name], "records": [n]})

    return run


def _reader(batches):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds)))
    for batch in batches:
        for name in batch.column(0).to_pylist():
            with _open(name + ".idx", "r") as index:
                places = [tuple(map(int, line.split())) for line in index.read().decode().splitlines()]
            rows = []
            with _open(name, "r") as members:
                for offset, length in places:
                    members.seek(offset)
                    rows.append(parse(zlib.decompress(members.read(length), 31)))
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def choose_responses(pages: DataFrame, id_col: str, html_col: str, min_bytes: int = 0) -> DataFrame:
    """Add refers_to: of rows with equal payloads of at least min_bytes, the smallest id; null for that row itself.

    Only SHA-256 digests are compared; one row per payload goes back to its copies, and large groups of copies are split.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    sha = F.sha2(F.encode(payload, "UTF-8"), 256)
    first = pages.select(sha.alias("_sha"), F.col(id_col).alias("_id")).groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = first.filter((F.col("_n") > 1) & F.col("_first").isNotNull())
    out = pages.withColumn("_sha", sha).join(first, "_sha", "left")
    refers = F.when((F.col("_first") != F.col(id_col)) & (F.octet_length(payload) >= min_bytes), F.col("_first"))
    return out.withColumn("refers_to", refers).drop("_sha", "_first", "_n")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write monolithic archives and return their list (file, records).

    Null html: an empty payload. Null url: about:blank. A row with a null id is always a response and has an empty
    record id. Rows that repeat the smallest id are all responses. Other columns are left out.
    """
    rows = choose_responses(only(pages, id_col, url_col, html_col), id_col, html_col, min_bytes)
    rows = rows.select(F.col(id_col).cast("long"), url_col, html_col, F.col("refers_to").cast("long"))
    return rows.mapInArrow(_writer(folder), "file string, records long")


#: Tasks that the files of one pass are dealt to at most.
MOST_TASKS = 50_000


def _one_each(files: DataFrame) -> DataFrame:
    """About one file per task; a count of tasks that is given isn't merged again because the rows are small."""
    return files.select("file").repartition(max(1, min(files.count(), MOST_TASKS)))


def normalise_archives(files: DataFrame, folder: str) -> DataFrame:
    """Inflate each listed file once and write it again with a member per record and a sidecar index."""
    return _one_each(files).mapInArrow(_normaliser(folder), "file string, records long")


def read_archives(files: DataFrame) -> DataFrame:
    """A row for each record of the listed files, read member by member at the places of the sidecar."""
    return _one_each(files).mapInArrow(
        _reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, min_bytes: int = 0, **columns) -> DataFrame:
    """Pages to archives, archives to normalised archives, and these back to rows. An empty table gives no rows."""
    ws = Workspace(pages.sparkSession, "warc")
    folder = ws.path + "/archives"
    make_folder(folder)
    written = ws.save(write_archives(pages, folder, min_bytes=min_bytes, **columns), "written")
    members = ws.save(normalise_archives(written, folder), "members")
    return read_archives(members)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: all pages through the archives."""
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: Base32 of a digest: its 160 bits, five at a time.
OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT *, strlen(html)::BIGINT AS bytes, from_hex(sha1(html))::BIT::VARCHAR AS bits, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, bytes AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INT * (16 >> j::INT)))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""
