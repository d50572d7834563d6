"""WARC archives: monolithic gzip files, normalised to one member per record with an index.

``write_monolithic`` writes pages as WARC records, one gzip stream per file, as a plain text
writer would. ``normalise`` inflates each such file once, as a stream, and rewrites every record
as its own gzip member; next to each archive goes a sidecar index with the offset, length and
kind of every member. ``read_records`` reads archives back through their sidecars: each record is
one ranged read.

Of the pages with equal payloads of at least ``least_bytes`` the one with the smallest id is a
response record, and the others are revisit records that name it and carry no payload. Groups
are counted in the tasks first; only groups of more than one page go into the join.

A file holds one Spark partition's pages and is inflated record by record, so memory is bounded
by a file's compressed bytes and the largest record. Files are written under a temporary name
and moved, so a task that runs again leaves one whole file.

Defined cases: a null payload is empty; a null id sorts last, so it is a response only if no
page of its group has an id; rows that repeat the smallest id are responses too; line breaks
in a URL become spaces, a null URL is left out; empty tables give empty archives; columns other
than id, URL and payload are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.frames import id_type, map_texts, raw_bytes, run_folder, written
from pagewright.operators.skew import heavy_keys, lookup_join

DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"
CHUNK = 1 << 20
INDEX_SCHEMA = "page_id string, archive string, offset bigint, length bigint, record_type string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_of(page_id: object, url: str | None, payload: bytes, refers_to: object | None) -> bytes:
    """One record without its closing blank lines."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode() + END + block


def parsed(record: bytes) -> dict:
    """Header fields (lower-cased names) of a record, and its ``block``."""
    head, _, block = record.partition(END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return {k.lower(): v for k, v in fields.items()} | {"block": block}


def records_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream, each without its closing blank lines; one is held at a time."""
    held = bytearray()
    needed = -1
    for chunk in chunks:
        held += chunk
        while True:
            if needed < 0:
                at = held.find(END)
                if at < 0:
                    break
                length = next(x for x in bytes(held[:at]).split(b"\r\n") if x.lower().startswith(b"content-length:"))
                needed = at + len(END) + int(length.split(b":")[1])
            if len(held) < needed + len(END):
                break
            yield bytes(held[:needed])
            del held[: needed + len(END)]
            needed = -1
    if held:
        raise ValueError("the stream ends inside a record")


def inflated(data: bytes) -> Iterator[bytes]:
    """The stream of a gzip file in bounded chunks, whatever the number of its members."""
    view = memoryview(data)
    while len(view):
        stream = zlib.decompressobj(31)
        rest: bytes | memoryview = view
        while not stream.eof:
            chunk = stream.decompress(rest, CHUNK)
            rest = stream.unconsumed_tail
            if chunk:
                yield chunk
            elif not rest and not stream.eof:
                raise ValueError("a gzip member is cut off")
        view = view[len(view) - len(stream.unused_data) :]


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record + END) + packer.flush()


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_monolithic(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0
) -> None:
    """Write every page as a record; each file is a single gzip stream."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("sha")
    )
    large = rows.where(F.octet_length("payload") >= least_bytes)
    first = large.groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = written(first, "warc-payloads")
    # Equal payloads may be a third of all pages: they are spread over salts, and so over files.
    marked = lookup_join(rows, first.drop("n"), ["sha"], heavy_keys(first, "sha", "n"))
    other = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= least_bytes)
    marked = marked.select("id", "url", "payload", F.when(other, F.col("first")).alias("refers_to"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "refers_to")]
            made = [record_of(i, u, raw, to) for i, u, to, raw in zip(*columns, raw_bytes(batch.column("payload")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([m.decode() for m in made], pa.string())], ["value"])

    inputs = {c: F.col(c) for c in ("id", "url", "payload", "refers_to")}
    records = map_texts(marked, inputs, "value string", build)
    records.write.option("compression", "gzip").option("lineSep", END.decode()).text(folder)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite each gzip file of ``source`` as an archive and a sidecar in ``target``.

    Returns what was written: archive, records, bytes.
    """
    fs, place = _file_system(target)
    fs.create_dir(place, recursive=True)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, int]] = []
            fs, place = _file_system(target)
            for path, raw in zip(batch.column("path").to_pylist(), raw_bytes(batch.column("content")), strict=True):
                name = posixpath.basename(path).split(".")[0] + ".warc.gz"
                final = posixpath.join(place, name)
                attempt = f"{final}.{hashlib.sha1(raw).hexdigest()[:8]}.{_attempt()}"
                lines, offset = [], 0
                with fs.open_output_stream(attempt + ".tmp", compression=None) as archive:
                    for record in records_of(inflated(raw)):
                        packed = member(record)
                        archive.write(packed)
                        fields = parsed(record[: record.find(END) + len(END)])
                        page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
                        entry = {"page_id": page or None, "archive": name, "offset": offset, "length": len(packed), "record_type": fields["warc-type"]}
                        lines.append(json.dumps(entry) + "\n")
                        offset += len(packed)
                with fs.open_output_stream(attempt + ".index.tmp", compression=None) as index:
                    index.write("".join(lines).encode())
                fs.move(attempt + ".tmp", final)
                fs.move(attempt + ".index.tmp", final.removesuffix(".warc.gz") + ".index.json")
                out.append((name, len(lines), offset))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())],
                ["archive", "records", "bytes"],
            )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    # Spark ends an Arrow batch at 64 MB: a task holds that much compressed, or one larger file.
    made = files.select("path", "content").mapInArrow(rewrite, "archive string, records bigint, bytes bigint")
    rows = made.collect()  # a row for each archive
    return spark.createDataFrame(rows, "archive string, records bigint, bytes bigint")


def _attempt() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.taskAttemptId() if context else 0


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives in ``folder``, read at its offset: header values and payload."""
    index = spark.read.schema(INDEX_SCHEMA).option("pathGlobFilter", "*.index.json").json(folder)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = _file_system(folder)
        for batch in batches:
            rows: list[tuple] = []
            opened: dict[str, pa.NativeFile] = {}
            columns = [batch.column(c).to_pylist() for c in ("archive", "offset", "length")]
            for archive, offset, length in zip(*columns, strict=True):
                if archive not in opened:
                    for file in opened.values():
                        file.close()
                    opened = {archive: fs.open_input_file(posixpath.join(place, archive))}
                fields = parsed(zlib.decompress(opened[archive].read_at(length, offset), 31).removesuffix(END))
                http, _, body = fields["block"].partition(END)
                size = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
                page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
                to = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                response = fields["warc-type"] == "response"
                if response and payload_digest(body) != digest:
                    raise ValueError(f"{archive} at {offset}: the payload does not fit its digest")
                rows.append((page or None, fields.get("warc-target-uri"), int(size.split(": ")[1]), digest, fields["warc-type"], to or None, body if response else None))
            for file in opened.values():
                file.close()
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            values = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(values, kinds, strict=True)], names)

    inputs = {c: F.col(c) for c in ("archive", "offset", "length")}
    schema = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    return map_texts(index, inputs, schema, fetch)


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("/") else folder.replace("file:/", "file:///", 1)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> str:
    """Write, normalise and index ``pages``; the folder of the archives. The monolithic files go."""
    spark = pages.sparkSession
    base = _uri(run_folder(spark, "warc"))
    write_monolithic(pages, f"{base}/monolithic", id_col, url_col, payload_col, least_bytes)
    normalise(spark, f"{base}/monolithic", f"{base}/archives")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/monolithic")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return f"{base}/archives"


def archive_report(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The result of the query, from the archives read back."""
    kind = id_type(pages, id_col)
    found = read_records(pages.sparkSession, archive_pages(pages, id_col))
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
