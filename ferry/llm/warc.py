"""WARC archives: writing, normalising of monolithic gzip files, and reading through an index.

Some crawlers compress a whole WARC file as one gzip stream, which no reader can enter in the
middle. ``normalise`` inflates such a file once, front to back, writes every record as a gzip member
of its own, and writes a sidecar index with each member's offset and length. It streams: it holds
one chunk and the header of one record, whatever the file's or record's size. Files with several
members, or already normalised, are handled alike. ``read_index`` and ``read_member`` then fetch
single records.

``write_archives`` turns pages into monolithic files, one per partition. Of pages with equal
payloads of at least ``min_bytes`` bytes, the one with the smallest page_id is the ``response``, the
others are ``revisit`` records that refer to it; smaller payloads are all responses.

Edge cases. A null html is an empty payload. Rows that repeat page_id and payload are records of
their own, alike. A null page_id is written as ``null``; it never wins over a number, and where all
are null, all are responses. A null url is written as the record's own name; control characters in
a url are percent-encoded. A truncated or malformed file raises ``ValueError``. An empty table gives
no records. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import one_per_task
from ferry.llm.files import locate, writing
from ferry.session import scratch_path

CHUNK = 1 << 18
GZIP = 31
DATE = "2025-01-01T00:00:00Z"
NAME = "urn:x-page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has the HTTP header of the page, but not its payload."""
    name = f"{NAME}{'null' if page_id is None else page_id}"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else name
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{NAME}{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def inflate(source) -> Iterator[bytes]:
    """The plain bytes of a gzip stream of one or more members, in chunks of bounded size."""
    stream, fresh = zlib.decompressobj(GZIP), True
    while data := source.read(CHUNK):
        while data:
            if fresh and not (data := data.lstrip(b"\0")):    # padding between and after members
                break
            out = stream.decompress(data, CHUNK)
            fresh = False
            if out:
                yield out
            if stream.eof:
                data, stream, fresh = stream.unused_data, zlib.decompressobj(GZIP), True
            else:
                data = stream.unconsumed_tail
    if not fresh:
        rest = stream.flush()
        if rest:
            yield rest
        if not stream.eof:
            raise ValueError("the gzip stream is truncated")


class _Input:
    """Reads delimiters and counts from an iterator of chunks."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.held = chunks, b""

    def more(self) -> bool:
        chunk = next(self.chunks, None)
        if chunk is None:
            return False
        self.held += chunk
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the input."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held.strip():
                    raise ValueError("the file ends within a record header")
                return None
        out, self.held = self.held[:at + len(mark)], self.held[at + len(mark):]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("the file ends within a record")
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out


def normalise(source, out, index, level: int = 6) -> int:
    """Rewrite a gzip WARC stream with one member per record; returns the number of records.

    ``index`` gets a line per record: offset, length, type, record id, payload digest.
    """
    stream, at, count = _Input(inflate(source)), 0, 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        fields = parse_header(head)
        member, start = zlib.compressobj(level, zlib.DEFLATED, GZIP), at
        at += out.write(member.compress(head)) or 0
        for part in stream.take(int(fields["content-length"])):
            at += out.write(member.compress(part)) or 0
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError("a record does not end with two empty lines")
        at += out.write(member.compress(b"\r\n\r\n") + member.flush())
        line = (str(start), str(at - start), fields.get("warc-type", ""), fields.get("warc-record-id", ""),
                fields.get("warc-payload-digest", ""))
        index.write(("\t".join(line) + "\n").encode())
        count += 1
    return count


def read_index(source) -> Iterator[tuple[int, int]]:
    """(offset, length) of every member."""
    held = b""
    while data := source.read(CHUNK):
        *lines, held = (held + data).split(b"\n")
        for line in lines:
            offset, length, *_ = line.split(b"\t")
            yield int(offset), int(length)


def read_member(source, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header fields and block of the record at ``offset``."""
    source.seek(offset)
    data = zlib.decompress(source.read(length), GZIP)
    end = data.index(b"\r\n\r\n") + 4
    fields = parse_header(data[:end])
    return fields, data[end:end + int(fields["content-length"])]


def _number(name: str | None) -> int | None:
    name = (name or "").strip("<>").removeprefix(NAME)
    return int(name) if name.lstrip("-").isdigit() else None


def describe(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; checks a response's digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return (_number(fields["warc-record-id"]), size, digest, fields["warc-type"], _number(fields.get("warc-refers-to")))


FILES = "part int, path string, records long"


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html (never null), refers_to (null for responses)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    # Only payloads that occur on several pages travel as keys: ids and digests, map-side combined.
    first = rows.where(F.octet_length("html") >= min_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    return rows.join(first, "sha", "left").select(
        "page_id", "url", "html",
        F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def _file_row(part: int, path: str, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path], "records": [records]})


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, level: int = 1) -> DataFrame:
    """One monolithic ``.warc.gz`` per partition of ``pages``; returns the written list of files."""
    spark = pages.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        path = f"{folder}/part-{part:06d}.warc.gz"
        with writing(path) as out:
            stream = zlib.compressobj(level, zlib.DEFLATED, GZIP)
            for batch in batches:
                for page_id, url, html, refers_to in zip(*(batch.column(k) for k in range(4))):
                    out.write(stream.compress(record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py())))
                    n += 1
            out.write(stream.flush())
        yield _file_row(part, path, n)

    marked = mark_revisits(pages, min_bytes)
    marked.mapInArrow(write, FILES).write.parquet(f"{folder}/files.parquet")
    return spark.read.parquet(f"{folder}/files.parquet")


def normalise_files(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Normalise the listed files (part, path), one per task; returns the written list of new files."""
    spark = files.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
                store, place = locate(path)
                target = f"{folder}/part-{part:06d}.warc.gz"
                with store.open_input_stream(place, compression=None) as source, \
                        writing(target) as out, writing(f"{target}.idx") as index:
                    n = normalise(source, out, index, level)
                yield _file_row(part, target, n)

    one_per_task(files, "part").mapInArrow(run, FILES).write.parquet(f"{folder}/files.parquet")
    return spark.read.parquet(f"{folder}/files.parquet")


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(files: DataFrame) -> DataFrame:
    """A row per record, each read by its own seek through the sidecar index."""
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = locate(path)
                with store.open_input_file(place) as source, \
                        store.open_input_stream(f"{place}.idx", compression=None) as index:
                    rows = []
                    for offset, length in read_index(index):
                        rows.append(describe(*read_member(source, offset, length)))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return one_per_task(files.select("part", "path"), "part").mapInArrow(read, RECORDS)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write monolithic archives, normalise them, and read every record back."""
    spark = pages.sparkSession
    files = write_archives(pages, scratch_path(spark, "warc-monolithic"), min_bytes)
    return read_archives(normalise_files(files, scratch_path(spark, "warc-normalised")))
