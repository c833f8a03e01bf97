"""WARC archives: writing whole-file gzip streams, normalising them, reading by offset.

``write_archives`` puts every task's records into archives that are one gzip stream each, as many
crawlers leave them. ``normalise`` inflates such a stream once, from front to back, writes every
record as a gzip member of its own and a sidecar with the offset and length of every member.
``read_records`` fetches single members by that index.

Archives are files, not tables, so tasks write them themselves, through ``pyarrow.fs``, into the shared
folder. A file is written under a name of the attempt and then moved to its final name, which only
depends on the partition: a lost executor or a second attempt does no harm.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvault.llm.tables import map_rows, packed, staged
from quillvault.sources.shared import fresh_path

#: Payloads below this many bytes are never replaced by a reference.
SMALLEST = 100
ROLL_BYTES = 512 << 20
CHUNK = 1 << 20
LEVEL = 6
GZIP = 31
DATE = "2000-01-01T00:00:00Z"

INDEX = "archive string, offset bigint, length bigint, page_id bigint, record_type string"


def duplicates(pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """``page_id, digest, refers_to`` of the rows that repeat an earlier payload.

    The smallest page_id of equal payloads stays; ids and digests only, summed per task first.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.sha2(payload, 256).alias("digest"),
                        F.octet_length(payload).alias("n"))
    rows = staged(rows.filter(F.col("n") >= smallest).select("page_id", "digest"), "payloads")
    first = (
        rows.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    return (
        rows.join(first, "digest")
        .filter("NOT (page_id <=> refers_to)")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def from_line(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit keeps the HTTP head, and so the payload's length."""
    digest = hashlib.sha256(payload).hexdigest()
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        fields[name.lower()] = value
    return fields, rest[: int(fields["content-length"])]


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _attempt() -> int:
    return TaskContext.get().taskAttemptId()


class Publishing:
    """A file that gets its final name when it is whole."""

    def __init__(self, store: pa.fs.FileSystem, path: str):
        self.store, self.path, self.draft = store, path, f"{path}.{_attempt()}"
        self.out = store.open_output_stream(self.draft)
        self.write = self.out.write

    def publish(self) -> None:
        self.out.close()
        self.store.move(self.draft, self.path)


def write_archives(pages: DataFrame, folder: str, smallest: int = SMALLEST) -> DataFrame:
    """Stored ``archive, records``: one row per archive written below ``folder``.

    ``pages`` needs ``page_id, url, html``. A null html is an empty payload. Rows with equal
    payloads of at least ``smallest`` bytes become revisits of the smallest page_id; repeated rows
    of that id are all responses, as are equal payloads of which none has an id.
    """
    repeats = duplicates(pages, smallest).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to"
    )
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    rows = pages.select("page_id", "url", "html", digest.alias("_d")).join(
        repeats, F.expr("page_id <=> _page AND _d = _digest"), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        part, out, count, size, done = TaskContext.get().partitionId(), None, 0, 0, []

        def close():
            out.write(gz.flush())
            out.publish()
            done.append((out.path, count))

        for batch in batches:
            for page_id, url, html, refers_to in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if out is None:
                    out = Publishing(store, f"{base}/part-{part:06d}-{len(done):04d}.warc.gz")
                    gz, count, size = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0, 0
                data = record(page_id, url, (html or "").encode("utf-8"), refers_to)
                out.write(gz.compress(data))
                count, size = count + 1, size + len(data)
                if size >= ROLL_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield packed(done, pa.schema([("archive", pa.string()), ("records", pa.int64())]))

    written = rows.select("page_id", "url", "html", "refers_to").mapInArrow(
        run, "archive string, records bigint"
    )
    return staged(written, "archives")


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The plain bytes of a gzip file, of one member or several, in bounded pieces."""
    gz = zlib.decompressobj(GZIP)
    for chunk in chunks:
        while chunk:
            yield gz.decompress(chunk, CHUNK)
            if gz.eof:
                chunk = gz.unused_data
                gz = zlib.decompressobj(GZIP)
            else:
                chunk = gz.unconsumed_tail
    while not gz.eof and (rest := gz.decompress(b"", CHUNK)):
        yield rest


def records(plain: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records from the plain bytes of an archive; holds one record at a time."""
    held = bytearray()
    need = None
    for piece in plain:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                head = bytes(held[:end]).decode().lower()
                at = head.index("content-length: ") + 16
                need = end + 8 + int(head[at:].split("\r\n", 1)[0])
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError(f"archive ends within a record ({len(held)} bytes left)")


def normalise(archives: DataFrame, folder: str, keep_source: bool = False) -> DataFrame:
    """Stored index of the normalised archives below ``folder`` (``INDEX``).

    Every archive becomes one file of single-record members and one sidecar of JSON lines. Where
    both exist already (an earlier attempt ended late), the sidecar is read instead. Sources are
    deleted afterwards unless ``keep_source``.
    """

    def lines(store, path):
        with store.open_input_stream(path) as file:
            return [tuple(json.loads(x)) for x in file.read().decode().splitlines()]

    def one(store, base, archive):
        name = archive.rsplit("/", 1)[-1]
        path, side = f"{base}/{name}", f"{base}/{name}.index"
        if store.get_file_info(side).type == pa.fs.FileType.File:
            found = lines(store, side)
        else:
            out, found, offset = Publishing(store, path), [], 0
            with store.open_input_stream(archive, compression=None) as file:
                for data in records(inflated(iter(lambda: file.read(CHUNK), b""))):
                    gz = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                    member = gz.compress(data) + gz.flush()
                    out.write(member)
                    fields = parse(data)[0]
                    page = fields.get("x-page-id")
                    found.append(
                        (offset, len(member), None if page is None else int(page), fields["warc-type"])
                    )
                    offset += len(member)
            out.publish()
            index = Publishing(store, side)
            index.write("\n".join(json.dumps(x) for x in found).encode())
            index.publish()
        if not keep_source and store.get_file_info(archive).type == pa.fs.FileType.File:
            store.delete_file(archive)
        return ((path, *x) for x in found)

    def make():
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        return lambda archive: one(store, base, archive)

    spread = archives.select("archive").repartition(
        max(1, archives.sparkSession.sparkContext.defaultParallelism * 2), "archive"
    )
    return staged(map_rows(spread, make, INDEX, rows=20000), "index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload``.

    One row per row of the index, each from its own member. The payload of a response is checked
    against the recorded digest; that of a revisit is null.
    """

    def make():
        store, _ = _store(folder)
        opened: dict[str, pa.NativeFile] = {}

        def one(archive, offset, length):
            if archive not in opened:
                for file in opened.values():
                    file.close()
                opened.clear()
                opened[archive] = store.open_input_file(archive)
            file = opened[archive]
            file.seek(offset)
            fields, block = parse(zlib.decompress(file.read(length), GZIP))
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.decode().lower().rsplit("content-length: ", 1)[1].split("\r\n")[0])
            digest = fields["warc-payload-digest"].removeprefix("sha256:")
            page, refers_to = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
            revisit = fields["warc-type"] == "revisit"
            if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                raise ValueError(f"{archive} at {offset}: payload does not match its digest")
            url = fields.get("warc-target-uri")
            return [
                (
                    None if page is None else int(page),
                    size,
                    digest,
                    fields["warc-type"],
                    None if refers_to is None else int(refers_to),
                    None if url is None else from_line(url),
                    None if revisit else payload.decode("utf-8"),
                )
            ]

        return one

    return map_rows(
        index.select("archive", "offset", "length"),
        make,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, url string, payload string",
        rows=200,
    )


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``pages`` written as archives, normalised, and read back (``read_records``).

    An empty table gives no archives and no rows.
    """
    folder = fresh_path(spark, "warc")
    raw = write_archives(pages, f"{folder}/raw")
    return read_records(normalise(raw, f"{folder}/members"), f"{folder}/members")
