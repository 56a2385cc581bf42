"""WARC archives: one gzip member per record, written and read back sequentially."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm.common import staged
from pricegrid.session import fresh_path

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Compressed bytes after which a task begins a new archive, and bytes read at a time.
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 16
LEVEL = 6

_MANIFEST = "archive string, records long, archive_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to long, content binary"
)
_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                      ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                      ("refers_to", pa.int64()), ("content", pa.binary())])


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _page_id(uri: str):
    tail = uri.rpartition(":")[2]
    return None if tail == "none" else int(tail)


def record_bytes(page_id, url: str, payload: bytes, digest: str, size: int, refers_to, is_revisit: bool) -> bytes:
    """One record: headers, block, two line ends. A revisit has an empty block."""
    target = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if is_revisit else 'response'}".encode(),
        f"WARC-Record-ID: <{_uri(page_id)}>".encode(),
        f"WARC-Target-URI: {target}".encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"X-Payload-Length: {size}".encode(),
    ]
    if is_revisit:
        payload = b""
        head += [f"WARC-Profile: {PROFILE}".encode(), f"WARC-Refers-To: <{_uri(refers_to)}>".encode()]
    head += [b"Content-Type: text/html", f"Content-Length: {len(payload)}".encode()]
    return b"\r\n".join([*head, b"", payload, b"", b""])


def gzip_member(record: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Records of one task as archives in the shared folder; a row for each finished archive.

    Names are unique for each attempt, and readers only follow the committed rows, so
    what a lost attempt left behind is never read.
    """
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    context = TaskContext.get()
    part, stem = (context.partitionId() if context else 0), uuid.uuid4().hex
    out, path, written, records, number, done = None, "", 0, 0, 0, []

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to", "is_revisit")]
        for page_id, url, html, refers_to, is_revisit in zip(*columns):
            if out is None:
                path = f"{root}/part-{part:05d}-{number:04d}-{stem}.warc.gz"
                out, written, records, number = fs.open_output_stream(path, compression=None), 0, 0, number + 1
            payload = html.encode("utf-8", "surrogatepass")
            member = gzip_member(record_bytes(page_id, url, payload, payload_digest(payload), len(payload), refers_to, is_revisit))
            out.write(member)
            written, records = written + len(member), records + 1
            if written >= archive_bytes:
                out.close()
                done.append((path, records, written))
                out = None
    if out is not None:
        out.close()
        done.append((path, records, written))
    if done:
        paths, counts, sizes = zip(*done)
        prefix = folder[: len(folder) - len(root)] if folder.endswith(root) else ""
        yield pa.RecordBatch.from_arrays(
            [pa.array([prefix + p for p in paths]), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
            names=["archive", "records", "archive_bytes"],
        )


def write_archives(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row of ``pages``; a table of the archives written.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the
    largest page_id is written as response and the others as revisits of it; shorter
    payloads are all responses. Rows that repeat that page_id and payload are all
    responses. Digests are counted before rows meet them, so a payload that a third
    of all pages share is reduced in the map tasks, and the join that brings the
    result back can be split by the adaptive plan.

    Null html or url: empty. Null page_id: kept, lowest in order. Archives go below
    ``spark.checkpoint.dir``, which every executor reaches.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("size", F.octet_length("html"))
    keyed = rows.withColumn("key", F.sha1(F.col("html").cast("binary")))
    response = (
        keyed.where(F.col("size") >= least_bytes)
        .groupBy("key", "size")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    marked = keyed.join(response.hint("shuffle_hash"), ["key", "size"], "left").select(
        "page_id",
        "url",
        "html",
        F.col("first_id").alias("refers_to"),
        (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("is_revisit"),
    )
    folder = fresh_path(pages.sparkSession, "warc")
    return staged(marked.mapInArrow(lambda it: _write(it, folder, archive_bytes), _MANIFEST), "warc-manifest")


class Records:
    """Records of one archive, front to back, from a function that reads the next bytes.

    Each gzip member is inflated in steps of at most ``chunk`` bytes; headers are kept,
    and the block is handed on piece by piece, so only a step is held in memory.
    """

    def __init__(self, read: Callable[[int], bytes], chunk: int = CHUNK):
        self._read, self._chunk = read, chunk
        self._raw = b""  # compressed, not yet inflated
        self._plain = b""  # inflated, not yet used
        self._inflater = None
        self._ended = True

    def _more(self) -> bool:
        """Inflate some more of the member; False at its end."""
        if self._ended:
            return False
        if not self._raw:
            self._raw = self._read(self._chunk)
            if not self._raw:
                raise ValueError("the archive ends inside a gzip member")
        self._plain += self._inflater.decompress(self._raw, self._chunk)
        if self._inflater.eof:
            self._raw, self._ended = self._inflater.unused_data, True
        else:
            self._raw = self._inflater.unconsumed_tail
        return True

    def _line(self) -> bytes:
        while (at := self._plain.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("a header has no end")
        line, self._plain = self._plain[:at], self._plain[at + 2 :]
        return line

    def __iter__(self) -> Iterator[tuple[dict, Iterator[bytes]]]:
        while True:
            if not self._raw:
                self._raw = self._read(self._chunk)
            if not self._raw:
                return
            self._inflater, self._ended, self._plain = zlib.decompressobj(31), False, b""
            if self._line() != VERSION:
                raise ValueError("no WARC record at the start of a gzip member")
            head = {}
            while line := self._line():
                name, _, value = line.decode("utf-8").partition(":")
                head[name.strip().lower()] = value.strip()
            block = self._block(int(head["content-length"]))
            yield head, block
            for _ in block:  # what the caller left
                pass
            while self._more():
                pass
            if self._plain != b"\r\n\r\n":
                raise ValueError("a block does not end where its length says")

    def _block(self, length: int) -> Iterator[bytes]:
        left = length
        while left:
            if not self._plain and not self._more():
                raise ValueError("a block is shorter than its length says")
            part, self._plain = self._plain[:left], self._plain[left:]
            left -= len(part)
            if part:
                yield part


def _read(batches: Iterator[pa.RecordBatch], with_content: bool) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)

    for batch in batches:
        for archive in batch["archive"].to_pylist():
            fs, path = pafs.FileSystem.from_uri(archive)
            rows, held = [], 0
            with fs.open_input_stream(path, compression=None) as stream:
                for head, block in Records(stream.read):
                    sha, size, parts = hashlib.sha1(), 0, []
                    for part in block:
                        sha.update(part)
                        size += len(part)
                        if with_content:
                            parts.append(part)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    kind, full = head["warc-type"], int(head["x-payload-length"])
                    if kind == "response" and (base64.b32encode(sha.digest()).decode(), size) != (digest, full):
                        raise ValueError(f"{head['warc-record-id']}: the payload does not have its digest")
                    rows.append((_page_id(head["warc-record-id"][1:-1]), head["warc-target-uri"], kind, digest, full,
                                 _page_id(head["warc-refers-to"][1:-1]) if kind == "revisit" else None,
                                 b"".join(parts) if with_content else None))
                    held += size if with_content else 200
                    if held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(archives: DataFrame, content: bool = True) -> DataFrame:
    """Records of the archives, each read front to back by one task as a stream.

    The digest and length of every response are computed from its bytes and compared
    with its headers; a difference, a broken frame or a cut archive is an error, not a
    missing row. Archives are dealt one per task, since gzip members have no index.
    """
    paths = archives.select("archive")
    tasks = max(1, paths.count())
    return paths.repartition(min(tasks, 100_000), "archive").mapInArrow(lambda it: _read(it, content), RECORDS)


def checked_revisits(records: DataFrame) -> DataFrame:
    """Records, each revisit held against the response it names; a wrong one is an error."""
    responses = records.where("record_type = 'response'").groupBy("page_id", "payload_digest", "payload_bytes").count()
    there = responses.select(
        F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes", F.lit(True).alias("there")
    )
    # what archives hold can't be told from the small table of their names: never broadcast it
    found = records.join(there.hint("merge"), ["refers_to", "payload_digest", "payload_bytes"], "left")
    wrong = (F.col("record_type") == "revisit") & F.col("there").isNull() & F.col("refers_to").isNotNull()
    return found.withColumn(
        "record_type",
        F.when(wrong, F.raise_error(F.lit("a revisit refers to no response with its payload")).cast("string"))
        .otherwise(F.col("record_type")),
    ).select("page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "content")
