"""WARC archives: records for pages, one file or several a task, and a reader that goes on after damage."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinlink.llm.store import shared_folder, written

#: Payloads below this length are always stored whole.
MIN_SHARED = 100
#: A task begins another archive beyond so many bytes.
ROLL_BYTES = 64 << 20
#: Bytes read at a time; the longest header that counts as one.
READ_BYTES, MAX_HEADER = 1 << 20, 1 << 20
#: Bytes of payload in one batch of rows read back.
BATCH_BYTES = 8 << 20

# Fixed values of the WARC format (ISO 28500) and of gzip.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"
_MARK = re.compile(rb"WARC/\d|\x1f\x8b\x08")
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")
_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")

MANIFEST = "path string, n_records bigint, n_bytes bigint"
ROWS = ("path string, offset bigint, length bigint, inner_offset bigint, reason string, record_type string, record_id string, "
        "date string, target_uri string, refers_to string, key string, refers_to_key string, payload_digest string, "
        "payload_bytes bigint, payload binary")
_ARROW = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in ROWS.split(", "))])


# --- records ------------------------------------------------------------------------------------

def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, target_uri, payload, payload_digest, payload_bytes, record_type, record_id, refers_to, refers_to_key) of each page.

    Of records with equal payloads of MIN_SHARED bytes or more, that with the smallest key is a response and the
    others are revisits of it. Null keys come last; of rows with one key and payload, one alone is the response.
    A null html is an empty payload. Other columns are not read; an empty table gives no rows.

    Digests of which there are many rows are joined by a broadcast: no more than a thousand digests can have more
    than a thousandth of the rows each. The rest is joined by digest, rows without a partner spread by their number.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b"").cast("binary"))
    rows = written(pages.select(F.col(key).cast("string").alias("key"), F.col(key).alias("order"), F.col(url).cast("string").alias("target_uri"),
                                payload.alias("payload"), F.monotonically_increasing_id().alias("row"))
                   .withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("bigint")}), "pages")
    name = F.md5(F.concat_ws(":", F.coalesce("key", F.lit("")), "row"))
    rows = rows.withColumn("record_id", F.format_string(
        "<urn:uuid:%s-%s-%s-%s-%s>", *(F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))))
    first = written(rows.where(F.col("payload_bytes") >= MIN_SHARED).groupBy("payload_digest").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("order").isNull().alias("missing"), "order", "row", "key", "record_id")).alias("first"))
        .where("n > 1").select("payload_digest", "n", "first.row", "first.key", "first.record_id")
        .toDF("payload_digest", "n", "first_row", "first_key", "first_id"), "first-pages")
    often = rows.count() // 1000
    hot = first.where(F.col("n") > often).drop("n").toDF("payload_digest", "hot_row", "hot_key", "hot_id")
    rows = rows.join(F.broadcast(hot), "payload_digest", "left")
    alone = F.col("hot_row").isNotNull() | (F.col("payload_bytes") < MIN_SHARED)
    rare = first.where(F.col("n") <= often).drop("n").withColumnRenamed("payload_digest", "place")
    rows = rows.withColumn("place", F.when(alone, F.concat(F.lit("-"), "row")).otherwise(F.col("payload_digest"))).join(rare, "place", "left")
    of = lambda what: F.coalesce(f"hot_{what}", f"first_{what}")
    revisit = F.coalesce(of("row") != F.col("row"), F.lit(False))
    return rows.select("key", "target_uri", F.when(~revisit, F.col("payload")).alias("payload"), "payload_digest", "payload_bytes",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"), "record_id",
                       F.when(revisit, of("id")).alias("refers_to"), F.when(revisit, of("key")).alias("refers_to_key"))


def _line(text: str) -> bytes:
    """A header value on one line: what is no visible ASCII is percent-encoded."""
    return quote(text, safe="".join(map(chr, range(0x21, 0x7F)))).encode()


def record_bytes(row: dict, date: str) -> bytes:
    """One record. The block is an HTTP message; that of a revisit has the head of it alone, Content-Length included."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    block = head + (row["payload"] or b"")
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", date),
              ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", "sha256:" + row["payload_digest"]),
              ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()), ("X-Record-Key", row["key"])]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", row["refers_to"]), ("X-Refers-To-Key", row["refers_to_key"])]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(n.encode() + b": " + _line(v) + b"\r\n" for n, v in fields if v is not None)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, folder: str | None = None, gzip: bool = True, roll_bytes: int = ROLL_BYTES,
                   date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes page_records as archives, a gzip member a record or plain, and returns the manifest (path, n_records, n_bytes).

    The folder, by default one in the shared folder, must be one that pyarrow's file systems reach from all executors.
    Names are new for each attempt of a task, and the manifest lists those of attempts that succeeded, so that files
    of a lost executor are never read. No records give no archives.
    """
    folder = folder or f"{shared_folder(records.sparkSession)}/archives-{uuid.uuid4().hex}"
    columns = ["key", "target_uri", "payload", "payload_digest", "payload_bytes", "record_type", "record_id", "refers_to", "refers_to_key"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, name, n, size, files = None, None, 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(len(columns)))):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc{'.gz' if gzip else ''}", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = record_bytes(dict(zip(columns, row)), date)
                data = gzip_member(data) if gzip else data
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    out.close()
                    files.append((f"{folder}/{name}", n, size))
                    out = None
        if out is not None:
            out.close()
            files.append((f"{folder}/{name}", n, size))
        if files:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*files)], ["path", "n_records", "n_bytes"])

    return written(records.select(*columns).mapInArrow(task, MANIFEST), "manifest")


# --- salvage ------------------------------------------------------------------------------------

class Damaged(Exception):
    """No valid record begins here; the text says what failed."""


class Tape:
    """Bytes of a file, or in memory, by place, with one stretch of READ_BYTES held."""

    def __init__(self, source, size: int | None = None):
        self.file = None if isinstance(source, bytes) else source
        self.size = len(source) if size is None else size
        self.at, self.held = 0, source if self.file is None else b""

    def read(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if at < self.at or at + n > self.at + len(self.held):
            self.file.seek(at)
            self.at, self.held = at, self.file.read(max(n, READ_BYTES))
        return self.held[at - self.at:at - self.at + n]

    def next_mark(self, at: int) -> int:
        """The next place from `at` on where a member or a version line may begin; the end if there is none."""
        while at < self.size:
            found = _MARK.search(self.read(at, READ_BYTES))
            if found:
                return at + found.start()
            at += max(READ_BYTES - 8, 1)
        return self.size


@dataclass
class Event:
    """A record (reason None) or a gap in bytes [offset, offset + length); inner is the place within the unpacked member."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict = field(default_factory=dict)
    block: bytes = b""
    inner: int | None = None


def _digest_holds(value: str | None, data: bytes) -> bool:
    """False where a sha256 or sha1 in hexadecimal is given that is not the data's; other forms are not checked."""
    name, _, digest = (value or "").partition(":")
    length = {"sha256": 64, "sha1": 40}.get(name.lower())
    if length != len(digest):
        return True
    return hashlib.new(name.lower(), data).hexdigest() == digest.lower()


def read_record(tape: Tape, at: int) -> Event:
    """The plain record at a place, with every check done: version, fields, length, end, digest of the block."""
    head = b""
    for n in (1 << 13, MAX_HEADER):
        head = tape.read(at, n)
        if b"\r\n\r\n" in head:
            break
    begin = _VERSION_LINE.match(head)
    if not begin:
        raise Damaged("no version line")
    stop = head.find(b"\r\n\r\n")
    if stop < 0:
        raise Damaged("header without end")
    headers = {}
    for line in head[begin.end():stop].split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and headers:      # a folded line belongs to the field before it
            headers[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        name = name.decode("utf-8", "replace").strip().lower()
        if not colon or not name:
            raise Damaged("header line without a colon")
        headers[name] = value.decode("utf-8", "replace").strip()
    missing = [n for n in _NEEDED if not headers.get(n)]
    if missing:
        raise Damaged(f"no {missing[0]}")
    if not re.fullmatch(r"[0-9]{1,18}", headers["content-length"]):
        raise Damaged("content-length is no number")
    first, length = at + stop + 4, int(headers["content-length"])
    end = first + length + 4
    if end > tape.size:
        raise Damaged("record longer than the archive")
    if tape.read(end - 4, 4) != b"\r\n\r\n":
        raise Damaged("no end of record where the length says")
    block = tape.read(first, length)
    if not _digest_holds(headers.get("warc-block-digest"), block):
        raise Damaged("block digest differs")
    return Event(at, end - at, None, headers, block)


def _member(tape: Tape, at: int) -> list[Event]:
    """The records of the gzip member at a place; gaps among them have an inner place."""
    unpack, parts, place = zlib.decompressobj(31), [], at
    while not unpack.eof:
        piece = tape.read(place, 1 << 16)
        if not piece:
            raise Damaged("member without end")
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error as error:
            raise Damaged("member does not unpack: " + str(error).split(": ")[-1]) from None
        place += len(piece)
    length = place - len(unpack.unused_data) - at
    inside = list(walk(Tape(b"".join(parts)), members=False))
    if not any(e.reason is None for e in inside):
        raise Damaged("member without record" + (f": {inside[0].reason}" if inside else ""))
    return [Event(at, length, e.reason, e.headers, e.block, e.offset) for e in inside]


def walk(tape: Tape, members: bool = True) -> Iterator[Event]:
    """Records and gaps of an archive, in order; together they cover it.

    Where a check fails, reading goes on at the next member or version line that begins a valid record; what lies
    between is one gap, with the reason of its first failure.
    """
    at, since, why = 0, None, None
    while at < tape.size:
        try:
            if members and tape.read(at, 3) == MEMBER:
                found = _member(tape, at)
            else:
                found = [read_record(tape, at)]
        except Damaged as failure:
            if since is None:
                since, why = at, str(failure)
            at = tape.next_mark(at + 1)
            continue
        if since is not None:
            yield Event(since, at - since, why)
            since = None
        yield from found
        at = found[-1].offset + found[-1].length
    if since is not None:
        yield Event(since, tape.size - since, why)


def _row(path: str, e: Event) -> tuple:
    if e.reason is not None:
        return (path, e.offset, e.length, e.inner, e.reason, *[None] * 10)
    h = e.headers
    payload, n = e.block, len(e.block)
    if h.get("content-type", "").startswith("application/http"):
        head, found, payload = e.block.partition(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})\s*$", head)
        n = int(length[1]) if h["warc-type"] == "revisit" and length else len(payload)
    digest = h.get("warc-payload-digest")
    if h["warc-type"] == "revisit":
        payload = None
    elif not _digest_holds(digest, payload):
        return (path, e.offset, e.length, e.inner, "payload digest differs", *[None] * 10)
    return (path, e.offset, e.length, e.inner, None, h["warc-type"], h["warc-record-id"], h["warc-date"], h.get("warc-target-uri"),
            h.get("warc-refers-to"), h.get("x-record-key"), h.get("x-refers-to-key"), digest.partition(":")[2] if digest else None, n, payload)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _read_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            uri = re.sub(r"^file:/+", "/", path)
            fs, place = pafs.FileSystem.from_uri(uri)
            with fs.open_input_file(place) as source:
                for event in walk(Tape(source, source.size())):
                    rows.append(_row(path, event))
                    size += len(rows[-1][-1] or b"") + 500
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
    if rows:
        yield _batch(rows)


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of the archives below a folder; only names are read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{warc,warc.gz}")
            .load(folder).select("path"))


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps of the archives in column path, one row each.

    Rows with a reason are gaps: bytes [offset, offset + length) that belong to no valid record, or a record whose
    payload has not the digest it states. Each archive is read by one task, a record at a time. Payloads are without the HTTP
    head; revisits have none, and the length and digest of what they revisit. Empty archives and null paths give no rows.
    """
    paths = archives.select("path").where("path IS NOT NULL")
    n = paths.count()
    return paths.repartition(max(1, min(n, 100_000))).mapInArrow(_read_tasks, ROWS)


def valid_records(rows: DataFrame) -> DataFrame:
    return rows.where("reason IS NULL").drop("reason")


def quarantine(rows: DataFrame) -> DataFrame:
    """The log of gaps: (path, offset, length, inner_offset, reason)."""
    return rows.where("reason IS NOT NULL").select("path", "offset", "length", "inner_offset", "reason")


def page_digest(rows: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the pages read back."""
    return valid_records(rows).select(F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                      F.col("refers_to_key").cast("bigint").alias("refers_to"))
