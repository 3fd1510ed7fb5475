"""WARC archives of pages with a two-level capture index.

Archive: one gzip member per record, pages with equal payloads are revisits of the one with the
largest id. Index: lines sorted by reversed-host key are packed into compressed blocks; each index
file ends with its sparse directory (first key, place and length of each block). A reader picks the
file by a list of first keys, binary-searches the directory, reads one block by range, searches it,
and reads the record by range.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.shared import small_batches, stored
from trendloom.llm.urls import host_of
from trendloom.session import scratch_root

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which a task begins another archive file; lines of an index block.
FILE_BYTES, BLOCK_LINES = 1 << 30, 3000
#: Index files hold at least FILE_LINES lines, and there are at most MOST_FILES of them. The list of
#: their first keys, each cut to KEY_BYTES, is all that travels to the readers.
FILE_LINES, MOST_FILES, KEY_BYTES = 100_000, 4096, 512

_CAPTURE = pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
CAPTURE = "key string, file string, offset long, length long"
_FILE = pa.schema([("first", pa.binary()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
FILE = "first binary, file string, offset long, length long"
_PAGE = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("html", pa.string())])
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, html string"


def capture_key(url: Column, page_id: Column) -> Column:
    """Host labels from the last to the first, ``)``, the rest of the url, and the page; no white space in between."""
    host = host_of(url)
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(.*)$", 1)
    plain = F.regexp_replace(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), r"[\x00-\x20]", "%20")
    return F.concat(plain, F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("-")))


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record. A revisit has the headers of the answer, with its full length, and no payload."""
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
        head.append("WARC-X-Target: " + json.dumps(url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"WARC-X-Page: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(packed: bytes) -> tuple:
    """Page id, payload length, digest, type, referred page, url and payload of one packed record."""
    data = zlib.decompress(packed, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    whole = lambda name: int(fields[name]) if name in fields else None
    url = json.loads(fields["WARC-X-Target"]) if "WARC-X-Target" in fields else None
    return whole("WARC-X-Page"), size, digest, kind, whole("WARC-X-Refers-To-Page"), url, payload.decode() if kind == "response" else None


#: Names that Hadoop gives to stores which Arrow's file systems know by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "gcs": "gs"}


def arrow_uri(uri: str) -> str:
    """The folder of a Hadoop uri as Arrow's file systems name it; a mounted folder as its local path.

    Access to a remote store comes from the environment of the workers, not from Hadoop's settings.
    """
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme == "dbfs":
        return "/dbfs/" + rest.lstrip("/")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    if scheme in ("wasb", "wasbs"):
        rest = rest.replace(".blob.core.", ".dfs.core.", 1)
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def _store(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(arrow_uri(uri))


def _name() -> str:
    """A name of its own for each attempt of a task, so a repeated task never changes a file in use."""
    task = TaskContext.get()
    return f"{task.partitionId():05d}-{task.taskAttemptId()}"


def _writer(folder: str, file_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        stream, name, at, files = None, "", 0, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if stream is None or at >= file_bytes:
                    if stream is not None:
                        stream.close()
                    name, at, files = f"{_name()}-{files}.warc.gz", 0, files + 1
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                packed = _gzip(record(row["page_id"], row["url"], (row["html"] or "").encode(), row["refers_to"]))
                stream.write(packed)
                rows.append((row["key"], name, at, len(packed)))
                at += len(packed)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CAPTURE.types)], schema=_CAPTURE)
        if stream is not None:
            stream.close()

    return run


def write_archive(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record per row into ``folder`` (shared by all executors) and returns the captures
    ``(key, file, offset, length)``.

    Equal payloads of at least ``min_bytes`` have one response, that of the largest page id. Null
    html is an empty payload, a null url has an empty key and no target line, a null id is no
    winner unless alone. Rows that repeat an id are records of their own.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        F.sha1(F.coalesce(F.col(html_col), F.lit(""))).alias("digest"),
    )
    winners = rows.groupBy("digest").agg(F.max("page_id").alias("winner"))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    refers = F.when(large & F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("page_id")), F.col("winner"))
    marked = rows.join(winners, "digest").select(
        "page_id", "url", "html", refers.alias("refers_to"), capture_key(F.col("url"), F.col("page_id")).alias("key")
    )
    _make(pages.sparkSession, folder)
    return stored(marked.mapInArrow(_writer(folder, file_bytes), CAPTURE))


def _make(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _indexer(folder: str, block_lines: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        stream, directory, lines, at = None, [], [], 0
        name = f"{_name()}.cdx.gz"

        def put() -> None:
            nonlocal at
            packed = _gzip("\n".join(lines).encode())
            stream.write(packed)
            directory.append((lines[0].split("\t", 1)[0], at, len(packed)))
            at += len(packed)
            lines.clear()

        for batch in batches:
            for key, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is None:
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                lines.append(f"{key}\t{file}\t{offset}\t{length}")
                if len(lines) == block_lines:
                    put()
        if stream is None:
            return
        if lines:
            put()
        packed = _gzip(json.dumps(directory).encode())
        stream.write(packed)
        stream.close()
        first = directory[0][0].encode()[:KEY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((first, name, at, len(packed)), _FILE.types)], schema=_FILE)

    return run


def write_index(captures: DataFrame, folder: str, *, block_lines: int = BLOCK_LINES, file_lines: int = FILE_LINES) -> list[tuple]:
    """Writes the sorted index into ``folder``; the list of its files with their first keys, at most
    ``MOST_FILES`` entries of about ``KEY_BYTES``.
    """
    lines = captures.count()
    files = min(MOST_FILES, max(1, math.ceil(lines / file_lines)))
    ordered = captures.repartitionByRange(files, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    _make(captures.sparkSession, folder)
    small_batches(captures.sparkSession)
    found = stored(ordered.mapInArrow(_indexer(folder, block_lines), FILE)).collect()
    return sorted((bytes(r["first"]), r["file"], r["offset"], r["length"]) for r in found)


class Reader:
    """Finds captures of keys. Keys are best asked in order: the last directory and block stay at hand."""

    def __init__(self, archive: str, index: str, files: list[tuple]):
        self.archive, self.index = _store(archive), _store(index)
        self.files, self.firsts = files, [f[0] for f in files]
        self.at_hand: dict = {}
        self.open: dict = {}

    def _range(self, store, name: str, offset: int, length: int) -> bytes:
        system, root = store
        handle = self.open.get((root, name))
        if handle is None:
            if len(self.open) >= 32:
                self.open.pop(next(iter(self.open))).close()
            handle = self.open[root, name] = system.open_input_file(f"{root}/{name}")
        handle.seek(offset)
        return handle.read(length)

    def _directory(self, number: int) -> list:
        if self.at_hand.get("file") != number:
            _, name, offset, length = self.files[number]
            held = json.loads(zlib.decompress(self._range(self.index, name, offset, length), 31))
            self.at_hand = {"file": number, "directory": held, "keys": [e[0].encode() for e in held]}
        return self.at_hand["directory"]

    def _block(self, number: int, block: int) -> tuple[list[bytes], list[str]]:
        _, offset, length = self._directory(number)[block]
        if self.at_hand.get("block") != block:
            lines = zlib.decompress(self._range(self.index, self.files[number][1], offset, length), 31).decode().split("\n")
            self.at_hand |= {"block": block, "lines": lines, "line_keys": [x.split("\t", 1)[0].encode() for x in lines]}
        return self.at_hand["line_keys"], self.at_hand["lines"]

    def captures(self, key: str) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of all captures of a key, from the last to the first."""
        asked = key.encode()
        number = bisect_right(self.firsts, asked) - 1
        while number >= 0:
            self._directory(number)
            block = bisect_right(self.at_hand["keys"], asked) - 1
            while block >= 0:
                keys, lines = self._block(number, block)
                at = bisect_right(keys, asked) - 1
                while at >= 0 and keys[at] == asked:
                    _, file, offset, length = lines[at].split("\t")
                    yield file, int(offset), int(length)
                    at -= 1
                if at >= 0:
                    return
                block -= 1
            number -= 1

    def read(self, file: str, offset: int, length: int) -> tuple:
        return parse(self._range(self.archive, file, offset, length))


def _looker(archive: str, index: str, files: list[tuple], payloads: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(archive, index, files)
        for batch in batches:
            rows = [reader.read(*found) for key in batch.column("key").to_pylist() for found in reader.captures(key)]
            if not payloads:
                rows = [(*r[:-1], None) for r in rows]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PAGE.types)], schema=_PAGE)

    return run


def look_up(keys: DataFrame, archive: str, index: str, files: list[tuple], *, payloads: bool = True) -> DataFrame:
    """The records of all captures of the distinct ``key`` rows, read by range; keys without a capture have none."""
    small_batches(keys.sparkSession)
    asked = keys.select("key").distinct()
    parts = max(1, min(MOST_FILES, 4 * len(files)), keys.sparkSession.sparkContext.defaultParallelism)
    ordered = asked.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(_looker(archive, index, files, payloads), PAGE)


def archive_and_read(pages: DataFrame, **options) -> DataFrame:
    """Archives the pages in the shared folder, indexes them, and reads each one back through the index."""
    root = f"{scratch_root(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    captures = write_archive(pages, f"{root}/archive", **options)
    files = write_index(captures, f"{root}/index")
    return look_up(captures, f"{root}/archive", f"{root}/index", files, payloads=False)
