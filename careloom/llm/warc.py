"""Web archives of pages with a two-level capture index: sorted blocks of captures, and a directory of their first keys."""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.llm.runtime import ddl_type, prepare, stage
from careloom.llm.url_graph import host_of

# payloads of fewer bytes are written each time
MIN_REVISIT_BYTES = 100
# an archive of this size is closed, and the next one begun
ARCHIVE_BYTES = 64 << 20
# captures of one compressed block of the index
BLOCK_CAPTURES = 1000
# captures in a row that are read with one request, up to this many bytes
READ_BYTES = 4 << 20
# archives whose first and last keys one broadcast holds
ROOT_ARCHIVES = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column | str) -> Column:
    """The URL with its host reversed, ``com,example,www)/path?query``, so that a site's pages stand together; a null URL has ``)``."""
    url = F.col(url) if isinstance(url, str) else url
    host = host_of(url)
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    turned = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.concat(turned, F.lit(")"), rest)).otherwise(F.concat(F.lit(")"), url)), F.lit(")"))


def _record_id(digest: str, page: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest} {page}')}>"


def _header_value(text: str) -> str:
    """Text as a header can hold it: white space, control characters and all beyond ASCII as percent codes."""
    return quote(text, safe="".join(map(chr, range(0x21, 0x7F))))


def record(url: str | None, page: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A WARC record as a gzip member of its own: a response, or a revisit without the payload that names the response."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(digest, page) if not revisit else _record_id(digest, f'{page} {refers_to}')}"]
    lines += [f"WARC-Date: {date}", f"WARC-Target-URI: {_header_value(url or '')}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_record_id(digest, refers_to)}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {_header_value(refers_to)}"]
    if page is not None:
        lines.append(f"X-Page: {_header_value(page)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of a record, headers of its response, and the payload that it holds."""
    raw = zlib.decompress(member, 31)
    head, _, body = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    length = int(headers["Content-Length"])
    if body[length:] != b"\r\n\r\n":
        raise ValueError("a record is longer or shorter than it says")
    http, _, payload = body[:length].partition(b"\r\n\r\n")
    return headers, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


class Archive:
    """An archive that is being written, and its index: blocks of captures by key, the blocks' directory at the end."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self.files, at = fs.FileSystem.from_uri(self.path)
        self.out = self.files.open_output_stream(at, compression=None)
        self.index = self.files.open_output_stream(index_of(at), compression=None)
        self.size, self.captures, self.block, self.directory, self.indexed = 0, 0, [], [], 0
        self.first = self.last = b""

    def add(self, key: bytes, member: bytes, capture: dict) -> None:
        if not self.captures:
            self.first = key
        self.last = key
        self.block.append((key, capture | {"offset": self.size, "length": len(member)}))
        self.out.write(member)
        self.size += len(member)
        self.captures += 1
        if len(self.block) >= BLOCK_CAPTURES:
            self._end_block()

    def _end_block(self) -> None:
        packed = gzip.compress("\n".join(json.dumps([key.decode(), capture]) for key, capture in self.block).encode(), 6, mtime=0)
        self.directory.append([self.block[0][0].decode(), self.indexed, len(packed)])
        self.index.write(packed)
        self.indexed += len(packed)
        self.block = []

    def close(self) -> tuple:
        if self.block:
            self._end_block()
        packed = gzip.compress(json.dumps(self.directory).encode(), 6, mtime=0)
        self.index.write(packed + len(packed).to_bytes(8, "big"))
        self.index.close()
        self.out.close()
        return self.path, self.first, self.last, self.captures


def index_of(path: str) -> str:
    return path.removesuffix(".warc.gz") + ".cdx"


class Reader:
    """Captures of an archive by key: binary search in the directory, then ranges of the index and of the archive."""

    def __init__(self, path: str):
        files, at = fs.FileSystem.from_uri(path)
        self.archive, self.index = files.open_input_file(at), files.open_input_file(index_of(at))
        size = self.index.size()
        length = int.from_bytes(self.index.read_at(8, size - 8), "big")
        self.directory = json.loads(gzip.decompress(self.index.read_at(length, size - 8 - length)))
        self.firsts = [d[0].encode() for d in self.directory]
        self.held: tuple[int, list, list] = (-1, [], [])

    def _block(self, number: int) -> tuple[list[bytes], list]:
        if self.held[0] != number:
            _, offset, length = self.directory[number]
            lines = [json.loads(line) for line in gzip.decompress(self.index.read_at(length, offset)).split(b"\n")]
            self.held = number, [key.encode() for key, _ in lines], [capture for _, capture in lines]
        return self.held[1:]

    def find(self, key: bytes) -> Iterator[dict]:
        """Captures of a key; those of one key may go on in the next blocks."""
        # the first of the key's captures may end the block before the first one that begins with it
        number = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while number < len(self.directory) and self.firsts[number] <= key:
            keys, captures = self._block(number)
            yield from captures[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
            number += 1

    def members(self, captures: Iterator[dict]) -> Iterator[tuple[dict, bytes]]:
        """Captures with their records; neighbours are read in one go."""
        run: list[dict] = []
        for capture in captures:
            if run and (run[-1]["offset"] + run[-1]["length"] != capture["offset"] or capture["offset"] + capture["length"] - run[0]["offset"] > READ_BYTES):
                yield from self._run(run)
                run = []
            run.append(capture)
        if run:
            yield from self._run(run)

    def _run(self, run: list[dict]) -> Iterator[tuple[dict, bytes]]:
        begin = run[0]["offset"]
        held = self.archive.read_at(run[-1]["offset"] + run[-1]["length"] - begin, begin)
        for capture in run:
            yield capture, held[capture["offset"] - begin : capture["offset"] - begin + capture["length"]]

    def close(self) -> None:
        self.archive.close()
        self.index.close()


def _first_pages(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``(digest, first)`` of the payloads that several pages have: the smallest id."""
    large = pages.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    return large.where("n > 1").select("digest", "first")


def write_archives(
    pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write a record for every row to archives below ``folder``; what comes back lists them: ``(archive, first_key, last_key, captures)``.

    The payload is the page in UTF-8, empty for null.  Of equal payloads of ``min_revisit_bytes`` and more, by SHA-256,
    the row with the smallest id is a response and the others are revisits that refer to it; all smaller ones, and those
    that only rows without an id have, are responses.  Rows that repeat that smallest id are responses each.

    Pages are dealt by ranges of their key (``url_key``) and id, so that a site of any size is spread, and each task
    writes its range in order: an archive of one gzip member a record, closed at ``ARCHIVE_BYTES``, and beside it the
    index of its captures in blocks of ``BLOCK_CAPTURES``, which ends in a directory of the blocks' first keys.  Files
    have new names in each attempt and count only if the list names them, so a task that is run again does no harm.

    ``folder`` must be one that all executors see.  Null urls have the key ``)``; an empty table gives an empty list;
    other columns are not looked at.
    """
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("page"), url.alias("url"), url_key(url).cast("binary").alias("key"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    first = stage(_first_pages(rows, min_revisit_bytes), "first-pages")
    refers = F.when((F.col("first") != F.col("page")) | (F.col("first").isNotNull() & F.col("page").isNull()), F.col("first"))
    rows = rows.join(first, "digest", "left").select("key", "page", F.col("page").cast("string").alias("id"), "url", "payload", "digest", refers.cast("string").alias("refers"))
    dealt = rows.repartitionByRange("key", F.asc_nulls_last("page")).sortWithinPartitions("key", F.asc_nulls_last("page")).drop("page")
    folder = _with_scheme(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, archive = [], None
        for batch in batches:
            for key, page, link, body, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    archive = Archive(folder)
                capture = {"url": link, "page": page, "digest": digest, "refers": refers_to}
                archive.add(key, record(link, page, body, digest, refers_to, date), capture)
                if archive.size >= ARCHIVE_BYTES:
                    made.append(archive.close())
                    archive = None
        if archive is not None:
            made.append(archive.close())
        kinds = (pa.string(), pa.binary(), pa.binary(), pa.int64())
        columns = [pa.array(list(c), t) for c, t in zip(zip(*made), kinds)] if made else [pa.array([], t) for t in kinds]
        yield pa.RecordBatch.from_arrays(columns, ["archive", "first_key", "last_key", "captures"])

    _make_folder(pages, folder)
    return stage(dealt.mapInArrow(write, "archive STRING, first_key BINARY, last_key BINARY, captures BIGINT"), "archives")


def _with_scheme(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{posixpath.abspath(folder)}"


def _make_folder(df: DataFrame, folder: str) -> None:
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


def lookup(urls: DataFrame, archives: DataFrame, id_type: str, url_col: str = "url") -> DataFrame:
    """Captures of the URLs with the given keys, read from the archives: ``(page, url, payload, payload_bytes, payload_digest, record_type, refers_to)``.

    Keys are looked up once each.  The archives' first and last keys, in broadcasts of ``ROOT_ARCHIVES``, tell which of
    them can hold a key; there it is searched for in the directory of the index, whose block gives the ranges of the
    archive to read.  A response's digest and size are those of the payload that was read; a revisit has none, so it
    gives those in its record.  Keys without captures and an empty list give no rows.
    """
    spark = prepare(urls.sparkSession)
    keys = urls.select(url_key(F.col(f"`{url_col}`").cast("string")).cast("binary").alias("key")).distinct()
    number = F.floor((F.monotonically_increasing_id() % (1 << 33)) / ROOT_ARCHIVES)
    total = archives.count()
    roots = -(-total // ROOT_ARCHIVES)
    archives = stage(archives.withColumn("root", number if roots > 1 else F.lit(0)), "roots") if roots > 1 else archives.withColumn("root", F.lit(0))
    out = None
    for root in [r["root"] for r in archives.select("root").distinct().collect()]:
        known = sorted((bytes(r["first_key"]), bytes(r["last_key"]), r["archive"]) for r in archives.where(F.col("root") == root).collect())
        part = _lookup(keys, spark.sparkContext.broadcast(known), id_type)
        out = part if out is None else out.unionByName(part)
    schema = f"page {id_type}, url STRING, payload BINARY, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to {id_type}"
    return spark.createDataFrame([], schema) if out is None else out


def _lookup(keys: DataFrame, known: Any, id_type: str) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys with the archives that can hold them: of sorted ranges, those that begin before the key and do not end before it."""
        firsts = [k[0] for k in known.value]
        # the ranges of one write overlap in a shared key only, but those of several writes may overlap at will
        ends: list[bytes] = []
        for _, last, _ in known.value:
            ends.append(max(last, ends[-1]) if ends else last)
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                k = bisect.bisect_right(firsts, key) - 1
                while k >= 0 and ends[k] >= key:
                    if known.value[k][1] >= key:
                        found.append((key, known.value[k][2]))
                    k -= 1
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], ["key", "archive"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, reader = None, None
        for batch in batches:
            asked = list(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()))
            at = 0
            while at < len(asked):
                if asked[at][0] != path:
                    if reader:
                        reader.close()
                    path = asked[at][0]
                    reader = Reader(path)
                end = at
                while end < len(asked) and asked[end][0] == path:
                    end += 1
                wanted = (capture for _, key in asked[at:end] for capture in reader.find(key))
                yield from _rows(reader.members(wanted))
                at = end
        if reader:
            reader.close()

    placed = keys.mapInArrow(place, "key BINARY, archive STRING")
    dealt = placed.repartition("archive", F.pmod(F.xxhash64(F.substring("key", 1, 24)), F.lit(16))).sortWithinPartitions("archive", "key")
    found = dealt.mapInArrow(read, "page STRING, url STRING, payload BINARY, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to STRING")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page", "refers_to")})


def _rows(members: Iterator[tuple[dict, bytes]]) -> Iterator[pa.RecordBatch]:
    """Records in batches of bounded size."""
    made, size = [], 0
    for capture, member in members:
        headers, http, payload = parse(member)
        response = headers["WARC-Type"] == "response"
        digest = hashlib.sha256(payload).hexdigest() if response else headers["WARC-Payload-Digest"].removeprefix("sha256:")
        if digest != capture["digest"]:
            raise ValueError(f"the record at {capture['offset']} is not the one that the index names")
        length = len(payload) if response else int(http["Content-Length"])
        made.append((capture["page"], capture["url"], payload if response else None, length, digest, headers["WARC-Type"], capture["refers"]))
        size += len(payload)
        if size >= READ_BYTES or len(made) >= 256:
            yield _batch(made)
            made, size = [], 0
    if made:
        yield _batch(made)


def _batch(made: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = ["page", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), kinds)], names)


def archive_pages(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows to archives and read them back by their keys, as ``lookup`` gives them with the id under its own name."""
    archives = write_archives(pages, folder, min_revisit_bytes, id_col=id_col, url_col=url_col, html_col=html_col)
    return lookup(pages, archives, ddl_type(pages, id_col), url_col).withColumnRenamed("page", id_col)
