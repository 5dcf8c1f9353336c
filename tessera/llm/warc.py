"""WARC archives of pages and a two-level capture index over them.

Writing: of equal payloads the capture with the largest id becomes the response and the others revisits of it. Tasks write gzip-membered WARC files into the shared folder, under a name of the attempt's
own, and return where each record lies; these rows are written as a table at once, so a lost executor never leads to a
second set of files being used.

Index: captures are range-sorted by reversed-host key and id, and each task writes one index file: compressed blocks of
``BLOCK_LINES`` lines, then its sparse directory, the first key and the place of each block. The upper level is the list
of index files with their first keys, one entry for about ``FILE_LINES`` captures.

Reading: requests are sorted the same way; for each, the upper level and the directory are searched by bisection, the
block is read by its range and searched by bisection, and the record is read by its range in the archive. A revisit is
resolved through the same index to the record that it refers to. Files are reached through pyarrow's file systems, by the path as Spark
resolves it, so the shared folder may be any store that both know.

Defined cases: a null html is an empty payload; a null url has an empty key and no target line; control characters and white space in a
url are percent-encoded; a null id is archived with an empty id and comes back as null; rows that repeat an id and a url give one
record each, and a revisit has the size of the response with its own digest; an empty table gives no rows; other columns are ignored. Payloads smaller than ``least`` bytes are all responses. Of equal payloads without any id all
are responses; a very long payload is one record, held whole by the task that writes or reads it.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discard, qualified
from .common import new_path, partitions_for, slices, text_bytes, written

BLOCK_LINES = 1_000
FILE_LINES = 50_000
ROLL_BYTES = 256 << 20
MOST_HOT = 200_000
#: Record header lines of WARC 1.1.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def clean_url(url: str | None) -> str:
    """The url without control characters and white space."""
    return re.sub(r"[\x00-\x20\x7f\u0085   ]", lambda m: quote(m[0]), url or "")


def reversed_host_key(url: str | None) -> str:
    """com,example,www)/path?query: hosts of one domain sort together."""
    url = clean_url(url)
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url.lower()
    scheme_port = {"http": 80, "https": 443}.get(parts.scheme)
    shown = f":{port}" if port and port != scheme_port else ""
    return ",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(kind: str, page_id: int | None, url: str, payload: bytes, payload_digest: str, refers_to: int | None, refers_url: str) -> bytes:
    """One record as a gzip member."""
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{payload_digest}", f"Page-ID: {'' if page_id is None else page_id}"]
    if url:
        lines.append(f"WARC-Target-URI: {url}")
    body = HTTP_HEAD
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
        if refers_url:
            lines.append(f"WARC-Refers-To-Target-URI: {refers_url}")
    else:
        body += payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    press = zlib.compressobj(1, wbits=31)
    return press.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + press.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of a gzip member."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _digests(pages: DataFrame) -> DataFrame:
    """pages with the clean url, the payload and its digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            payloads = text_bytes(batch.column("html"))
            digests = [digest(p or b"") for p in payloads]
            urls = [clean_url(u) for u in batch.column("url").to_pylist()]
            columns = [batch.column("page_id").cast(pa.int64()), pa.array(urls, pa.string()), pa.array(payloads, pa.binary()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "payload", "payload_digest"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, payload binary, payload_digest string")


def decide(pages: DataFrame, least: int = 0, most_hot: int = MOST_HOT) -> DataFrame:
    """pages (page_id, url, html) with payload_digest, and winner and winner_url, the capture that equal payloads refer to.

    Winners come from a table without payloads. Those of frequent digests, at most `most_hot`, are sent to the tasks: their captures aren't
    shuffled, and only the winner keeps its payload. The others are joined by digest.
    """
    read = _digests(pages)
    best = read.where(F.coalesce(F.octet_length("payload"), F.lit(0)) >= least).groupBy("payload_digest").agg(F.max(F.struct("page_id", "url")).alias("w"), F.count("*").alias("n"))
    best = written(best.select("payload_digest", F.col("w.page_id").alias("winner"), F.col("w.url").alias("winner_url"), "n"), "winners")
    total = best.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") > max(100, total // most_hot)
    hot = best.where(frequent).drop("n").withColumn("hot", F.lit(True))
    marked = read.join(F.broadcast(hot), "payload_digest", "left")
    own = F.col("winner").isNull() | F.col("winner").eqNullSafe(F.col("page_id"))
    kept = ("page_id", "url", "payload", "payload_digest", "winner", "winner_url")
    ready = marked.where("hot").withColumn("payload", F.when(own, F.col("payload"))).select(*kept)
    rest = marked.where("hot IS NULL").drop("winner", "winner_url", "hot").join(best.where(~frequent).drop("n"), "payload_digest", "left").select(*kept)
    return ready.unionByName(rest)


def write_archives(decided: DataFrame, folder: str) -> DataFrame:
    """Writes the records; (key, page_id, archive, offset, length) of each, as a table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        out, name, offset = None, "", 0
        try:
            for batch in slices(batches, "payload"):
                rows: list[list] = [[], [], [], [], []]
                for page_id, url, payload, sha, winner, winner_url in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "payload_digest", "winner", "winner_url")), strict=True):
                    if out is None or offset >= ROLL_BYTES:
                        if out:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    kind = "response" if winner is None or winner == page_id else "revisit"
                    member = record(kind, page_id, url, payload or b"", sha, winner, winner_url or "")
                    out.write(member)
                    for column, value in zip(rows, (reversed_host_key(url), page_id, name, offset, len(member)), strict=True):
                        column.append(value)
                    offset += len(member)
                columns = [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "page_id", "archive", "offset", "length"])
        finally:
            if out:
                out.close()

    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    return written(decided.mapInArrow(run, "key string, page_id bigint, archive string, offset bigint, length bigint"), "captures")


def _sort_key(key: str, page_id: int | None) -> str:
    """Keys in byte order, then ids in number order, nulls first."""
    return f"{key} {'' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def write_index(captures: DataFrame, folder: str, parts: int) -> list[tuple[str, str]]:
    """Writes index files; (first key, file), ascending: one entry for each file."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        name, directory, block, offset, out = f"{uuid.uuid4().hex}.cdx", [], [], 0, None

        def flush() -> None:
            nonlocal offset, block
            data = zlib.compress("\n".join(block).encode(), 6)
            out.write(data)
            directory.append([block[0].split("\t")[0], offset, len(data)])
            offset, block = offset + len(data), []

        for batch in batches:
            for sort_key, page_id, archive, at, length in zip(*(batch.column(c).to_pylist() for c in ("sort_key", "page_id", "archive", "offset", "length")), strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                block.append(f"{sort_key}\t{'' if page_id is None else page_id}\t{archive}\t{at}\t{length}")
                if len(block) == BLOCK_LINES:
                    flush()
        if out is not None:
            if block:
                flush()
            tail = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(tail + len(tail).to_bytes(8, "big"))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], names=["first", "file"])

    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    keyed = captures.withColumn("sort_key", sort_key_column())
    files = keyed.repartitionByRange(parts, "sort_key").sortWithinPartitions("sort_key").mapInArrow(run, "first string, file string")
    return sorted((r["first"], r["file"]) for r in files.collect())  # one row for each index file


def sort_key_column():
    number = F.lpad((F.col("page_id").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat("key", F.lit(" "), F.coalesce(number, F.lit("")))


class Reader:
    """Looks captures up in index files and reads their records. Holds a few open files, directories and blocks."""

    def __init__(self, index: list[tuple[str, str]], index_folder: str, archive_folder: str, most: int = 8):
        self.index, self.firsts, self.most = index, [f for f, _ in index], most
        self.index_fs, self.index_root = file_system(index_folder)
        self.archive_fs, self.archive_root = file_system(archive_folder)
        self.kept: OrderedDict = OrderedDict()

    def _held(self, key, make):
        if key not in self.kept:
            if len(self.kept) >= 4 * self.most:
                old = self.kept.popitem(last=False)[1]
                if hasattr(old, "close"):
                    old.close()
            self.kept[key] = make()
        self.kept.move_to_end(key)
        return self.kept[key]

    def _range(self, fs, path: str, offset: int, length: int) -> bytes:
        return self._held(path, lambda: fs.open_input_file(path)).read_at(length, offset)

    def _directory(self, path: str) -> tuple[list[str], list[tuple[int, int]]]:
        size = self._held(path, lambda: self.index_fs.open_input_file(path)).size()
        n = int.from_bytes(self._range(self.index_fs, path, size - 8, 8), "big")
        rows = json.loads(zlib.decompress(self._range(self.index_fs, path, size - 8 - n, n)))
        return [r[0] for r in rows], [(r[1], r[2]) for r in rows]

    def lookup(self, key: str) -> list[list[str]]:
        """The captures of a sort key: two bisections, one block read. A key that spans blocks or files is followed back."""
        found: list[list[str]] = []
        k = bisect_right(self.firsts, key) - 1
        while k >= 0:
            path = f"{self.index_root}/{self.index[k][1]}"
            firsts, places = self._held(("directory", path), lambda p=path: self._directory(p))
            b = bisect_right(firsts, key) - 1
            while b >= 0:
                offset, length = places[b]
                lines = self._held(("block", path, b), lambda p=path, o=offset, n=length: [x.split("\t") for x in zlib.decompress(self._range(self.index_fs, p, o, n)).decode().split("\n")])
                i = bisect_right(lines, key, key=lambda x: x[0])
                while i and lines[i - 1][0] == key:
                    i -= 1
                    found.append(lines[i])
                if i or firsts[b] != key:
                    return found
                b -= 1
            k -= 1
        return found

    def read(self, line: list[str]) -> tuple[dict[str, str], bytes]:
        _, _, archive, offset, length = line
        return parse(self._range(self.archive_fs, f"{self.archive_root}/{archive}", int(offset), int(length)))


_ROW = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_back(pages: DataFrame, index: list[tuple[str, str]], index_folder: str, archive_folder: str, parts: int) -> DataFrame:
    """One row for each archived capture of pages (page_id, url), read through the index."""

    held = pages.sparkSession.sparkContext.broadcast(index)  # one entry for each index file

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value, index_folder, archive_folder)
        sizes: dict[tuple[str, str], int] = {}

        def size_of(key: str, sha: str) -> int:
            """Bytes of the response of that key with that digest: a page id and a url may have several payloads."""
            if (key, sha) not in sizes:
                if len(sizes) > 100_000:
                    sizes.clear()
                found = (len(p) for f, p in map(reader.read, reader.lookup(key)) if f["WARC-Type"] == "response" and f["WARC-Payload-Digest"] == sha)
                if (n := next(found, None)) is None:
                    raise ValueError(f"no response {sha} at {key}")
                sizes[key, sha] = n
            return sizes[key, sha]

        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for key in batch.column("sort_key").to_pylist():
                for line in reader.lookup(key):
                    fields, payload = reader.read(line)
                    page_id = int(line[1]) if line[1] else None
                    if fields["WARC-Type"] == "revisit":
                        to = int(fields["Refers-To-Page-ID"])
                        n = size_of(_sort_key(reversed_host_key(fields.get("WARC-Refers-To-Target-URI")), to), fields["WARC-Payload-Digest"])
                        values = (page_id, n, fields["WARC-Payload-Digest"].removeprefix("sha1:"), "revisit", to)
                    else:
                        values = (page_id, len(payload), digest(payload), "response", None)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([reversed_host_key(u) for u in batch.column("url").to_pylist()], pa.string()), batch.column("page_id").cast(pa.int64())], names=["key", "page_id"])

    asked = pages.select("url", "page_id").mapInArrow(keys, "key string, page_id bigint").select(sort_key_column().alias("sort_key")).distinct()
    return asked.repartitionByRange(parts, "sort_key").sortWithinPartitions("sort_key").mapInArrow(run, _ROW)


def archive(pages: DataFrame, least: int = 0) -> tuple[list[tuple[str, str]], str, str, int]:
    """Writes archives and index of pages; (upper index level, index folder, archive folder, captures)."""
    spark = pages.sparkSession
    archives, index_folder = (qualified(spark, new_path(spark, name)) for name in ("warc", "cdx"))
    captures = write_archives(decide(pages, least), archives)
    n = captures.count()
    index = write_index(captures, index_folder, max(1, -(-n // FILE_LINES)))
    discard(captures)
    return index, index_folder, archives, n


def archive_and_read(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives every page, then reads every capture back through the index."""
    index, index_folder, archives, n = archive(pages, least)
    return read_back(pages, index, index_folder, archives, partitions_for(pages.sparkSession, n, 20_000))


def oracle() -> str:
    """DuckDB SQL for the rows of query op3. Five hexadecimal digits are four of base 32."""
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({v} >> {s}) & 31) + 1, 1)"
    group = "CAST('0x' || substr(h, {at}, 5) AS INTEGER)"
    digits = " || ".join(letter.format(v=group.format(at=5 * g + 1), s=s) for g in range(8) for s in (15, 10, 5, 0))
    return f"""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS w FROM p)
    SELECT page_id, payload_bytes, {digits} AS payload_digest, CASE WHEN page_id = w THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> w THEN w END AS refers_to
    FROM h"""
