"""WARC archives with a two-level capture index.

Archives hold a gzip member for each record. The first level of the index is a sorted table of
captures, keyed by the URL with its host reversed, cut into compressed blocks; the second is a
directory with the first key and the place of each block. A look-up searches the directory by
bisection, reads and opens the blocks that can hold its key, and reads the records' byte ranges.

Archives, blocks and directories are files below one folder that all executors reach through
``pyarrow.fs``: a local shared folder, HDFS or an object store, by URI. A task writes to files named
after its attempt, and only what a successful attempt returns is ever referred to.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyflow.llm.shared import ship_package, stored
from levyflow.sources.scratch import scratch_path

# Payloads below this size are never revisits.
REVISIT_BYTES = 100
# Captures of an index block.
BLOCK_LINES = 2000
# An archive file is closed when it has grown to this.
ARCHIVE_BYTES = 1 << 30
# Range reads of one archive that are at most this far apart are one read.
READ_GAP, READ_BYTES = 64 * 1024, 8 * 1024**2
_DATE = "2024-01-01T00:00:00Z"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """The URL with its host reversed and lower-cased: ``com,example,blog)/path?query``.

    Scheme, port, user, fragment and a leading ``www.`` do not count. Text without a host keeps its form.
    """
    text = (url or "").strip()
    try:
        parts = urlsplit(text if "//" in text else f"//{text}")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        host = ""
    if not host:
        return text
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


# --- records ---


def _record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, length: int,
            refers_to: int | None) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: text/html; charset=utf-8"]
    if url is not None:
        # Header lines end at a line break: URLs are quoted as JSON text where they hold one.
        plain = not re.search(r"[\x00-\x1f\x7f]", url) and url == url.strip() and not url.startswith('"')
        head.append(f"WARC-Target-URI: {url if plain else json.dumps(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(payload)}")
    body = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"
    return gzip.compress(body, compresslevel=6, mtime=0)


@dataclass
class Record:
    kind: str
    page_id: int | None
    url: str | None
    payload: bytes
    digest: str
    refers_to: int | None


def parse_record(member: bytes) -> Record:
    """A record from its gzip member."""
    head, _, rest = zlib.decompress(member, wbits=31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])]
    url = fields.get("WARC-Target-URI")
    return Record(
        fields["WARC-Type"], _page(fields["WARC-Record-ID"]), json.loads(url) if url and url[0] == '"' else url,
        payload, fields["WARC-Payload-Digest"].removeprefix("sha256:"), _page(fields.get("WARC-Refers-To")),
    )


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


# --- storage ---

# Hadoop's names of schemes that pyarrow has under another one.
SAME_SCHEME = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
Opener = Callable[[str], tuple[fs.FileSystem, str]]


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The store and path of a Hadoop URI. Credentials are those that pyarrow finds on the executor."""
    scheme, colon, rest = folder.partition("://")
    uri = SAME_SCHEME.get(scheme.lower(), scheme) + colon + rest
    try:
        return fs.FileSystem.from_uri(uri)
    except (ValueError, NotImplementedError, OSError) as error:
        raise ValueError(f"pyarrow cannot open {folder}: give an opener for its scheme ({error})") from error


# --- writing ---

_CAPTURE = "url_key string, page_id long, file string, start long, length long"


def with_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Adds ``refers_to``: for payloads of at least ``least_bytes`` that a smaller page has too, that page.

    Only digests that occur more than once are looked up, one row for each; digests of a third of all
    pages are split by adaptive execution, as the look-up is a plain join.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("large", F.length("payload") >= least_bytes)
    slim = pages.select("page_id", payload.alias("payload")).where(F.length("payload") >= least_bytes)
    first = (
        slim.groupBy(F.sha2("payload", 256).alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null").select("digest", "first")
    )
    found = rows.join(first, "digest", "left")
    revisit = F.col("large") & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, opener: Opener = open_folder) -> DataFrame:
    """Write a record for every row of ``with_revisits``; returns the stored captures, unsorted."""
    ship_package(pages.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opener(folder)
        name = out = None
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or out.tell() >= ARCHIVE_BYTES:
                    if out:
                        out.close()
                    name = f"archive-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                kind = "response" if refers_to is None else "revisit"
                body = payload if refers_to is None else b""
                member = _record(kind, page_id, url, body, digest, len(payload), refers_to)
                rows.append((url_key(url), page_id, name, out.tell(), len(member)))
                out.write(member)
            yield _batch(rows, _CAPTURE_TYPES)
        if out:
            out.close()

    return stored(pages.mapInArrow(work, _CAPTURE), "captures")


_CAPTURE_TYPES = pa.schema([
    ("url_key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


# --- index ---


@dataclass(frozen=True)
class CaptureIndex:
    """A written index. ``parts`` has a row for each index file: ``part, first_key, last_key, blocks,
    directory``, by key; there are as many as tasks wrote the index."""

    folder: str
    parts: DataFrame
    opener: Opener = open_folder


def build_index(
    captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES, opener: Opener = open_folder
) -> CaptureIndex:
    """Sort the captures by key and page, and write each range's blocks and their directory.

    The sort includes the page, so that a URL with very many captures spans several files.
    """
    ship_package(captures.sparkSession)
    schema = pa.schema([("part", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()), ("blocks", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opener(folder)
        name, directory, first, last = f"index-{uuid.uuid4().hex}", [], None, None
        out = None
        for lines in _blocks(batches, block_lines):
            out = out or store.open_output_stream(f"{root}/{name}.gz", compression=None)
            block = gzip.compress("".join(lines).encode("utf-8", "surrogatepass"), mtime=0)
            first_key, last_key = _key_of(lines[0]), _key_of(lines[-1])
            directory.append(json.dumps([first_key, last_key, out.tell(), len(block)]))
            out.write(block)
            first, last = (first_key if first is None else first), last_key
        if out:
            out.close()
            with store.open_output_stream(f"{root}/{name}.dir", compression=None) as listing:
                listing.write("\n".join(directory).encode("utf-8", "surrogatepass"))
            yield _batch([(name, first, last, len(directory))], schema)

    ordered = captures.repartitionByRange("url_key", "page_id", "file", "start").sortWithinPartitions(
        "url_key", "page_id", "file", "start")
    kind = "part string, first_key string, last_key string, blocks long"
    return CaptureIndex(folder, stored(ordered.mapInArrow(work, kind), "index_parts"), opener)


def _blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[list[str]]:
    lines: list[str] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            lines.append(json.dumps(row) + "\n")
            if len(lines) == size:
                yield lines
                lines = []
    if lines:
        yield lines


def _key_of(line: str) -> str:
    return json.loads(line)[0]


def look_up(index: CaptureIndex, keys: DataFrame, url_key_column: str = "url_key") -> DataFrame:
    """``url_key, page_id, file, start, length`` of all captures of each key of ``keys``, once for a key.

    Keys are sent to the index files whose range holds them. There, each key is searched in the file's
    directory, and the blocks that can hold it are read and opened once, in order.
    """
    spark = keys.sparkSession
    ship_package(spark)
    # A row for each index file, as many as there were tasks: the top of the search.
    parts = index.parts.orderBy("first_key", "last_key", "part").toArrow()
    names = parts.column("part").to_pylist()
    firsts, lasts = (parts.column(c).to_pylist() for c in ("first_key", "last_key"))
    bounds = spark.sparkContext.broadcast((names, firsts, lasts))
    wanted = keys.select(F.col(url_key_column).alias("url_key")).where("url_key is not null").distinct()
    sent = wanted.mapInArrow(lambda batches: _send(batches, bounds), "url_key string, part string")
    folder, opener = index.folder, index.opener

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opener(folder)
        part, reader = None, None
        for batch in batches:
            rows = []
            for key, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != part:
                    part, reader = name, _IndexFile(store, f"{root}/{name}")
                rows += [r for r in reader.find(key)]
                if len(rows) >= 10_000:
                    yield _batch(rows, _CAPTURE_TYPES)
                    rows = []
            yield _batch(rows, _CAPTURE_TYPES)

    return sent.repartition("part").sortWithinPartitions("part", "url_key").mapInArrow(search, _CAPTURE)


def _send(batches: Iterator[pa.RecordBatch], bounds) -> Iterator[pa.RecordBatch]:
    names, firsts, lasts = bounds.value
    for batch in batches:
        rows = []
        for key in batch.column(0).to_pylist():
            # Files are sorted by range; those of a key that spans several are neighbours.
            rows += [(key, n) for n in names[bisect_left(lasts, key) : bisect_right(firsts, key)]]
        yield _batch(rows, pa.schema([("url_key", pa.string()), ("part", pa.string())]))


class _IndexFile:
    """Looks up rising keys; holds one block."""

    def __init__(self, store: fs.FileSystem, path: str):
        with store.open_input_stream(f"{path}.dir", compression=None) as listing:
            lines = listing.read().decode("utf-8", "surrogatepass").split("\n")
        self.firsts, self.lasts, self.starts, self.lengths = zip(*map(json.loads, lines))
        self.file = store.open_input_file(f"{path}.gz")
        self.block, self.rows, self.keys = None, [], []

    def find(self, key: str) -> Iterator[tuple]:
        for block in range(bisect_left(self.lasts, key), bisect_right(self.firsts, key)):
            if block != self.block:
                self.file.seek(self.starts[block])
                text = zlib.decompress(self.file.read(self.lengths[block]), wbits=31).decode("utf-8", "surrogatepass")
                self.rows = [tuple(json.loads(line)) for line in text.split("\n") if line]
                self.block, self.keys = block, [r[0] for r in self.rows]
            yield from self.rows[bisect_left(self.keys, key) : bisect_right(self.keys, key)]


# --- reading ---


def read_records(captures: DataFrame, folder: str, opener: Opener = open_folder) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` of each capture's record,
    from range reads of its archive. The last two come from the payload itself; a revisit has none, so
    there they are null and the digest its header names is in ``named_digest``."""
    ship_package(captures.sparkSession)
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("named_digest", pa.string()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opener(folder)
        name, file = None, None
        for batch in batches:
            places = list(zip(*[batch.column(c).to_pylist() for c in ("file", "start", "length")]))
            rows = []
            for run in _runs(places):
                if run[0][0] != name:
                    name, file = run[0][0], store.open_input_file(f"{root}/{run[0][0]}")
                at = run[0][1]
                file.seek(at)
                chunk = file.read(run[-1][1] + run[-1][2] - at)
                for _, start, length in run:
                    r = parse_record(chunk[start - at : start - at + length])
                    full = r.kind == "response"
                    rows.append((r.page_id, r.url, r.kind, r.refers_to, len(r.payload) if full else None,
                                 hashlib.sha256(r.payload).hexdigest() if full else None, r.digest))
            yield _batch(rows, schema)

    ordered = captures.repartitionByRange("file", "start").sortWithinPartitions("file", "start")
    return ordered.mapInArrow(
        work,
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string,"
        " named_digest string",
    )


def _runs(places: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Neighbouring byte ranges of one archive, to be read at once."""
    run: list[tuple[str, int, int]] = []
    for place in places:
        if run and not (place[0] == run[0][0] and 0 <= place[1] - run[-1][1] - run[-1][2] <= READ_GAP
                        and place[1] + place[2] - run[0][1] <= READ_BYTES):
            yield run
            run = []
        run.append(place)
    if run:
        yield run


def resolve(records: DataFrame) -> DataFrame:
    """Give revisits the size and digest of the payload of the response they name."""
    responses = records.where("record_type = 'response'")
    full = responses.select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("named_digest"),
        F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d"),
    ).where("refers_to is not null").distinct()
    revisits = records.where("record_type = 'revisit'").join(full, ["refers_to", "named_digest"], "left")
    columns = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")
    return responses.select(*columns).union(
        revisits.withColumn("payload_bytes", F.col("n")).withColumn("payload_digest", F.col("d")).select(*columns))


def archive_round_trip(
    spark: SparkSession, pages: DataFrame, folder: str | None = None, least_bytes: int = REVISIT_BYTES,
    block_lines: int = BLOCK_LINES, opener: Opener = open_folder,
) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as archives with an index, and read every record back
    through the index.

    Returns ``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` for every row. A null
    html is an empty payload. A null url is indexed under the empty key. A row with a null page id never
    is the page that others revisit. Rows that repeat the id of the page that others revisit, with the same payload,
    are responses too. An empty table gives no rows. Other columns are not read.

    ``folder`` is a Hadoop URI; archives in it are opened by ``opener``, on the executors, as Spark itself has no
    writer of such files. One that it cannot open is an error before anything is written.
    """
    folder = folder or scratch_path(spark, "archives")
    opener(folder)
    captures = write_archives(with_revisits(pages, least_bytes), folder, opener)
    index = build_index(captures, folder, block_lines, opener)
    found = look_up(index, captures.select("url_key"))
    return resolve(stored(read_records(found, folder, opener), "records"))
