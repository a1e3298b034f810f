"""WARC archives with a two-level capture index.

Each task writes one archive of separately compressed records and reports where they lie. The
captures are then sorted by reversed-host URL key over all tasks and cut into compressed index
blocks; a sparse directory holds the first key of every block. A lookup binary-searches the
directory, reads the blocks that can hold its key by range, and reads the records by range.

Archives and index go to a folder that pyarrow's file systems reach from every executor
(local or mounted paths, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowise.plans.sizing import broadcast_if_small
from kilowise.plans.storage import materialize, work_dir

DATE = "2024-01-01T00:00:00Z"  # crawl time of the records; pages have none
REVISIT_BYTES = 1000  # equal payloads of at least so many bytes are stored once
BLOCK_LINES = 3000
MAX_BLOCKS = 100_000  # beyond it the blocks grow, so that the directory stays small
# Fixed value: profile of a revisit record, WARC 1.1.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")  # fixed value: RFC 4122 namespace for object ids
_CAPTURE = "key string, page_id long, file string, offset long, length long"
_SAFE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def surt(url: str | None) -> str:
    """Reversed-host sort key: http://www.a.org:8080/x?y#z becomes org,a,www:8080)/x?y.

    Without a host the text itself is the key; null is the empty key. White space,
    control and non-ASCII characters are percent-encoded.
    """
    if not url:
        return ""
    url = url.strip()
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return quote(url, safe=_SAFE)
    if not host:
        return quote(url, safe=_SAFE)
    default = {"http": 80, "https": 443}.get(parts.scheme)
    where = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != default else "")
    return quote(f"{where}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else ""), safe=_SAFE)


def _line(name: str, value: object) -> str:
    return f"{name}: {str(value).translate({13: '%0D', 10: '%0A'})}\r\n"


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit holds the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    head = "WARC/1.1\r\n" + _line("WARC-Type", "revisit" if revisit else "response")
    head += _line("WARC-Record-ID", _record_id(page_id)) + _line("WARC-Date", DATE)
    if url is not None:
        head += _line("WARC-Target-URI", url)
    head += _line("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if page_id is not None:
        head += _line("Page-ID", page_id)
    if revisit:
        head += _line("WARC-Profile", SAME_PAYLOAD)
        head += _line("WARC-Refers-To", _record_id(refers_to)) + _line("Refers-To-Page-ID", refers_to)
    block = http if revisit else http + payload
    head += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", len(block))
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of one record; raises on a damaged one."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    size = int(fields["content-length"])
    if not first.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"damaged WARC record: {first!r}")
    _, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, payload


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _pack_member(data: bytes) -> bytes:
    return gzip.compress(data, compresslevel=1, mtime=0)


def choose_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, digest and refers_to of every page.

    Of equal payloads of ``revisit_bytes`` or more the one with the largest page_id is stored, the
    others refer to it; further rows with that very page_id are stored too, and so are all of a
    group without any page_id. A null html is an empty payload. An empty table gives an empty one;
    further columns are left out.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= revisit_bytes
    # One row per payload leaves each task; most payloads occur once and end here.
    equal = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    equal = materialize(equal.filter((F.col("_n") > 1) & F.col("_keep").isNotNull()).select("digest", "_keep"), "equal")
    equal = broadcast_if_small(equal)
    other = large & (F.col("page_id").isNull() | (F.col("page_id") != F.col("_keep")))
    refers_to = F.when(other, F.col("_keep"))
    return rows.join(equal, "digest", "left").select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task below ``folder``; the stored table of captures. An attempt that is
    repeated writes a file of its own, and the captures name only files of attempts that succeeded."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, at = None, 0
        for batch in batches:
            if stream is None:
                files, path = _files(folder)
                files.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                stream = files.open_output_stream(f"{path}/{name}", compression=None)
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))
            for page_id, url, html, digest, refers_to in zip(*columns):
                member = _pack_member(record(page_id, url, html.encode(), digest, refers_to))
                stream.write(member)
                rows.append((surt(url), page_id, name, at, len(member)))
                at += len(member)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "page_id", "file", "offset", "length"]
            )
        if stream is not None:
            stream.close()

    return materialize(records.mapInArrow(write, _CAPTURE), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures into compressed blocks below ``folder``; the stored block directory.

    The sort goes on to page, file and offset, so a key that many captures share is spread over
    tasks and blocks.
    """
    n = captures.count()
    lines = max(block_lines, math.ceil(n / MAX_BLOCKS))
    order = ["key", "page_id", "file", "offset"]
    schema = "first_key string, last_key string, index string, offset long, length long, n_lines long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, at, held = None, 0, []
        files, path = _files(folder)
        files.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.cdx.gz"

        def flush() -> pa.RecordBatch:
            nonlocal stream, at
            stream = stream or files.open_output_stream(f"{path}/{name}", compression=None)
            block = _pack_member("".join("\t".join("" if x is None else str(x) for x in row) + "\n" for row in held).encode())
            stream.write(block)
            values = [held[0][0], held[-1][0], name, at, len(block), len(held)]
            at += len(block)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in values], ["first_key", "last_key", "index", "offset", "length", "n_lines"]
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) == lines:
                    yield flush()
        if held:
            yield flush()
        if stream is not None:
            stream.close()

    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.mapInArrow(write, schema), "directory")


def look_up(spark: SparkSession, urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The captures of every url: each url is binary-searched in the block directory, the blocks that
    may hold it are read once each, by range. ``urls`` has a column ``url``; null finds the empty key. A url that is
    there more than once is looked up once; no urls, or none that is indexed, give an empty table."""
    blocks = directory.orderBy("first_key", "last_key", "index", "offset").collect()  # at most about MAX_BLOCKS rows
    sparse = spark.sparkContext.broadcast(
        ([b["first_key"] for b in blocks], [b["last_key"] for b in blocks], [(b["index"], b["offset"], b["length"]) for b in blocks])
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, _ = sparse.value
        for batch in batches:
            keys, numbers = [], []
            for key in set(map(surt, batch.column("url").to_pylist())):
                # Blocks follow one another: the first that ends at or after the key, up to the last that begins there.
                for b in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                    keys.append(key)
                    numbers.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int32())], ["key", "block"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        _, _, places = sparse.value
        for batch in batches:
            for b in batch.column("block").to_pylist():
                name, offset, length = places[b]
                with files.open_input_file(f"{path}/{name}") as f:
                    lines = gzip.decompress(f.read_at(length, offset)).decode().split("\n")[:-1]
                key, page, file, at, size = zip(*(x.split("\t") for x in lines))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array([int(x) if x else None for x in page], pa.int64()), pa.array(file),
                     pa.array(list(map(int, at)), pa.int64()), pa.array(list(map(int, size)), pa.int64())],
                    ["key", "page_id", "file", "offset", "length"],
                )

    found = materialize(urls.select("url").distinct().mapInArrow(search, "key string, block int"), "found")
    captures = found.select("block").distinct().mapInArrow(read, _CAPTURE)
    # Stored, so that the join can be split at a url that very many pages have.
    return captures.join(materialize(found.select("key").distinct(), "keys"), "key", "left_semi")


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """key, page_id, record_type, payload, refers_to, digest of the captures' records, read by range."""
    schema = "key string, page_id long, record_type string, payload binary, refers_to long, digest string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        name, f = None, None
        for batch in batches:
            rows = []
            for key, file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length"))):
                if file != name:
                    name, f = file, files.open_input_file(f"{path}/{file}")
                fields, payload = parse_record(zlib.decompress(f.read_at(length, offset), 31))
                kind = fields["warc-type"]
                page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                rows.append((key, page and int(page), kind, payload if kind == "response" else None, refers and int(refers), digest))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string())
            columns = list(zip(*rows)) or [[]] * 6
            labels = ["key", "page_id", "record_type", "payload", "refers_to", "digest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], labels)

    near = captures.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return near.mapInArrow(read, schema)


def archive_and_read_back(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages as WARC records, index them, find them by their urls and read them back.

    page_id, payload_bytes, payload_digest, record_type, refers_to and url_key, one row per page; size
    and digest of a revisit are those of the response that it names. Further columns of ``pages`` are
    not archived. An empty table gives an empty one.
    """
    spark = pages.sparkSession
    folder = folder or work_dir(spark, "warc")
    captures = write_archives(choose_records(pages), f"{folder}/archives")
    directory = write_index(captures, f"{folder}/index")
    found = look_up(spark, pages.select(F.col("url").cast("string").alias("url")), directory, f"{folder}/index")
    records = read_records(found, f"{folder}/archives").select(
        "page_id", "record_type", "refers_to", "digest", F.col("key").alias("url_key"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    records = materialize(records, "records")
    revisits = records.filter(F.col("record_type") == "revisit").drop("payload_bytes")
    responses = records.filter(F.col("record_type") == "response")
    # Stored for the same reason: a payload that very many pages have.
    stored = materialize(responses.select(F.col("page_id").alias("refers_to"), "digest", "payload_bytes").distinct(), "responses")
    columns = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url_key"]
    return responses.select(*columns).unionByName(revisits.join(stored, ["refers_to", "digest"], "left").select(*columns))
