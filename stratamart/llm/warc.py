"""WARC archives with a two-level capture index.

Pages become gzip members of WARC files. The index keeps one line per record, sorted by
reversed-host URL keys and cut into compressed blocks; a sparse directory has the first
and last key of each block. A look-up searches the directory by bisection, opens the few
blocks that can hold its keys, and reads the records' byte ranges from the archives.
"""

from __future__ import annotations

import bisect
import json
import math
import zlib
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, framed, small_batches, stored

#: Payloads shorter than this are always written in full.
LEAST_REVISIT = 100
#: Bytes of an archive after which the next one begins; one larger record may exceed it.
ARCHIVE_BYTES = 8_000_000
#: Index lines per compressed block.
BLOCK_LINES = 500
#: Blocks per shard of the directory. The driver sees two keys a shard, so two per 100,000 lines.
SHARD_BLOCKS = 200
#: Bytes that one positioned read takes at most unless a record is larger, and the gap between ranges that it reads over.
READ_BYTES, GAP = 4 << 20, 64 << 10
#: Bytes of records that a task reads where there are more tasks than cores anyway.
TASK_BYTES = 128 << 20
# Form of records.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

DIRECTORY = "shard string, block string, first string, last string"
LINE = "key string, page_id long, path string, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def header_url(url: str | None) -> str:
    """A URL as its record names it: controls, blanks and letters beyond ASCII, which would break the header, are escaped."""
    return quote(url if isinstance(url, str) else "", safe="".join(map(chr, range(33, 127))))


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels in reverse, then path and query; scheme, user, port, ``www`` and fragment do not matter.

    The key of an escaped URL is that of the URL.
    """
    rest = header_url(url).partition("#")[0]
    rest = rest.partition("://")[2] or rest
    host, slash, path = rest.partition("/")
    host, ask, query = host.partition("?")
    labels = host.rpartition("@")[2].partition(":")[0].lower().strip(".").split(".")
    if len(labels) > 1 and labels[0] == "www":
        labels = labels[1:]
    return ",".join(reversed(labels)) + ")/" + path + ask + query


def gzipped(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


#: An empty member, which ends each file that Spark's text writer makes of raw bytes.
TAIL = gzipped(b"").decode("latin-1")


def record(page_id: int | None, url: str | None, html: str | None, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    payload = b"" if revisit else encoded(html)
    name = "null" if page_id is None else str(page_id)
    head = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {header_url(url)}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return gzipped("\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n")


def numbered(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name not in ("", "null") else None


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, body = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"no record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, body[: int(fields["Content-Length"])]


def members(content: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of every gzip member."""
    at = 0
    while at < len(content):
        unpack, begin, out = zlib.decompressobj(31), at, []
        while not unpack.eof:
            if at >= len(content):
                raise ValueError("archive ends within a member")
            out.append(unpack.decompress(content[at : at + step]))
            at += min(step, len(content) - at) - len(unpack.unused_data)
        yield begin, at - begin, b"".join(out)


def described(raw: bytes) -> tuple[tuple, bytes]:
    """One row of :data:`RECORD` and the payload; sizes and digests of responses are those of the payload that was read."""
    fields, payload = parsed(raw)
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else sha256(payload).hexdigest()
    size = int(fields["X-Payload-Length"]) if revisit else len(payload)
    row = numbered(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], size, digest, fields["WARC-Type"], numbered(fields.get("WARC-Refers-To"))
    return row, payload


def named(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as gzip WARC files below ``path``.

    Of equal payloads of at least :data:`LEAST_REVISIT` bytes the one with the smallest
    page_id is a response and the others revisit it; rows that repeat that id are
    responses too, a null id is never the smallest unless all are null. Null html is an
    empty payload, a null url an empty one. Other columns are not read.

    Digests are added up by value first, so a payload that a third of the pages share
    is one row; what it joins back to are only digests that occur twice.
    """
    rows = small_batches(pages).select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha2(F.col("html").cast("binary"), 256)})
    shared = rows.where(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = stored(shared.where("n > 1").select(F.col("digest").alias("_digest"), "first"), "warc-shared")
    # Only where a payload is not the first one is there something to refer to.
    rows = rows.join(shared, F.col("digest") == F.col("_digest"), "left")
    rows = rows.withColumn("revisit", F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, html, digest, n, first, revisit in batch.itertuples(index=False):
                number = None if pd.isna(page_id) else int(page_id)
                held.append(record(number, url, html, digest, n, None if pd.isna(first) else int(first), revisit))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame({"data": [b"".join(held)]})
                    held, size = [], 0
        if held:
            yield pd.DataFrame({"data": [b"".join(held)]})

    rows = rows.select("page_id", "url", "html", "digest", "size", "first", "revisit").mapInPandas(pack, "data binary")
    # One row is one file. The text writer puts out the bytes as they are, then the separator in Latin-1.
    rows.select(F.col("data").cast("string").alias("value")).write.options(
        maxRecordsPerFile=1, encoding="ISO-8859-1", lineSep=TAIL
    ).text(path)


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def write_index(spark: SparkSession, path: str, index: str) -> None:
    """Index the archives below ``path``: ``index``/blocks and its ``index``/directory."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                for offset, length, raw in members(bytes(content)):
                    if raw:
                        fields, _ = parsed(raw)
                        rows.append((url_key(fields["WARC-Target-URI"]), numbered(fields["WARC-Record-ID"]), name, offset, length))
                yield framed(rows, *named(LINE))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        shard: list = ["", SHARD_BLOCKS]
        for batch in batches:
            held += [(k, None if pd.isna(i) else int(i), p, int(o), int(n)) for k, i, p, o, n in batch.itertuples(index=False)]
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES], shard)
                held = held[BLOCK_LINES:]
        if held:
            yield block(held, shard)

    def block(rows: list[tuple], shard: list) -> pd.DataFrame:
        name = sha256(json.dumps([rows[0], rows[-1]]).encode()).hexdigest()[:32]
        # A shard is named after its first block.
        shard[:] = (name, 1) if shard[1] >= SHARD_BLOCKS else (shard[0], shard[1] + 1)
        row = {"shard": shard[0], "block": name, "first": rows[0][0], "last": rows[-1][0], "data": zlib.compress(json.dumps(rows).encode(), 6)}
        return pd.DataFrame([row])

    found = stored(archives(spark, path).select("path", "content").mapInPandas(lines, LINE), "warc-lines")
    ordered = found.repartitionByRange("key", "page_id", "path", "offset").sortWithinPartitions("key", "page_id", "path", "offset")
    ordered.mapInPandas(cut, DIRECTORY + ", data binary").write.parquet(f"{index}/blocks")
    spark.read.parquet(f"{index}/blocks").select(*named(DIRECTORY)).write.parquet(f"{index}/directory")


def opened(blocks: DataFrame) -> DataFrame:
    """Lines of index blocks."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                yield framed([tuple(x) for x in json.loads(zlib.decompress(data))], *named(LINE))

    return blocks.select("data").mapInPandas(lines, LINE)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path within it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    rest = rest if rest.startswith("//") else "//" + rest
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + quote(rest, safe="/@:"))


def positioned(path: str) -> bool:
    """Whether tasks can open files below ``path`` at an offset."""
    try:
        store, place = store_of(path)
        return store.get_file_info(place).type != fs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return False


def stretches(spans: Iterable[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """(offset, length) in order, in runs that one read covers."""
    run: list[tuple[int, int]] = []
    for offset, length in sorted(spans):
        if run and (offset - sum(run[-1]) > GAP or offset + length - run[0][0] > READ_BYTES):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def ranges(spark: SparkSession, path: str, lines: DataFrame, payloads: bool = True) -> DataFrame:
    """Records that ``lines`` point to: :data:`RECORD` and, if asked for, the payload.

    Tasks open the archives at the records' offsets; what is shuffled are offsets and
    lengths, an archive's in one row, which its size bounds. Where only Spark can open
    the files, it reads the archives that are asked for as a whole and they are joined
    with the offsets.
    """
    schema = RECORD + (", payload binary" if payloads else "")

    def records(read: Callable[[int, int], bytes], spans) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for run in stretches((s["offset"], s["length"]) for s in spans):
            begin = run[0][0]
            data = read(begin, sum(run[-1]) - begin)
            for offset, length in run:
                row, payload = described(zlib.decompress(data[offset - begin : offset - begin + length], 31))
                held.append((*row, payload) if payloads else row)
                size += len(payload)
                if size >= READ_BYTES or len(held) >= 2000:
                    yield framed(held, *named(schema))
                    held, size = [], 0
        if held:
            yield framed(held, *named(schema))

    def at_offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, spans in zip(batch["path"], batch["spans"], strict=True):
                store, place = store_of(name)
                with store.open_input_file(place) as file:
                    yield from records(lambda at, n, file=file: file.read_at(n, at), spans)

    def of_contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content, spans in zip(batch["content"], batch["spans"], strict=True):
                yield from records(lambda at, n, content=content: bytes(content[at : at + n]), spans)

    spans = lines.groupBy("path").agg(F.collect_list(F.struct("offset", "length")).alias("spans"), F.sum("length").alias("bytes"))
    spans = stored(spans, "warc-spans")
    if not positioned(path):
        both = archives(spark, path).select("path", "content").join(spans, "path")
        return both.select("content", "spans").mapInPandas(of_contents, schema)
    # A few bytes a row stand for a whole archive, so tasks are dealt by what they will read.
    n, size = spans.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(n, 4 * spark.sparkContext.defaultParallelism), math.ceil(size / TASK_BYTES))
    return spans.select("path", "spans").repartition(tasks).mapInPandas(at_offsets, schema)


def read_all(spark: SparkSession, path: str, index: str) -> DataFrame:
    """Every record that the index knows: :data:`RECORD` and the payload."""
    return ranges(spark, path, opened(spark.read.parquet(f"{index}/blocks")))


def look_up(urls: DataFrame, path: str, index: str, payloads: bool = True) -> DataFrame:
    """Records of the distinct, non-null ``url`` of ``urls``, whatever their scheme, port or fragment.

    Keys find their shards of the directory by bisection of the shards' bounds, and in
    a shard their blocks by bisection of the blocks' bounds. A key that runs on over many
    blocks or shards gets them all. Only blocks that may hold a key are opened and only
    ranges of lines whose key is asked for are read.
    """
    spark = urls.sparkSession
    directory = spark.read.parquet(f"{index}/directory")
    bounds = directory.groupBy("shard").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect()
    bounds = sorted((r["first"], r["last"], r["shard"]) for r in bounds)
    firsts, lasts, shards = ([b[k] for b in bounds] for k in range(3))

    def within(firsts: list[str], lasts: list[str], key: str) -> range:
        return range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = {url_key(url) for url in batch["url"]}
            yield framed([(key, shards[k]) for key in sorted(keys) for k in within(firsts, lasts, key)], "key", "shard")

    def search(keys: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["first", "last"])
        firsts, lasts, blocks = part["first"].tolist(), part["last"].tolist(), part["block"].tolist()
        return framed([(key, blocks[k]) for key in keys["key"] for k in within(firsts, lasts, key)], "key", "block")

    keys = small_batches(urls).where("url is not null").select("url").mapInPandas(place, "key string, shard string").distinct()
    asked = keys.groupBy("shard").cogroup(directory.groupBy("shard")).applyInPandas(search, "key string, block string")
    asked = stored(asked, "warc-asked")
    lines = opened(spark.read.parquet(f"{index}/blocks").join(asked.select("block").distinct(), "block", "left_semi"))
    return ranges(spark, path, lines.join(asked.select("key").distinct(), "key", "left_semi"), payloads)
