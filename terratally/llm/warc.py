"""WARC archives: written whole-file compressed, normalised to one gzip member per record, read back.

``write`` makes monolithic archives with Spark's text writer: one gzip stream per file. ``normalise``
inflates each of them once as a stream, gives every record a member of its own and writes an index
of the members beside the archive. ``read`` follows the index and inflates single members.

Archives are files in a folder that all executors share; the two Python steps open it through
pyarrow's file systems, so its address needs a scheme that pyarrow knows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_FILE = 20_000
LEVEL = 5
_BLOCK = 1 << 20
_END = b"\r\n\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "archive string, offset long, length long, page_id long, record_type string"
PAGE_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """One record per page; of pages with equal payloads the one with the largest id has it.

    The others are revisits of that page, if the payload has ``least_bytes`` at least. A null html
    is an empty payload. Rows with the largest id of their payload are all responses, also where
    a row is repeated; a row without id revisits one that has one. Other columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    rows = rows.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    # Copies are counted in the map tasks first, so a frequent payload costs a row per task.
    keepers = (
        rows.where(F.col("size") >= least_bytes)
        .groupBy("sha", "size")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    records = rows.join(keepers, ["sha", "size"], "left").select(
        "page_id", "url", "html", "sha", "keeper"
    )
    (
        records.mapInArrow(_records, "record string")
        .write.option("lineSep", _END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (column.to_pylist() for column in batch.columns)
        records = [_record(*row) for row in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], ["record"])


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _record(page_id, url, html: str, sha: str, keeper) -> str:
    digest = base64.b32encode(bytes.fromhex(sha)).decode()
    revisit = keeper is not None and page_id != keeper
    block = _HTTP if revisit else _HTTP + html
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "X-Payload-Length": len(html.encode()),
    }
    if page_id is not None:
        fields["X-Page-Id"] = page_id
    if url is not None:  # quoted so that no line break gets into the header
        fields["WARC-Target-URI"] = urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")
        fields["X-Target-URI"] = json.dumps(url)
    if revisit:
        fields["WARC-Profile"] = _PROFILE
        fields["WARC-Refers-To"] = _record_id(keeper, digest)
        fields["X-Refers-To-Page"] = keeper
    fields["Content-Length"] = len(block.encode())
    head = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return f"WARC/1.1\r\n{head}\r\n{block}"


def _open(address: str) -> tuple[fs.FileSystem, str]:
    if address.startswith("file:/") and not address.startswith("file:///"):
        address = "file://" + address[len("file:") :]
    return fs.FileSystem.from_uri(address)


class _Stream:
    """Bytes of a gzip file of one or many members, inflated as they are asked for."""

    def __init__(self, source):
        self._source, self._inflater, self._left = source, zlib.decompressobj(31), b""
        self._ready = bytearray()

    def _more(self) -> bool:
        if self._inflater.eof:
            self._left, self._inflater = self._inflater.unused_data, zlib.decompressobj(31)
        packed = self._left or self._source.read(_BLOCK)
        self._left = b""
        if not packed:
            return False
        self._ready += self._inflater.decompress(packed)
        return True

    def until_blank_line(self) -> bytes | None:
        seen = 0
        while (at := self._ready.find(_END, seen)) < 0:
            seen = max(0, len(self._ready) - len(_END) + 1)
            if not self._more():
                if self._ready.strip():
                    raise ValueError("the archive ends within a record's header")
                return None
        return self.take(at + len(_END))

    def take(self, size: int) -> bytes:
        while len(self._ready) < size:
            if not self._more():
                raise ValueError("the archive ends within a record")
        taken = bytes(self._ready[:size])
        del self._ready[:size]
        return taken


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _split(stream: _Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    while (head := stream.until_blank_line()) is not None:
        fields = _fields(head)
        yield fields, head + stream.take(int(fields["content-length"]) + len(_END))


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every archive below ``source`` into ``target``; one row per archive.

    An archive and its index get their names only when complete and always with the same content,
    so a task that runs twice does no harm. Memory holds one record at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_normalise_one(path, target) for path in batch.column(0).to_pylist()]
            names, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                ["archive", "records", "bytes"],
            )

    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    return paths.select("path").mapInArrow(run, "archive string, records long, bytes long")


def _normalise_one(path: str, target: str) -> tuple[str, int, int]:
    system, place = _open(path)
    goal, folder = _open(target)
    goal.create_dir(folder, recursive=True)
    name = place.rsplit("/", 1)[1].removesuffix(".gz").removesuffix(".txt")
    attempt = f"{folder}/.{name}-{uuid.uuid4().hex}"
    offset = records = 0
    with (
        system.open_input_stream(place, compression=None) as packed,
        goal.open_output_stream(f"{attempt}.warc.gz", compression=None) as out,
        goal.open_output_stream(f"{attempt}.jsonl", compression=None) as index,
    ):
        for fields, record in _split(_Stream(packed)):
            deflater = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = deflater.compress(record) + deflater.flush()
            out.write(member)
            entry = {
                "archive": f"{name}.warc.gz",
                "offset": offset,
                "length": len(member),
                "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
                "record_type": fields["warc-type"],
            }
            index.write(json.dumps(entry).encode() + b"\n")
            offset, records = offset + len(member), records + 1
    for ending in ("warc.gz", "jsonl"):
        goal.move(f"{attempt}.{ending}", f"{folder}/{name}.{ending}")
    return f"{name}.warc.gz", records, offset


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of normalised archives as a row of ``PAGE_SCHEMA``, found through the indexes.

    The digest of a response is taken from its payload, and one that differs from the header is an
    error; a revisit has no payload, its digest and length come from the header.
    """
    names = [column.split()[0] for column in PAGE_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, system.open_input_file(f"{root}/{archive}")
                rows.append(_page(source.read_at(length, offset)))
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)
        if source is not None:
            source.close()

    index = spark.read.schema(INDEX_SCHEMA).option("pathGlobFilter", "*.jsonl").json(folder)
    return index.select("archive", "offset", "length").mapInArrow(run, PAGE_SCHEMA)


def _page(member: bytes) -> tuple:
    record = zlib.decompress(member, 31)
    cut = record.index(_END) + len(_END)
    fields = _fields(record[:cut])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind, size, payload = fields["warc-type"], int(fields["x-payload-length"]), None
    if kind == "response":
        block = record[cut : cut + int(fields["content-length"])]
        payload = block[block.index(_END) + len(_END) :]
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"payload of page {fields.get('x-page-id')} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    url = json.loads(fields["x-target-uri"]) if "x-target-uri" in fields else None
    return number("x-page-id"), url, size, digest, kind, number("x-refers-to-page"), payload


def round_trip(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Pages written to monolithic archives below ``folder``, normalised, and read back."""
    spark = pages.sparkSession
    write(pages, f"{folder}/monolithic", least_bytes)
    normalise(spark, f"{folder}/monolithic", f"{folder}/normal").write.parquet(f"{folder}/archives")
    return read(spark, f"{folder}/normal")
