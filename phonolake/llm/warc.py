"""WARC archives as seekable Zstandard bundles.

A bundle is one file: records are grouped into independent Zstandard frames of about a megabyte, followed by a
skippable frame with the record index (identifier, frame, offset inside the decompressed frame, length) and, as the
last content, the seek table of the seekable format (compressed and decompressed size of every frame). A reader takes
the table from the end of the file, finds a record's frame and decompresses that frame only; a plain Zstandard reader
sees the records one after the other.

Files are written and read by Spark, so they may lie in any file system it knows: every frame is a row of the text sink,
whose line separator is an empty skippable frame. A task writes a bundle per 64 frames, and a task that is lost is written again.

Payloads are UTF-8 text. Of equal payloads of at least ``least`` bytes the one with the smallest id is a response and
the others are revisits that refer to it; smaller payloads are responses. Equal means equal SHA-256.

Defined results: a null payload is empty; a very long one is a frame of its own; rows that repeat the smallest id are all
responses; a null id counts as the largest; an empty table gives an empty archive. Further columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonolake.llm import filters
from phonolake.llm.registry import query, table
from phonolake.session import materialise, scratch_dir

# Fixed values of the Zstandard and seekable formats.
SKIPPABLE = 0x184D2A50
INDEX_FRAME = 0x184D2A51
SEEK_FRAME = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
#: An empty skippable frame; the text sink writes it behind every frame.
SEPARATOR = struct.pack("<II", SKIPPABLE, 0)

FRAME_BYTES = 1 << 20
BUNDLE_FRAMES = 64
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
EOL = b"\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def build_record(page_id, url: str | None, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has the size and digest of its payload but not the payload."""
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        f"X-Page-ID: {json.dumps(page_id)}",
    ]
    if refers_to is not None:
        headers += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body += payload if refers_to is None else b""
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return EOL.join(h.encode() for h in headers) + EOL * 2 + body + EOL * 2


def parse_record(data: bytes) -> dict:
    """Headers by lower-case name, and the payload (empty for a revisit)."""
    head, _, rest = data.partition(EOL * 2)
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return {"headers": headers, "payload": block.partition(EOL * 2)[2]}


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    return skippable(SEEK_FRAME, entries + struct.pack("<IBI", len(frames), 0, SEEK_MAGIC))


class Writer:
    """Gathers records into frames and frames into one bundle."""

    def __init__(self, frame_bytes: int) -> None:
        self.frame_bytes = frame_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.places: list[tuple] = []
        self.held: list[bytes] = []
        self.size = 0

    def add(self, page_id, record: bytes) -> bytes | None:
        """The frame that the record completes, if it does."""
        self.places.append((page_id, len(self.frames), self.size, len(record)))
        self.held.append(record)
        self.size += len(record)
        return self.close_frame() if self.size >= self.frame_bytes else None

    def close_frame(self) -> bytes:
        packed = self.packer.compress(b"".join(self.held))
        # What the sink writes behind the frame counts as part of it, so that frames lie end to end.
        self.frames.append((len(packed) + len(SEPARATOR), self.size))
        self.held, self.size = [], 0
        return packed

    def footer(self) -> list[bytes]:
        names = ["id", "frame", "offset", "length"]
        columns = [pa.array(c, pa.int64()) for c in zip(*self.places, strict=True)]
        index = pa.table(dict(zip(names, columns, strict=True)))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as writer:
            writer.write_table(index)
        return [skippable(INDEX_FRAME, self.packer.compress(sink.getvalue().to_pybytes())), seek_table(self.frames)]


def _bundles_of_task(batches: Iterator[pa.RecordBatch], frame_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of one task as frames; each bundle but the last has ``BUNDLE_FRAMES`` frames and two rows of footer."""

    def row(part: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], ["frame"])

    writer = Writer(frame_bytes)
    for batch in batches:
        for i in range(batch.num_rows):
            page = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            payload = page["payload"].encode()
            record = build_record(page["id"], page["url"], payload, page["size"], page["digest"], page["refers_to"])
            if (frame := writer.add(page["id"], record)) is not None:
                yield row(frame)
            if len(writer.frames) == BUNDLE_FRAMES:
                yield from map(row, writer.footer())
                writer = Writer(frame_bytes)
    if writer.held:
        yield row(writer.close_frame())
    if writer.frames:
        yield from map(row, writer.footer())


class Bundle:
    """Random access to the bytes of a bundle."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        end = len(data) - len(SEPARATOR)
        count, _, magic = struct.unpack_from("<IBI", data, end - 9)
        if magic != SEEK_MAGIC:
            raise ValueError("the bundle has no seek table")
        entries = end - 9 - 8 * count
        self.frames, at = [], 0
        for packed, size in struct.iter_unpack("<II", data[entries : end - 9]):
            self.frames.append((at, packed, size))
            at += packed
        kind, length = struct.unpack_from("<II", data, at)
        if kind != INDEX_FRAME:
            raise ValueError("the bundle has no record index")
        body = zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + length])
        self.index = pa.ipc.open_stream(body).read_all()

    def frame(self, number: int) -> bytes:
        at, packed, size = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(
            self.data[at : at + packed - len(SEPARATOR)], max_output_size=max(size, 1)
        )


def mark_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows of ``pages`` (id, url, payload) with size, digest and refers_to; a revisit has no payload any more.

    Payloads are counted by their digests before any row moves. The digests that repeat are written, a filter of fixed size
    keeps all other rows where they are, and what repeats meets its first without its payload: a payload that is very
    common is a narrow row in a join that Spark can split. Then its responses are the rows that are no revisits,
    told by digest and id.
    """
    pages = pages.select("id", "url", F.coalesce("payload", F.lit("")).alias("payload"))
    pages = pages.withColumns({
        "digest": F.sha2(F.col("payload").cast("binary"), 256), "size": F.octet_length("payload").cast("long")
    })
    large = F.col("size") >= least
    counted = pages.where(large).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    firsts = materialise(counted.where("n > 1").select("digest", "first", F.xxhash64("digest").alias("key")))
    may = filters.may_hold(firsts, "key", F.xxhash64("digest"))
    marked = materialise(pages.select("id", "url", "digest", "size", (large & may).alias("may")).where("may").drop("may"))
    revisits = marked.join(firsts.select("digest", "first"), "digest").where(~F.col("id").eqNullSafe(F.col("first")))
    revisits = materialise(revisits.select("id", "url", "digest", "size", F.col("first").alias("refers_to")))
    keys = revisits.select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    some = pages.where(large & may)
    others = some.join(keys, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_anti")
    none = F.lit(None).cast(pages.schema["id"].dataType).alias("refers_to")
    columns = ["id", "url", "payload", "digest", "size", "refers_to"]
    out = [pages.where(~(large & may)).select("*", none), others.select("*", none), revisits.withColumn("payload", F.lit(""))]
    return out[0].select(*columns).unionByName(out[1].select(*columns)).unionByName(out[2].select(*columns))


def write_bundles(pages: DataFrame, path: str, least: int = LEAST, frame_bytes: int = FRAME_BYTES) -> None:
    """Write (id, url, payload) as bundles below ``path``."""
    marked = mark_revisits(pages, least)
    frames = marked.mapInArrow(lambda batches: _bundles_of_task(batches, frame_bytes), "frame binary")
    # The sink starts another file after so many rows: a bundle's frames and its footer.
    sink = frames.select(F.col("frame").cast("string")).write.option("maxRecordsPerFile", BUNDLE_FRAMES + 2)
    sink.option("lineSep", SEPARATOR.decode()).text(path)


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    # A bundle file is one value, so files are not split.
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record lies: id, bundle, frame, offset in the frame, length."""

    def entries(batches):
        for batch in batches:
            for bundle, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                found = Bundle(content.as_buffer().to_pybytes()).index
                names = pa.array([bundle] * len(found), pa.string())
                yield from found.add_column(1, "bundle", names).to_batches()

    schema = "id long, bundle string, frame long, offset long, length long"
    return _bundles(spark, path).mapInArrow(entries, schema)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The raw records of the ids in ``wanted`` (id): only their frames are decompressed."""
    spots = read_index(spark, path).join(wanted.select("id").distinct(), "id")
    spots = spots.groupBy("bundle").agg(F.collect_list(F.struct("id", "frame", "offset", "length")).alias("spots"))
    joined = _bundles(spark, path).join(spots, F.col("path") == F.col("bundle")).select("content", "spots")

    def records(batches):
        for batch in batches:
            for content, spots in zip(batch["content"], batch["spots"].to_pylist(), strict=True):
                bundle, number, body = Bundle(content.as_buffer().to_pybytes()), None, b""
                for spot in sorted(spots, key=lambda s: (s["frame"], s["offset"])):
                    if spot["frame"] != number:
                        number = spot["frame"]
                        body = bundle.frame(number)
                    record = body[spot["offset"] : spot["offset"] + spot["length"]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([spot["id"]], pa.int64()), pa.array([record], pa.binary())], ["id", "record"]
                    )

    return joined.mapInArrow(records, "id long, record binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records: id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits).

    The digest of every payload that is there is computed again and compared.
    """

    def records(batches):
        for batch in batches:
            for content in batch["content"]:
                bundle = Bundle(content.as_buffer().to_pybytes())
                spots = bundle.index.to_pydict()
                number, body, out, held = None, b"", [], 0
                for frame, offset, length in zip(spots["frame"], spots["offset"], spots["length"], strict=True):
                    if frame != number:
                        if held > FRAME_BYTES:
                            yield _rows(out)
                            out, held = [], 0
                        number, body = frame, bundle.frame(frame)
                    out.append(_row(parse_record(body[offset : offset + length])))
                    held += length
                if out:
                    yield _rows(out)

    return _bundles(spark, path).mapInArrow(records, RECORDS)


RECORDS = (
    "id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string"
)
_ARROW = pa.schema(
    [
        ("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.string()),
    ]
)


def _row(record: dict) -> dict:
    headers, payload = record["headers"], record["payload"]
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    response = headers["warc-type"] == "response"
    if response and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"damaged payload in {headers['warc-record-id']}")
    refers_to = headers.get("x-refers-to-page-id")
    return {
        "id": json.loads(headers["x-page-id"]),
        "url": headers["warc-target-uri"],
        "record_type": headers["warc-type"],
        "payload_bytes": int(headers["x-payload-length"]),
        "payload_digest": digest,
        "refers_to": None if refers_to is None else int(refers_to),
        "payload": payload.decode() if response else None,
    }


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


OP8_SQL = f"""
with p as (
  select page_id, coalesce(html, '') html, strlen(coalesce(html, ''))::bigint payload_bytes,
         sha256(coalesce(html, '')) payload_digest from pages),
m as (select *, min(page_id) over (partition by payload_digest) lowest from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes < {LEAST} or page_id = lowest then 'response' else 'revisit' end record_type,
       case when payload_bytes < {LEAST} or page_id = lowest then null else lowest end refers_to
from m
"""


@query("op8_seekable_warc", OP8_SQL)
def op8_seekable_warc(spark, sf_dir):
    """All pages written to bundles in the shared folder and read back; the rows come from the archives."""
    pages = table(spark, sf_dir, "pages")
    pages = pages.select(F.col("page_id").alias("id"), "url", F.col("html").alias("payload"))
    path = scratch_dir(spark)
    write_bundles(pages, path)
    found = read_records(spark, path).withColumnRenamed("id", "page_id")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
