"""WARC archives written from a table and read back as a table of chunks.

Writing: every page is a record; of records with equal payloads of ``MIN_REVISIT_BYTES`` or
more the first is a response and the others revisit it. A payload beyond ``CHUNK_CHARS`` is
segmented as the format provides: a first record and continuations. Each segment is one row,
so no row, and with ``ROWS_A_FILE`` no archive, grows with a record's size. Spark's own
writer makes the files, on any file system and with its commit: a lost task leaves nothing.

Reading: an archive is unpacked as a stream. A record that lies there in one piece, not
larger than a chunk, gives its length and digest at once. Others give rows of record, segment
and piece with at most ``PIECE_BYTES`` of payload; these are brought in order by record and
their digest is carried from row to row, so a record of any size needs the memory of one
piece.

Defined results: null html is the empty payload; among equal payloads the smallest page_id
is the response (a null one comes last), then the smallest url; of rows that agree in page_id,
url and payload each is a record and gives a row, and one of them can be the response, which
the others revisit; line breaks in a url are written as %0D and
%0A. Only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm.common import stored
from starhouse.scratch import scratch_path

MIN_REVISIT_BYTES = 100
CHUNK_CHARS = 16_384
PIECE_BYTES = 65_536
ROWS_A_FILE = 2_048
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

CHUNKS = (
    "record_id string, page_id bigint, record_type string, refers_to string, declared string, "
    "segment bigint, piece bigint, n_bytes bigint, digest string, data binary"
)
_FIELDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("declared", pa.string()),
        ("segment", pa.int64()),
        ("piece", pa.int64()),
        ("n_bytes", pa.int64()),
        ("digest", pa.string()),
        ("data", pa.binary()),
    ]
)


def _urn(key: Column) -> Column:
    """A record id from a hexadecimal md5."""
    return F.regexp_replace(key, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _keyed(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    parts = [F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit("="), F.col("url")), F.lit("-"))]
    return rows.withColumn("record_id", _urn(F.md5(F.concat_ws("\n", *parts, F.col("digest")))))


def _header(*lines: Column) -> Column:
    """Header lines, those that are null left out."""
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(_END))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def records(pages: DataFrame) -> DataFrame:
    """One text a segment: header and block, without the two line ends that close a record."""
    rows = _keyed(pages)
    # Repeated rows are equal, so one stands for all and is written as often as it was counted.
    narrow = rows.withColumn("linked", F.octet_length("payload") >= MIN_REVISIT_BYTES).drop("payload")
    counted = narrow.groupBy("record_id", "page_id", "url", "digest", "linked").agg(F.count("*").alias("times"))
    counted = stored(counted, "warc-payloads")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "record_id")
    firsts = counted.filter("linked").groupBy("digest").agg(F.min(order).alias("first"))
    origin = F.col("first.record_id")
    marks = counted.join(firsts, "digest", "left").select(
        "record_id", "times", origin.alias("origin"), (origin != F.col("record_id")).alias("later")
    )
    marks = stored(marks.filter("times > 1 OR later"), "warc-marks")
    rows = rows.join(marks, "record_id", "left").withColumn("times", F.coalesce("times", F.lit(1)))
    again = rows.filter("times > 1").groupBy("record_id", "origin", "later", "times")
    again = again.agg(*[F.first(c).alias(c) for c in ("page_id", "url", "payload", "digest")])
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("times") - 1).cast("int"))))
    rows = rows.filter("times = 1").withColumn("copy", F.lit(0)).unionByName(again)
    rows = rows.withColumn("refers_to", F.when(F.col("later") | (F.col("copy") > 0), F.col("origin")))
    copy_id = _urn(F.md5(F.concat_ws("\n", "record_id", F.lit("copy"), F.col("copy").cast("string"))))
    rows = rows.withColumn("record_id", F.when(F.col("copy") == 0, F.col("record_id")).otherwise(copy_id))

    whole = F.col("payload")
    # Possessive: Java's greedy repetition would take a stack frame for each character.
    pieces = F.when(F.length(whole) <= CHUNK_CHARS, F.array(whole)).otherwise(
        F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{CHUNK_CHARS}}}+"), F.lit(0))
    )
    date = _line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    uri = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    common = [date, _line("WARC-Target-URI", uri), _line("Page-ID", F.col("page_id").cast("string"))]
    own_digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = F.lit("Content-Type: application/http;msgtype=response")

    def length(block: Column) -> Column:
        return _line("Content-Length", F.octet_length(block).cast("string"))

    revisit = F.concat(
        _header(
            F.lit("WARC-Type: revisit"),
            _line("WARC-Record-ID", F.col("record_id")),
            *common,
            _line("WARC-Refers-To", F.col("refers_to")),
            F.lit(f"WARC-Profile: {_PROFILE}"),
            own_digest,
            http,
            length(F.lit(_HTTP)),
        ),
        F.lit(_HTTP),
    )
    block = F.concat(F.lit(_HTTP), F.col("chunk"))
    several = F.col("n") > 1
    response = F.concat(
        _header(
            F.lit("WARC-Type: response"),
            _line("WARC-Record-ID", F.col("record_id")),
            *common,
            own_digest,
            F.when(several, F.lit("WARC-Segment-Number: 1")),
            http,
            length(block),
        ),
        block,
    )
    number = F.col("k") + 1
    piece_id = _urn(F.md5(F.concat_ws("\n", "record_id", F.col("k").cast("string"))))
    total = _line("WARC-Segment-Total-Length", (F.octet_length("payload") + len(_HTTP)).cast("string"))
    continuation = F.concat(
        _header(
            F.lit("WARC-Type: continuation"),
            _line("WARC-Record-ID", piece_id),
            *common,
            _line("WARC-Segment-Origin-ID", F.col("record_id")),
            _line("WARC-Segment-Number", number.cast("string")),
            F.when(number == F.col("n"), total),
            length(F.col("chunk")),
        ),
        F.col("chunk"),
    )
    single = F.when(F.col("refers_to").isNotNull(), F.array(F.lit(""))).otherwise(pieces)
    cut = rows.withColumn("pieces", single).withColumn("n", F.size("pieces"))
    cut = cut.select("*", F.posexplode("pieces").alias("k", "chunk")).drop("pieces")
    return cut.select(
        F.when(F.col("refers_to").isNotNull(), revisit).when(F.col("k") == 0, response).otherwise(continuation).alias("value")
    )


def write(pages: DataFrame, path: str) -> None:
    """Archives of at most ``ROWS_A_FILE`` segments, compressed; the writer closes each record."""
    out = records(pages).write.option("lineSep", _END).option("compression", "gzip")
    out.option("maxRecordsPerFile", ROWS_A_FILE).text(path)


class _Unpacked(io.RawIOBase):
    """The bytes of an archive, unpacked as they are read; several gzip members may follow each other."""

    def __init__(self, content: bytes):
        self.left = memoryview(content)
        self.packed = content[:2] == b"\x1f\x8b"
        self.unpack = zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if not self.packed:
                out, self.left = bytes(self.left[: len(into)]), self.left[len(into) :]
            else:
                if self.unpack.eof:
                    self.left, self.unpack = memoryview(self.unpack.unused_data or bytes(self.left)), zlib.decompressobj(31)
                feed = self.unpack.unconsumed_tail or bytes(self.left[:PIECE_BYTES])
                if not self.unpack.unconsumed_tail:
                    self.left = self.left[len(feed) :]
                if not feed:
                    return 0
                out = self.unpack.decompress(feed, len(into))
                if self.unpack.eof:
                    self.left = memoryview(self.unpack.unused_data + bytes(self.left)) if self.unpack.unused_data else self.left
                    self.unpack = zlib.decompressobj(31)
                if not out:
                    continue
            into[: len(out)] = out
            return len(out)


def _fields(stream: io.BufferedReader) -> tuple[dict[str, str], int]:
    """Lines up to the blank one as names (in lower case) and values, and their length in bytes."""
    fields, size = {}, 0
    while line := stream.readline():
        size += len(line)
        line = line.strip(b"\r\n")
        if not line:
            break
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, size


def chunks_of(content: bytes) -> Iterator[dict]:
    """The records of an archive; a payload that is segmented or long comes in pieces."""
    stream = io.BufferedReader(_Unpacked(content), PIECE_BYTES)
    while first := stream.readline():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {first[:40]!r}")
        fields, _ = _fields(stream)
        left = int(fields["content-length"])
        kind = fields.get("warc-type", "")
        if kind in ("response", "revisit") and fields.get("content-type", "").startswith("application/http"):
            left -= _fields(stream)[1]
        page = fields.get("page-id")
        row = {
            "record_id": fields.get("warc-segment-origin-id", fields.get("warc-record-id")),
            "page_id": int(page) if page else None,
            "record_type": kind,
            "refers_to": fields.get("warc-refers-to"),
            "declared": fields.get("warc-payload-digest", "").partition(":")[2] or None,
            "segment": int(fields.get("warc-segment-number", 1)),
            "piece": 0,
        }
        if kind in ("response", "continuation") and (left > PIECE_BYTES or "warc-segment-number" in fields):
            piece = 0
            while left or not piece:
                data = stream.read(min(left, PIECE_BYTES))
                if left and not data:
                    raise ValueError("an archive ends within a record")
                left -= len(data)
                yield row | {"piece": piece, "n_bytes": len(data), "data": data}
                piece += 1
        elif kind in ("response", "revisit"):
            data = stream.read(left)
            if len(data) < left:
                raise ValueError("an archive ends within a record")
            yield row | {"n_bytes": left, "digest": hashlib.sha256(data).hexdigest() if kind == "response" else None}
        else:
            while left:
                if not (data := stream.read(min(left, PIECE_BYTES))):
                    raise ValueError("an archive ends within a record")
                left -= len(data)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for row in chunks_of(content.as_py()):
                rows.append(row)
                size += len(row.get("data") or b"") + 200
                if size > 16 * PIECE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_FIELDS)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_FIELDS)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of all archives in a folder (columns: ``CHUNKS``)."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, CHUNKS)


_SUMS = "record_id string, n_bytes bigint, digest string"


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and digest of each record from its pieces in order; repeated pieces count once."""
    schema = pa.schema([("record_id", pa.string()), ("n_bytes", pa.int64()), ("digest", pa.string())])
    record, last, size, digest = None, None, 0, hashlib.sha256()
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("record_id", "segment", "piece", "data")]
        for own, segment, piece, data in zip(*columns):
            if own != record:
                if record is not None:
                    done.append({"record_id": record, "n_bytes": size, "digest": digest.hexdigest()})
                record, last, size, digest = own, None, 0, hashlib.sha256()
            if (segment, piece) != last:
                digest.update(data)
                size += len(data)
                last = (segment, piece)
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    if record is not None:
        yield pa.RecordBatch.from_pylist([{"record_id": record, "n_bytes": size, "digest": digest.hexdigest()}], schema=schema)


def summaries(chunks: DataFrame) -> DataFrame:
    """Length and digest of every response, whole or in pieces: record_id, n_bytes, digest."""
    pieces = chunks.filter(F.col("data").isNotNull()).select("record_id", "segment", "piece", "data")
    in_order = pieces.repartition("record_id").sortWithinPartitions("record_id", "segment", "piece")
    whole = chunks.filter((F.col("record_type") == "response") & F.col("data").isNull())
    return whole.select("record_id", "n_bytes", "digest").distinct().unionByName(in_order.mapInArrow(_carry, _SUMS))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """A row a record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit has the payload of the response that it refers to. A record whose digest is not
    the declared one fails the read.
    """
    chunks = stored(read_chunks(spark, path), "warc-chunks")
    heads = chunks.filter(F.col("record_type").isin("response", "revisit") & (F.col("piece") == 0))
    heads = heads.select("record_id", "page_id", "record_type", "refers_to", "declared").distinct()
    sums = summaries(chunks)
    responses = heads.filter("record_type = 'response'").join(sums, "record_id")
    damaged = F.raise_error(F.concat(F.lit("digest differs from the declared one: "), F.col("record_id")))
    responses = responses.withColumn("digest", F.when(F.col("declared") != F.col("digest"), damaged).otherwise(F.col("digest")))
    responses = stored(responses, "warc-responses")
    origin = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"), "n_bytes", "digest")
    revisits = heads.filter("record_type = 'revisit'").join(origin, "refers_to")
    columns = ["page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type"]
    return responses.select(*columns, F.lit(None).cast("bigint").alias("refers_to")).unionByName(
        revisits.select(*columns, F.col("_page").alias("refers_to"))
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes archives of ``pages`` to the shared folder and reads them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path)
    return read_back(pages.sparkSession, path)


def oracle() -> str:
    return f"""
WITH p AS (
    SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
    SELECT *, n >= {MIN_REVISIT_BYTES} AND row_number() OVER payload > 1 AS again, first_value(page_id) OVER payload AS first
    FROM p WINDOW payload AS (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS FIRST)
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM f
"""
