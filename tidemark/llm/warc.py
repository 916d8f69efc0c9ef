"""WARC archives, written and read as tables of record chunks.

A record is rows of (record id, chunk number, bytes): a payload is cut into
chunks of bounded size, written chunk by chunk into a gzip member of its own,
and read back chunk by chunk with a digest that is carried along, so neither
side's Python ever holds a whole record. Payloads that equal another's become
revisit records, which carry headers alone.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import tidy

from tidemark.llm.files import publish, resolve

#: Bytes of a chunk at most.
CHUNK = 1 << 20
#: Fixed values of the format.
VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The date of records whose source has none.
DATE = "1970-01-01T00:00:00Z"
_READ = 1 << 16


def record_uri(record_id: int | None) -> str:
    return f"<urn:page:{'null' if record_id is None else record_id}>"


def _id_of(uri: str) -> int | None:
    value = uri.rpartition(":")[2].rstrip(">")
    return None if value == "null" else int(value)


def _clean(value: str) -> str:
    """A header's value: one line, without spaces at its ends."""
    return " ".join(value.split())


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """(record_id, url, payload, payload_bytes, sha1, refers_to): what is to be written.

    Of records with equal payloads of at least ``least`` bytes the one with the
    largest id is the response and the others refer to it; a null payload is an
    empty one. Copies of one id are all responses; a null id never is one if any
    equal payload has an id. Counting by digest is combined before the shuffle;
    only digests that occur twice are joined back, and a hot one is split.
    """
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    records = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    records = records.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    groups = records.where(F.col("payload_bytes") >= least).groupBy("sha1", "payload_bytes").agg(F.max("record_id").alias("response"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select(F.col("sha1").alias("of"), F.col("payload_bytes").alias("size"), "response")
    joined = records.join(groups, (F.col("sha1") == F.col("of")) & (F.col("payload_bytes") == F.col("size")), "left")
    refers = F.when(~F.col("response").eqNullSafe(F.col("record_id")), F.col("response"))
    return joined.select("record_id", "url", "payload", "payload_bytes", "sha1", refers.alias("refers_to"))


def chunked(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(record_id, url, payload_bytes, sha1, refers_to, chunk_no, data): at least one row a record, in order.

    A revisit record has one row without data.
    """
    last = F.when(F.col("refers_to").isNotNull() | (F.col("payload_bytes") == 0), F.lit(0)).otherwise(F.ceil(F.col("payload_bytes") / chunk).cast("int") - 1)
    rows = records.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    data = F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)))
    return rows.select("record_id", "url", "payload_bytes", "sha1", "refers_to", "chunk_no", data.alias("data"))


def _opening(row: dict, date: str) -> bytes:
    """Headers of a record, and those of its HTTP message."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    revisit = row["refers_to"] is not None
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_uri(row["record_id"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(row["url"] or "") or record_uri(row["record_id"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + (0 if revisit else row["payload_bytes"]))),
    ]
    if revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(row["refers_to"]))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + http


def write(records: DataFrame, path: str, date: str = DATE, level: int = 5, chunk: int = CHUNK) -> list[str]:
    """Write planned() records as one .warc.gz for each task; returns their names.

    Every record is a gzip member. Only a name for each archive comes to the
    driver; an empty table gives none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        full = (b for b in batches if b.num_rows)
        first = next(full, None)
        if first is None:
            return
        archive = f"{path}/part-{part:06d}.warc.gz"
        with publish(archive) as out:
            packer = None
            for batch in chain([first], full):
                for k in range(batch.num_rows):
                    row = {c: batch.column(c)[k].as_py() for c in ("record_id", "url", "payload_bytes", "sha1", "refers_to", "chunk_no", "data")}
                    if row["chunk_no"] == 0:
                        if packer:
                            out.write(packer.compress(END) + packer.flush())
                        packer = zlib.compressobj(level, wbits=31)
                        out.write(packer.compress(_opening(row, date)))
                    if row["data"]:
                        out.write(packer.compress(row["data"]))
            out.write(packer.compress(END) + packer.flush())
        yield pa.record_batch([pa.array([archive])], ["archive"])

    return sorted(r.archive for r in chunked(records, chunk).mapInArrow(tidy(run), "archive string").collect())


class _Stream:
    """The plain bytes of a file of gzip members, a bounded buffer at a time."""

    def __init__(self, file) -> None:
        self.file, self.buffer, self.packed, self.ended = file, b"", b"", False
        self.unpack = zlib.decompressobj(wbits=31)

    def _fill(self) -> bool:
        while not self.ended:
            if self.unpack.eof:
                self.packed = self.unpack.unused_data
                self.unpack = zlib.decompressobj(wbits=31)
            if not self.packed:
                self.packed = self.file.read(_READ)
                if not self.packed:
                    self.ended = True
                    return False
            got = self.unpack.decompress(self.packed, _READ * 4)
            self.packed = self.unpack.unconsumed_tail
            if got:
                self.buffer += got
                return True
        return False

    def head(self) -> list[tuple[str, str]] | None:
        """First line and headers up to the empty line; None at the end of the file."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._fill():
                if self.buffer.strip():
                    raise ValueError("the archive ends within a record")
                return None
        lines, self.buffer = self.buffer[:at].decode("utf-8", "replace").split("\r\n"), self.buffer[at + 4 :]
        return [("", lines[0]), *((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))]

    def take(self, most: int) -> bytes:
        """Up to ``most`` bytes, at least one."""
        if not self.buffer and not self._fill():
            raise ValueError("the archive ends within a record")
        got, self.buffer = self.buffer[:most], self.buffer[most:]
        return got

    def skip(self, size: int) -> None:
        while size:
            size -= len(self.take(size))


def records_of(file, chunk: int = CHUNK) -> Iterator[tuple]:
    """(headers, payload bytes declared, chunk number, data, bytes so far, digest so far, last) of one archive."""
    stream = _Stream(file)
    while (head := stream.head()) is not None:
        fields = dict(head)
        block = int(fields["content-length"])
        http = dict(stream.head() or [])  # part of the block
        declared = int(http["content-length"])
        body = 0 if fields["warc-type"] == "revisit" else declared
        digest, done, number = hashlib.sha1(), 0, 0
        while True:
            parts, size = [], 0
            while size < min(chunk, body - done):
                parts.append(stream.take(min(chunk, body - done) - size))
                size += len(parts[-1])
            data = b"".join(parts)
            digest.update(data)
            done += size
            last = done == body
            yield fields, declared, number, data, done, base64.b32encode(digest.digest()).decode(), last
            number += 1
            if last:
                break
        if body and f"sha1:{base64.b32encode(digest.digest()).decode()}" != fields["warc-payload-digest"] or block < body:
            raise ValueError(f"record {fields['warc-record-id']} doesn't match its digest or length")
        stream.skip(4)


CHUNK_ROWS = "record_id bigint, record_type string, target_uri string, refers_to bigint, payload_bytes bigint, payload_digest string, chunk_no int, data binary, bytes_so_far bigint, sha1_so_far string, last boolean"


def read_chunks(spark: SparkSession, archives: list[str], chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk table of these archives (columns: CHUNK_ROWS).

    payload_bytes and payload_digest are those declared, of the full payload;
    bytes_so_far and sha1_so_far are carried from chunk to chunk of what was
    read. A payload is checked against its digest when its last chunk is read.
    """
    names = [x.split()[0] for x in CHUNK_ROWS.split(", ")]
    types = [{"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[x.split()[1]] for x in CHUNK_ROWS.split(", ")]

    def rows(archive: str) -> Iterator[tuple]:
        fs, path = resolve(archive)
        with fs.open_input_stream(path, compression=None) as file:
            for fields, declared, number, data, done, digest, last in records_of(file, chunk):
                refers = fields.get("warc-refers-to")
                yield (
                    _id_of(fields["warc-record-id"]),
                    fields["warc-type"],
                    fields["warc-target-uri"],
                    None if refers is None else _id_of(refers),
                    declared,
                    fields["warc-payload-digest"].removeprefix("sha1:"),
                    number,
                    data if with_data else None,
                    done,
                    digest,
                    last,
                )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                some, size = [], 0
                for row in rows(archive):
                    some.append(row)
                    size += len(row[7] or b"") + 100
                    if size > 4 * CHUNK:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names)
                        some, size = [], 0
                if some:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names)

    table = spark.createDataFrame([(a,) for a in archives], "archive string")
    if len(archives) > 1:
        table = table.repartition(len(archives))
    return table.mapInArrow(tidy(run), CHUNK_ROWS)


def summaries(chunks: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id_col, payload_bytes, payload_digest, record_type, refers_to): a row for each record."""
    return chunks.where("last").select(F.col("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
