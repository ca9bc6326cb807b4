"""WARC archives: writing, normalising to one gzip member for each record, reading by index.

Archives are first written as a plain text sink writes them: many records in one gzip stream
(the record end is the line separator). Such a file can only be read from its start. The
normaliser inflates each file once, as a stream, and writes every record as a gzip member of
its own into a new archive; the table it returns (file, offset, length of each record) is the
sidecar index, by which any record is read on its own.

Archive files lie in a shared folder and are opened by URI on the executors. A task that is
run again writes files of a new name; only those that the index names count.
"""

from __future__ import annotations

import gzip
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import join_back

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
READ_BYTES = 1 << 20
ROWS_OUT = 256            # records handed back at once
INDEX_ROWS = 5_000        # index rows handed on at once
MIN_REVISIT_BYTES = 1000  # smaller payloads are always written in full

INDEX = "file string, offset long, length long, record_id string, warc_type string"
RECORDS = "record_id string, warc_type string, payload_bytes long, payload_digest string, refers_to string, body binary"


def record_text(record_id: Column, uri: Column, kind: Column, digest: Column, size: Column, refers_to: Column, body: Column) -> Column:
    """A record without its end. Revisits have no body; digest and size are those of the full payload."""
    body = F.when(kind == "response", F.coalesce(body, F.lit(""))).otherwise("")
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    clean = F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\r\n]", " ")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), record_id, F.lit(">"))),
        line("WARC-Target-URI", clean), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Payload-Length", size.cast("string")),
        F.when(refers_to.isNotNull(), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers_to, F.lit(">")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(CRLF), body)


def page_records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", body_col: str = "html",
                 least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(value): one WARC record for each page.

    Of pages with equal payloads of at least `least` bytes, that with the largest id is the
    response and the others revisit it. The largest id of each payload digest is taken by an
    aggregate that combines before its shuffle, and comes back by a join that can split a
    payload with very many copies. A null body is an empty payload. A page with a null id has
    an empty record id and revisits only if another page has the same payload and an id;
    repeated ids stay repeated, and the rows of the largest id are all responses.
    """


    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).alias("uri"), body.alias("body"))
    rows = rows.withColumns({"size": F.octet_length("body").cast("long"), "digest": F.sha1(F.col("body"))})
    large = rows.filter(F.col("size") >= least)
    first = large.groupBy("digest").agg(F.max("id").alias("first"))
    big = join_back(large, first, ["digest"])
    rows = rows.filter(F.col("size") < least).withColumn("first", F.lit(None).cast("long")).unionByName(big)
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    refers = F.when(again, F.col("first").cast("string"))
    return rows.select(record_text(F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("uri"), kind, F.col("digest"), F.col("size"), refers, F.col("body")).alias("value"))


def write_monolithic(records: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """Write the records as gzip files of one stream each, into a folder that must not exist."""
    (records.write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", rows_per_file).text(path))


def archive_files(spark, path: str) -> DataFrame:
    """(path) of the archives in a folder; their contents are not read here."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path")


@dataclass
class Record:
    head: bytes
    fields: dict[str, str]
    body: bytes


def open_uri(uri: str):
    """File system and path of a URI (file, hdfs, s3, gs), on the machine that runs this."""
    uri = uri.replace("file:///", "/", 1) if uri.startswith("file:///") else uri
    if uri.startswith("file:/"):
        uri = uri[5:]
    return pafs.FileSystem.from_uri(uri)


def inflated(stream) -> Iterator[bytes]:
    """The plain bytes of a gzip stream of one or more members, piece by piece."""
    unzip = zlib.decompressobj(31)
    while piece := stream.read(READ_BYTES):
        while piece:
            out = unzip.decompress(piece, READ_BYTES)
            if out:
                yield out
            piece = unzip.unconsumed_tail
            if unzip.eof:
                piece, unzip = unzip.unused_data, zlib.decompressobj(31)
    if rest := unzip.flush():
        yield rest


def parse(pieces: Iterator[bytes]) -> Iterator[Record]:
    """Records of a stream; no more than one record and one piece are held."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while fill(2) and held[:2] == b"\r\n":  # a piece may begin anywhere in the end of a record
            del held[:2]
        if not held:
            return
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            at = max(0, len(held) - 3)
            if not fill(len(held) + 1):
                raise ValueError("a WARC record ends within its header")
        head = bytes(held[:end + 4])
        lines = head.decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        size = int(fields.get("content-length", "0"))
        if not fill(len(head) + size):
            raise ValueError("a WARC record ends within its body")
        yield Record(head, fields, bytes(held[len(head):len(head) + size]))
        del held[:len(head) + size]


def _normalise(target: str):
    def run(batches):
        fs, folder = open_uri(target)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                source, path = open_uri(uri)
                name = f"{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with source.open_input_file(path) as stream, fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
                    for r in parse(inflated(stream)):
                        member = gzip.compress(r.head + r.body + RECORD_END.encode(), 6, mtime=0)
                        out.write(member)
                        rows.append((f"{target}/{name}", offset, len(member), _id(r, "warc-record-id"), r.fields.get("warc-type")))
                        offset += len(member)
                        if len(rows) >= INDEX_ROWS:
                            yield _index_batch(rows)
                            rows = []
                if rows:
                    yield _index_batch(rows)
    return run


def _index_batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["file", "offset", "length", "record_id", "warc_type"])


def _id(r: Record, name: str) -> str | None:
    value = r.fields.get(name)
    return value.removeprefix("<urn:page:").removesuffix(">") if value is not None else None


def normalise(files: DataFrame, target: str) -> DataFrame:
    """The sidecar index of new archives in `target` with one member for each record of files.

    Each file is one task's stream: what is held is one record, a read buffer and INDEX_ROWS
    rows of the index, however long the file. The index must be written once before it is read (a task that runs again makes
    a new file). Empty files give no rows; a broken record is an error with its reason.
    """
    spark = files.sparkSession
    many = max(1, spark.sparkContext.defaultParallelism * 4)
    fs, folder = open_uri(target)
    fs.create_dir(folder, recursive=True)
    return files.repartition(many).mapInArrow(_normalise(target), INDEX)


def _read(batches):
    for batch in batches:
        rows, opened = [], {}
        for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if file not in opened:
                for old in opened.values():
                    old.close()
                fs, path = open_uri(file)
                opened = {file: fs.open_input_file(path)}
            data = gzip.decompress(opened[file].read_at(length, offset))
            r = next(parse(iter([data])))
            rows.append((_id(r, "warc-record-id"), r.fields.get("warc-type"), int(r.fields.get("warc-payload-length", len(r.body))),
                         r.fields.get("warc-payload-digest", "").removeprefix("sha1:"), _id(r, "warc-refers-to"), r.body))
            if len(rows) >= ROWS_OUT:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)
        for old in opened.values():
            old.close()


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[
        "record_id", "warc_type", "payload_bytes", "payload_digest", "refers_to", "body"])


def read_records(index: DataFrame) -> DataFrame:
    """The records that the index names, each inflated from its own member."""
    return index.select("file", "offset", "length").mapInArrow(_read, RECORDS)
