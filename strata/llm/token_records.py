"""Token ids as length-delimited binary records with a separate offset index.

One file a task, records in ascending document order over all files.  A record
is framed as in the TFRecord layout::

    uint64 length | uint32 masked checksum of the length | payload | uint32 masked checksum of the payload

with CRC-32 (zlib) as the checksum and the usual mask (rotate right by 15, add
a constant), all little-endian.  The payload is a byte (1: it has a doc_id),
the doc_id as int64, and the ids as uint16 or uint32 as the vocabulary needs.

The index is a Parquet table with one row a record: file, offset, length,
number of ids, and number of ids before it in its file.  A task names its file
uniquely and the index rows it returns are committed by Spark's Parquet
writer, so the files of failed or repeated attempts are never read.  Any subset
or order of index rows can be read; records that lie next to each other are
fetched by one read.

Cases: null text counts as empty (a record with the end id only); a null
doc_id sorts first and is kept; rows that share a doc_id are ordered by text;
an empty table gives an empty index; other columns are ignored.  A record
that fails its checksum raises.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import map_rows, unit_interval
from strata.llm.tokenization import shared_encoder

_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_ID = struct.Struct("<Bq")
_SUM = struct.Struct("<I")
READ_SPAN = 8 << 20

INDEX = "file string, part int, doc_id long, position long, offset long, length long, n_tokens long, tokens_before long"
_INDEX_ARROW = pa.schema([
    ("file", pa.string()), ("part", pa.int32()), ("doc_id", pa.int64()), ("position", pa.int64()),
    ("offset", pa.int64()), ("length", pa.int64()), ("n_tokens", pa.int64()), ("tokens_before", pa.int64()),
])


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    payload = _ID.pack(doc_id is not None, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return size + _SUM.pack(masked_checksum(size)) + payload + _SUM.pack(masked_checksum(payload))


def unframe(record: bytes) -> tuple[int | None, bytes]:
    """``(doc_id, ids)``; raises on a damaged record."""
    size, size_sum = _HEAD.unpack_from(record)
    payload = record[_HEAD.size : -_SUM.size]
    if masked_checksum(record[:8]) != size_sum or size != len(payload):
        raise ValueError("damaged record: length")
    if masked_checksum(payload) != _SUM.unpack(record[-_SUM.size :])[0]:
        raise ValueError("damaged record: payload")
    has_id, doc_id = _ID.unpack_from(payload)
    return doc_id if has_id else None, payload[_ID.size :]


def open_store(uri: str):
    """``(file system, path)`` of a folder on shared storage (file, hdfs, s3, gs)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, dtype: str = "<u2") -> DataFrame:
    """Encode and write every document under ``folder``; returns the index."""

    def kernel(rows: Iterator[tuple]) -> Iterator[tuple]:
        store, root = open_store(f"{folder}/records")
        part = TaskContext.get().partitionId()
        encoder = shared_encoder(tokenizer, True, dtype)
        out, name, at, before = None, f"part-{part:06d}-{uuid.uuid4().hex}.rec", 0, 0
        width = encoder.dtype.itemsize
        end = end_id.to_bytes(width, "little")
        try:
            for position, (doc_id, ids) in enumerate(encoder.encode_rows(rows)):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}", buffer_size=1 << 20)
                ids += end
                record = frame(doc_id, ids)
                out.write(record)
                n = len(ids) // width
                yield f"{folder}/records/{name}", part, doc_id, position, at, len(record), n, before
                at, before = at + len(record), before + n
        finally:
            if out is not None:
                out.close()

    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    index = ordered.mapInArrow(map_rows(kernel, ["doc_id", "text"], _INDEX_ARROW), INDEX)
    index.write.mode("errorifexists").parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index rows in an order fixed by the seed, for shuffled reads."""
    return index.orderBy(unit_interval(F.concat_ws(":", "file", "offset"), seed), "file", "offset")


def _spans(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Runs of records that lie next to each other in one file."""
    run: list[tuple] = []
    end = size = 0
    for row in rows:
        file, _, _, offset, length = row[:5]
        if run and (file != run[0][0] or offset != end or size + length > READ_SPAN):
            yield run
            run, size = [], 0
        run.append(row)
        end, size = offset + length, size + length
    if run:
        yield run


def read_records(index: DataFrame) -> DataFrame:
    """``(part, position, tokens_before, doc_id, ids)`` of the index rows, read
    from the files and verified; ``ids`` as stored."""
    schema = pa.schema([("part", pa.int32()), ("position", pa.int64()), ("tokens_before", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def kernel(rows: Iterator[tuple]) -> Iterator[tuple]:
        opened, source, store = None, None, None
        for run in _spans(rows):
            file, first = run[0][0], run[0][3]
            if file != opened:
                if source is not None:
                    source.close()
                store, path = open_store(file)
                source, opened = store.open_input_file(path), file
            block = source.read_at(run[-1][3] + run[-1][4] - first, first)
            for _, part, position, offset, length, before in run:
                doc_id, ids = unframe(block[offset - first : offset - first + length])
                yield part, position, before, doc_id, ids
        if source is not None:
            source.close()

    names = ["file", "part", "position", "offset", "length", "tokens_before"]
    return index.select(*names).mapInArrow(map_rows(kernel, names, schema, 512), "part int, position long, tokens_before long, doc_id long, ids binary")


def file_starts(index: DataFrame) -> DataFrame:
    """``(part, ids_before_file)``: one row a file, so one window is small."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ids_before_file"))
