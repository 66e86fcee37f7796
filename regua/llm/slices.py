"""Documents packed into slices of bounded size, and blocks that travel between slices and buckets.

A slice holds a few megabytes of documents in one compressed row, so a join that
brings something back to documents moves few rows and little data. What slices
send out is cut by bucket and packed in the same way: one block for each bucket
that a slice has something for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from regua.llm.common import pieces, ship, store, texts_of

#: Bytes of text in a slice; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20

SCHEMA = T.StructType(
    [T.StructField("n_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def pack(table: pa.RecordBatch | pa.Table) -> bytes:
    """Arrow data as one compressed value."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def pack_array(values: np.ndarray) -> bytes:
    """Numbers as one compressed value; bytes of the same weight stand together."""
    planes = values.reshape(-1, 1).view(np.uint8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_array(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def slices(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Stored rows (slice, n_bytes, payload); a payload holds doc_id (as long) and text, null as empty."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for piece in pieces(batch, 1, limit):
                piece = pa.RecordBatch.from_arrays(
                    [piece.column(0), texts_of(piece.column(1))], names=["doc_id", "text"]
                )
                size = pc.sum(pc.binary_length(piece.column(1))).as_py() or 0
                if waiting and held + size > limit:
                    yield _row(waiting, held)
                    waiting, held = [], 0
                waiting.append(piece)
                held += size
        if waiting:
            yield _row(waiting, held)

    packed = narrow.mapInArrow(run, SCHEMA).withColumn("slice", F.monotonically_increasing_id())
    return store(packed, "slices")


def _row(waiting: list[pa.RecordBatch], held: int) -> pa.RecordBatch:
    whole = pa.Table.from_batches(waiting).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [pa.array([held], pa.int64()), pa.array([pack(whole)], pa.binary())], names=["n_bytes", "payload"]
    )


def open_slice(payload: bytes) -> tuple[list[int | None], pa.Array]:
    """Ids and texts of a slice."""
    table = unpack(payload)
    return table.column("doc_id").to_pylist(), table.column("text").combine_chunks()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts, and where those of each text begin, with the end at last."""
    lists = pc.ascii_split_whitespace(texts)
    words, cuts = lists.values, lists.offsets.to_numpy()
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    return words.filter(real), before[cuts]
