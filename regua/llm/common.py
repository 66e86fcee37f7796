"""What the operators of this package share: reading, shipping, stored steps, text batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import regua
from regua.session import scratch_path

#: Texts are worked on in pieces of about so many bytes, whatever the batches of Spark hold.
PIECE_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(regua.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="regua-package-")) / "regua_package.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for file in sorted(root.rglob("*.py")):
            bundle.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def store(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Write ``df`` to the shared folder, in a folder for each value of the columns ``folders``, and read it back.

    This cuts the lineage: a lost executor takes nothing with it, and columns
    that depend on how rows were dealt (row numbers) stay what they are.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, changed until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(column):
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def pieces(batch: pa.RecordBatch, text: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each piece stay near ``limit`` bytes; one row is never cut."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def texts_of(column: pa.Array) -> pa.Array:
    """The texts of a column, null as the empty text."""
    return column.cast(pa.string()).fill_null("")


def append(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array], list[pa.Array]],
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """``df`` with columns computed from whole texts, batch by batch.

    ``compute`` gets a column of texts as it is (with nulls) and returns an
    array for each of ``fields``. Names that ``df`` has already are refused.
    """
    ship(df.sparkSession)
    clash = {f.name.lower() for f in fields} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    at = df.columns.index(text)
    names = [*df.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, at, limit):
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, *compute(piece.column(at))], names=names
                )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes are split at exactly these six characters."""
    return text.split()


def held_out(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; an id that is null counts as not held out."""
    code = F.crc32(doc_id.cast("string").cast("binary")) % modulus
    return F.coalesce(code == remainder, F.lit(False))
