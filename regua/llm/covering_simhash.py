"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Fingerprint: 64 bits; a bit is 1 when more than half of the shingle hashes have it.

Search: each bit position gets a random vector of ``radius + 1`` bits, and each
nonzero vector v of that size makes a mask that keeps the positions whose vector
has an odd product with v. ``radius`` differing positions span at most ``radius``
dimensions, so some v is orthogonal to all of them and its mask keeps none:
every pair within the radius collides in at least one of the 2^(radius+1) - 1
tables. No pair is missed by chance.

Verification within a table: two fingerprints differ in at most 2 bits exactly
if some point is at most 1 bit away from both. So members of a bucket are listed
at themselves and at their one-bit neighbours (only the bits that the mask drops
can differ), and fingerprints that meet at a point are linked. At most 65 distinct
fingerprints can meet at one point, whatever the size of the bucket, so no pairs
of a bucket are formed. Links of radius 1 meet at one of the two fingerprints.

Defined results: null and empty texts have fingerprint zero and link as any
other; the component of rows without any id has a null id; an empty table gives
no rows; repeated rows link to each other; other columns are ignored.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from regua.llm.common import append, store, texts_of, unused
from regua.llm.components import connected_components

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
#: Shingles whose bits are spread out at once.
BLOCK = 1 << 15


def simhash(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Fingerprint of a list of words."""
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -shingle] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(text[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())],
        np.uint64,
        len(words) - shingle + 1,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(column: pa.Array) -> list[pa.Array]:
    lowered = pc.ascii_lower(texts_of(column)).cast(pa.binary())
    prints = [simhash(x.as_py().split()) for x in lowered]
    return [pa.array(np.array(prints, np.uint64).view(np.int64))]


def fingerprints(docs: DataFrame, name: str = "fingerprint", text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint of its text as a signed long."""
    return append(docs, text, [T.StructField(name, T.LongType())], _fingerprints)


def covering_masks(radius: int = RADIUS, bits: int = BITS, seed: int = 7) -> list[int]:
    """The masks of the tables. Positions get the nonzero vectors in turn, in shuffled order, so masks keep about half."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    random.Random(seed).shuffle(vectors)
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame, name: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within ``radius`` (1 or 2) bits of each other."""
    if radius not in (1, 2):
        raise ValueError("points between fingerprints verify a radius of 1 or 2")
    masks = covering_masks(radius)
    tables = F.array(
        *(
            F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for k, m in enumerate(masks)
        )
    )
    rows = prints.select(F.col(name).alias("fp")).select("fp", F.inline(tables))
    full = store(rows.groupBy("k", "key").count().where("count > 1").select("k", "key"), "buckets")
    members = rows.join(full, ["k", "key"], "left_semi").select("k", "fp")
    dropped = F.element_at(
        F.array(
            *(
                F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << i)) for i in range(BITS) if not m >> i & 1))
                for m in masks
            )
        ),
        F.col("k") + 1,
    )
    points = (
        members.repartition("fp")
        .select("k", "fp", F.explode(dropped).alias("flip"))
        .select("k", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "flip")
    )
    if radius == 1:
        # At radius 1 the point must be one of the two.
        raise_to = F.min(F.when(F.col("flip") == 0, F.col("fp")))
    else:
        raise_to = F.min("fp")
    lead = raise_to.over(Window.partitionBy("k", "point"))
    return points.select(F.col("fp").alias("u"), lead.alias("v")).where("u <> v").distinct()


def components(base: DataFrame, fp: str, doc_id: str, row: str) -> DataFrame:
    """(fp, component_id, keep_row) for each distinct fingerprint of a stored table."""
    first = F.struct(F.col(doc_id).isNull(), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    prints = store(base.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")), "prints")
    found = store(connected_components(links(prints)), "components")
    linked = store(
        found.join(prints, found.node == prints.fp)
        .groupBy("root")
        .agg(F.min("first").alias("smallest")),
        "smallest",
    )
    roots = found.join(linked, "root").select(F.col("node").alias("fp"), "smallest")
    best = F.coalesce("smallest", "first")
    return store(
        prints.join(roots, "fp", "left").select(
            "fp", best["id"].alias("component_id"), best["row"].alias("keep_row")
        ),
        "members",
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, fingerprint (hex), component_id."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    base = fingerprints(docs, "fp").select("doc_id", "fp")
    base = store(base.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    found = components(base, "fp", "doc_id", "row")
    return base.join(found, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest id of each component, with all columns of ``docs``."""
    row, fp = unused(docs, "row_number"), unused(docs, "fingerprint")
    base = store(
        fingerprints(docs, fp, text).withColumn(row, F.monotonically_increasing_id()), "printed"
    )
    found = components(base, fp, doc_id, row)
    kept = found.select(F.col("keep_row").alias(row)).distinct()
    return base.join(kept.hint("merge"), row, "left_semi").select(docs.columns)
