"""Exact duplicates by distributed most-significant-digit radix partitioning.

All documents start in one group. Each level splits every group by the next
stretch of the normalised text; groups with one member are done, and so are
groups whose texts end inside the stretch, because their members agree on
every byte. Stretches grow, so a text of n characters takes O(log n) levels.
Equality rests on the characters alone; no digest is compared.

Only ids, group numbers and the stretch of a level are shuffled, never whole
texts. Members of a group are counted with map-side sums and learn their new
group from a join that the adaptive skew join can split, so a group that holds
a third of all rows never meets in one task. Joins are sort-merge joins at every
size, since the number of rows still alive is not bounded.

Defined results: a null text is an empty text; all empty texts are one group;
of rows with the same largest id exactly one stays; null ids count as smaller
than any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from regua.llm.common import append, ascii_lower, store, texts_of, unused

#: Characters of the first stretch, growth from level to level, and the longest stretch.
FIRST, GROWTH, LONGEST = 64, 4, 1 << 18


def _digest(column: pa.Array) -> list[pa.Array]:
    lowered = pc.ascii_lower(texts_of(column)).cast(pa.binary())
    return [pa.array([hashlib.sha256(x.as_buffer()).digest() for x in lowered], pa.binary())]


def numbered(docs: DataFrame, row: str, sha: str, text: str = "text") -> DataFrame:
    """``docs`` stored with a row number and the SHA-256 of the normalised text (an output, never compared)."""
    made = append(docs, text, [T.StructField(sha, T.BinaryType())], _digest)
    return store(made.withColumn(row, F.monotonically_increasing_id()), "numbered")


def groups(base: DataFrame, row: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, keep_row, keep_id, group_size) for each row of ``base``, a stored table with unique ``row``."""
    body = F.coalesce(F.col(text), F.lit(""))
    length = F.char_length(body)
    alive, done, start, width = None, [], 0, FIRST
    while True:
        stretch = ascii_lower(F.substring(body, start + 1, width)).alias("stretch")
        ends = (length < start + width).alias("ends")
        rows = base.where(length >= start).select(
            F.col(row).alias("r"), F.col(doc_id).alias("id"), stretch, ends
        )
        if alive is None:
            members = rows.withColumn("g", F.lit(0).cast("long"))
        else:
            members = rows.join(alive.hint("merge"), "r")
        members = members if alive is None else store(members, "members")
        splits = store(
            members.groupBy("g", "stretch")
            .agg(
                F.min("r").alias("next_g"),
                F.count(F.lit(1)).alias("n"),
                # Largest id, null ids last, the first row of equal ids.
                F.max(F.struct(F.col("id").isNotNull(), F.col("id"), -F.col("r"))).alias("best"),
            )
            .where("n > 1")
            .select(
                "g",
                "stretch",
                "next_g",
                "n",
                F.col("best.id").alias("keep_id"),
                (-F.col("best.col3")).alias("keep_row"),
            ),
            "splits",
        )
        level = store(
            members.join(splits.hint("merge"), ["g", "stretch"], "left").select(
                "r",
                F.col("next_g").alias("g"),
                F.coalesce("n", F.lit(1).cast("long")).alias("n"),
                F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("keep_row", "r").alias("keep_row"),
                (F.col("n").isNull() | F.col("ends")).alias("done"),
            ),
            "level",
        )
        done.append(level.where("done").select("r", "keep_row", "keep_id", "n"))
        alive = level.where("not done").select("r", "g")
        if alive.isEmpty():
            break
        start, width = start + width, min(width * GROWTH, LONGEST)
    result = done[0]
    for part in done[1:]:
        result = result.unionAll(part)
    return result.select(
        F.col("r").alias(row), "keep_row", "keep_id", F.col("n").alias("group_size")
    )


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    base = numbered(docs, "row", "sha")
    found = groups(base, "row")
    return base.select("row", "doc_id", "sha").join(found.hint("merge"), "row").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row, sha = unused(docs, "row_number"), unused(docs, "text_digest")
    base = numbered(docs, row, sha, text)
    extra = groups(base, row, doc_id, text).where(F.col(row) != F.col("keep_row")).select(row)
    return base.join(extra.hint("merge"), row, "left_anti").select(docs.columns)
