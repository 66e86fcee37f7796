"""Importance resampling towards a target, with features counted once for each distinct line.

Features of a text are its runs of 1 to ``longest`` consecutive words, hashed into
buckets. Newlines cut texts into lines, and no word crosses one. For the corpus
counts, lines are grouped with their number of occurrences (equal ones of a task
before the shuffle), the features of each distinct line are counted once and
multiplied by the occurrences, and runs that cross lines are added from the
documents apart. Scoring works the same way within each batch: the gains of each
distinct line are added up once and given to every document that holds it.

A bucket's gain is the floored log ratio of its smoothed shares in target and corpus,
in thousandths. A document's weight is the floored mean gain of its features.
Gumbel noise from the document's id makes the highest scores a draw without
replacement in proportion to the weights. Ranks come from counts by score, since
scores are whole numbers within narrow bounds (tens of thousands of values at any
size), and from the order within one score.

The driver gets one gain for each bucket and, of the counts by score, the lowest
score drawn.

Defined results: a null or empty text has no features and weight 0; a document
without an id has no score and takes no part in the draw; rows of one id and score are
ranked in any order; repeated rows count as often as they stand; with empty tables
all gains are 0; other columns are ignored (``resample`` keeps them).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from regua.llm.common import append, ascii_lower, pieces, ship, store, texts_of, unused

LONGEST, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COUNTS = "bucket int, n long"


# --- features ---------------------------------------------------------------------


class Words:
    """The words of lower-cased texts: the crc32 of each, their names, and where those of each text begin."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern_regex(texts, NOT_WORDS)
        words, cuts = lists.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
        real = pc.greater(pc.binary_length(words), 0)
        before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
        coded = words.filter(real).dictionary_encode()
        self.names = [n.as_buffer().to_pybytes() for n in coded.dictionary]
        self.at = coded.indices.to_numpy(zero_copy_only=False)
        self.cuts = before[cuts].astype(np.int64)

    def runs(self, longest: int, buckets: int, line: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of every run of 1 to ``longest`` words within a text.

        With ``line``, a number for each word, only of runs that cross lines.
        """
        text = np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))
        single = np.fromiter(map(zlib.crc32, self.names), np.int64, len(self.names))
        texts, codes = [text], [single[self.at] % buckets]
        if line is not None:
            texts, codes = [], []
        if longest > 1:
            tails = [b" " + n for n in self.names]
            code = single[self.at]
        for n in range(2, longest + 1):
            # The code of a run goes on from the code of the run without its last word.
            code = np.fromiter(
                (zlib.crc32(tails[w], c) for w, c in zip(self.at[n - 1 :].tolist(), code.tolist())),
                np.int64,
                max(0, len(self.at) - n + 1),
            )
            within = text[n - 1 :] == text[: len(code)]
            if line is not None:
                within &= line[n - 1 :] != line[: len(code)]
            texts.append(text[: len(code)][within])
            codes.append(code[within] % buckets)
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(texts), np.concatenate(codes)


class Lines:
    """Distinct lines of lower-cased texts, and which of them each text holds, one entry for each time."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(texts, "\n")
        coded = lists.flatten().dictionary_encode()
        self.distinct = coded.dictionary
        self.at = coded.indices.to_numpy(zero_copy_only=False)
        self.text = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
        self.texts = texts

    def crossing(self, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of the runs that cross lines."""
        own = Words(self.distinct)
        sizes = np.diff(own.cuts)[self.at]
        line = np.repeat(np.arange(len(self.at)), sizes)
        return Words(self.texts).runs(longest, buckets, line)


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""
    ship(texts.sparkSession)
    lowered = texts.select(ascii_lower(F.col(text)).alias("text")).where(F.length("text") > 0)
    lines = lowered.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line") > 0)
    distinct = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times"))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, 0):
                line, bucket = Words(piece.column(0)).runs(longest, buckets)
                # Whole numbers, added up as such.
                np.add.at(total, bucket, piece.column(1).to_numpy()[line])
        yield _counted(total)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, 0):
                _, bucket = Lines(piece.column(0)).crossing(longest, buckets)
                total += np.bincount(bucket, minlength=buckets)
        yield _counted(total)

    found = distinct.mapInArrow(within, COUNTS)
    if longest > 1:
        found = found.unionAll(lowered.where(F.contains("text", F.lit("\n"))).mapInArrow(across, COUNTS))
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def _counted(total: np.ndarray) -> pa.RecordBatch:
    held = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the counts (bucket, n) of corpus and target."""
    both = (
        corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
        .unionAll(target.select("bucket", F.lit(0).cast("long"), "n"))
        .unionAll(
            corpus.sparkSession.range(buckets).select(F.col("id").cast("int"), F.lit(0).cast("long"), F.lit(0).cast("long"))
        )
        .groupBy("bucket")
        .agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    )
    both = store(both, "bucket_counts")
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    ratio = (F.col("t") + 1) * F.lit(all_s + buckets) / ((F.col("s") + 1) * F.lit(all_t + buckets))
    return both.select("bucket", F.floor(F.lit(1000) * F.ln(ratio)).alias("gain"))


def weights(
    docs: DataFrame, gain: np.ndarray, text: str = "text", names: tuple[str, str, str] = ("n_words", "n_features", "weight"),
    longest: int = LONGEST,
) -> DataFrame:
    """``docs`` with its number of words, number of features, and the floored mean of its features' gains."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def compute(column: pa.Array) -> list[pa.Array]:
        lines = Lines(pc.ascii_lower(texts_of(column)))
        own, n = Words(lines.distinct), len(lines.distinct)
        gain, rows = held.value, len(column)
        line, bucket = own.runs(longest, len(gain))
        words, features, total = (np.zeros(rows, np.int64) for _ in range(3))
        per_line = np.zeros(n, np.int64)
        np.add.at(per_line, line, gain[bucket])
        np.add.at(words, lines.text, np.diff(own.cuts)[lines.at])
        np.add.at(features, lines.text, np.bincount(line, minlength=n)[lines.at])
        np.add.at(total, lines.text, per_line[lines.at])
        if longest > 1:
            doc, bucket = lines.crossing(longest, len(gain))
            features += np.bincount(doc, minlength=rows)
            np.add.at(total, doc, gain[bucket])
        mean = np.where(features > 0, total // np.maximum(features, 1), 0)
        return [pa.array(words), pa.array(features), pa.array(mean)]

    return append(docs, text, [T.StructField(name, T.LongType()) for name in names], compute)


# --- drawing ----------------------------------------------------------------------


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of an id in thousandths; null without an id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """Stored rows (doc_id, n_features, weight, score, eligible, ...) with ``rank``: the ``drawn`` highest scores from 1 on."""
    rank = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.select("*", rank)
    counts = scored.where("eligible").groupBy("score").count()
    ahead = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("score", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    before = store(before.where(F.col("before") < drawn), "scores_drawn")
    lowest = before.agg(F.min("score")).first()[0]
    chosen = F.col("eligible") & (F.col("score") >= lowest)
    within = F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features", "weight"))
    place = F.col("before") + within
    high = scored.where(chosen).join(before, "score").withColumn("rank", place).select(
        *scored.columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    )
    return high.unionAll(scored.where(~F.coalesce(chosen, F.lit(False))).select("*", rank))


def _scored(
    docs: DataFrame, target: DataFrame, longest: int, buckets: int, seed: int, least_words: int
) -> DataFrame:
    """Stored rows (doc_id, row, n_features, weight, score, eligible)."""
    table = gains(bucket_counts(docs, "text", longest, buckets), bucket_counts(target, "text", longest, buckets), buckets)
    gain = np.zeros(buckets, np.int64)
    for bucket, value in table.collect():
        gain[bucket] = value
    scored = weights(docs, gain, longest=longest).select(
        "doc_id",
        "row",
        "n_features",
        "weight",
        (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
        (F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)).alias("eligible"),
    )
    return store(scored, "scored")


def importance(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    row: Column | None = None,
) -> DataFrame:
    """One row for each document: doc_id, n_features, weight, score, rank (null if not drawn)."""
    narrow = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        (F.lit(0).cast("long") if row is None else row).alias("row"),
    )
    scored = _scored(narrow, target.select(F.col(target_text).alias("text")), longest, buckets, seed, least_words)
    drawn = scored.where("eligible").count() * percent // 100
    out = ranked(scored, drawn)
    return out.select("doc_id", "n_features", "weight", "score", "rank", *(["row"] if row is not None else []))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows drawn, with all columns of ``docs`` (options as of ``importance``)."""
    number = unused(docs, "row_number")
    base = store(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = importance(base, target, doc_id=doc_id, text=text, row=F.col(number), **options)
    kept = found.where(F.col("rank").isNotNull()).select(F.col("row").alias(number))
    return base.join(kept.hint("merge"), number, "left_semi").select(docs.columns)
