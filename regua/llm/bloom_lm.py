"""Language-model scoring with a log-frequency Bloom filter that is broadcast to the workers.

Counts of n-grams are quantised to levels: level j stands for counts from
``BASE**(j - 1)`` up to the next level, so a count of one is level 1, and an
n-gram of level j is put into a Bloom filter with each of the numbers 1 to j. A count comes back by asking for level
1, 2 and so on until one is missing. It is never too low, and too high only by
false hits.

The filter holds the n-grams of the training documents alone and is cut into
segments by key, each with ``BITS_PER_ENTRY`` bits for an entry, so it answers alike at every
size of the corpus. Tasks add up the n-grams of several slices and send one block of keys and
counts to each segment, as many as Spark's own shuffle blocks. Segments are then broadcast in passes: a pass is a run of segments of at most
``pass_bytes``, measured before anything is gathered, and probes the keys of every slice that fall
into it. The keys of a slice are stored once, in a folder for each range of segments, so a pass reads no others; files
are as many as tasks times ranges, so a large cluster should take larger passes. The levels of all passes come
together again slice by slice. Scores do not hang on the number of passes.

The model: p_1(w) is the add-one unigram probability that also makes ``base_score``, and
p_k(w | h) = (count(h w) + MU * p_{k-1}) / (count(h) + MU) for the k - 1 tokens h before w, at most 1,
up to ``order`` (2; 3 and more are possible), with counts from the filter. A text starts behind an end token and
ends with one; further back nothing stands, so its first tokens use the shorter n-grams alone.

Word counts are exact: counted by slice first, then by bucket of the hash of the word; each slice gets the
counts of its own words back, so no vocabulary has to fit into one place.

Defined results: a null or empty text is one end token; documents without an id
are training documents; without training tokens every base probability is 1 and
scores are 0; repeated documents count as often as they stand; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from regua.llm.common import ship, store
from regua.llm.slices import open_slice, pack, pack_array, slices, split_words, unpack, unpack_array

BASE, MU, ORDER = 1.5, 1000.0, 2
BITS_PER_ENTRY, HASHES = 16, 8
#: No count that fits into 64 bits has a higher level.
TOP = 128
#: Bytes of the filter that are broadcast at once.
PASS_BYTES = 64 << 20
#: Most bytes that a segment is expected to have. Where segments begin hangs on the corpus alone, not on the passes.
SEGMENT_BYTES = 4 << 20
#: Slices whose n-grams are added up before they are shuffled; bounds a worker's memory.
MERGED = 3
KEY_BITS = 48
#: Bytes of text for each bucket of words.
WORD_BUCKET = 64 << 20
#: Stands for the end of a text; no word is empty.
END = ""

BLOCKS = "bucket long, slice long, block binary"


def held_out_id(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Tokens:
    """The tokens of a slice: a dictionary, and their numbers document by document."""

    def __init__(self, payload: bytes):
        self.doc_ids, texts = open_slice(payload)
        words, cuts = split_words(pc.ascii_lower(texts))
        coded = words.dictionary_encode()
        self.names = pa.concat_arrays([pa.array([END]), coded.dictionary])
        ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        # One end behind each document.
        sizes = np.diff(cuts) + 1
        self.cuts = np.concatenate(([0], np.cumsum(sizes)))
        self.ids = np.zeros(self.cuts[-1], np.int64)
        body = np.ones(len(self.ids), bool)
        body[self.cuts[1:] - 1] = False
        self.ids[body] = ids
        self.sizes = sizes
        self.held_out = np.array([held_out_id(i) for i in self.doc_ids], bool)
        self.codes = np.fromiter(
            (xxhash.xxh3_64_intdigest(n.as_buffer()) if n.as_buffer() else 0 for n in self.names), np.uint64, len(self.names)
        )

    def training(self) -> np.ndarray:
        """Which tokens are of training documents."""
        return np.repeat(~self.held_out, self.sizes)

    def ngrams(self, order: int) -> Iterator[np.ndarray]:
        """Keys of each token with those before it, for 2 to ``order`` tokens; a text starts behind an end."""
        codes = self.codes[self.ids]
        chain = codes
        for k in range(2, order + 1):
            before = np.empty_like(codes)
            before[1:] = chain[:-1]
            before[self.cuts[:-1]] = self.codes[0]
            chain = before * np.uint64(0x9E3779B97F4A7C15) + codes
            yield mixed(chain, k)

    def place(self) -> np.ndarray:
        """How many tokens of its document stand before each token."""
        return np.arange(len(self.ids)) - np.repeat(self.cuts[:-1], self.sizes)

    def unigrams(self) -> np.ndarray:
        """Key of each name of the dictionary."""
        return mixed(self.codes, 1)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Well-mixed keys of KEY_BITS bits."""
    x = x ^ np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - KEY_BITS)


def levels(counts: np.ndarray) -> np.ndarray:
    """Whole power of BASE in each count of at least 1; the filter holds it as the level above, since 0 is for no count."""
    return np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """What a level of the filter stands for: the middle of its counts, all whole numbers."""
    level = np.asarray(level, np.float64)
    return np.where(level > 0, (np.ceil(BASE ** (level - 1)) + np.ceil(BASE**level) - 1) / 2, 0.0)


# --- counting ---------------------------------------------------------------


def _each_slice(rows: DataFrame, work, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield work(number, payload.as_py())

    return rows.select("slice", "payload").mapInArrow(run, schema)


def _block_rows(buckets: list[int], number: int, blocks: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(buckets, pa.int64()),
            pa.array([number] * len(buckets), pa.int64()),
            pa.array(blocks, pa.binary()),
        ],
        names=["bucket", "slice", "block"],
    )


def word_buckets(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts names by bucket, and where each bucket begins."""
    bucket = (codes % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def word_counts(rows: DataFrame, n: int) -> DataFrame:
    """Stored blocks (bucket, slice, block, tokens, distinct): counts of the words a slice sent to a bucket, in its order."""

    def send(number: int, payload: bytes) -> pa.RecordBatch:
        own = Tokens(payload)
        counts = np.bincount(own.ids[own.training()], minlength=len(own.names))
        order, cuts = word_buckets(own.codes, n)
        buckets, blocks = [], []
        for bucket, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if b > a:
                at = order[a:b]
                block = pa.table({"name": own.names.take(pa.array(at)), "n": counts[at]})
                buckets.append(bucket)
                blocks.append(pack(block))
        return _block_rows(buckets, number, blocks)

    def total(group: pa.Table) -> pa.Table:
        blocks = [unpack(b) for b in group.column("block").to_pylist()]
        names = pa.chunked_array([c for t in blocks for c in t.column("name").chunks], pa.string())
        coded = names.combine_chunks().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        given = np.concatenate([t.column("n").to_numpy() for t in blocks])
        counts = np.bincount(at, given, len(coded.dictionary)).astype(np.int64)
        cuts = np.cumsum([0] + [t.num_rows for t in blocks]).tolist()
        answers = [pack_array(counts[at[a:b]]) for a, b in zip(cuts, cuts[1:])]
        # The sums of the bucket go with its first block.
        first = [1] + [0] * (len(blocks) - 1)
        return pa.table(
            {
                "bucket": group.column("bucket"),
                "slice": group.column("slice"),
                "block": pa.array(answers, pa.binary()),
                "tokens": pa.array([int(counts.sum()) * f for f in first], pa.int64()),
                "distinct": pa.array([int((counts > 0).sum()) * f for f in first], pa.int64()),
            }
        )

    blocks = _each_slice(rows, send, BLOCKS)
    return store(
        blocks.groupBy("bucket").applyInArrow(total, BLOCKS + ", tokens long, distinct long"), "word_counts"
    )


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segment of each key; keys in order have segments in order."""
    return ((keys >> np.uint64(16)) * np.uint64(segments) >> np.uint64(KEY_BITS - 16)).astype(np.int64)


class Grams:
    """The n-grams of a slice: their keys in order, training counts, and where those of names and tokens stand."""

    def __init__(self, own: Tokens, order: int = ORDER):
        training = own.training()
        keys, counts, places = [own.unigrams()], [np.bincount(own.ids[training], minlength=len(own.names))], [None]
        for of_tokens in own.ngrams(order):
            distinct, at = np.unique(of_tokens, return_inverse=True)
            keys.append(distinct)
            counts.append(np.bincount(at[training], minlength=len(distinct)))
            places.append(at)
        begin = np.cumsum([0] + [len(k) for k in keys])
        whole = np.concatenate(keys)
        order_of = np.argsort(whole, kind="stable")
        self.keys, self.counts = whole[order_of], np.concatenate(counts)[order_of].astype(np.int64)
        place = np.empty_like(order_of)
        place[order_of] = np.arange(len(order_of))
        self.names = place[: begin[1]]
        self.tokens = [place[b + at] for b, at in zip(begin[1:], places[1:])]


def gram_blocks(rows: DataFrame, order: int, segments: int, per_range: int) -> DataFrame:
    """Stored blocks (slice, keys, counts, range): the n-grams of a slice in each range of segments, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = Grams(Tokens(payload.as_py()), order)
                ranked = segment_of(own.keys, segments) // per_range
                begin = np.flatnonzero(np.diff(ranked, prepend=-1))
                cuts = [*begin.tolist(), len(ranked)]
                parts = list(zip(cuts, cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(parts), pa.int64()),
                        pa.array([pack_array(np.diff(own.keys[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()),
                        pa.array([pack_array(own.counts[a:b]) for a, b in parts], pa.binary()),
                        pa.array(ranked[begin], pa.int64()),
                    ],
                    names=["slice", "keys", "counts", "range"],
                )

    sent = rows.select("slice", "payload").mapInArrow(run, "slice long, keys binary, counts binary, range long")
    return store(sent, "grams", "range")


def _keys(block: bytes) -> np.ndarray:
    return np.cumsum(unpack_array(block, "u8"), dtype=np.uint64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]))
    return ranked[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def filter_segments(blocks: DataFrame, segments: int) -> DataFrame:
    """Stored rows (segment, size, bits): the filter of the training counts, cut by key."""

    def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        key, n = summed(np.concatenate(keys), np.concatenate(counts))
        place = segment_of(key, segments)
        begin = np.flatnonzero(np.diff(place, prepend=-1))
        cuts = [*begin.tolist(), len(key)]
        parts = list(zip(cuts, cuts[1:]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(place[begin], pa.int64()),
                pa.array([pack_array(np.diff(key[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()),
                pa.array([pack_array(n[a:b]) for a, b in parts], pa.binary()),
            ],
            names=["segment", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            for key, n in zip(batch.column(0), batch.column(1)):
                key, n = _keys(key.as_py()), unpack_array(n.as_py(), "i8")
                keys.append(key[n > 0])
                counts.append(n[n > 0])
                if len(keys) == MERGED:
                    yield merged(keys, counts)
                    keys, counts = [], []
        if keys:
            yield merged(keys, counts)

    def build(group: pa.Table) -> pa.Table:
        keys = np.concatenate([_keys(k) for k in group.column("keys").to_pylist()])
        key, n = summed(keys, np.concatenate([unpack_array(c, "i8") for c in group.column("counts").to_pylist()]))
        bits = segment(key, 1 + levels(n), BITS_PER_ENTRY)
        return pa.table({"segment": group.column("segment")[:1], "size": [len(bits)], "bits": pa.array([bits], pa.binary())})

    sent = blocks.select("keys", "counts").mapInArrow(run, "segment long, keys binary, counts binary")
    return store(sent.groupBy("segment").applyInArrow(build, "segment long, size long, bits binary"), "filter")


def passes(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Runs of segments of one range, each of at most ``limit`` bytes (or of one segment)."""
    out, begin, held = [], 0, 0
    for at, size in enumerate(sizes):
        if at > begin and held + size > limit:
            out.append((begin, at))
            begin, held = at, 0
        held += size
    return [*out, (begin, len(sizes))]


def gram_levels(blocks: DataFrame, held: DataFrame, segments: int, per_range: int, pass_bytes: int) -> list[DataFrame]:
    """Stored blocks (slice, a, b, block) of each pass: levels of the n-grams of a slice in segments a to b."""
    spark = blocks.sparkSession
    out = []
    for at in range(-(-segments // per_range)):
        base, size = at * per_range, min(per_range, segments - at * per_range)
        # A range has ``per_range`` rows at most.
        own = held.where(F.col("segment").between(base, base + size - 1))
        known = {r.segment - base: r["size"] for r in own.select("segment", "size").collect()}
        for a, b in passes([known.get(k, 0) for k in range(size)], pass_bytes):
            sent = spark.sparkContext.broadcast(_gathered(own, segments, base + a, base + b))
            part = blocks.where(F.col("range") == at).select("slice", "keys")
            out.append(store(part.mapInArrow(_prober(sent, base + a, base + b, segments), "slice long, a long, b long, block binary"), "levels"))
            # The answers are stored, so nothing can ask for this pass again; the driver lets go of it too.
            sent.destroy(blocking=True)
    return out


def _gathered(held: DataFrame, segments: int, a: int, b: int) -> Filter:
    """Segments ``a`` to ``b`` as they are broadcast; no other copy outlives the call."""
    chosen = held.where(F.col("segment").between(a, b - 1)).select("segment", "bits").collect()
    return Filter({r.segment: r.bits for r in chosen}, segments, a, b)


def _prober(sent, a: int, b: int, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block in batch.column(1):
                keys = _keys(block.as_py())
                begin, end = np.searchsorted(segment_of(keys, segments), [a, b])
                found.append(pack_array(sent.value.level(keys[begin:end]).astype(np.uint8)))
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a] * size, pa.int64()), pa.array([b] * size, pa.int64()), pa.array(found, pa.binary())],
                names=["slice", "a", "b", "block"],
            )

    return run


# --- the filter -------------------------------------------------------------


class Filter:
    """Segments ``a`` to ``b`` of ``n``, in one array of bits."""

    def __init__(self, segments: dict[int, bytes], n: int, a: int = 0, b: int | None = None):
        self.n, self.a = n, a
        held = [segments.get(k, b"") for k in range(a, n if b is None else b)]
        sizes = np.array([len(s) for s in held], np.int64) * 8
        self.begin, self.size = np.cumsum(sizes) - sizes, sizes
        self.bits = np.frombuffer(b"".join(held) or b"\0", np.uint8)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key, by asking for one level after another."""
        found = np.zeros(len(keys), np.int64)
        bucket = segment_of(keys, self.n) - self.a
        at = np.flatnonzero(self.size[bucket] > 0)
        level = 0
        while len(at) and level < TOP:
            level += 1
            own, where = keys[at], bucket[at]
            size, begin = self.size[where].astype(np.uint64), self.begin[where]
            held = np.arange(len(at))
            for k in range(HASHES):
                place = begin[held] + _place(own[held], level, k, size[held])
                held = held[(self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0]
                if not len(held):
                    break
            at = at[held]
            found[at] = level
        return found


def _place(keys: np.ndarray, level: int, k: int, size: np.ndarray) -> np.ndarray:
    x = (keys + np.uint64((level * 16 + k) * 0xA0761D6478BD642F % (1 << 64))) * np.uint64(0xE7037ED1A0B428DB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x8EBC6AF09C88C6E3)
    return ((x ^ (x >> np.uint64(32))) % size).astype(np.int64)


def segment(keys: np.ndarray, level: np.ndarray, bits_per_entry: float) -> bytes:
    """The bits of one bucket."""
    size = 64 * max(1, int(np.ceil(level.sum() * bits_per_entry / 64)))
    bits = np.zeros(size, np.uint8)
    for own in range(1, int(level.max(initial=0)) + 1):
        put = keys[level >= own]
        for k in range(HASHES):
            bits[_place(put, own, k, np.uint64(size))] = 1
    return np.packbits(bits, bitorder="little").tobytes()


# --- scoring ----------------------------------------------------------------


def score_slice(
    own: Tokens, counts: np.ndarray, n: int, v: int, names: np.ndarray, tokens: list[np.ndarray]
) -> dict[str, np.ndarray]:
    """Base and model score of each document of a slice, from the levels of its names and of the n-grams at its tokens."""
    starts = own.cuts[:-1]
    prior = (counts + 1) / (n + v + 1)
    before = np.zeros_like(own.ids)
    before[1:] = own.ids[:-1]
    before[starts] = 0
    p, history = prior[own.ids], count_of(names)[before]
    place = own.place()
    for k, level in enumerate(tokens, 2):
        grams = count_of(level)
        longer = (grams + MU * p) / (np.maximum(history, grams) + MU)
        # Behind the start of a text there are no longer n-grams.
        p = np.where(place >= k - 2, longer, p)
        history = np.concatenate(([0.0], grams[:-1]))[: len(grams)]
    total = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
    return {
        "n_tokens": own.sizes.astype(np.int64),
        "n_known": total((counts[own.ids] > 0).astype(np.int64)).astype(np.int64),
        "base_score": total(np.log10(prior)[own.ids]).astype(np.float64),
        "score": total(np.log10(p)).astype(np.float64),
    }


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def lm_scores(
    docs: DataFrame, order: int = ORDER, pass_bytes: int = PASS_BYTES, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship(docs.sparkSession)
    rows = slices(docs)
    size = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_words = size // WORD_BUCKET + 1
    counted = word_counts(rows, n_words)
    sums = counted.agg(F.sum("tokens"), F.sum("distinct")).first()
    n, v = sums[0] or 0, sums[1] or 0
    # An n-gram has no more entries than it has occurrences, so this bounds the whole filter.
    segments = n * order * BITS_PER_ENTRY // 8 // segment_bytes + 1
    per_range = max(1, pass_bytes // segment_bytes)
    blocks = gram_blocks(rows, order, segments, per_range)
    found = gram_levels(blocks, filter_segments(blocks, segments), segments, per_range, pass_bytes)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        word = pc.is_null(right.column("b"))
        of_words, of_grams = right.filter(word), right.filter(pc.invert(word))
        for payload in left.column("payload").to_pylist():
            own = Tokens(payload)
            counts = np.zeros(len(own.names), np.int64)
            order_of, cuts = word_buckets(own.codes, n_words)
            for bucket, block in zip(of_words.column("a").to_pylist(), of_words.column("block").to_pylist()):
                counts[order_of[cuts[bucket] : cuts[bucket + 1]]] = unpack_array(block, "i8")
            grams = Grams(own, order)
            place = segment_of(grams.keys, segments)
            level = np.zeros(len(grams.keys), np.uint8)
            for a, b, block in zip(*(of_grams.column(c).to_pylist() for c in ("a", "b", "block"))):
                begin, end = np.searchsorted(place, [a, b])
                level[begin:end] = unpack_array(block, "u1")
            scored = score_slice(own, counts, n, v, level[grams.names], [level[t] for t in grams.tokens])
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(own.doc_ids, pa.int64()),
                        "held_out": own.held_out,
                        "n_tokens": scored["n_tokens"],
                        "n_known": scored["n_known"],
                        "train_tokens": np.full(len(own.doc_ids), n, np.int64),
                        "base_score": scored["base_score"],
                        "score": scored["score"],
                    }
                )
            )
        return pa.concat_tables(out)

    answers = counted.select("slice", F.col("bucket").alias("a"), F.lit(None).cast("long").alias("b"), "block")
    for part in found:
        answers = answers.unionAll(part)
    return (
        rows.select("slice", "payload")
        .groupBy("slice")
        .cogroup(answers.groupBy("slice"))
        .applyInArrow(work, SCORED)
    )
