"""Which windows of documents occur elsewhere, by minimiser partitioning.

A window is a fixed number of consecutive units (bytes or words) of one document.
Its minimiser is the smallest hash among its short grams; equal windows have
equal minimisers, so only windows of one minimiser need comparing. Consecutive
windows with the same minimiser travel as one packed run.

1. Every slice counts its minimisers; the counts of all slices are dealt out by
   minimiser and summed, and each slice is told which of its minimisers occur more
   than once. All other windows are unique.
2. Runs of repeated minimisers are cut out, equal ones of a slice collapsed, and
   sent to the bucket of the minimiser, where windows are compared exactly.
3. A minimiser whose runs are too many for one bucket (a passage that very many
   documents share, each with other text around it) is split by window instead: each
   window is sent as a 128-bit digest to a bucket of its own, equal ones of a slice
   once. No group is ever gathered, and none is cut short.
4. Answers go back to the slices, which know where each run stands.

Everything that moves is a plain row: for each minimiser or run of a slice, for the digests
of a slice that one bucket gets (a single one, when buckets are many), and as many answers.
So their number follows the text, and not slices times buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from regua.llm.common import ship, store
from regua.llm.slices import pack, unpack

#: Low bits of a minimiser code that hold its position; a stretch of units worked on at once.
PLACE_BITS = 24
STRETCH = 1 << 20
#: Windows in one run at most, bytes of runs in one bucket, bytes of distinct runs of one minimiser before it is split.
LONGEST_RUN, BUCKET_BYTES, SPLIT_BYTES = 1024, 2 << 20, 1 << 20
#: As many times those bytes, equal runs of several slices counted each, are gathered before a minimiser is split all the same.
COPIES = 8
#: Prints of a minimiser that a slice tells apart; with more, all its runs count as one that no other slice has.
PRINTS = 8
#: Bytes of text for each bucket of minimisers, bytes of runs for each bucket of digests.
CODE_BUCKET, DIGEST_BUCKET = 64 << 20, 1 << 19
#: Stands for a document without an id, behind all others.
NO_ID = (1 << 63) - 1
#: Low bits of a key that hold the print of a run, which tells equal runs when bytes are counted; above them stands the code.
PRINT_BITS = 24

KEYS = "slice long, key long, often int, size long"
VERDICTS = "slice long, code long, verdict int, size long"
SENT = "bucket long, slice long, piece int, code long, body binary, windows int, often int, low long, note binary"
ANSWERS = "slice long, piece int, again binary, low binary"
#: Low bit of a bucket; the bucket of a slice's own note.
RUNS, DIGESTS, OWN = 0, 1, -1

DIGEST = np.dtype([("a", "<u8"), ("b", "<u8")])
#: With how often it stands in the slice (2: more than once) and its smallest document there.
TOLD = np.dtype([("a", "<u8"), ("b", "<u8"), ("low", "<i8"), ("often", "u1")])


class Units:
    """Units of a slice: a byte buffer, where each unit begins and ends, and where documents do.

    Subclasses set ``doc_ids``, ``buffer`` (bytes), ``begin`` and ``end`` (offsets of units in
    it, or None when units are bytes) and ``cuts`` (units before each document, with all at last).
    """

    window: int
    gram: int
    begin: np.ndarray | None = None
    end: np.ndarray | None = None

    def hashes(self, start: int, stop: int) -> np.ndarray:
        """A hash of the gram at each unit of a stretch, whatever the value where a gram would not fit."""
        raise NotImplementedError

    def body(self, first: int, windows: int) -> bytes:
        """The bytes from the first of ``windows`` windows to the end of the last."""
        last = first + windows + self.window - 2
        if self.begin is None:
            return self.buffer[first : last + 1]
        return self.buffer[self.begin[first] : self.end[last]]

    def places(self, body: bytes, windows: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window of a run's body begins and ends."""
        raise NotImplementedError

    def ids(self) -> np.ndarray:
        return np.array([NO_ID if i is None else i for i in self.doc_ids], np.int64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by running minima of blocks from either side."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Runs:
    """Runs of windows with one minimiser: first window, number of windows, code, whether the gram stands twice, document, print."""

    def __init__(self, units: Units):
        width = units.window - units.gram + 1
        total = int(units.cuts[-1])
        low = np.uint64((1 << PLACE_BITS) - 1)
        parts = []
        doc_of = np.repeat(np.arange(len(units.cuts) - 1, dtype=np.int32), np.diff(units.cuts))
        for start in range(0, total, STRETCH):
            stop = min(total, start + STRETCH + units.window)
            hashes = units.hashes(start, stop)
            own = (hashes & ~low) | np.arange(stop - start, dtype=np.uint64)
            least = sliding_min(own, width)[:STRETCH]
            # Windows that fit into their document.
            docs = doc_of[start : start + len(least)]
            at = np.flatnonzero(
                units.cuts[1:][docs] - np.arange(start, start + len(least)) >= units.window
            )
            if not len(at):
                continue
            code = least[at] >> np.uint64(PLACE_BITS)
            fresh = np.ones(len(at), bool)
            fresh[1:] = (code[1:] != code[:-1]) | (np.diff(at) > 1)
            # A new document is a new run even where windows follow on each other.
            doc = docs[at]
            fresh[1:] |= doc[1:] != doc[:-1]
            head = np.flatnonzero(fresh)
            size = np.diff(head, append=len(at))
            for k in np.flatnonzero(size > LONGEST_RUN).tolist():
                fresh[head[k] : head[k] + size[k] : LONGEST_RUN] = True
            head = np.flatnonzero(fresh)
            tail = np.concatenate((head[1:], [len(at)])) - 1
            # Runs of the same bytes have the same sum of hashes.
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes)))
            print_ = mix(sums[at[tail] + width] - sums[at[head]]) >> np.uint64(64 - PRINT_BITS)
            parts.append(
                (
                    at[head] + start,
                    tail - head + 1,
                    code[head],
                    (least[at[head]] & low) != (least[at[tail]] & low),
                    doc[head],
                    print_,
                )
            )
        columns = list(zip(*parts)) or [
            [np.zeros(0, t)] for t in (np.int64, np.int64, np.uint64, bool, np.int64, np.uint64)
        ]
        self.first, self.windows, self.code, self.twice, self.doc, self.print = map(np.concatenate, columns)
        # Bytes of the run, from the first unit to the last.
        last = self.first + self.windows + units.window - 2
        self.size = last + 1 - self.first if units.begin is None else units.end[last] - units.begin[self.first]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


# --- counts ------------------------------------------------------------------


def minimisers(units: Units, runs: Runs, number: int, across: bool) -> pa.RecordBatch:
    """A row for each minimiser and print of a slice: how often (2: more than once), bytes of distinct runs, documents from and to."""
    keys, one, inverse = np.unique(
        runs.code << np.uint64(PRINT_BITS) | runs.print, return_index=True, return_inverse=True
    )
    size, code = runs.size[one], keys >> np.uint64(PRINT_BITS)
    head = np.ones(len(keys), bool)
    head[1:] = code[1:] != code[:-1]
    group = np.cumsum(head) - 1
    many = (np.bincount(group) > PRINTS)[group]
    keys[many] = code[many] << np.uint64(PRINT_BITS) | mix(code[many] ^ mix(np.uint64([number + 1]))) >> np.uint64(64 - PRINT_BITS)
    kept = head | ~many
    place = np.cumsum(kept) - 1
    inverse, n = place[inverse], int(kept.sum())
    columns = {
        "slice": np.full(n, number),
        "key": keys[kept].view(np.int64),
        "often": np.minimum(np.bincount(inverse, 1 + runs.twice, n), 2).astype(np.int32),
        "size": np.bincount(place, size, n).astype(np.int64),
    }
    if across:
        ids = units.ids()[runs.doc]
        columns |= {"low": np.full(n, NO_ID), "high": np.full(n, -NO_ID)}
        np.minimum.at(columns["low"], inverse, ids)
        np.maximum.at(columns["high"], inverse, ids)
    return pa.RecordBatch.from_pydict(columns)


def _repeated(rows: pa.Table, across: bool, split_bytes: int) -> pa.RecordBatch:
    """The repeated minimisers of each slice, from all rows of these minimisers: 1 repeated, 2 repeated and to be split."""
    key = rows.column("key").to_numpy().view(np.uint64)
    codes, inverse = np.unique(key >> np.uint64(PRINT_BITS), return_inverse=True)
    n, size = len(codes), rows.column("size").to_numpy()
    if across:
        low, high = np.full(n, NO_ID), np.full(n, -NO_ID)
        np.minimum.at(low, inverse, rows.column("low").to_numpy())
        np.maximum.at(high, inverse, rows.column("high").to_numpy())
        again = low < high
    else:
        again = np.bincount(inverse, rows.column("often").to_numpy(), n) > 1
    verdict = again.astype(np.int32)
    sent = np.bincount(inverse, size, n)
    large = again & (sent > split_bytes)
    at = np.flatnonzero(large[inverse])
    if len(at):
        # Equal runs collapse where they meet, so only distinct ones make a bucket hard.
        one = at[np.unique(key[at], return_index=True)[1]]
        distinct = np.bincount(inverse[one], size[one], n)
        verdict[large & ((distinct > split_bytes) | (sent > COPIES * split_bytes))] = 2
    number = rows.column("slice").to_numpy()
    at = np.flatnonzero(again[inverse])
    at = at[np.argsort(number[at], kind="stable")]
    return pa.RecordBatch.from_pydict(
        {
            "slice": number[at],
            "code": codes[inverse[at]].astype(np.int64),
            "verdict": verdict[inverse[at]],
            "size": size[at],
        }
    )


# --- comparing runs ----------------------------------------------------------


def _strings(data: bytes, ends: np.ndarray) -> pa.Array:
    """Consecutive strings of ``data`` that end at ``ends``."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _answers(group: pa.Table, of: np.ndarray, windows: np.ndarray, again: np.ndarray, low: np.ndarray, lowest: bool) -> pa.Table:
    """Answers for the rows of a bucket: bits of the windows, and smallest documents (one, if it is that of all).

    ``of``: which distinct run each row holds; ``windows``: of each distinct run; ``again`` and ``low``: of each window.
    """
    held = -(-windows // 8)
    step = np.arange(len(again)) - np.repeat(np.cumsum(windows) - windows, windows)
    bits = np.zeros(8 * int(held.sum()), bool)
    bits[np.repeat(8 * (np.cumsum(held) - held), windows) + step] = again
    flags = _strings(np.packbits(bits, bitorder="little").tobytes(), np.cumsum(held))
    if lowest:
        begin = np.cumsum(windows) - windows
        same = np.minimum.reduceat(low, begin) == np.maximum.reduceat(low, begin)
        kept = low[(step == 0) | ~np.repeat(same, windows)]
        documents = _strings(kept.tobytes(), 8 * np.cumsum(np.where(same, 1, windows))).take(pa.array(of))
    else:
        documents = pa.nulls(len(of), pa.binary())
    return pa.table(
        {
            "slice": group.column("slice"),
            "piece": group.column("piece"),
            "again": flags.take(pa.array(of)),
            "low": documents,
        }
    )


def _distinct(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct digests, and which of them each one is."""
    order = np.lexsort((digests["b"], digests["a"]))
    ordered = digests[order]
    fresh = np.ones(len(digests), bool)
    fresh[1:] = (ordered["a"][1:] != ordered["a"][:-1]) | (ordered["b"][1:] != ordered["b"][:-1])
    inverse = np.empty(len(digests), np.int64)
    inverse[order] = np.cumsum(fresh) - 1
    return ordered[fresh], inverse


def _digest_answers(group: pa.Table, lowest: bool) -> pa.Table:
    """For each digest of a bucket: whether it stands elsewhere too, and its smallest document."""
    told = np.frombuffer(b"".join(group.column("body").to_pylist()), TOLD)
    keys, of = _distinct(told)
    again = np.bincount(of, told["often"], len(keys)) > 1
    low = np.full(len(keys), NO_ID)
    np.minimum.at(low, of, told["low"])
    windows = group.column("windows").to_numpy().astype(np.int64)
    return _answers(group, np.arange(len(windows)), windows, again[of], low[of], lowest)


def _compare(group: pa.Table, compare: Callable, across: bool, lowest: bool) -> pa.Table:
    """Answers of a bucket of runs: for each window of each run sent, whether it stands elsewhere, and its smallest document.

    ``compare`` gets the distinct bodies of minimisers that have several, with their
    windows, weights and smallest documents, and answers for the windows of each.
    """
    coded = group.column("body").combine_chunks().dictionary_encode()
    bodies, of = coded.dictionary, coded.indices.to_numpy()
    n = len(bodies)
    one = np.unique(of, return_index=True)[1]
    windows = group.column("windows").to_numpy()[one].astype(np.int64)
    often = np.bincount(of, group.column("often").to_numpy(), n).astype(np.int64)
    low = np.full(n, NO_ID)
    np.minimum.at(low, of, group.column("low").to_numpy())
    # Equal bodies have equal minimisers.
    _, inverse, count = np.unique(group.column("code").to_numpy()[one], return_inverse=True, return_counts=True)
    chosen = count[inverse] > 1
    if not across:
        # A run that stands once may still repeat within itself.
        chosen |= (windows > 1) & (often == 1)
    again, least = np.repeat(often > 1, windows), np.repeat(low, windows)
    at = np.flatnonzero(chosen)
    if len(at):
        found = compare(bodies.take(pa.array(at)).to_pylist(), windows[at].tolist(), often[at].tolist(), low[at].tolist())
        begin = np.cumsum(windows) - windows
        for a, size, (own_again, own_low) in zip(begin[at].tolist(), windows[at].tolist(), found):
            again[a : a + size] |= own_again
            least[a : a + size] = own_low
    return _answers(group, of, windows, again, least, lowest)


# --- the slices' side --------------------------------------------------------


def _send(units: Units, number: int, known: pa.Table, n_runs: int, n_digests: int) -> pa.RecordBatch:
    """The runs and digests of a slice, each with its bucket, and the slice's own note of where they stand."""
    runs = Runs(units)
    kind = np.zeros(len(runs.code), np.int64)
    codes, one = np.unique(known.column("code").to_numpy().astype(np.uint64), return_index=True)
    if len(codes):
        spot = np.minimum(np.searchsorted(codes, runs.code), len(codes) - 1)
        kind = np.where(codes[spot] == runs.code, known.column("verdict").to_numpy()[one][spot], 0)
    ids = units.ids()[runs.doc]

    # Whole runs, equal ones once.
    chosen = np.flatnonzero(kind == 1)
    number_of: dict[bytes, int] = {}
    of, often, low, sizes, code = [], [], [], [], []
    for own, first, windows, doc in zip(*(x[chosen].tolist() for x in (runs.code, runs.first, runs.windows, ids))):
        i = number_of.setdefault(units.body(first, windows), len(often))
        if i == len(often):
            often.append(1)
            low.append(doc)
            sizes.append(windows)
            code.append(own)
        else:
            often[i] = 2
            low[i] = min(low[i], doc)
        of.append(i)
    code = np.array(code, np.uint64)

    # Windows of minimisers that are split, as digests, equal ones once.
    split = np.flatnonzero(kind == 2)
    places, digests, docs = [], [], []
    for first, windows, doc in zip(*(x[split].tolist() for x in (runs.first, runs.windows, ids))):
        body = units.body(first, windows)
        froms, tos = units.places(body, windows)
        digests += [xxhash.xxh3_128_digest(body[a:b]) for a, b in zip(froms.tolist(), tos.tolist())]
        places.append(np.arange(first, first + windows))
        docs.append(np.full(windows, doc))
    distinct, inverse = _distinct(np.frombuffer(b"".join(digests), DIGEST))
    told = np.zeros(len(distinct), TOLD)
    told["a"], told["b"], told["low"] = distinct["a"], distinct["b"], NO_ID
    told["often"] = np.minimum(np.bincount(inverse, minlength=len(distinct)), 2)
    if digests:
        least = np.full(len(distinct), NO_ID)
        np.minimum.at(least, inverse, np.concatenate(docs))
        told["low"] = least
    # Those of a bucket are one piece.
    target = (distinct["a"] % np.uint64(n_digests)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    buckets, held = np.unique(target, return_counts=True)
    ends = np.cumsum(held)
    piece, skip = np.zeros((2, len(distinct)), np.int64)
    piece[order] = np.repeat(np.arange(len(buckets)), held)
    skip[order] = np.arange(len(distinct)) - np.repeat(ends - held, held)

    # Pieces are numbered: distinct runs, then the digests for each bucket.
    whole, n = len(sizes), len(sizes) + len(buckets)
    note = pa.table(
        {
            "first": np.concatenate([runs.first[chosen], *places]),
            "windows": np.concatenate([runs.windows[chosen], np.ones(len(inverse), np.int64)]),
            "piece": np.concatenate([np.array(of, np.int64), whole + piece[inverse]]),
            "skip": np.concatenate([np.zeros(len(of), np.int64), skip[inverse]]),
        }
    )
    bucket = np.concatenate(
        [2 * (mix(code) % np.uint64(n_runs)).astype(np.int64) + RUNS, 2 * buckets + DIGESTS, [OWN]]
    )
    body = pa.concat_arrays(
        [pa.array(list(number_of), pa.binary()), _strings(told[order].tobytes(), TOLD.itemsize * ends), pa.nulls(1, pa.binary())]
    )
    rest = np.zeros(n + 1 - whole, np.int64)
    return pa.RecordBatch.from_pydict(
        {
            "bucket": bucket,
            "slice": np.full(n + 1, number),
            "piece": np.arange(n + 1, dtype=np.int32),
            "code": np.concatenate([code.astype(np.int64), rest]),
            "body": body,
            "windows": np.concatenate([np.array(sizes, np.int32), held.astype(np.int32), np.zeros(1, np.int32)]),
            "often": np.concatenate([np.array(often, np.int32), rest.astype(np.int32)]),
            "low": np.concatenate([np.array(low, np.int64), rest + NO_ID]),
            "note": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([pack(note)], pa.binary())]),
        }
    )


def marked(total: int, answers: pa.Table, lowest: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each unit: whether the window that begins there stands elsewhere too, and its smallest document."""
    again, low = np.zeros(total, bool), np.full(total, NO_ID)
    piece = answers.column("piece").to_numpy()
    order = np.argsort(piece)
    # The slice's own note has the last number.
    note = unpack(answers.column("note")[int(order[-1])].as_py())
    sizes, own = note.column("windows").to_numpy(), note.column("piece").to_numpy()
    if not len(sizes):
        return again, low
    step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(note.column("first").to_numpy(), sizes) + step
    step += np.repeat(note.column("skip").to_numpy(), sizes)
    data, begin = _joined(answers.column("again"), order[:-1])
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little").astype(bool)
    again[at] = bits[np.repeat(8 * begin[own], sizes) + step]
    if lowest:
        data, begin = _joined(answers.column("low"), order[:-1])
        same = np.diff(begin)[own] == 8
        low[at] = np.frombuffer(data, np.int64)[np.repeat(begin[own] // 8, sizes) + np.where(np.repeat(same, sizes), 0, step)]
    return again, low


def _joined(column: pa.ChunkedArray, order: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The strings of a column in the given order as one, and where each begins, with the end at last."""
    strings = column.take(pa.array(order)).to_pylist()
    return b"".join(strings), np.cumsum([0, *map(len, strings)])


def repeated_windows(
    rows: DataFrame,
    units: Callable[[bytes], Units],
    compare: Callable,
    across: bool,
    finish: Callable[[Units, np.ndarray, np.ndarray], pa.Table],
    schema: str,
    split_bytes: int = SPLIT_BYTES,
    lowest: bool = True,
) -> DataFrame:
    """Find windows of stored slices that stand elsewhere too, and let ``finish`` make rows of each slice from them.

    ``across``: only windows that stand in another document are of interest.
    ``finish`` gets the units of a slice, a flag for each unit whose window stands
    elsewhere, and the smallest document that the window begins in (``NO_ID`` without ``lowest``).
    """
    ship(rows.sparkSession)
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    n_codes = total // CODE_BUCKET + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = units(payload.as_py())
                yield minimisers(own, Runs(own), number, across)

    def total_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield _repeated(pa.Table.from_batches(held), across, split_bytes)

    narrow = rows.select("slice", "payload")
    verdicts = store(
        narrow.mapInArrow(count, KEYS + ", low long, high long" * across)
        .repartition(n_codes, F.shiftrightunsigned("key", PRINT_BITS))
        .mapInArrow(total_up, VERDICTS),
        "minimisers",
    )
    size = lambda kind: F.coalesce(F.sum(F.when(F.col("verdict") == kind, F.col("size"))), F.lit(0))
    plain, split = verdicts.agg(size(1), size(2)).first()
    n_runs, n_digests = plain // BUCKET_BYTES + 1, 16 * split // DIGEST_BUCKET + 1

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = [
            _send(units(payload), number, right, n_runs, n_digests)
            for number, payload in zip(left.column("slice").to_pylist(), left.column("payload").to_pylist())
        ]
        return pa.Table.from_batches(batches)

    sent = store(
        narrow.groupBy("slice")
        .cogroup(verdicts.select("slice", "code", "verdict").groupBy("slice"))
        .applyInArrow(send, SENT),
        "runs",
    )

    def answer(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() % 2 == RUNS:
            return _compare(group, compare, across, lowest)
        return _digest_answers(group, lowest)

    own = F.col("bucket") == OWN
    replies = store(sent.where(~own).drop("note").groupBy("bucket").applyInArrow(answer, ANSWERS), "replies")
    none = F.lit(None).cast("binary")
    notes = sent.where(own).select("slice", "piece", none.alias("again"), none.alias("low"), "note")

    def end(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for payload in left.column("payload").to_pylist():
            own = units(payload)
            again, low = marked(int(own.cuts[-1]), right, lowest)
            tables.append(finish(own, again, low))
        return pa.concat_tables(tables)

    right = replies.withColumn("note", none).unionAll(notes)
    return narrow.groupBy("slice").cogroup(right.groupBy("slice")).applyInArrow(end, schema)


def covered(starts: np.ndarray, width: int) -> np.ndarray:
    """Units that some marked window of ``width`` units covers; marked windows fit into their document."""
    change = np.zeros(len(starts) + 1, np.int32)
    at = np.flatnonzero(starts)
    change[at] += 1
    change[at + width] -= 1
    return np.cumsum(change[:-1], dtype=np.int32) > 0
