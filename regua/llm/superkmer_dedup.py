"""Passages that stand in an earlier document removed, by super-k-mer partitioning.

Windows of ``WORDS`` words are compared. Consecutive windows that share a
minimiser (the smallest hash of their ``GRAM``-word grams) travel as one packed
string to the bucket of the minimiser, where the windows of all strings are
sorted and equal ones met exactly (:mod:`regua.llm.repeats`). Not so for a minimiser
with more than ``SPLIT_BYTES`` of distinct runs (or ``COPIES`` times that, with equal
ones of several slices): each of its windows travels as a 128-bit digest, and windows are equal when their digests are, so two different ones would be
taken as equal if xxh3 gave both the same digest. A word goes if a window that covers
it also begins in a document with a smaller id.

Defined results: a null text has no words; a text of fewer words than a window
is left alone; documents without an id come last and are not before each other;
rows of the same id are not before each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from regua.llm.repeats import SPLIT_BYTES, Units, covered, repeated_windows
from regua.llm.slices import open_slice, slices, split_words

WORDS = 50
GRAM = 8


class WordUnits(Units):
    window, gram = WORDS, GRAM

    def __init__(self, payload: bytes):
        self.doc_ids, texts = open_slice(payload)
        words, self.cuts = split_words(texts)
        self.coded = words.dictionary_encode()
        self.codes: np.ndarray | None = None
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        # The words of the slice with one space behind each.
        self.end = np.cumsum(sizes + 1) - 1
        self.begin = self.end - sizes
        whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        self.buffer = pc.binary_join(whole, " ")[0].as_buffer().to_pybytes() if len(words) else b""

    def hashes(self, start: int, stop: int) -> np.ndarray:
        if self.codes is None:
            names = self.coded.dictionary
            codes = (xxhash.xxh3_64_intdigest(n.as_buffer()) for n in names)
            own = np.fromiter(codes, np.uint64, len(names))[self.coded.indices.to_numpy(zero_copy_only=False)]
            self.codes = np.concatenate((own, np.zeros(GRAM, np.uint64)))
        n = stop - start
        mixed = np.zeros(n, np.uint64)
        for k in range(start, start + GRAM):
            mixed = (mixed ^ self.codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return mixed * np.uint64(0xD6E8FEB86659FD93)

    def places(self, body: bytes, windows: int) -> tuple[np.ndarray, np.ndarray]:
        return word_windows(body, windows)


def word_windows(body: bytes, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each window of a string of words begins and ends."""
    spaces = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)
    begin = np.concatenate(([0], spaces + 1))
    end = np.concatenate((spaces, [len(body)]))
    return begin[:windows], end[WORDS - 1 :]


def compare_words(bodies: list[bytes], windows: list[int], often: list[int], low: list[int]):
    """The smallest document of each window, by sorting the windows of all strings."""
    entries = []
    for i, (body, n) in enumerate(zip(bodies, windows)):
        begin, end = word_windows(body, n)
        entries += [(body[a:b], i, k) for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist()))]
    entries.sort()
    found = [(np.zeros(n, bool), np.full(n, d)) for n, d in zip(windows, low)]
    start = 0
    for stop in range(1, len(entries) + 1):
        if stop == len(entries) or entries[stop][0] != entries[start][0]:
            if stop - start > 1:
                least = min(low[i] for _, i, _ in entries[start:stop])
                for _, i, k in entries[start:stop]:
                    found[i][0][k], found[i][1][k] = True, least
            start = stop
    return found


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_passages(docs: DataFrame, with_text: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row for each document: its words, those removed, the digest of the rest (and the rest itself)."""

    def finish(units: WordUnits, again: np.ndarray, low: np.ndarray) -> pa.Table:
        own = np.repeat(units.ids(), np.diff(units.cuts))
        gone = covered(low < own, WORDS)
        words = units.buffer.split(b" ") if units.buffer else []
        rows = []
        for doc_id, a, b in zip(units.doc_ids, units.cuts.tolist(), units.cuts[1:].tolist()):
            part = gone[a:b]
            if part.any():
                kept = b" ".join([words[k] for k in (np.flatnonzero(~part) + a).tolist()])
            else:
                kept = units.buffer[units.begin[a] : units.end[b - 1]] if b > a else b""
            row = (doc_id, b - a, int(part.sum()), hashlib.sha256(kept).hexdigest())
            rows.append(row + (kept.decode(),) * with_text)
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        columns = list(zip(*rows)) or [()] * (4 + with_text)
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    schema = OUT + (", kept string" if with_text else "")
    return repeated_windows(slices(docs), WordUnits, compare_words, True, finish, schema, split_bytes)
