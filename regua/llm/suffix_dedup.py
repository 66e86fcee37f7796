"""Repeated byte strings removed by suffix order and longest previous factors.

The longest previous factor of a position is the longest string that starts there
and also somewhere before. In suffix order its earlier match is the nearest
entry with a smaller position on either side (previous and next smaller value);
the length shared with it is the smallest common prefix on the way. Keeping first
copies and removing later ones means removing what positions with a factor of
the wanted length or more cover. To remove all copies, positions with a later
match (the same, looked at from behind) are added.

At scale, :mod:`regua.llm.repeats` brings the strings that may be equal into
buckets of bounded size, and suffix order is made there. Equal whole runs are met
by their bytes, and windows of a minimiser with more than ``SPLIT_BYTES`` of distinct runs
(or ``COPIES`` times that, with equal ones of several slices) by 128-bit digests, without
suffix order. Longest previous factors serve ``keep_first`` only.

Defined results: a null or empty text has nothing to remove; a text shorter
than the string length is left alone; matches never cross documents; repeated
documents are copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regua.llm.repeats import NO_ID, SPLIT_BYTES, Units, covered, repeated_windows
from regua.llm.slices import open_slice, slices

LENGTH = 400
GRAM = 32


# --- suffix arrays ------------------------------------------------------------


def _ranks(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys of ``width`` bits, positions ascending where equal, and the rank of each (from 1)."""
    n = len(keys)
    bits = max(1, (n - 1).bit_length())
    if width + bits <= 64:
        # Key and position sort as one number, several times faster than by reference.
        whole = np.sort(keys << np.uint64(bits) | np.arange(n, dtype=np.uint64))
        order = (whole & np.uint64((1 << bits) - 1)).astype(np.int64)
        ordered = whole >> np.uint64(bits)
    else:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
    return order, rank


def suffix_order(data: bytes, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first ``depth`` bytes (all, if None), and a rank that is equal where these are.

    By prefix doubling; behind the end stands something smaller than any byte.
    """
    n = len(data)
    depth = n if depth is None else min(depth, n)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = min(4, depth)
    raw = np.zeros(n + held, np.uint64)
    raw[:n] = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    keys = np.zeros(n, np.uint64)
    for k in range(held):
        keys = keys << np.uint64(9) | raw[k : k + n]
    order, rank = _ranks(keys, 9 * held)
    width = n.bit_length()
    while held < depth and rank[order[-1]] < n:
        step = min(held, depth - held)
        behind = np.zeros(n, np.int64)
        behind[: n - step] = rank[step:]
        order, rank = _ranks(rank.astype(np.uint64) << np.uint64(width) | behind.astype(np.uint64), 2 * width)
        held += step
    return order, rank


def common_prefixes(data: bytes, order: np.ndarray) -> np.ndarray:
    """Length that each suffix shares with the one before it in suffix order (0 for the first)."""
    n = len(data)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    out = np.zeros(n, np.int64)
    held = 0
    for i in range(n):
        at = place[i]
        if not at:
            held = 0
            continue
        j = int(order[at - 1])
        while i + held < n and j + held < n and data[i + held] == data[j + held]:
            held += 1
        out[at] = held
        held = max(0, held - 1)
    return out


def longest_previous_factors(data: bytes) -> np.ndarray:
    """For each position, the longest string that starts there and at an earlier position."""
    order, _ = suffix_order(data)
    shared = common_prefixes(data, order)
    out = np.zeros(len(data), np.int64)
    # A stack of entries with growing positions: what is popped has met its next smaller
    # value, what stays below it is its previous smaller one.
    stack: list[list[int]] = []
    for at, length in zip([*order.tolist(), -1], [*shared.tolist(), 0]):
        while stack and stack[-1][0] > at:
            position, below = stack.pop()
            out[position] = max(below, length)
            length = min(below, length)
        stack.append([at, length])
    return out


def neighbours(rank: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each position has an earlier and a later one of equal rank.

    Positions ascend among equal ranks, so the previous smaller value of an entry
    in suffix order is the entry before it, if that shares its rank.
    """
    same = rank[order[1:]] == rank[order[:-1]]
    earlier, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    earlier[order[1:]], later[order[:-1]] = same, same
    return earlier, later


# --- documents ----------------------------------------------------------------


class ByteUnits(Units):
    window, gram = LENGTH, GRAM

    def __init__(self, payload: bytes):
        self.doc_ids, texts = open_slice(payload)
        bodies = [t.as_buffer().to_pybytes() for t in texts]
        self.buffer = b"".join(bodies)
        self.cuts = np.cumsum([0, *map(len, bodies)])

    def hashes(self, start: int, stop: int) -> np.ndarray:
        n = stop - start
        raw = np.zeros(n + GRAM + 8, np.uint8)
        own = np.frombuffer(self.buffer, np.uint8)[start : stop + GRAM + 8]
        raw[: len(own)] = own
        # Eight bytes at a time, then four of these for each gram.
        word = np.ndarray((n + GRAM,), "<u8", raw, strides=(1,)).copy()
        mixed = np.zeros(n, np.uint64)
        for k in range(0, GRAM, 8):
            mixed ^= word[k : k + n]
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return mixed * np.uint64(0xD6E8FEB86659FD93)

    def places(self, body: bytes, windows: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.arange(windows)
        return start, start + LENGTH


def compare_bytes(bodies: list[bytes], windows: list[int], often: list[int], low: list[int]):
    """Windows of the bodies that stand more than once, and their smallest documents."""
    whole = b"".join(bodies)
    order, rank = suffix_order(whole, LENGTH)
    begins = np.cumsum([0, *map(len, bodies)])
    # Only positions where a window of a body begins count; others are context.
    counts = np.array(windows)
    at = np.repeat(begins[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    real = np.zeros(len(whole), bool)
    real[at] = True
    order = order[real[order]]
    kept_rank = rank[order]
    first = np.concatenate(([True], kept_rank[1:] != kept_rank[:-1]))
    position_rank = np.cumsum(first) - 1
    number = np.zeros(len(whole), np.int64)
    number[order] = position_rank
    dense = number[at]
    local = np.argsort(dense, kind="stable")
    earlier, later = neighbours(dense, local)
    weight = np.repeat(np.array(often), counts) > 1
    doc = np.repeat(np.array(low, np.int64), counts)
    least = np.full(int(position_rank[-1]) + 1, NO_ID)
    np.minimum.at(least, dense, doc)
    heavy = np.zeros(len(least), bool)
    np.logical_or.at(heavy, dense, weight)
    again, lowest = earlier | later | heavy[dense], least[dense]
    cuts = np.cumsum([0, *windows]).tolist()
    return [(again[a:b], lowest[a:b]) for a, b in zip(cuts, cuts[1:])]


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
OUT_TEXT = OUT + ", kept binary, spans array<struct<begin:int,end:int>>"


def remove_repeats(docs: DataFrame, keep_first: bool = False, with_text: bool = False, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row for each document: what is left after repeated strings of LENGTH bytes are removed.

    ``keep_first``: a string stays where it stands first, in order of doc_id and position.
    ``with_text``: also the remaining bytes and the removed spans.
    """

    def finish(units: ByteUnits, again: np.ndarray, low: np.ndarray) -> pa.Table:
        if keep_first:
            own = np.repeat(units.ids(), np.diff(units.cuts))
            later = low < own
            for a, b in zip(units.cuts.tolist(), units.cuts[1:].tolist()):
                if (again[a:b] & ~later[a:b]).any():
                    later[a:b] |= longest_previous_factors(units.buffer[a:b]) >= LENGTH
            again = later
        gone = covered(again, LENGTH)
        data = np.frombuffer(units.buffer, np.uint8)
        rows = []
        for doc_id, a, b in zip(units.doc_ids, units.cuts.tolist(), units.cuts[1:].tolist()):
            own = gone[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
            kept = data[a:b][~own].tobytes()
            row = (doc_id, b - a, int(own.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest())
            if with_text:
                row += (kept, [{"begin": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
            rows.append(row)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
        columns = list(zip(*rows)) or [()] * (7 if with_text else 5)
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})

    schema = OUT_TEXT if with_text else OUT
    return repeated_windows(slices(docs), ByteUnits, compare_bytes, False, finish, schema, split_bytes, lowest=keep_first)
