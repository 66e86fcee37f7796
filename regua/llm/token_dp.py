"""Token counts by dynamic programming over prefixes.

For each prefix of a word there is one last token of its encoding. A token that
ends the prefix is that last token exactly if it may follow the last token of the
prefix before it, that is, if the pair of them encodes to itself. So one pass
over the bytes gives the last token and the exact number of tokens of every
prefix, and counts of all prefixes are kept. Truncation and budget questions are
then answered from counts, without encoding again.

Words are matches of the byte-level pattern; a text that is cut inside a match
may split differently near its end, so a prefix of a text is counted from the
start of its last match, or of the white space before that.

The vocabulary file is read by the driver and broadcast, since its size does
not depend on the data; a worker keeps the counts of words it has met, up to a
fixed number.

Defined results: a null or empty text has no tokens and no bytes; the file's
special strings inside a text count as one token each, as the library does by
default; texts are counted whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from regua.llm.common import append, texts_of, unused
from regua.llm.pretokens import Split, compiled

FILE = "byte_bpe_50k.json"
LIMIT = 512
#: Words and pairs of tokens that a worker remembers.
REMEMBERED = 500_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in set(plain))
    return shown | {chr(256 + n): b for n, b in enumerate(others)}


class Counter:
    """Counts of one vocabulary file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        of = byte_characters()
        specials = {t["content"] for t in spec["added_tokens"]}
        self.ids = {
            bytes(of[c] for c in token): i
            for token, i in model["vocab"].items()
            if token not in specials
        }
        self.bytes_of = {i: t for t, i in self.ids.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = (bytes(of[c] for c in x) for x in (a, b))
            pair = self.ids[left], self.ids[right]
            self.ranks.setdefault(pair, (rank, self.ids[left + right]))
        #: Endings of tokens: a stretch that is none of them ends no longer token.
        self.endings = {t[at:] for t in self.ids for at in range(len(t))}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials)))) if specials else None
        self.pattern = compiled()
        self.follows: dict[int, bool] = {}
        self.totals: dict[str, int] = {}
        self.split = Split(self._stretches)

    # --- one word -----------------------------------------------------------

    def _merged(self, data: bytes) -> list[int]:
        """Encoding of a few bytes by the merges, for testing pairs."""
        ids = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            options = [
                (*self.ranks[pair], at)
                for at, pair in enumerate(zip(ids, ids[1:]))
                if pair in self.ranks
            ]
            if not options:
                break
            _, made, at = min(options, key=lambda o: (o[0], o[2]))
            ids[at : at + 2] = [made]
        return ids

    def _test(self, before: int, token: int, key: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: nothing) in an encoding; remembered under ``key``."""
        if len(self.follows) > REMEMBERED:
            self.follows.clear()
        expected = [token] if before < 0 else [before, token]
        found = self._merged(b"".join([self.bytes_of[t] for t in expected])) == expected
        self.follows[key] = found
        return found

    def _extend(self, data: bytes, last: list[int], counts: list[int]) -> None:
        """Add last token and number of tokens of the prefixes of ``data`` that the lists lack."""
        token_of, known, endings = self.ids.get, self.follows.get, self.endings
        for end in range(len(last), len(data) + 1):
            start = end - 1
            while True:
                piece = data[start:end]
                token = token_of(piece)
                if token is not None:
                    before = last[start]
                    key = (before + 1) << 20 | token
                    fits = known(key)
                    if fits is None:
                        fits = self._test(before, token, key)
                    if fits:
                        last.append(token)
                        counts.append(counts[start] + 1)
                        break
                elif piece not in endings:
                    raise AssertionError("the vocabulary misses a byte")
                start -= 1

    def word(self, data: bytes) -> list[int]:
        """The number of tokens of each prefix of a word, the empty prefix first."""
        last, counts = [-1], [0]
        self._extend(data, last, counts)
        return counts

    def _learn(self, words: set[str]) -> None:
        """Totals of words not met yet. In sorted order, a word takes over the prefixes that it shares with the one before."""
        if len(self.totals) + len(words) > REMEMBERED:
            self.totals.clear()
        last, counts, before = [-1], [0], b""
        for data, word in sorted((w.encode(), w) for w in words):
            shared = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], counts[shared + 1 :]
            self._extend(data, last, counts)
            self.totals[word] = counts[-1]
            before = data

    def _total(self, word: str) -> int:
        if word not in self.totals:
            self._learn({word})
        return self.totals[word]

    # --- whole texts --------------------------------------------------------

    def _stretches(self, stretches: list[str]) -> list[int]:
        split = [self.pattern.findall(s) for s in stretches]
        asked = {w for words in split for w in words}
        missing = asked - self.totals.keys()
        # When the memory starts anew, words known so far are asked again.
        self._learn(missing if len(self.totals) + len(missing) <= REMEMBERED else asked)
        totals = self.totals
        return [sum([totals[w] for w in words]) for words in split]

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each whole text."""
        if self.specials is None or not any(map(self.specials.search, texts)):
            return [sum(found) for found in self.split.values(texts)]
        parts = [self.specials.split(t) for t in texts]
        flat = iter(self.split.values([p for own in parts for p in own]))
        return [sum(sum(next(flat)) for _ in own) + len(own) - 1 for own in parts]

    def prefixes(self, text: str) -> list[int]:
        """The number of tokens of each prefix of a text, by characters, the empty prefix first.

        Equal to counting ``text[:n]`` anew for every n, but for prefixes that end
        inside a special string, which are ordinary text there too.
        """
        counts, base, at = [0], 0, 0
        ends = [m.span() for m in self.specials.finditer(text)] if self.specials else []
        for start, end in [*ends, (len(text), len(text))]:
            # Inside a special string the prefix is ordinary text up to its last character.
            stop = max(start, end - 1)
            counts += [base + n for n in self._plain(text[at:stop])[1:]]
            if end > start:
                base += self._plain(text[at:start])[-1] + 1
                counts.append(base)
            at = end
        return counts

    def _plain(self, text: str) -> list[int]:
        spans = [m.span() for m in self.pattern.finditer(text)]
        counts, before = [0], [0]
        tables: dict[str, list[int]] = {}
        for i, (start, end) in enumerate(spans):
            word = text[start:end]
            if word not in tables:
                tables[word] = self.word(word.encode())
            table = tables[word]
            # A match that only ends other white space can join it in a shorter text.
            back = i - 1 if i and text[spans[i - 1][0] : start].isspace() else i
            origin, base = spans[back][0], before[back]
            size = 0
            for stop in range(start + 1, end + 1):
                size += len(text[stop - 1].encode())
                tail = text[origin:stop]
                if back == i and (stop == end or len(self.pattern.findall(tail)) == 1):
                    counts.append(before[i] + table[size])
                else:
                    counts.append(base + sum(map(self._total, self.pattern.findall(tail))))
            before.append(before[i] + table[-1])
        if spans:
            counts[-1] = before[-1]
        return counts

    def fitting(self, text: str, budget: int) -> str:
        """The longest prefix of a text with at most ``budget`` tokens."""
        counts = self.prefixes(text)
        return text[: max(n for n, c in enumerate(counts) if c <= budget)]


_counters: dict[bytes, Counter] = {}


def counter(data: bytes) -> Counter:
    key = hashlib.sha256(data).digest()
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(data)
    return _counters[key]


def _shared(docs: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(FILE), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_tokens, over_limit."""
    data = _shared(docs, path)

    def compute(column: pa.Array) -> list[pa.Array]:
        texts = texts_of(column)
        counts = np.array(counter(data.value).count(texts.to_pylist()), np.int64)
        return [pc.binary_length(texts).cast(pa.int64()), pa.array(counts), pa.array(counts > limit)]

    fields = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ]
    return append(docs.select("doc_id", "text"), "text", fields, compute).drop("text")


def truncated(docs: DataFrame, budget: int = LIMIT, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens (null stays null)."""
    data = _shared(docs, path)
    name = unused(docs, "fitting")

    def compute(column: pa.Array) -> list[pa.Array]:
        own = counter(data.value)
        return [
            pa.array([None if t is None else own.fitting(t, budget) for t in column.to_pylist()], pa.string())
        ]

    cut = append(docs, text, [T.StructField(name, T.StringType())], compute)
    return cut.withColumn(text, F.col(name)).select(docs.columns)
