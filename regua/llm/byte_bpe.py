"""Byte-level BPE as recursive queries.

Encoding: each partition collects the distinct words (matches of the pattern)
that it has not met and puts their bytes as rows (word, position, token) into an
embedded SQL engine. A recursive query joins neighbouring tokens with the merge
table, finds the lowest rank of each word and contracts that pair, leftmost
first, until no word has a pair left. Equal pairs that do not overlap are
contracted in one step where this cannot change the outcome, namely where the
new token makes no pair of a lower rank with its neighbours; else only the
leftmost is.

A word of more than LONG bytes is contracted in windows that overlap, so that time
follows its length. A sequence of tokens is the encoding of its bytes exactly if each
pair of neighbours is the encoding of theirs. So two windows that share a token where
they overlap may be joined at it: all pairs come from one window or the other. Windows
that share none are contracted anew as one.

Decoding: token rows join the vocabulary, and an ordered aggregation puts the
pieces of each text together.

Spark partitions the texts; engine memory is bounded by working on small sets
of words and tokens at a time. Rank files are read by the driver and broadcast,
since their size does not depend on the data.

Defined results: a null or empty text has no tokens; any other text is encoded
whole, whatever its length; a repeated text gives the same ids; an empty table
gives no rows. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from regua.llm.common import append, ship, texts_of
from regua.llm.pretokens import Split, compiled

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Bytes of words in one recursive query, steps after which it is resumed, tokens in one decoding query.
WORD_BYTES, STEPS, DECODED = 400_000, 64, 400_000
#: Words whose ids a worker remembers (about 200 bytes each), parts of texts beside them.
REMEMBERED, PARTS = 1_500_000, 800_000

#: Words of more than LONG bytes are cut into windows, of which neighbours share OVERLAP bytes (half a window at most).
LONG, WINDOW, OVERLAP = 512, 80, 32

#: Stands for an id that is no token's.
NO_TOKEN = (1 << 32) - 1

#: For words of up to SHORT bytes: one pair of a word in a step, the leftmost of the lowest rank.
#: Rows carry the token behind them along, so that one sorted window serves a step.
SHORT = 64
LEFTMOST = """
WITH RECURSIVE r(word, pos, tok, after, done) AS (
    SELECT word, pos, tok, after, false FROM words
    UNION ALL
    SELECT word, pos, CASE WHEN key = lowest THEN (lowest // 1048576)::INT ELSE tok END,
        CASE WHEN key = lowest THEN second WHEN beyond = lowest THEN (lowest // 1048576)::INT ELSE after END,
        lowest IS NULL
    FROM (
        -- The rank leads the key and the position follows, so the smallest key is the pair to contract.
        SELECT word, pos, tok, after, key,
            min(key) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lowest,
            lag(key) OVER line AS before, lead(key) OVER line AS beyond, lead(after) OVER line AS second
        FROM (
            SELECT word, pos, tok, after, merged::BIGINT * 1048576 + pos AS key
            FROM (SELECT * FROM r WHERE NOT done)
            LEFT JOIN merges ON pair = tok::BIGINT * 4294967296 + after)
        WINDOW line AS (PARTITION BY word ORDER BY pos))
    WHERE lowest IS NULL OR before IS DISTINCT FROM lowest)
SELECT word, pos, tok, done FROM r WHERE done ORDER BY word, pos
"""

#: For longer words: all pairs of the lowest rank at once where that is safe.
CONTRACT = f"""
WITH RECURSIVE r(word, pos, tok, step, done) AS (
    SELECT word, pos, tok, 0, false FROM words
    UNION ALL
    SELECT word, pos,
        CASE WHEN hit AND (CASE WHEN one_by_one THEN nth = first_hit ELSE (nth - bar) % 2 = 1 END)
            THEN merged ELSE tok END,
        step + 1, lowest IS NULL
    FROM (
        SELECT word, pos, tok, step, merged, lowest, nth, coalesce(hit, false) AS hit,
            -- The last pair before this one that is not contracted: every second pair behind it is.
            coalesce(last_value(CASE WHEN hit IS NOT TRUE THEN nth END IGNORE NULLS) OVER
                (PARTITION BY word ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bar,
            min(CASE WHEN hit THEN nth END) OVER (PARTITION BY word) AS first_hit,
            coalesce(bool_or(hit AND (list_contains(early, before) OR list_contains(early, beyond)
                OR list_contains(early, merged))) OVER (PARTITION BY word), false) AS one_by_one
        FROM (
            SELECT *, merged = min(merged) OVER (PARTITION BY word) AS hit,
                min(merged) OVER (PARTITION BY word) AS lowest
            FROM (SELECT word, pos, tok, step, row_number() OVER line AS nth, lag(tok) OVER line AS before,
                      lead(tok) OVER line AS after, lead(tok, 2) OVER line AS beyond
                  FROM r WHERE NOT done AND step < {STEPS}
                  WINDOW line AS (PARTITION BY word ORDER BY pos))
            LEFT JOIN merges ON pair = tok::BIGINT * 4294967296 + after))
    WHERE NOT (CASE WHEN one_by_one THEN nth = first_hit + 1 ELSE (nth - 1 - bar) % 2 = 1 END))
SELECT word, pos, tok, done FROM r WHERE done OR step = {STEPS} ORDER BY word, pos
"""

JOINED = """
SELECT doc, string_agg(coalesce(piece, chr(239) || chr(191) || chr(189)), '' ORDER BY pos) AS body
FROM tokens LEFT JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(pair, merged, early): every pair of tokens that makes a token.

    ``early`` lists the neighbours with which the new token makes one of a lower rank.
    """
    rows = [
        (left, ranks[token[at:]], merged)
        for token, merged in ranks.items()
        for at in range(1, len(token))
        if (left := ranks.get(token[:at])) is not None and token[at:] in ranks
    ]
    early: dict[int, set[int]] = {}
    for left, right, merged in rows:
        if merged < left:
            early.setdefault(left, set()).add(right)
        if merged < right:
            early.setdefault(right, set()).add(left)
    left, right, merged = np.array(rows, np.int64).reshape(-1, 3).T
    partners = [sorted(early[m]) if m in early else None for m in merged.tolist()]
    return pa.table(
        {
            "pair": left * (1 << 32) + right,
            "merged": merged.astype(np.int32),
            "early": pa.array(partners, pa.list_(pa.int32())),
        }
    )


class Codec:
    """Encoder and decoder of one rank file; a worker keeps one for all its tasks."""

    def __init__(self, data: bytes):
        self.ranks = read_ranks(data)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = compiled()
        self.packed: dict[str, bytes] = {}
        self.split = Split(self._stretches, PARTS)
        self.sql = duckdb.connect(
            config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""}
        )
        self.size_of = np.zeros(max(self.ranks.values()) + 1, np.int64)
        self.size_of[list(self.ranks.values())] = [len(t) for t in self.ranks]
        merges = merge_table(self.ranks)  # noqa: F841, read by name
        self.sql.execute("CREATE TABLE merges AS SELECT * FROM merges")
        # Bytes as characters U+0000 to U+00FF, since pieces alone may not be valid UTF-8.
        pieces = pa.table(  # noqa: F841
            {
                "id": pa.array(list(self.ranks.values()), pa.int32()),
                "piece": [t.decode("latin-1") for t in self.ranks],
            }
        )
        self.sql.execute("CREATE TABLE vocabulary AS SELECT * FROM pieces")

    # --- encoding ---------------------------------------------------------

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids of each word, packed as little-endian 32-bit integers."""
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        tokens = self.of_byte[data]
        # The last byte of a word has nothing behind it.
        last = np.zeros(len(data), bool)
        last[starts + sizes - 1] = True
        rows = pa.table(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
                "pos": (np.arange(len(data)) - np.repeat(starts, sizes)).astype(np.int32),
                "tok": tokens,
                "after": pa.array(np.append(tokens[1:], 0).astype(np.int32), mask=last),
            }
        )
        out = [b""] * len(words)
        while rows.num_rows:
            self.sql.register("words", rows)
            found = self.sql.sql(query).to_arrow_table()
            self.sql.unregister("words")
            done = found.column("done").to_numpy()
            word = found.column("word").to_numpy()[done]
            ids = found.column("tok").to_numpy()[done].astype("<u4").tobytes()
            if len(word):
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(word)) + 1, [len(word)]))
                for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                    out[word[a]] = ids[4 * a : 4 * b]
            rows = found.filter(pa.array(~done)).select(["word", "pos", "tok"])
        return out

    def _made(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids of any number of words, a bounded number of bytes in each query."""
        made: list[bytes] = []
        start = held = 0
        for at in range(len(words) + 1):
            if at == len(words) or held > WORD_BYTES:
                if start < at:
                    made += self._contract(words[start:at], query)
                start, held = at, 0
            if at < len(words):
                held += len(words[at])
        return made

    def _tokens_at(self, ids: np.ndarray, start: int, low: int, high: int) -> dict[tuple[int, int], int]:
        """Tokens that lie between two places of a word, by place and id, with their number."""
        ends = start + np.cumsum(self.size_of[ids])
        starts = ends - self.size_of[ids]
        inside = np.flatnonzero((starts >= low) & (ends <= high))
        return {(p, t): k for k, p, t in zip(inside.tolist(), starts[inside].tolist(), ids[inside].tolist())}

    def _of_windows(self, word: bytes) -> bytes:
        """Ids of a long word, joined from those of its windows."""
        stride = WINDOW - OVERLAP
        places = [(a, min(a + WINDOW, len(word))) for a in range(0, max(1, len(word) - OVERLAP), stride)]
        distinct = list({word[a:b]: None for a, b in places})
        made = dict(zip(distinct, self._made(distinct, LEFTMOST)))
        parts = [np.frombuffer(made[word[a:b]], "<u4") for a, b in places]
        while True:
            # For each pair of neighbours a token that both have, as its numbers in either, or None.
            joints = []
            for at in range(len(parts) - 1):
                low, high = places[at + 1][0], places[at][1]
                left, right = (self._tokens_at(parts[i], places[i][0], low, high) for i in (at, at + 1))
                shared = next((key for key in left if key in right), None)
                joints.append(None if shared is None else (left[shared], right[shared]))
            if None not in joints:
                break
            whole, kept, at = [], [], 0
            while at < len(parts):
                apart = at < len(joints) and joints[at] is None
                whole.append((places[at][0], places[at + 1 if apart else at][1]))
                kept.append(None if apart else parts[at])
                at += 2 if apart else 1
            distinct = list({word[a:b]: None for (a, b), part in zip(whole, kept) if part is None})
            made = dict(zip(distinct, self._made(distinct, CONTRACT)))
            parts = [np.frombuffer(made[word[a:b]], "<u4") if p is None else p for (a, b), p in zip(whole, kept)]
            places = whole
        # A part gives its tokens from behind the one it shares with the part before to the one shared with the next.
        first = [0, *(right + 1 for _, right in joints)]
        behind = [*(left + 1 for left, _ in joints), None]
        return b"".join(part[a:b].tobytes() for part, a, b in zip(parts, first, behind))

    def _learn(self, words: list[str]) -> None:
        """Make the ids of words that are not known yet."""
        if len(self.packed) > REMEMBERED:
            self.packed.clear()
        short, middle = [], []
        for word in words:
            data = word.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.packed[word] = whole.to_bytes(4, "little")
            elif len(data) > LONG:
                self.packed[word] = self._of_windows(data)
            else:
                (short if len(data) <= SHORT else middle).append((word, data))
        for group, query in ((short, LEFTMOST), (middle, CONTRACT)):
            made = self._made([data for _, data in group], query)
            self.packed.update(zip((word for word, _ in group), made))

    def _stretches(self, stretches: list[str]) -> list[bytes]:
        split = [self.pattern.findall(s) for s in stretches]
        asked = {w for words in split for w in words}
        have = self.packed
        missing = [w for w in asked if w not in have]
        if len(have) + len(missing) > REMEMBERED:
            have.clear()
            missing = list(asked)
        self._learn(missing)
        return [b"".join([have[w] for w in words]) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        return [b"".join(found) for found in self.split.values(texts)]

    # --- decoding ---------------------------------------------------------

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes that packed ids stand for."""
        out = [b""] * len(packed)
        batch: list[int] = []
        held = 0
        for at in [*range(len(packed)), None]:
            if at is None or held > DECODED:
                self._join(packed, batch, out)
                batch, held = [], 0
            if at is not None:
                batch.append(at)
                held += len(packed[at]) // 4
        return out

    def _join(self, packed: list[bytes], batch: list[int], out: list[bytes]) -> None:
        ids = np.frombuffer(b"".join([packed[i] for i in batch]), "<u4").astype(np.int32)
        if not len(ids):
            return
        docs = np.repeat(np.array(batch, np.int32), [len(packed[i]) // 4 for i in batch])
        tokens = pa.table({"doc": docs, "pos": np.arange(len(ids), dtype=np.int32), "id": ids})
        self.sql.register("tokens", tokens)
        found = self.sql.sql(JOINED).to_arrow_table()
        self.sql.unregister("tokens")
        for doc, body in zip(found.column("doc").to_pylist(), found.column("body").to_pylist()):
            out[doc] = body.encode("latin-1")


_codecs: dict[bytes, Codec] = {}


def codec(data: bytes) -> Codec:
    key = hashlib.sha256(data).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(data)
    return _codecs[key]


def _shared_ranks(docs: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


ID_FIELDS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


def _columns(docs: DataFrame, text: str, path: str | None, fields: list[T.StructField]) -> DataFrame:
    data = _shared_ranks(docs, path)
    with_ids = any(f.name == "ids" for f in fields)

    def compute(column: pa.Array) -> list[pa.Array]:
        own = codec(data.value)
        packed = own.encode(texts_of(column).to_pylist())
        decoded = own.decode(packed)
        sizes = np.array([len(p) // 4 for p in packed], np.int64)
        out = [pa.array(sizes)]
        if with_ids:
            ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
            cuts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            out.append(pa.ListArray.from_arrays(cuts, pa.array(ids)))
        for values in (packed, decoded):
            out.append(pa.array([hashlib.sha256(v).hexdigest() for v in values]))
        return out

    return append(docs, text, fields, compute)


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of each document."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _columns(docs, "text", path, ID_FIELDS).drop("text")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    fields = [f for f in ID_FIELDS if f.name != "ids"]
    return _columns(docs.select("doc_id", "text"), "text", path, fields).drop("text")


def _packed(ids: list[int | None]) -> bytes:
    """Ids as they are packed by the encoder; what no token can have becomes the largest number."""
    return np.array([i if i is not None and 0 <= i < 1 << 31 else NO_TOKEN for i in ids], "<u4").tobytes()


def decoded(tokens: DataFrame, ids: str = "ids", name: str = "text", path: str | None = None) -> DataFrame:
    """``tokens`` with the text of its ids; bytes that are not UTF-8 become replacement characters, null ids null."""
    ship(tokens.sparkSession)
    data = _shared_ranks(tokens, path)
    if name.lower() in {c.lower() for c in tokens.columns}:
        raise ValueError(f"column exists already: {name}")
    at, names = tokens.columns.index(ids), [*tokens.columns, name]

    def run(batches):
        own = codec(data.value)
        for batch in batches:
            lists = batch.column(at).to_pylist()
            bodies = own.decode([_packed(x or []) for x in lists])
            texts = [None if x is None else b.decode("utf-8", "replace") for x, b in zip(lists, bodies)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(name, T.StringType())]))
