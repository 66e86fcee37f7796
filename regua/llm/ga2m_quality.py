"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a row of measures. Cyclic boosting visits the measures in
turn and adds a small step of a shallow tree (at most three leaves) to the
lookup table of each; the pairs whose joint bins explain most of what is left
get tables of their own in the same way (four leaves). A score is the logistic
of a sum of table entries, so scoring looks up bins and adds vectors.

The model is fitted on at most ``max_rows`` labelled rows, chosen by a hash of
the id; every text is scored whole. The measures see the text only.

Defined results: null and empty texts get measures of zero and a score; without
labels of both kinds the score is the share of label 1 (0.5 without labels); a
document labelled more than once counts with its lowest label; labels that are
null or without a document are not used; an empty table gives no rows; other
columns of the input are kept by :func:`keep_good` and ignored by :func:`score`.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from regua.llm.common import append, held_out, texts_of, unused

MAX_ROWS = 8_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE, SHRINK = 0.15, 2.0
THRESHOLD = 0.3

MEASURES = (
    "log_bytes log_words mean_word longest_word distinct_words repeated_next repeated_second "
    "lines repeated_lines short_lines upper digits spaces newlines full_stops commas bars "
    "exclamations marks other_signs non_ascii entropy words_with_signs links"
).split()

_SIGNS = np.zeros(256, bool)
_SIGNS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_MARKS = [ord(c) for c in "#$%&*"]
_NOT_WORD = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'-")


def measure(text: str) -> list[float]:
    """The measures of one text, in the order of ``MEASURES``."""
    data = text.encode()
    if not data:
        return [0.0] * len(MEASURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    share = counts / size
    words = data.split()
    n = len(words) or 1
    lines = data.split(b"\n")
    seen = share[share > 0]
    letters = counts[65:91].sum() + counts[97:123].sum()
    signs = share[_SIGNS].sum()
    marks = share[_MARKS].sum()
    return [
        np.log1p(size),
        np.log1p(len(words)),
        (size - counts[9:14].sum() - counts[32]) / n,
        np.log1p(max(map(len, words), default=0)),
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(map(operator.eq, words, words[2:])) / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        sum(len(line) < 40 for line in lines) / len(lines),
        counts[65:91].sum() / (letters or 1),
        share[48:58].sum(),
        share[32],
        share[10],
        share[46],
        share[44],
        share[124],
        share[33],
        marks,
        signs - marks - share[33] - share[44] - share[46] - share[124],
        share[128:].sum(),
        float(-(seen * np.log2(seen)).sum()),
        (size - len(data.translate(None, _NOT_WORD))) / n,
        (data.count(b"http") + data.count(b"www.") + data.count(b"@")) / n,
    ]


def _matrix(column: pa.Array) -> np.ndarray:
    rows = [measure(text) for text in texts_of(column).to_pylist()]
    return np.array(rows, np.float32).reshape(-1, len(MEASURES))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _gain(g, h):
    return g * g / (h + SHRINK)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """Best place to cut ordered bins in two, and what it gains; 0 for no cut."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0, 0.0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    best = int(gains.argmax())
    return (best + 1, float(gains[best])) if gains[best] > 1e-9 else (0, 0.0)


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return float(g.sum() / (h.sum() + SHRINK))


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step of a tree with at most three leaves, spread over the bins."""
    edges = [0, len(g)]
    for _ in range(2):
        cuts = [(_cut(g[a:b], h[a:b]), a) for a, b in zip(edges, edges[1:])]
        (at, gained), start = max(cuts, key=lambda c: c[0][1])
        if gained <= 0:
            break
        edges = sorted([*edges, start + at])
    return np.concatenate([np.full(b - a, _leaf(g[a:b], h[a:b])) for a, b in zip(edges, edges[1:])])


def _grid_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step over a grid: one cut along rows, then one along columns on either side."""
    out = np.empty_like(g)
    at, _ = _cut(g.sum(1), h.sum(1))
    for part in (slice(0, at), slice(at, None)):
        gs, hs = g[part], h[part]
        if not gs.size:
            continue
        col, _ = _cut(gs.sum(0), hs.sum(0))
        for side in (slice(0, col), slice(col, None)):
            if gs[:, side].size:
                out[part, side] = _leaf(gs[:, side], hs[:, side])
    return out


@dataclass
class Model:
    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        bins = self.bins(x)
        for table, at in zip(self.tables, bins):
            total += table[at]
        for table, (i, j) in zip(self.pair_tables, self.pairs):
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(_sigmoid(self.logits(x.astype(np.float64))), 0.0, 1.0)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on measures ``x`` and labels ``y`` (0 or 1)."""
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
        return Model(start=float(np.log(share / (1 - share))))
    x = x.astype(np.float64)
    model = Model(start=float(np.log(y.mean() / (1 - y.mean()))))
    for column in x.T:
        model.edges.append(np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])))
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [np.arange(len(t)) * PAIR_BINS // len(t) for t in model.tables]
    bins = model.bins(x)
    f = np.full(len(y), model.start)
    for _ in range(ROUNDS):
        for table, at in zip(model.tables, bins):
            p = _sigmoid(f)
            n = len(table)
            step = RATE * _tree(
                np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n)
            )
            table += step
            f += step[at]
    cells = PAIR_BINS * PAIR_BINS

    def grid(i: int, j: int) -> np.ndarray:
        return model.coarse[i][bins[i]] * PAIR_BINS + model.coarse[j][bins[j]]

    p = _sigmoid(f)
    found = []
    for i in range(len(bins)):
        for j in range(i):
            at = grid(i, j)
            g, h = np.bincount(at, y - p, cells), np.bincount(at, p * (1 - p), cells)
            found.append((float(_gain(g, h).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(found, reverse=True)[:PAIRS]]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    grids = [grid(i, j) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for table, at in zip(model.pair_tables, grids):
            p = _sigmoid(f)
            g = np.bincount(at, y - p, cells).reshape(table.shape)
            h = np.bincount(at, p * (1 - p), cells).reshape(table.shape)
            step = RATE * _grid_tree(g, h)
            table += step
            f += step.ravel()[at]
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model:
    """Fit on labelled documents whose crc32(id) mod 5 is not 0, at most ``max_rows`` of them."""
    chosen = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
        .where("y in (0, 1) and id is not null")
        .where(~held_out(F.col("id"), 5, 0))
        .groupBy("id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    # At most max_rows pairs of id and label: small enough to broadcast by construction.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(
        F.broadcast(chosen), "id"
    )
    kind = T.ArrayType(T.FloatType())
    measured = append(
        rows.select("id", "y", "t"),
        "t",
        [T.StructField("m", kind)],
        lambda column: [pa.array(list(_matrix(column)), pa.list_(pa.float32()))],
    )
    found = (
        measured.select("id", "y", "m").orderBy(F.xxhash64("id"), "id", "m").limit(max_rows).collect()
    )
    x = np.array([r.m for r in found], np.float32).reshape(-1, len(MEASURES))
    return fit(x, np.array([r.y for r in found], np.float64))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""

    def compute(column: pa.Array) -> list[pa.Array]:
        return [pa.array(model.scores(_matrix(column)), pa.float64())]

    return append(docs, text, [T.StructField(name, T.DoubleType())], compute)


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    name = unused(docs, "quality_score")
    return score(docs, model, text, name).where(F.col(name) >= threshold).select(docs.columns)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
