"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of ``WINDOW`` bytes that together cover all of them.
A gated recurrent unit runs over each window in either direction, and from both
states every byte gets a probability for each language; the mean over all bytes
of a text is the probability of the text. Training is backpropagation through
time in numpy with Adam, on windows sampled from at most ``PER_LANGUAGE``
documents of each language. The network sees bytes only, A-Z lower-cased.

Arrays are laid out as (unit, window), many windows at a time, so the cost of a
byte is a few vector operations. The input matrices are folded into a table
with one column for each byte.

Defined results: ``und`` with score 0 for a null text or one without a letter,
and for all texts if there is nothing to learn from; with one language learned,
that one; of equal probabilities the alphabetically first; documents without a
language teach nothing; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from regua.llm.common import append, held_out, texts_of

WINDOW = 96
UNITS = 8
#: Bounds of the training sample.
PER_LANGUAGE, MAX_DOCS, WINDOWS_PER_DOC = 200, 4_000, 12
STEPS, BATCH, LEARNING_RATE = 100, 192, 0.03
#: Windows worked on at a time.
LANES = 2048
UNDECIDED = "und"


def _tanh_gate(x: np.ndarray) -> np.ndarray:
    """Logistic function, by way of tanh."""
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters: for each direction a byte table, a recurrent matrix and its bias; then the output layer."""

    languages: list[str]
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (3 * UNITS, 256))
            p[f"u{d}"] = rng.normal(0, 0.3, (3 * UNITS, UNITS))
            p[f"c{d}"] = np.zeros((UNITS, 1))
        p["w"] = rng.normal(0, 0.3, (len(languages), 2 * UNITS))
        p["b"] = np.zeros((len(languages), 1))
        return cls(languages, {k: v.astype(np.float32) for k, v in p.items()})

    def states(self, data: np.ndarray, real: np.ndarray | None, d: str, tape: list | None = None) -> np.ndarray:
        """States of one direction behind each byte: (time, unit, window).

        ``data``: bytes as (time, window). ``real`` marks bytes that are not padding;
        states stay zero before the first of them. ``tape`` gets what training needs.
        """
        n, lanes = data.shape
        x, u, c = self.p[f"x{d}"], self.p[f"u{d}"], self.p[f"c{d}"]
        h = np.zeros((UNITS, lanes), np.float32)
        out = np.empty((n, UNITS, lanes), np.float32)
        for t in range(n) if d == "f" else range(n - 1, -1, -1):
            a = x[:, data[t]]
            v = u @ h
            gates = _tanh_gate(a[: 2 * UNITS] + v[: 2 * UNITS])
            z, r = gates[:UNITS], gates[UNITS:]
            s = v[2 * UNITS :] + c
            m = np.tanh(a[2 * UNITS :] + r * s)
            if tape is not None:
                tape.append((t, h, z, r, s, m))
            h = m + z * (h - m)
            if real is not None:
                h = h * real[t]
            out[t] = h
        return out

    def probabilities(self, data: np.ndarray, real: np.ndarray | None = None) -> np.ndarray:
        """Of each language at each byte: (time, language, window)."""
        forth, back = self.states(data, real, "f"), self.states(data, real, "b")
        w = self.p["w"]
        scores = w[:, :UNITS] @ forth + w[:, UNITS:] @ back + self.p["b"]
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True)
        return scores

    # --- training -----------------------------------------------------------

    def gradients(self, data: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over all bytes of full windows; ``target``: the language of each window."""
        n, lanes = data.shape
        tapes = {"f": [], "b": []}
        h = {d: self.states(data, None, d, tapes[d]) for d in "fb"}
        w = self.p["w"]
        scores = w[:, :UNITS] @ h["f"] + w[:, UNITS:] @ h["b"] + self.p["b"]
        scores -= scores.max(axis=1, keepdims=True)
        e = np.exp(scores)
        e /= e.sum(axis=1, keepdims=True)
        e[:, target, np.arange(lanes)] -= 1
        e /= n * lanes
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["b"] = e.sum(axis=(0, 2))[:, None]
        for i, d in enumerate("fb"):
            part = slice(i * UNITS, (i + 1) * UNITS)
            g["w"][:, part] = np.einsum("tlk,tuk->lu", e, h[d])
            into = w[:, part].T @ e
            u = self.p[f"u{d}"]
            dh = np.zeros((UNITS, lanes), np.float32)
            steps, columns = [], []
            for t, before, z, r, s, m in reversed(tapes[d]):
                dh = dh + into[t]
                dm = dh * (1 - z) * (1 - m * m)
                dz = dh * (before - m) * z * (1 - z)
                dr = dm * s * r * (1 - r)
                ds = dm * r
                dv = np.concatenate((dz, dr, ds))
                g[f"u{d}"] += dv @ before.T
                g[f"c{d}"] += ds.sum(axis=1, keepdims=True)
                steps.append(np.concatenate((dz, dr, dm)))
                columns.append(data[t])
                dh = dh * z + u.T @ dv
            # Sum what each byte's column of the table gets.
            at = np.concatenate(columns)
            values = np.concatenate(steps, axis=1)
            for row, own in enumerate(values):
                g[f"x{d}"][row] = np.bincount(at, own, 256)
        return g


def fit(windows: dict[str, np.ndarray], steps: int = STEPS, seed: int = 1) -> Network | None:
    """Train on full windows (rows of ``WINDOW`` bytes) of each language."""
    languages = sorted(name for name, rows in windows.items() if len(rows))
    if not languages:
        return None
    net = Network.fresh(languages, seed)
    if len(languages) == 1:
        return net
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        target = rng.integers(len(languages), size=BATCH)
        rows = [windows[languages[k]][rng.integers(len(windows[languages[k]]))] for k in target]
        g = net.gradients(np.array(rows).T, target)
        rate = LEARNING_RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in net.p.items():
            grad = np.clip(g[k], -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            net.p[k] = (v - rate * move).astype(np.float32)
    return net


def sample_windows(text: str, count: int = WINDOWS_PER_DOC) -> list[bytes]:
    """Up to ``count`` full windows, spread evenly over the text; a short text is repeated to fill one."""
    data = text.encode().lower()
    if not data:
        return []
    if len(data) < WINDOW:
        return [(data * (WINDOW // len(data) + 1))[:WINDOW]]
    starts = np.unique(np.linspace(0, len(data) - WINDOW, count).astype(int))
    return [data[s : s + WINDOW] for s in starts.tolist()]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, max_docs: int = MAX_DOCS) -> Network | None:
    """Learn from text and language of documents whose crc32(id) mod 3 is not 1."""
    known = docs.where("lang is not null and doc_id is not null").where(~held_out(F.col("doc_id"), 3, 1))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.select("lang", "doc_id")
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= per_language)
        .orderBy("nth", "lang")
        .limit(max_docs)
        .select("lang", "doc_id")
    )
    # At most max_docs pairs, so small enough to broadcast by construction.
    rows = known.select("lang", "doc_id", "text").join(F.broadcast(chosen), ["lang", "doc_id"])
    kind = T.ArrayType(T.BinaryType())

    def compute(column: pa.Array) -> list[pa.Array]:
        return [pa.array([sample_windows(t) for t in texts_of(column).to_pylist()], pa.list_(pa.binary()))]

    sampled = append(rows, "text", [T.StructField("windows", kind)], compute)
    found = sampled.select("lang", "doc_id", "windows").orderBy("lang", "doc_id", "windows").limit(2 * max_docs)
    of: dict[str, list[bytes]] = {}
    for row in found.collect():
        of.setdefault(row.lang, []).extend(bytes(w) for w in row.windows)
    return fit({k: np.frombuffer(b"".join(v), np.uint8).reshape(-1, WINDOW) for k, v in of.items()})


def _pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all bytes of each text: (text, language)."""
    total = np.zeros((len(texts), len(net.languages)))
    full, full_of, rest, rest_of = [], [], [], []
    for i, data in enumerate(texts):
        n = len(data) // WINDOW
        if n:
            full.append(data[: n * WINDOW])
            full_of += [i] * n
        if len(data) % WINDOW:
            rest.append(data[n * WINDOW :].ljust(WINDOW, b"\0"))
            rest_of.append(i)
    blocks = [
        (np.frombuffer(b"".join(full), np.uint8).reshape(-1, WINDOW), full_of, None),
        (np.frombuffer(b"".join(rest), np.uint8).reshape(-1, WINDOW), rest_of, [len(texts[i]) % WINDOW for i in rest_of]),
    ]
    for rows, owner, sizes in blocks:
        for at in range(0, len(rows), LANES):
            data = np.ascontiguousarray(rows[at : at + LANES].T)
            real = None
            if sizes is not None:
                real = (np.arange(WINDOW)[:, None] < np.array(sizes[at : at + LANES])).astype(np.float32)
            p = net.probabilities(data, real)
            if real is not None:
                p *= real[:, None, :]
            np.add.at(total, owner[at : at + LANES], p.sum(axis=0, dtype=np.float64).T)
    return total / np.maximum([len(t) for t in texts], 1)[:, None]


def label_bytes(net: Network, text: str) -> list[str]:
    """The language of each byte of a text."""
    data = text.encode().lower()
    out: list[str] = []
    for at in range(0, len(data), WINDOW):
        p = net.probabilities(np.frombuffer(data[at : at + WINDOW], np.uint8)[:, None])
        out += [net.languages[k] for k in p[:, :, 0].argmax(axis=1)]
    return out


def predict(net: Network | None, texts: list[str]) -> tuple[list[str], list[float]]:
    names, scores = [UNDECIDED] * len(texts), [0.0] * len(texts)
    lettered = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
    if net is None or not lettered:
        return names, scores
    pooled = np.clip(_pooled(net, [texts[i].encode().lower() for i in lettered]), 0, 1)
    for i, row in zip(lettered, pooled):
        names[i], scores[i] = net.languages[int(row.argmax())], float(row.max())
    return names, scores


def languages(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score."""
    net = train(docs)

    def compute(column: pa.Array) -> list[pa.Array]:
        names, scores = predict(net, texts_of(column).to_pylist())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    found = append(docs.select("doc_id", "text"), "text", fields, compute)
    return found.select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score"
    )
