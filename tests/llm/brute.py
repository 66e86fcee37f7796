"""The operators' definitions, spelled out over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text):
    return WORD.findall(text or "")


def normal_words(text):
    return NORMAL.findall((text or "").translate(LOWER))


def last(doc_id):
    return math.inf if doc_id is None else doc_id


def base_scores(docs):
    tokens = [words((t or "").translate(LOWER)) + [""] for _, t in docs]
    trains = [d is None or zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in docs]
    counts = Counter(w for own, t in zip(tokens, trains) if t for w in own)
    n, v = sum(counts.values()), len(counts)
    return [
        (d, len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        for (d, _), own in zip(docs, tokens)
    ]


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        own = normal_words(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[i : i + 10])].add(item)
    out = []
    for d, text in docs:
        n, hit, found = _hits(text, windows)
        out.append((d, n, len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def _hits(text, windows):
    own, hit, found = normal_words(text), set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(own) - n + 1):
            key = tuple(own[i : i + n])
            if key in windows:
                hit.update(range(i, i + n))
                found |= {str(x) for x in windows[key] if x is not None}
    return len(own), hit, found


def without_marked(docs, items):
    """Texts, letter by letter: a marked word goes with the separators in front of it."""
    windows = defaultdict(set)
    for item, text in items:
        own = normal_words(text)
        for i in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[i : i + 10])].add(item)
    out = []
    for d, text in docs:
        _, hit, _ = _hits(text, windows)
        if not hit:
            out.append((d, text))
            continue
        kept, held, word, at = "", "", "", 0
        for c in [*text, None]:
            if c is not None and (ord(c) > 127 or c.isalnum()):
                word += c
                continue
            if word:
                kept += "" if at in hit else held + word
                held, word, at = "", "", at + 1
            held += c or ""
        out.append((d, kept + held))
    return out


def repeated_bytes(docs, width=400):
    bodies = [(t or "").encode() for _, t in docs]
    seen = Counter(b[i : i + width] for b in bodies for i in range(len(b) - width + 1))
    out = []
    for (d, _), b in zip(docs, bodies):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), spans, sha(kept)))
    return out


def equal_texts(docs):
    bodies = [(t or "").translate(LOWER) for _, t in docs]
    groups = defaultdict(list)
    for i, b in enumerate(bodies):
        groups[b].append(i)
    out = []
    for i, b in enumerate(bodies):
        ids = [docs[k][0] for k in groups[b] if docs[k][0] is not None]
        out.append((docs[i][0], max(ids, default=None), len(groups[b]), sha(b.encode())))
    return out


def earlier_passages(docs, width=50):
    own = [words(t) for _, t in docs]
    first = {}
    for (d, _), ws in zip(docs, own):
        for i in range(len(ws) - width + 1):
            key = tuple(ws[i : i + width])
            first[key] = min(first.get(key, math.inf), last(d))
    out = []
    for (d, _), ws in zip(docs, own):
        gone = set()
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i : i + width])] < last(d):
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), sha(kept.encode())))
    return out


def fingerprint(text):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs):
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                group[max(root(i), root(j))] = min(root(i), root(j))
    members = defaultdict(list)
    for i in range(len(docs)):
        members[root(i)].append(i)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[k][0] for k in members[root(i)] if docs[k][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids, default=None)))
    return out


def exact_grams(lines, order):
    """Counts of all runs of 1 to ``order`` tokens; a line stands behind an end."""
    seen = Counter()
    for line in lines:
        seen.update((w,) for w in line)
        behind = ["", *line]
        for k in range(2, order + 1):
            seen.update(tuple(behind[i : i + k]) for i in range(len(behind) - k + 1))
    return seen


def exact_score(line, seen, n, v, order, mu=1000.0):
    """The model's log10 probability of a line from exact counts."""
    total, behind = 0.0, ["", *line]
    for at in range(1, len(behind)):
        p = (seen[(behind[at],)] + 1) / (n + v + 1)
        for k in range(2, min(order, at + 1) + 1):
            gram = tuple(behind[at - k + 1 : at + 1])
            p = (seen[gram] + mu * p) / (max(seen[gram[:-1]], seen[gram]) + mu)
        total += math.log10(p)
    return total


def lm_scores(docs, order):
    """(doc_id, base tokens, score by exact counts) of each document, learned from those that are not held out."""
    cut = lambda t: [w for w in re.split("[ \\t\\n\\v\\f\\r]+", (t or "").translate(LOWER)) if w] + [""]
    lines = [(d, cut(t)) for d, t in docs]
    training = [line for d, line in lines if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    seen = exact_grams(training, order)
    n, v = sum(map(len, training)), len({w for line in training for w in line})
    return [(d, len(line), exact_score(line, seen, n, v, order)) for d, line in lines]
