"""Importance resampling against its definition, also with runs of words across lines, and against SQL."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import pytest

import brute
from compare import difference
from regua.llm import importance
from regua.llm.common import read
from regua.llm.oracle import ORACLE
from regua.llm.queries import QUERIES


def views(folder):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def features(text, longest):
    ws = brute.normal_words(text)
    return [" ".join(ws[i : i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]


def expected(docs, items, longest=1, buckets=10_000, least=20, percent=10):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(code(f) for _, t in docs for f in features(t, longest))
    t = Counter(code(f) for _, x in items for f in features(x, longest))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows, drawn = [], []
    for i, (d, text) in enumerate(docs):
        own = [gain[code(f)] for f in features(text, longest)]
        weight = sum(own) // len(own) if own else 0
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(brute.normal_words(text)) >= least:
                drawn.append((-score, d, len(own), weight, i))
        rows.append([d, len(own), weight, score, None])
    drawn.sort()
    for rank, (*_, i) in enumerate(drawn[: percent * len(drawn) // 100], 1):
        rows[i][4] = rank
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("longest, buckets, least, percent", [(1, 10_000, 20, 10), (3, 97, 1, 50), (2, 10_000, 5, 100), (1, 50, 20, 0)])
def test_against_the_definition(spark, awkward, longest, buckets, least, percent):
    folder, docs, items = awkward
    found = importance.importance(
        read(spark, folder, "documents"), read(spark, folder, "benchmark"),
        longest=longest, buckets=buckets, least_words=least, percent=percent,
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(docs, items, longest, buckets, least, percent)


def test_resample_keeps_rows_as_they_are(spark, awkward):
    folder, docs, items = awkward
    df = read(spark, folder, "documents")
    kept = importance.resample(df, read(spark, folder, "benchmark"), percent=50, least_words=5)
    assert kept.columns == df.columns
    drawn = [r for r in expected(docs, items, least=5, percent=50) if r[4] is not None]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in drawn)


def test_empty_target(spark, awkward):
    folder, docs, _ = awkward
    nothing = read(spark, folder, "benchmark").limit(0)
    found = importance.importance(read(spark, folder, "documents"), nothing)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(docs, [])


@pytest.mark.parametrize("tenth", [True, False])
def test_against_sql(spark, awkward, tenth):
    folder = "/root/testdata/sf0.01" if tenth else awkward[0]
    ours = QUERIES["op12_importance"](spark, folder).toPandas()
    theirs = views(folder).execute(ORACLE["op12_importance"]).fetchdf()
    # All columns are whole numbers, some with nulls.
    assert difference(ours.astype("Int64"), theirs.astype("Int64")) is None
