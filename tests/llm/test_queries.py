"""Every registered query against its definition on awkward rows, and against SQL where there is some."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from compare import connect, difference
from regua.llm import bloom_lm, byte_bpe, decontaminate
from regua.llm.oracle import ORACLE
from regua.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = {
    "op1_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op6_language": "doc_id held_out lang_pred score",
    "op7_superkmer_dedup": "doc_id n_words n_removed kept_sha256",
    "op8_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op9_simhash": "doc_id fingerprint component_id",
    "op10_quality": "doc_id held_out score predicted",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_importance": "doc_id n_features weight score rank",
    "op13_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans n_disguised",
}


def rows(spark, name, folder, *columns):
    df = QUERIES[name](spark, folder)
    assert df.columns == COLUMNS[name].split()
    found = df.select(*(columns or df.columns)).collect()
    return sorted((tuple(r) for r in found), key=repr)


def same(found, expected):
    assert found == sorted(expected, key=repr)


def test_all_are_registered():
    assert list(QUERIES) == list(COLUMNS)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_empty_tables(spark, empty, name):
    assert rows(spark, name, empty) == []


def test_lm_scoring(spark, awkward):
    folder, docs, _ = awkward
    found = rows(spark, "op1_lm_scoring", folder)
    expected = sorted(brute.base_scores(docs), key=repr)
    key = lambda r: (repr(r[0]), r[1], r[2], round(r[4], 6))
    ours = sorted(((d, n, k, t, b) for d, _, n, k, t, b, _ in found), key=key)
    for a, b in zip(ours, sorted(expected, key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9)
    assert all(s <= 0 for *_, s in found)


@pytest.mark.parametrize("order", [2, 3])
def test_lm_scores_against_exact_counts(spark, awkward, order):
    """Quantised counts and false answers move no document by more than 0.1 a token; passes change nothing."""
    folder, docs, _ = awkward
    table = spark.read.parquet(f"{folder}/documents.parquet")
    whole = bloom_lm.lm_scores(table, order).collect()
    key = lambda r: (repr(r[0]), r[1], round(r[2], 3))
    ours = sorted(((r.doc_id, r.n_tokens, r.score) for r in whole), key=key)
    theirs = sorted(brute.lm_scores(docs, order), key=key)
    gaps = []
    by_id = {}
    for d, n, score in theirs:
        by_id.setdefault((d, n), []).append(score)
    for d, n, score in ours:
        expected = min(by_id[d, n], key=lambda x: abs(x - score))
        gaps.append(abs(score - expected) / n)
    assert max(gaps) < 0.1 and sum(gaps) / len(gaps) < 0.02
    once, often = (bloom_lm.lm_scores(table, order, size, 2_000).collect() for size in (1 << 20, 5_000))
    assert sorted(map(repr, once)) == sorted(map(repr, often))


def test_decontamination(spark, awkward):
    folder, docs, items = awkward
    same(rows(spark, "op2_decontamination", folder), brute.contamination(docs, items))


def test_marked_words_removed(spark, awkward):
    folder, docs, items = awkward
    table, tests = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    left = decontaminate.remove_marked_words(table, tests)
    assert left.columns == table.columns
    same(sorted(map(tuple, left.select("doc_id", "text").collect()), key=repr), brute.without_marked(docs, items))


def test_hash_sets_in_several_scans(spark, awkward):
    """A benchmark dealt over many small sets marks the same words and items as one set does."""
    folder, _, _ = awkward
    table, tests = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    windows = decontaminate.item_windows(tests, decontaminate.SIZE, "item_id", "text")
    assert max(decontaminate.set_bits(c, 256)[1] for c in decontaminate.counted(windows).values()) > 1

    def found(bits):
        staged, hits = decontaminate.scanned(table, tests, "text", "no", "words", max_bits=bits)
        got = staged.join(hits, "no").select("doc_id", "words", F.array_sort("marked").alias("marked"), "items")
        return sorted(map(repr, got.collect()))

    assert found(256) == found(decontaminate.MAX_BITS) != []


def test_hash_set_follows_the_benchmark(spark):
    """Under one in a hundred other windows passes, and no set is larger than its bound."""
    for n in (0, 1, 10_000, 349_525, 349_526, 5_000_000, 100_000_000):
        bits, sets = decontaminate.set_bits(n)
        assert bits & (bits - 1) == 0 and bits <= decontaminate.MAX_BITS
        assert bits * sets >= n * decontaminate.BITS_PER_WINDOW
    for n in (10_000, 500_000):
        bits, _ = decontaminate.set_bits(n)
        codes = spark.range(n).select(F.xxhash64(F.col("id").cast("string")).alias("code"))
        held = decontaminate.hash_set(codes, bits)
        probe = decontaminate._probe(F.col("held"), F.xxhash64((F.col("id") + n).cast("string")), bits)
        inside = decontaminate._probe(F.col("held"), F.xxhash64(F.col("id").cast("string")), bits)
        ids = spark.range(2_000, numPartitions=1)
        wrong, right = ids.join(F.broadcast(held)).agg(F.sum(probe.cast("int")), F.sum(inside.cast("int"))).first()
        assert right == 2_000 and wrong < 20


def test_byte_bpe(spark, awkward):
    folder, docs, _ = awkward
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for d, text in docs:
        ids = known.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((d, len(ids), brute.sha(packed), brute.sha((text or "").encode())))
    same(rows(spark, "op3_byte_bpe", folder), expected)


def test_suffix_dedup(spark, awkward):
    folder, docs, _ = awkward
    same(rows(spark, "op4_suffix_dedup", folder), brute.repeated_bytes(docs))


def test_exact_dedup(spark, awkward):
    folder, docs, _ = awkward
    same(
        rows(spark, "op5_exact_dedup", folder, "doc_id", "keep_id", "group_size", "text_sha256"),
        brute.equal_texts(docs),
    )
    kept = QUERIES["op5_exact_dedup"](spark, folder).where("kept").collect()
    assert len(kept) == len({r.text_sha256 for r in kept}) == len({x[3] for x in brute.equal_texts(docs)})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_superkmer_dedup(spark, awkward):
    folder, docs, _ = awkward
    same(rows(spark, "op7_superkmer_dedup", folder), brute.earlier_passages(docs))


def test_token_counts(spark, awkward):
    folder, docs, _ = awkward
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = [len(e.ids) for e in library.encode_batch([t or "" for _, t in docs], add_special_tokens=False)]
    expected = [(d, len((t or "").encode()), n, n > 512) for (d, t), n in zip(docs, counts)]
    same(rows(spark, "op8_token_counts", folder), expected)


def test_simhash(spark, awkward):
    folder, docs, _ = awkward
    same(rows(spark, "op9_simhash", folder), brute.near_groups(docs))


def test_language_on_awkward_rows(spark, awkward):
    folder, docs, _ = awkward
    df = QUERIES["op6_language"](spark, folder)
    found = df.collect()
    assert len(found) == len(docs)
    lettered = sum(any(map(str.isalpha, t or "")) for _, t in docs)
    assert sum(r.lang_pred == "und" for r in found) == len(docs) - lettered
    assert {r.lang_pred for r in found} <= {"en", "de", "fr", "und"}
    assert all(0 <= r.score <= 1 for r in found)


def test_language_on_held_out_rows(spark):
    found = QUERIES["op6_language"](spark, SF).where("held_out")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    judged = found.join(docs, "doc_id").selectExpr("avg(cast(lang = lang_pred as int)) a", "count(*) n").first()
    assert judged.n > 200 and judged.a > 0.97


def test_quality_on_awkward_rows(spark, awkward):
    folder, docs, _ = awkward
    found = QUERIES["op10_quality"](spark, folder).collect()
    assert len(found) == len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_quality_on_held_out_rows(spark):
    found = QUERIES["op10_quality"](spark, SF).where("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = found.join(labels, "doc_id").selectExpr("avg(cast(quality = predicted as int)) a", "count(*) n").first()
    assert judged.n > 50 and judged.a > 0.93


def test_model_beats_unigrams_on_either_part(spark):
    found = QUERIES["op1_lm_scoring"](spark, SF).groupBy("held_out")
    for total in found.agg({"score": "sum", "base_score": "sum"}).collect():
        assert total["sum(score)"] > total["sum(base_score)"]


@pytest.mark.parametrize("name", [n for n in ORACLE if n != "op12_importance"])
def test_same_as_sql(spark, awkward, name):
    with connect(SF) as duck:
        theirs = duck.execute(ORACLE[name]).df()
    assert difference(QUERIES[name](spark, SF).toPandas(), theirs) is None


@pytest.fixture(scope="module")
def stages(spark, awkward):
    """What each stage got and gave, as lists of (doc_id, text)."""
    folder, _, items = awkward
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
            docs = corpus_pipeline.store(after, "step")
            steps.append((before, [(r.doc_id, r.text) for r in docs.collect()]))
        else:
            steps.append((before, after.collect()))
    return steps, items


def ordered(docs):
    return sorted(docs, key=repr)


def test_pipeline_stages(stages):
    (quality, exact, near, clean, tokens), items = stages
    assert set(map(repr, quality[1])) <= set(map(repr, quality[0]))
    # Of equal texts the largest id stays, once.
    chosen = {}
    for d, t in exact[0]:
        key = (t or "").translate(brute.LOWER)
        best = chosen.get(key)
        if best is None or (d is not None, d or 0) > (best[0] is not None, best[0] or 0):
            chosen[key] = (d, t)
    norm = lambda docs: ordered((d, (t or "").translate(brute.LOWER)) for d, t in docs)
    assert norm(exact[1]) == norm(chosen.values())
    # Of near groups one stays, the smallest id.
    groups = brute.near_groups(near[0])
    assert len(near[1]) == len({g[2] if g[2] is not None else g[1] for g in groups})
    assert all(any(d == g[2] for g in groups) for d, _ in near[1] if d is not None)
    marked = brute.contamination(clean[0], items)
    assert ordered(clean[1]) == ordered(doc for doc, m in zip(clean[0], marked) if not m[5])
    assert len(tokens[1]) == len(tokens[0])
    assert {r.decoded_sha256 for r in tokens[1]} == {brute.sha((t or "").encode()) for _, t in tokens[0]}


def test_pipeline_runs(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


@pytest.mark.parametrize("name, modulus, remainder", [("op1_lm_scoring", 7, 2), ("op6_language", 3, 1), ("op10_quality", 5, 0)])
def test_held_out(spark, awkward, name, modulus, remainder):
    folder, docs, _ = awkward
    expected = [(d, d is not None and zlib.crc32(str(d).encode()) % modulus == remainder) for d, _ in docs]
    same(rows(spark, name, folder, "doc_id", "held_out"), expected)


def test_held_out_labels_reach_no_score(spark, tmp_path):
    """Quality labels and languages of held-out documents are turned around; every score stays."""
    docs = pq.read_table(f"{SF}/documents.parquet")
    labels = pq.read_table(f"{SF}/labels.parquet")
    out = lambda ids, m, r: np.array([zlib.crc32(str(i).encode()) % m == r for i in ids.to_pylist()])
    lang = np.where(out(docs["doc_id"], 3, 1), "xx", np.array(docs["lang"].to_pylist(), object))
    quality = labels["quality"].to_numpy()
    quality = np.where(out(labels["doc_id"], 5, 0), 1 - quality, quality)
    pq.write_table(docs.set_column(docs.column_names.index("lang"), "lang", pa.array(lang, pa.string())), tmp_path / "documents.parquet")
    turned = pa.array(quality, labels.schema.field("quality").type)
    pq.write_table(labels.set_column(labels.column_names.index("quality"), "quality", turned), tmp_path / "labels.parquet")
    for name in ("op6_language", "op10_quality"):
        assert rows(spark, name, str(tmp_path)) == rows(spark, name, SF)
