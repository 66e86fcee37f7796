"""Parts of the operators by themselves."""

import functools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import brute
from regua.llm import (
    bloom_lm,
    byte_bpe,
    covering_simhash,
    ga2m_quality,
    language_birnn,
    repeats,
    suffix_dedup,
    superkmer_dedup,
    token_dp,
)
from regua.llm.components import connected_components
from regua.llm.slices import pack, slices

ALPHABET = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'", "re", "é", "1", "23", "!", "...", "\xa0", "　", "\x1c", "\x85", "日本", " a", "<|endoftext|>", "<|end"]


LETTERS = ["ab", "abc", "etaoin", "=-", "aà", "0123", "\n ", "日本語テスト", "abcdefghijklmnopqrstuvwxyz"]


def scraps(n, size=30, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_covering_masks_miss_no_pair():
    for radius in (1, 2):
        masks = covering_simhash.covering_masks(radius)
        flips = [1 << i for i in range(64)]
        if radius == 2:
            flips += [a | b for a in flips for b in flips if a < b]
        assert len(masks) == (1 << (radius + 1)) - 1
        assert all(any(f & m == 0 for m in masks) for f in flips)


def test_links_of_a_large_group(spark):
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(120):
        value = rng.choice(sorted(prints))
        for _ in range(rng.randrange(1, 4)):
            value ^= 1 << rng.randrange(64)
        prints.add(value)
    prints |= {rng.getrandbits(64) for _ in range(60)}
    prints = sorted(prints)
    signed = [(covering_simhash._signed(p),) for p in prints]
    found = covering_simhash.links(spark.createDataFrame(signed, "fp long")).collect()
    links = spark.createDataFrame(found, "u long, v long")
    of = {r.node: r.root for r in connected_components(links).collect()}
    group = {p: p for p in prints}

    def root(p):
        while group[p] != p:
            p = group[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 2:
                group[root(a)] = root(b)
    for a, (s,) in zip(prints, signed):
        for b, (t,) in zip(prints, signed):
            assert (root(a) == root(b)) == (of.get(s, s) == of.get(t, t))


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 5000)]
    random.Random(0).shuffle(links)
    of = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {of[i] for i in range(61)} == {0}
    assert {of[i] for i in range(1000, 1200)} == {1000}
    assert 5000 not in of


def test_factors():
    rng = random.Random(3)
    for _ in range(150):
        b = bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(40)))
        expected = [
            max((next((k for k in range(len(b) - i) if b[i + k] != b[j + k]), len(b) - i) for j in range(i)), default=0)
            for i in range(len(b))
        ]
        assert suffix_dedup.longest_previous_factors(b).tolist() == expected


def test_suffix_order_to_a_depth():
    rng = random.Random(4)
    for depth in (1, 7, 13, 400):
        b = bytes(rng.choice(b"ab") for _ in range(900)) * 2
        order, rank = suffix_dedup.suffix_order(b, depth)
        cut = [b[i : i + depth] for i in range(len(b))]
        assert order.tolist() == sorted(range(len(b)), key=lambda i: (cut[i], i))
        assert len(set(rank.tolist())) == len(set(cut))


def test_sliding_min():
    rng = np.random.default_rng(0)
    for n in (1, 5, 64, 200):
        values = rng.integers(0, 50, n).astype(np.uint64)
        for width in (1, 3, 64):
            expected = [values[i : i + width].min() for i in range(n - width + 1)]
            assert repeats.sliding_min(values, width).tolist() == expected


@pytest.mark.parametrize("split", [0, 3000])
def test_minimisers_that_are_split(spark, awkward, split):
    folder, docs, _ = awkward
    table = spark.read.parquet(f"{folder}/documents.parquet")
    key = lambda r: repr(tuple(r))
    found = superkmer_dedup.remove_passages(table, split_bytes=split).collect()
    assert sorted(map(key, found)) == sorted(map(repr, brute.earlier_passages(docs)))
    found = suffix_dedup.remove_repeats(table, split_bytes=split).collect()
    assert sorted(map(key, found)) == sorted(map(repr, brute.repeated_bytes(docs)))


@pytest.mark.parametrize("module, run", [(suffix_dedup, "remove_repeats"), (superkmer_dedup, "remove_passages")])
def test_moved_rows_follow_the_input(spark, monkeypatch, module, run):
    # Slices and buckets of few bytes, so that both are many.
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 1 << 14)
    monkeypatch.setattr(repeats, "CODE_BUCKET", 1 << 16)
    monkeypatch.setattr(module, "slices", functools.partial(slices, limit=1 << 16))
    moved, store = {}, repeats.store

    def counted(df, name):
        out = store(df, name)
        moved.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(repeats, "store", counted)
    rng = random.Random(8)
    for n in (64, 256):
        texts = [" ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(1600)) for _ in range(n)]
        # Half of each odd document stands in the one before it.
        docs = [(i, texts[i - i % 2][:4000] + texts[i][4000:]) for i in range(n)]
        table = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
        assert getattr(module, run)(table).where("n_removed > 0").count() >= n // 2
    assert set(moved) == {"minimisers", "runs", "replies"}
    for name, (few, many) in moved.items():
        assert many <= 5 * few, (name, few, many)


def test_equal_runs_split_no_minimiser():
    def verdicts(prints):
        rows = {"slice": list(range(len(prints))), "key": [7 << repeats.PRINT_BITS | p for p in prints]}
        rows |= {"often": pa.array([1] * len(prints), pa.int32()), "size": [600] * len(prints)}
        return set(repeats._repeated(pa.table(rows), False, 1000).column("verdict").to_pylist())

    assert verdicts([5]) == set()
    assert verdicts([5] * 10) == {1}
    assert verdicts([5, 5, 6]) == {2}
    assert verdicts([5] * 1 + [5] * (repeats.COPIES * 1000 // 600)) == {2}


def test_first_copies_can_stay(spark):
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdef ") for _ in range(500))
    docs = [(2, "x" + passage + "y"), (1, passage), (3, passage + "-" + passage), (4, "short")]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), keep_first=True, with_text=True)
    left = {r.doc_id: bytes(r.kept).decode() for r in found.collect()}
    assert left == {1: passage, 2: "xy", 3: "-", 4: "short"}


def test_kept_words(spark):
    same = " ".join(f"w{i}" for i in range(60))
    docs = [(1, same), (2, f"before {same}  after"), (3, None)]
    found = superkmer_dedup.remove_passages(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True)
    assert {r.doc_id: r.kept for r in found.collect()} == {1: same, 2: "before after", 3: ""}


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as file:
        return byte_bpe.Codec(file.read())


def test_encoding_round_trip(codec):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    texts = scraps(600) + ["", "a" * 3000, "=" * 5001, "ab" * 1500, " " * 900 + "x", "xyz" * 200]
    packed = codec.encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in packed] == [known.encode_ordinary(t) for t in texts]
    assert codec.decode(packed) == [t.encode() for t in texts]


def test_long_words_in_windows(codec):
    """Windows that meet nowhere, runs, few letters, many bytes a letter: always the ids of the library."""
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    rng = random.Random(8)
    words = ["".join(rng.choices(letters, k=rng.randrange(81, 700))) for letters in LETTERS for _ in range(8)]
    words += ["a" * 20_003, "the" * 5_001, "".join(rng.choice("ab") * rng.randrange(1, 300) for _ in range(40))]
    words += ["x" * n for n in (byte_bpe.WINDOW - 1, byte_bpe.WINDOW, byte_bpe.WINDOW + 1, byte_bpe.OVERLAP)]
    for word in words:
        ids = np.frombuffer(codec._of_windows(word.encode()), "<u4").tolist()
        assert ids == known._core_bpe.encode_single_piece(word.encode()), word[:80]


def test_time_follows_the_length_of_a_word(codec):
    rng, work = random.Random(9), []
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for size in (50_000, 200_000):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size))
        sent, real = [], codec._contract
        codec._contract = lambda words, query: sent.append(sum(map(len, words))) or real(words, query)  # noqa: B023
        try:
            (found,) = codec.encode([word])
        finally:
            del codec._contract
        assert np.frombuffer(found, "<u4").tolist() == known.encode_ordinary(word)
        assert max(sent) <= byte_bpe.WORD_BYTES + byte_bpe.WINDOW
        work.append(sum(sent) / size)
    # Bytes contracted for each byte of the word.
    assert max(work) < 2 and work[1] < 1.1 * work[0]


def test_ids_of_nothing_and_taken_names(spark):
    tokens = spark.createDataFrame([(1, [None, 10_000_000, -4]), (2, []), (3, None)], "doc_id long, ids array<int>")
    back = {r.doc_id: r.text for r in byte_bpe.decoded(tokens).collect()}
    assert back == {1: "\ufffd" * 3, 2: "", 3: None}
    with pytest.raises(ValueError):
        byte_bpe.decoded(tokens, name="DOC_ID")


def test_ids_decode_to_text(spark):
    docs = spark.createDataFrame([(1, "naïve  text\n"), (2, None), (3, "🙂")], "doc_id long, text string")
    back = byte_bpe.decoded(byte_bpe.encoded(docs)).collect()
    assert {r.doc_id: r.text for r in back} == {1: "naïve  text\n", 2: "", 3: "🙂"}


def test_counts_of_all_prefixes():
    library = Tokenizer.from_file(public_tokenizers.path(token_dp.FILE))
    with open(public_tokenizers.path(token_dp.FILE), "rb") as file:
        own = token_dp.Counter(file.read())
    for text in scraps(120):
        cut = [text[:n] for n in range(len(text) + 1)]
        expected = [len(e.ids) for e in library.encode_batch(cut, add_special_tokens=False)]
        assert own.prefixes(text) == expected
        for budget in (0, 2, 5):
            fit = own.fitting(text, budget)
            assert len(fit) == max(n for n, c in enumerate(expected) if c <= budget)


def test_truncation_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "one two three four", "x"), (2, None, "y")], "doc_id long, text string, fitting string")
    found = token_dp.truncated(docs, 2).collect()
    assert {r.doc_id: (r.text, r.fitting) for r in found} == {1: ("one two", "x"), 2: (None, "y")}


def filtered(keys, counts, segments=3):
    """What a filter of these counts answers for each of the keys."""
    key, n = bloom_lm.summed(keys, counts)
    key, level = key[n > 0], 1 + bloom_lm.levels(n[n > 0])
    place = bloom_lm.segment_of(key, segments)
    parts = {b: bloom_lm.segment(key[place == b], level[place == b], bloom_lm.BITS_PER_ENTRY) for b in range(segments)}
    return bloom_lm.Filter(parts, segments).level(keys)


def test_filter_is_never_too_low():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << bloom_lm.KEY_BITS, 4000, dtype=np.uint64))
    level = rng.integers(1, 12, len(keys))
    n = 3
    place = bloom_lm.segment_of(keys, n)
    assert (np.diff(place) >= 0).all() and set(place) == {0, 1, 2}
    parts = {b: bloom_lm.segment(keys[place == b], level[place == b], 10) for b in range(n)}
    held = bloom_lm.Filter(parts, n)
    found = held.level(keys)
    assert (found >= level).all() and (found == level).mean() > 0.95
    others = rng.integers(0, 1 << bloom_lm.KEY_BITS, 20_000, dtype=np.uint64)
    assert (held.level(others) > 0).mean() < 0.03
    # A part of the segments answers for its own keys as the whole does.
    part = bloom_lm.Filter(parts, n, 1, 2)
    assert (part.level(keys[place == 1]) == found[place == 1]).all()


def test_filter_keeps_its_bits_at_every_size():
    rng = np.random.default_rng(4)
    for n in (50, 5_000, 500_000):
        keys = np.unique(rng.integers(0, 1 << bloom_lm.KEY_BITS, 2 * n, dtype=np.uint64))
        rng.shuffle(keys)
        counts = rng.integers(2, 40, len(keys))
        counts[: len(keys) // 2] = 0
        # Each key comes from two slices.
        found = filtered(np.concatenate((keys, keys)), np.concatenate((counts, 0 * counts)))
        assert (found[: len(keys)] == found[len(keys) :]).all()
        found, never = found[: len(keys)], counts == 0
        assert (found[~never] >= bloom_lm.levels(counts[~never])).all()
        assert (found[never] > 0).mean() < (0.2 if n == 50 else 0.02) and found[never].max() < 6


def test_passes_stay_within_their_bytes():
    sizes = [3, 3, 3, 9, 0, 0, 12, 1]
    assert bloom_lm.passes(sizes, 9) == [(0, 3), (3, 6), (6, 7), (7, 8)]
    assert bloom_lm.passes(sizes, 1000) == [(0, 8)]
    assert bloom_lm.passes([0], 9) == [(0, 1)]


def test_once_seen_grams_are_held():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << bloom_lm.KEY_BITS, 3000, dtype=np.uint64))
    for count in (1, 2, 3):
        found = bloom_lm.count_of(filtered(keys, np.full(len(keys), count)))
        assert (found >= count).all() and (found == count).mean() > 0.95
    counts = np.arange(1, 5000)
    stands = bloom_lm.count_of(1 + bloom_lm.levels(counts))
    assert (stands < counts * bloom_lm.BASE).all() and (stands > counts / bloom_lm.BASE).all()


@pytest.mark.parametrize("order", [2, 3])
def test_scores_are_those_of_exact_counts(order):
    texts = ["the cat sat on the mat", "a dog sat", "the cat", "", "the dog sat on a cat and the cat ran"]
    table = pa.table({"doc_id": pa.array([None] * len(texts), pa.int64()), "text": texts})
    own = bloom_lm.Tokens(pack(table))
    grams = bloom_lm.Grams(own, order)
    level = filtered(grams.keys, grams.counts)
    lines = [text.split() + [""] for text in texts]
    seen = brute.exact_grams(lines, order)
    n, v = sum(map(len, lines)), len({w for line in lines for w in line})
    counts = np.array([seen[(name,)] for name in own.names.to_pylist()])
    found = bloom_lm.score_slice(own, counts, n, v, level[grams.names], [level[t] for t in grams.tokens])["score"]
    for line, score in zip(lines, found, strict=True):
        # Counts above 3 are quantised, and a few answers may be too high.
        assert score == pytest.approx(brute.exact_score(line, seen, n, v, order), abs=0.02)


def test_search_for_levels_ends_in_a_full_filter():
    held = bloom_lm.Filter({0: b"\xff" * 8}, 1)
    assert (held.level(np.arange(100, dtype=np.uint64)) == bloom_lm.TOP).all()


def test_levels_stand_for_their_counts():
    counts = np.arange(1, 5000)
    level = bloom_lm.levels(counts)
    assert (bloom_lm.BASE**level <= counts + 1e-6).all() and (counts < bloom_lm.BASE ** (level + 1) + 1e-6).all()


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = language_birnn.Network.fresh(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data, target = rng.integers(97, 101, (7, 5)), rng.integers(3, size=5)

    def loss():
        p = net.probabilities(data)
        return -np.log(p[:, target, np.arange(5)]).mean()

    own = net.gradients(data, target)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(s) for s in value.shape)
            if name[0] == "x":
                at = (at[0], int(data.flat[rng.integers(data.size)]))
            old = value[at]
            value[at] = old + 1e-3
            up = loss()
            value[at] = old - 1e-3
            down = loss()
            value[at] = old
            assert own[name][at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-4)


def test_pooling_is_the_mean_over_bytes():
    net = language_birnn.Network.fresh(["a", "b"])
    text = "abc def " * 31
    labels = language_birnn.label_bytes(net, text)
    assert len(labels) == len(text.encode())
    data = text.encode()
    whole = []
    for at in range(0, len(data), language_birnn.WINDOW):
        part = np.frombuffer(data[at : at + language_birnn.WINDOW], np.uint8)[:, None]
        whole.append(net.probabilities(part)[:, :, 0])
    assert language_birnn._pooled(net, [data, b""])[0] == pytest.approx(np.concatenate(whole).mean(axis=0), abs=1e-5)


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(ga2m_quality.MEASURES)))
    y = ((x[:, 1] > 0.5) ^ (x[:, 4] > 0.5)).astype(float)
    model = ga2m_quality.fit(x, y)
    assert (1, 4) in [tuple(sorted(p)) for p in model.pairs]
    fresh = rng.random((1000, x.shape[1]))
    right = (model.scores(fresh) > 0.5) == ((fresh[:, 1] > 0.5) ^ (fresh[:, 4] > 0.5))
    assert right.mean() > 0.9


def test_additive_model_without_both_labels():
    assert ga2m_quality.fit(np.zeros((0, 3)), np.zeros(0)).scores(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert ga2m_quality.fit(np.zeros((4, 3)), np.ones(4)).scores(np.zeros((1, 3)))[0] > 0.99
