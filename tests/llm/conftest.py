"""A folder of small tables with every awkward case."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

VOCABULARY = "the of and to in a is that für más où être naïve data Model GRAPH zebra 42 7up don't x-ray ... !!".split()


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for _ in range(n))


def cases() -> tuple[list, list, list]:
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 160)) for _ in range(40)]
    passage = prose(rng, 130)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 25]))) for i in range(12)]
    items += [(3, items[3][1]), (None, prose(rng, 14)), (20, None), (21, ""), (22, "?? !!"), (None, None)]
    texts += [prose(rng, 30) + passage + prose(rng, 20) for _ in range(6)]
    texts += [texts[0], texts[0].upper(), texts[1], texts[1] + " tail"]
    texts += [prose(rng, 20) + " " + items[k][1] + " " + prose(rng, 5) for k in (0, 3, 5, 7)]
    texts += [items[2][1], items[13][1], None, None, "", " ", "\n\t", "a", "É", "é", "1234 5678", "<|endoftext|> x <|endoftext|>"]
    texts += ["be " * 400, "ab" * 900, "=" * 700, "a" * 1300, "word " * 20_000, "𝄞 music 日本語 テスト", "nul\x00byte\x1cx"]
    docs = list(enumerate(texts))
    # Repeated rows, two texts under one id, rows without an id.
    docs += [docs[4], docs[45], (7, texts[9]), (None, texts[11]), (None, texts[40]), (None, None), (None, "nobody else")]
    labels = [(d, k % 2, 0) for k, (d, _) in enumerate(docs[:40])]
    labels += [(None, 1, 1), (5, None, 0), (9999, 1, 0), (3, 0, 0), (3, 1, 0)]
    return docs, items, labels


def write(folder, docs, items, labels) -> str:
    langs = ["en", "de", None, "fr"]
    pq.write_table(
        pa.table(
            {
                "doc_id": pa.array([d for d, _ in docs], pa.int64()),
                "text": pa.array([t for _, t in docs], pa.string()),
                "lang": pa.array([langs[i % 4] for i in range(len(docs))], pa.string()),
                "source": pa.array([None if i % 5 == 0 else "s" for i in range(len(docs))], pa.string()),
                "n_chars": pa.array([None] * len(docs), pa.int64()),
                # Names that the operators use themselves.
                **{name: pa.array(["own"] * len(docs)) for name in CLASHING},
            }
        ),
        folder / "documents.parquet",
        row_group_size=16,
    )
    pq.write_table(
        pa.table(
            {
                "item_id": pa.array([i for i, _ in items], pa.int64()),
                "text": pa.array([t for _, t in items], pa.string()),
                "n": pa.array([None] * len(items), pa.string()),
                "gram": pa.array([None] * len(items), pa.string()),
            }
        ),
        folder / "benchmark.parquet",
    )
    kinds = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])
    columns = list(zip(*labels)) or [(), (), ()]
    pq.write_table(
        pa.table({f.name: pa.array(c, f.type) for f, c in zip(kinds, columns)}), folder / "labels.parquet"
    )
    vectors = awkward_vectors() if docs else []
    pq.write_table(
        pa.table(
            {
                "vec_id": pa.array([v for v, _ in vectors], pa.int64()),
                "embedding": pa.array([e for _, e in vectors], pa.list_(pa.float32())),
                **{name: pa.array(["own"] * len(vectors)) for name in ("x", "n", "part", "component", "label")},
            }
        ),
        folder / "embeddings.parquet",
        row_group_size=32,
    )
    return str(folder)


def awkward_vectors() -> list:
    rng = random.Random(11)
    vectors = [(i, [rng.gauss(0, 0.2) * (k + 1) for k in range(6)]) for i in range(90)]
    # One vector many times, one that is equal only as whole numbers, negative zeros.
    vectors += [(100 + i, vectors[3][1]) for i in range(60)]
    vectors += [(170, [c + 1e-6 * (256 * c % 1 < 0.9) for c in vectors[5][1]]), (171, [-0.0] * 6), (172, [0.0] * 6)]
    vectors += [(None, vectors[7][1]), (7, vectors[8][1]), (None, None), (180, None), (181, []), (182, [0.5] * 5)]
    vectors += [(183, [None, *[0.1] * 5]), (184, [float("nan"), *[0.1] * 5]), (185, [0.1] * 5 + [float("inf")])]
    return vectors


CLASHING = (
    "row score kept fp fingerprint row_number n_words quality_score text_digest r g n id stretch "
    "held_10 scanned slice payload held_out sha n_tokens ids weight eligible spans found rank line bucket gain"
).split()


@pytest.fixture(scope="session")
def awkward(tmp_path_factory):
    docs, items, labels = cases()
    return write(tmp_path_factory.mktemp("awkward"), docs, items, labels), docs, items


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return write(tmp_path_factory.mktemp("empty"), [], [], [])
