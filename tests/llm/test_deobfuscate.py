"""Personal data: plain spans against plain patterns, disguises against the places they stand at."""

import random
import re
import time

import pyarrow as pa
import pyarrow.compute as pc
import pytest

import brute
from regua.llm import deobfuscate as d
from regua.llm.common import read
from regua.llm.queries import QUERIES

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def expected(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            keep = (
                True,
                all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else False,
                12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else False,
                9 <= len(digits) <= 15,
            )[kind]
            if keep:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_plain_spans_are_those_of_the_patterns():
    rng = random.Random(8)
    pieces = "a b.c @ @x.y . - + +1 555 1.2.3.4 256 255 0007 4111111111111111 4111-1111 ( ) é 日 _ % \n x@y.z q@ @@ 12 9".split(" ")
    for _ in range(4000):
        text = "".join(rng.choice(pieces) + rng.choice(["", "", " ", "-", "."]) for _ in range(rng.randrange(1, 25)))
        assert [tuple(s) for s in d.plain_spans(text)] == expected(text), text


CASES = {
    "mail [john.doe [at] example [dot] com] now": [("email", "john.doe [at] example [dot] com")],
    "to bob dot smith at mail dot example dot org ok": [("email", "bob dot smith at mail dot example dot org")],
    "a(AT)b(Dot)de, {c{at}d.ee": [("email", "a(AT)b(Dot)de"), ("email", "c{at}d.ee")],
    "escribe a ana arroba correo punto es hoy": [("email", "ana arroba correo punto es")],
    "j\u043ehn@ex\u0430mple.com": [("email", "j\u043ehn@ex\u0430mple.com")],
    "jo\u200bhn@example.com": [("email", "jo\u200bhn@example.com")],
    "\uff4a\uff4f\uff45\uff20\uff58.org": [("email", "\uff4a\uff4f\uff45\uff20\uff58.org")],
    "plus one five five five one two three four five six seven yes": [("phone", "plus one five five five one two three four five six seven")],
    "+4 four double seven 1234567 x": [("phone", "+4 four double seven 1234567")],
    "+49 drei null acht neun zwei eins vier sechs": [("phone", "+49 drei null acht neun zwei eins vier sechs")],
    "ip one nine two dot one six eight dot zero dot one.": [("ip", "one nine two dot one six eight dot zero dot one")],
    "10 [dot] 0 [dot] 0 (dot) 7": [("ip", "10 [dot] 0 [dot] 0 (dot) 7")],
    "\u0661\u0660.\u0660.\u0660.\u0661 x": [("ip", "\u0661\u0660.\u0660.\u0660.\u0661")],
    "\uff14\uff11\uff11\uff11 1111 1111 1111": [("card", "\uff14\uff11\uff11\uff11 1111 1111 1111")],
    "four one one one 1111 1111 1111": [("card", "four one one one 1111 1111 1111")],
    "four " + "one " * 15: [("card", "four" + " one" * 15)],
    # Prose and plain identifiers are left alone.
    "look at noon dot": [],
    "meet me at example.com": [],
    "one two three four": [],
    "un deux point trois": [],
    "a@b.com and 1.2.3.4 and +1 (017) 555-7713 and 4111111111111111": [],
    "": [],
}


@pytest.mark.parametrize("text", CASES)
def test_disguises(text):
    plain = d.plain_spans(text)
    found = [(d.KINDS[s.kind], text[s.start : s.end]) for s in d.disguised_spans(text, plain)]
    assert found == CASES[text]


@pytest.mark.parametrize("text", [t for t in CASES if CASES[t]])
def test_the_net_is_wider_than_the_patterns(text):
    for body in (text, text.upper(), "x " + text + " y"):
        if d.normalised(body).new.any():
            assert pc.match_substring_regex(pa.array([body]), d.TRIGGER)[0].as_py()


def test_random_texts_pass_the_net_or_stay_as_they_are():
    rng = random.Random(2)
    pieces = "one two un dot at double five - 5 7 [ ] ( ) . @ plus x é punto arroba oh \u043e \u200b".split(" ")
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randrange(1, 14)))
        now = d.normalised(text)
        assert now.text == text or pc.match_substring_regex(pa.array([text]), d.TRIGGER)[0].as_py(), text
        # Every character says where it is from, in order.
        assert (now.begin < now.end).all() and (now.begin[1:] >= now.begin[:-1]).all()
        for c, a, b, new in zip(now.text, now.begin, now.end, now.new):
            assert new or text[a:b] == c


def test_time_grows_with_the_text():
    for piece in ("a", "1", "1.", "a@", "@a.", "+1 ", "one ", "(", "one dot ", " at x", "4-", "\u043e", "+(", "oh-"):
        took = []
        for n in (20_000, 160_000):
            text = piece * (n // len(piece))
            start = time.process_time()
            d.found_in(pa.array([text]))
            took.append(time.process_time() - start)
        assert took[1] < 24 * max(took[0], 0.01), (piece, took)


def test_query(spark, awkward):
    folder, docs, _ = awkward
    rows = QUERIES["op13_personal_data"](spark, folder).collect()
    found = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows), key=repr)
    theirs = []
    for doc_id, text in docs:
        spans = expected(text or "")
        shown = ",".join(f"{d.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        theirs.append((doc_id, *(sum(k == kind for _, k, _ in spans) for kind in range(4)), brute.sha(shown.encode())))
    assert found == sorted(theirs, key=repr)


def test_lists_and_masks(spark):
    texts = [t for t in CASES if t] + [None, "", "write to a@b.com, or a (at) b.com"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in d.personal_data(df).collect()}
    for i, text in enumerate(texts):
        plain = d.plain_spans(text or "")
        assert found[i].spans == d.listed([*plain, *d.disguised_spans(text or "", plain)])
        assert found[i].n_disguised == found[i].spans.count(":") // 2 - len(plain)
    masked = {r.doc_id: r.masked for r in d.mask_personal_data(df).collect()}
    assert masked[len(texts) - 3] is None and masked[len(texts) - 2] == ""
    assert masked[len(texts) - 1] == "write to [email], or [email]"
    with pytest.raises(ValueError):
        d.find_personal_data(df.withColumn("spans", df.doc_id))


def test_whole_table(spark):
    df = QUERIES["op13_personal_data"](spark, "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text or "" for r in read(spark, "/root/testdata/sf0.01", "documents").collect()}
    for row in df.collect():
        spans = expected(texts[row.doc_id])
        assert row.base_sha256 == brute.sha(",".join(f"{d.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode())
