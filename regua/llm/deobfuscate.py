"""Personal data found through disguises, at its place in the original text.

Plain identifiers (e-mail addresses, IPv4 addresses, card and phone numbers) are
found in the text itself. Then transducers rewrite it, each keeping for every
character that it puts out where in the original it comes from:

1. look-alike characters become the ASCII ones that they stand for, invisible ones go;
2. spelled digits become digits, next to each other or with dots between them;
3. spelled or bracketed "at" and "dot" become ``@`` and ``.``.

The same identifiers are looked for in what comes out, and their spans mapped back.
A span is added if something in it was rewritten and no plain span of its kind
holds it already. A bare "at" counts only before a spelled-out dot, since it is a
common word; unchanged texts are not searched twice. All patterns take time in
proportion to the text, whatever it holds.

Offsets are code points, ends exclusive. Look-alikes in Unicode's compatibility forms
(fullwidth, mathematical letters, other digits) come from its tables; letters of
other alphabets from ``LETTERS``.

Defined results: a null or empty text holds nothing; long texts are read whole; repeated
rows are each answered; an empty table gives no rows; a row without an id keeps its null;
columns named as the new ones are refused, others are ignored or kept.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from regua.llm.common import append, texts_of

KINDS = ("email", "ip", "card", "phone")

# --- plain identifiers ------------------------------------------------------------

#: What follows the name of an address. The name is everything before it that may be in one.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
#: An address begins at the start of a run of digits; runs that begin none are taken whole, so no other start is tried.
IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for match in DOMAIN.finditer(text):
        at = match.start()
        # An earlier sign cannot be part of the name, nor what an earlier address took.
        start = len(text[free:at].rstrip(NAME)) + free
        free = at + 1
        if start < at:
            free = match.end()
            yield start, free


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for match in IP.finditer(text):
        if match[2] is None:
            continue
        parts = [p.lstrip("0") for p in match.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield match.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in PHONE.finditer(text):
        if 9 <= len(DIGITS.findall(match.group())) <= 15:
            yield match.span()


FINDERS: tuple[Callable[[str], Iterator[tuple[int, int]]], ...] = (_emails, _ips, _cards, _phones)


def plain_spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    return sorted(Span(a, kind, b) for kind, find in enumerate(FINDERS) for a, b in find(text))


# --- transducers ------------------------------------------------------------------

#: Letters of other alphabets that look like ASCII ones (fixed values).
LETTERS = dict(
    zip(
        "АВЕКМНОРСТУХЅІЈаеорсухѕіјһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρι",
        "ABEKMHOPCTYXSIJaeopcyxsijhdqwABEZHIKMNOPTYXaovpi",
    )
)
#: Other signs (fixed values): dashes, dots, and what is not seen at all.
SIGNS = (
    dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2015\u2212\u2043", "-")
    | dict.fromkeys("\u3002\u2024\u2219\u2027", ".")
    | dict.fromkeys("\u00ad\u200b\u200c\u200d\u2060\ufeff", "")
)


def _look_alikes() -> dict[str, str]:
    found = {}
    for code in [*range(0xA0, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)]:
        char = chr(code)
        digit = unicodedata.decimal(char, None)
        plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", char)
        if len(plain) == 1 and " " <= plain <= "~":
            found[char] = plain
    return found | LETTERS | SIGNS


LOOK_ALIKES = _look_alikes()
_LOOKS = re.compile("[" + "".join(map(re.escape, sorted(LOOK_ALIKES))) + "]")

#: Digits by name in the languages of the texts (fixed values).
NAMES = (
    "zero oh cero zéro null", "one uno un eins", "two dos deux zwei", "three tres trois drei", "four cuatro quatre vier",
    "five cinco cinq fünf", "six seis sechs", "seven siete sept sieben", "eight ocho huit acht", "nine nueve neuf neun",
)
SPELLED = {name: str(digit) for digit, names in enumerate(NAMES) for name in names.split()}
_NAMED = "|".join(sorted(SPELLED, key=len, reverse=True))
AT, CLEAR_AT, DOT = "at|arroba|arobase", "arroba|arobase", "dot|punto|point|punkt"
_DIGIT = rf"(?:(?:double |triple )?(?:{_NAMED})|[0-9])"
_BETWEEN = rf"(?:[ -]{{1,2}}| (?:{DOT}) )"
_SEQUENCE = re.compile(
    rf"(?<![^\W_])(?P<plus>plus {{1,2}})?(?P<digits>{_DIGIT}(?:{_BETWEEN}{_DIGIT})+)(?![^\W_])", re.IGNORECASE
)
_TOKEN = re.compile(rf"(?:(double|triple) )?({_NAMED})|[0-9]| (?:{DOT}) |[ -]+", re.IGNORECASE)
_PLACES = re.compile(
    rf" {{0,2}}(?:\[ {{0,2}}(?:{AT}|@) {{0,2}}\]|\( {{0,2}}(?:{AT}|@) {{0,2}}\)|\{{ {{0,2}}(?:{AT}|@) {{0,2}}\}}|< {{0,2}}(?:{AT}|@) {{0,2}}>) {{0,2}}"
    rf"|(?P<dot> {{0,2}}(?:\[ {{0,2}}(?:{DOT}|\.) {{0,2}}\]|\( {{0,2}}(?:{DOT}|\.) {{0,2}}\)|\{{ {{0,2}}(?:{DOT}|\.) {{0,2}}\}}|< {{0,2}}(?:{DOT}|\.) {{0,2}}>) {{0,2}}"
    rf"|(?<=[A-Za-z0-9]) (?:{DOT}) (?=[A-Za-z0-9]))"
    rf"|(?<=[A-Za-z0-9._%+-]) (?:{AT}) (?=[A-Za-z0-9-]{{1,63}} ?[\[({{<]? {{0,2}}(?:{DOT})[ \])}}>])"
    rf"|(?<=[A-Za-z0-9._%+-]) (?:{CLEAR_AT}|@) (?=[A-Za-z0-9-]{{1,63}}\.[A-Za-z])",
    re.IGNORECASE,
)

#: What a text must hold for a transducer to change it; a wider net than their patterns.
TRIGGER = (
    "["
    + "".join(sorted(LOOK_ALIKES))
    + "]|(?i:"
    + "|".join(
        (
            rf"(?:^|[^a-z0-9])(?:{_NAMED})(?:[ -]{{1,2}}(?:double |triple )?(?:{_NAMED}|[0-9])| (?:{DOT}) )",
            rf"[0-9][ -]{{1,2}}(?:double |triple )?(?:{_NAMED})",
            rf"[\[({{<] {{0,2}}(?:{AT}|{DOT}|@|\.) {{0,2}}[\])}}>]|[a-z0-9] (?:{DOT}) [a-z0-9]",
            rf"[a-z0-9._%+-] (?:{CLEAR_AT}|@) [a-z0-9-]",
            rf"[a-z0-9._%+-] at [a-z0-9-]{{1,63}} ?[\[({{<]? {{0,2}}(?:{DOT})[ \])}}>]",
        )
    )
    + ")"
)


class Text(NamedTuple):
    """A rewritten text: for each character where its source begins and ends, and whether it was rewritten."""

    text: str
    begin: np.ndarray
    end: np.ndarray
    new: np.ndarray


def unchanged(text: str) -> Text:
    at = np.arange(len(text) + 1)
    return Text(text, at[:-1], at[1:], np.zeros(len(text), bool))


def rewrite(source: Text, edits: list[tuple[int, int, str]]) -> Text:
    """``source`` with each (start, end, replacement) made; edits ascend and do not overlap."""
    if not edits:
        return source
    parts, begins, ends, news = [], [], [], []
    done, marked = 0, False

    def keep(start: int, stop: int) -> None:
        nonlocal marked
        if stop > start:
            parts.append(source.text[start:stop])
            begins.append(source.begin[start:stop])
            ends.append(source.end[start:stop])
            new = source.new[start:stop]
            if marked:
                # What stood before was taken away.
                new = new.copy()
                new[0] = True
                marked = False
            news.append(new)

    for start, stop, text in edits:
        keep(done, start)
        if text:
            parts.append(text)
            begins.append(np.full(len(text), source.begin[start]))
            ends.append(np.full(len(text), source.end[stop - 1]))
            news.append(np.ones(len(text), bool))
        marked = not text
        done = stop
    keep(done, len(source.text))
    join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
    return Text("".join(parts), join(begins, np.int64), join(ends, np.int64), join(news, bool))


def _look_alike_edits(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), LOOK_ALIKES[m.group()]) for m in _LOOKS.finditer(text)]


def _digit_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for sequence in _SEQUENCE.finditer(text):
        tokens = list(_TOKEN.finditer(text, sequence.start("digits"), sequence.end()))
        if not any(t[2] for t in tokens):
            continue
        if sequence["plus"]:
            edits.append((sequence.start(), sequence.start("digits"), "+"))
        for before, token, behind in zip([None, *tokens], tokens, [*tokens[1:], None]):
            if token[2]:
                times = {None: 1, "double": 2, "triple": 3}[token[1] and token[1].lower()]
                edits.append((token.start(), token.end(), SPELLED[token[2].lower()] * times))
            elif token.group().strip(" -") == "" and before and behind and (before[2] or behind[2]):
                edits.append((token.start(), token.end(), ""))
    return edits


def _place_edits(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "." if m["dot"] else "@") for m in _PLACES.finditer(text)]


def normalised(text: str) -> Text:
    """A text behind all transducers."""
    now = unchanged(text)
    for edits in (_look_alike_edits, _digit_edits, _place_edits):
        now = rewrite(now, edits(now.text))
    return now


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """Spans of ``text`` that only the rewritten text shows."""
    now = normalised(text)
    found = []
    for start, kind, end in plain_spans(now.text):
        if not now.new[start:end].any():
            continue
        span = Span(int(now.begin[start]), kind, int(now.end[end - 1]))
        if not any(p.kind == kind and p.start <= span.start and span.end <= p.end for p in plain):
            found.append(span)
    return sorted(set(found))


# --- documents ----------------------------------------------------------------------

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("disguised", T.BooleanType()),
        ]
    )
)
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())])
)


def found_in(texts: pa.Array) -> list[tuple[list[Span], list[Span]]]:
    """Plain and disguised spans of each text."""
    texts = texts_of(texts)
    suspect = pc.match_substring_regex(texts, TRIGGER).to_pylist()
    out = []
    for text, look in zip(texts.to_pylist(), suspect):
        plain = plain_spans(text)
        out.append((plain, disguised_spans(text, plain) if look else []))
    return out


def find_personal_data(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with a list of (kind, start, end, disguised) by start, then kind."""

    def compute(column: pa.Array) -> list[pa.Array]:
        rows = []
        for plain, more in found_in(column):
            spans = sorted([(s, False) for s in plain] + [(s, True) for s in more])
            rows.append(
                [{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "disguised": d} for s, d in spans]
            )
        return [pa.array(rows, _ARROW_SPANS)]

    return append(docs, text, [T.StructField(name, SPANS)], compute)


def mask_personal_data(docs: DataFrame, text: str = "text", name: str = "masked") -> DataFrame:
    """``docs`` with its text where each stretch of spans is replaced by the kind of the first, as in ``[email]``."""

    def masked(body: str, spans: list[Span]) -> str:
        parts, done = [], 0
        for start, kind, end in sorted(spans):
            if start >= done:
                parts += [body[done:start], f"[{KINDS[kind]}]"]
            done = max(done, end)
        return "".join([*parts, body[done:]])

    def compute(column: pa.Array) -> list[pa.Array]:
        bodies = zip(column.to_pylist(), found_in(column))
        return [pa.array([None if b is None else masked(b, [*p, *m]) for b, (p, m) in bodies], pa.string())]

    return append(docs, text, [T.StructField(name, T.StringType())], compute)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, plain spans by kind (n_email, n_ip, n_card, n_phone), base_sha256, all spans, n_disguised."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = find_personal_data(docs, "text", "found")
    plain = F.filter("found", lambda s: ~s["disguised"])
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of_kind = lambda k: F.size(F.filter("found", lambda s: ~s["disguised"] & (s["kind"] == k)))
    return found.select(
        "doc_id",
        *(of_kind(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(F.transform(plain, shown), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("found", shown), ",").alias("spans"),
        F.size(F.filter("found", lambda s: s["disguised"])).cast("long").alias("n_disguised"),
    )
