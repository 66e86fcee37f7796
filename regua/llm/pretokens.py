"""Splitting texts for byte-level BPE by the pattern of the public tokenizers, with little repeated work.

A space between two characters that are not white space always starts a new
match and no match runs across it, so a text can be cut there and the parts be
looked up: equal parts split equally wherever they stand. Only parts never seen
before go through the pattern. Parts beside other white space stay together.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import regex

#: The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_WHITE = frozenset(WHITE_SPACE)


def compiled(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    """The pattern with white space spelled out, so that libraries cannot differ on it."""
    inside = regex.escape(WHITE_SPACE, special_only=False, literal_spaces=False)
    pattern = pattern.replace(r"[^\s", "[^" + inside)
    pattern = pattern.replace(r"\S", f"[^{inside}]").replace(r"\s", f"[{inside}]")
    return regex.compile(pattern)


def _firm(part: str) -> bool:
    """Whether a part neither begins nor ends with white space."""
    return bool(part) and part[0] not in _WHITE and part[-1] not in _WHITE


def segments(parts: list[str]) -> Iterator[tuple[int, int, str]]:
    """The stretches (first part, behind the last, text) of ``text.split(" ")`` that must be matched as one.

    Texts begin with the space before them, but for the first.
    """
    start = 0
    for i in range(1, len(parts) + 1):
        if i == len(parts) or (
            parts[i - 1]
            and parts[i]
            and parts[i - 1][-1] not in _WHITE
            and parts[i][0] not in _WHITE
        ):
            yield start, i, ("" if start == 0 else " ") + " ".join(parts[start:i])
            start = i


class Split:
    """Values of texts as the sum or concatenation of values of their parts.

    ``value_of`` maps lists of strings (stretches of text) to their values. Values
    of parts are remembered, at most ``limit`` of them; the memory starts anew when full.
    """

    def __init__(self, value_of, limit: int = 400_000):
        self.value_of = value_of
        self.limit = limit
        self.known: dict[str, object] = {}

    def values(self, texts: list[str]) -> list[list]:
        """For each text the values of its stretches, in order."""
        known = self.known
        if len(known) > self.limit:
            known.clear()
        out, wanted, odd = [], {}, []
        for text in texts:
            if not text:
                out.append([])
                continue
            parts = text.split(" ")
            found = list(map(known.get, parts))
            found[0] = None
            out.append(found)
            if None in found:
                missing = [i for i, value in enumerate(found) if value is None]
                if all(_firm(parts[i]) for i in missing):
                    for i in missing[1:] if missing[0] == 0 else missing:
                        wanted[parts[i]] = None
                    odd.append((found, missing, parts))
                else:
                    odd.append((found, None, parts))
                    for _, _, stretch in segments(parts):
                        if _single(stretch):
                            if stretch[1:] not in known:
                                wanted[stretch[1:]] = None
        names = [" " + part for part in wanted]
        plain = len(names)
        for _, missing, parts in odd:
            if missing is None:
                names += [s for _, _, s in segments(parts) if not _single(s)]
            else:
                names.append(parts[0])
        made = self.value_of(names)
        known.update(zip(wanted, made))
        rest = iter(made[plain:])
        for found, missing, parts in odd:
            if missing is None:
                found[:] = [
                    known[s[1:]] if _single(s) else next(rest) for _, _, s in segments(parts)
                ]
            else:
                found[0] = next(rest)
                for i in missing:
                    if i:
                        found[i] = known[parts[i]]
        return out


def _single(stretch: str) -> bool:
    """Whether a stretch is a space and one firm part, so that its value is remembered."""
    return stretch[0] == " " and _firm(stretch[1:]) and " " not in stretch[1:]
