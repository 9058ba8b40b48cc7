"""Exact encoding under a tokenizer that drops white space, by memoised units.

Such a tokenizer never forms a token across white space, so the ids of a text are those of its
white-space-separated units in order. Each worker process remembers the units it has met (a bounded number);
a unit met for the first time is cut into words, and the library's model encodes each unknown word.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

from .common import tokenizer

MEMO = 200_000

# The word pattern of the tokenizer, and white space as its normaliser sees it.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
AT_WHITE = regex.compile(f"[{WHITE}]+")
#: Units of these characters alone are stable under the normaliser but for case, whatever the Unicode version.
PLAIN = regex.compile(r"[!-~¡-įı-ɏ]+")
#: Python's split() takes these for white space, the tokenizer doesn't.
SEPARATORS = regex.compile("[\x1c-\x1f]")


def units_of(text: str) -> list[str]:
    """The units of a text, as the tokenizer sees white space."""
    return [u for u in AT_WHITE.split(text) if u] if SEPARATORS.search(text) else text.split()


#: The signs that stand for bytes: printable ones for themselves, the others for code points from 256 on, in order.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTED)}


class Units(dict):
    """What units render to; one that is not held is taken from the older generation or made."""

    def __init__(self, make: Callable[[str], object], older: dict[str, object]):
        self.make, self.older = make, older

    def __missing__(self, unit: str) -> object:
        found = self.older.get(unit)
        if found is None:
            found = self.make(unit)
        self[unit] = found
        return found


class UnitEncoder:
    """What a text's units render to, remembered. render makes it of the ids of a word, combine of those of several words.

    Words are held as the units that they would be on their own. Two generations are kept, of about `memo` units each: what is still in use
    moves to the younger one."""

    def __init__(self, path: str, render: Callable[[list[int]], object], combine: Callable[[list], object], memo: int = MEMO):
        self.memo = memo
        self.tok, self.render, self.combine = tokenizer(path), render, combine
        self.cut = self.tok.model.tokenize
        self.units = Units(self.rendered, {})

    def encode(self, text: str) -> list[int]:
        """The ids by the library."""
        return self.tok.encode(text, add_special_tokens=False).ids

    def rendered(self, unit: str) -> object:
        """A unit's rendering, made of those of its words."""
        if not (unit.isascii() or PLAIN.fullmatch(unit)) or "<|" in unit:
            return self.render(self.encode(unit))
        low = unit.lower()
        if low.isalpha():
            return self.word(low) if low == unit else self.units[low]
        if low[-1] in ",.;:!?" and low[:-1].isalpha():
            return self.combine([self.units[low[:-1]], self.units[low[-1]]])
        words = WORD.findall(low)
        return self.word(low) if words == [low] else self.combine([self.units[w] for w in words])

    def word(self, word: str) -> object:
        """A word's rendering: the library's model applied to the signs that stand for its bytes."""
        signs = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
        return self.render([t.id for t in self.cut(signs)])

    def renew(self) -> None:
        """Begin a new generation if the younger one is full; to be called between batches."""
        if len(self.units) > self.memo:
            self.units.older = {}
            self.units = Units(self.rendered, self.units)
