"""Noisy-channel deobfuscation: character lattices decoded under a character language model.

A suspect stretch is a token with a look-alike (digit or sign) beside a letter, a
token with a letter three times in a row, or single letters set apart by spaces or
signs.  Its lattice offers for each look-alike the letters it may stand for or
a word break, for each repeated character its loss, and for each separator its
loss or a word break, every choice at a cost.  The Viterbi path of least cost plus
model surprise is the restored text.  The model is a trigram model of letters
within words, interpolated with bigrams and letters.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

# What look-alikes may stand for.
LOOK_ALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e"}
SEPARATORS = " .-_*~"
# Costs of the channel in nats.
AS_LETTER, DIGIT_AS_BREAK, NEXT_AS_BREAK, SIGN_AS_BREAK = 1.0, 8.0, 1.0, 0.5
LOST_OF_TWO, LOST_OF_MANY = 6.0, 0.3
JOINED, LEFT_APART = 0.5, 3.0

BREAK, OTHER = 0, 59
SYMBOLS = 60
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xE0, 0x100))
CODE = {c: k + 1 for k, c in enumerate(ALPHABET)}
BLOCK = 4096              # a longer stretch is decoded in blocks
CACHED = 1 << 16

_SIGNS = "".join(map(re.escape, LOOK_ALIKES))
_TOKEN = rf"[^\W_{_SIGNS}]|[{_SIGNS}]"
_LETTER = r"[^\W\d_]"
SUSPECT = re.compile(rf"(?<![\w{_SIGNS}])(?=[\w{_SIGNS}]*?(?:{_LETTER}[{_SIGNS}]|[{_SIGNS}]{_LETTER}|({_LETTER})\1\1))[\w{_SIGNS}]++")
APART = re.compile(rf"(?<![\w{_SIGNS}])(?:{_TOKEN})(?:[ .\-_*~](?:{_TOKEN})(?![^\W_{_SIGNS}]|[{_SIGNS}])){{2,}}+")
LETTER = re.compile(_LETTER)


# of each code point: its symbol, whether it is a letter, a look-alike or a separator
CHUNK = 1 << 20           # characters looked at together


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    symbol = np.where(letter, OTHER, BREAK)
    for point in range(0x250):
        symbol[point] = CODE.get(chr(point).lower(), symbol[point])
    sign, separator = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    sign[[ord(c) for c in LOOK_ALIKES]] = True
    separator[[ord(c) for c in SEPARATORS]] = True
    return symbol, letter, sign, separator


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def letters(points: np.ndarray) -> np.ndarray:
    return _tables()[1][points]


def symbols(text: str) -> np.ndarray:
    """The symbols of a text, a break on both sides."""
    return _tables()[0][code_points(f"\n{text}\n")]


def chunks(texts: list[str]):
    """Consecutive lists of texts of about ``CHUNK`` characters; a longer text comes alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > CHUNK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def suspects(texts: list[str]) -> np.ndarray:
    """Numbers of the texts that may hold a suspect stretch."""
    points = code_points("\n".join(texts))
    if len(points) < 3:
        return np.zeros(0, np.int64)
    _, letter, sign, separator = (t[points] for t in _tables())
    at = [np.flatnonzero(letter[:-1] & sign[1:] | sign[:-1] & letter[1:]),
          np.flatnonzero(letter[:-2] & (points[:-2] == points[1:-1]) & (points[1:-1] == points[2:]))]
    token = np.concatenate(([False], letter | sign, [False]))
    one = token[1:-1] & ~token[:-2] & ~token[2:]
    at.append(np.flatnonzero(one[:-4] & separator[1:-3] & one[2:-2] & separator[3:-1] & one[4:]))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.unique(np.searchsorted(ends, np.concatenate(at), side="right"))


def count_trigrams(texts, counts: np.ndarray) -> None:
    """Add the trigrams of ``texts`` to ``counts``, an array of SYMBOLS ** 3."""
    for text in texts:
        if text:
            s = symbols(text)
            a, b, c = s[:-2], s[1:-1], s[2:]
            # a word's first letter follows two breaks, whatever stood before
            index = (np.where(b == BREAK, BREAK, a) * SYMBOLS + b) * SYMBOLS + c
            index = np.concatenate(([s[1]] if len(s) > 1 else [], index))
            counts += np.bincount(index.astype(np.int64), minlength=SYMBOLS ** 3)


def surprise(counts: np.ndarray) -> np.ndarray:
    """``-log P(c | a, b)`` as an array [a, b, c], from the counts of trigrams."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    three[BREAK, BREAK, BREAK] = 0
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one.sum() + SYMBOLS)

    def over(counted, lower):
        # Witten-Bell: the more kinds of successors, the more weight below
        total = counted.sum(axis=-1, keepdims=True)
        kinds = (counted > 0).sum(axis=-1, keepdims=True)
        return (counted + np.maximum(kinds, 1) * lower) / (total + np.maximum(kinds, 1))

    return -np.log(over(three, over(two, p1)))


class Restorer:
    """Restores texts under one model; decoded stretches are remembered up to a bound."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.cache: dict[str, str] = {}

    def restore_all(self, texts: list[str]) -> list[str]:
        """Restored texts; those without a suspect stretch are told by one look at their characters."""
        out = []
        for held in chunks(texts):
            held = list(held)
            for k in suspects(held):
                held[k] = self.restore(held[k])
            out += held
        return out

    def restore(self, text: str) -> str:
        text = APART.sub(self._stretch, text)
        return SUSPECT.sub(self._stretch, text)

    def _stretch(self, match: re.Match) -> str:
        part = match.group()
        if not LETTER.search(part):
            return part
        if part not in self.cache:
            if len(self.cache) >= CACHED:
                self.cache.clear()
            self.cache[part] = "".join(self.decode(part[k:k + BLOCK]) for k in range(0, len(part), BLOCK))
        return self.cache[part]

    def decode(self, part: str) -> str:
        """The path of least cost through the lattice of ``part``; breaks come back as spaces."""
        # state: last two symbols -> (cost, path), a path being (symbol or letter, path before)
        states = {(BREAK, BREAK): (0.0, None)}
        part = part.lower()
        for at, c in enumerate(part):
            choices = self._choices(part, at)
            after: dict = {}
            for (a, b), (cost, path) in states.items():
                row = self.costs[a][b]
                for code, letter, extra in choices:
                    if code is None:
                        key, total, grown = (a, b), cost + extra, path
                    elif code == BREAK:
                        key = (BREAK, BREAK)
                        total = cost + extra + (row[BREAK] if b != BREAK else 0.0)
                        grown = (" ", path) if b != BREAK else path
                    else:
                        key, total, grown = (b, code), cost + extra + row[code], (letter, path)
                    if key not in after or total < after[key][0]:
                        after[key] = (total, grown)
            states = after
        _, path = min(((cost + (self.costs[a][b][BREAK] if b != BREAK else 0.0), path) for (a, b), (cost, path) in states.items()),
                      key=lambda x: x[0])
        out = []
        while path is not None:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    @staticmethod
    def _choices(part: str, at: int) -> list[tuple[int | None, str, float]]:
        """(symbol or None for nothing, letter, cost) of one character."""
        c = part[at]
        if c in LOOK_ALIKES:
            out = [(CODE[x], x, AS_LETTER) for x in LOOK_ALIKES[c]]
            digit = NEXT_AS_BREAK if at and part[at - 1].isdigit() else DIGIT_AS_BREAK
            out.append((BREAK, " ", digit if c.isdigit() else SIGN_AS_BREAK))
        elif c.isalpha():
            out = [(CODE.get(c, OTHER), c, 0.0)]
        else:
            return [(None, "", JOINED), (BREAK, " ", LEFT_APART)]
        if at and part[at - 1] == c:
            many = part[at - 2:at - 1] == c or part[at + 1:at + 2] == c
            out.append((None, "", LOST_OF_MANY if many else LOST_OF_TWO))
        return out
