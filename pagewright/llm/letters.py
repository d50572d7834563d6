"""A character language model and a Viterbi decoder for disguised words."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

import ahocorasick
import numpy as np

#: Letters of the model: 0 is a word's border, 1-26 are a-z, 27 is any other letter.
SYMBOLS = 28
ORDER = 4
STATES = SYMBOLS ** (ORDER - 1)

#: Characters that are written for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Characters that are put between letters.
FILLERS = ".-_*~'`^/\\,:;#=·"
#: Characters that may be put between letters, and those that each letter is written as.
_FILLS = frozenset(FILLERS + "!|+(")
_WRITTEN_AS = {letter: "".join(c for c, letters in LEET.items() if letter in letters) for letter in "abcdefghijklmnopqrstuvwxyz"}

# Log probabilities of the ways in which a letter comes to be written.
PLAIN = math.log(0.95)
SWAPPED = math.log(0.05)
REPEATED = math.log(0.3)
FILLER = math.log(0.4)

_TABLE = np.zeros(0x250, np.uint8)
for _k in range(26):
    _TABLE[ord("a") + _k] = _TABLE[ord("A") + _k] = _k + 1
for _k in range(0x80, 0x250):
    if chr(_k).isalpha():
        _TABLE[_k] = 27


def symbols_of(text: str) -> np.ndarray:
    """Model letters of a text; whatever is no letter is a border."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], np.where(points > 0x2FFF, 0, 27)).astype(np.int64)


def gram_counts(texts: list[str], counts: np.ndarray) -> None:
    """Add the texts' runs of ``ORDER`` letters, with the borders around words, to ``counts``."""
    found = symbols_of("\n".join(["", *texts, ""]))
    inside = found > 0
    # A word ends in one border, which its last run reaches; its first run has no letter before.
    index = found[np.flatnonzero(inside[1:] | inside[:-1]) + 1] if len(found) > 1 else found
    history = np.concatenate([[0] * (ORDER - 1), index])
    # Letters before the last border belong to another word.
    runs = np.zeros(len(index), np.int64)
    open_ = np.ones(len(index), bool)
    for k in range(1, ORDER):
        before = history[ORDER - 1 - k : len(history) - k]
        open_ &= before > 0
        runs += np.where(open_, before, 0) * SYMBOLS**k
    counts += np.bincount(runs + index, minlength=len(counts))


class LetterModel:
    """Log probability of a letter after three others, mixed with shorter histories."""

    def __init__(self, counts: np.ndarray) -> None:
        levels = [counts.reshape(-1, SYMBOLS).astype(np.float64)]
        while len(levels) < ORDER:
            levels.append(levels[-1].reshape(SYMBOLS, -1, SYMBOLS).sum(0))
        mixed = (levels[-1] + 1) / (levels[-1].sum() + SYMBOLS)
        for level in levels[-2::-1]:
            total = level.sum(1, keepdims=True)
            known = total / (total + 5.0)
            shares = level / np.maximum(total, 1)
            mixed = known * shares + (1 - known) * np.tile(mixed, (len(level) // len(mixed), 1))
        self.logs = np.log(mixed).astype(np.float32).tolist()

    def decode(self, written: str) -> str:
        """The likeliest letters behind a word: Viterbi over its lattice of writings.

        A state is the last three letters. Every character may be its own letter, a letter
        that it is written for, a repetition of the letter before, or a filler.
        """
        # A path is its last letter and the path before, so that a step costs the same at any length.
        paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        for character in written:
            after: dict[int, tuple[float, tuple | None]] = {}
            choices: list[tuple[str, float]] = []
            if character.isalpha():
                choices.append((character, PLAIN))
            choices += [(letter, SWAPPED) for letter in LEET.get(character, "")]
            filler = FILLER if character in _FILLS else None
            for state, (score, path) in paths.items():
                row = self.logs[state]
                for letter, cost in choices:
                    symbol = ord(letter) - 96 if "a" <= letter <= "z" else 27
                    value = score + cost + row[symbol]
                    target = (state * SYMBOLS + symbol) % STATES
                    if target not in after or after[target][0] < value:
                        after[target] = (value, (letter, path))
                if path is not None and any(letter == path[0] for letter, _ in choices):
                    value = score + REPEATED
                    if state not in after or after[state][0] < value:
                        after[state] = (value, path)
                if filler is not None:
                    value = score + filler
                    if state not in after or after[state][0] < value:
                        after[state] = (value, path)
            paths = after
            if not paths:
                return written
        _, path = max(((score + self.logs[state][0], path) for state, (score, path) in paths.items()), key=lambda x: x[0])
        text = []
        while path is not None:
            text.append(path[0])
            path = path[1]
        return "".join(reversed(text))


def _readable(written: str) -> bool:
    """Whether each character is a letter, is written for one, or may be a filler; others leave a word as it is."""
    return written.isalpha() or all(c.isalpha() or c in LEET or c in _FILLS for c in written)


class Reach:
    """Whether a reading can have one of some features, told without decoding.

    A feature is a word's beginning, or a whole word with ``$`` behind it. ``may`` follows all
    paths of the lattice that spell a feature, all features at once: the bits of a number are the
    letters reached so far, and a character moves bits on whose next letter it may be written for,
    and keeps those whose last letter it may repeat or after which it may be a filler. With
    ``anywhere`` features may stand behind other letters.
    """

    def __init__(self, found: Iterable[str], anywhere: bool = False) -> None:
        self._writes: dict[str, int] = {}
        self._start = self._begun = self._whole = 0
        self._again = anywhere
        place = 0
        for feature in sorted(found):
            word = feature.removesuffix("$")
            self._start |= 1 << place
            for letter in word:
                place += 1
                for character in [letter, *_WRITTEN_AS.get(letter, "")]:
                    self._writes[character] = self._writes.get(character, 0) | 1 << place
            if feature.endswith("$"):
                self._whole |= 1 << place
            else:
                self._begun |= 1 << place
            place += 1
        self._every = (1 << place) - 1

    def may(self, written: str) -> bool:
        """Whether ``decode(written)`` may have a feature; false only if it has none."""
        if not _readable(written):
            return True
        state = self._start
        for character in written:
            writes = self._writes.get(character, 0)
            stays = self._every if character in _FILLS else writes
            state = (state << 1) & writes | state & stays
            if self._again:
                state |= self._start
            if state & self._begun:
                return True
            if not state:
                return False
        return bool(state & self._whole)


#: Of the characters that may be put between letters, those that are also written for one.
_EITHER = tuple(c for c in _FILLS if c in LEET)
_POINTS = 0x10000


@lru_cache(maxsize=1)
def _rough_codes() -> np.ndarray:
    """A code for each character: 0 for what can only be a filler, one for white space, and one for all
    characters that can be written for the same letter. Letters that share a character share a code."""
    same = {c: c for c in "abcdefghijklmnopqrstuvwxyz"}
    for choices in LEET.values():
        for other in choices[1:]:
            same = {c: same[choices[0]] if x == same[other] else x for c, x in same.items()}
    codes = 0x80 + np.arange(_POINTS) % 0x70
    codes[:0x80] = np.where(np.arange(0x80) < 0x20, 1 + np.arange(0x80) % 0x1F, np.arange(0x80))
    for letter, code in same.items():
        codes[ord(letter)] = ord(code)
    for character, choices in LEET.items():
        codes[ord(character)] = ord(same[choices[0]])
    codes[[ord(c) for c in FILLERS if c not in LEET]] = 0
    codes[[k for k in range(_POINTS) if chr(k).isspace()]] = 0x20
    return codes.astype(np.uint8)


def _rough(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points of a text, their codes, and the places of those that are left without fillers and repetitions."""
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), _POINTS - 1)
    codes = _rough_codes()[points]
    kept = np.flatnonzero(codes)
    left = codes[kept]
    return points, codes, kept[np.append(left[:1] > 0, left[1:] != left[:-1])]


class Gate:
    """Finds the tokens of a text that may have one of some features in any reading.

    Characters that can stand for one letter get one code, fillers go, and repetitions become one.
    What is left of a reading's feature then stands in what is left of the token, so a search for
    all features at once passes over the others. Only a character that may be a letter or a filler
    between two others could hide a feature; such tokens are always returned.
    """

    def __init__(self, found: Iterable[str]) -> None:
        rough = set()
        for feature in found:
            word = feature.removesuffix("$") if len(feature) > 1 else feature
            _, codes, kept = _rough(word)
            rough.add(codes[kept].tobytes().decode("latin-1"))
        #: Without enough letters to look for, every token is returned.
        self._open = any(len(r) < 2 for r in rough)
        self._none = not rough
        self._search = ahocorasick.Automaton()
        for r in rough:
            self._search.add_word(r, None)
        if rough:
            self._search.make_automaton()

    def tokens(self, lowered: str) -> set[str]:
        if self._none or self._open:
            return set(lowered.split()) if self._open else set()
        points, codes, kept = _rough(lowered)
        spots = [int(kept[end]) for end, _ in self._search.iter(codes[kept].tobytes().decode("latin-1"))]
        spots += [k for k in np.flatnonzero(np.isin(points, _EITHER_POINTS)).tolist() if self._between(lowered, k)]
        if not spots:
            return set()
        inside = codes != 0x20
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        starts, ends = edges[::2], edges[1::2]
        at = np.unique(np.searchsorted(starts, spots, "right") - 1)
        return {lowered[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)}

    @staticmethod
    def _between(lowered: str, at: int) -> bool:
        """Whether the run of equal characters at ``at`` stands between two other characters of a token."""
        first = last = at
        while first and lowered[first - 1] == lowered[at]:
            first -= 1
        while last + 1 < len(lowered) and lowered[last + 1] == lowered[at]:
            last += 1
        return first > 0 and last + 1 < len(lowered) and not lowered[first - 1].isspace() and not lowered[last + 1].isspace()


_EITHER_POINTS = np.array([ord(c) for c in _EITHER], np.uint32)
_SPACED = re.compile(r"(?<!\S)(?:[^\W_][ .\-_*]{1,3}){2,}[^\W_](?![^\s.,!?;:])")
_EDGES = re.compile(r"^[\"'(\[{<¿¡«„“*_#%&~.,:;=\-]+|[\"')\]}>.,:;!?…»”%&*#_~=\-/\\|]+$|\${3,}$|@{3,}$")
_TRIPLE = re.compile(r"(.)\1\1")
_ADDRESS = re.compile(r"@.+\.|://|^www\.|^\d+$")
_LETTERS = re.compile(r"[^\W\d_]")
LONGEST = 30


def is_disguised(word: str) -> bool:
    """Whether a word's lattice has more than one path worth following.

    Double letters are ordinary spelling; addresses and words that are mostly digits are not words.
    """
    if word.isalpha():
        return _TRIPLE.search(word) is not None and len(word) <= LONGEST
    return 2 < len(word) <= LONGEST and 3 * len(_LETTERS.findall(word)) >= len(word) and not _ADDRESS.search(word)


def spaced_words(lowered: str) -> list[str]:
    """Words whose letters stand apart, put together."""
    return ["".join(c for c in found if c != " ") for found in _SPACED.findall(lowered)]


def restored(token: str, decode: Callable[[str], str]) -> str:
    """The word behind a token of lowered text; empty if there is none."""
    core = token if token.isalpha() else _EDGES.sub("", token)
    return decode(core) if core and is_disguised(core) else core


def lattices(token: str) -> tuple[set[str], set[str]]:
    """Of a token of lowered text, the words as they are written, and the writings to decode.

    A sign may stand for a letter, between letters or between words, so the token is read as one
    lattice, split at all signs, and split at those that are not written for letters.
    """
    if token.isalpha():
        if not _DOUBLE.search(token):
            return {token}, set()
        core, parts = token, {token}
    else:
        core = _EDGES.sub("", token)
        parts = {core, token, *_NO_WRITING.split(token), *_NO_LETTER.split(token)} - {""}
    written = {w for w in map(_lattice, parts) if w is not None}
    if core and is_disguised(core):
        written.add(core)
    return parts, written


_LONG_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_DOUBLE = re.compile(r"([^\W\d_])\1")
_NO_LETTER = re.compile(r"[\W_]+")
_NO_WRITING = re.compile(rf"[^\w{re.escape(''.join(c for c in LEET if not c.isalnum()))}]+|_+")


def _lattice(core: str) -> str | None:
    """What to decode of a part; None for plain words, numbers and addresses.

    Long runs are cut to three, which mean the same, so the length of a part is no limit.
    """
    plain = core.isalpha()
    if len(core) < 3 or (plain and not _DOUBLE.search(core)) or (not plain and _ADDRESS.search(core)):
        return None
    return _LONG_RUN.sub(r"\1\1\1", core)


def readings(token: str, decode: Callable[[str], str]) -> set[str]:
    """All words that a token of lowered text may be."""
    parts, written = lattices(token)
    return (parts | {decode(w) for w in written}) - {""}


def readings_within(token: str, decode: Callable[[str], str], reach: Reach) -> set[str]:
    """Those of ``readings`` that may have a feature of ``reach``, and the words as they are written."""
    parts, written = lattices(token)
    return (parts | {decode(w) for w in written if reach.may(w)}) - {""}


def words_restored(text: str, decode: Callable[[str], str]) -> set[str]:
    """The different words of a text, disguised ones decoded."""
    lowered = text.lower()
    found = {word for token in set(lowered.split()) for word in readings(token, decode)}
    found |= {decode(word) for word in spaced_words(lowered)}
    return found - {""}
