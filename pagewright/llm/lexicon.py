"""A minimal acyclic transducer from words to the ids of their tokens.

Words in byte order are added one by one; a finished suffix is replaced by an equal one that
is already there, so that words share both prefixes and suffixes. Each transition carries how
many words lie before those behind it, so the numbers along a word's path add up to its rank,
and the rank leads to its ids. The automaton is five flat arrays in one file, which is mapped
into memory: processes of a machine share its pages. Lookups walk many words at once.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

_MAGIC = b"MATLEX01"


class _Node:
    __slots__ = ("edges", "final", "number")

    def __init__(self) -> None:
        self.edges: dict[int, _Node] = {}
        self.final = False
        self.number = -1

    def key(self) -> tuple:
        return (self.final, tuple((b, n.number) for b, n in self.edges.items()))


def compiled(entries: dict[bytes, list[int]]) -> bytes:
    """The automaton of ``entries`` as one block of bytes."""
    words = sorted(entries)
    root = _Node()
    register: dict[tuple, _Node] = {}
    path: list[tuple[_Node, int, _Node]] = []
    nodes: list[_Node] = []

    def settle(depth: int) -> None:
        """Replace the states beyond ``depth`` of the last word by equal ones, or keep them."""
        while len(path) > depth:
            parent, byte, child = path.pop()
            key = child.key()
            twin = register.get(key)
            if twin is None:
                child.number = len(nodes)
                nodes.append(child)
                register[key] = child
            else:
                parent.edges[byte] = twin

    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        node = path[-1][2] if path else root
        for byte in word[common:]:
            child = _Node()
            node.edges[byte] = child
            path.append((node, byte, child))
            node = child
        node.final = True
        last = word
    settle(0)
    root.number = len(nodes)
    nodes.append(root)

    # Children are numbered before their parents, so counts of words below are known in order.
    below = np.zeros(len(nodes), np.int64)
    first = np.zeros(len(nodes) + 1, np.int32)
    labels, targets, skipped = [], [], []
    for k, node in enumerate(nodes):
        before = int(node.final)
        for byte, child in node.edges.items():
            labels.append(byte)
            targets.append(child.number)
            skipped.append(before)
            before += int(below[child.number])
        below[k] = before
        first[k + 1] = len(labels)
    ids = [entries[w] for w in words]
    arrays = [
        first,
        np.array([n.final for n in nodes], np.uint8),
        np.array(labels, np.uint8),
        np.array(targets, np.int32),
        np.array(skipped, np.int32),
        np.cumsum([0, *map(len, ids)]).astype(np.int32),
        np.array([i for each in ids for i in each], np.uint32),
    ]
    out = bytearray(_MAGIC + np.array([len(a) for a in arrays], np.int64).tobytes())
    for array in arrays:
        out += bytes(-len(out) % 8) + array.tobytes()
    return bytes(out)


class Lexicon:
    """A compiled automaton, read from a mapped file."""

    _KINDS = (np.int32, np.uint8, np.uint8, np.int32, np.int32, np.int32, np.uint32)

    def __init__(self, path: str) -> None:
        mapped = np.memmap(path, np.uint8, mode="r")
        if mapped[: len(_MAGIC)].tobytes() != _MAGIC:
            raise ValueError("not a lexicon file")
        sizes = mapped[8 : 8 + 8 * len(self._KINDS)].view(np.int64)
        at, arrays = 8 + 8 * len(self._KINDS), []
        for size, kind in zip(sizes.tolist(), self._KINDS, strict=True):
            at += -at % 8
            n = size * np.dtype(kind).itemsize
            arrays.append(mapped[at : at + n].view(kind))
            at += n
        self._first, self._final, self._labels, self._targets, self._skipped, self._offsets, self._ids = arrays
        self.states, self.transitions, self.words = len(self._final), len(self._labels), len(self._offsets) - 1
        # State and label in one sorted key: transitions of a state are in order of their labels.
        self._keys = np.repeat(np.arange(self.states, dtype=np.int64), np.diff(self._first)) << 8 | self._labels

    @classmethod
    def of_bytes(cls, block: bytes, name: str) -> Lexicon:
        """Map ``block`` from a file of this machine that its processes share; ``name`` is unique to it."""
        path = os.path.join(tempfile.gettempdir(), f"lexicon-{name}")
        if not (os.path.exists(path) and os.path.getsize(path) == len(block)):
            with tempfile.NamedTemporaryFile(dir=tempfile.gettempdir(), delete=False) as out:
                out.write(block)
            os.replace(out.name, path)
        return cls(path)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 if it is not in the lexicon."""
        ranks = np.full(len(words), -1, np.int64)
        if not len(words) or not self.words:
            return ranks
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live = np.arange(len(words))
        state = np.full(len(words), self.states - 1, np.int64)
        number = np.zeros(len(words), np.int64)
        depth = 0
        while len(live):
            ended = lengths[live] == depth
            done = live[ended]
            final = self._final[state[ended]] == 1
            ranks[done[final]] = number[ended][final]
            live, state, number = live[~ended], state[~ended], number[~ended]
            keys = state << 8 | letters[starts[live] + depth]
            at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            known = self._keys[at] == keys
            live, at = live[known], at[known]
            state, number = self._targets[at].astype(np.int64), number[known] + self._skipped[at]
            depth += 1
        return ranks

    def ids_of_rank(self, rank: int) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self._ids[self._offsets[rank] : self._offsets[rank + 1]].tobytes()
