"""A minimal acyclic automaton that maps words to id sequences, as one block of bytes.

The automaton shares prefixes and suffixes. A path adds up the numbers of words that come
before it in order, so a word's sum is its rank, and the rank leads to its ids: the
transducer's output.
"""

from __future__ import annotations

import mmap
import os
import struct
from collections.abc import Iterable

import numpy as np

_HEAD = struct.Struct("<5q")


def compile_words(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The automaton of distinct words with their ids. Words are sorted here."""
    entries = sorted(entries)
    # a state: [final, labels, targets]; made minimal from the end of each word once no
    # later word can change it
    register: dict[tuple, int] = {}
    final: list[int] = []
    arcs: list[tuple[tuple[int, int], ...]] = []

    def frozen(is_final: bool, out: list[tuple[int, int]]) -> int:
        key = (is_final, *out)
        at = register.get(key)
        if at is None:
            at = register[key] = len(final)
            final.append(int(is_final))
            arcs.append(tuple(out))
        return at

    # the path of the last word: per state whether it is final, and its finished arcs
    path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
    last = b""
    for word, _ in entries:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        for at in range(len(last), same, -1):
            (is_final,), out = path.pop()
            path[-1][1].append((last[at - 1], frozen(is_final, out)))
        for _ in word[same:]:
            path.append(([False], []))
        path[-1][0][0] = True
        last = word
    for at in range(len(last), 0, -1):
        (is_final,), out = path.pop()
        path[-1][1].append((last[at - 1], frozen(is_final, out)))
    (is_final,), out = path.pop()
    root = frozen(is_final, out)

    # targets are frozen before their sources, so one pass counts the words of every state
    words = np.zeros(len(final), np.int32)
    first = np.zeros(len(final) + 1, np.int32)
    labels, targets, before = bytearray(), [], []
    for state, out in enumerate(arcs):
        total = final[state]
        for label, target in out:
            labels.append(label)
            targets.append(target)
            before.append(total)
            total += int(words[target])
        words[state] = total
        first[state + 1] = len(labels)
    ids = [i for _, seq in entries for i in seq]
    ends = np.cumsum([0, *(len(seq) for _, seq in entries)], dtype=np.int64).astype(np.int32)
    numbers = [first, np.array(targets, np.int32), np.array(before, np.int32), np.array(final, np.int32), ends, np.array(ids, np.int32)]
    head = _HEAD.pack(root, len(final), len(labels), len(entries), len(ids))
    return head + b"".join(x.tobytes() for x in numbers) + bytes(labels)


class Lexicon:
    """Looks words up in a compiled automaton through mapped memory, without unpacking it."""

    def __init__(self, block: bytes):
        # an unnamed file in memory: mapped as a file is, and in no folder
        handle = os.memfd_create("lexicon")
        try:
            os.write(handle, block) if len(block) < 1 << 30 else os.writev(handle, [block])
            self.memory = mmap.mmap(handle, len(block), prot=mmap.PROT_READ)
        finally:
            os.close(handle)
        root, states, arcs, words, ids = _HEAD.unpack_from(self.memory)
        view, at = memoryview(self.memory), _HEAD.size

        def numbers(n: int) -> memoryview:
            nonlocal at
            at += 4 * n
            return view[at - 4 * n : at].cast("i")

        self.root = root
        self.first, self.targets, self.before = numbers(states + 1), numbers(arcs), numbers(arcs)
        self.final, self.ends, self.ids = numbers(states), numbers(words + 1), numbers(ids)
        self.labels = at
        self._keys: np.ndarray | None = None

    def rank(self, word: bytes) -> int:
        """The place of the word in order, or -1."""
        state, total = self.root, 0
        first, base, find = self.first, self.labels, self.memory.find
        for i in range(len(word)):
            at = find(word[i : i + 1], base + first[state], base + first[state + 1])
            if at < 0:
                return -1
            at -= base
            total += self.before[at]
            state = self.targets[at]
        return total if self.final[state] else -1

    def output(self, rank: int) -> list[int]:
        """The ids of the word with this place."""
        return self.ids[self.ends[rank] : self.ends[rank + 1]].tolist()

    def __call__(self, word: bytes) -> list[int] | None:
        rank = self.rank(word)
        return None if rank < 0 else self.output(rank)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The places of many words, or -1: all of them take their next step at the same time."""
        found = np.full(len(words), -1, np.int64)
        if not words or not len(self.targets):
            return found
        if self._keys is None:
            first, labels = np.asarray(self.first), np.frombuffer(self.memory, np.uint8, len(self.targets), self.labels)
            # arcs stand in order of state and label
            self._keys = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first)) << 8 | labels
        targets, before, final = np.asarray(self.targets), np.asarray(self.before), np.asarray(self.final)
        sizes = np.array([len(w) for w in words])
        flat, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        live, state, total = np.arange(len(words)), np.full(len(words), self.root), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            ended = sizes[live] == step
            if ended.any():
                over = live[ended]
                found[over] = np.where(final[state[ended]] == 1, total[ended], -1)
                live, state, total = live[~ended], state[~ended], total[~ended]
            key = state.astype(np.int64) << 8 | flat[start[live] + step]
            at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            hit = self._keys[at] == key
            live, at, total = live[hit], at[hit], total[hit]
            state, total = targets[at], total + before[at]
            step += 1
        return found
