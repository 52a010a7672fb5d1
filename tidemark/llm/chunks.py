"""Encode each distinct stretch of text once: a bounded memory of encoded stretches per Python worker."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Stretches and the pieces they are made of, remembered before a memory starts again.
MOST, MOST_PIECES = 150_000, 350_000


@contextmanager
def no_collection() -> Iterator[None]:
    """No search for reference cycles meanwhile: encoding makes very many lists and no cycles."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


class Memory(dict):
    """Stretches of text and their encoded bytes; ``encode`` gives those of new ones."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = MOST):
        super().__init__()
        self.encode, self.most = encode, most

    def learn(self, stretches: Iterable[Iterable[str]]) -> None:
        """Make sure that all these are known."""
        self.learn_set(set().union(*stretches))

    def learn_set(self, distinct: set[str]) -> None:
        new = [x for x in distinct if x not in self]  # not a difference of sets: that would walk through the whole memory
        if len(self) + len(new) > self.most:
            self.clear()
            new = list(distinct)
        self.update(zip(new, self.encode(new)))


def joined_groups(items: list[str], chars: int = 20_000) -> Iterable[tuple[list[int], str, np.ndarray]]:
    """Cut items into groups: (their places, the text joined by spaces, where each begins in it).

    Items have no outer spaces; empty ones are left out.
    """
    group, starts, at = [], [], 0
    for k, item in enumerate(items):
        if not item:
            continue
        group.append(k)
        starts.append(at)
        at += len(item) + 1
        if at > chars:
            yield group, " ".join([items[i] for i in group]), np.array(starts)
            group, starts, at = [], [], 0
    if group:
        yield group, " ".join([items[i] for i in group]), np.array(starts)


def encode_items(tokenizer, items: list[str], kind: np.dtype, whole_words: bool = False) -> list[bytes]:
    """Each item's ids as bytes. The tokenizer must treat items parted by a space independently.

    Many items are encoded as one text, and token offsets tell which item a token is of; if the
    tokenizer splits at spaces only (``whole_words``), the tokens' word numbers do.
    """
    out = [b""] * len(items)
    groups = list(joined_groups(items))
    for low in range(0, len(groups), 16):
        some = groups[low:low + 16]
        for (group, _, starts), encoding in zip(some, tokenizer.encode_batch([g[1] for g in some], add_special_tokens=False)):
            ids = np.array(encoding.ids, kind)
            if not len(ids):
                continue
            if whole_words:
                item = np.array(encoding.word_ids)
            else:
                item = np.searchsorted(starts, np.array([a for a, _ in encoding.offsets]), side="right") - 1
            cut = np.searchsorted(item, np.arange(len(group) + 1))
            data, width = ids.tobytes(), ids.itemsize
            cut = (cut * width).tolist()
            for place, a, b in zip(group, cut[:-1], cut[1:]):
                out[place] = data[a:b]
    return out


def encode_flat(tokenizer, items: list[str], kind: np.dtype, whole_words: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode_items``: all ids side by side, and how many each item has."""
    lengths, out = np.zeros(len(items), np.int64), [np.zeros(0, kind)]
    groups = list(joined_groups(items))
    for low in range(0, len(groups), 16):
        some = groups[low:low + 16]
        for (group, _, starts), encoding in zip(some, tokenizer.encode_batch([g[1] for g in some], add_special_tokens=False)):
            if whole_words:
                item = np.array(encoding.word_ids, np.int64)
            else:
                item = np.searchsorted(starts, np.array([a for a, _ in encoding.offsets], np.int64), side="right") - 1
            lengths[group] = np.bincount(item, minlength=len(group))
            out.append(np.array(encoding.ids, kind))
    return np.concatenate(out), lengths


def gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after another."""
    ends = np.cumsum(lengths)
    return ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


class IdMemory:
    """Names and their ids in one growing array; ``encode`` gives the ids of new names, side by side, and their numbers.

    At ``most`` names it starts again.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int, kind: np.dtype):
        self.encode, self.most, self.kind = encode, most, kind
        self.clear()

    def clear(self) -> None:
        self.names = pa.array([], pa.string())
        self.starts, self.lengths, self.ids, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, self.kind), 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])

    def find(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of the ids of each of some distinct names; ``ids`` has them."""
        slots = pc.index_in(names, value_set=self.names).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new) and len(self.names) + len(new) > self.most:
            self.clear()
            new = np.arange(len(names))
        if len(new):
            fresh = names.take(pa.array(new))
            ids, lengths = self.encode(fresh)
            count, first = len(self.names), np.arange(len(self.names), len(self.names) + len(new))
            self.starts, self.lengths, self.ids = (self._room(a, n) for a, n in (
                (self.starts, count + len(new)), (self.lengths, count + len(new)), (self.ids, self.used + len(ids))))
            self.starts[first], self.lengths[first] = self.used + np.cumsum(lengths) - lengths, lengths
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            self.names = pa.concat_arrays([self.names, fresh])
            slots[new] = first
        return self.starts[slots], self.lengths[slots]
