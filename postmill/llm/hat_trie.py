"""A HAT-trie over word ids: hash containers under shallow trie nodes, spilled as sorted runs.

A key is a row of ids; the first `ROOT` of them choose a subtree. A subtree begins as one hash container of the
remaining ids; a container over `BURST` entries bursts into a trie node with a container for each next id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ROOT = 2
# Entries of a container before it bursts, and of a trie before subtrees are spilled.
BURST, HELD = 1 << 13, 1 << 18


class Node:
    """A trie node: the count of the key that ends here, and a container or node for each next id."""

    __slots__ = ("count", "below")

    def __init__(self, box: dict[bytes, int]):
        self.count = box.pop(b"", 0)
        self.below: dict[bytes, dict[bytes, int] | Node] = {}
        for key, count in box.items():
            self.below.setdefault(key[:4], {})[key[4:]] = count

    def add(self, key: bytes, count: int) -> int:
        """1 if the key is new."""
        if not key:
            self.count, new = self.count + count, not self.count
            return int(new)
        place = key[:4]
        box = self.below.get(place)
        if box is None:
            self.below[place] = {key[4:]: count}
            return 1
        if isinstance(box, Node):
            return box.add(key[4:], count)
        before = len(box)
        box[key[4:]] = box.get(key[4:], 0) + count
        if len(box) > BURST:
            self.below[place] = Node(dict(box))
        return len(box) - before

    def items(self) -> Iterator[tuple[bytes, int]]:
        if self.count:
            yield b"", self.count
        for place, box in self.below.items():
            for key, count in box.items():
                yield place + key, count


class HatTrie:
    """Counts of rows of ids."""

    def __init__(self):
        self.roots: dict[bytes, dict[bytes, int] | Node] = {}
        self.sizes: dict[bytes, int] = {}
        self.size = 0

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Distinct rows of equal length with their counts, in order, so that a subtree's rows lie together."""
        if not len(rows):
            return
        cut = min(ROOT, rows.shape[1])
        head = np.append(True, (rows[1:, :cut] != rows[:-1, :cut]).any(axis=1))
        begins = np.flatnonzero(head)
        roots = _packed(rows[begins, :cut])
        keys = _packed(rows[:, cut:]) if cut < rows.shape[1] else [b""] * len(rows)
        begins, times = begins.tolist(), counts.tolist()
        for root, a, z in zip(roots, begins, [*begins[1:], len(rows)], strict=True):
            box = self.roots.get(root)
            if box is None:
                box = self.roots[root] = {}
                self.sizes[root] = 0
            if isinstance(box, Node):
                new = sum(map(box.add, keys[a:z], times[a:z]))
            else:
                new, get = -len(box), box.get
                for k in range(a, z):
                    box[keys[k]] = get(keys[k], 0) + times[k]
                new += len(box)
                if len(box) > BURST:
                    self.roots[root] = Node(box)
            self.sizes[root] += new
            self.size += new

    def spill(self, down_to: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take whole subtrees out, the largest first, until `down_to` entries are left: rows and counts by length."""
        keys, counts = [], []
        for root in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.size <= down_to:
                break
            self.size -= self.sizes.pop(root)
            box = self.roots.pop(root)
            if isinstance(box, Node):
                for key, count in box.items():
                    keys.append(root + key)
                    counts.append(count)
            else:
                keys += [root + key for key in box]
                counts += box.values()
        length, counts = np.array(list(map(len, keys)), dtype=np.int64), np.array(counts, dtype=np.int64)
        for own in np.unique(length):
            at = np.flatnonzero(length == own)
            rows = np.frombuffer(b"".join([keys[k] for k in at.tolist()]), dtype=">u4")
            yield rows.reshape(len(at), -1).astype(np.int64), counts[at]


def _packed(rows: np.ndarray) -> list[bytes]:
    return np.ascontiguousarray(rows, dtype=">u4").view(f"V{4 * rows.shape[1]}").ravel().tolist()


def counted(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ids in order, with the sums of their weights."""
    if not len(rows):
        return rows, weights
    rank = np.zeros(len(rows), dtype=np.int64)
    for k in range(rows.shape[1]):
        rank = np.unique(rank * (int(rows[:, k].max()) + 1) + rows[:, k], return_inverse=True)[1].ravel()
    first = np.zeros(int(rank.max()) + 1, dtype=np.int64)
    first[rank] = np.arange(len(rank))
    total = np.zeros(len(first), dtype=np.int64)
    np.add.at(total, rank, weights)
    return rows[first], total
