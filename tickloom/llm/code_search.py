"""Links among vectors held in memory, told from integer codes of their rotated components."""

from __future__ import annotations

import math

import numpy as np

from tickloom.llm.vectors import unit_rows

#: The code of a component of 1.
UNIT = 32_767
#: Pairs compared at once, and pairs up to which a search is not split by blocks.
LEAF, WHOLE = 1 << 19, 1 << 20
#: Vectors whose components are unpacked at once.
PIECE = 1 << 17
#: Candidates whose codes are compared at once; from this share on, all pairs of a leaf are.
BATCH, DENSE = 1 << 14, 1 / 16


class Codes:
    """A random rotation, the 16-bit codes of unit vectors, and what distances of codes say.

    Rounding moves a distance of codes by the square root of ``size`` at most, so that up to ``sure``
    a pair has a cosine of ``cosine`` or more, beyond ``near`` it has less, and between them only the
    vectors tell. Squared distances of codes are whole numbers below 2 ** 53: sums of them are exact
    in any order. A pair within ``near`` is within its share of the square in one of the blocks.
    """

    def __init__(self, size: int, cosine: float, blocks: int):
        normal = np.random.default_rng(11).normal(size=(size, size))
        self.rotation = np.linalg.qr(normal)[0]
        radius, error = UNIT * math.sqrt(max(2 - 2 * cosine, 0)), math.sqrt(size) + 1
        self.sure, self.near = (radius - error) ** 2 if radius > error else -1.0, (radius + error) ** 2
        self.size = size
        self.blocks = self._shares(min(blocks, size))
        self.whole = self._shares(1)

    def _shares(self, blocks: int) -> list[tuple[int, int, float]]:
        edges = np.linspace(0, self.size, blocks + 1).astype(int).tolist()
        return [(a, b, self.near * (b - a) / self.size + 1) for a, b in zip(edges[:-1], edges[1:])]

    def of(self, rows: np.ndarray) -> np.ndarray:
        return np.rint(unit_rows(rows) @ self.rotation * UNIT).astype(np.int16)


class Search:
    """Counts of links, a spanning forest of them, and the pairs that codes leave undecided.

    In every block, sets are halved until few pairs are left or their bounding boxes are too far
    apart. A pair counts in the first block that has it within its share, so that it counts once;
    rows with the same ``node`` are no pair.
    """

    def __init__(self, codes: Codes, code: np.ndarray, node: np.ndarray, copies: np.ndarray):
        self.codes, self.code, self.node, self.copies = codes, code, node, copies
        self.links = np.zeros(len(node), np.int64)
        self.parent = np.arange(len(node))
        self.edges: list[np.ndarray] = []
        self.unsure: list[np.ndarray] = []

    def run(self, left: np.ndarray, right: np.ndarray | None = None) -> None:
        """Finds the pairs of a row of ``left`` and one of ``right``, or those within ``left``."""
        many = len(left) * (len(left) if right is None else len(right)) > WHOLE
        self.blocks = self.codes.blocks if many else self.codes.whole
        self.starts = [first for first, _, _ in self.blocks]
        self.shares = np.array([share for _, _, share in self.blocks])
        for self.block, (first, end, _) in enumerate(self.blocks):
            self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
            self.n_waiting = 0
            lefts, rights = (None if rows is None else self._pieces(rows, first, end) for rows in (left, right))
            for k, rows in enumerate(lefts):
                part = _columns(self.code[rows, first:end])
                if right is None:
                    self._within(rows, part)
                for others in lefts[k + 1 :] if right is None else rights:
                    self._between(rows, part, others, _columns(self.code[others, first:end]))
            self._compare_waiting()

    def _pieces(self, rows: np.ndarray, first: int, end: int) -> list[np.ndarray]:
        """The rows, halved as they are later, so that only pieces of them are unpacked."""
        if len(rows) <= PIECE:
            return [rows]
        part = self.code[rows, first:end].T
        return [piece for half in _halves(part, part.min(axis=1).astype(int), part.max(axis=1)) for piece in self._pieces(rows[half], first, end)]

    def _within(self, rows: np.ndarray, part: np.ndarray) -> None:
        if len(rows) ** 2 <= 2 * LEAF:
            self._compare(rows, part, rows, part)
            return
        low, high = _halves(part, *_box(part))
        one, other = (rows[low], part.take(low, axis=1)), (rows[high], part.take(high, axis=1))
        self._within(*one)
        self._within(*other)
        self._between(*one, *other)

    def _between(self, left: np.ndarray, part: np.ndarray, right: np.ndarray, other: np.ndarray) -> None:
        if not (len(left) and len(right)):
            return
        box = _box(part)
        near = self._near(*box, other)
        if len(near) < len(right):
            right, other = right[near], other.take(near, axis=1)
        if not len(right):
            return
        other_box = _box(other)
        near = self._near(*other_box, part)
        if len(near) < len(left):
            left, part = left[near], part.take(near, axis=1)
        if not len(left):
            return
        if len(left) * len(right) <= LEAF:
            self._compare(left, part, right, other)
        elif len(left) >= len(right):
            for half in _halves(part, *box):
                self._between(left[half], part.take(half, axis=1), right, other)
        else:
            for half in _halves(other, *other_box):
                self._between(left, part, right[half], other.take(half, axis=1))

    def _near(self, least: np.ndarray, most: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Which columns of ``part`` are within the block's share of a box."""
        out = np.clip(part[:-1], least[:, None], most[:, None])
        out -= part[:-1]
        return np.flatnonzero(np.einsum("ij,ij->j", out, out) <= 1.001 * self.blocks[self.block][2])

    def _compare(self, left: np.ndarray, part: np.ndarray, right: np.ndarray, other: np.ndarray) -> None:
        squares, off = _squares(part, other)
        _, _, share = self.blocks[self.block]
        inside = squares <= share + off
        if np.count_nonzero(inside) > DENSE * inside.size:
            self._compare_all(left, right, inside, squares <= share - off)
        else:
            self._wait(left, right, inside)

    def _wait(self, left: np.ndarray, right: np.ndarray, some: np.ndarray) -> None:
        hits = np.flatnonzero(some)
        if not len(hits):
            return
        i, j = np.divmod(hits, len(right))
        if left is right:
            i, j = i[i < j], j[i < j]
        self.waiting.append((left[i], right[j]))
        self.n_waiting += len(i)
        if self.n_waiting > 4 * BATCH:
            self._compare_waiting()

    def _compare_waiting(self) -> None:
        if not self.waiting:
            return
        left, right = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        for start in range(0, len(left), BATCH):
            a, b = left[start : start + BATCH], right[start : start + BATCH]
            apart = self.code[a].astype(np.float64) - self.code[b]
            parts = np.add.reduceat(apart * apart, self.starts, axis=1)
            inside = parts[:, : self.block + 1] <= self.shares[: self.block + 1]
            total = parts.sum(axis=1)
            found = inside[:, -1] & ~inside[:, :-1].any(axis=1) & (total <= self.codes.near) & (self.node[a] != self.node[b])
            sure = found & (total <= self.codes.sure)
            if sure.any():
                np.add.at(self.links, a[sure], self.copies[b[sure]])
                np.add.at(self.links, b[sure], self.copies[a[sure]])
                self._join(a[sure], b[sure])
            if (unsure := found & ~sure).any():
                self.unsure.append(np.column_stack([a[unsure], b[unsure]]))

    def _compare_all(self, left: np.ndarray, right: np.ndarray, found: np.ndarray, clear: np.ndarray) -> None:
        """Settles by matrix products what is ``clear`` among all pairs of a leaf; the others ``found`` wait."""
        one, two = self.code[left], self.code[right]
        for block in range(self.block):
            first, end, share = self.blocks[block]
            squares, off = _squares(_columns(one[:, first:end]), _columns(two[:, first:end]))
            found &= squares > share - off
            if np.count_nonzero(found) <= DENSE * found.size:
                self._wait(left, right, found)
                return
            clear &= squares > share + off
        total, off = _squares(_columns(one), _columns(two))
        found &= total <= self.codes.near + off
        clear &= found
        clear &= total <= self.codes.sure - off
        clear &= self.node[left][:, None] != self.node[right]
        if left is right:
            clear = np.triu(clear, 1)
            found = np.triu(found, 1)
        counted = clear.astype(np.float64)
        np.add.at(self.links, left, (counted @ self.copies[right].astype(np.float64)).astype(np.int64))
        np.add.at(self.links, right, (self.copies[left].astype(np.float64) @ counted).astype(np.int64))
        i, j = np.divmod(np.flatnonzero(clear & (self._roots(left)[:, None] != self._roots(right))), len(right))
        self._join(left[i], right[j])
        self._wait(left, right, found & ~clear)

    def _roots(self, rows: np.ndarray) -> np.ndarray:
        root = self.parent[rows]
        while (above := self.parent[root]).tobytes() != root.tobytes():
            root = above
        self.parent[rows] = root
        return root

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Keeps those links that connect what was apart: each round hangs roots on smaller ones."""
        while len(a):
            p, q = self._roots(a), self._roots(b)
            apart = p != q
            a, b, p, q = a[apart], b[apart], p[apart], q[apart]
            larger, at = np.unique(np.maximum(p, q), return_index=True)
            self.parent[larger] = np.minimum(p, q)[at]
            if len(at):
                self.edges.append(np.column_stack([a[at], b[at]]))


def _columns(rows: np.ndarray) -> np.ndarray:
    """Components in rows, vectors in columns; below them the squares of the vectors."""
    part = np.empty((rows.shape[1] + 1, len(rows)), np.float32)
    part[:-1] = rows.T
    part[-1] = np.einsum("ij,ij->j", part[:-1], part[:-1])
    return part


def _squares(part: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances of all pairs of columns, by one product, and how far off single precision may be."""
    one = np.concatenate([-2 * part[:-1], part[-1:], np.ones_like(part[-1:])])
    off = (len(part) + 8) * 2.0**-22 * float(part[-1].max() + other[-1].max())
    return one.T @ np.concatenate([other[:-1], np.ones_like(other[-1:]), other[-1:]]), off


def _box(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return part[:-1].min(axis=1), part[:-1].max(axis=1)


def _halves(part: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the lower and the upper half along the widest component."""
    order = np.argpartition(part[np.argmax(most - least)], part.shape[1] // 2)
    return order[: part.shape[1] // 2], order[part.shape[1] // 2 :]
