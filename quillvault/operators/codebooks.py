"""Short codes of vectors: what a vector has beyond its cell's centroid, part by part.

A vector of unit length is its centroid and a rest. The rest is cut into parts, and each part is
replaced by the number of the nearest entry of the part's codebook. A vector then takes a byte a part,
and its similarity to a question is estimated from tables: the question's product with the centroid,
and with every entry. The codebooks are learned from a bounded sample; every vector gets a code.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Vectors that the codebooks are learned from, at most.
SAMPLE_ROWS = 16_384
#: Components in a part, and entries in a codebook.
PART = 4
ENTRIES = 256
ROUNDS = 8


class Codebooks(NamedTuple):
    """``entries[p]``: the entries of part p; ``edges``: where parts begin and end."""

    edges: list[int]
    entries: list[np.ndarray]

    def encode(self, rest: np.ndarray) -> np.ndarray:
        """Codes of rows, one byte a part."""
        codes = np.empty((len(rest), len(self.entries)), np.uint8)
        for p, (a, b) in enumerate(zip(self.edges, self.edges[1:], strict=False)):
            codes[:, p] = _nearest(rest[:, a:b], self.entries[p])
        return codes

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The rests that codes stand for, in single precision."""
        parts = [e.astype(np.float32)[codes[:, p]] for p, e in enumerate(self.entries)]
        return np.concatenate(parts, axis=1)

    def products(self, questions: np.ndarray) -> list[np.ndarray]:
        """Tables ``[question, entry]``, one a part."""
        spans = zip(self.edges, self.edges[1:], strict=False)
        return [questions[:, a:b] @ e.T for (a, b), e in zip(spans, self.entries, strict=True)]


def _nearest(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((entries * entries).sum(axis=1) - 2 * (rows @ entries.T)).argmin(axis=1)


def learned(rest: np.ndarray, seed: int, part: int = PART, entries: int = ENTRIES) -> Codebooks:
    """Codebooks of a sample of rests, by a few rounds of k-means a part."""
    length = rest.shape[1]
    edges = [*range(0, length, part), length]
    rng = np.random.default_rng(seed)
    books = []
    for a, b in zip(edges, edges[1:], strict=False):
        rows = np.ascontiguousarray(rest[:, a:b])
        book = rows[rng.permutation(len(rows))[:entries]].copy()
        for _ in range(ROUNDS):
            owner = _nearest(rows, book)
            sizes = np.bincount(owner, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, owner, rows)
            used = sizes > 0
            book[used] = sums[used] / sizes[used, None]
        books.append(book)
    return Codebooks(edges, books)


def estimates(tables: list[np.ndarray], base: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Similarities ``[question, vector]``: ``base`` (with the centroid) and one look-up a part."""
    out = np.repeat(base[:, None], len(codes), axis=1)
    for p, table in enumerate(tables):
        out += table[:, codes[:, p]]
    return out
