"""Counting quotient filters of packed word numbers, as numpy arrays in sorted order.

A phrase of up to three words is one key of ``3 * width`` bits. An invertible permutation mixes the
key, so every part of the key space is equally full whatever the phrases are. The permuted key is
cut into bucket, quotient and remainder: the bucket says which filter holds it, the quotient is kept
as run lengths (one bit per entry and one per quotient), the remainder in full. Nothing of the key
is lost, and ``words_of`` brings the word numbers back. Counters take a byte, longer ones eight more.

Keys are two lanes of half the bits each, so that word numbers of up to 42 bits find room.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

LONG_COUNT = 255
#: Odd multipliers of the mixing rounds; any would do.
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class Shape(NamedTuple):
    """Bits of a word number (even) and of a bucket number."""

    width: int
    bucket: int

    @property
    def half(self) -> int:
        return 3 * self.width // 2


class Entries(NamedTuple):
    """Permuted keys in ascending order, each once, with their counts."""

    high: np.ndarray
    low: np.ndarray
    count: np.ndarray


def shape_for(words: int, entries: int, per_bucket: int) -> Shape:
    """Room for word numbers 1 to ``words`` and about ``per_bucket`` of ``entries`` in a bucket."""
    width = max(16, words.bit_length())
    width += width % 2
    if width > 42:
        raise ValueError("more than 2 ** 42 - 1 different frequent words")
    return Shape(width, min(max(0, (max(entries, 1) // per_bucket).bit_length()), 3 * width // 2))


def _mixed(lane: np.ndarray, multiplier: int, half: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        lane = (lane ^ (lane >> np.uint64(29))) * np.uint64(multiplier)
    return (lane ^ (lane >> np.uint64(32))) & np.uint64((1 << half) - 1)


def permuted(first, second, third, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Lanes of the packed and mixed keys; a missing third word is 0."""
    quarter = np.uint64(shape.width // 2)
    width = np.uint64(shape.width)
    first, second, third = (np.asarray(x).astype(np.uint64, copy=False) for x in (first, second, third))
    high = (first << quarter) | (second >> quarter)
    low = ((second & np.uint64((1 << (shape.width // 2)) - 1)) << width) | third
    for i in range(0, len(ROUNDS), 2):
        high ^= _mixed(low, ROUNDS[i], shape.half)
        low ^= _mixed(high, ROUNDS[i + 1], shape.half)
    return high, low


def words_of(high, low, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word numbers of permuted keys."""
    for i in range(len(ROUNDS) - 2, -1, -2):
        low = low ^ _mixed(high, ROUNDS[i + 1], shape.half)
        high = high ^ _mixed(low, ROUNDS[i], shape.half)
    quarter = np.uint64(shape.width // 2)
    within = np.uint64((1 << (shape.width // 2)) - 1)
    second = ((high & within) << quarter) | (low >> np.uint64(shape.width))
    return high >> quarter, second, low & np.uint64((1 << shape.width) - 1)


#: Entries that are merged at once: what sorting them takes besides does not grow with the filters.
RANGE_ENTRIES = 1 << 18


def merged(parts: list[Entries], shape: Shape) -> Entries:
    """One sorted filter of several; counts of equal keys add up."""
    found = list(merged_ranges(parts, shape))
    if len(found) == 1:
        return found[0]
    return Entries(*(np.concatenate(lane) for lane in zip(*found, strict=True)))


def merged_ranges(parts: list[Entries], shape: Shape, bucket: int | None = None) -> Iterator[Entries]:
    """One sorted filter of several, range after range of keys, each about ``RANGE_ENTRIES`` long.

    The permutation fills all ranges equally. Ranges end between buckets; those of the parts of one
    ``bucket`` end within it.
    """
    held = sum(len(p.high) for p in parts)
    room, most, first = shape.half, shape.bucket, 0
    if bucket is not None:
        room, most, first = room - shape.bucket, room - shape.bucket, bucket << (room - shape.bucket)
    bits = min((held // RANGE_ENTRIES).bit_length(), most) if held > RANGE_ENTRIES else 0
    cuts = np.uint64(first) + (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(room - bits))
    edges = [[0, *np.searchsorted(p.high, cuts).tolist(), len(p.high)] for p in parts]
    for r in range(1 << bits):
        yield _merged_at_once(
            [Entries(*(lane[e[r] : e[r + 1]] for lane in p)) for p, e in zip(parts, edges, strict=True)], shape
        )


def _merged_at_once(parts: list[Entries], shape: Shape) -> Entries:
    """The sort merges sorted runs."""
    high = np.concatenate([p.high for p in parts])
    low = np.concatenate([p.low for p in parts])
    count = np.concatenate([p.count for p in parts])
    return counted(high, low, count, shape)


def counted(high: np.ndarray, low: np.ndarray, count: np.ndarray, shape: Shape) -> Entries:
    if not len(high):
        return Entries(high, low, count)
    if 2 * shape.half <= 64:
        order = np.argsort((high << np.uint64(shape.half)) | low, kind="stable")
    else:
        order = np.lexsort((low, high))
    high, low, count = high[order], low[order], count[order]
    new = np.empty(len(high), bool)
    new[0] = True
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    starts = np.flatnonzero(new)
    return Entries(high[starts], low[starts], np.add.reduceat(count, starts))


def _bytes_of(lane: np.ndarray, bits: int) -> bytes:
    return lane.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()


def _lane_of(raw: memoryview, bits: int, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    size = (bits + 7) // 8
    wide[:, :size] = np.frombuffer(raw, np.uint8, n * size).reshape(n, size)
    return wide.view("<u8").reshape(n).astype(np.uint64)


def _sizes(n: int, shape: Shape) -> tuple[int, int]:
    """Bits of quotient and of the remainder's part in the high lane, for a filter of n entries."""
    quotient = min(max(n - 1, 0).bit_length(), shape.half - shape.bucket)
    return quotient, shape.half - shape.bucket - quotient


def packed(entries: Entries, shape: Shape) -> bytes:
    """The filter of one bucket as bytes."""
    n = len(entries.high)
    quotient, rest = _sizes(n, shape)
    within = entries.high & np.uint64((1 << (shape.half - shape.bucket)) - 1)
    slots = (within >> np.uint64(rest)).astype(np.int64)
    runs = np.zeros((1 << quotient) + n, bool)
    runs[slots + np.arange(n)] = True
    long = entries.count >= LONG_COUNT
    return b"".join(
        (
            np.packbits(runs).tobytes(),
            _bytes_of(within & np.uint64((1 << rest) - 1), rest),
            _bytes_of(entries.low, shape.half),
            np.where(long, LONG_COUNT, entries.count).astype(np.uint8).tobytes(),
            entries.count[long].astype("<i8").tobytes(),
        )
    )


def unpacked(raw: bytes, n: int, bucket: int, shape: Shape) -> Entries:
    quotient, rest = _sizes(n, shape)
    view = memoryview(raw)
    size = (((1 << quotient) + n) + 7) // 8
    places = np.flatnonzero(np.unpackbits(np.frombuffer(view[:size], np.uint8)))
    slots = (places - np.arange(n)).astype(np.uint64)
    at = size
    remainder = _lane_of(view[at:], rest, n)
    at += n * ((rest + 7) // 8)
    low = _lane_of(view[at:], shape.half, n)
    at += n * ((shape.half + 7) // 8)
    count = np.frombuffer(view[at : at + n], np.uint8).astype(np.int64)
    long = count == LONG_COUNT
    count[long] = np.frombuffer(view[at + n :], "<i8", int(long.sum()))
    high = (slots << np.uint64(rest)) | remainder
    if shape.bucket:
        high |= np.uint64(bucket << (shape.half - shape.bucket))
    return Entries(high, low, count)


def buckets(entries: Entries, shape: Shape) -> list[tuple[int, Entries]]:
    """The entries cut by bucket, in ascending order, empty ones left out."""
    if not len(entries.high):
        return []
    number = (entries.high >> np.uint64(shape.half - shape.bucket)).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
    return [
        (int(number[a]), Entries(*(lane[a:b] for lane in entries)))
        for a, b in zip(edges, edges[1:], strict=False)
    ]
