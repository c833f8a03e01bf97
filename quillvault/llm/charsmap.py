"""Normalisation by a compiled character map, with the place in the source of every byte.

The map is a trie in a double array and a pool of replacements. At every place of the text the
longest prefix that the trie holds is replaced; where it holds none, one character is copied. White
space may be escaped, squeezed and put before or after the text. ``starts`` records for every byte of
the result where the bytes that it stands for begin in the UTF-8 source, and, last, where they end.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import regex

SPACE = "▁"


class Normalised(NamedTuple):
    text: str
    starts: np.ndarray


class CharsMap:
    """The rules of a compiled map; an empty map has none."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.pool = compiled[4 + size :]
        self.known: dict[bytes, tuple[str, int] | None] = {}

    def longest(self, source: bytes, at: int) -> tuple[str, int] | None:
        """Replacement and length of the longest rule that ``source`` goes on with at ``at``."""
        units = self.units
        if not units:
            return None
        node, found = _child(units[0]), None
        for place in range(at, len(source)):
            node ^= source[place]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != source[place]:
                break
            node ^= _child(unit)
            if unit & 0x100:
                found = units[node] & 0x7FFFFFFF, place + 1 - at
        if found is None:
            return None
        begin, length = found
        return self.pool[begin : self.pool.index(0, begin)].decode("utf-8"), length


def _child(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """As the settings of a model file ask; ``kept`` are strings that no rule may touch."""

    def __init__(
        self,
        compiled: bytes = b"",
        *,
        dummy: bool = True,
        squeeze: bool = True,
        escape: bool = True,
        suffix: bool = False,
        kept: tuple[str, ...] = (),
    ):
        self.map = CharsMap(compiled)
        self.dummy, self.squeeze, self.suffix = dummy, squeeze, suffix
        self.space = SPACE if escape else " "
        by_length = sorted(kept, key=lambda s: len(s.encode()), reverse=True)
        self.kept = regex.compile("|".join(map(regex.escape, by_length))) if kept else None
        self.plain = not self.map.units and not squeeze and escape

    def __call__(self, text: str) -> Normalised:
        if not text:
            return Normalised("", np.zeros(1, np.int32))
        return self._escaped(text) if self.plain else self._mapped(text)

    def _escaped(self, text: str) -> Normalised:
        """Nothing but white space changes: one blank is one byte of the source, three of the result."""
        source = np.frombuffer(text.encode("utf-8"), np.uint8)
        widths = np.where(source == 32, len(SPACE.encode()), 1)
        starts = np.repeat(np.arange(len(source), dtype=np.int32), widths)
        edge = np.zeros(len(SPACE.encode()) if self.dummy else 0, np.int32)
        out, last = text.replace(" ", SPACE), np.full(1, len(source), np.int32)
        if self.dummy and self.suffix:
            return Normalised(out + SPACE, np.concatenate([starts, edge + len(source), last]))
        return Normalised(
            SPACE + out if self.dummy else out, np.concatenate([edge, starts, last])
        )

    def _segments(self, text: str):
        """Source place, source length and replacement of the text, from its beginning."""
        source = text.encode("utf-8")
        kept = {}
        if self.kept:
            at = before = 0
            for m in self.kept.finditer(text):
                at += len(text[before : m.start()].encode())
                kept[at] = m[0]
                at += len(m[0].encode())
                before = m.end()
        place = 0
        while place < len(source):
            if place in kept:
                out, length = kept[place], len(kept[place].encode())
            else:
                rule = self.map.longest(source, place)
                if rule is None:
                    length = char_length(source[place])
                    out = source[place : place + length].decode("utf-8")
                else:
                    out, length = rule
            yield place, length, out
            place += length

    def _mapped(self, text: str) -> Normalised:
        parts: list[tuple[int, str]] = []
        end = 0
        began = False
        squeezed = self.squeeze  # nothing but blanks so far, or a blank before
        for place, length, out in self._segments(text):
            if not began:
                if self.squeeze and out == " ":
                    continue
                began = True
                if self.dummy and not self.suffix:
                    parts.append((place, self.space))
            if squeezed:
                out = out.lstrip(" ")
            if out:
                parts.append((place, out.replace(" ", self.space)))
                squeezed = self.squeeze and out.endswith(" ")
            end = place + length
        while self.squeeze and parts and parts[-1][1].endswith(self.space):
            end, out = parts.pop()
            if out := out.rstrip(self.space):
                parts.append((end, out))
        if began and self.dummy and self.suffix:
            parts.append((end, self.space))
        widths = [len(out.encode()) for _, out in parts]
        starts = np.repeat(np.array([place for place, _ in parts], np.int32), widths)
        return Normalised(
            "".join(out for _, out in parts), np.append(starts, np.int32(end))
        )


def char_length(lead: int) -> int:
    """Bytes of the character that begins with this byte; 0 for a byte within one."""
    if lead < 0x80:
        return 1
    return 0 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
