"""Encoding by the merges of a sentencepiece model, decoding, and the source bytes of every piece.

A text is normalised with ``charsmap``; the best-scored pair of neighbouring pieces is merged until
no pair is a piece. A character that is no piece becomes its bytes where the model has pieces for
them. Lengths of the pieces in the normalised text and the recorded places of its bytes give the
bytes of the source that a piece stands for.

No merge joins two characters that no piece holds side by side, so texts are cut there, merged part by
part, and workers keep the pieces of recent parts. Where they may be cut is read off the model: before
white space, before signs that no piece has after a letter, and after signs that no piece has before one.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain
from math import inf
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_format

from quillvault.llm.bpe import Recent
from quillvault.llm.charsmap import SPACE, Normalised, Normaliser, char_length
from quillvault.llm.tables import map_rows

#: Parts of texts kept by a Python worker.
WORDS = 300_000
#: Parts up to this length are merged by scans, longer ones by a heap, with equal results.
SCANNED = 48
#: Kinds of pieces in a model file (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

class PieceCodec:
    """Encodes and decodes as the model file at ``path`` does; models of merges only."""

    def __init__(self, path: str, words: int = WORDS):
        model = model_format.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, normal = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if trainer.model_type != trainer.BPE or UNUSED in kinds or model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("not a model of merges, or one with unused pieces or a denormaliser")
        user = tuple(p.piece for p in model.pieces if p.type == USER)
        self.normaliser = Normaliser(
            normal.precompiled_charsmap,
            dummy=normal.add_dummy_prefix,
            squeeze=normal.remove_extra_whitespaces,
            escape=normal.escape_whitespaces,
            suffix=trainer.treat_whitespace_as_suffix,
            kept=user,
        )
        self.kept = self.normaliser.kept
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, USER)}
        self.ranks = {p.piece: -p.score for p in model.pieces if p.type in (NORMAL, USER)}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.kinds = [p.type for p in model.pieces]
        self.fallback = trainer.byte_fallback
        self.byte_of = {i: int(p.piece[1:-1], 16) for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        self.shown = [p.piece for p in model.pieces]
        self.shown_ids = list(map(str, range(len(model.pieces))))
        #: Bytes of the normalised text that a piece takes; of byte pieces the place decides.
        self.sizes = np.array([0 if k == BYTE else len(p.encode()) for k, p in zip(self.kinds, self.shown)])
        self.surface = [self._surface(p, trainer.unk_surface) for p in model.pieces]
        self.strips = normal.add_dummy_prefix or normal.remove_extra_whitespaces
        self.strips_all = normal.remove_extra_whitespaces
        self.part = _cuts(self.ids)
        self.recent = Recent(words)

    @staticmethod
    def _surface(piece, unknown: str) -> bytes:
        if piece.type == CONTROL:
            return b""
        if piece.type == UNKNOWN:
            return unknown.encode()
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        return piece.piece.replace(SPACE, " ").encode()

    def pieces(self, part: str) -> tuple[int, ...]:
        """Ids of a part of the normalised text that no merge crosses."""
        found = self.recent.get(part)
        if found is None:
            merges = merged(part, self.ranks)
            try:
                found = tuple([self.ids[p] for p in merges])
            except KeyError:
                found = tuple(chain.from_iterable(map(self._ids, merges)))
            self.recent.put(part, found)
        return found

    def _ids(self, piece: str) -> list[int]:
        number = self.ids.get(piece)
        if number is not None:
            return [number]
        return [self.byte_ids[b] for b in piece.encode()] if self.fallback else [self.unknown]

    def encode(self, text: str) -> Encoding:
        normalised = self.normaliser(text)
        if not self.fallback:
            return self._with_unknown(normalised)
        table, pieces, cut = self.recent.new.get, self.pieces, self.part.findall
        if self.kept is None:
            found = [table(p) or pieces(p) for p in cut(normalised.text)]
        else:
            found = []
            for part, whole in self._around_kept(normalised.text):
                found += [self._ids(part)] if whole else [pieces(p) for p in cut(part)]
        ids = list(chain.from_iterable(found))
        return Encoding(ids, self._lengths(ids), normalised.starts)

    def _around_kept(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in order; True with strings that are pieces by themselves."""
        at = 0
        for m in self.kept.finditer(text) if self.kept else ():
            yield text[at : m.start()], False
            yield m[0], True
            at = m.end()
        yield text[at:], False

    def _lengths(self, ids: list[int]) -> np.ndarray:
        numbers = np.fromiter(ids, np.int64, len(ids))
        lengths = self.sizes[numbers]
        for i in np.flatnonzero(lengths == 0).tolist():  # the last byte stands for the character
            size = char_length(self.byte_of[ids[i]])
            if size:
                lengths[i + size - 1] = size
        return lengths

    def _with_unknown(self, normalised: Normalised) -> Encoding:
        """Without byte pieces: neighbouring characters that are no pieces are one unknown piece."""
        ids: list[int] = []
        lengths: list[int] = []
        for part, whole in self._around_kept(normalised.text):
            parts = [part] if whole else chain.from_iterable(
                merged(p, self.ranks) for p in self.part.findall(part)
            )
            for piece in parts:
                (number,), size = self._ids(piece), len(piece.encode())
                if number == self.unknown and ids and ids[-1] == number:
                    lengths[-1] += size
                else:
                    ids.append(number)
                    lengths.append(size)
        return Encoding(ids, np.array(lengths, np.int64), normalised.starts)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; the blank that was put before the text goes."""
        head, first = b"", 0
        while first < len(ids) and not head and self.kinds[ids[first]] != BYTE:
            number = ids[first]
            first += 1
            head = self.surface[number]
            if self.strips and self.kinds[number] in (NORMAL, USER) and self.shown[number][0] == SPACE:
                head = head[1:]
                if not self.strips_all:
                    break
        raw = head + b"".join(map(self.surface.__getitem__, ids[first:] if first else ids))
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return head.decode("utf-8") + self._decoded_runs(ids[first:])

    def _decoded_runs(self, ids: Sequence[int]) -> str:
        """Byte by byte where runs of byte pieces are no UTF-8: each stray byte is replaced."""
        out, run = [], b""
        for number in ids:
            if self.kinds[number] == BYTE:
                run += self.surface[number]
            else:
                out += [_lenient(run), self.surface[number].decode("utf-8")]
                run = b""
        return "".join([*out, _lenient(run)])


def _lenient(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode("utf-8"))
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


class Encoding(NamedTuple):
    """Ids of a text, the bytes that they take of the normalised text, and where its bytes are from."""

    ids: list[int]
    lengths: np.ndarray
    starts: np.ndarray

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end in the UTF-8 source of every piece."""
        ends = np.cumsum(self.lengths)
        return self.starts[ends - self.lengths], self.starts[ends]


def _cuts(pieces: Iterable[str]) -> re.Pattern:
    """A pattern whose matches are a text in order, cut only where no piece goes on."""
    pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
    if any(b == SPACE != a for a, b in pairs):
        return re.compile(r"(?s).+")
    signs = {c for pair in pairs for c in pair if not c.isalpha() and c != SPACE}
    signs |= set(map(chr, range(128))) - {c for c in map(chr, range(128)) if c.isalpha()}
    # Signs that no piece has after anything but signs and white space, until that is so of all.
    while late := {b for a, b in pairs if b in signs and a not in signs and a != SPACE}:
        signs -= late
    closed = signs - {a for a, b in pairs if b not in signs}
    sign, last = (re.escape("".join(sorted(s))) for s in (signs, closed))
    if not signs or not closed:
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    return re.compile(
        f"{SPACE}*(?:[{sign}]*[{last}](?![{sign}])|[{sign}]*[^{SPACE}{sign}]+|[{sign}]+)|{SPACE}+"
    )


def merged(word: str, ranks: dict[str, float]) -> list[str]:
    """``word`` in pieces after all merges: least rank first, then leftmost."""
    n = len(word)
    if n <= SCANNED:
        return _merged_short(word, ranks)
    end = list(range(1, n + 1))  # of the piece that begins here; 0: none does
    before = list(range(-1, n - 1))
    rank_of = ranks.get
    heap = [
        (rank, i, i + 1, i + 2)
        for i in range(n - 1)
        if (rank := rank_of(word[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end[a] != b or b == n or end[b] != c:
            continue
        end[a], end[b] = c, 0
        if c < n:
            before[c] = a
            if (rank := rank_of(word[a : end[c]])) is not None:
                heapq.heappush(heap, (rank, a, c, end[c]))
        left = before[a]
        if left >= 0 and (rank := rank_of(word[left:c])) is not None:
            heapq.heappush(heap, (rank, left, a, c))
    parts, at = [], 0
    while at < n:
        parts.append(word[at : end[at]])
        at = end[at]
    return parts


def _merged_short(word: str, ranks: dict[str, float]) -> list[str]:
    parts = list(word)
    rank_of = ranks.get
    adjacent = [rank_of(a + b, inf) for a, b in zip(parts, parts[1:], strict=False)]
    while adjacent:
        least = min(adjacent)
        if least == inf:
            break
        i = adjacent.index(least)
        part = parts[i] = parts[i] + parts.pop(i + 1)
        del adjacent[i]
        if i < len(adjacent):
            adjacent[i] = rank_of(part + parts[i + 1], inf)
        if i:
            adjacent[i - 1] = rank_of(parts[i - 1] + part, inf)
    return parts


@lru_cache(maxsize=2)
def piece_codec(path: str, words: int = WORDS) -> PieceCodec:
    return PieceCodec(path, words)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_pieces(documents: DataFrame, path: str, words: int = WORDS) -> DataFrame:
    """``doc_id, pieces, decoded``: the pieces of every text in order, and the text they decode to.

    A piece has ``id, piece, start, end``: bytes ``start`` to ``end`` of the UTF-8 text. ``path`` must
    exist on every executor. A null text counts as empty: no pieces. Repeated rows stay repeated, a
    null doc_id stays null; other columns are not read.
    """

    def make():
        codec = piece_codec(path, words)

        def encoded(doc_id, text) -> Iterable[tuple]:
            encoding = codec.encode(text or "")
            ids = encoding.ids
            starts, ends = (x.tolist() for x in encoding.spans())
            pieces = [
                {"id": i, "piece": codec.shown[i], "start": a, "end": b}
                for i, a, b in zip(ids, starts, ends, strict=True)
            ]
            yield doc_id, pieces, codec.decode(ids)

        return encoded

    schema = (
        "doc_id bigint, pieces array<struct<id: int, piece: string, start: bigint, end: bigint>>, "
        "decoded string"
    )
    return map_rows(documents.select("doc_id", "text"), make, schema, rows=50)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids`` (array of numbers); null ids decode to an empty text."""

    def make():
        codec = piece_codec(path)
        return lambda doc_id, ids: [(doc_id, codec.decode([int(i) for i in ids or ()]))]

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id bigint, text string", rows=500)


def piece_digests(documents: DataFrame, path: str, words: int = WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_spans, span_bytes`` of every row.

    ``n_spans`` pieces stand for at least one byte of the source, ``span_bytes`` bytes in all. Rows
    as in ``encode_pieces``.
    """

    def make():
        codec = piece_codec(path, words)

        def digests(doc_id, text) -> Iterable[tuple]:
            encoding = codec.encode(text or "")
            ids = encoding.ids
            starts, ends = encoding.spans()
            widths = ends - starts
            shown = codec.shown_ids
            yield (
                doc_id,
                len(ids),
                _digest(",".join([shown[i] for i in ids])),
                _digest(codec.decode(ids)),
                int(np.count_nonzero(widths)),
                int(widths.sum()),
            )

        return digests

    schema = (
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
        "n_spans bigint, span_bytes bigint"
    )
    return map_rows(documents.select("doc_id", "text"), make, schema, rows=500)
