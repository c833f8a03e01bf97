"""Exact token counts at every prefix of a text, by dynamic programming over last tokens.

For every prefix of a piece the table holds the last token of the prefix's encoding and the number
of its tokens. A token may follow another exactly when encoding the two together leaves both as
they are, and an encoding is the one sequence whose neighbours may all follow each other. So the
last token of a prefix is the one token that ends there and may follow the last token of the
prefix before it. The count of any prefix, the cut for any budget and the total are then lookups.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import regex
from pyspark.sql import DataFrame

from quillvault.llm.bpe import KEPT_CHARS, merged_bounds
from quillvault.llm.byte_level import SPACE, visible, vocabulary
from quillvault.llm.tables import map_rows

#: Entries kept per Python worker in each table; a full table is emptied.
PIECES = 1_000_000
PAIRS = 1_500_000

#: Fixed value: how the vocabulary cuts text into pieces.
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^S\p{L}\p{N}]+|[S]+(?![^S])|[S]+".replace(
        "[S]", f"[{SPACE}]"
    ).replace("[^S", f"[^{SPACE}"),
    regex.V0,
)


class Totals(dict):
    """Piece -> number of tokens, from the piece's prefix table."""

    def __init__(self, prefixes):
        self.prefixes = prefixes

    def __missing__(self, piece: str) -> int:
        found = self.prefixes(visible(piece))[-1]
        if len(piece) <= KEPT_CHARS:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = found
        return found


class PrefixCounter:
    """Prefix tables of pieces, and counts, budgets and cuts of whole texts."""

    def __init__(self, path: str):
        ids, merges, added = vocabulary(path)
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.special = regex.compile("|".join(regex.escape(t) for t, _ in added))
        self.first = [t[:2] for t, _ in added]
        # All tokens that end at a place come from one automaton; 0 stands for no token.
        self.tokens = ["", *ids]
        self.ending = ahocorasick.Automaton()
        for number, token in enumerate(self.tokens[1:], 1):
            self.ending.add_word(token, (len(token), number))
        self.ending.make_automaton()
        self.follows: dict[int, bool] = {}
        self.totals = Totals(self.prefixes)
        self.last: TextPrefixes | None = None

    def may_follow(self, last: int, token: int) -> bool:
        """Whether encoding the two together leaves both as they are."""
        before, after = self.tokens[last], self.tokens[token]
        text = before + after
        bounds = merged_bounds(text, list(text), self.ranks)
        found = bounds == ([0, len(before), len(text)] if last else [0, len(text)])
        if len(self.follows) >= PAIRS:
            self.follows.clear()
        self.follows[last << 20 | token] = found
        return found

    def prefixes(self, shown: str) -> list[int]:
        """Token count of every prefix of one piece; index is the number of bytes."""
        counts = [0] * (len(shown) + 1)
        last = [0] * (len(shown) + 1)
        known, may_follow = self.follows.get, self.may_follow
        for end, (length, token) in self.ending.iter(shown):
            end += 1
            if counts[end]:
                continue
            start = end - length
            before = last[start]
            follows = known(before << 20 | token)
            if follows or follows is None and may_follow(before, token):
                last[end] = token
                counts[end] = counts[start] + 1
        return counts

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """Plain text and special tokens in turn, with a mark for the special ones."""
        if not any(f in text for f in self.first) or not self.special.search(text):
            return [(text, False)]
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [(text[at : m.start()], False), (m[0], True)]
            at = m.end()
        return [*out, (text[at:], False)]

    def count(self, text: str) -> int:
        total_of = self.totals.__getitem__
        return sum(
            1 if special else sum(map(total_of, PIECE.findall(part)))
            for part, special in self.segments(text)
        )

    def count_at(self, text: str, chars: int) -> int:
        """Tokens of the first ``chars`` characters, from the tables of the text."""
        if self.last is None or self.last.text != text:
            self.last = TextPrefixes(self, text)
        return self.last.count_at(chars)

    def pieces(self, text: str) -> Iterator[tuple[str, int, bool]]:
        """Pieces and special tokens in order with their token counts, as far as asked for."""
        for part, special in self.segments(text):
            if special:
                yield part, 1, True
            else:
                for m in PIECE.finditer(part):
                    yield m[0], self.totals[m[0]], False

    def table(self, text: str) -> list[tuple[int, int]]:
        """(characters, tokens) at the end of every piece and special token."""
        out, chars, tokens = [], 0, 0
        for piece, n, _ in self.pieces(text):
            chars, tokens = chars + len(piece), tokens + n
            out.append((chars, tokens))
        return out

    def fit(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens.

        Whole pieces are counted from their totals. Only the piece in which the budget runs out is
        looked at prefix by prefix; a cut piece stands for itself, since a piece never depends on
        what follows it but for runs of blanks and apostrophes, which are cut again.
        """
        at = used = 0
        for piece, n, special in self.pieces(text):
            if used + n > budget:
                return at + self._fit_piece(piece, special, budget - used)
            at, used = at + len(piece), used + n
        return at

    def _fit_piece(self, piece: str, special: bool, budget: int) -> int:
        if not special and piece[0] != "'":
            counts = self.prefixes(visible(piece))
            ends = [0, *accumulate(len(c.encode("utf-8")) for c in piece)]
            return max(n for n, end in enumerate(ends) if counts[end] <= budget)
        return next(
            (n for n in range(len(piece) - 1, 0, -1) if self.count(piece[:n]) <= budget), 0
        )


class TextPrefixes:
    """Token counts of all prefixes of one text: sums at its pieces, and tables of pieces that are cut.

    A piece never depends on what follows it but for white space, apostrophes and special tokens;
    where one of these is cut, the text from the piece before on is counted anew.
    """

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        self.found = []
        self.ends = [0]
        self.sums = [0]
        for piece, n, special in counter.pieces(text):
            self.found.append((piece, special))
            self.ends.append(self.ends[-1] + len(piece))
            self.sums.append(self.sums[-1] + n)

    def count_at(self, chars: int) -> int:
        i = bisect_left(self.ends, chars)
        if i == len(self.ends):
            return self.sums[-1]
        if self.ends[i] == chars and not (i and self.found[i - 1][0].isspace()):
            return self.sums[i]
        cut = i - 1
        piece, special = self.found[cut]
        head = self.text[self.ends[cut] : chars]
        if special or piece[0] == "'" or head.isspace():
            before = max(0, cut - 1)
            return self.sums[before] + self.counter.count(self.text[self.ends[before] : chars])
        return self.sums[cut] + self.counter.prefixes(visible(piece))[len(head.encode("utf-8"))]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(documents: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` of every row of ``documents``.

    ``fit_chars`` is the longest prefix within ``limit`` tokens. A null text counts as empty (no
    bytes, no tokens). Repeated rows stay repeated, a null doc_id stays null; other columns are
    not read. ``path`` must exist on every executor.
    """

    def make():
        tables = counter(path)

        def one(doc_id, text):
            text = text or ""
            n = tables.count(text)
            fits = len(text) if n <= limit else tables.fit(text, limit)
            return [(doc_id, len(text.encode("utf-8")), n, n > limit, fits)]

        return one

    return map_rows(
        documents.select("doc_id", "text"),
        make,
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint",
    )
