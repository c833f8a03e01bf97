"""Licence texts in documents, by conditional compression.

Passages around cue words are candidate blocks. A block is compressed by zstandard alone and with each
template as a raw dictionary; what a template knows of the block needs no bytes. Templates are
ranked by the bytes they save, relative to their own compressed size, and a winner must stand the
comparison of exact wording: its words are aligned with the block's, and the words that are
missing, and those in between that are not the template's, are counted.

Work is per document, so there is no shuffle and no group that could grow.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import zstandard
from pyspark.sql import DataFrame

from quillvault.llm.licence_texts import TEMPLATES
from quillvault.llm.tables import map_rows

CUE = re.compile(
    r"(?i)licen[sc]e|copyright|warrant|permission|redistribut|public domain|creative commons|"
    r"free software|\bCC0\b|\bCC BY"
)
WORD = re.compile(r"[A-Za-z0-9]+(?:[.'/-][A-Za-z0-9]+)*")
LEVEL = 3
#: Share of a template's own compressed size that it has to save.
SAVED = 0.15
#: Words that may be missing, and be put in between, per word of the template.
DIFFERENT = 0.1


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.raw = text.encode()
        self.words = [m[0].lower() for m in WORD.finditer(text)]
        self.chars = len(text)
        dictionary = zstandard.ZstdCompressionDict(
            self.raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.with_template = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        self.size = len(zstandard.ZstdCompressor(level=LEVEL).compress(self.raw))


@lru_cache(maxsize=1)
def templates() -> dict[int, list[Template]]:
    """Templates by the reach of their blocks: surroundings much longer than a template would
    drown what it saves."""
    made = [Template(name, text) for name, text in TEMPLATES.items()]
    longest = max(t.chars for t in made)
    out: dict[int, list[Template]] = {}
    for t in made:
        reach = next(r for r in (120, 480, 5 * longest // 4) if t.chars <= r)
        out.setdefault(reach, []).append(t)
    return out


def blocks(text: str, reach: int) -> Iterator[tuple[int, int]]:
    """Ranges around cues; every passage of up to ``reach`` characters with a cue is within one.

    Overlapping ranges are one, and long ones are cut into pieces that overlap by ``2 * reach``.
    """
    start = end = None
    found = []
    for m in CUE.finditer(text):
        a, b = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if end is not None and a <= end:
            end = b
        else:
            if end is not None:
                found.append((start, end))
            start, end = a, b
    if end is not None:
        found.append((start, end))
    for start, end in found:
        while end - start > 6 * reach:
            yield start, start + 6 * reach
            start += 4 * reach
        yield start, end


def aligned(template: list[str], words: list[str], at: int) -> tuple[int, int, int, int] | None:
    """(first word, end, missing, extra) of ``template`` in ``words`` if it starts at about ``at``."""
    slack = 1 + len(template) // 5
    low = max(0, at - slack)
    high = min(len(words), at + len(template) + slack)
    part = words[low:high]
    same = [b for b in SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks() if b.size]
    if not same:
        return None
    first, end = same[0].b, same[-1].b + same[-1].size
    shared = sum(b.size for b in same)
    return low + first, low + end, len(template) - shared, end - first - shared


def confirmed(template: list[str], words: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """(first word, end, missing, extra) of every place that stands the comparison of wording.

    Equal runs are tried from the longest down to the least that such a place has, since every
    missing or extra word cuts it at most once more. A run that leads nowhere is not tried again, but
    its words still count for other places.
    """
    limit = DIFFERENT * len(template)
    least = max(1, -(-(len(template) - int(limit)) // (2 * int(limit) + 1)))
    wanted = Counter(template)
    rest, tried = list(words), list(words)
    while (wanted & Counter(rest)).total() >= len(template) - limit:
        run = SequenceMatcher(None, template, tried, autojunk=False).find_longest_match()
        if run.size < least:
            return
        same = template[run.a : run.a + run.size]
        for a in range(run.a, len(template) - run.size + 1):
            if template[a : a + run.size] != same:
                continue
            found = aligned(template, rest, run.b - a)
            if found and max(found[2:]) <= limit:
                first, end = found[:2]
                yield found
                # The same licence may stand in the block again.
                rest[first:end] = tried[first:end] = [""] * (end - first)
                break
        tried[run.b : run.b + run.size] = [""] * run.size


def in_block(block: str, known: list[Template]) -> list[tuple[str, int, int, float, int, int, int]]:
    """(licence, start, end, saved, missing, extra, agreeing words) of all confirmed templates."""
    raw = block.encode("utf-8", "surrogatepass")
    alone = len(zstandard.ZstdCompressor(level=LEVEL).compress(raw))
    ranked = []
    for t in known:
        saved = alone - len(t.with_template.compress(raw))
        if saved >= SAVED * t.size:
            ranked.append((saved, t))
    if not ranked:
        return []
    places = list(WORD.finditer(block))
    words = [m[0].lower() for m in places]
    out = []
    for saved, t in sorted(ranked, key=lambda r: (-r[0], r[1].name)):
        for first, end, missing, extra in confirmed(t.words, words):
            a, b = places[first].start(), places[end - 1].end()
            agreeing = len(t.words) - 2 * missing - extra
            out.append((t.name, a, b, saved / t.size, missing, extra, agreeing))
    return out


def licences_in(text: str) -> list[tuple[str, int, int, float, int, int]]:
    """All licences of a text by place. Of overlapping ones the best worded counts: most words of
    the template in common, less those that differ."""
    if not CUE.search(text):
        return []
    found = {}
    for reach, known in templates().items():
        for start, end in blocks(text, reach):
            for name, a, b, saved, *words in in_block(text[start:end], known):
                found.setdefault((start + a, start + b, name), (saved, *words))
    out: list[tuple[str, int, int, float, int, int]] = []
    for (a, b, name), (saved, missing, extra, _) in sorted(
        found.items(), key=lambda x: (-x[1][3], x[0])
    ):
        if not any(a < y and x < b for _, x, y, *_ in out):
            out.append((name, a, b, saved, missing, extra))
    return sorted(out, key=lambda r: (r[1], r[2]))


def licence_scan(documents: DataFrame) -> DataFrame:
    """``doc_id, licence, start, end, saved, missing, extra``: one row per licence passage.

    Offsets count code points; ``saved`` is the size reduction relative to the template's own
    compressed size, ``missing`` and ``extra`` count differing words. Null and empty texts give no
    row. Repeated rows give repeated results, a null doc_id stays null; other columns are not read.
    """

    def make():
        return lambda doc_id, text: [
            (doc_id, name, a, b, saved, missing, extra)
            for name, a, b, saved, missing, extra in licences_in(text or "")
        ]

    return map_rows(
        documents.select("doc_id", "text"),
        make,
        "doc_id bigint, licence string, start bigint, end bigint, saved double, "
        "missing bigint, extra bigint",
    )
