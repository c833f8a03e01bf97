"""What the two byte-pair vocabularies have in common: alphabet, files, white space."""

from __future__ import annotations

import json
from functools import lru_cache

#: Unicode white space as the tokenizers' patterns see it (fixed value).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"



@lru_cache(maxsize=1)
def alphabet() -> list[str]:
    """Byte -> visible character: printable Latin-1 stands for itself, the rest follows from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]], list[tuple[str, int]]]:
    """Tokens with ids, merges in order of rank, and added tokens with ids."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    merges = [
        tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in stored["model"]["merges"]
    ]
    added = [(t["content"], t["id"]) for t in stored["added_tokens"]]
    return stored["model"]["vocab"], merges, added


@lru_cache(maxsize=1)
def _ascii() -> dict[int, str]:
    return dict(enumerate(alphabet()[:128]))


def visible(text: str) -> str:
    """The UTF-8 bytes of ``text``, each as its visible character."""
    if text.isascii():
        return text.translate(_ascii())
    signs = alphabet()
    return "".join([signs[b] for b in text.encode("utf-8")])
