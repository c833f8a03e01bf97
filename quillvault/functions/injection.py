"""Prompt-injection scoring of untrusted text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvault import fixed_values as fv
from quillvault.functions.barrier import settled
from quillvault.functions.text import nfkc


# Lower-case literals of which a text must hold one before a pattern can match: a substring
# search is much cheaper than the regex and settles most texts.
_HINTS = {
    "template_tokens": ("<|", "inst]", "sys>>"),
    "ignore_instructions": ("ignore", "disregard", "forget", "override", "bypass"),
    "reveal_prompt": ("prompt", "instructions", "rules"),
    "role_reassignment": ("system", "assistant", "user"),
    "new_identity": ("now", "act", "pretend", "persona"),
    "jailbreak_known": ("anything", "mode"),
    "exfiltration_hint": ("send", "post", "upload", "exfiltrate", "transmit"),
    "dangerous_scheme": ("javascript:", "data:text/html"),
}
# Letters that match an ASCII "i" when case is ignored but do not lower-case to one.
_ODD_LETTERS = ("ı", "İ")


def _flag(name: str, pattern: str) -> str:
    found = f"rlike(_clean, r'{pattern}')"
    hints = [f"contains(_lower, '{hint}')" for hint in _HINTS.get(name, ())]
    return f"({' OR '.join([*hints, '_odd'])}) AND {found}" if hints else found


def with_injection_score(
    df: DataFrame, text: str, score: str = "score", reasons: str = "reasons"
) -> DataFrame:
    """Add the capped sum of the weights of all signals found, and their names in table order.

    Invisible characters are counted on the text as given; the patterns look at its NFKC form
    without them, so that neither full-width letters nor split words hide a phrase.
    """
    given = [f"`{c}`" for c in df.columns]
    df = df.withColumn("_folded", nfkc(F.col(text))).selectExpr(
        "*",
        f"CASE WHEN octet_length({text}) > length({text}) AND rlike({text}, r'{fv.INVISIBLE}') "
        f"THEN regexp_count({text}, r'{fv.INVISIBLE}') ELSE 0 END AS _invisible",
    )
    df = df.selectExpr(
        "*",
        f"CASE WHEN _invisible > 0 THEN regexp_replace(_folded, r'{fv.INVISIBLE}', '') "
        "ELSE _folded END AS _clean",
    )
    odd = " OR ".join(f"contains(_clean, '{ch}')" for ch in _ODD_LETTERS)
    df = df.selectExpr("*", "lower(_clean) AS _lower", f"{odd} AS _odd")
    df = df.selectExpr(
        *given,
        "_invisible",
        *[f"{_flag(name, pattern)} AS _is_{name}" for name, _, pattern in fv.INJECTION_PATTERNS],
    )
    total = f"CASE WHEN _invisible > 0 THEN {fv.INVISIBLE_WEIGHT}D ELSE 0D END" + "".join(
        f" + CASE WHEN _is_{name} THEN {weight}D ELSE 0D END"
        for name, weight, _ in fv.INJECTION_PATTERNS
    )
    labels = ["CASE WHEN _invisible > 0 THEN concat('invisible_chars:', _invisible) END"] + [
        f"CASE WHEN _is_{name} THEN '{name}' END" for name, _, _ in fv.INJECTION_PATTERNS
    ]
    df = df.selectExpr(
        *given,
        f"least(1.0D, round({total}, 6)) AS {score}",
        f"array_compact(array({', '.join(labels)})) AS {reasons}",
    )
    return settled(df, score, reasons)
