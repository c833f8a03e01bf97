from __future__ import annotations

import pytest

from quillvault.llm.licence_texts import TEMPLATES
from quillvault.llm.licences import licence_scan, licences_in


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_template_in_prose(name, prose):
    text = prose(1, 200) + "\n" + TEMPLATES[name] + "\n" + prose(2, 300)
    found = licences_in(text)
    assert [(f[0], f[4], f[5]) for f in found] == [(name, 0, 0)]
    start, end = found[0][1:3]
    assert TEMPLATES[name].startswith(text[start : start + 12]) and text[start:end].rstrip(".\"") in TEMPLATES[name]


@pytest.mark.parametrize("name", ["MIT", "BSD-3-Clause", "Apache-2.0 notice", "GPL-3.0 notice", "ISC"])
def test_changed_wording_is_counted(name, prose):
    words = TEMPLATES[name].split(" ")
    words[20] = "otherwise"
    words[30:30] = ["one", "more"]
    found = licences_in(prose(3, 40) + " " + " ".join(words) + " " + prose(4, 40))
    assert [f[0] for f in found] == [name]
    assert 1 <= found[0][4] <= 2 and 2 <= found[0][5] <= 4


def test_cue_words_alone_are_no_licence(prose):
    text = prose(5, 50) + " a licence to sail, without warranty, by permission of the owner " + prose(6, 50)
    assert licences_in(text) == []


def test_several_in_one_text(prose):
    lines = ["MIT line", "CC-BY-NC-4.0 line", "MIT line", "GPL-3.0 line"]
    text = "\n".join(prose(i, 80) + "\n" + TEMPLATES[n] for i, n in enumerate(lines))
    assert [f[0] for f in licences_in(text)] == lines
    close = "\n".join(TEMPLATES[n] for n in lines)
    assert [f[0] for f in licences_in(close)] == lines


def test_rows(documents, rows_of, prose):
    mit = TEMPLATES["MIT line"]
    df = documents([(1, mit), (1, mit), (2, None), (3, ""), (None, mit), (4, "license " * 40000), (5, prose(1, 20000) + ' ' + mit)])
    got = rows_of(licence_scan(df))
    assert [r[0] for r in got] == [1, 1, 5, None] and all(r[1] == "MIT line" for r in got)
    assert licence_scan(documents([])).count() == 0


def test_wrong_place_with_a_longer_run_hides_no_right_one(prose):
    holder = "THE COPYRIGHT HOLDER"
    bsd2 = TEMPLATES["BSD-2-Clause"]
    named = bsd2.replace(holder + "S", holder).replace(holder, "MERIDIAN PRESS")
    assert named != bsd2
    alone = [f[0] for f in licences_in(prose(7, 40) + "\n" + named)]
    assert alone == ["BSD-2-Clause"]
    for pair in ([TEMPLATES["BSD-3-Clause"], named], [named, TEMPLATES["BSD-3-Clause"]]):
        want = ["BSD-3-Clause", "BSD-2-Clause"] if pair[1] is named else ["BSD-2-Clause", "BSD-3-Clause"]
        assert [f[0] for f in licences_in(prose(8, 40) + "\n" + "\n\n".join(pair) + "\n" + prose(9, 40))] == want
