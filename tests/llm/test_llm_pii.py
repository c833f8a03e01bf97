from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import exp, log

import pytest

from quillvault.llm import pii
from quillvault.llm.pii import base_spans, joined, luhn, mask, mask_personal_data, personal_data, runs_between

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = "".join(c for c in m[0] if c.isdigit())
            ok = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(FORMS).index(s[0])))


TEXTS = [
    "a.b@c.de, x@y @z@w.q a@b.c@d.e .@-.-", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 00010.0.0.1 1.2.3", "+49 (30) 1234-5678 +1 2 +12345678901234567",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 11111111111111", "é 🙂 me@ho.st 10.0.0.1", "12345678901.1.1.1 +1+2 345 678 901 2",
    "a@b@c.d.e@f", "%@%.% a@b-.c-", "", "+1 " + "0" * 30, "4" * 400,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_forms(text):
    assert base_spans(text) == plain(text)


def test_hostile_texts_take_linear_time():
    for piece in ("a", "1", "1.", "+1 ", "@", "a@", "1 ", "(+1"):
        base_spans(piece * 200_000)


def contact(i, told=True):
    return f"Please {'write' if i % 2 else 'send'} the form. account holder {'4111 1111 1111 1111' if told else ''} thanks {i}"


def corpus():
    seeds = ["4111111111111111", "5500005555555559", "340000000000009", "30000000000004", "6011000000000004"]
    rows = [(i, f"some words before customer card {seeds[i % 5]} was charged today in town {i}") for i in range(40)]
    rows += [(100, "other words and customer card AB-9912345 was charged twice")]
    rows += [(101, "again AB-9912345, in the middle of other words")]
    rows += [(200 + i, f"in the year of {1900 + i}00 we met people at ten") for i in range(30)]
    rows += [(300, "it was in the year of 4111111111111111 again")]
    return rows


def test_contexts_find_an_unseen_identifier(documents):
    got = {r.doc_id: r for r in personal_data(documents(corpus())).collect()}
    a, b = dict(corpus())[100], dict(corpus())[101]
    s, t = a.index("AB-99"), b.index("AB-99")
    assert got[100].spans == f"card:{s}:{s + 10}" and got[101].spans == f"card:{t}:{t + 10}"
    assert got[100].n_card == 0 and got[100].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].n_card == 1
    assert all(got[200 + i].spans == "" for i in range(30))


def test_rows(documents):
    text = "mail a@b.c and a@b.c, ip 10.0.0.1; +49 30 1234567"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "word " * 50000 + "x@y.z")]
    got = personal_data(documents(rows)).collect()
    assert len(got) == 6
    for r in got:
        if r.doc_id in (1, None):
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (2, 1, 0, 1)
            assert r.spans == joined(plain(text))
            assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
        elif r.doc_id in (2, 3):
            assert r.spans == "" and r.n_email == 0
        else:
            assert r.spans == "email:250000:250005"
    assert personal_data(documents([])).count() == 0


def test_masking(documents):
    df = documents([*corpus(), (400, "a@b.c"), (401, None), (None, "none here"), (400, "a@b.c")])
    got = mask_personal_data(df)
    assert got.columns == df.columns
    texts = [(r.doc_id, r.text) for r in got.collect()]
    assert all(r[c] == "theirs" for r in got.collect() for c in df.columns[2:])
    assert len(texts) == df.count() and texts.count((400, "[EMAIL]")) == 2
    assert dict(texts)[100] == "other words and customer card [CARD] was charged twice"
    assert dict(texts)[401] is None and (None, "none here") in texts


def test_mask_of_overlapping_spans():
    spans = [{"start": 1, "end": 4, "kind": "ip"}, {"start": 2, "end": 6, "kind": "card"}, {"start": 7, "end": 8, "kind": "email"}]
    assert mask("0123456789", spans) == "0[IP]6[EMAIL]89"


def with_blanks():
    cards = ["4111 1111 1111 1111", "5500 0055 5555 5559", "6011 0000 0000 0004"]
    rows = [(i, f"please ring desk +1 202 555 01{i:02d} before noon {i}") for i in range(30)]
    rows += [(100 + i, f"the customer card {cards[i % 3]} was charged {i}") for i in range(30)]
    new = {
        200: ("please ring desk ", "phone", "555 123 4567", " before noon"),
        201: ("my office desk ", "phone", "(020) 7946 0018", ", before noon"),
        202: ("the customer card ", "card", "4111 1111 1111 1112", " was charged"),
        203: ("please ring desk ", "phone", "5551234 567", " at ten"),
    }
    rows += [(i, before + number + after) for i, (before, _, number, after) in new.items()]
    return [*rows, (300, "in all they sold 300 400 500 pieces"), (301, "then 555 123 4567. Or not")], new


def test_contexts_find_identifiers_with_blanks(documents):
    rows, new = with_blanks()
    got = {r.doc_id: r.spans for r in personal_data(documents(rows)).collect()}
    for i, (before, kind, number, _) in new.items():
        assert got[i] == f"{kind}:{len(before)}:{len(before) + len(number)}"
    assert got[300] == "" and got[301] == "phone:5:17"
    assert got[5] == "phone:17:32" and got[100] == "card:18:37"


def test_masking_of_identifiers_with_blanks(documents):
    rows, new = with_blanks()
    got = {r.doc_id: r.text for r in mask_personal_data(documents(rows)).collect()}
    for i, (before, kind, _, after) in new.items():
        assert got[i] == f"{before}[{kind.upper()}]{after}"
    assert got[300] == rows[-2][1] and got[301] == "then [PHONE]. Or not"


def test_hostile_runs_of_numbers_take_linear_time():
    for piece in ("1 2 ", "1 1a ", "1-1", "(", "1) ", "1.1 ", "+1 "):
        runs_between(piece * 100_000, [])


EDGES = " \t\r\n.,;:!?\"'()[]{}<>|*#%&$"


def by_rounds(rows):
    """Spans of all rows by plain Python: one list of words a text, everything counted in full."""
    graph, places, listed = defaultdict(Counter), Counter(), []
    for _, text in rows:
        text = text or ""
        spots = [m.span() for m in re.finditer(r"\S+", text)]
        words = [text[a:b].strip(EDGES).lower() for a, b in spots]
        word = dict(enumerate(words)).get

        def patterns(i, j):
            two, one, after = word(i - 2, ""), word(i - 1, ""), word(j + 1, "")
            return [("b", two, one)] * bool(two and one) + [("a", one, after)] * bool(one and after)

        base = plain(text)
        taken = {k for _, a, b in base for k in range(a, b)}
        spans = [*base]
        for a, b in spots:
            w = text[a:b].strip(EDGES)
            x = a + text[a:b].find(w)
            likely = len(w) >= 6 and ("@" in w or sum(c in "0123456789" for c in w) >= 4)
            if likely and not taken & set(range(x, x + len(w))):
                spans.append((None, x, x + len(w)))
        spans += [(None, a, b) for a, b in runs_between(text, base)]
        at = Counter()
        for i in range(len(words)):
            at.update((p, i, i) for p in patterns(i, i))
        seen = Counter()
        for kind, a, b in spans:
            i = max(k for k, (x, _) in enumerate(spots) if x <= a)
            j = max(k for k, (x, _) in enumerate(spots) if x <= b - 1)
            for p in patterns(i, j):
                graph[p][text[a:b].lower(), kind] += 1
                # A place is where the pattern's words are; several identifiers there are several.
                place = (p, i, i if p[0] == "b" else j)
                seen[place] += 1
            listed.append((len(listed), kind, a, b))
        for place in at.keys() | seen.keys():
            several = place[0][0] == "a" and place[2] > place[1]
            places[place[0]] += seen[place] if several else max(at[place], seen[place])
    weight = {}
    for _ in range(pii.ROUNDS):
        chance = defaultdict(float)
        for p, members in graph.items():
            for kind in FORMS:
                known = [
                    n * (1.0 if k else weight.get((x, kind), 0.0))
                    for (x, k), n in members.items()
                    if k == kind or (k is None and (x, kind) in weight)
                ]
                if len(known) >= pii.SEEDS and sum(known) / places[p] >= pii.STRONG:
                    share = min(1.0, sum(known) / places[p])
                    for x, k in members:
                        if k is None:
                            chance[x, kind] += log(1.000001 - share)
        weight = {key: 1 - exp(v) for key, v in chance.items() if 1 - exp(v) >= pii.STRONG}
    kind_of = {}
    for (x, kind), w in weight.items():
        kind_of[x] = max(kind_of.get(x, (0.0, "")), (w, kind))
    out = []
    for i, text in rows:
        text = text or ""
        base = plain(text)
        taken = {k for _, a, b in base for k in range(a, b)}
        more = [(a, b) for a, b in runs_between(text, base)]
        for a, b in [m.span() for m in re.finditer(r"\S+", text)]:
            w = text[a:b].strip(EDGES)
            x = a + text[a:b].find(w)
            likely = len(w) >= 6 and ("@" in w or sum(c in "0123456789" for c in w) >= 4)
            if likely and not taken & set(range(x, x + len(w))):
                more.append((x, x + len(w)))
        reach = -1
        for a, b in sorted(more, key=lambda s: (s[0], -s[1])):
            if text[a:b].lower() in kind_of and b > reach:
                base.append((kind_of[text[a:b].lower()][1], a, b))
                reach = b
        out.append((i, joined(sorted(base, key=lambda s: (s[1], list(FORMS).index(s[0]))))))
    return sorted(out, key=repr)


def letters(seed, n=160):
    """Texts of a few templates, some of them only sometimes about identifiers."""
    rnd = random.Random(seed)
    cards = ["4111 1111 1111 1111", "5500005555555559", "340000000000009", "3000-0000-0000-04"]
    forms = {
        "card": lambda: rnd.choice([*cards, *cards, f"AB-{rnd.randint(1000, 1012)}X", "4111 1111 1111 1112"]),
        "ip": lambda: rnd.choice(["10.0.0.1", "10.0.0.2", "192.168.1.7", f"node-{rnd.randint(0, 5)}0001"]),
        "mail": lambda: rnd.choice(["a@b.cc", "x.y@z.org,u@v.org", "me@localhost", "_ _"]),
        "phone": lambda: rnd.choice(["+49 30 1234567", "(020) 7946 0018", "555 123 4567", "+1 202 555 0199"]),
    }
    lines = [
        "the customer card {card} was charged", "my card is {card}, thanks", "log in to {ip} at once",
        "host address {ip}; up", "write to {mail} today", "_ _ {mail} _", "ring desk {phone} before noon",
        "call me {phone}", "in the year of 199900 we met", "the customer card was lost", "w" * 90 + " {ip} " + "v" * 80,
        "\u2003pay\xa0with {card}\x1dnow", "id " + "9" * 70 + " end",
    ]
    out = []
    for i in range(n):
        text = rnd.choice([" ", "\n", ".  "]).join(rnd.choices(lines, k=rnd.randint(1, 4)))
        out.append((i, text.format(**{k: f() for k, f in forms.items()})))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rounds_as_plain_python(documents, seed):
    rows = [*letters(seed), (900, None), (901, "")]
    want = by_rounds(rows)
    got = [(r.doc_id, r.spans) for r in personal_data(documents(rows)).collect()]
    assert sorted(got, key=repr) == want
    added = sum(s.count(":") // 2 - len(plain(t or "")) for (_, s), (_, t) in zip(want, sorted(rows, key=repr)))
    assert added > 5  # the rounds do find something


@pytest.mark.parametrize("gap, length", [(1, 1029), (1, 1506), (260, 5), (405, 5), (3000, 70)])
def test_long_words_and_gaps_are_one_context(documents, gap, length):
    """A long word or a long run of blanks beside a place is the same for edges and for totals."""
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "30000000000004"]
    word, gap = "w" * length, " " * gap
    rows = [(i, f"{word}{gap}{cards[i % 4]}{gap}{word}") for i in range(12)]
    rows += [(50, f"{word}{gap}AB-123456{gap}{word}")]
    got = dict((r.doc_id, r.spans) for r in personal_data(documents(rows)).collect())
    start = rows[-1][1].index("AB-")
    assert got[50] == f"card:{start}:{start + 9}"


def test_identifiers_of_any_length(documents):
    long = "AB-" + "7" * 200
    rows = [(i, f"customer card {c} was charged") for i, c in enumerate(
        ["4111111111111111", "5500005555555559", "340000000000009"] * 4)] + [(50, f"customer card {long} was charged")]
    got = dict((r.doc_id, r.spans) for r in personal_data(documents(rows)).collect())
    assert got[50] == f"card:14:{14 + len(long)}"


def test_hostile_words_take_linear_time():
    for piece in ("a", "1", "1a", "@", "a@b.cc,", "1 ", "é"):
        text = piece * 200_000
        pii.occurrences(text, base_spans(text))
