"""Pieces, spans, decoding and normalisation against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_format
from sentencepiece import sentencepiece_pb2

from quillvault.llm.charsmap import Normaliser
from quillvault.llm.pieces import PieceCodec, decode_pieces, encode_pieces, piece_digests

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = list("abXYZ \t\n\r  \x1c\x85\xa0 éΣßﬁﬃ①ＡｂＣ½㌔Å中文한グ゛é🙂²٣_-.,!?'\"<|>\x00▁�") + [
    "the ", "ing", "▁the", "  ", "    ", "<0x41>", "<s>", "</s>", "<unk>", "ation", "Straße ", "ẛ̣", "한",
]


def texts(n=700):
    rnd = random.Random(11)
    made = ["".join(rnd.choices(SIGNS, k=rnd.randint(0, 50))) for _ in range(n)]
    return [*made, "", " ", "   ", "▁", "a" * 3000, "ab" * 2000, "!" * 700, " " * 500, "é" * 600, "𒀀x"]


def library(path):
    return sentencepiece.SentencePieceProcessor(model_file=str(path))


def spans_of(want, text):
    found = sentencepiece_pb2.SentencePieceText()
    found.ParseFromString(want.encode(text, out_type="serialized_proto"))
    return [(p.id, p.piece, p.begin, p.end) for p in found.pieces]


def altered(tmp_path, name, change):
    model = model_format.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    change(model)
    path = tmp_path / name
    path.write_bytes(model.SerializeToString())
    return path


def with_map(rule, **settings):
    def change(model):
        made = model_format.ModelProto()
        made.ParseFromString(
            sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
        )
        model.normalizer_spec.CopyFrom(made.normalizer_spec)
        for name, value in settings.items():
            setattr(model.normalizer_spec, name, value)

    return change


def no_bytes(model):
    model.trainer_spec.byte_fallback = False
    for piece in model.pieces:
        if piece.type == 6:
            piece.type = 3


def user_defined(model):
    with_map("nfkc")(model)
    for piece in model.pieces:
        if piece.piece in ("ation", "▁the", "①", "ing", "the"):
            piece.type = 4


def no_prefix(model):
    model.normalizer_spec.add_dummy_prefix = False


def as_suffix(model):
    model.trainer_spec.treat_whitespace_as_suffix = True


def across_words(model):
    model.pieces[300].piece = "a▁b"


def nothing(model):
    pass


CHANGES = {
    "as_is": nothing,
    "nfkc": with_map("nfkc"),
    "nmt_nfkc_cf": with_map("nmt_nfkc_cf", remove_extra_whitespaces=False),
    "no_bytes": no_bytes,
    "user_defined": user_defined,
    "no_prefix": no_prefix,
    "suffix": as_suffix,
    "across_words": across_words,
}


@pytest.mark.parametrize("name", CHANGES)
def test_pieces_spans_and_texts_as_the_library(tmp_path, name):
    path = altered(tmp_path, name, CHANGES[name])
    want, own = library(path), PieceCodec(str(path))
    for text in texts():
        encoding = own.encode(text)
        ids = encoding.ids
        assert ids == want.encode(text), repr(text)
        starts, ends = (x.tolist() for x in encoding.spans())
        pieces = [own.shown[i] for i in ids]
        if name != "no_bytes":  # unknown pieces show their text in the library
            assert list(zip(ids, pieces, starts, ends, strict=True)) == spans_of(want, text), repr(text)
        assert own.decode(ids) == want.decode(ids), repr(text)


def test_any_ids_decode_as_the_library():
    want, own = library(MODEL), PieceCodec(MODEL)
    rnd = random.Random(5)
    some = [*range(0, 262), *rnd.choices(range(262, 32000), k=60)]
    for _ in range(2000):
        ids = rnd.choices(some, k=rnd.randint(0, 12))
        assert own.decode(ids) == want.decode(ids), ids


@pytest.mark.parametrize("rule", ["nfkc", "nfkc_cf", "nmt_nfkc"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normal_forms_and_places_as_the_library(rule, squeeze):
    want = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze
    )
    made = model_format.ModelProto()
    made.ParseFromString(want.serialized_model_proto())
    own = Normaliser(made.normalizer_spec.precompiled_charsmap, squeeze=squeeze)
    for text in texts():
        shown, places = want.normalize(text, with_offsets=True)
        got = own(text)
        assert got.text == shown, repr(text)
        at, starts = 0, []
        for c in got.text:
            starts.append(int(got.starts[at]))
            at += len(c.encode())
        starts.append(int(got.starts[at]))
        assert starts == [len(text[:p].encode()) for p in places], repr(text)


def test_other_models_are_refused(tmp_path):
    def unigram(model):
        model.trainer_spec.model_type = 1

    with pytest.raises(ValueError):
        PieceCodec(str(altered(tmp_path, "unigram", unigram)))


def test_rows(documents, spark):
    rows = [(1, "The  Straße ▁x"), (1, "The  Straße ▁x"), (2, None), (3, ""), (None, "a\x00b")]
    rows += [(10 + i, t) for i, t in enumerate(texts(60))]
    docs = documents(rows, ["ids", "n_tokens", "pieces", "start"])
    want = library(MODEL)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for i, text in rows:
        ids = want.encode(text or "")
        spans = spans_of(want, text or "")
        widths = [b - a for _, _, a, b in spans]
        expected.append(
            (
                i,
                len(ids),
                digest(",".join(map(str, ids))),
                digest(want.decode(ids)),
                sum(w > 0 for w in widths),
                sum(widths),
            )
        )
    got = [tuple(r) for r in piece_digests(docs, MODEL).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)

    encoded = encode_pieces(docs, MODEL)
    texts_of = {i: t or "" for i, t in rows}
    for r in encoded.collect():
        source = texts_of[r["doc_id"]].encode()
        assert b"".join(source[p["start"] : p["end"]] for p in r["pieces"]) == source
        assert r["decoded"] == want.decode([p["id"] for p in r["pieces"]])
    back = decode_pieces(encoded.selectExpr("doc_id", "pieces.id AS ids"), MODEL)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        ((r["doc_id"], r["decoded"]) for r in encoded.collect()), key=repr
    )


def test_no_rows(documents):
    assert piece_digests(documents([]), MODEL).count() == 0
    assert encode_pieces(documents([]), MODEL).count() == 0
