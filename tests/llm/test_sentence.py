"""Sentence pieces against the library: the stored model, and models derived from it by other settings."""

from __future__ import annotations

import hashlib
import random
import struct

import pytest
import sentencepiece

from clickweave.llm import sentence
from clickweave.llm.pieces import stored

FILE = stored("piece_bpe_32k.model")
r = random.Random(5)
ODD = [
    "", " ", "   ", "a", " a ", "Hello  world\n\t é 日本語 ▁x <s> </s> <unk> <0x0A>", "▁", "▁▁ ▁", "\x00a\x00", "x" * 3000, "日本語" * 400,
    "ﬁ ①２ ｱﾞ  ½ \u00a8 \u3000 \u200b\u00ad x", "e\u0301 \U0001f9d9\U0001f3fd end ", "\u0644\u0627 \ufdfa", "tail\u3000\u3000", "\u3000 head", "ﷺ" * 30,
]
MIXED = ["".join(r.choice(["a", "th", "ing", " ", "  ", "é", "ﬁ", "１", "日", "\U0001f600", "\n", "▁", "\u3000", "zz"]) for _ in range(60)) for _ in range(150)]


def varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def wire(number: int, value: int | bytes | float) -> bytes:
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def model(kinds: dict[str, int] | None = None, trainer: dict | None = None, normalizer: dict | None = None) -> bytes:
    """The stored model with other kinds of pieces and other settings; pieces it lacks are put in."""
    with open(FILE, "rb") as f:
        fields = list(sentence._fields(f.read()))
    out, missing = b"", dict(kinds or {})
    for number, value in fields:
        if number == 1:
            own = dict(sentence._fields(value))
            kind = missing.pop(own[1].decode(), own.get(3, 1))
            value = wire(1, own[1]) + wire(2, struct.unpack("<f", own[2])[0]) + wire(3, kind)
        elif number in (2, 3):
            own = dict(sentence._fields(value)) | ((trainer if number == 2 else normalizer) or {})
            value = b"".join(wire(n, v) for n, v in own.items() if not (number == 2 and isinstance(v, bytes) and len(v) == 4 and n in (10, 14)))
        out += wire(number, value)
    return out + b"".join(wire(1, wire(1, p.encode()) + wire(2, 0.0) + wire(3, k)) for p, k in missing.items())


def charmap(rule: str) -> bytes:
    whole = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    return next(dict(sentence._fields(v))[2] for n, v in sentence._fields(whole) if n == 3)


MODELS = {
    "stored": lambda: model(),
    "no dummy": lambda: model(normalizer={3: 0}),
    "trimmed": lambda: model(normalizer={4: 1}),
    "trimmed, no dummy": lambda: model(normalizer={3: 0, 4: 1}),
    "mapped": lambda: model(normalizer={2: charmap("nmt_nfkc")}),
    "mapped and trimmed": lambda: model(normalizer={2: charmap("nfkc_cf"), 4: 1}),
    "no bytes": lambda: model(kinds={f"<0x{i:02X}>": 3 for i in range(256)}, trainer={35: 0}),
    "marks last": lambda: model(trainer={24: 1}, normalizer={4: 1}),
    "blanks as they are": lambda: model(normalizer={5: 0}),
    "out of use": lambda: model(kinds={"▁th": 5, "ing": 5, "▁Hello": 5, "▁wor": 5}),
    "user": lambda: model(kinds={"ing": 4, "日本": 4, "<sep>": 4}),
}


@pytest.mark.parametrize("name", MODELS)
def test_pieces_equal_library(name):
    data = MODELS[name]()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), sentence.Pieces(data)
    for text in ODD + MIXED + [" ".join(MIXED[:30])]:
        ids, begins, ends = own.encode(text.encode())
        want = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in want] == library.encode(text), text
        assert list(zip(begins.tolist(), ends.tolist())) == [(p.begin, p.end) for p in want], text
        assert own.decode(ids.tolist()) == library.decode(ids.tolist()), text


@pytest.mark.parametrize("name", ["stored", "trimmed", "no dummy"])
def test_any_ids_decode_as_by_the_library(name):
    data = MODELS[name]()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), sentence.Pieces(data)
    few = [0, 1, 2, 3, 13, 198, 233, 131, 28705, 259, 264, 22557]
    for k in range(400):
        g = random.Random(k)
        ids = [g.choice(few) if g.random() < 0.7 else g.randrange(32000) for _ in range(g.randrange(8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_side_by_side_equals_the_queue():
    with open(FILE, "rb") as f:
        own = sentence.Pieces(f.read())
    parts = [("▁" if g.random() < 0.5 else "") + "".join(g.choice("aeinrst.é日") for _ in range(g.randrange(1, 60))) for g in map(random.Random, range(500))]
    found = own.table.merge_all(parts + ["a\u1234", "\U000fffff"])
    assert set(found) == {p for p in parts if len(p) <= sentence.LONGEST}
    assert all(found[p] == own._part(p) for p in found)


def test_query_columns(spark):
    rows = [(i, t, "x", 3) for i, t in enumerate(ODD + MIXED[:20])] + [(None, None, "x", 1), (None, "no id", "x", 1), (1, "twice", "x", 1), (1, "twice", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Ids string, begins int").repartition(3)
    made = sentence.encoded(docs, FILE)
    library = sentencepiece.SentencePieceProcessor(model_file=FILE)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = sentence.decoded(made, FILE, ["begins"]).collect()
    want = [(i, library.encode(t or ""), sha(library.decode(library.encode(t or "")))) for i, t, _, _ in rows]
    assert sorted([(x.doc_id, x.ids, sha(x.text)) for x in found], key=str) == sorted(want, key=str)
    for x in made.collect():
        assert len(x.ids) == len(x.begins) == len(x.ends) and all(a <= b for a, b in zip(x.begins, x.ends))
    both = sorted([(x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in sentence.digested(docs, FILE).collect()], key=str)
    assert both == sorted([(i, len(ids), sha(",".join(map(str, ids))), text) for i, ids, text in want], key=str)
    spans = {x.doc_id: hashlib.sha256(struct.pack(f"<{2 * len(x.ids)}i", *x.begins, *x.ends)).hexdigest() for x in made.where("doc_id > 1").collect()}
    assert {x.doc_id: x.spans_sha256 for x in sentence.digested(docs.where("doc_id > 1"), FILE).collect()} == spans
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sentence.decoded(sentence.encoded(none, FILE), FILE).count() == 0
    assert sentence.digested(none, FILE).count() == 0
    gone = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(x) for x in sentence.decoded(gone, FILE).collect()] == [(1, None, "")]
