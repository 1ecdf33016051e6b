"""The learned rank index and the fill-in-middle rearrangement against plain slicing."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import infill

r = random.Random(3)
MIXED = "".join(r.choice(["a", "é", "日", "😀", " ", "\n", "<", "S>"]) for _ in range(4000))
LONG = "".join("plain text " * r.randrange(1, 40) + "日本語" * r.randrange(60) for _ in range(200))
CASES = [
    (1, MIXED), (1, MIXED), (2, LONG), (3, "ab"), (4, "x"), (5, ""), (6, None), (None, "no id"), (None, None), (7, "with <P> inside"),
    (8, "<<S>"), (9, "<" * 50 + "S>"), (10, "\x00\n"), *[(100 + i, f"text {i} <S of {'é' * i}>") for i in range(80)],
]


def wanted(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(t, i, 1, "x") for i, t in CASES], "TEXT string, doc_id long, n int, Output string").withColumnRenamed("TEXT", "text").repartition(3)


def test_texts_equal_plain_slicing(docs):
    made = infill.restored_texts(infill.transformed(docs))
    found = [(x.doc_id, x.n, x.form, x.prefix_units, x.middle_units, x.output) for x in made.collect()]
    key = lambda x: tuple(map(str, x))
    assert sorted(found, key=key) == sorted((wanted(i, t) for i, t in CASES), key=key)
    assert {x[2] for x in found} == {"plain", "psm", "spm"}
    assert sorted(x.text for x in made.collect()) == sorted(t or "" for _, t in CASES)


def test_bytes_follow_units(docs):
    for x in infill.transformed(docs).where("form <> 'plain' and doc_id = 2").collect():
        assert x.prefix_bytes == len(LONG[: x.prefix_units].encode())
        assert x.middle_bytes == len(LONG[x.prefix_units : x.prefix_units + x.middle_units].encode()) and x.n_segments > 1


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units_cut_at_boundaries(docs, unit):
    made = infill.restored_texts(infill.transformed(docs, unit))
    assert sorted(x.text for x in made.collect()) == sorted(t or "" for _, t in CASES)
    ends = set(infill.boundaries(LONG.encode(), unit).tolist())
    for x in made.where("doc_id = 2 and form <> 'plain'").collect():
        assert {x.prefix_bytes, x.prefix_bytes + x.middle_bytes} <= ends and x.n == len(ends) - 1


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert infill.restored_texts(infill.transformed(none)).count() == 0


def test_index_is_bounded_and_exact():
    g = np.random.default_rng(1)
    tables = [np.array([0]), np.array([0, 0, 0]), np.arange(5000) * 3, np.array([0, 10**9, 10**9 + 1, 2 * 10**9])]
    tables += [np.concatenate([[0], np.cumsum(g.integers(0, w, 3000))]) for w in (2, 5, 1000, 10**6)]
    for offsets in tables:
        for error in (0, 7, infill.ERROR):
            index = infill.RankIndex.fit(offsets.astype(np.int64), error)
            ranks = np.arange(len(offsets))
            assert (index.find(ranks) == offsets).all()
            assert abs(offsets - index.predict(ranks)).max() <= error + 1 and index.residual.dtype == np.int8
            ends = [*index.first[1:].tolist(), len(offsets)]
            for a, b in zip(index.first.tolist(), ends):  # a segment ends only where no slope reaches one boundary more
                if b < len(offsets):
                    run, rise = np.arange(1, b - a + 1), offsets[a + 1 : b + 1] - offsets[a]
                    assert ((rise - error) / run).max() > ((rise + error) / run).min()
    assert len(infill.RankIndex.fit(np.arange(100_000)).first) == 1
    with pytest.raises(ValueError):
        infill.RankIndex.fit(np.arange(3), 127)
