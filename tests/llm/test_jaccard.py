"""Near copies: sketches rule out no link, rounds and blocks agree, and no sets stay behind."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest

from clickweave.llm import jaccard
from clickweave.scratch import scratch_root


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiourstlnm") for _ in range(r.randint(2, 7))) for _ in range(n))


def edited(text: str, seed: int, times: int) -> str:
    r, words = random.Random(seed), text.split()
    for _ in range(times):
        words[r.randrange(len(words))] = f"w{r.randrange(1 << 30)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows(spark):
    passage, base = prose(60, 50), prose(80, 9)
    texts = [passage + " " + prose(25, 300 + s) for s in range(40)] + [edited(base, s, s % 7) for s in range(40)]
    texts += [edited(prose(9, 60), s, 1) for s in range(20)] + ["", "   ", "one", texts[0], texts[41]]
    return spark.createDataFrame([*enumerate(texts), (None, texts[42]), (7, texts[43])], "doc_id long, text string").repartition(4)


def found(rows):
    return sorted(map(tuple, jaccard.near_duplicates(rows, 5, 80).collect()), key=repr)


def test_sketches_differ_by_no_more_than_the_sets():
    g = np.random.default_rng(5)
    for size, other in ((3, 3), (100, 90), (130, 127), (1000, 1300), (20_000, 17_000)):
        x = np.unique(g.integers(0, 1 << 63, size + other).astype(np.uint64))
        for shared in (0, min(size, other) // 2, min(size, other)):
            a, b = np.sort(x[:size]), np.sort(np.concatenate([x[:shared], x[size : size + other - shared]]))
            apart = jaccard._sketches_apart(jaccard.sketch_of(a), jaccard.sketch_of(b))
            assert apart == jaccard._sketches_apart(jaccard.sketch_of(b), jaccard.sketch_of(a))
            assert apart <= len(a) + len(b) - 2 * shared


def test_sketches_rule_out_large_sets_that_profiles_let_pass():
    x = np.unique(np.random.default_rng(6).integers(0, 1 << 63, 40_000).astype(np.uint64))
    ends = [np.sort(x[i::2]) for i in (0, 1)]
    size = np.array([len(s) for s in ends])
    profile = [np.frombuffer(jaccard.profile_of(s), np.uint8) for s in ends]
    assert jaccard._may_link(size[0], profile[0], size[1], profile[1], 80)
    assert jaccard._sketches_apart(*map(jaccard.sketch_of, ends)) * 180 > 20 * size.sum()
    assert all(len(jaccard.sketch_of(s)) * 16 <= s.nbytes for s in ends)


def test_rounds_of_stars_labels_and_sketches_change_nothing(rows, monkeypatch):
    plain = found(rows)
    assert len({r[2] for r in plain}) < len(plain)
    monkeypatch.setattr(jaccard, "SCREEN", 0)  # sketches before all sets, and slices
    monkeypatch.setattr(jaccard, "STORE", 0)  # labels spread in rounds
    monkeypatch.setattr(jaccard, "_blocks_suffice", lambda rows: False)  # all rounds of stars
    assert found(rows) == plain


def test_little_work_takes_no_rounds_of_stars(rows, monkeypatch):
    def star(rows):
        raise AssertionError("a round of stars")

    monkeypatch.setattr(jaccard, "_star", star)
    assert found(rows)


def test_sets_go_when_components_are_known(spark, rows):
    before = set(os.listdir(scratch_root(spark)))
    jaccard.near_duplicates(rows)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(scratch_root(spark))) - before}
    assert "classes" in left and not left & {"sets", "members", "two", "labels"}


def test_signatures_met_in_a_stream_are_those_of_a_whole_table(monkeypatch):
    g = np.random.default_rng(8)
    sig, d1 = g.integers(-40, 40, 900) ** 3, g.integers(-9, 9, 900)
    sig[:60] = np.arange(1_000_000, 1_000_060)
    wanted = {}
    for s, d in zip(sig.tolist(), d1.tolist()):
        wanted.setdefault(s, []).append(d)
    wanted = {(s, min(d), max(d), min(len(d), 3)) for s, d in wanted.items() if min(d) < max(d)}

    def batches(sig, d1, step):
        for i in range(0, len(sig), step):
            yield pa.RecordBatch.from_pydict({"sig": pa.array(sig[i : i + step]), "d1": pa.array(d1[i : i + step])})
        yield pa.RecordBatch.from_pydict({"sig": pa.array([], pa.int64()), "d1": pa.array([], pa.int64())})

    for store, step in ((64, 7), (1, 1), (400, 900), (10_000, 100)):
        monkeypatch.setattr(jaccard, "STORE", store)
        fewer = pa.Table.from_batches(jaccard._fewer(batches(sig, d1, step))).sort_by("sig")
        met = pa.Table.from_batches(jaccard._met(iter(fewer.to_batches(max_chunksize=step))))
        rows = [tuple(r.values()) for r in met.to_pylist()]
        assert len(rows) == len(set(rows)) and set(rows) == wanted
        assert fewer.num_rows <= len(sig) and (store < 10_000 or fewer.num_rows <= 3 * len(set(sig.tolist())))


def test_no_table_of_all_signatures_is_made(rows, monkeypatch):
    plans, pin = [], jaccard.pin

    def seen(df, name="t"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return pin(df, name)

    monkeypatch.setattr(jaccard, "pin", seen)
    jaccard.near_duplicates(rows, 5, 80)
    plan = dict(plans)["shared"]
    assert "Sort" in plan and "HashAggregate" not in plan
