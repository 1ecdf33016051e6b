"""Lookups beyond a broadcast, rows of the learner that meet rows, stored rows of a tower."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickweave.operators import embedding as emb
from clickweave.operators.joins import fields_join
from clickweave.plans import training as TR
from clickweave.streaming import online as O

FIELDS = ["a", "b", "c"]


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("least", [0, 30, 1000])
def test_fields_meet_their_table_with_hot_and_cold_keys(spark, least):
    """All hot, some hot, none hot; null keys, keys the table lacks, equal rows; the same as a dictionary."""
    rows = [(i // 2, *(None if (i + k) % 11 == 0 else f"{(i * (k + 1)) % (3, 40, 90)[k]}" for k in range(3))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string")
    known = {(f, str(v)): (0.5 * v, f"{f}{v}") for f in FIELDS for v in range(1, 60)}
    table = spark.createDataFrame([(*k, *v) for k, v in known.items()], "feature string, _key string, w double, t string")
    out, met = fields_join(df, {f: F.col(f) for f in FIELDS}, table, ["w", "t"], least=least)
    got = sorted((str(tuple(r)) for r in out.select("id", *FIELDS, *[F.col(m)[v] for m in met for v in ("w", "t")]).collect()))
    want = sorted(str((*r, *[x for f, k in zip(FIELDS, r[1:]) for x in known.get((f, k), (None, None))])) for r in rows)
    assert got == want


def pairs(spark):
    rows = [(f, o, i, [i + 0.1 * n, 1.0]) for f in FIELDS for n, o in enumerate(FIELDS) for i in range(4) if f != o]
    table = spark.createDataFrame(rows, "feature string, other string, idx int, vec array<double>")
    df = spark.createDataFrame([(1, 0, 1, 2), (2, 3, None, 9), (2, 3, None, 9)], "id int, a int, b int, c int")
    return df, table


def test_pair_lookups_agree_and_leave_settled_rows_where_they_are(spark):
    df, table = pairs(spark)
    wide, long = emb.pair_lookup(df, FIELDS, table, fits=True), emb.pair_lookup(df, FIELDS, table, fits=False)
    assert wide.columns == long.columns == [*df.columns, *[f"{f}__for__{o}" for f in FIELDS for o in FIELDS if f != o]]
    a, b = (sorted(str(tuple(r)) for r in d.collect()) for d in (wide, long))
    assert a == b and any("[0.1, 1.0], [0.2, 1.0], [1.0, 1.0], [1.2, 1.0]" in r for r in a)
    assert "Union" in plan(long)  # rows whose keys are all hot are not taken through the join by the row's number


def test_pair_lookup_has_a_column_a_field_in_its_joins(spark, sf):
    import __spark_entry__ as entry

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = entry.queries()["e10_field_aware_lookup"](spark, sf)._jdf.queryExecution().debug().codegenToSeq()
        assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_rows_of_a_batch_are_not_sent_to_the_driver(spark):
    """The joins of rows by their number are sort-merge joins, whatever the size of their files."""
    rows = O.Rows("id", ("t",), ("x",), "y")
    batch = spark.createDataFrame([(i, f"k{i % 3}", 0.1 * i, i % 2) for i in range(40)], "id long, t string, x double, y int")
    seen, kept = [], O.pin
    try:
        O.pin = lambda df, name="t": (seen.append((name, plan(df, "executedPlan"))), kept(df, name))[1]
        new, _ = O.update(batch, lambda keys, fits: O.empty_state(spark), rows, O.FtrlSettings(k=2, fold_rows=10))
    finally:
        O.pin = kept
    assert new.where("key <> '__bias__'").count() == 4
    assert [p for n, p in seen if n == "scored"] and all("SortMergeJoin [id" in p for n, p in seen if n == "scored")
    assert any("SortMergeJoin [id" in p for n, p in seen if n == "fold")


def test_stored_rows_of_a_tower_come_back_whole():
    x, y = np.random.default_rng(1).normal(size=(3000, 11)), np.arange(3000.0)
    batch = pa.RecordBatch.from_pydict({"x": pa.array(x.tolist(), pa.list_(pa.float64())), "y": pa.array(y)})
    (packed,) = TR._packed(iter([batch]))
    back = np.concatenate(list(TR._unpacked(packed, 11)))
    assert packed.num_rows > 1 and (back[:, :-1] == x).all() and (back[:, -1] == y).all()
    with pytest.raises(ValueError):
        list(TR._unpacked(packed, 10))
