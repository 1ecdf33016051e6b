"""Shared pieces of the registered queries: the stored model and its SQL twin.

Weights come from integer arithmetic, so that a plain SQL query can rebuild them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.scalars import rounded, rounded_apart
from clickweave.functions.vectors import in_small_methods
from clickweave.operators.embedding import Lookup, attach, compose, formula_table
from clickweave.operators.encode import fit_vocabulary, vocabulary_sizes
from clickweave.plans.impressions import DENSE, KEY, SPARSE, impressions
from clickweave.scratch import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ROW = ["l_orderkey", "l_linenumber", "l_partkey"]
ROW_SQL = ", ".join(ROW)
KERNEL = [0.01, 0.5, 1e-6]
NF = len(SPARSE)
MANY = 5  # results of a row from which they are compiled as small methods
PAIRS = [(i, j) for i in range(NF) for j in range(i + 1, NF)]


def register(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


# ---- weights by arithmetic ---------------------------------------------

def num(n: int, seed: int = 0) -> float:
    return ((n * 37 + seed * 11) % 53) / 53.0 - 0.5


def nums(n: int, seed: int = 0) -> list[float]:
    return [num(i, seed) for i in range(n)]


def mat(rows: int, cols: int, seed: int = 0) -> list[list[float]]:
    return [[num(r * cols + c, seed) for c in range(cols)] for r in range(rows)]


def lit(x: float) -> str:
    s = repr(float(x))
    return f"({s})" if "e" in s else f"({s}e0)"


def spark_vec(dim: int, step: int = 7) -> Callable[[Column, Column], Column]:
    return lambda i, p: F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)), lambda d: ((i * 31 + p * 17 + d * step) % 97) / 97.0 - 0.5
    )


def spark_weight(i: Column, p: Column) -> Column:
    return ((i * 13 + p * 5) % 89) / 89.0 - 0.5


def sql_cell(idx: str, f: int, d: int, step: int = 7) -> str:
    return f"((({idx}*31+{f * 17 + d * step}) % 97)/97e0-0.5e0)"


def sql_weight(idx: str, f: int) -> str:
    return f"((({idx}*13+{f * 5}) % 89)/89e0-0.5e0)"


# ---- the stored model --------------------------------------------------

@dataclass
class Model:
    vocab: DataFrame
    sizes: dict[str, int]
    table: DataFrame
    lookup: Lookup
    dim: int


_models: dict[tuple, Model] = {}
_vocabs: dict[tuple, tuple[DataFrame, dict[str, int]]] = {}


def stored_vocab(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, int]]:
    """Encoders fitted once per session and folder, then read back like any stored encoder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _vocabs:
        vocab = fit_vocabulary(impressions(spark, sf), SPARSE)
        _vocabs[key] = (vocab, vocabulary_sizes(vocab))
    return _vocabs[key]


def all_ids(spark: SparkSession, vocab: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Every class number plus the unseen one of each field."""
    spare = spark.createDataFrame(list(sizes.items()), "feature string, idx int")
    return vocab.select("feature", "idx").unionByName(spare)


def stored_model(spark: SparkSession, sf: str, dim: int) -> Model:
    key = (spark.sparkContext.applicationId, sf, dim)
    if key not in _models:
        vocab, sizes = stored_vocab(spark, sf)
        table = pin(formula_table(all_ids(spark, vocab, sizes), SPARSE, spark_vec(dim), spark_weight), "model")
        _models[key] = Model(vocab, sizes, table, compose(vocab, table, sizes), dim)
    return _models[key]


def attached(spark: SparkSession, sf: str, dim: int) -> DataFrame:
    m = stored_model(spark, sf, dim)
    return attach(impressions(spark, sf), SPARSE, m.lookup)


def vecs() -> list[Column]:
    return [F.col(f"{f}__v") for f in SPARSE]


def wts() -> list[Column]:
    return [F.col(f"{f}__w") for f in SPARSE]


def row_with(df: DataFrame, **cols: Column) -> DataFrame:
    """Row columns and rounded results; many of them are compiled apart from the joins before."""
    if len(cols) < MANY:
        return df.select(*ROW, *[rounded(c).alias(k) for k, c in cols.items()])
    doubles = {k for k, t in df.select(*[c.alias(k) for k, c in cols.items()]).dtypes if t == "double"}
    out = {k: rounded_apart(c) if k in doubles else rounded(c) for k, c in cols.items()}
    return in_small_methods(df.select(*ROW, *[c for c in df.columns if c not in ROW]), **out).select(*ROW, *cols)


def row_with_vector(df: DataFrame, vector: Column, width: int, name: str = "c") -> DataFrame:
    cur = df.select(*ROW, vector.alias("_out"))
    return row_with(cur, **{f"{name}{d}": F.col("_out").getItem(d) for d in range(width)})


# ---- SQL twins ---------------------------------------------------------

IMP = f"""imp AS (
  SELECT {', '.join(KEY)}, {', '.join(SPARSE)}, {', '.join(DENSE)},
    CAST(l_returnflag = 'R' AS INTEGER) AS label, CAST(l_linestatus = 'O' AS INTEGER) AS label2, p_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey)"""

ENC = IMP + ",\nenc AS (SELECT *, " + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS i{f}" for f, c in enumerate(SPARSE)
) + " FROM imp)"


def vec_cte(dim: int) -> str:
    cells = ", ".join(f"{sql_cell(f'i{f}', f, d)} AS e{f}_{d}" for f in range(NF) for d in range(dim))
    ws = ", ".join(f"{sql_weight(f'i{f}', f)} AS w{f}" for f in range(NF))
    return ENC + f",\nvec AS (SELECT *, {cells}, {ws} FROM enc)"


LINEAR_SQL = (
    " + ".join(f"w{f}" for f in range(NF)) + " + " + " + ".join(f"{c}*{lit(k)}" for c, k in zip(DENSE, KERNEL))
)


def r6(x: str, digits: int = 6) -> str:
    return f"round({x}, {digits}) + 0e0"


def sig(x: str) -> str:
    return f"(1e0/(1e0+exp(-({x}))))"


def cell(f: int, d: int) -> str:
    return f"e{f}_{d}"


def dot_sql(i: int, j: int, dim: int) -> str:
    return "(" + "+".join(f"e{i}_{d}*e{j}_{d}" for d in range(dim)) + ")"


def fm_dim_sql(d: int, fields=range(NF)) -> str:
    s = "+".join(f"e{f}_{d}" for f in fields)
    q = "+".join(f"e{f}_{d}*e{f}_{d}" for f in fields)
    return f"(({s})*({s})-({q}))"


def fm_sql(dim: int) -> str:
    return "0.5e0*(" + "+".join(fm_dim_sql(d) for d in range(dim)) + ")"


def select_sql(dim: int, **cols: str) -> str:
    items = ", ".join(f"{r6(x)} AS {k}" for k, x in cols.items())
    return f"WITH {vec_cte(dim)}\nSELECT {ROW_SQL}, {items} FROM vec"
