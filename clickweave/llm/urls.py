"""URL filters: a blocked Bloom filter in front of an exact hash join.

A listed entry is a host and a path; it covers the host, its subdomains and all paths that
start with the entry's path. A URL is canonicalised and tried under every (host suffix, path
prefix) that an entry could have: suffixes of as many labels as the longest listed host, and
path prefixes of the listed path lengths. Each candidate key is tested against one block of
the filter: 512 bits, one bit in each of eight words. Only keys that pass are joined with the
list, so a false positive costs a join row and never a verdict. The longest entry wins.

Defined cases: a null URL or one without ``://`` has an empty host and path, which no entry
fits; entries with a null or empty host are ignored; of entries equal in host and path,
"block" wins; equal pages give equal rows; an empty list gives the default everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import fresh
from clickweave.operators.joins import lookup_join
from clickweave.scratch import pin

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Filter size: bits for each listed entry, up to this many blocks of 64 bytes (32 MiB), which
#: bounds the broadcast; a longer list has more false positives, which the exact join removes.
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 19
WORDS = [f"b{i}" for i in range(8)]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) tuples as a list of entries."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")


def canonical_entries(listed: DataFrame) -> DataFrame:
    """host, path, rule, block (boolean): one row for each listed (host, path)."""
    rows = listed.select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict"
    ).where(F.length("host") > 0)
    rows = rows.groupBy("host", "path").agg(F.bool_or(F.col("verdict") == "block").alias("block"))
    return rows.withColumn("rule", F.concat("host", "path"))


def _key(host: Column, path: Column) -> Column:
    return F.concat_ws("\u0001", host, path)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit for each of the eight words, six bits of a second hash for each."""
    second = F.xxhash64(F.lit(31), key)
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(8)
    ]


def bloom_blocks(entries: DataFrame) -> tuple[DataFrame, int]:
    """The filter as a table of blocks (number and eight words), and how many blocks it is dealt over."""
    n = entries.count()
    blocks = max(1, min(MAX_BLOCKS, -(-n * BITS_PER_KEY // 512)))
    key = _key(F.col("host"), F.col("path"))
    rows = entries.select(_block(key, blocks).alias("block_no"), *[b.alias(w) for w, b in zip(WORDS, _bits(key))])
    return rows.groupBy("block_no").agg(*[F.bit_or(w).alias(w) for w in WORDS]), blocks


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Array of (host suffix, path prefix) structs that an entry of the list could equal."""
    parts = F.split(host, r"\.", -1)
    suffix = lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), ".")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), suffix)
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    pairs = F.transform(
        suffixes,
        lambda s: F.transform(prefixes, lambda n: F.struct(s.alias("s"), F.substring(path, F.lit(1), n).alias("p"))),
    )
    return F.flatten(pairs)


def judge_urls(pages: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages`` and a struct column named by ``verdict_column(pages)``: host, path, rule, verdict.

    Each page becomes one carrier row with its columns and one narrow row for each candidate key;
    narrow rows that the filter stops are gone before anything is shuffled. The rest meet their
    carrier again under a row number that is given once, in this one plan.
    """
    out, row, rec = verdict_column(pages), "_row", "_rec"
    entries = pin(canonical_entries(listed), "url-entries")
    bound = entries.agg(
        F.coalesce(F.max(F.size(F.split("host", r"\.", -1))), F.lit(1)), F.collect_set(F.length("path"))
    ).first()
    blocks, n_blocks = bloom_blocks(entries)
    labels, lengths = bound[0], sorted(bound[1]) or [0]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias(rec),
        host_of(F.col(url)).alias("h"),
        path_of(F.col(url)).alias("p"),
        F.monotonically_increasing_id().alias(row),
    )
    no_key = F.struct(F.lit(None).cast("string").alias("s"), F.lit(None).cast("string").alias("p"))
    tries = F.concat(F.array(no_key), candidate_keys(F.col("h"), F.col("p"), labels, lengths))
    keys = rows.select(row, rec, "h", "p", F.posexplode(tries).alias("n", "key"))
    carrier = F.col("n") == 0
    keys = keys.select(
        row,
        F.when(carrier, F.struct(rec, "h", "p")).alias(rec),
        F.col("key")["s"].alias("host"),
        F.col("key")["p"].alias("path"),
    )
    key = _key(F.col("host"), F.col("path"))
    tested = keys.withColumn("block_no", F.when(F.col("host").isNotNull(), _block(key, n_blocks)))
    tested = tested.join(F.broadcast(blocks), "block_no", "left")
    passes = F.lit(True)
    for w, bit in zip(WORDS, _bits(key)):
        passes = passes & (F.col(w).bitwiseAND(bit) != 0)
    possible = tested.where(F.col(rec).isNotNull() | passes).select(row, rec, "host", "path")
    exact = lookup_join(possible, entries, ["host", "path"], ["block", "rule"])
    rank = F.struct(F.length("rule").alias("n"), F.length("host").alias("m"), "rule", "block")
    best = exact.groupBy(row).agg(
        F.first(rec, ignorenulls=True).alias(rec), F.max(F.when(F.col("rule").isNotNull(), rank)).alias("best")
    )
    verdict = F.when(F.col("best").isNull(), F.lit(default)).otherwise(
        F.when(F.col("best")["block"], F.lit("block")).otherwise(F.lit("allow"))
    )
    fields = [F.col(rec)["h"].alias("host"), F.col(rec)["p"].alias("path"), F.col("best")["rule"].alias("rule")]
    back = [F.col(rec)[rec][c].alias(c) for c in pages.columns]
    return best.select(*back, F.struct(*fields, verdict.alias("verdict")).alias(out))


def verdict_column(pages: DataFrame) -> str:
    return fresh(pages, "_url")


def url_report(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    rows = pages.select("page_id", "url")
    return judge_urls(rows, listed, default=default).select("page_id", f"{verdict_column(rows)}.*")
