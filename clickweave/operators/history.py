"""Behaviour sequences from an event table: histories, sessions, negatives, next steps.

Users with very many events are taken apart: their events are cut into ordered
range blocks, each block is worked on alone, and only its edge (the last few
items, the last timestamp, the number of session starts) is handed to the next.
All other users take one plain window. Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators.blocks import global_rank, ordered_blocks
from clickweave.operators.joins import HOT_ROWS, hot_keys, lookup_join
from clickweave.operators.multivalue import pad
from clickweave.operators.rows import numbered, put_back
from clickweave.scratch import pin


def _last(c: Column, m: int) -> Column:
    return F.when(F.size(c) > m, F.slice(c, -m, m)).otherwise(c)


def _split_hot(events: DataFrame, user: str, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    hot = hot_keys(events, [user], hot_rows)  # read from a table that is written already
    if hot.isEmpty():
        return events, None
    small = F.broadcast(hot)
    return events.join(small, [user], "left_anti"), events.join(small, [user], "left_semi")


def behaviour_history(
    events: DataFrame, user: str, order: Sequence[str], item: str, m: int, out: str = "hist", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the last ``m`` items of the user before each event (``order`` is unique per user)."""
    cold, hot = _split_hot(events, user, hot_rows)
    w = Window.partitionBy(user).orderBy(*order).rowsBetween(-m, -1)
    done = cold.withColumn(out, F.collect_list(item).over(w))
    if hot is None:
        return done
    return done.unionByName(_history_in_blocks(hot, user, list(order), item, m, out))


def _history_in_blocks(hot: DataFrame, user: str, order: list[str], item: str, m: int, out: str) -> DataFrame:
    blocked = ordered_blocks(hot, [F.col(c) for c in [user, *order]])
    latest = Window.partitionBy("_block", user).orderBy(F.desc("_pos"))
    tails = (
        blocked.select("_block", user, "_pos", F.col(item).alias("_item"))
        .withColumn("_rn", F.row_number().over(latest))
        .where(F.col("_rn") <= m)
        .groupBy("_block", user)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_item"))), lambda e: e["_item"]).alias("_tail"))
    )
    # one row per user and block; m earlier blocks always hold m earlier items
    earlier = Window.partitionBy(user).orderBy("_block").rowsBetween(-m, -1)
    carried = tails.select("_block", user, _last(F.flatten(F.collect_list("_tail").over(earlier)), m).alias("_carried"))
    inside = Window.partitionBy("_block", user).orderBy("_pos").rowsBetween(-m, -1)
    return (
        blocked.withColumn("_own", F.collect_list(item).over(inside))
        .join(F.broadcast(carried), ["_block", user])
        .withColumn(out, _last(F.concat("_carried", "_own"), m))
        .select(*hot.columns, out)
    )


def padded_history(history: Column, m: int, value=0) -> tuple[Column, Column]:
    """Right-padded ids and their true length."""
    return pad(history, m, value), F.least(F.size(history), F.lit(m))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def divide_sessions(
    events: DataFrame, user: str, ts: str, tie: str, gap_seconds: float, out: str = "session_no", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Number the sessions of each user from 1; a gap above ``gap_seconds`` starts a new one."""
    gap = int(gap_seconds * 1_000_000)
    cold, hot = _split_hot(events, user, hot_rows)
    w = Window.partitionBy(user).orderBy(ts, tie)
    timed = cold.withColumn("_t", _micros(ts))
    back = F.col("_t") - F.lag("_t").over(w)
    flagged = timed.withColumn("_new", (back.isNull() | (back > gap)).cast("int"))
    done = flagged.withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_t", "_new")
    if hot is None:
        return done
    return done.unionByName(_sessions_in_blocks(hot, user, ts, tie, gap, out))


def _sessions_in_blocks(hot: DataFrame, user: str, ts: str, tie: str, gap: int, out: str) -> DataFrame:
    blocked = ordered_blocks(hot.withColumn("_t", _micros(ts)), [F.col(user), F.col(ts), F.col(tie)])
    w = Window.partitionBy("_block", user).orderBy("_pos")
    back = F.col("_t") - F.lag("_t").over(w)
    flagged = blocked.withColumn("_new", F.coalesce(back > gap, F.lit(False)).cast("int"))
    edges = flagged.groupBy("_block", user).agg(
        F.min("_t").alias("_from"), F.max("_t").alias("_to"), F.sum("_new").alias("_starts")
    )
    by_block = Window.partitionBy(user).orderBy("_block")
    wait = F.col("_from") - F.lag("_to").over(by_block)
    edges = edges.withColumn("_opens", (wait.isNull() | (wait > gap)).cast("int"))
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn(
        "_base", F.coalesce(F.sum(F.col("_starts") + F.col("_opens")).over(before), F.lit(0)) + F.col("_opens")
    ).select("_block", user, "_base")
    running = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        flagged.withColumn("_run", running)
        .join(F.broadcast(edges), ["_block", user])
        .withColumn(out, F.col("_base") + F.col("_run"))
        .select(*hot.columns, out)
    )


def last_sessions(events: DataFrame, user: str, session: str, keep: int = 5, out: str = "sess") -> DataFrame:
    """Only the last ``keep`` sessions of each user, numbered from 0, with ``sess_length`` kept ones."""
    totals = events.groupBy(user).agg(F.max(session).cast("bigint").alias("_total"))
    met = lookup_join(events, totals, [user], ["_total"])
    first = F.greatest(F.col("_total") - F.lit(keep), F.lit(0).cast("bigint"))
    return (
        met.where(F.col(session) > first)
        .withColumn(out, (F.col(session) - first - 1).cast("int"))
        .withColumn("sess_length", F.least(F.col("_total"), F.lit(keep).cast("bigint")).cast("int"))
        .drop("_total")
    )


def session_items(events: DataFrame, user: str, sess: str, order: Sequence[str], item: str, maxlen: int) -> DataFrame:
    """Per user and kept session the last ``maxlen`` items, in order.

    The row-number filter is applied by each map task before the shuffle (window
    group limit), so a huge session sends ``maxlen`` rows per task.
    """
    latest = Window.partitionBy(user, sess).orderBy(*[F.desc(c) for c in order])
    top = events.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") <= maxlen)
    return top.groupBy(user, sess).agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_rn")).alias("k"), F.col(item).alias("v")))), lambda e: e["v"]).alias("items")
    )


def draw_negatives(
    clicks: DataFrame, user: str, item_idx: str, n_items: int, draw: Column, out: str = "neg_idx", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One item index the user never touched for every click, null if none exists.

    ``draw`` is any whole number of the row (a hash of seed and key). With m own items of the user, the click gets
    the k-th free index, k = draw mod (n_items - m), so all free indexes are equally likely. The index below which
    k free ones lie is k plus the own items i_j (j-th smallest) with i_j - j <= k: clicks and own items are merged
    in the order of that number and counted once. A null user, or an item outside 0..n_items - 1, owns nothing.
    """
    inside = F.col(item_idx).between(0, n_items - 1) & F.col(user).isNotNull()
    seen = clicks.where(inside).select(F.col(user).alias("_u"), F.col(item_idx).cast("bigint").alias("_i")).distinct()
    ranked = pin(global_rank(seen, [F.col("_i")], "_rank", group=["_u"], few_groups=False), "owned")
    owned = ranked.groupBy("_u").agg(F.count(F.lit(1)).alias("_m"))
    rows, row = numbered(clicks.withColumn("_draw", draw.cast("bigint")))
    met = lookup_join(rows.select(row, F.col(user).alias("_u"), "_draw"), owned, ["_u"], ["_m"])
    free = F.lit(n_items).cast("bigint") - F.coalesce("_m", F.lit(0))
    asked = met.select(row, "_u", F.when(free > 0, F.pmod("_draw", free)).alias("_at"), F.lit(1).alias("_click"))
    # own items come before the clicks of the same number
    steps = ranked.select(F.lit(None).cast("bigint").alias(row), "_u", (F.col("_i") - F.col("_rank")).alias("_at"), F.lit(0).alias("_click"))
    merged = asked.where(F.col("_at").isNotNull()).unionByName(steps)
    order = ["_at", "_click", row]
    cold, hot = _split_hot(merged, "_u", hot_rows)
    own = (1 - F.col("_click")).cast("bigint")
    before = Window.partitionBy("_u").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = cold.withColumn("_own", F.sum(own).over(before)).select(row, "_at", "_click", "_own")
    if hot is not None:
        blocked = ordered_blocks(hot, [F.col(c) for c in ["_u", *order]])
        # one row a user and block is windowed, so a busy user's blocks are, its rows are not
        earlier = Window.partitionBy("_u").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sums = blocked.groupBy("_u", "_block").agg(F.sum(own).alias("_s"))
        sums = sums.select("_u", "_block", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"))
        inner = Window.partitionBy("_block", "_u").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        spread = blocked.withColumn("_own", F.sum(own).over(inner)).join(sums, ["_u", "_block"])
        counted = counted.unionByName(spread.select(row, "_at", "_click", (F.col("_own") + F.col("_before")).alias("_own")))
    found = counted.where(F.col("_click") == 1).select(row, (F.col("_at") + F.col("_own")).alias(out))
    return put_back(rows.drop("_draw"), found, row)


def next_steps(df: DataFrame, key: Sequence[str], clicked: str, negative: str, length: str) -> DataFrame:
    """Rows ``pos, current, next_click, next_negative`` for positions before ``length - 1``."""
    steps = F.transform(
        F.sequence(F.lit(0), F.size(clicked) - 2),
        lambda t: F.struct(
            t.alias("pos"),
            F.get(F.col(clicked), t).alias("current"),
            F.get(F.col(clicked), t + 1).alias("next_click"),
            F.get(F.col(negative), t + 1).alias("next_negative"),
        ),
    )
    long = df.where(F.size(clicked) >= 2).select(*key, length, F.inline(steps))
    return long.where(F.col("pos") < F.col(length) - 1).drop(length)


def next_step_loss(steps: DataFrame, p_click: str, p_negative: str, cells: int) -> DataFrame:
    """Log loss of the step probabilities over ``cells`` = rows x (padded length - 1).

    ``steps`` holds the valid positions only; masked cells count as zero.
    """
    term = -F.log(F.col(p_click)) - F.log(1.0 - F.col(p_negative))
    return steps.agg((F.coalesce(F.sum(term), F.lit(0.0)) / F.lit(float(cells))).alias("loss"))
