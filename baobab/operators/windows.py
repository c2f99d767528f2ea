"""Ranking and ordered-window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key, ties broken by all
    remaining columns (descending, NULLs last) so the result is deterministic.

    Implemented as ``max(struct(order_cols..., rest...))`` per key: an ordinary
    aggregation with a map-side partial step, so a key holding a large share of
    the rows is reduced on every mapper before the shuffle instead of being sorted
    in one task as ``row_number()`` over ``partitionBy(key)`` would.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.max(F.struct(*order_cols, *rest)).alias("_best")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in df.columns
                               if c not in keys])


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rang") -> DataFrame:
    """First ``n`` rows per group by ``order`` with ``row_number``.

    The filter ``rank <= n`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so each mapper ships at most ``n`` rows per group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= n))


def with_previous(df: DataFrame, order_col: str, value_col: str,
                  prev_col: str, delta_col: str) -> DataFrame:
    """Previous value and delta in ``order_col`` order.

    Unpartitioned window: only for inputs already reduced to a small, bounded set
    of rows (one per month here).
    """
    w = Window.orderBy(order_col)
    prev = F.lag(value_col, 1).over(w)
    return df.withColumns({prev_col: prev, delta_col: F.col(value_col) - prev})


def _max_before(df: DataFrame, pos: str, value: str, by: list[str], block: int, levels: int,
                out: str) -> DataFrame:
    """``df`` with the greatest ``value`` at smaller ``pos``, inside ``by``. Windows cover a
    block of positions; what came before a block is the same question about the blocks'
    maxima, asked ``levels`` times before one window takes the rest."""
    if not levels:
        w = Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.max(value).over(w))
    blk, top, inside, pre = f"_blk{levels}", f"_top{levels}", f"_in{levels}", f"_pre{levels}"
    # Integer division rounds towards zero, which keeps the order of negative positions, too.
    x = df.withColumn(blk, F.call_function("div", F.col(pos), F.lit(block)))
    w = Window.partitionBy(*by, blk).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    blocks = x.groupBy(*by, blk).agg(F.max(value).alias(top))
    earlier = _max_before(blocks, blk, top, by, block, levels - 1, pre).select(
        *[F.col(c).alias(f"_b{levels}_{c}") for c in by], F.col(blk).alias(f"_b{levels}"), pre)
    same = F.col(blk) == F.col(f"_b{levels}")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_b{levels}_{c}"))
    out_col = F.greatest(F.col(inside), F.col(pre)).alias(out)
    return x.withColumn(inside, F.max(value).over(w)).join(earlier, same, "left").select(*df.columns, out_col)


def behind_running_max(df: DataFrame, arrival: str, ts: str, block: int = 1 << 16,
                       prev_col: str = "max_avant", by: list[str] | None = None, levels: int = 3) -> DataFrame:
    """For each row, the greatest ``ts`` among rows that arrived before it
    (``arrival`` order), over all rows or inside each key ``by``, exactly.

    Arrivals (a 64-bit integer) are cut into blocks of ``block`` values, blocks into
    blocks of blocks, and so on: three levels of 2^16 leave at most 2^16 values for the
    last window. So every window holds at most ``block`` different arrivals, whether
    they are dense or spread over the whole range. ``prev_col`` is NULL for a first
    arrival; arrivals are taken to be unique (inside ``by``).
    """
    return _max_before(df.withColumn("_pos", F.col(arrival).cast("bigint")), "_pos", ts, by or [], block, levels,
                       prev_col).drop("_pos")


def share_of_total(df: DataFrame, value_col: str, share_col: str, scale: float = 100.0,
                   digits: int | None = 1) -> DataFrame:
    """``value / sum(value) over ()`` on an already aggregated frame.

    The total is a scalar subquery (computed once, no join, no single-partition
    window), so the frame keeps its partitioning.
    """
    total = df.agg(F.sum(value_col)).scalar()
    share = F.lit(scale) * F.col(value_col) / total
    if digits is not None:
        share = F.round(share, digits)
    return df.withColumn(share_col, share.cast("double"))
