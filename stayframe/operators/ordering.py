"""Global order without a single-partition window (ORD1), plus sort, top-k,
first-n and union (SRT1-SRT3, SET1).

``global_prefix`` is a two-level prefix sum over slices of the order:

1. splitters: a bounded sample of the keys (``OVERSAMPLE`` a slice, one per
   hash bucket) gives a small table of bounds, and the slice of a row is an
   expression over it. Any bounds give right results, so nothing has to be
   pinned. The key must be unique: equal keys share a slice, so collapse them
   to one row with a count first, as ``exact_quantiles`` does;
2. running sums inside each slice (a window partitioned by the slice, so each
   task sorts only its own);
3. exact totals per slice, with map-side partials and before any row moves,
   form a table with one row per slice (and group), which is prefix-summed and
   joined back as offsets.

Only the splitters and the per-slice totals are ever small enough to gather;
nothing whole passes through the driver or a single task, and no rows are
stored. The input is read by three branches (splitters, totals, rows): where
it ends in an aggregate all three reuse its exchange; where two evaluations
of it may differ, store it first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayframe.session import shuffle_width

_PID = "_range_pid"
# Sampled keys a slice.
OVERSAMPLE = 16


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _slice_count(df: DataFrame, partitions: int | None) -> int:
    """Explicit number of slices, or as many as a shuffle starts from: set
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` (or the
    shuffle partition count) high on a large cluster so that no slice exceeds
    a task's memory."""
    return int(partitions or shuffle_width(df.sparkSession))


def _direction(df: DataFrame, order: Sequence[Column]) -> tuple[list[str], bool]:
    """Names of the order's columns and whether it falls. One direction holds for all, with Spark's default place of nulls."""
    parts = [re.fullmatch(r"Column<'`?(.+?)`?(?: (ASC NULLS FIRST|DESC NULLS LAST))?'>", str(o)) for o in order]
    if not all(p and p[1] in df.columns for p in parts):
        raise ValueError(f"order by plain columns with the default place of nulls, not {order}")
    ways = {(p[2] or "ASC")[:4].strip() for p in parts}
    if len(ways) != 1:
        raise ValueError("order by columns of one direction")
    return [p[1] for p in parts], ways == {"DESC"}


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.  The right
    side is a single row by construction (a global ``agg``), so broadcasting
    it is bounded; the join is an equi-join on a constant key."""
    return (
        df.withColumn("_scalar_key", F.lit(1))
        .join(F.broadcast(one_row.withColumn("_scalar_key", F.lit(1))), "_scalar_key", "inner")
        .drop("_scalar_key")
    )


def _key(columns: Sequence[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


def splitters(df: DataFrame, keys: Sequence[str], also: Sequence[str] = (), slices: int = 8) -> DataFrame:
    """One row: ``_bounds``, about ``slices`` ascending keys at most (a struct
    where there are several columns) that cut the rows into slices of like size, and every ``_step``-th of them
    as ``_coarse``.

    Each of ``OVERSAMPLE`` x ``slices`` hash buckets keeps the key of its least
    hash, with map-side partials, so the sample is bounded whatever the number
    of rows. ``also`` are columns that the other branches read: hashing them
    keeps the branches' aggregates alike, so that Spark evaluates them once."""
    h = df.select(*keys, F.xxhash64(*keys, *also).alias("_h"))
    named = [F.min_by(k, F.col("_h")).alias(f"k{i}") for i, k in enumerate(keys)]
    sample = h.groupBy(F.pmod("_h", F.lit(OVERSAMPLE * slices)).alias("_bucket")).agg(*named)
    # A list leaves nulls out, which come first of all and need no bound.
    row = sample.agg(F.sort_array(F.collect_list(_key([F.col(f"k{i}") for i in range(len(keys))]))).alias("_all"))
    every = F.greatest(F.lit(1), F.ceil(F.size("_all") / F.lit(slices)).cast("int"))
    row = row.select(F.filter("_all", lambda x, i: (i + 1) % every == 0).alias("_bounds"))
    row = row.withColumn("_step", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_bounds"))).cast("int")))
    return row.withColumn("_coarse", F.filter("_bounds", lambda x, i: (i + 1) % F.col("_step") == 0))


def _range_split(df: DataFrame, by: Sequence[str], order: Sequence[Column], also: Sequence[str], partitions: int | None) -> DataFrame:
    """Tag each row with its slice: slices ascend in ``order`` within every group.

    The slice is the number of bounds up to the row's key, found in two steps
    (among the coarse bounds, then among those that follow), each of about the
    square root of the number of slices."""
    names, falls = _direction(df, order)
    keys = [*by, *names]
    for b in by:  # the offsets' join drops null groups; said here, all branches read the same rows
        df = df.where(F.col(b).isNotNull())
    bounds = splitters(df, keys, [c for c in also if c not in keys], _slice_count(df, partitions))
    rows = with_scalars(df, bounds)
    key = _key([F.col(k) for k in keys])
    upto = lambda a: F.size(F.filter(a, lambda b: b <= key))  # noqa: E731  (a null key is behind no bound)
    at = upto(F.col("_coarse")) * F.col("_step")
    # The lower bound of the fine step is a column, so that it is found once a row.
    rows = rows.withColumn(_PID, at)
    pid = F.col(_PID) + upto(F.slice("_bounds", F.col(_PID) + 1, F.col("_step")))
    return rows.withColumn(_PID, -pid if falls else pid).drop("_bounds", "_coarse", "_step")


def global_prefix(
    df: DataFrame,
    order: Sequence,
    sums: Sequence[str],
    by: Sequence[str] = (),
    partitions: int | None = None,
    suffix: str = "_cum",
    totals: bool = False,
    following: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums of ``sums`` in ``order`` (within each ``by``
    group).  ``order`` must be unique within a group (add a tie-break key);
    ``by`` should have few distinct values (subgroups, not entities).
    ``order`` holds plain columns of one direction.

    Adds ``{c}{suffix}`` per summed column and, with ``totals``, the group
    total ``{c}_total``. ``following`` names summed columns whose values on
    the next row are added as ``_next_{c}`` (NULL on a group's last row), from
    the same slices.
    """
    order = [_col(o) for o in order]
    by = list(by)
    names, falls = _direction(df, order)
    packed = F.struct(*following) if following else None
    r = _range_split(df, by, order, sums, partitions)
    # The first row of a slice follows the last one of the slice before.
    heads = [(F.max_by if falls else F.min_by)(packed, F.struct(*names)).alias("_head")] if following else []
    per_part = r.groupBy(_PID, *by).agg(*[F.sum(c).alias(f"_{c}_part") for c in sums], *heads)
    w_local = Window.partitionBy(_PID, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for c in sums:
        r = r.withColumn(f"_{c}_local", F.sum(c).over(w_local))
    if following:
        r = r.withColumn("_next_local", F.lead(packed).over(Window.partitionBy(_PID, *by).orderBy(*order)))
    # Bounded: one row per (slice, group present in it).
    w_before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    off_cols = [F.coalesce(F.sum(f"_{c}_part").over(w_before), F.lit(0)).alias(f"_{c}_off") for c in sums]
    if totals:
        off_cols += [F.sum(f"_{c}_part").over(w_all).alias(f"{c}_total") for c in sums]
    if following:
        off_cols.append(F.lead("_head").over(Window.partitionBy(*by).orderBy(_PID)).alias("_next_head"))
    offsets = per_part.select(_PID, *by, *off_cols)
    # Without groups the offsets have one row per slice; with groups
    # their number may follow the data, so the join is left to the planner.
    out = r.join(offsets if by else F.broadcast(offsets), [_PID, *by], "inner")
    for c in sums:
        out = out.withColumn(f"{c}{suffix}", F.col(f"_{c}_local") + F.col(f"_{c}_off"))
    for c in following:
        out = out.withColumn(f"_next_{c}", F.coalesce("_next_local", "_next_head").getField(c))
    if following:
        out = out.drop("_next_local", "_next_head")
    drop = [_PID] + [f"_{c}_local" for c in sums] + [f"_{c}_off" for c in sums]
    return out.drop(*drop)


def global_rank(
    df: DataFrame,
    order: Sequence,
    by: Sequence[str] = (),
    name: str = "rank",
    partitions: int | None = None,
    with_count: bool = False,
) -> DataFrame:
    """0-based position of each row in ``order`` (unique keys required), and
    optionally the group size ``n`` alongside."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    out = global_prefix(ones, order, ["_one"], by, partitions, totals=with_count)
    out = out.withColumn(name, F.col("_one_cum") - F.lit(1)).drop("_one", "_one_cum")
    if with_count:
        out = out.withColumnRenamed("_one_total", "n")
    return out


def global_previous(
    df: DataFrame,
    order: Sequence,
    columns: Sequence[str],
    by: Sequence[str] = (),
    partitions: int | None = None,
    prefix: str = "prev_",
) -> DataFrame:
    """Value of ``columns`` on the previous row in ``order`` (NULL for the
    first row of each group): a lag over the global order.

    Inside a slice this is an ordinary lag; the first row of a slice takes
    the last row of the nearest earlier non-empty slice, found in the small
    per-slice table. ``order`` holds plain columns of one direction.
    """
    order = [_col(o) for o in order]
    by = list(by)
    r = _range_split(df, by, order, columns, partitions)
    w_local = Window.partitionBy(_PID, *by).orderBy(*order)
    packed = F.struct(*[F.col(c).alias(c) for c in columns])
    # Last row of each (slice, group): the greatest key, or the least of a falling order.
    names, falls = _direction(df, order)
    key = F.struct(*names)
    last = r.groupBy(_PID, *by).agg((F.min_by if falls else F.max_by)(packed, key).alias("_last"))
    r = r.withColumn("_prev_local", F.lag(packed, 1).over(w_local)).withColumn(
        "_is_first", F.lag(F.lit(1), 1).over(w_local).isNull()
    )
    w_prev = Window.partitionBy(*by).orderBy(_PID)
    last = last.select(_PID, *by, F.lag("_last", 1).over(w_prev).alias("_carry"))
    out = r.join(last if by else F.broadcast(last), [_PID, *by], "inner")
    chosen = F.when(F.col("_is_first"), F.col("_carry")).otherwise(F.col("_prev_local"))
    for c in columns:
        out = out.withColumn(f"{prefix}{c}", chosen.getField(c))
    return out.drop(_PID, "_prev_local", "_is_first", "_carry")


def sort_rows(df: DataFrame, *order) -> DataFrame:
    """SRT1: total order for an output (range-partitioned sort).  Inside a
    pipeline use ``sortWithinPartitions`` instead."""
    return df.orderBy(*order)


def global_position(sorted_rows: DataFrame, name: str = "position") -> DataFrame:
    """0-based place of each row in the order in which a sorted frame hands
    its rows out: partitions in their order, rows as they stand in them.

    The sorted rows are pinned by a checkpoint, numbered inside each partition
    and shifted by the sizes of the partitions before (one row each)."""
    from stayframe.session import checkpoint_dir

    checkpoint_dir(sorted_rows.sparkSession)
    r = sorted_rows.checkpoint().withColumn("_at", F.monotonically_increasing_id())
    r = r.withColumn(_PID, F.shiftright("_at", 33).cast("int")).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = r.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return r.join(F.broadcast(offsets), _PID).withColumn(name, F.col("_at") + F.col("_off")).drop(_PID, "_at", "_off")


def top_k(df: DataFrame, by: str, k: int = 10, ties: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """SRT2: the k rows with the largest (or smallest) ``by``; explicit tie
    keys make the choice deterministic.  Plans as TakeOrderedAndProject:
    each task keeps only its own top k."""
    first = F.col(by).desc() if descending else F.col(by).asc()
    return df.orderBy(first, *[F.col(t).asc() for t in ties]).limit(int(k))


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """SRT3: first ``n`` rows in an explicit order (never ``head`` of an
    unordered frame)."""
    return df.orderBy(*[F.col(c).asc() for c in order]).limit(int(n))


def union_parts(*parts: DataFrame) -> DataFrame:
    """SET1: UNION ALL by column name; a column absent from one part is NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
