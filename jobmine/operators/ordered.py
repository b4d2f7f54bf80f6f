"""Order statistics, exact-size draws and key lookups that do not rest on a single task.

Exact percentiles and running totals need a global order. A window without partitions would sort
the whole column in one task, and the built-in ``percentile`` keeps all distinct values of a group
in one hash map.

Quantiles take two narrow passes. A mergeable sketch per group gives two values between which each
share lies; then rows are counted per value between such a pair and per gap outside of all pairs
(map-side combined), so that only values next to a share are shuffled. The counts are exact, so they
also tell whether a sketch missed; such a group is counted whole.

Running totals count all values, cut them into buckets of about equal size and order a bucket in one
task; a small table of bucket totals supplies the offset.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmine.operators.rows import row_digest, small_side, with_row
from jobmine.session import stage, staging_dir

BUCKETS = 256
_STEP = 16  # bounds are searched in two steps of 16
# So many narrow rows may be ordered by one task.
KEYS_PER_TASK = 1_000_000
ACCURACY = 10_000
MARGIN = 3 / ACCURACY  # on each side of a share: three times what the sketch may be off
WHOLE_ROWS = 10_000  # a group of at most so many rows is between its least and its largest value
HEX_DIGITS = 3
KEY_DIGITS = 32
_ROW_BITS = 33  # of a number by monotonically_increasing_id, below the partition's number
HOT_SHARE = 1_000


def _bucket(value: Column, bounds: Column) -> Column:
    """How many bounds are smaller than the value, searched in two steps."""
    coarse = F.transform(F.sequence(F.lit(_STEP), F.lit(BUCKETS - _STEP), F.lit(_STEP)),
                         lambda i: F.get(bounds, i - 1))
    skipped = F.size(F.filter(coarse, lambda b: b < value)) * _STEP
    fine = F.slice(bounds, skipped + 1, F.lit(_STEP))
    return skipped + F.size(F.filter(fine, lambda b: b < value))


def _bounds(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame | list[float]:
    """Approximate quantiles as bucket bounds, fixed before use so that every step sees the same.

    Without groups: 255 numbers. With groups: a small local table, or a checkpointed one when
    there are more groups than a driver should hold.
    """
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    found = df.where(F.col(value).isNotNull()).groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(
        F.percentile_approx(value, shares, 10_000).alias("_bounds")
    )
    if not by:
        return found.first()["_bounds"] or []
    near = small_side(found)
    if near is found:
        staging_dir(df.sparkSession)
        return found.checkpoint()
    return near


def running_totals(
    df: DataFrame, value: str, sums: dict[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group and value: each sum, ``<sum>_before``, its total over smaller values, and
    ``<sum>_all``, its total over the group."""
    by = list(by)
    values = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        *[expression.alias(name) for name, expression in sums.items()]
    )
    group = Window.partitionBy(*by)
    smaller = (Window.unboundedPreceding, -1)

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(*smaller)), F.lit(0))

    bounds = _bounds(df, value, by)
    if by:
        match = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
        located = values.join(bounds, match, "left").select(
            *by, value, *sums, _bucket(F.col(value), F.col("_bounds")).alias("_bucket")
        )
    else:
        cuts = F.array(*[F.lit(float(b)) for b in bounds]).cast("array<double>")
        located = values.withColumn("_bucket", _bucket(F.col(value), cuts))
    keys = [*by, "_bucket"]
    buckets = located.groupBy(*keys).agg(*[F.sum(s).alias(f"_total_{s}") for s in sums])
    offsets = buckets.select(
        *[F.col(c).alias(f"_key_{c}") for c in keys],
        *[before(f"_total_{s}", group.orderBy("_bucket")).alias(f"_offset_{s}") for s in sums],
        *[F.sum(f"_total_{s}").over(group).alias(f"{s}_all") for s in sums],
    )
    match = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]
    inside = Window.partitionBy(*keys).orderBy(value)
    return located.join(offsets, match, "inner").select(
        *by, value, *sums,
        *[(F.col(f"_offset_{s}") + before(s, inside)).alias(f"{s}_before") for s in sums],
        *[f"{s}_all" for s in sums],
    )


def _fixed(df: DataFrame) -> DataFrame:
    """A row per group, computed once: few are kept by the driver, many are written."""
    near = small_side(df)
    return stage(df, "per-group") if near is df else near


def _brackets(numeric: DataFrame, shares: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Per group the number of rows and, for rising shares, values below and above each, by a sketch."""
    ends = [min(max(s + side * MARGIN, 0.0), 1.0) for s in shares for side in (-1, 1)]
    found = numeric.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(
        F.count(F.lit(1)).alias("_size"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
        F.percentile_approx("_v", ends, ACCURACY).alias("_ends"),
    )
    few = F.col("_size") <= WHOLE_ROWS

    def end(i: int, outer: str) -> Column:
        whole = F.lit(ends[i] in (0.0, 1.0)) | few
        return F.when(whole, F.col(outer)).otherwise(F.col("_ends")[i])

    pairs = range(0, len(ends), 2)
    return _fixed(found.select(
        *[f"_of_{c}" for c in by], "_size", F.array(*[end(i, "_least") for i in pairs]).alias("_low"),
        F.array(*[end(i + 1, "_most") for i in pairs]).alias("_high"),
    ))


def _cells(numeric: DataFrame, brackets: DataFrame, count: int, by: Sequence[str]) -> DataFrame:
    """Rows counted per value within a bracket and per gap outside of all: ``_n``, the largest value
    ``_at`` and ``_open`` rows of gaps. Cells of a group are in the order of ``_at``."""
    if by:
        match = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
        rows, low, high = numeric.join(brackets, match), F.col("_low"), F.col("_high")
        lows, highs = [low[i] for i in range(count)], [high[i] for i in range(count)]
    else:
        found = brackets.first()
        rows, lows, highs = numeric, [F.lit(v) for v in found["_low"]], [F.lit(v) for v in found["_high"]]
    value, within, passed = F.col("_v"), F.lit(False), F.lit(0)
    for low, high in zip(lows, highs, strict=True):
        within = within | ((value >= low) & (value <= high))
        passed = passed + F.when(value > high, 1).otherwise(0)
    told = rows.select(*by, "_v", within.alias("_within"), passed.alias("_passed"))
    held, gap = F.when(F.col("_within"), value), F.when(~F.col("_within"), F.col("_passed"))
    cells = told.groupBy(*by, held.alias("_held"), gap.alias("_gap")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_at"))
    return cells.select(*by, "_at", "_n", F.when(F.col("_held").isNull(), F.col("_n")).otherwise(0).alias("_open"))


def _at_shares(ranked: DataFrame, shares: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Per group ``n``, the quantiles ``q`` and whether one ``_missed`` its bracket. ``ranked`` has
    ``_at``, ``_n``, ``_n_before``, ``_n_all`` and ``_open``."""

    def holds(rank: Column) -> Column:
        return (F.col("_n_before") <= rank) & (rank < F.col("_n_before") + F.col("_n"))

    columns, missed = [], F.lit(False)
    for i, share in enumerate(shares):
        position = F.lit(float(share)) * (F.col("_n_all") - 1)
        for name, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            columns.append(F.max(F.when(holds(rank), F.col("_at"))).alias(f"_{name}{i}"))
            missed = missed | (holds(rank) & (F.col("_open") > 0))
    found = ranked.groupBy(*by).agg(
        F.coalesce(F.max("_n_all"), F.lit(0)).alias("n"), F.coalesce(F.max(missed), F.lit(False)).alias("_missed"), *columns)

    def between(i: int) -> Column:
        position = F.lit(float(shares[i])) * (F.col("n") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        # As ``percentile`` weighs them, so that results equal its to the last digit.
        weighed = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
        return F.when(low == high, low).otherwise(weighed)

    q = F.when(F.col("n") > 0, F.array(*[between(i) for i in range(len(shares))]))
    return found.select(*by, "n", q.alias("q"), "_missed")


def quantiles(
    df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles: per group ``n`` and the array ``q``; NaN is null.

    Without groups an empty table gives one row with ``n`` 0 and a null ``q``. Runs when called.
    """
    by = list(by)
    numeric = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    rising = sorted({float(s) for s in shares})
    brackets = _brackets(numeric, rising, by)
    cells = _cells(numeric, brackets, len(rising), by)
    largest = brackets.agg(F.max("_size")).first()[0] or 0
    if largest * 2 * MARGIN * len(rising) <= KEYS_PER_TASK:  # of one group, values in brackets
        group = Window.partitionBy(*by)
        smaller = group.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        ranked = cells.withColumns({
            "_n_before": F.coalesce(F.sum("_n").over(smaller), F.lit(0)), "_n_all": F.sum("_n").over(group)})
    else:
        ranked = running_totals(stage(cells, "cells"), "_at", {"_n": F.sum("_n"), "_open": F.sum("_open")}, by)
    found = _fixed(_at_shares(ranked, shares, by))
    missed = found.where("_missed")
    if missed.isEmpty():
        return found.drop("_missed")
    match = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    rest = numeric
    if by:
        rest = numeric.join(missed.select(*[F.col(c).alias(f"_of_{c}") for c in by]), match, "left_semi")
    whole = running_totals(rest.withColumnRenamed("_v", "_at"), "_at", {"_n": F.count(F.lit(1))}, by)
    again = _fixed(_at_shares(whole.withColumn("_open", F.lit(0)), shares, by))
    return found.where("NOT _missed").unionByName(again).drop("_missed")


def hash_key(id_col: str, seed: int) -> Column:
    """A reproducible pseudo-random key of a row, the same in any partitioning."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def _last_taken(keyed: DataFrame, need: dict, sizes: dict) -> dict:
    """Where a draw of ``need`` rows of each group ends: (key, take, tied). It takes all rows with a
    smaller key and ``take`` of the ``tied`` rows that have this one.

    ``keyed`` has ``_group`` (a few values) and ``_key`` (hexadecimal digits). Keys are counted by their
    leading digits; the prefix that holds the last row is counted again with more digits, until the
    rows left there, as counted, may be ordered by one task. Repeated keys are counts, never rows.
    """
    spark = keyed.sparkSession
    group_type = keyed.schema["_group"].dataType.simpleString()
    left = {g: ("", n, sizes[g]) for g, n in need.items()}  # prefix, rows still to take, rows there
    digits = 0
    while digits < KEY_DIGITS:
        few = max(rows for _, _, rows in left.values()) <= KEYS_PER_TASK
        cells = [(g, prefix, n) for g, (prefix, n, _) in left.items()]
        wanted = spark.createDataFrame(cells, f"_of {group_type}, _prefix string, _need long")
        inside = keyed.join(
            F.broadcast(wanted), (F.col("_group") == F.col("_of")) & (F.substring("_key", 1, digits) == F.col("_prefix"))
        )
        digits = KEY_DIGITS if few else min(KEY_DIGITS, digits + HEX_DIGITS)
        counts = inside.groupBy("_of", "_need", F.substring("_key", 1, digits).alias("_digits")).count()
        earlier = Window.partitionBy("_of").orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("_before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        last = placed.where(
            (F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("count"))
        ).collect()  # a row per group
        left = {r["_of"]: (r["_digits"], r["_need"] - r["_before"], r["count"]) for r in last}
    return left


def _numbered_as_they_lie(rows: DataFrame, by: str, out: str) -> DataFrame:
    """Append the number of each row within its group, from 0, in no particular order. The rows are
    written first, so that a task that runs again numbers them alike."""
    held = stage(rows.sortWithinPartitions(by).withColumn("_at", F.monotonically_increasing_id()), "alike")
    part = F.shiftright("_at", _ROW_BITS)
    runs = held.groupBy(F.col(by).alias("_in"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_in").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    starts = runs.select("_in", "_part", shift.alias("_shift"))  # a row per group and task
    placed = held.join(starts, (F.col(by) == F.col("_in")) & (part == F.col("_part")))
    return placed.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(out))


def mark_drawn(
    df: DataFrame, id_col: str, quotas: dict, by: str | None, sizes: dict, seed: int, out: str,
    told_by: Sequence[str] | None = None,
) -> DataFrame:
    """Append a flag: the row is among the ``quotas[group]`` first rows of its group, by the hash of
    the id, then by the digest of the whole row (or of the columns ``told_by``).

    ``quotas`` and ``sizes`` hold one number per group of ``by`` (a few bins), or one number under
    the key None. Sizes are exact whatever the ids: rows of the id at the end of a draw are told
    apart by their digests, rows alike in every column by number. Only those last ones are written;
    all others stay where they are. ``df`` is read more than once.
    """
    asked = {g: min(q, sizes[g]) for g, q in quotas.items() if min(q, sizes[g]) > 0}
    if not asked:
        return df.withColumn(out, F.lit(False))
    group = F.lit(0) if by is None else F.col(by)
    if by is None:
        asked, sizes = {0: asked[None]}, {0: sizes[None]}
    own, digest = hash_key(id_col, seed), row_digest(df, list(told_by or df.columns))
    last = _last_taken(df.select(group.alias("_group"), own.alias("_key")), asked, sizes)
    cells = {g: (key, None, True, 0) for g, (key, take, tied) in last.items()}
    shared = {g: cell for g, cell in last.items() if cell[1] < cell[2]}
    spark, group_type = df.sparkSession, "int" if by is None else df.schema[by].dataType.simpleString()
    if shared:
        ends = spark.createDataFrame([(g, key) for g, (key, _, _) in shared.items()], f"_of {group_type}, _end string")
        tied = df.select(group.alias("_group"), own.alias("_own"), digest.alias("_key")).join(
            F.broadcast(ends), (F.col("_group") == F.col("_of")) & (F.col("_own") == F.col("_end"))).select("_group", "_key")
        inner = _last_taken(tied, {g: take for g, (_, take, _) in shared.items()}, {g: n for g, (_, _, n) in shared.items()})
        cells.update({g: (last[g][0], key, take == n, take) for g, (key, take, n) in inner.items()})
    schema = f"_of {group_type}, _end string, _digest string, _whole boolean, _take long"
    table = spark.createDataFrame([(g, *cell) for g, cell in cells.items()], schema)
    if by is None:
        joined = with_row(df, "_draw", table).select(*df.columns, "_draw.*")
    else:
        joined = df.join(F.broadcast(table), group == F.col("_of"), "left")
    at_end = own == F.col("_end")
    before = F.col("_digest").isNull() | (digest < F.col("_digest"))
    level = F.col("_digest").isNotNull() & (digest == F.col("_digest"))
    drawn = F.coalesce((own < F.col("_end")) | (at_end & (before | (level & F.col("_whole")))), F.lit(False))
    marked = joined.withColumn(out, drawn)
    if all(whole for _, _, whole, _ in cells.values()):
        return marked.select(*df.columns, out)
    alike = F.coalesce(at_end & level & ~F.col("_whole"), F.lit(False))
    some = _numbered_as_they_lie(joined.where(alike).select(*df.columns, "_of", "_take"), "_of", "_place")
    some = some.withColumn(out, F.col("_place") < F.col("_take")).select(*df.columns, out)
    return marked.where(~alike).select(*df.columns, out).unionByName(some)


def first_n(df: DataFrame, n: int, keys: Sequence[Column]) -> DataFrame:
    """The n smallest rows by unique keys, in order. Only keys are ranked; whole rows stay where
    they are until n are left."""
    key = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    last = df.select(key.alias("_key")).orderBy("_key").limit(n).agg(F.max("_key")).scalar()
    return df.where(key <= last).orderBy(*keys)


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones in any partitioning, by the hash of the id and then
    the digest of the row. Ids may repeat or be null."""
    if n <= 100:  # a few keys per task
        own = hash_key(id_col, seed)
        last = df.select(own.alias("_own")).orderBy("_own").limit(n).agg(F.max("_own")).scalar()
        return df.where(own <= last).orderBy(own, row_digest(df, df.columns)).limit(n)
    total = df.count()
    if total <= n:
        return df
    drawn = mark_drawn(df, id_col, {None: n}, None, {None: total}, seed, "_drawn")
    return drawn.where("_drawn").drop("_drawn")


def largest_remainder(sizes: dict, share: float) -> dict:
    """Whole quotas per group that add up to ``ceil(total * share)``, as proportional as can be."""
    total = sum(sizes.values())
    target = math.ceil(round(total * share, 9))
    exact = {g: size * target / total for g, size in sizes.items()}
    quotas = {g: math.floor(e) for g, e in exact.items()}
    open_seats = target - sum(quotas.values())
    for g in sorted(sizes, key=lambda g: (quotas[g] - exact[g], g))[:open_seats]:
        quotas[g] += 1
    return quotas


def attach_by_key(
    rows: DataFrame, found: DataFrame, key: str, size: str, spread_by: str, staged: bool = False
) -> DataFrame:
    """Left join of one-row-per-key results to the rows of each key, whatever the key sizes.

    A key with more than a thousandth of all counted rows is looked up by broadcast (there are
    fewer than a thousand of those) and its rows are spread over many shuffle partitions by a hash
    of ``spread_by``, which must tell rows of a key apart and not change between task attempts.
    ``found`` is written once (unless ``staged`` already), because its total, its hot and its other
    keys are read separately.
    """
    found = found if staged else stage(found, "by-key")
    payload = [c for c in found.columns if c != key]
    total = found.agg(F.sum(size)).scalar()
    is_hot = F.col(size) * HOT_SHARE > total
    hot = found.where(is_hot).select(
        F.col(key).alias("_hot_key"), F.struct(*payload).alias("_hot")
    )
    cold = found.where(~is_hot).select(
        F.col(key).alias("_cold_key"), F.struct(*payload).alias("_cold")
    )
    looked_up = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").drop("_hot_key")
    spread = F.concat(F.col(key), F.lit("~"), F.pmod(F.xxhash64(spread_by), F.lit(HOT_SHARE)))
    lookup = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread)
    joined = looked_up.withColumn("_lookup", lookup).join(
        cold, F.col("_lookup") == F.col("_cold_key"), "left"
    )
    both = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[both[c].alias(c) for c in payload])
