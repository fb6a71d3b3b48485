"""Join shapes used across the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from meterproof.operators.ranges import in_ranges

#: Buckets that a period may touch; longer periods are joined like open-ended ones.
LONG = 1000
BUCKET_SECONDS = {"year": 365 * 86400, "month": 30 * 86400, "day": 86400}


def join_validity(
    facts: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
    bucket: str | None = None,
) -> DataFrame:
    """Facts with every period of the same key that covers their instant, [from, to).

    The key equality drives a hash or merge join and the range is a residual
    condition, which suits keys with a handful of periods. For keys with very long
    histories pass `bucket` ("year", "month", "day"): closed periods are then spread
    over the buckets they touch and join on (key, bucket), so that a fact meets only
    the periods of its own bucket. Open-ended periods, and those of more than LONG buckets
    such as an end in the year 9999, keep the plain condition.
    """
    if bucket is not None:
        return _bucketed(facts, periods, list(keys), at, valid_from, valid_to, how, bucket)
    left, right = facts.alias("f"), periods.alias("p")
    on = _same(keys) & _covers(at, valid_from, valid_to)
    joined = left.join(right, on, how)
    return joined.drop(*[F.col(f"p.{key}") for key in keys])


#: Facts in a cell of `sweep_validity`. A period is carried once for every CELL facts that it covers and compared with
#: no more than two cells of facts that it does not.
CELL = 128


def sweep_validity(
    facts: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
    how: str = "inner", slices: int | None = None, cell: int = CELL,
) -> DataFrame:
    """`join_validity` for keys that own most facts or very many periods: a sweep over slices of time.

    Facts and both borders of every period are ordered together by (key, time) and dealt to range
    partitions. A fact's rank is the number of facts before it, so a period covers the facts from the rank
    at its start to that at its end, and is carried into the cells of `cell` facts that hold them only. Beside the
    pairs it returns, the work grows with facts and periods, however the keys and instants are
    distributed; the pairs of one instant are spread over its cells. Open ends reach to the last
    fact of their key. `how` is inner or left; NULL keys and instants match nothing, and
    repeated facts and periods count each time.
    """
    if how not in ("inner", "left"):
        raise ValueError("sweeps are inner or left joins")
    keys = list(keys)
    named = [F.col(c).isNotNull() for c in keys]
    live = (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))) & F.col(valid_from).isNotNull()
    for condition in named:
        live = live & condition
    # At one instant borders come before facts: a period that starts then covers them, one that ends then does not.
    side = {"_fact": facts.schema, "_period": periods.schema}
    fact_rows = facts.select(*keys, F.lit(0).alias("_endless"), F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(*facts.columns).alias("_lot"), F.struct(*facts.columns).alias("_fact"), F.lit(None).cast(side["_period"]).alias("_period"))
    border = [F.lit(0).alias("_kind"), F.xxhash64(*periods.columns).alias("_lot"), F.lit(None).cast(side["_fact"]).alias("_fact"), F.struct(*periods.columns).alias("_period")]
    alive = periods.where(live)
    starts = alive.select(*keys, F.lit(0).alias("_endless"), F.col(valid_from).alias("_t"), *border)
    ends = alive.select(*keys, F.col(valid_to).isNull().cast("int").alias("_endless"), F.col(valid_to).alias("_t"), *border)
    rows = in_ranges(fact_rows.unionByName(starts).unionByName(ends), [*keys, "_endless", "_t", "_kind", "_lot"], slices)
    # One row per slice, whatever the input.
    totals = rows.groupBy("_slice").agg(F.sum("_kind").alias("_facts"))
    before = totals.select(F.col("_slice").alias("_s"), (F.sum("_facts").over(Window.orderBy("_slice")) - F.col("_facts")).alias("_before"))
    so_far = F.sum("_kind").over(Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = rows.withColumn("_in_slice", so_far - F.col("_kind")).join(before, F.col("_slice") == F.col("_s")).withColumns({"_rank": F.col("_before") + F.col("_in_slice"), "_key": F.xxhash64(*keys)})
    spans = ranked.where("_kind = 0").groupBy("_period").agg(F.min("_rank").alias("_a"), F.max("_rank").alias("_b"), F.min("_key").alias("_key"), (F.count(F.lit(1)) / 2).cast("int").alias("_copies"))
    rest = [c for c in periods.columns if c not in keys]
    carried = (
        spans.where("_a < _b").select("_a", "_b", "_key", "_copies", *[F.col(f"_period.{c}").alias(f"_p{i}") for i, c in enumerate(rest)])
        .withColumn("_cell", F.explode(F.expr(f"sequence(_a div {cell}, (_b - 1) div {cell})"))).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
        .withColumn("_p_at", F.xxhash64("_cell", "_key")).drop("_cell", "_key")
    )
    found = ranked.where("_kind = 1").select("_rank", F.xxhash64(F.expr(f"_rank div {cell}"), "_key").alias("_f_at"), *[F.col(f"_fact.{c}").alias(f"_f{i}") for i, c in enumerate(facts.columns)])
    # Ranks alone decide; the hash of cell and keys only keeps keys that share a cell apart, in one number that sorts fast.
    covers = (F.col("_rank") >= F.col("_a")) & (F.col("_rank") < F.col("_b"))
    joined = found.join(carried, (F.col("_f_at") == F.col("_p_at")) & covers, how)
    return joined.select(*[F.col(f"_f{i}").alias(c) for i, c in enumerate(facts.columns)], *[F.col(f"_p{i}").alias(c) for i, c in enumerate(rest)])


#: Periods of a key up to which every one of them is compared with each of the key's facts.
SHORT = 64


def mixed_validity(facts: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, by: str, sizes: DataFrame) -> DataFrame:
    """Facts with every period that covers them, or none: `join_validity` for keys of up to SHORT periods, a sweep for the others.

    A key that owns most facts is spread by the facts' column `by`; `sizes` holds the number of facts (`n`) of every key.
    Whether any key has a longer history is looked up at once, in the periods.
    """
    keys = list(keys)
    longer = periods.groupBy(*keys).agg(F.count(F.lit(1)).alias("_periods")).where(F.col("_periods") > SHORT).select(*keys)

    def short(facts: DataFrame, periods: DataFrame) -> DataFrame:
        salted, copies = spread(facts, periods, keys, by, sizes)
        return join_validity(salted, copies, [*keys, "_salt"], at, how="left").drop("_salt")

    if longer.isEmpty():
        return short(facts, periods)
    swept = sweep_validity(facts.join(longer, keys, "left_semi").select(*facts.columns), periods.join(longer, keys, "left_semi").select(*periods.columns), keys, at, how="left")
    rest = short(facts.join(longer, keys, "left_anti").select(*facts.columns), periods.join(longer, keys, "left_anti").select(*periods.columns))
    return rest.unionByName(swept)


#: Copies of each row of the small side of `spread_join`.
SALTS = 64
#: Rows of one key that one task of `spread_join` takes when the numbers are known.
SHARE = 100_000


def spread_join(rows: DataFrame, few: DataFrame, keys: Sequence[str], by: str, sizes: DataFrame | None = None) -> DataFrame:
    """Inner join with `few`, which has few rows per key and far fewer keys than `rows` has rows.

    Every row of `few` is repeated SALTS times and rows pick one copy by their column `by`, so
    a key that owns most of the rows is joined in as many tasks, whatever the sizes.

    With many keys give their numbers of rows as `sizes`: see `spread`.
    """
    if sizes is None:
        copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    else:
        salted, copies = spread(rows, few, keys, by, sizes)
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def spread(rows: DataFrame, few: DataFrame, keys: Sequence[str], by: str, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on `keys` and `_salt`, in which a key is repeated once per SHARE of its rows, so most keys are not.

    `sizes` holds the keys and the number of their rows (`n`). Neither side is broadcast; told to every task are
    the keys of more than SHARE rows only, which are fewer than one per SHARE rows.
    """
    large = sizes.where(F.col("n") > SHARE).groupBy(*keys).agg(F.ceil(F.max("n") / SHARE).cast("int").alias("_salts"))
    salts = F.coalesce("_salts", F.lit(1))

    def told(side: DataFrame) -> DataFrame:
        return side.join(F.broadcast(large), [*keys], "left").select(*side.columns, "_salts")

    copies = told(few).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return told(rows).withColumn("_salt", F.pmod(F.xxhash64(by), salts).cast("int")).drop("_salts").hint("merge"), copies


def _same(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"f.{key}") == F.col(f"p.{key}"))
    return condition


def _covers(at: str, valid_from: str, valid_to: str) -> Column:
    return (F.col(f"f.{at}") >= F.col(f"p.{valid_from}")) & (
        F.col(f"p.{valid_to}").isNull() | (F.col(f"f.{at}") < F.col(f"p.{valid_to}"))
    )


def _bucketed(facts, periods, keys, at, valid_from, valid_to, how, bucket):
    if how != "inner":
        raise ValueError("bucketed validity joins are inner joins")
    first, last = F.date_trunc(bucket, valid_from), F.date_trunc(bucket, valid_to)
    seconds = F.unix_seconds(valid_to) - F.unix_seconds(valid_from)
    long = seconds > LONG * BUCKET_SECONDS[bucket]
    closed = periods.where((F.col(valid_to) > F.col(valid_from)) & ~long).withColumn(
        "_bucket", F.explode(F.sequence(first, last, F.expr(f"INTERVAL 1 {bucket}")))
    )
    opened = periods.where(F.col(valid_to).isNull() | long)
    by_bucket = join_validity(
        facts.withColumn("_bucket", F.date_trunc(bucket, at)),
        closed,
        [*keys, "_bucket"],
        at,
        valid_from,
        valid_to,
    ).drop("_bucket")
    return by_bucket.unionByName(join_validity(facts, opened, keys, at, valid_from, valid_to))


def key_set_diff(wanted: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are missing from, extra in or repeated in `found`.

    Both sides are counted in one aggregation, so a key repeated a billion times
    costs one counter rather than a billion joined rows.
    """
    keys = list(keys)
    sides = wanted.select(*keys, F.lit(1).alias("_w"), F.lit(0).alias("_f")).unionByName(
        found.select(*keys, F.lit(0).alias("_w"), F.lit(1).alias("_f"))
    )
    counted = sides.groupBy(*keys).agg(
        F.sum("_w").alias("wanted_rows"), F.sum("_f").alias("found_rows")
    )
    kind = (
        F.when(F.col("found_rows") == 0, "missing")
        .when(F.col("wanted_rows") == 0, "extra")
        .when((F.col("found_rows") > 1) | (F.col("wanted_rows") > 1), "duplicate")
    )
    return counted.withColumn("difference", kind).where(F.col("difference").isNotNull())
