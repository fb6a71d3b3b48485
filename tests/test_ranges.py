"""Scans over range partitions against brute force; one tariff has nine tenths of the rows."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterproof.operators.joins import sweep_validity
from meterproof.operators.ranges import in_ranges
from meterproof.operators.tariffs import tariff_overlaps_all

T = datetime(2026, 1, 1)
PERIODS = "run_id STRING, tariff_id STRING, valid_from TIMESTAMP, valid_to TIMESTAMP, currency STRING, payload STRING, payload_hash STRING"


def day(n):
    return None if n is None else T + timedelta(days=n)


def made_up(count, span, longest, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        tariff = "hot" if pick.random() < 0.9 else f"t{pick.randrange(5)}"
        start = pick.randrange(span)
        end = None if pick.random() < 0.01 else start + pick.randrange(0, longest)
        rows.append(("r", tariff, start, end, f"p{i}"))
    return rows + [("r", None, 3, 9, "n"), ("r", "gone", None, 5, "s"), ("r", "gone", 4, 6, "e")]


def frame(spark, rows):
    return spark.createDataFrame([(r, t, day(a), day(b), "EUR", p, p) for r, t, a, b, p in rows], PERIODS)


def brute_overlaps(rows):
    far = 10**9
    live = [(r, t, -far if a is None else a, far if b is None else b, p) for r, t, a, b, p in rows]
    live = [x for x in live if x[3] > x[2]]
    found = {}
    for x in live:
        others = [y for y in live if y is not x and y[:2] == x[:2] and y[2] < x[3] and x[2] < y[3]]
        earlier = any((y[2], y[3], y[4]) < (x[2], x[3], x[4]) for y in others)
        later = any((y[2], y[3], y[4]) > (x[2], x[3], x[4]) for y in others)
        if others:
            found[x[4]] = (earlier, later)
    return found


@pytest.mark.parametrize("slices", [1, 7])
def test_all_overlaps(spark, slices):
    rows = made_up(400, 4000, 40)
    found = {r.payload: (r.overlaps_earlier, r.overlaps_later) for r in tariff_overlaps_all(frame(spark, rows), slices).collect()}
    assert found == brute_overlaps(rows) and 50 < len(found) < 400


def test_enclosed_periods_are_listed(spark):
    rows = [("r", "t", 0, 360, "year"), ("r", "t", 30, 60, "spring"), ("r", "t", 120, 150, "summer"), ("r", "t", 360, 400, "next")]
    twice = frame(spark, rows + rows[:1])
    found = {r.payload: (r.overlaps_earlier, r.overlaps_later) for r in tariff_overlaps_all(twice, 3).collect()}
    assert found == {"year": (False, True), "spring": (True, False), "summer": (True, False)}
    assert tariff_overlaps_all(twice.limit(0)).collect() == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("slices", [1, 9])
def test_sweep(spark, how, slices):
    pick = random.Random(2)
    periods = made_up(200, 900, 30, seed=3)
    periods += periods[:3]  # repeated rows count each time
    facts = [("r", "hot" if i % 10 else pick.choice(["t1", "t2", "none"]), pick.randrange(960), i) for i in range(500)]
    facts += [("r", "hot", 77, 1000 + i) for i in range(80)] + [("r", None, 5, 2000), ("r", "hot", None, 2001), ("r", "hot", 77, 1000)]
    df = spark.createDataFrame([(r, t, day(a), i) for r, t, a, i in facts], "run_id STRING, tariff_id STRING, at TIMESTAMP, fact LONG")
    got = sweep_validity(df, frame(spark, periods), ["run_id", "tariff_id"], "at", how=how, slices=slices)
    assert got.columns == ["run_id", "tariff_id", "at", "fact", "valid_from", "valid_to", "currency", "payload", "payload_hash"]
    wanted = Counter()
    for r, t, a, i in facts:
        hits = [p for q, u, b, e, p in periods if (q, u) == (r, t) and t is not None and None not in (a, b) and b <= a and (e is None or a < e)]
        wanted.update((i, p) for p in hits)
        if not hits and how == "left":
            wanted[i, None] += 1
    assert Counter((x.fact, x.payload) for x in got.collect()) == wanted and len(wanted) > 400
    with pytest.raises(ValueError):
        sweep_validity(df, frame(spark, periods), ["run_id", "tariff_id"], "at", how="full")


def test_pairs_of_one_instant_are_spread(spark):
    """All sessions of one instant cover each other: their pairs are as many tasks' work, also where they share a slice."""
    df = spark.createDataFrame([("r", "hot", day(5), i) for i in range(400)], "run_id STRING, tariff_id STRING, at TIMESTAMP, fact LONG")
    periods = frame(spark, [("r", "hot", 5, 6, f"p{i}") for i in range(400)])
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        got = sweep_validity(df, periods, ["run_id", "tariff_id"], "at", slices=1, cell=20)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in held:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 400 * 400 and len(sizes) >= 4 and max(sizes) <= 400 * 200


@pytest.mark.parametrize("cell", [1, 3, 1000])
def test_cells_of_any_size(spark, cell):
    periods = made_up(60, 90, 30, seed=5) + [("r", "t0", 3, 3, "empty"), ("r", "t0", 9, 3, "turned"), ("r", "hot", 95, 96, "late"), ("r", "late", 1, None, "open")]
    facts = [("r", t, i % 97, i) for i, t in enumerate(["hot", "hot", "t0", "t1", "late"] * 40)] + [("r", None, 4, 900), ("r", "hot", None, 901), (None, "hot", 7, 902)]
    df = spark.createDataFrame([(r, t, day(a), i) for r, t, a, i in facts], "run_id STRING, tariff_id STRING, at TIMESTAMP, fact LONG")
    wanted = Counter()
    for r, t, a, i in facts:
        hits = [p for q, u, b, e, p in periods if (q, u) == (r, t) and t is not None and None not in (a, b) and b <= a and (e is None or a < e)]
        wanted.update((i, p) for p in hits or [None])
    got = sweep_validity(df, frame(spark, periods), ["run_id", "tariff_id"], "at", how="left", slices=3, cell=cell)
    assert Counter((x.fact, x.payload) for x in got.collect()) == wanted
    none = sweep_validity(df, frame(spark, periods).limit(0), ["run_id", "tariff_id"], "at", how="left", cell=cell).collect()
    assert len(none) == len(facts) and not any(x.payload for x in none)
    assert sweep_validity(df.limit(0), frame(spark, periods), ["run_id", "tariff_id"], "at", how="left", cell=cell).collect() == []


def test_a_hot_key_lies_in_many_slices(spark):
    rows = in_ranges(frame(spark, made_up(2000, 4000, 40)), ["run_id", "tariff_id", "valid_from", "payload"], 8)
    sizes = [r["count"] for r in rows.where("tariff_id = 'hot'").groupBy("_slice").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 600
    places = [r[0] for r in rows.orderBy("run_id", "tariff_id", "valid_from", "payload").select(F.col("_place")).collect()]
    assert places == sorted(places)
