from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators import fx

D = dt.date
QUOTES = "currency string, day date, rate decimal(18,8)"
LINES = "id int, currency string, order_date date, amount decimal(19,4)"


def quotes(spark):
    rows = [
        ("A", D(2024, 1, 5), Decimal("2")),  # Friday
        ("A", D(2024, 1, 8), Decimal("3")),  # Monday
        ("B", D(2024, 1, 8), Decimal("5")),
    ]
    return spark.createDataFrame(rows, QUOTES)


def lines(spark):
    one = Decimal("1")
    rows = [
        (1, "A", D(2024, 1, 5), one), (2, "A", D(2024, 1, 7), one), (3, "A", D(2024, 1, 8), one),
        (4, "A", D(2024, 1, 4), one), (5, "B", D(2024, 1, 7), one), (6, "A", D(2024, 3, 1), one),
        (7, "Z", D(2024, 1, 8), one), (8, None, D(2024, 1, 8), one), (9, "A", None, one),
        (10, "B", D(2024, 2, 1), one),
    ]
    return spark.createDataFrame(rows, LINES)


EXPECTED = {
    1: (2, "quoted"), 2: (2, "carried"), 3: (3, "quoted"), 4: (None, "missing"),
    5: (None, "missing"), 6: (3, "carried"), 7: (None, "missing"), 8: (None, "missing"),
    9: (None, "missing"), 10: (5, "carried"),
}


def rated(frame):
    return {r["id"]: (r["rate"] and int(r["rate"]), r["rate_status"]) for r in frame.collect()}


def test_each_line_takes_the_last_rate_and_none_is_lost(spark):
    assert rated(fx.with_rate(lines(spark), fx.calendar(quotes(spark)))) == EXPECTED


def test_a_calendar_too_large_to_broadcast_gives_the_same(spark):
    frame = fx.with_rate(lines(spark), fx.calendar(quotes(spark), broadcast_rows=0))
    assert rated(frame) == EXPECTED


def test_no_quotes_at_all(spark):
    frame = fx.with_rate(lines(spark), fx.calendar(quotes(spark).filter("false")))
    assert {v for v in rated(frame).values()} == {(None, "missing")}


def test_convert_rounds_half_up(spark):
    row = spark.range(1).select(
        F.lit("0.00005").cast("decimal(19,5)").alias("amount"),
        F.lit("1").cast("decimal(18,8)").alias("rate"),
    )
    assert fx.to_usd(row).first()["usd"] == Decimal("0.0001")


def test_carry_forward_fills_each_day(spark):
    got = fx.carry_forward(quotes(spark), "currency", "day", "rate").orderBy("currency", "day")
    rows = [(r["currency"], r["day"].day, int(r["rate"]), r["status"]) for r in got.collect()]
    assert rows == [
        ("A", 5, 2, "quoted"), ("A", 6, 2, "carried"), ("A", 7, 2, "carried"),
        ("A", 8, 3, "quoted"), ("B", 8, 5, "quoted"),
    ]


def brute(probes, quotes_):
    answer = {}
    for pid, key, ts in probes:
        best = [q for q in quotes_ if q[0] == key and key is not None and q[1] <= ts]
        answer[pid] = max(best, key=lambda q: (q[1], q[3]))[2] if best else None
    return answer


def test_asof_of_large_sides_equals_brute_force(spark):
    """One key holds most rows, instants collide, buckets are narrow and often empty."""
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
    when = lambda: start + dt.timedelta(seconds=rng.randrange(4000))
    probes = [(i, key(), when()) for i in range(900)]
    quotes_ = [(key(), when(), rng.randrange(1000), i) for i in range(300)]
    p = spark.createDataFrame(probes, "id int, k string, ts timestamp_ntz")
    q = spark.createDataFrame(quotes_, "k string, at timestamp_ntz, price int, n int")
    for width in (7, 600, 10_000):
        got = fx.asof_join(p, q, "k", "ts", "at", "price", "n", bucket_seconds=width).collect()
        assert len(got) == len(probes)
        assert {r["id"]: r["asof_price"] for r in got} == brute(probes, quotes_)
