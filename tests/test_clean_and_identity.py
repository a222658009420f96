from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fiscal, text
from ledgerloom.operators import clean, geography, identity


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def day(text_):
    return F.lit(text_).cast("date")


@pytest.mark.parametrize("when, year, quarter", [
    ("2023-03-31", "FY2023", "FY2023-Q4"), ("2023-04-01", "FY2024", "FY2024-Q1"),
    ("2023-12-31", "FY2024", "FY2024-Q3"), ("2024-01-01", "FY2024", "FY2024-Q4"),
    ("2024-02-29", "FY2024", "FY2024-Q4"), ("2024-05-31", "FY2025", "FY2025-Q1"),
])
def test_fiscal_labels(spark, when, year, quarter):
    index = fiscal.fiscal_index(day(when))
    assert value(spark, fiscal.fiscal_year(day(when))) == year
    assert value(spark, fiscal.fiscal_quarter(day(when))) == quarter
    assert value(spark, fiscal.year_of_index(index)) == year
    assert value(spark, fiscal.quarter_of_index(index)) == quarter


def test_fiscal_parameters(spark):
    assert value(spark, fiscal.fiscal_year(day("2023-05-01"), label_by="start")) == "FY2023"
    assert value(spark, fiscal.fiscal_year(day("2023-05-01"), start_month=1)) == "FY2023"
    with pytest.raises(ValueError):
        fiscal.fiscal_year(day("2023-05-01"), label_by="middle")


def test_offset_moves_a_sale_over_the_fiscal_year(spark):
    instant = text.utc_instant(F.lit("2026-03-31T23:30:00-05:00"))
    assert value(spark, instant) == dt.datetime(2026, 4, 1, 4, 30)
    assert value(spark, fiscal.fiscal_year(instant.cast("date"))) == "FY2027"
    assert value(spark, text.utc_instant(F.lit("no time"))) is None


def test_keys(spark):
    assert value(spark, text.email_key(F.lit("  A@B.c "))) == "a@b.c"
    assert value(spark, text.email_key(F.lit("   "))) is None
    assert value(spark, text.country_key(F.lit(" u.s. a "))) == "USA"
    assert value(spark, text.default_if_missing(F.lit(""), "?")) == "?"


def test_quarantine_keeps_the_input_whole(spark):
    rows = spark.createDataFrame([("1", "x"), ("N/A", "2"), (None, None)], "a string, b string")
    judged = clean.quarantine(rows, {"a_n": ("a", "bigint"), "b_n": ("b", "int")})
    assert clean.good_rows(judged).count() + clean.bad_rows(judged).count() == 3
    reasons = [r["bad_reason"] for r in clean.bad_rows(judged).orderBy("a").collect()]
    assert reasons == ["a is missing; b is missing", "b is not int", "a is not bigint"]


def test_latest_delivery_picks_version_then_tiebreak(spark):
    rows = [(1, 1, "a", 9), (1, 2, "b", 1), (1, 2, "b", 3), (2, 1, None, None)]
    frame = spark.createDataFrame(rows, "id int, version int, name string, n int")
    got = clean.latest_delivery(frame, ["id"], "version", ["n"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 2, "b", 3), (2, 1, None, None)]


def test_dealt_out_rows_lose_their_copies_and_no_other(spark, monkeypatch):
    """Copies, keys without value, numbers that are equal and written differently; in many pieces and in one."""
    monkeypatch.setattr(clean, "ROWS_SIDE_BY_SIDE", 3)
    nan = float("nan")
    seen = [(1, "a", 0.0, 1), (1, "a", -0.0, 2), (1, "a", 0.5, 1), (None, "b", nan, 1), (None, "b", nan, 1),
            (None, None, None, 1), (None, None, None, 2)] + [(7, "x", 1.0, 1)] * 50 + [(i, "y", 1.0, 1) for i in range(40)]
    frame = spark.createDataFrame(seen, "id long, name string, price double, version int")
    rows = lambda f: sorted(str(tuple(r)).replace("-0.0", "0.0") for r in f.collect())
    plain = rows(clean.latest_delivery(frame, ["id", "name", "price"], "version"))
    assert len(plain) == 45
    for keys in (["id", "name", "price"], ["price", "name", "id"]):
        for n_rows in (0, 1, len(seen)):
            got = clean.latest_delivery(frame, keys, "version", n_rows=n_rows).select("id", "name", "price", "version")
            assert rows(got) == plain
    assert rows(clean.latest_delivery(frame.select("price", "version"), ["price"], "version", n_rows=99)) == rows(
        clean.latest_delivery(frame.select("price", "version"), ["price"], "version"))


def test_flags_drop_nothing(spark):
    rows = spark.createDataFrame([(1,), (None,)], "a int")
    assert [r["odd"] for r in clean.flag(rows, odd=F.col("a") == 1).collect()] == [True, False]


COUNTRIES = [("N1", "Nation One"), ("N2", "N1"), ("N3", "Nation  3")]


def test_country_lookup_never_fans_out(spark):
    """Two countries claim one spelling; every row still comes back once."""
    aliases = geography.alias_table(spark.createDataFrame(COUNTRIES, "country string, country_name string"))
    rows = spark.createDataFrame(
        [(1, "nation-one"), (2, " n1"), (3, "NATION 3"), (4, "nowhere"), (5, None), (6, "")],
        "id int, txt string",
    )
    got = {r["id"]: r["country"] for r in geography.conform_country(rows, aliases, "txt").collect()}
    assert got == {1: "N1", 2: "N1", 3: "N3", 4: "UNKNOWN", 5: "UNKNOWN", 6: "UNKNOWN"}


def test_identity(spark):
    store = spark.createDataFrame(
        [(1, "A@x"), (2, " a@X "), (3, None), (4, ""), (5, "b@x")], "sid bigint, email string"
    )
    web = spark.createDataFrame(
        [(10, "a@x"), (11, None), (12, "c@x"), (13, "C@X")], "wid bigint, email string"
    )
    people = identity.resolve(store, web, "sid", "wid")
    got = sorted((r["person_id"], r["store_id"], r["web_id"]) for r in people.collect())
    assert got == [
        ("E:a@x", 1, 10), ("E:b@x", 5, None), ("E:c@x", None, 12),
        ("S:3", 3, None), ("S:4", 4, None), ("W:11", None, 11),
    ]
    twice = sorted(r["email_key"] for r in identity.duplicate_emails(people).collect())
    assert twice == ["a@x", "c@x"]
    master = spark.createDataFrame([(1, "Ann", "N1")], "cust_id bigint, name string, country string")
    dim = {r["customer_id"]: (r["name"], r["country"]) for r in
           identity.dim_customer(people, master).collect()}
    assert dim["E:a@x"] == ("Ann", "N1") and dim["W:11"] == ("UNKNOWN", "UNKNOWN")
    assert len(dim) == 6
