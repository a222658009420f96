"""Declared schemas and fixed vocabularies. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "str": T.StringType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ntz": T.TimestampNTZType(),
    "money": T.DecimalType(19, 4),
    "total": T.DecimalType(38, 4),
}


def struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns.items()])


TABLES = {
    "region": struct(r_regionkey="int", r_name="str"),
    "nation": struct(n_nationkey="int", n_name="str", n_regionkey="int"),
    "customer": struct(
        c_custkey="long", c_name="str", c_nationkey="int", c_acctbal="double", c_mktsegment="str"
    ),
    "supplier": struct(s_suppkey="long", s_name="str", s_nationkey="int", s_acctbal="double"),
    "part": struct(
        p_partkey="long", p_name="str", p_brand="str", p_type="str", p_size="int",
        p_retailprice="double",
    ),
    "orders": struct(
        o_orderkey="long", o_custkey="long", o_orderstatus="str", o_totalprice="double",
        o_orderdate="ntz", o_orderpriority="str",
    ),
    "lineitem": struct(
        l_orderkey="long", l_partkey="long", l_suppkey="long", l_linenumber="int",
        l_quantity="double", l_extendedprice="double", l_discount="double", l_tax="double",
        l_returnflag="str", l_linestatus="str", l_shipdate="ntz",
    ),
    "events": struct(
        event_id="long", ts="ntz", user_id="long", event_type="str", value="double", props="str"
    ),
}

# The store's customer export is 101 columns wide: six we read and ninety-five we do not.
STORE_CUSTOMER_CORE = struct(
    cust_id="long", name="str", email="str", country_text="str", segment="str", balance="money"
)
STORE_CUSTOMER_FILLERS = [f"attr_{i:03d}" for i in range(1, 96)]
STORE_CUSTOMER = T.StructType(
    STORE_CUSTOMER_CORE.fields + [T.StructField(c, T.StringType()) for c in STORE_CUSTOMER_FILLERS]
)

# Quantity stays text here: the feed carries rows whose quantity is not a number.
STORE_ORDER_EVENT = struct(
    order_key="long", line_no="int", part_key="long", supp_key="long", quantity_text="str",
    price="money", discount="double",
)

WEB_ORDER = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("placed_on", T.DateType()),
        T.StructField(
            "lines",
            T.ArrayType(struct(event_id="long", placed_at="str", k="int", amount="money")),
        ),
    ]
)

PRODUCT_MASTER = struct(part_key="long", sku="int", department="str", product_segment="str")

CHANGE_ROW = struct(value="money", event_type="str", k="int")
# The connector's envelope: the log position is nested, the instant counts microseconds.
CHANGE_ENVELOPE = T.StructType(
    [
        T.StructField("before", CHANGE_ROW),
        T.StructField("after", CHANGE_ROW),
        T.StructField("source", struct(lsn="long")),
        T.StructField("op", T.StringType()),
        T.StructField("ts_us", T.LongType()),
    ]
)
CHANGE_KEY = struct(user_id="long")
# A topic record as landed in a file; a null value is a tombstone.
CHANGE_RECORD = struct(
    topic="str", topic_partition="int", topic_offset="long", key="str", value="str"
)
CHANGE_OPS = ["c", "r", "u", "d"]

RUN_EVENT = struct(
    run="long", seq="long", kind="str", status="str", job_type="str", failure_reason="str",
    activity="str", error="str", retry="int", producer="str", dropped="long",
)

SUMMARY_AXES = [
    "fiscal_year", "fiscal_quarter", "department", "product_segment", "customer_segment",
    "country", "channel",
]
SUMMARY = struct(
    **{axis: "str" for axis in SUMMARY_AXES},
    sale_lines="long", units="long", revenue_usd="total", cancelled_usd="total",
    carried_rate_usd="total",
)
DAILY = struct(order_date="date", country="str", orders="long", units="long", revenue="total")
DIM_CUSTOMER = struct(customer_id="str", name="str", country="str")
DIM_COUNTRY = struct(country="str", country_name="str")

# --- fixed values -----------------------------------------------------------------------------
FISCAL_START_MONTH = 4
CHANNELS = ["store", "web"]
UNKNOWN = "UNKNOWN"
# Run-event vocabulary.
JOB_STATUS_FINE = ["Started", "NotStarted", "InProgress", "Completed"]
STATUS_FAILED = "Failed"
PRODUCERS_OBSERVED = ["Copy", "NotebookObserved", "Warehouse", "DirectLake"]
PRODUCERS_CLAIMED = ["Notebook", "Reported"]
FINDINGS_SHOWN = 60

# Contracts that a build publishes, by name.
PUBLISHED_CONTRACTS = [
    "channels_present", "country_resolves", "fiscal_is_not_calendar", "money_is_decimal",
    "summary_conserves_revenue", "not_empty", "not_all_zero", "expected_counts", "unique",
    "not_null", "accepted_values", "relationship", "no_orphan_lines", "rate_is_known",
]
