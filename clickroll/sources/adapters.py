"""Adapters that present the driver's tables in the event contract.

Event contract (one row per event)::

    row_no        orderable input position (bigint, or a struct for adapter B)
    user_id       bigint
    user_session  string
    event_type    string
    product_id    bigint
    category_id   bigint (string for adapter B)
    event_time    timestamp_ntz
    split         'train' | 'test'

``EventSource.labeled`` adds ``session_value`` to the train rows; ``label_rows`` holds
the rows that labels are taken from; ``template`` lists the test sessions to be
predicted, with their own ``row_no`` order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickroll.session import materialize

CONTRACT_COLUMNS = ["row_no", "user_id", "user_session", "event_type", "product_id",
                    "category_id", "event_time", "split"]

# Event type names of the clickstream table mapped to the reference's names.
CLICKSTREAM_TYPE_NAMES = {"view": "VIEW", "click": "CART", "purchase": "BUY"}
# train/test boundary of the clickstream table (data spans 2024-01-01..2024-01-30).
CLICKSTREAM_TEST_FROM = "2024-01-25 00:00:00"

# Return flags of the order lines mapped to event types.
LINEITEM_TYPE_NAMES = {"N": "VIEW", "R": "CART", "A": "BUY"}
# Orders placed from this date on form the test split.
LINEITEM_TEST_FROM = "2000-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_names(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(default if default is not None else F.lit(None))


@dataclass
class EventSource:
    """Events, their train / test parts, the labelled train rows and the template.

    ``labeled`` (train rows with ``session_value``) is built when first asked for.
    ``label_rows`` are enough of its rows, the first of each (user, session) included, to
    derive every label from; all of them unless the adapter has a shorter way.

    ``train`` and ``test`` filter the raw rows before the contract projection, so the
    split predicate reaches the parquet scan (row-group skipping on the time column)
    instead of a derived ``split = 'train'`` test on every row.
    """

    events: DataFrame
    train: DataFrame
    test: DataFrame
    make_labeled: Callable[[], DataFrame]
    template: DataFrame         # user_session, session_value, row_no
    name: str = "events"
    extras: dict = field(default_factory=dict)
    first_rows: DataFrame | None = None
    time_col: str | None = "event_time"       # parsed time; None: the input has no time column
    row_time_col: str | None = "event_time"   # what the trainers' last rows are ordered by

    @cached_property
    def labeled(self) -> DataFrame:
        return self.make_labeled()

    @property
    def label_rows(self) -> DataFrame:
        return self.labeled if self.first_rows is None else self.first_rows


def test_template(test_events: DataFrame) -> DataFrame:
    """Distinct test sessions, ordered by their first event; target column pre-filled."""
    return (test_events.where(F.col("user_session").isNotNull())
            .groupBy("user_session").agg(F.min("row_no").alias("row_no"))
            .withColumn("session_value", F.lit(0.0)))


def clickstream_contract(raw: DataFrame) -> DataFrame:
    """Row-wise mapping of the ``events`` table to the contract (plus ``value``);
    works on batch and streaming frames alike."""
    et = F.lower(F.col("event_type"))
    product = F.get_json_object("props", "$.k").cast("bigint")
    ev = raw.select(
        F.col("event_id").alias("row_no"),
        F.col("user_id"),
        # the day of a wall-clock timestamp_ntz: no session time zone involved
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.to_date("ts").cast("string")).alias("user_session"),
        _map_names(et, CLICKSTREAM_TYPE_NAMES, F.upper(F.col("event_type"))).alias("event_type"),
        product.alias("product_id"),
        (product % 10).alias("category_id"),
        F.col("ts").alias("event_time"),
        F.when(F.col("ts") < F.lit(CLICKSTREAM_TEST_FROM).cast("timestamp_ntz"), F.lit("train"))
         .otherwise(F.lit("test")).alias("split"),
        F.col("value"),
    )
    return ev


def clickstream_source(spark: SparkSession, sf_dir: str) -> EventSource:
    """Adapter A over ``events``: a session is one user's day of events.

    ``session_value`` is the session's sum of ``value`` (summed as DECIMAL(18,2), so it
    is exact) repeated on each train row.
    """
    raw = read_table(spark, sf_dir, "events")
    cut = F.lit(CLICKSTREAM_TEST_FROM).cast("timestamp_ntz")
    events = clickstream_contract(raw).drop("value")
    train_v = clickstream_contract(raw.where(F.col("ts") < cut))
    test = clickstream_contract(raw.where((F.col("ts") >= cut) | F.col("ts").isNull())).drop("value")
    # Labels need no event-level join: a partial aggregate leaves one row per (user,
    # session), however many events a hot session has, and the session sum is joined to that.
    per_user = train_v.groupBy("user_id", "user_session").agg(
        F.min("row_no").alias("row_no"), F.sum(F.col("value").cast("decimal(18,2)")).alias("_part"))
    sums = (per_user.groupBy("user_session")
            .agg(F.sum("_part").cast("double").alias("session_value")))
    first_rows = (per_user.drop("_part").join(sums, "user_session", "left")
                  .select("row_no", "user_id", "user_session", "session_value"))

    def labeled():
        # The sums are written first: a shuffle then sits directly under each side of the
        # join, which is what lets adaptive execution split a hot session's events.
        return (train_v.drop("value").join(materialize(sums), "user_session", "left")
                .select(*CONTRACT_COLUMNS, "session_value"))
    return EventSource(events=events, train=train_v.drop("value"), test=test, make_labeled=labeled,
                       template=test_template(test), name="clickstream", first_rows=first_rows)


def lineitem_source(spark: SparkSession, sf_dir: str) -> EventSource:
    """Adapter B over ``lineitem`` joined with ``orders`` and ``part``: a session is an order.

    Lines of one order share ship dates and even line numbers, so the input position
    is the whole line as an ordering struct (lines are unique as whole rows).
    """
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
           .join(part, li.l_partkey == part.p_partkey, "inner"))
    row_no = F.struct(*[F.col(c) for c in (
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")])
    cut = F.lit(LINEITEM_TEST_FROM).cast("timestamp_ntz")

    def contract(rows):
        return rows.select(
            row_no.alias("row_no"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_orderkey").cast("string").alias("user_session"),
            _map_names(F.col("l_returnflag"), LINEITEM_TYPE_NAMES).alias("event_type"),
            F.col("l_partkey").alias("product_id"),
            F.col("p_brand").alias("category_id"),
            F.col("l_shipdate").alias("event_time"),
            F.when(F.col("o_orderdate") < cut, F.lit("train")).otherwise(F.lit("test")).alias("split"),
            F.col("o_totalprice").alias("session_value"),
        )
    events = contract(j).drop("session_value")
    # session-constant attributes come from ``orders`` alone, so session features can
    # aggregate line items joined with ``part`` only and attach orders per session
    lines = li.join(part, li.l_partkey == part.p_partkey, "inner")
    line_events = lines.select(
        row_no.alias("row_no"),
        F.col("l_orderkey").cast("string").alias("user_session"),
        _map_names(F.col("l_returnflag"), LINEITEM_TYPE_NAMES).alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_brand").alias("category_id"),
        F.col("l_shipdate").alias("event_time"))
    order_attrs = orders.select(
        F.col("o_orderkey").cast("string").alias("user_session"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderdate") < cut, F.lit("train")).otherwise(F.lit("test")).alias("split"))
    labeled = contract(j.where(F.col("o_orderdate") < cut))
    test = contract(j.where((F.col("o_orderdate") >= cut) | F.col("o_orderdate").isNull())).drop("session_value")
    return EventSource(events=events, train=labeled.drop("session_value"), test=test, make_labeled=lambda: labeled,
                       template=test_template(test), name="lineitem",
                       extras={"line_events": line_events, "session_attrs": order_attrs})


# Columns of the reference's raw files.
RAW_ID_COLUMNS = ("user_id", "product_id", "category_id")
RAW_REQUIRED = ("event_type", "product_id", "category_id", "user_id", "user_session")


def csv_source(spark: SparkSession, train_path: str, test_path: str, template_path: str,
               time_candidates=None, id_type: str | None = None) -> EventSource:
    """[S1 S2 S3 P2 P6 P7 U1] Headered CSV files in the reference's layout: train events
    (with ``session_value``), test events, and the submission template.

    Ids take the type that the cells of both files have (``id_type``: "long" or "string" for
    all of them): integers stay 64-bit integers where cells are missing, anything else is
    text. The target is a double, the first matching time column is parsed (bad values ->
    NULL), and each file's dense input position is ``row_no``. ``row_time`` keeps the unparsed
    text of the first time column on the trainers' shorter list: their last rows follow
    its text order. Files without a time column give sources without ``time_col``.
    """
    from clickroll.functions.schema import TIME_CANDIDATES, TIME_CANDIDATES_SHORT, detect_time_column
    from clickroll.sources.files import INTEGER, column_looks, least_type, typed
    from clickroll.sources.quoted_csv import read_csv_text

    raw = {path: read_csv_text(spark, path) for path in (train_path, test_path, template_path)}
    for path in (train_path, test_path):
        missing = [c for c in (*RAW_REQUIRED, *(["session_value"] if path == train_path else [])) if c not in raw[path][0]]
        if missing:
            raise ValueError(f"missing columns in {path}: {missing}")
    if id_type is None:
        looks = [column_looks(raw[path][1], RAW_ID_COLUMNS) for path in (train_path, test_path)]
        kinds = {c: [least_type(x[c], keep_integers=True) for x in looks if x[c]["filled"]] for c in RAW_ID_COLUMNS}
        id_types = {c: "bigint" if set(k) == {INTEGER} else "string" for c, k in kinds.items()}
    else:
        id_types = {c: "bigint" if id_type == "long" else "string" for c in RAW_ID_COLUMNS}

    def load(path, split):
        cols, rows = raw[path]
        df = typed(rows, {c: "double" if c == "session_value" else id_types.get(c, "string") for c in cols})
        tcol = detect_time_column(cols, time_candidates or TIME_CANDIDATES)
        short = detect_time_column(cols, TIME_CANDIDATES_SHORT)
        times.append((tcol is not None, short is not None))
        text = F.col(short) if short else F.lit(None).cast("string")
        t = F.try_to_timestamp(F.col(tcol)).cast("timestamp_ntz") if tcol else F.lit(None).cast("timestamp_ntz")
        return df.select("row_no", "user_id", "user_session", "event_type",
                         "product_id", "category_id", t.alias("event_time"), text.alias("row_time"),
                         F.lit(split).alias("split"),
                         *(["session_value"] if "session_value" in cols else []))

    times: list[tuple[bool, bool]] = []
    train = load(train_path, "train")
    test = load(test_path, "test")
    template = typed(raw[template_path][1], {"user_session": "string"}).withColumn("session_value", F.lit(0.0))
    events = train.drop("session_value").unionByName(test.drop(*[c for c in test.columns
                                                                 if c == "session_value"]))
    return EventSource(events=events, train=train.drop("session_value"), test=test, make_labeled=lambda: train,
                       template=template, name="csv", time_col="event_time" if any(t for t, _ in times) else None,
                       row_time_col="row_time" if any(s for _, s in times) else None)
