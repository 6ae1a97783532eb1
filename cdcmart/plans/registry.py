"""Every operator as a named query over the given tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions import codec, envelope
from cdcmart.operators import audit, backfill, contracts, deltas, history, reports, upsert
from cdcmart.operators.replay import replay_from
from cdcmart.plans import bindings as b
from cdcmart.plans import repair
from cdcmart.plans.incremental import MaintainedReports
from cdcmart.plans.reporting import all_violations, report_set
from cdcmart.session import log_tasks, prepare, scratch_dir
from cdcmart.sinks import bucketed
from cdcmart.sinks.mart import Mart, version_of
from cdcmart.sources.changes import change_stream
from cdcmart.specs import CUSTOMERS, EXTRAS, OFFSET, ORDER_ITEMS, ORDERS, PARTITION, PRODUCTS, TOPIC
from cdcmart.streaming.runner import start_mart_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Days that split the data where a query needs an earlier and a later part.
_BATCH_DAY = "2024-01-30"
_ORDERS_KNOWN_UNTIL = "2000-12-31"
_GAP = ("1996-03-01", "1996-08-31")
_BACKFILL = ("1996-01-01", "1996-12-31")
_SALT = 16


def _query(run: Query) -> Query:
    @functools.wraps(run)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = prepared
    return run


def _plain_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables hold them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# -- reports ------------------------------------------------------------------------------------


@_query
def report_delivery_status(spark, sf_dir):
    return reports.delivery_status_summary(b.fact_orders(spark, sf_dir))


@_query
def report_open_order_total(spark, sf_dir):
    return reports.open_order_total(b.fact_orders(spark, sf_dir))


@_query
def report_top_delivery_dates(spark, sf_dir):
    top = reports.top_delivery_dates(b.fact_orders(spark, sf_dir))
    return reports.with_rank(top, "open_order_count", "delivery_date")


def _pending(spark, sf_dir, **options):
    return reports.pending_items_by_product(
        b.fact_order_items(spark, sf_dir),
        b.fact_orders(spark, sf_dir),
        b.dim_product(spark, sf_dir),
        **options,
    )


@_query
def report_pending_items_by_product(spark, sf_dir):
    return _pending(spark, sf_dir)


@_query
def report_pending_items_salted(spark, sf_dir):
    return _pending(spark, sf_dir, salt=_SALT)


@_query
def report_pending_items_item_status(spark, sf_dir):
    """The items store their status; the report reads no order."""
    path = f"{scratch_dir(spark, 'items')}/stored"
    upsert.denormalize(b.fact_order_items(spark, sf_dir), b.fact_orders(spark, sf_dir)).write.parquet(path)
    items = spark.read.parquet(path)
    return reports.pending_items_by_product(items, None, b.dim_product(spark, sf_dir), status_from="item")


@_query
def report_pending_items_fallback(spark, sf_dir):
    """A third of the items have their quantity in the column only, a third nowhere; some products have no name."""
    third = F.pmod(F.col("order_id"), F.lit(3))
    own = F.get_json_object(EXTRAS, f"$.{reports.SOURCE_QUANTITY}").try_cast("int")
    items = b.fact_order_items(spark, sf_dir).withColumns(
        {
            "quantity": F.when(third == 1, own),
            EXTRAS: F.when(third == 0, F.col(EXTRAS)).when(third == 1, F.lit('{"other":1}')),
        }
    )
    named = F.when(F.col("product_id") % 7 != 0, F.col("product_name"))
    products = b.dim_product(spark, sf_dir).withColumn("product_name", named)
    return reports.pending_items_by_product(items, b.fact_orders(spark, sf_dir), products)


@_query
def report_contract_violations(spark, sf_dir):
    """Every rule of the four reports, over their whole rows."""
    orders, items = b.fact_orders(spark, sf_dir), b.fact_order_items(spark, sf_dir)
    made = {
        "delivery_status_summary": reports.delivery_status_summary(orders),
        "top_delivery_dates": reports.top_delivery_dates(orders),
        "pending_items_by_product": reports.pending_items_by_product(items, orders, b.dim_product(spark, sf_dir)),
        "top_customers": reports.top_customers(orders, b.dim_customer(spark, sf_dir)),
    }
    return all_violations(made)


@_query
def report_top_customers(spark, sf_dir):
    top = reports.top_customers(b.fact_orders(spark, sf_dir), b.dim_customer(spark, sf_dir))
    return reports.with_rank(top, "pending_order_count", "customer_id")


@_query
def report_stamped(spark, sf_dir):
    report = reports.delivery_status_summary(b.fact_orders(spark, sf_dir))
    return contracts.stamp(report).drop("generated_at")


# -- change feed --------------------------------------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    return b.event_records(b.table(spark, sf_dir, "events"))


def _changes(spark, sf_dir) -> DataFrame:
    return envelope.parse_changes(_events(spark, sf_dir), b.USER_STATE)


def _change_view(changes: DataFrame, *columns: str) -> DataFrame:
    return _plain_time(changes.withColumnRenamed(OFFSET, "kafka_offset").select(*columns))


_VERSIONED = ("user_id", "updated_at", "value", "kafka_offset")


@_query
def cdc_parse_changes(spark, sf_dir):
    return _change_view(_changes(spark, sf_dir), *_VERSIONED, "op")


@_query
def cdc_parse_deletes(spark, sf_dir):
    deletes = envelope.parse_deletes(_events(spark, sf_dir), b.USER_STATE)
    return _change_view(deletes, "user_id", "updated_at", "value", "op")


@_query
def cdc_parse_events(spark, sf_dir):
    events = envelope.parse_events(_events(spark, sf_dir), b.USER_STATE)
    return _change_view(events, *_VERSIONED, "op")


@_query
def cdc_extra_columns(spark, sf_dir):
    extra = F.get_json_object(EXTRAS, "$.k").try_cast("int")
    return _changes(spark, sf_dir).select(F.col(OFFSET).alias("kafka_offset"), extra.alias("extra_k"))


@_query
def extra_columns_from_row(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part")
    extras = envelope.extra_columns_from_row(parts, ["p_partkey", "p_name"])
    kept = parts.select(F.col("p_partkey").alias("product_id"), extras.alias(EXTRAS))
    return kept.select(
        "product_id",
        F.get_json_object(EXTRAS, "$.p_brand").alias("brand"),
        F.get_json_object(EXTRAS, "$.p_type").alias("kind"),
        F.get_json_object(EXTRAS, "$.p_size").try_cast("int").alias("size"),
    )


@_query
def codec_roundtrip(spark, sf_dir):
    kinds = {"order_date": T.DateType(), "updated_at": T.TimestampType(), "price": T.DecimalType(12, 2)}
    orders = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
    )
    wire = orders.select("order_id", *[codec.encode(F.col(c), t).alias(c) for c, t in kinds.items()])
    back = wire.select("order_id", *[codec.decode(F.col(c), t).alias(c) for c, t in kinds.items()])
    return _plain_time(back.withColumn("price", F.col("price").cast("double")))


# Wire values as a connector writes them, extremes included: milliseconds, days, unscaled digits and scale.
_WIRE_CASES = (
    '{"t":0,"d":0,"p":{"scale":0,"value":"AA=="}}',
    '{"t":-1,"d":-1,"p":{"scale":2,"value":"/w=="}}',
    '{"t":1700000000123,"d":19782,"p":{"scale":2,"value":"B88="}}',
    '{"t":9223372036854775807,"d":2932896,"p":{"scale":-2147483648,"value":"AQ=="}}',
    '{"t":-9223372036854775808,"d":-719162,"p":{"scale":2147483647,"value":"AQ=="}}',
    '{"t":null,"d":null,"p":{"scale":2,"value":""}}',
    '{"t":"soon","d":"soon","p":{"scale":2,"value":"?"}}',
)


@_query
def cdc_decode_literals(spark, sf_dir):
    """Hand-written wire values, one for each order in turn, so that an error in the encoder cannot hide one here."""
    cases = F.array(*[F.lit(c) for c in _WIRE_CASES])
    kinds = {"t": T.TimestampType(), "d": T.DateType(), "p": T.DecimalType(12, 2)}
    schema = codec.wire_schema(T.StructType([T.StructField(n, k) for n, k in kinds.items()]))
    orders = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.get(cases, F.pmod("o_orderkey", F.lit(len(_WIRE_CASES))).cast("int")).alias("wire"),
    )
    read = orders.select("order_id", F.from_json("wire", schema).alias("row"))
    decoded = read.select("order_id", *[codec.decode(F.col(f"row.{n}"), k).alias(n) for n, k in kinds.items()])
    return _plain_time(decoded.withColumn("p", F.col("p").cast("double")))


# -- audit of the log ---------------------------------------------------------------------------


def _lossy(spark, sf_dir) -> DataFrame:
    """Positions of the feed over four partitions, some stretches of each lost and some offsets read twice."""
    offset = F.floor(F.col("event_id") / 4)
    read = b.table(spark, sf_dir, "events").select(
        F.lit("users").alias(TOPIC), (F.col("event_id") % 4).cast("int").alias(PARTITION), offset.alias(OFFSET)
    )
    kept = read.where((F.col(OFFSET) % 97 >= 5) & (F.col(OFFSET) % 50 != F.col(PARTITION)))
    return kept.unionByName(kept.where(F.col(OFFSET) % 31 == 0))


def _position_view(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({TOPIC: "topic", PARTITION: "partition"})


@_query
def offset_gaps(spark, sf_dir):
    """In ranges of 1000 offsets, so that gaps within and between ranges occur."""
    return _position_view(audit.offset_gaps(_lossy(spark, sf_dir), 1000))


@_query
def offset_summary(spark, sf_dir):
    return _position_view(audit.offset_summary(_lossy(spark, sf_dir), 1000))


def _damaged(spark, sf_dir) -> DataFrame:
    """The event feed with seven of thirteen records damaged, each in another way."""
    text, kind = F.col("value").cast("string"), F.col("offset") % 13
    damaged = (
        F.when(kind == 0, F.substring(text, 1, 20))
        .when(kind == 1, F.regexp_replace(text, '"op":"."', '"op":"x"'))
        .when(kind == 2, F.regexp_replace(text, '"op":"."', '"other":"x"'))
        .when(kind == 3, F.regexp_replace(text, '"(before|after)":', '"was_$1":'))
        .when(kind == 4, F.regexp_replace(text, '"user_id":[0-9]+', '"user_id":"some"'))
        .when(kind == 5, F.lit("[1]"))
        .when(kind != 6, text)
    )
    return _events(spark, sf_dir).withColumn("value", damaged.cast("binary"))


@_query
def cdc_quarantine(spark, sf_dir):
    """Reason and position of every record that cannot be read as it should."""
    found = audit.quarantine(_damaged(spark, sf_dir), b.USER_STATE)
    return found.select(F.col(OFFSET).alias("kafka_offset"), "reason", "fields")


@_query
def cdc_outcomes(spark, sf_dir):
    """Every record counts once, under one outcome."""
    found = audit.outcomes(_damaged(spark, sf_dir), b.USER_STATE)
    return found.groupBy("outcome").agg(F.count("*").alias("n"))


@_query
def drift_report(spark, sf_dir):
    """Unknown fields of a feed in which one changes its type and one is null or missing."""
    events = b.table(spark, sf_dir, "events")
    third = F.col("event_id") % 3
    rows = events.select(
        "user_id", "value", F.lit(None).cast("boolean").alias("is_active"),
        F.col("ts").cast("timestamp").alias("updated_at"), F.col("ts").cast("timestamp").alias("created_at"),
        "event_id", third.alias("third"),
    )
    parts = []
    for k, note in enumerate((F.col("event_id"), F.concat(F.lit("n"), "event_id"), F.lit(None).cast("string"))):
        extras = {"note": note} if k else {"note": note, "flag": F.col("event_id") % 2 == 0}
        part = rows.where(F.col("third") == k)
        parts.append(b.build_records(part, b.USER_STATE, "users", F.col("event_id"), F.lit("u"), extras))
    return audit.drift_report(envelope.parse_changes(deltas.union(parts), b.USER_STATE))


# -- upsert -------------------------------------------------------------------------------------


@_query
def latest_by_key(spark, sf_dir):
    changes = _changes(spark, sf_dir)
    latest = upsert.latest_by_key(changes, b.USER_STATE.key, b.USER_STATE.order_by)
    return _change_view(latest, *_VERSIONED)


@_query
def latest_by_key_late(spark, sf_dir):
    """The newest rows picked by key and position first, then fetched."""
    return _change_view(upsert.latest_by_key_late(_changes(spark, sf_dir), b.USER_STATE.key, *b.USER_STATE.order_by), *_VERSIONED)


@_query
def latest_by_key_window(spark, sf_dir):
    changes = _changes(spark, sf_dir)
    latest = upsert.latest_by_key_window(changes, b.USER_STATE.key, b.USER_STATE.order_by)
    return _change_view(latest, *_VERSIONED)


_LINE = ("order_id", "line_no", "product_id", "quantity")


@_query
def drop_duplicate_keys(spark, sf_dir):
    lines = b.source_line_items(spark, sf_dir).withColumnRenamed("position", OFFSET)
    kept = upsert.drop_duplicate_keys(lines, b.LINE_ITEMS)
    return kept.withColumn("quantity", F.col(reports.SOURCE_QUANTITY)).select(*_LINE)


@_query
def apply_defaults_dates(spark, sf_dir):
    """Missing dates take the day of the batch."""
    orders = b.fact_orders(spark, sf_dir).withColumn(
        "order_date", F.when(F.col("order_id") % 3 != 0, F.col("order_date"))
    )
    return upsert.apply_defaults(orders, ORDERS, dt.date(2020, 2, 3)).select("order_id", "order_date", "delivery_date")


@_query
def null_keys_set_aside(spark, sf_dir):
    """Changes with and without a key, counted by day; only the former are merged."""
    changes = _changes(spark, sf_dir).withColumn(
        "user_id", F.when(F.col(OFFSET) % 10 != 0, F.col("user_id"))
    )
    keyed = F.coalesce(upsert.has_key(b.USER_STATE), F.lit(False))
    return changes.groupBy(F.to_date("updated_at").alias("day")).agg(
        F.count_if(keyed).alias("kept"), F.count_if(~keyed).alias("set_aside")
    )


@_query
def apply_defaults(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("customer_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") >= 5000).alias("is_active"),
    )
    return upsert.apply_defaults(customers, CUSTOMERS)


def _split(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    day = F.lit(_BATCH_DAY).cast("timestamp")
    return changes.where(F.col("updated_at") < day), changes.where(F.col("updated_at") >= day)


def _empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], b.USER_STATE.mart_schema)


def _state_view(state: DataFrame) -> DataFrame:
    return _plain_time(state.select("user_id", "updated_at", "created_at", "value"))


def _merged(spark, batches, **options) -> DataFrame:
    state = _empty_state(spark)
    for batch in batches:
        state = upsert.merge_upsert(state, batch, b.USER_STATE, **options)
    return _state_view(state)


@_query
def merge_upsert(spark, sf_dir):
    early, late = _split(_changes(spark, sf_dir))
    return _merged(spark, [early, late])


@_query
def merge_upsert_small_changes(spark, sf_dir):
    spec = b.USER_STATE
    early, late = _split(_changes(spark, sf_dir))
    state = upsert.merge_upsert(_empty_state(spark), early, spec)
    latest = upsert.apply_defaults(upsert.drop_duplicate_keys(late, spec), spec)
    return _state_view(upsert.merge_latest(state, latest, spec))


@_query
def merge_upsert_late_batch(spark, sf_dir):
    """The earlier events arrive last and win, as the last batch does."""
    early, late = _split(_changes(spark, sf_dir))
    return _merged(spark, [late, early])


@_query
def merge_upsert_newest(spark, sf_dir):
    """The earlier events arrive last and lose."""
    early, late = _split(_changes(spark, sf_dir))
    return _merged(spark, [late, early], on_conflict=upsert.NEWEST)


@_query
def fold_batches(spark, sf_dir):
    """One batch per day, folded at once."""
    spec = b.USER_STATE
    daily = dataclasses.replace(spec, key=("user_id", "day"))
    changes = _changes(spark, sf_dir).withColumn("day", F.unix_date(F.to_date("updated_at")))
    per_day = upsert.drop_duplicate_keys(changes, daily)
    return _state_view(upsert.fold_batches(per_day.select(*spec.columns, "day"), spec, "day"))


@_query
def history_append(spark, sf_dir):
    """The feed is read twice; each event counts once."""
    changes = _changes(spark, sf_dir)
    once = history.entries(changes, b.USER_STATE)
    twice = once.unionByName(history.entries(changes, b.USER_STATE))
    return _history_view(history.distinct_events(twice))


def _history_view(stored: DataFrame) -> DataFrame:
    """With the number of rows that share an id: one, if the id tells events apart and repeats for none."""
    counted = stored.groupBy("history_id").agg(F.count("*").alias("same_id"))
    return _change_view(stored.join(counted, "history_id"), *_VERSIONED, "same_id")


@_query
def soft_delete(spark, sf_dir):
    events = envelope.parse_events(_events(spark, sf_dir), b.USER_STATE)
    marked = upsert.soft_delete(events, b.USER_STATE)
    merged = upsert.merge_upsert(_empty_state(spark), marked, b.USER_STATE)
    return merged.select("user_id", "is_active", _extra_k())


def _extra_k():
    return F.get_json_object(EXTRAS, "$.k").try_cast("int").alias("extra_k")


# -- order status on items ----------------------------------------------------------------------


def _arrivals(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders that arrived before the items did, and those that came after."""
    orders, known = b.fact_orders(spark, sf_dir), F.col("order_date") <= F.lit(_ORDERS_KNOWN_UNTIL).cast("date")
    return orders.where(known), orders.where(~known)


def _denormalized(spark, sf_dir, salt=None) -> DataFrame:
    """The status at arrival, and after the other orders have come."""
    before, after = _arrivals(spark, sf_dir)
    first = upsert.denormalize(b.item_lines(spark, sf_dir), before, salt=salt)
    return upsert.sync_from(first.withColumn("first_status", F.col("order_status")), after, salt=salt)


@_query
def denormalize_status(spark, sf_dir):
    return _denormalized(spark, sf_dir)


@_query
def denormalize_status_salted(spark, sf_dir):
    return _denormalized(spark, sf_dir, _SALT)


@_query
def status_sync(spark, sf_dir):
    state = b.item_lines(spark, sf_dir).withColumn("order_status", F.lit("PENDING"))
    for orders in _arrivals(spark, sf_dir):
        state = upsert.sync_from(state, orders)
    return state


# -- items and orders in buckets ----------------------------------------------------------------


def _bucketed(spark, sf_dir) -> tuple[bucketed.BucketedTable, bucketed.BucketedTable]:
    """Items and orders in buckets of the order; the last lines of orders have lost theirs and hold its default."""
    folder = scratch_dir(spark, "buckets")
    mark = folder.rsplit("-", 1)[1]
    items = bucketed.BucketedTable(spark, f"items_{mark}", "order_id")
    orders = bucketed.BucketedTable(spark, f"orders_{mark}", "order_id")
    lost = F.col("line_no") >= 6
    rows = b.fact_order_items(spark, sf_dir).withColumn("order_id", F.when(~lost, F.col("order_id")).otherwise(0))
    buckets = bucketed.width_for(rows)
    items.write(rows, buckets, folder, default=ORDER_ITEMS.defaults["order_id"])
    orders.write(b.fact_orders(spark, sf_dir), buckets, folder, unique=True)
    return items, orders


@_query
def bucketed_denormalize_status(spark, sf_dir):
    items = bucketed.by_parts(*_bucketed(spark, sf_dir), upsert.denormalize)
    quantity = reports.pending_quantity().alias("quantity")
    return items.select("order_id", "line_no", "product_id", quantity, "order_status")


@_query
def bucketed_status_sync(spark, sf_dir):
    """The stored status of every item, wrong for two in three, brought to that of its order."""
    items, orders = _bucketed(spark, sf_dir)
    stored = F.when(F.pmod("order_id", F.lit(3)) == 0, F.lit("PENDING")).otherwise(F.lit("unknown"))
    sync = lambda rows, other: upsert.sync_from(rows.withColumn("order_status", stored), other)
    synced = bucketed.by_parts(items, orders, sync)
    return synced.select("order_id", "line_no", "product_id", "order_status")


@_query
def bucketed_pending_items(spark, sf_dir):
    """Totals of both parts added up, then named."""
    found = [deltas.pending_items(deltas.appeared(i), o) for i, o in bucketed.parts(*_bucketed(spark, sf_dir))]
    totals = deltas.added_up(deltas.union(found), "pending_items")
    return deltas.pending_items_by_product(totals, b.dim_product(spark, sf_dir))


# -- repair -------------------------------------------------------------------------------------


def _backfilled(spark, sf_dir) -> DataFrame:
    return backfill.extract(b.source_orders(spark, sf_dir), ORDERS, *_BACKFILL)


def _loaded(spark, sf_dir) -> DataFrame:
    """All orders but those of a gap inside the range that is filled again."""
    rows = b.source_orders(spark, sf_dir).where(
        ~F.col("order_date").between(*[F.lit(d).cast("date") for d in _GAP])
    )
    lineage = {EXTRAS: F.lit(None).cast("string"), OFFSET: F.col("order_id")}
    return rows.withColumns(lineage).select(*ORDERS.columns)


def _created_by():
    """A backfill leaves it unset on rows it inserts."""
    return F.coalesce("created_by", F.lit(-1)).alias("created_by")


@_query
def backfill_extract(spark, sf_dir):
    return _backfilled(spark, sf_dir).select(
        "order_id", "customer_id", "order_date", "delivery_date", "status",
        F.col(OFFSET).alias("kafka_offset"),
    )


@_query
def backfill_merge(spark, sf_dir):
    target = _loaded(spark, sf_dir).withColumn("status", F.lit("unknown"))
    extracted = _backfilled(spark, sf_dir)
    merged = upsert.merge_upsert(target, extracted, ORDERS, columns=extracted.columns)
    return merged.select("order_id", "status", _created_by())


@_query
def backfill_run_summary(spark, sf_dir):
    return backfill.run_summary(_loaded(spark, sf_dir), _backfilled(spark, sf_dir), ORDERS)


@_query
def replay_from_offset(spark, sf_dir):
    return _change_view(replay_from(_changes(spark, sf_dir), 50), *_VERSIONED, "op")


@_query
def contract_violations(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("customer_name"),
        F.when(F.col("c_acctbal") >= 0, F.lit(True)).alias("is_active"),
    )
    return contracts.violations(customers, contracts.table_contract(CUSTOMERS), {"customer_name": 8})


@_query
def row_counts(spark, sf_dir):
    return repair.row_counts(
        {
            "fact_orders": b.fact_orders(spark, sf_dir),
            "fact_order_items": b.item_lines(spark, sf_dir),
            "dim_customer": b.dim_customer(spark, sf_dir),
            "dim_product": b.dim_product(spark, sf_dir),
        }
    )


# -- a first snapshot of each table, through envelope, parser and upsert ------------------------


def _mart_table(spark, sf_dir, name) -> DataFrame:
    """The newest rows are written before they are merged, as a batch is persisted: the status copy and the merge read
    them several times, and each time would build and parse all records again."""
    spec, records = b.records_of(spark, sf_dir, name)
    path = f"{scratch_dir(spark, 'latest')}/{spec.name}"
    parsed = upsert.drop_duplicate_keys(envelope.parse_changes(records, spec), spec)
    parsed.write.parquet(path)
    latest = spark.read.schema(parsed.schema).parquet(path)
    if spec.derived:
        latest = upsert.denormalize(latest, b.fact_orders(spark, sf_dir))
    state = spark.createDataFrame([], spec.mart_schema)
    return upsert.merge_latest(state, upsert.apply_defaults(latest, spec), spec)


@_query
def mart_dim_customer(spark, sf_dir):
    return _mart_table(spark, sf_dir, CUSTOMERS.name).select(
        "customer_id", "customer_name", "is_active", "created_by",
        F.get_json_object(EXTRAS, "$.segment").alias("segment"),
    )


@_query
def mart_dim_product(spark, sf_dir):
    return _mart_table(spark, sf_dir, PRODUCTS.name).select(
        "product_id", "product_name", "barcode", "is_active",
        F.col("unity_price").cast("double").alias("unity_price"),
        F.get_json_object(EXTRAS, "$.kind").alias("kind"),
    )


@_query
def mart_fact_orders(spark, sf_dir):
    return _mart_table(spark, sf_dir, ORDERS.name).select(
        "order_id", "order_date", "delivery_date", "customer_id", "status"
    )


def _item_view(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id", "line_no", "product_id", reports.pending_quantity().alias("quantity"), "order_status"
    )


@_query
def mart_fact_order_items(spark, sf_dir):
    return _item_view(_mart_table(spark, sf_dir, b.LINE_ITEMS.name))


# -- streams ------------------------------------------------------------------------------------


def _append(records: DataFrame, path: str) -> None:
    """Add records to a feed folder, in files small enough to be read in parallel."""
    records.write.mode("append").option("maxRecordsPerFile", 50_000).parquet(path)


def _stream_in(mart: Mart, name: str, feed: str, **options) -> None:
    """Run the table's stream over the feed folder until it has read what is there."""
    records = change_stream(mart.spark, "parquet", {"path": feed})
    with log_tasks(mart.spark):
        start_mart_stream(mart, name, records, trigger=None, **options).awaitTermination()


def _streamed_users(spark, sf_dir, later_first=False, on_conflict=None, **options) -> Mart:
    """Two arrivals of the event feed, a stream run after each."""
    folder = scratch_dir(spark, "users")
    mart = Mart(spark, f"{folder}/mart", {b.USER_STATE.name: b.USER_STATE}, on_conflict)
    day = F.lit(_BATCH_DAY).cast("timestamp_ntz")
    # The wire holds milliseconds, so the arrivals are cut on those.
    events = b.table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("millisecond", "ts"))
    arrivals = [events.where(F.col("ts") < day), events.where(F.col("ts") >= day)]
    for arrived in reversed(arrivals) if later_first else arrivals:
        _append(b.event_records(arrived), f"{folder}/feed")
        _stream_in(mart, b.USER_STATE.name, f"{folder}/feed", **options)
    return mart


@_query
def stream_scd4_current(spark, sf_dir):
    return _state_view(_streamed_users(spark, sf_dir).read(b.USER_STATE.name))


@_query
def stream_scd4_history(spark, sf_dir):
    """Read after the day's batches were put into one folder and their own folders removed."""
    table = _streamed_users(spark, sf_dir).table(b.USER_STATE.name)
    table.merge_history(before=dt.date(9999, 1, 1))
    table.vacuum(dt.timedelta(0))
    stored = table.read_history()
    return _history_view(stored)


@_query
def stream_history_once(spark, sf_dir):
    """Half of the feed is read again after a replay was asked for: the history, as it is stored, holds each event once."""
    mart = _streamed_users(spark, sf_dir)
    repair.request_replay(mart, b.USER_STATE.name)
    folder = f"{scratch_dir(spark, 'again')}/feed"
    _append(_events(spark, sf_dir).where(F.col("offset") % 2 == 0), folder)
    _stream_in(mart, b.USER_STATE.name, folder)
    return _history_view(mart.table(b.USER_STATE.name).read_history())


@_query
def stream_soft_delete(spark, sf_dir):
    mart = _streamed_users(spark, sf_dir, deletes="soft")
    return mart.read(b.USER_STATE.name).select("user_id", "is_active", _extra_k())


@_query
def stream_newest_compacted(spark, sf_dir):
    """The later events arrive first; a state is written, and read by a mart that was told no rule."""
    mart = _streamed_users(spark, sf_dir, later_first=True, on_conflict=upsert.NEWEST)
    mart.table(b.USER_STATE.name).rewrite()
    return _state_view(Mart(spark, mart.root, mart.specs).read(b.USER_STATE.name))


@_query
def stream_replay_from_offset(spark, sf_dir):
    """A stored log, streamed into a new mart from a position on."""
    folder = scratch_dir(spark, "replay")
    mart = Mart(spark, f"{folder}/mart", {b.USER_STATE.name: b.USER_STATE})
    _append(_events(spark, sf_dir), f"{folder}/feed")
    records = replay_from(change_stream(spark, "parquet", {"path": f"{folder}/feed"}), 50, "offset")
    start_mart_stream(mart, b.USER_STATE.name, records, trigger=None).awaitTermination()
    return _history_view(mart.table(b.USER_STATE.name).read_history())


@_query
def stream_order_items(spark, sf_dir):
    """Some orders arrive before the items, the others after; the copied status follows."""
    folder = scratch_dir(spark, "items")
    mart = Mart(spark, f"{folder}/mart", {s.name: s for s in (ORDERS, b.LINE_ITEMS)})
    orders = b.source_orders(spark, sf_dir)
    # Orders without a date come first, so that every order comes and a dated row of the same key still replaces them.
    known = F.col("order_date").isNull() | (F.col("order_date") <= F.lit(_ORDERS_KNOWN_UNTIL).cast("date"))

    def arrive(name, rows, offset):
        spec = mart.specs[name]
        _append(b.snapshot_records(rows, spec, F.col(offset)), f"{folder}/{spec.source}")
        _stream_in(mart, name, f"{folder}/{spec.source}")

    arrive(ORDERS.name, orders.where(known), "order_id")
    arrive(b.LINE_ITEMS.name, b.source_line_items(spark, sf_dir), "position")
    arrive(ORDERS.name, orders.where(~known), "order_id")
    # What the items store themselves, by the orders that changed.
    repair.sync_status(mart, b.LINE_ITEMS.name)
    return _item_view(mart.read(b.LINE_ITEMS.name, stored_status=True))


def _streamed_shop(spark, sf_dir) -> Mart:
    """All four tables, each kept by its own stream from its own feed."""
    folder = scratch_dir(spark, "shop")
    mart = Mart(spark, f"{folder}/mart", {n: spec for n, (spec, _, _) in b.SOURCES.items()})
    for name in b.SOURCES:
        spec, records = b.records_of(spark, sf_dir, name)
        _append(records, f"{folder}/{spec.source}")
    # Side by side, so that one stream's last tasks leave no core idle; the items copy the status of orders there are.
    feeds = {name: change_stream(spark, "parquet", {"path": f"{folder}/{spec.source}"}) for name, spec in mart.specs.items()}
    items = feeds.pop(b.LINE_ITEMS.name)
    with log_tasks(spark):
        for query in [start_mart_stream(mart, name, feed, trigger=None) for name, feed in feeds.items()]:
            query.awaitTermination()
        start_mart_stream(mart, b.LINE_ITEMS.name, items, trigger=None).awaitTermination()
    return mart


@_query
def stream_report_pending_items(spark, sf_dir):
    return report_set(_streamed_shop(spark, sf_dir))["pending_items_by_product"]


@_query
def stream_report_top_customers(spark, sf_dir):
    top = report_set(_streamed_shop(spark, sf_dir))["top_customers"]
    return reports.with_rank(top, "pending_order_count", "customer_id")


# -- reports kept up to date by changes ---------------------------------------------------------


def _maintained(spark, sf_dir) -> MaintainedReports:
    """Totals of a mart whose orders were known in part and by another status, and whose items came in part.

    A first refresh reads the tables, two more the changes: later orders, other statuses and delivery dates, items
    that move to other products, and the rest of the items.
    """
    specs = (ORDERS, b.LINE_ITEMS, CUSTOMERS, PRODUCTS)
    mart = Mart(spark, f"{scratch_dir(spark, 'maintained')}/mart", {s.name: s for s in specs})
    lineage = {EXTRAS: F.lit(None).cast("string"), OFFSET: F.lit(0).cast("long")}
    mart.table(CUSTOMERS.name).commit_state(b.source_customers(spark, sf_dir).withColumns(lineage), 0)
    mart.table(PRODUCTS.name).commit_state(b.source_products(spark, sf_dir).withColumns(lineage), 0)
    maintained = MaintainedReports(mart)

    orders = b.source_orders(spark, sf_dir).withColumns(lineage)
    third = F.pmod("order_id", F.lit(3))
    known = F.col("order_date") <= F.lit(_GAP[0]).cast("date")
    wrong = {
        "status": F.when(third == 0, F.lit("PENDING")).when(third == 1, F.lit("COMPLETED")).otherwise(F.col("status")),
        "delivery_date": F.when(third == 2, F.date_add("delivery_date", 1)).otherwise(F.col("delivery_date")),
    }
    items = upsert.drop_duplicate_keys(
        b.source_line_items(spark, sf_dir)
        .withColumns({EXTRAS: F.to_json(F.struct(reports.SOURCE_QUANTITY)), OFFSET: F.col("position")})
        .withColumn("order_status", F.lit("unknown"))
        .select(*b.LINE_ITEMS.columns),
        b.LINE_ITEMS,
    )
    first = F.col("line_no") <= 3
    moved = items.withColumn("product_id", F.when(F.col("line_no") == 2, F.col("product_id") + 1).otherwise(F.col("product_id")))

    mart.table(ORDERS.name).commit_state(orders.where(known).withColumns(wrong), 0)
    mart.table(b.LINE_ITEMS.name).commit_state(moved.where(first), 0)
    maintained.refresh()
    mart.table(ORDERS.name).commit_changes(orders.where(known & (third != 2)), version_of(0, 0))
    mart.table(b.LINE_ITEMS.name).commit_changes(items.where(~first | (F.col("line_no") == 2)), version_of(0, 0))
    maintained.refresh()
    mart.table(ORDERS.name).commit_changes(orders.where(~known | (third == 2)), version_of(0, 1))
    maintained.refresh()
    return maintained


@_query
def report_incremental_delivery_status(spark, sf_dir):
    return _maintained(spark, sf_dir).report("delivery_status_summary")


@_query
def report_incremental_top_delivery_dates(spark, sf_dir):
    top = _maintained(spark, sf_dir).report("top_delivery_dates")
    return reports.with_rank(top, "open_order_count", "delivery_date")


@_query
def report_incremental_pending_items(spark, sf_dir):
    return _maintained(spark, sf_dir).report("pending_items_by_product")


@_query
def report_incremental_top_customers(spark, sf_dir):
    top = _maintained(spark, sf_dir).report("top_customers")
    return reports.with_rank(top, "pending_order_count", "customer_id")


# -- jobs on a stored mart ----------------------------------------------------------------------


def _stored_orders(spark, rows: DataFrame) -> Mart:
    mart = Mart(spark, f"{scratch_dir(spark, 'orders')}/mart", {ORDERS.name: ORDERS})
    mart.table(ORDERS.name).commit_state(rows, 0)
    return mart


@_query
def backfill_job(spark, sf_dir):
    mart = _stored_orders(spark, _loaded(spark, sf_dir))
    repair.backfill(mart, "orders", b.source_orders(spark, sf_dir), *_BACKFILL)
    return mart.read("orders").select("order_id", "status", _created_by())


@_query
def backfill_beside_stream(spark, sf_dir):
    """While a backfill is at work, a batch arrives and a state is written; both outlast it."""
    lineage = {EXTRAS: F.lit(None).cast("string"), OFFSET: F.col("order_id")}
    mart = _stored_orders(spark, _loaded(spark, sf_dir))
    table = mart.table(ORDERS.name)
    version = table.claim()
    late = b.source_orders(spark, sf_dir).where(F.col("order_date") > F.lit("1998-01-01").cast("date"))
    table.commit_changes(late.withColumns(lineage).withColumn("status", F.lit("LATE")), version_of(0, 0))
    table.rewrite()
    filled = upsert.apply_defaults(
        upsert.carry_over(_backfilled(spark, sf_dir), table.read(), ORDERS, ["created_by", "updated_by"]), ORDERS
    )
    table.commit_changes(filled, version)
    table.release(version)
    table.rewrite()
    return mart.read("orders").select("order_id", "status")


@_query
def reset_all_job(spark, sf_dir):
    """Counts of every table before and after all are emptied."""
    mart = Mart(spark, f"{scratch_dir(spark, 'all')}/mart", {s.name: s for s in (ORDERS, CUSTOMERS)})
    lineage = {EXTRAS: F.lit(None).cast("string")}
    for spec, rows, key in (
        (ORDERS, b.source_orders(spark, sf_dir), "order_id"),
        (CUSTOMERS, b.source_customers(spark, sf_dir), "customer_id"),
    ):
        mart.table(spec.name).commit_state(rows.withColumns({**lineage, OFFSET: F.col(key)}), 0)
    before = {n: mart.table(n).read(0) for n in mart.specs}
    repair.reset_all(mart)
    after = repair.row_counts({n: mart.read(n) for n in mart.specs}).withColumnRenamed("n", "rows_after")
    return repair.row_counts(before).withColumnRenamed("n", "rows_before").join(after, "table_name")


@_query
def reset_job(spark, sf_dir):
    lineage = {EXTRAS: F.lit(None).cast("string"), OFFSET: F.col("order_id")}
    mart = _stored_orders(spark, b.source_orders(spark, sf_dir).withColumns(lineage))
    before = mart.table("orders").read(0)
    repair.reset_table(mart, "orders", replay=True)
    counts = repair.row_counts({"fact_orders": before}).withColumnRenamed("n", "rows_before")
    after = repair.row_counts({"fact_orders": mart.read("orders")}).withColumnRenamed("n", "rows_after")
    return counts.join(after, "table_name")
