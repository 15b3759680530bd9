"""All registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.functions.encoding import decode_json, decode_table, row_json, text_schema
from feedmill.functions.values import class_text, lenient_double, loose_number
from feedmill.operators.caps import ordered_cap
from feedmill.operators.cleaning import apply_null_policy
from feedmill.operators.counting import count_by, histogram, sum_counts
from feedmill.operators.features import add_features, category_counts, category_places, with_places
from feedmill.operators.metrics import area_under_roc, class_metrics, model_report
from feedmill.operators.models import fold_number, partitions_by_rows
from feedmill.operators.ordinals import slice_rows, with_chunks, with_ordinals
from feedmill.operators.pivoting import pivot_counts
from feedmill.operators.splitting import split_rows
from feedmill.operators.weighting import class_balance, with_class_weight
from feedmill.plans import loan, marketing, marts, report
from feedmill.plans.feed import encode_feed, encode_rows, write_feed_files
from feedmill.sources.releases import Place, publish_together, read_published
from feedmill.sources.scratch import new_path
from feedmill.sources.tables import (
    MESSAGE_SCHEMA,
    Target,
    append_table,
    fan_out,
    publish,
    read_csv,
    read_feed,
    read_table,
    replace_table,
    table_rows,
)
from feedmill.streaming.ingest import BronzeWriter, backlog_files, bronze_table, compact, file_stream, ledger_table, start_ingest, sweep
from feedmill.streaming.progress import ProgressLog, progress_table, request_stop, run_until_marked

from workloads.feeds import (
    LOAN_SILVER_SQL,
    MARKETING_SILVER_SQL,
    RULE_LOAN_SQL,
    RULE_MARKETING_SQL,
    loan_bronze,
    marketing_bronze,
    marketing_csv_bronze,
    rule_loan_bronze,
    rule_marketing_bronze,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None  # None where SQL can't express it


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name with its SQL."""

    def register(run: Query) -> Query:
        ENTRIES[name] = Entry(run, sql)
        return run

    return register


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as the table the next step reads, as between bronze, silver and gold."""
    path = new_path(df.sparkSession, label)
    replace_table(df, path)
    return read_table(df.sparkSession, path)


# --- sources and sinks --------------------------------------------------------

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("csv_scan", ORDERS_SQL)
def csv_scan(spark, sf_dir):
    path = new_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(*ORDERS_COLUMNS)
    orders.write.option("header", True).csv(path)
    return read_csv(spark, path, schema=orders.schema)


@query("csv_scan_inferred", ORDERS_SQL.replace("o_orderkey", "o_orderkey::BIGINT AS o_orderkey", 1))
def csv_scan_inferred(spark, sf_dir):
    path = new_path(spark, "csv")
    table(spark, sf_dir, "orders").select(*ORDERS_COLUMNS).write.option("header", True).csv(path)
    inferred = read_csv(spark, path, infer=True)
    # Inference picks int or bigint by the largest value seen.
    return inferred.withColumns({key: F.col(key).cast("bigint") for key in ("o_orderkey", "o_custkey")})


@query("table_append", ORDERS_SQL)
def table_append(spark, sf_dir):
    path = new_path(spark, "append")
    orders = table(spark, sf_dir, "orders").select(*ORDERS_COLUMNS)
    append_table(orders.where("o_orderstatus = 'F'"), path)
    append_table(orders.where("o_orderstatus <> 'F'"), path)
    return read_table(spark, path, schema=orders.schema)


@query("table_replace", "SELECT o_orderkey, o_totalprice, o_totalprice * 2 AS doubled FROM orders")
def table_replace(spark, sf_dir):
    path = new_path(spark, "replace")
    orders = table(spark, sf_dir, "orders")
    replace_table(orders.select("o_orderkey", "o_orderstatus"), path)
    replace_table(orders.select("o_orderkey", "o_totalprice", (F.col("o_totalprice") * 2).alias("doubled")), path)
    return read_table(spark, path)


@query(
    "write_counts",
    """SELECT 'replaced' AS step, count(*) AS "rows" FROM orders
       UNION ALL SELECT 'table', count(*) + count(*) FILTER (o_orderstatus = 'O') FROM orders""",
)
def write_counts(spark, sf_dir):
    path = new_path(spark, "counted")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    replaced = replace_table(orders, path)
    append_table(orders.where("o_orderstatus = 'O'"), path)
    steps = {"replaced": replaced, "table": table_rows(spark, path)}
    return spark.createDataFrame(list(steps.items()), "step string, rows bigint")


@query(
    "fan_out_mart",
    """WITH m AS (SELECT c_mktsegment AS job, count(*) AS "count" FROM customer GROUP BY 1)
       SELECT 'parquet' AS target, * FROM m UNION ALL SELECT 'json', * FROM m""",
)
def fan_out_mart(spark, sf_dir):
    mart = count_by(table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "job"), "job")
    targets = [Target(fmt, new_path(spark, f"mart-{fmt}")) for fmt in ("parquet", "json")]
    fan_out(mart, targets)
    first, second = [
        read_table(spark, target.path, target.fmt, schema=mart.schema).select(F.lit(target.fmt).alias("target"), "*")
        for target in targets
    ]
    return first.unionByName(second)


@query("publish_text", "SELECT event_id, event_type, value FROM events")
def publish_text(spark, sf_dir):
    path = new_path(spark, "topic")
    publish(encode_rows(table(spark, sf_dir, "events").select("event_id", "event_type", "value")), "text", path)
    read = decode_json(spark.read.text(path), text_schema(["event_id", "event_type", "value"]))
    return read.select(
        F.col("event_id").cast("bigint").alias("event_id"), "event_type", lenient_double("value").alias("value")
    )


@query(
    "publish_places",
    """SELECT ordinal::BIGINT AS ordinal, (ordinal // 1000)::BIGINT AS chunk, ((ordinal // 1000) % 3)::INT AS partition, event_id, event_type
       FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal FROM events)""",
)
def publish_places(spark, sf_dir):
    """Chunk and place of every row of a feed that was published and read back, and the partition of its chunk."""
    path = new_path(spark, "topic")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    publish(encode_feed(events, ["ts", "event_id"], unique=True), "parquet", path, partitions=3)
    sent = read_table(spark, path, schema=MESSAGE_SCHEMA).select(
        F.col("partition"), F.from_json("value", "event_id bigint")["event_id"].alias("event_id")
    )
    read = read_feed(spark, path, "parquet").select("ordinal", "chunk", F.from_json("value", "event_id bigint, event_type string").alias("j"))
    return read.select("ordinal", "chunk", "j.*").join(sent, "event_id")


@query(
    "marts_together",
    """WITH c AS (SELECT c_mktsegment AS job, c_acctbal > 0 AS paid FROM customer),
       m AS (SELECT 'failed' AS step, job, count(*) AS "count" FROM c GROUP BY job
             UNION ALL SELECT 'repaired', job, count(*) FROM c WHERE paid GROUP BY job)
       SELECT step, place, job, "count" FROM m, (VALUES ('first'), ('second')) p(place)""",
)
def marts_together(spark, sf_dir):
    """What two places show after a release whose second place failed, and after it was written anew."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("job"), "c_acctbal")
    first, second = Place(new_path(spark, "marts")), Place(new_path(spark, "marts"), "json")
    old = {"jobs": count_by(customers, "job")}
    new = {"jobs": count_by(customers.where("c_acctbal > 0"), "job")}
    shown = []

    def show(step: str) -> None:
        for name, place in (("first", first), ("second", second)):
            mart = read_published(spark, place, "jobs", "job string, count bigint")
            shown.append(mart.select(F.lit(step).alias("step"), F.lit(name).alias("place"), "job", "count"))

    publish_together(old, [first, second])
    try:
        publish_together(new, [first, replace(second, options={"compression": "unknown"})], attempts=2)
    except PySparkException:
        show("failed")
    publish_together(new, [first, second])
    show("repaired")
    return reduce(DataFrame.unionByName, shown)


# --- projections, casts, null policy ------------------------------------------

@query(
    "json_roundtrip",
    """SELECT event_id::VARCHAR AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS second,
              user_id::VARCHAR AS user_id, event_type, value, props FROM events""",
)
def json_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    decoded = decode_json(encode_rows(events), text_schema(events.columns))
    return decoded.select(
        "event_id", F.substring("ts", 1, 19).alias("second"), "user_id", "event_type",
        lenient_double("value").alias("value"), "props",
    )


@query(
    "json_absent_fields",
    """SELECT o_orderkey::VARCHAR AS o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
              o_orderpriority <> '5-LOW' AS has_key FROM orders""",
)
def json_absent_fields(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "nullif(o_orderpriority, '5-LOW') AS priority")
    encoded = orders.select(row_json(orders.columns).alias("value"))
    schema = text_schema(orders.columns)
    return encoded.select(F.from_json("value", schema).alias("j"), F.contains("value", F.lit("priority")).alias("has_key")).select(
        "j.*", "has_key"
    )


@query(
    "lenient_cast",
    """SELECT o_orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'NaN'::DOUBLE
           WHEN '3-MEDIUM' THEN NULL ELSE o_totalprice END AS amount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0.0::DOUBLE WHEN '2-HIGH' THEN 'NaN'::DOUBLE
           WHEN '3-MEDIUM' THEN NULL WHEN '4-NOT SPECIFIED' THEN 0.0::DOUBLE ELSE o_totalprice END AS loose
       FROM orders""",
)
def lenient_cast(spark, sf_dir):
    price = "CAST(o_totalprice AS STRING)"
    damaged = f"""CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'NaN' WHEN '3-MEDIUM' THEN '13.56%'
                  WHEN '4-NOT SPECIFIED' THEN concat(' ', {price}, ' ') ELSE {price} END"""
    blank = f"""CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'NaN' WHEN '3-MEDIUM' THEN 'n/a'
                WHEN '4-NOT SPECIFIED' THEN ' ' ELSE {price} END"""
    texts = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{damaged} AS damaged", f"{blank} AS blank")
    return texts.select("o_orderkey", lenient_double("damaged").alias("amount"), loose_number("blank").alias("loose"))


@query(
    "null_policy",
    """SELECT o_orderkey, o_totalprice AS must,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 0.0::DOUBLE ELSE o_totalprice END AS amount,
         coalesce(nullif(o_orderpriority, '5-LOW'), 'Unknown') AS priority
       FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
)
def null_policy(spark, sf_dir):
    holes = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN double('NaN') ELSE o_totalprice END AS must",
        "CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN double('NaN') ELSE o_totalprice END AS amount",
        "nullif(o_orderpriority, '5-LOW') AS priority",
    )
    return apply_null_policy(holes, required=["must"], zero_fill=["amount"], text_fill=fixed.MISSING_TEXT)


@query("loan_silver", f"WITH {LOAN_SILVER_SQL} SELECT * FROM silver")
def loan_silver(spark, sf_dir):
    return loan.silver(loan_bronze(spark, sf_dir))


@query("marketing_silver", f"WITH {MARKETING_SILVER_SQL} SELECT * FROM silver")
def marketing_silver(spark, sf_dir):
    return marketing.silver(marketing_bronze(spark, sf_dir))


@query("marketing_silver_common_key", f"WITH {MARKETING_SILVER_SQL} SELECT * FROM silver")
def marketing_silver_common_key(spark, sf_dir):
    """The feed read the way that takes one row's name for all, which holds for this feed."""
    return marketing.silver(marketing_bronze(spark, sf_dir), schema_from_first_row=True)


@query("marketing_silver_mixed", f"WITH {MARKETING_SILVER_SQL} SELECT * FROM silver")
def marketing_silver_mixed(spark, sf_dir):
    """Half of the rows under a second header, an odd row in front, and a broken one."""
    feed = marketing_bronze(spark, sf_dir)
    renamed = F.concat(F.lit('{"other header":'), F.regexp_extract("value", r'^\{(?:"(?:[^"\\]|\\.)*"):(.*)$', 1))
    mixed = feed.select(F.when(F.crc32(F.col("value").cast("binary")) % 2 == 0, renamed).otherwise(F.col("value")).alias("value"))
    odd = spark.range(1).select(F.explode(F.array(F.lit('{"odd":"1"}'), F.lit("{bad"), F.lit('["x"]'))).alias("value"))
    return marketing.silver(odd.unionByName(mixed))


@query(
    "unknown_fields",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN true END AS flag,
              CASE event_id % 3 WHEN 0 THEN user_id::VARCHAR WHEN 2 THEN 'u' || user_id END AS user_id,
              CASE WHEN event_id % 3 = 1 THEN value END AS value
       FROM events UNION ALL SELECT NULL, NULL, NULL, NULL FROM range(4)""",
)
def unknown_fields(spark, sf_dir):
    """A feed whose rows differ in fields and in a field's type, with rows that hold no object."""
    text = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":"u'), F.col("user_id"), F.lit('","flag":true}'))
    value = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct("event_id", "user_id")))
    feed = table(spark, sf_dir, "events").select(value.when(F.col("event_id") % 3 == 1, F.to_json(F.struct("event_id", "value"))).otherwise(text).alias("value"))
    odd = spark.range(1).select(F.explode(F.array(*map(F.lit, ["{bad", '["x"]', "7", None]))).alias("value"))
    return decode_table(odd.unionByName(feed))


@query("marketing_silver_from_csv", f"WITH {MARKETING_SILVER_SQL} SELECT * FROM silver")
def marketing_silver_from_csv(spark, sf_dir):
    return marketing.silver(marketing_csv_bronze(spark, sf_dir))


# --- counts, histograms, weights ----------------------------------------------

def buckets_sql(value: str) -> str:
    return f"CAST(CAST(floor({value} / 5000) * 5000 AS BIGINT) AS VARCHAR)"


@query(
    "balance_hist",
    f"""SELECT {buckets_sql('c_acctbal')} AS balance_range, (c_custkey % 2)::DOUBLE AS prediction, count(*) AS "count"
        FROM customer GROUP BY 1, 2""",
)
def balance_hist(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_acctbal AS balance", "double(c_custkey % 2) AS prediction")
    return histogram(rows, "balance", ["prediction"])


@query(
    "price_hist",
    f"""SELECT {buckets_sql('l_extendedprice')} AS price_range, l_returnflag, l_linestatus, count(*) AS "count"
        FROM lineitem GROUP BY 1, 2, 3""",
)
def price_hist(spark, sf_dir):
    return histogram(
        table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag", "l_linestatus"], name="price_range"
    )


@query("count_by_two", 'SELECT l_returnflag, l_linestatus, count(*) AS "count" FROM lineitem GROUP BY 1, 2')
def count_by_two(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query("count_by_one", 'SELECT c_mktsegment, count(*) AS "count" FROM customer GROUP BY 1')
def count_by_one(spark, sf_dir):
    return count_by(table(spark, sf_dir, "customer"), "c_mktsegment")


@query("count_by_outcome", 'SELECT o_orderpriority, o_orderstatus, count(*) AS "count" FROM orders GROUP BY 1, 2')
def count_by_outcome(spark, sf_dir):
    return count_by(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query("row_count", 'SELECT count(*) AS "rows" FROM lineitem')
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("rows"))


BALANCE_SQL = """SELECT count(*) AS total, count_if(label = 1) AS positives,
    (count(*) - count_if(label = 1))::DOUBLE / count_if(label = 1) AS ratio FROM silver"""


@query("class_balance", f"WITH {LOAN_SILVER_SQL} SELECT total::BIGINT AS total, positives::BIGINT AS positives, round(ratio, 8) AS ratio FROM ({BALANCE_SQL})")
def class_balance_query(spark, sf_dir):
    return class_balance(loan_silver(spark, sf_dir)).withColumn("ratio", F.round("ratio", 8))


@query(
    "class_weight",
    f"""WITH {LOAN_SILVER_SQL}, b AS ({BALANCE_SQL})
        SELECT loan_amnt, label, round(CASE WHEN label = 1 THEN (SELECT ratio FROM b) ELSE 1.0 END, 8) AS weight FROM silver""",
)
def class_weight(spark, sf_dir):
    weighted = with_class_weight(written(loan_silver(spark, sf_dir), "loan-silver"))
    return weighted.select("loan_amnt", "label", F.round("classWeight", 8).alias("weight"))


# --- ordinals, chunks, caps, splits -------------------------------------------

@query(
    "feed_chunks",
    """WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal FROM orders)
       SELECT ordinal::BIGINT AS ordinal, (ordinal // 1000)::BIGINT AS chunk, o_orderkey, o_totalprice FROM o""",
)
def feed_chunks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    feed = encode_feed(orders, ["o_orderdate", "o_orderkey"], rows=None, unique=True)
    decoded = feed.select("ordinal", "chunk", F.from_json("value", "o_orderkey bigint, o_totalprice double").alias("j"))
    return decoded.select("ordinal", "chunk", "j.*")


@query(
    "hot_key_ordinals",
    """WITH e AS (SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS hot, event_id FROM events)
       SELECT hot, event_id, (row_number() OVER (ORDER BY hot, event_id) - 1)::BIGINT AS ordinal FROM e""",
)
def hot_key_ordinals(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hot = events.select(
        F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("bigint").alias("hot"), "event_id"
    )
    return with_ordinals(hot, ["hot", "event_id"], stored=True)


@query(
    "wide_ordinals",
    """SELECT event_id, event_type, value, props,
              (row_number() OVER (ORDER BY event_type, user_id, event_id) - 1)::BIGINT AS by_key,
              ((row_number() OVER (ORDER BY event_type, user_id, event_id) - 1) // 1000)::BIGINT AS chunk FROM events""",
)
def wide_ordinals(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    numbered = with_ordinals(events, ["event_type", "user_id", "event_id"], "by_key", stored=True)
    return with_chunks(numbered, fixed.FEED_CHUNK_ROWS, "by_key").drop("user_id")


@query(
    "feed_slice",
    """SELECT o_orderkey, ordinal::BIGINT AS ordinal FROM
         (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS ordinal FROM orders)
       WHERE ordinal >= 1000 AND ordinal < 2000""",
)
def feed_slice(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    numbered = with_ordinals(orders, ["o_totalprice", "o_orderkey"], unique=True)
    return slice_rows(numbered, 1000, 2000).select("o_orderkey", "ordinal")


@query(
    "chunk_sizes",
    """SELECT (ordinal // 1000)::BIGINT AS chunk, count(*) AS "rows", min(l_orderkey) AS first_key
       FROM (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS ordinal FROM lineitem) GROUP BY 1""",
)
def chunk_sizes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    chunked = with_chunks(with_ordinals(lines, ["l_orderkey", "l_linenumber"], stored=True), fixed.FEED_CHUNK_ROWS)
    return chunked.groupBy("chunk").agg(F.count("*").alias("rows"), F.min("l_orderkey").alias("first_key"))


@query(
    "ordered_cap",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1000",
)
def ordered_cap_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ordered_cap(orders, fixed.SCATTER_ROWS, ["o_totalprice", "o_orderkey"])


@query(
    "ordered_cap_narrowed",
    """SELECT hot, l_extendedprice, l_orderkey, l_linenumber FROM
         (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey END AS hot, * FROM lineitem)
       ORDER BY hot, l_extendedprice, l_orderkey, l_linenumber LIMIT 1000""",
)
def ordered_cap_narrowed(spark, sf_dir):
    """A third of the rows under one leading key."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_suppkey % 3 = 0 THEN 0L ELSE l_suppkey END AS hot", "l_extendedprice", "l_orderkey", "l_linenumber"
    )
    return ordered_cap(lines, fixed.SCATTER_ROWS, lines.columns)


@query(
    "holdout_split",
    """SELECT c_custkey, CASE WHEN ('0x' || substr(md5('42:' || c_custkey), 1, 8))::BIGINT % 10000 < 8000
         THEN 'train' ELSE 'holdout' END AS side FROM customer""",
)
def holdout_split(spark, sf_dir):
    train, holdout = split_rows(table(spark, sf_dir, "customer").select("c_custkey"), key="c_custkey")
    return train.withColumn("side", F.lit("train")).unionByName(holdout.withColumn("side", F.lit("holdout")))


# --- feature preparation ------------------------------------------------------

def index_sql(column: str, source: str) -> str:
    """Category numbers by falling count, then text."""
    return f"""(SELECT {column} AS v, (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS i
                FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"""


@query(
    "category_index",
    f"""SELECT p_partkey, t.i AS p_type_idx, b.i AS p_brand_idx FROM part
        JOIN {index_sql('p_type', 'part')} t ON p_type = t.v JOIN {index_sql('p_brand', 'part')} b ON p_brand = b.v""",
)
def category_index(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    indexed, _ = add_features(parts, ["p_partkey"], ["p_type", "p_brand"])
    return indexed.select("p_partkey", "p_type_idx", "p_brand_idx")


@query(
    "category_index_nulls",
    f"""WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
        SELECT o_orderkey, coalesce(p.i, (SELECT count(DISTINCT priority) FROM o)::DOUBLE) AS priority_idx
        FROM o LEFT JOIN {index_sql('priority', 'o')} p ON priority = p.v""",
)
def category_index_nulls(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "nullif(o_orderpriority, '5-LOW') AS priority")
    indexed, _ = add_features(orders, ["o_orderkey"], ["priority"])
    return indexed.select("o_orderkey", "priority_idx")


@query(
    "category_index_wide",
    f"""WITH e AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'hot' WHEN user_id % 7 = 0 THEN NULL
                   ELSE user_id::VARCHAR END AS who FROM events)
        SELECT event_id, who, coalesce(w.i, (SELECT count(DISTINCT who) FROM e)::DOUBLE) AS who_idx
        FROM e LEFT JOIN {index_sql('who', 'e')} w ON who = w.v""",
)
def category_index_wide(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN user_id % 3 = 0 THEN 'hot' WHEN user_id % 7 = 0 THEN NULL ELSE string(user_id) END AS who"
    )
    # Few labels by broadcast, so that the others go through the join.
    return with_places(events, ["who"], *category_places(category_counts(events, ["who"])), hot_labels=100)


@query(
    "feature_vector",
    """SELECT o_orderkey::DOUBLE AS f0, o_totalprice AS f1 FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""",
)
def feature_vector(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN double('NaN') ELSE o_totalprice END AS amount",
    )
    featured, _ = add_features(rows, ["o_orderkey", "amount"], [])
    return spread(featured, "features", 2)


def spread(df: DataFrame, vector: str, size: int, *columns: str, digits: int | None = None) -> DataFrame:
    """The elements of a vector as columns f0, f1, ..."""
    values = vector_to_array(F.col(vector))
    parts = [F.get(values, F.lit(place)) for place in range(size)]
    if digits is not None:
        parts = [F.round(part, digits) for part in parts]
    return df.select(*columns, *[part.alias(f"f{place}") for place, part in enumerate(parts)])


@query(
    "feature_scaled",
    f"""WITH s AS (SELECT stddev_samp(c_acctbal) AS a, stddev_samp(c_nationkey) AS n, stddev_samp(i) AS m FROM customer
                   JOIN {index_sql('c_mktsegment', 'customer')} x ON c_mktsegment = x.v)
        SELECT c_custkey, round(c_acctbal / a, 6) AS f0, round(c_nationkey / n, 6) AS f1, 0.0::DOUBLE AS f2, round(x.i / m, 6) AS f3
        FROM customer JOIN {index_sql('c_mktsegment', 'customer')} x ON c_mktsegment = x.v, s""",
)
def feature_scaled(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("constant", F.lit(7.0))
    featured, _ = add_features(rows, ["c_acctbal", "c_nationkey", "constant"], ["c_mktsegment"], scale=True)
    return spread(featured, "features", 4, "c_custkey", digits=6)


def _loan_gold_sql() -> str:
    indexed = ", ".join(f"{name}_i.i AS {name}_idx" for name in fixed.LOAN_CATEGORICAL)
    joins = " ".join(f"JOIN {index_sql(name, 'silver')} {name}_i ON {name} = {name}_i.v" for name in fixed.LOAN_CATEGORICAL)
    features = [*fixed.LOAN_NUMERIC, *[f"{name}_idx" for name in fixed.LOAN_CATEGORICAL]]
    deviations = ", ".join(f"stddev_samp({name}) AS s{place}" for place, name in enumerate(features))
    scaled = ", ".join(
        f"round(CASE WHEN s{place} = 0 THEN 0 ELSE {name} / s{place} END, 4) AS f{place}" for place, name in enumerate(features)
    )
    return f"""WITH {LOAN_SILVER_SQL}, b AS ({BALANCE_SQL}),
        indexed AS (SELECT silver.*, {indexed} FROM silver {joins}),
        s AS (SELECT {deviations} FROM indexed)
        SELECT loan_amnt, label, round(CASE WHEN label = 1 THEN (SELECT ratio FROM b) ELSE 1.0 END, 8) AS weight,
               term_idx, grade_idx, emp_length_idx, home_ownership_idx, {scaled} FROM indexed, s"""


@query("loan_gold", _loan_gold_sql())
def loan_gold(spark, sf_dir):
    gold = loan.gold(written(loan_silver(spark, sf_dir), "loan-silver"))
    indexes = [f"{name}_idx" for name in fixed.LOAN_CATEGORICAL]
    weighted = gold.withColumn("weight", F.round("classWeight", 8))
    return spread(weighted, "features", 10, "loan_amnt", "label", "weight", *indexes, digits=4)


def _marketing_gold_sql() -> str:
    parts = [
        f"coalesce({name}_i.i, (SELECT count(DISTINCT {name}) FROM silver)::DOUBLE) AS f{len(fixed.MARKETING_NUMERIC) + place}"
        for place, name in enumerate(fixed.MARKETING_CATEGORICAL)
    ]
    joins = " ".join(
        f"LEFT JOIN {index_sql(name, 'silver')} {name}_i ON silver.{name} = {name}_i.v" for name in fixed.MARKETING_CATEGORICAL
    )
    numbers = ", ".join(f"{name} AS f{place}" for place, name in enumerate(fixed.MARKETING_NUMERIC))
    complete = " AND ".join(f"{name} IS NOT NULL" for name in fixed.MARKETING_NUMERIC)
    return f"""WITH {MARKETING_SILVER_SQL} SELECT label, {numbers}, {', '.join(parts)} FROM silver {joins} WHERE {complete}"""


@query("marketing_gold", _marketing_gold_sql())
def marketing_gold(spark, sf_dir):
    return spread(marketing.gold(written(marketing_silver(spark, sf_dir), "marketing-silver")), "features", 9, "label")


# --- quality metrics ----------------------------------------------------------

SCORED_SQL = """s AS (SELECT value AS score, CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS label,
                      CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END AS prediction FROM events)"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "value AS score", "double(event_type = 'purchase') AS label", "double(value > 50) AS prediction"
    )


CLASS_METRICS_SQL = f"""WITH {SCORED_SQL}, c AS (
      SELECT k, count_if(label = k)::DOUBLE AS actual, count_if(prediction = k)::DOUBLE AS predicted,
             count_if(label = k AND prediction = k)::DOUBLE AS hits
      FROM s, (VALUES (0.0), (1.0)) t(k) GROUP BY k)
    SELECT (SELECT count(*) FROM s) AS "rows", round(sum(hits) / sum(actual), 9) AS accuracy,
           round(sum(hits / predicted * actual) / sum(actual), 9) AS weighted_precision,
           round(sum(hits / actual * actual) / sum(actual), 9) AS weighted_recall FROM c"""


@query("metrics_class", CLASS_METRICS_SQL)
def metrics_class(spark, sf_dir):
    return rounded(class_metrics(scored_events(spark, sf_dir)))


def rounded(metrics: DataFrame, digits: int = 9) -> DataFrame:
    names = ["accuracy", "weighted_precision", "weighted_recall", "auc"]
    return metrics.withColumns({name: F.round(name, digits) for name in names if name in metrics.columns})


AUC_SQL = f"""WITH {SCORED_SQL}, r AS (
      SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM s),
    n AS (SELECT count_if(label = 1)::DOUBLE AS p, count_if(label = 0)::DOUBLE AS q FROM s)
    SELECT round((sum(place) FILTER (label = 1) - max(p) * (max(p) + 1) / 2) / (max(p) * max(q)), 9) AS auc FROM r, n"""


@query("metrics_auc", AUC_SQL)
def metrics_auc(spark, sf_dir):
    return rounded(area_under_roc(scored_events(spark, sf_dir), "score"))


@query(
    "model_report",
    f"""SELECT 'threshold' AS model, m.*, a.auc FROM ({CLASS_METRICS_SQL}) m, ({AUC_SQL}) a""",
)
def model_report_query(spark, sf_dir):
    return rounded(model_report(scored_events(spark, sf_dir), "threshold"))


NULLS_SQL = SCORED_SQL.replace("SELECT value AS score, CASE", "SELECT nullif(value, 50) AS score, CASE WHEN user_id % 7 = 0 THEN NULL", 1)


@query(
    "metrics_null_labels",
    f"""SELECT m."rows", m.accuracy, a.auc FROM ({CLASS_METRICS_SQL.replace(SCORED_SQL, NULLS_SQL).replace("FROM s) AS", "FROM s WHERE label IS NOT NULL) AS").replace("FROM s, (VALUES", "FROM (SELECT * FROM s WHERE label IS NOT NULL), (VALUES")}) m,
        ({AUC_SQL.replace(SCORED_SQL, NULLS_SQL).replace("AS place FROM s)", "AS place FROM s WHERE label IS NOT NULL AND score IS NOT NULL)").replace("AS q FROM s)", "AS q FROM s WHERE score IS NOT NULL)")}) a""",
)
def metrics_null_labels(spark, sf_dir):
    """Rows without a label count in no metric, rows without a score not in the area."""
    scored = scored_events(spark, sf_dir)
    events = table(spark, sf_dir, "events").selectExpr(
        "nullif(value, 50) AS score", "CASE WHEN user_id % 7 = 0 THEN NULL ELSE double(event_type = 'purchase') END AS label",
        "double(value > 50) AS prediction",
    ).select(*scored.columns)
    return rounded(model_report(events, "threshold")).select("rows", "accuracy", "auc")


# --- marts --------------------------------------------------------------------

LOAN_RESULTS_SQL = "loan_results AS (SELECT loan_amnt, (dti > 20)::INT::DOUBLE AS prediction, label, grade, dti FROM silver)"
MARKETING_RESULTS_SQL = "marketing_results AS (SELECT age, job, balance, (duration > 300)::INT::DOUBLE AS prediction, label FROM silver)"


def loan_results(silver: DataFrame) -> DataFrame:
    """Loan results with a rule in the place of a model."""
    return silver.withColumn("prediction", (F.col("dti") > 20).cast("double")).select(*fixed.LOAN_RESULT_COLUMNS)


def marketing_results(silver: DataFrame) -> DataFrame:
    """Marketing results with a rule in the place of a model."""
    predicted = silver.withColumn("prediction", (F.col("duration") > 300).cast("double"))
    return predicted.select(*fixed.MARKETING_RESULT_COLUMNS)


LOAN_MART_WITH = f"WITH {LOAN_SILVER_SQL}, {LOAN_RESULTS_SQL}"
MARKETING_MART_WITH = f"WITH {MARKETING_SILVER_SQL}, {MARKETING_RESULTS_SQL}"


@query("viz_loan_grade", f'{LOAN_MART_WITH} SELECT grade, prediction, count(*) AS "count" FROM loan_results GROUP BY 1, 2')
def viz_loan_grade(spark, sf_dir):
    return marts.loan_grade(loan_results(loan_silver(spark, sf_dir)))


@query("viz_loan_home", f'{LOAN_MART_WITH} SELECT home_ownership, count(*) AS "count" FROM silver GROUP BY 1')
def viz_loan_home(spark, sf_dir):
    return marts.loan_home(loan_silver(spark, sf_dir))


@query(
    "viz_mkt_balance",
    f"""{MARKETING_MART_WITH} SELECT {buckets_sql('balance')} AS balance_range, prediction, count(*) AS "count"
        FROM marketing_results GROUP BY 1, 2""",
)
def viz_mkt_balance(spark, sf_dir):
    return marts.marketing_balance(marketing_results(marketing_silver(spark, sf_dir)))


@query("viz_mkt_edu", f'{MARKETING_MART_WITH} SELECT education, y, count(*) AS "count" FROM silver GROUP BY 1, 2')
def viz_mkt_edu(spark, sf_dir):
    return marts.marketing_education(marketing_silver(spark, sf_dir))


@query("viz_mkt_job", f'{MARKETING_MART_WITH} SELECT job, prediction, count(*) AS "count" FROM marketing_results GROUP BY 1, 2')
def viz_mkt_job(spark, sf_dir):
    return marts.marketing_job(marketing_results(marketing_silver(spark, sf_dir)))


@query(
    "viz_loan_scatter",
    f"{LOAN_MART_WITH} SELECT dti, loan_amnt, prediction FROM loan_results ORDER BY dti, loan_amnt, prediction LIMIT 1000",
)
def viz_loan_scatter(spark, sf_dir):
    return marts.loan_scatter(loan_results(loan_silver(spark, sf_dir)), fixed.SCATTER_ROWS, order_by=["dti", "loan_amnt", "prediction"])


# --- report -------------------------------------------------------------------

@query(
    "grade_risk",
    f"""{LOAN_MART_WITH} SELECT g AS grade, count(*) FILTER (prediction = 0) AS safe, count(*) FILTER (prediction = 1) AS risky
        FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'F', 'G']) AS g) LEFT JOIN loan_results ON grade = g GROUP BY 1""",
)
def grade_risk(spark, sf_dir):
    return report.grade_risk(viz_loan_grade(spark, sf_dir))


@query(
    "pivot_rows",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1""",
)
def pivot_rows(spark, sf_dir):
    return pivot_counts(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", {"f": "F", "o": "O"})


@query(
    "education_outcome",
    f"""{MARKETING_MART_WITH} SELECT education, count(*) FILTER (y = 'yes') AS yes, count(*) FILTER (y = 'no') AS "no" FROM silver GROUP BY 1""",
)
def education_outcome(spark, sf_dir):
    return report.education_outcome(viz_mkt_edu(spark, sf_dir))


@query(
    "job_groups",
    f"""{MARKETING_MART_WITH}, g AS (SELECT CASE WHEN lower(job) IN ('admin.', 'management', 'entrepreneur', 'self-employed') THEN 'office'
          WHEN lower(job) IN ('blue-collar', 'technician', 'services', 'housemaid') THEN 'labor' ELSE 'other' END AS job_group
        FROM marketing_results)
        SELECT d.job_group, count(g.job_group) AS "count"
        FROM (SELECT unnest(['office', 'labor', 'other']) AS job_group) d LEFT JOIN g USING (job_group) GROUP BY 1""",
)
def job_groups(spark, sf_dir):
    return report.job_groups(viz_mkt_job(spark, sf_dir))


BANDS_SQL = """SELECT d.band, count(b.band) AS "count" FROM (SELECT unnest(['debt', 'low', 'middle', 'VIP']) AS band) d
               LEFT JOIN b USING (band) GROUP BY 1"""


@query(
    "asset_bands",
    f"""{MARKETING_MART_WITH}, b AS (SELECT CASE WHEN balance < 0 THEN 'debt' WHEN balance IS NULL OR balance < 10000 THEN 'low'
          WHEN balance < 55000 THEN 'middle' ELSE 'VIP' END AS band FROM marketing_results) {BANDS_SQL}""",
)
def asset_bands(spark, sf_dir):
    return report.asset_bands(viz_mkt_balance(spark, sf_dir))


@query(
    "price_bands",
    f"""WITH b AS (SELECT CASE WHEN l_extendedprice < 10000 THEN 'low' WHEN l_extendedprice < 55000 THEN 'middle'
          ELSE 'VIP' END AS band FROM lineitem) {BANDS_SQL}""",
)
def price_bands(spark, sf_dir):
    return report.asset_bands(histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(
    "segment_groups",
    """SELECT d.part AS part, count(c.part) AS "count" FROM (SELECT unnest(['BUILDING', 'MACHINERY', 'NONE', 'OTHER']) AS part) d
       LEFT JOIN (SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'OTHER' END AS part FROM customer) c
       USING (part) GROUP BY 1""",
)
def segment_groups(spark, sf_dir):
    counts = count_by(table(spark, sf_dir, "customer"), "c_mktsegment")
    part = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")).otherwise("OTHER")
    return sum_counts(counts, part, "part", ["BUILDING", "MACHINERY", "NONE", "OTHER"])


@query(
    "class_text",
    """SELECT CASE WHEN l_linenumber = 3 THEN 'NaN' ELSE printf('%.1f', l_linenumber::DOUBLE) END AS "text", count(*) AS "count"
       FROM lineitem GROUP BY 1""",
)
def class_text_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(class_text(F.expr("nullif(l_linenumber, 3)")).alias("text"))
    return count_by(lines, "text")


@query("class_points", f"{LOAN_MART_WITH} SELECT dti AS x, loan_amnt AS y FROM loan_results WHERE prediction = 1")
def class_points(spark, sf_dir):
    return report.class_points(loan_results(loan_silver(spark, sf_dir)), "1.0")


@query("home_share", f'{LOAN_MART_WITH} SELECT home_ownership, count(*) AS "count" FROM silver GROUP BY 1')
def home_share(spark, sf_dir):
    return report.home_share(viz_loan_home(spark, sf_dir))


@query(
    "chart_rows",
    f"""WITH l AS ({LOAN_MART_WITH} SELECT * FROM (
            SELECT 'grade' AS chart, json_array(grade, printf('%.1f', prediction), count(*)) AS entry FROM loan_results GROUP BY grade, prediction
            UNION ALL SELECT 'home', json_array(home_ownership, count(*)) FROM silver GROUP BY home_ownership
            UNION ALL SELECT 'scatter', json_array(dti, loan_amnt, printf('%.1f', prediction)) FROM loan_results)),
         m AS ({MARKETING_MART_WITH} SELECT * FROM (
            SELECT 'job' AS chart, json_array(job, CASE WHEN prediction IS NULL THEN 'NaN' ELSE printf('%.1f', prediction) END, count(*)) AS entry
              FROM marketing_results GROUP BY job, prediction
            UNION ALL SELECT 'balance', json_array({buckets_sql('balance')}, CASE WHEN prediction IS NULL THEN 'NaN' ELSE printf('%.1f', prediction) END, count(*))
              FROM marketing_results GROUP BY {buckets_sql('balance')}, prediction
            UNION ALL SELECT 'edu', json_array(education, y, count(*)) FROM silver GROUP BY education, y))
        SELECT chart, entry::VARCHAR AS entry FROM l UNION ALL SELECT chart, entry::VARCHAR FROM m""",
)
def chart_rows(spark, sf_dir):
    loans = written(loan_silver(spark, sf_dir), "loan-silver")
    contacts = written(marketing_silver(spark, sf_dir), "marketing-silver")
    return report.chart_rows(marts.build_marts(loan_results(loans), marketing_results(contacts), loans, contacts))


# --- streaming ----------------------------------------------------------------

STREAM_CHUNK_ROWS = 1_000
STREAM_FILES_PER_BATCH = "32"


def ingest_events(spark: SparkSession, sf_dir: str, files_per_batch: str = STREAM_FILES_PER_BATCH) -> tuple[str, str]:
    """All events as a feed of JSON files, streamed into bronze; bronze and ledger paths.

    A long feed comes in larger batches, not in more of them.
    """
    topic, bronze, ledger, checkpoint = [
        new_path(spark, f"stream-{part}") for part in ("topic", "bronze", "ledger", "checkpoint")
    ]
    events = table(spark, sf_dir, "events")
    feed = encode_feed(events, ["event_id"], rows=None, chunk_rows=STREAM_CHUNK_ROWS, unique=True)
    write_feed_files(feed, topic, STREAM_CHUNK_ROWS)
    files = -(-events.count() // STREAM_CHUNK_ROWS)
    source = file_stream(spark, topic, maxFilesPerTrigger=str(backlog_files(files, int(files_per_batch))))
    start_ingest(source, bronze, ledger, checkpoint, trigger=None).awaitTermination()
    return bronze, ledger


@query("stream_ingest", "SELECT event_id, user_id, event_type, value, (props::JSON ->> '$.k')::BIGINT AS k FROM events")
def stream_ingest(spark, sf_dir):
    bronze, ledger = ingest_events(spark, sf_dir)
    rows = decode_json(
        bronze_table(spark, bronze, ledger=ledger), "event_id bigint, user_id bigint, event_type string, value double, props string"
    )
    return rows.withColumn("k", F.from_json("props", "k bigint")["k"]).drop("props")


@query("stream_ledger", 'SELECT count(*) AS "rows", count(*) AS total_rows FROM events')
def stream_ledger(spark, sf_dir):
    """Rows of all batches, and the running total of the last one."""
    _, ledger = ingest_events(spark, sf_dir)
    return ledger_table(spark, ledger).agg(F.sum("rows").alias("rows"), F.max("total_rows").alias("total_rows"))


@query("stream_compacted", """SELECT event_id, user_id, event_type, value, count(*) OVER () AS total_rows FROM events""")
def stream_compacted(spark, sf_dir):
    """All events out of a bronze table whose batches have been folded, and the ledger's total."""
    bronze, ledger = ingest_events(spark, sf_dir, files_per_batch="4")
    compact(spark, bronze, ledger, keep=1)
    rows = decode_json(bronze_table(spark, bronze, ledger=ledger), "event_id bigint, user_id bigint, event_type string, value double")
    return rows.withColumn("total_rows", ledger_table(spark, ledger).agg(F.max("total_rows")).scalar())


@query(
    "stream_restarted",
    """SELECT event_id, user_id, event_type, value, count(*) OVER () AS total_rows, 0 AS leftovers FROM events""",
)
def stream_restarted(spark, sf_dir):
    """All events once, after a batch was written twice, another one not to its end, a fold begun for nothing and a restart."""
    bronze, ledger = ingest_events(spark, sf_dir, files_per_batch="2")
    again = bronze_table(spark, bronze, ledger=ledger).where("false")
    last = ledger_table(spark, ledger).agg(F.max("batch")).first()[0]
    values = bronze_table(spark, bronze, ledger=ledger)
    values.write.parquet(f"{bronze}/batch-{last + 1}-unfinished")
    values.write.parquet(f"{bronze}/fold-{last}-unfinished")
    BronzeWriter(bronze, ledger)(again, last + 1)  # an empty batch
    compact(spark, bronze, ledger, keep=1, kept_versions=1, leftover_seconds=0)
    BronzeWriter(bronze, ledger)(values, 0)  # a batch that has been folded comes again
    rows = decode_json(bronze_table(spark, bronze, ledger=ledger), "event_id bigint, user_id bigint, event_type string, value double")
    sweep(spark, bronze, ledger, 1, 0)
    left = sweep(spark, bronze, ledger, 1, 0)  # what the first sweep has overlooked
    return rows.withColumn("total_rows", ledger_table(spark, ledger).agg(F.max("total_rows")).scalar()).withColumn("leftovers", F.lit(left))


@query("stream_progress", 'SELECT false AS idle, count(*) AS "rows" FROM events UNION ALL SELECT true, 0')
def stream_progress(spark, sf_dir):
    """Rows of the triggers that had some and of those that had none, of a timed stream ended by its marker."""
    topic, bronze, ledger, checkpoint, progress, marker = [
        new_path(spark, f"timed-{part}") for part in ("topic", "bronze", "ledger", "checkpoint", "progress", "stop")
    ]
    encode_rows(table(spark, sf_dir, "events")).write.text(topic)
    log, often = ProgressLog(spark, progress), "spark.sql.streaming.noDataProgressEventInterval"
    before = spark.conf.get(often)
    spark.conf.set(often, "500")
    spark.streams.addListener(log)
    try:
        query_ = start_ingest(file_stream(spark, topic, maxFilesPerTrigger="2"), bronze, ledger, checkpoint, trigger="200 milliseconds")
        query_.processAllAvailable()
        log.idle.clear()
        log.idle.wait(60)
        request_stop(spark, marker)
        run_until_marked(query_, spark, marker, every=0.2)
        log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set(often, before)
    log.write()
    return progress_table(spark, progress).groupBy("idle").agg(F.sum("rows").alias("rows"))


@query(
    "fold_sizes",
    """SELECT ('0x' || substr(md5('42:' || c_custkey), 1, 8))::BIGINT % 3 AS fold, count(*) AS "rows",
              min(c_custkey) AS least, max(c_custkey) AS largest
       FROM customer GROUP BY 1""",
)
def fold_sizes(spark, sf_dir):
    """Rows and range of keys per fold of a cross-validation whose folds follow a key."""
    customers = table(spark, sf_dir, "customer")
    folds = customers.select(fold_number(customers, fixed.LOGIT_FOLDS, key=F.col("c_custkey")).alias("fold"), "c_custkey")
    return folds.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.min("c_custkey").alias("least"), F.max("c_custkey").alias("largest")
    )


# --- models -------------------------------------------------------------------
# SQL knows the holdout rows, since their key decides. Of the models it states what
# must hold: classes are 0 or 1, the ranking beats chance clearly, settings are as asked for.

LOAN_KEY = "CAST(annual_inc * 1000 + fico_range_low AS BIGINT)"
MARKETING_KEY = "CAST(age * 1000000 + duration * 100 + campaign AS BIGINT)"


def holdout_sql(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % 10000 >= 8000"


def trained_loans(spark: SparkSession, sf_dir: str):
    """Loans from the feed through silver and gold tables to fitted models."""
    silver = written(loan_silver(spark, sf_dir), "loan-silver")
    key = F.expr(LOAN_KEY)
    gold = written(loan.gold(silver, fit_rows=split_rows(silver, key=key)[0]), "loan-gold")
    return loan.train_and_score(gold, key=key, partitions=partitions_by_rows(gold))


def trained_marketing(spark: SparkSession, sf_dir: str):
    """Contacts from the feed through silver and gold tables to a fitted forest."""
    silver = written(marketing_silver(spark, sf_dir), "marketing-silver")
    complete = silver.na.drop(subset=fixed.MARKETING_NUMERIC)
    key = F.expr(MARKETING_KEY)
    gold = written(marketing.gold(complete, fit_rows=split_rows(complete, key=key)[0]), "marketing-gold")
    return marketing.train_and_score(gold, key=key, partitions=partitions_by_rows(gold))


def checked_report(trained, least: float) -> DataFrame:
    """The report's rows with what must hold of the models in place of their figures."""
    forest = len(trained.models["forest"].trees) == fixed.FOREST_TREES
    logistic = "logistic" in trained.models and trained.models["logistic"].getRegParam() in fixed.LOGIT_REG_PARAMS
    as_set = F.when(F.col("model") == "forest", F.lit(forest)).otherwise(F.lit(logistic))
    return trained.report.select("model", "rows", (F.col("auc") > least).alias("ranks"), as_set.alias("as_set"))


def checked_results(trained) -> DataFrame:
    known = F.col("prediction").isin(0.0, 1.0)
    return trained.results.select(*[name for name in trained.results.columns if name != "prediction"], known.alias("known"))


LOAN_HOLDOUT_SQL = f"WITH {LOAN_SILVER_SQL}, holdout AS (SELECT * FROM silver WHERE {holdout_sql(LOAN_KEY)})"
MARKETING_HOLDOUT_SQL = f"""WITH {MARKETING_SILVER_SQL}, holdout AS (SELECT * FROM silver
    WHERE balance IS NOT NULL AND duration IS NOT NULL AND campaign IS NOT NULL AND {holdout_sql(MARKETING_KEY)})"""


@query(
    "logit_cv_report",
    f"""{LOAN_HOLDOUT_SQL} SELECT unnest(['forest', 'logistic']) AS model, "rows", true AS ranks, true AS as_set
        FROM (SELECT count(*) AS "rows" FROM holdout)""",
)
def logit_cv_report(spark, sf_dir):
    return checked_report(trained_loans(spark, sf_dir), 0.65)


@query("logit_cv_score", f"{LOAN_HOLDOUT_SQL} SELECT loan_amnt, label, grade, dti, true AS known FROM holdout")
def logit_cv_score(spark, sf_dir):
    return checked_results(trained_loans(spark, sf_dir))


@query(
    "forest_report",
    f"""{MARKETING_HOLDOUT_SQL} SELECT 'forest' AS model, count(*) AS "rows", true AS ranks, true AS as_set FROM holdout""",
)
def forest_report(spark, sf_dir):
    return checked_report(trained_marketing(spark, sf_dir), 0.6)


@query("forest_score", f"{MARKETING_HOLDOUT_SQL} SELECT age, job, balance, label, true AS known FROM holdout")
def forest_score(spark, sf_dir):
    return checked_results(trained_marketing(spark, sf_dir))


# Models of feeds whose fields follow from one value: SQL knows every prediction, and the
# order of the scores follows from the value, so it knows the area too.
RULE_LOAN_HOLDOUT = f"{RULE_LOAN_SQL}, holdout AS (SELECT * FROM silver WHERE {holdout_sql('fico_range_low')})"
RULE_MARKETING_HOLDOUT = f"{RULE_MARKETING_SQL}, holdout AS (SELECT * FROM silver WHERE {holdout_sql('o_orderkey')})"


def quality_sql(holdout: str) -> tuple[str, str]:
    """SQL of the class metrics and of the area of a holdout with score, label and prediction."""
    scored = f"{holdout}, s AS (SELECT score, label, prediction FROM holdout)"
    return CLASS_METRICS_SQL.replace(SCORED_SQL, scored), AUC_SQL.replace(SCORED_SQL, scored)


def rule_loans(spark: SparkSession, sf_dir: str):
    silver = written(loan.silver(rule_loan_bronze(spark, sf_dir)), "rule-loan-silver")
    key = F.expr("CAST(fico_range_low AS BIGINT)")
    gold = written(loan.gold(silver, fit_rows=split_rows(silver, key=key)[0]), "rule-loan-gold")
    return loan.train_and_score(gold, key=key, partitions=partitions_by_rows(gold))


def rule_marketing(spark: SparkSession, sf_dir: str):
    silver = written(marketing.silver(rule_marketing_bronze(spark, sf_dir)), "rule-marketing-silver")
    gold = written(marketing.gold(silver, fit_rows=split_rows(silver, key="day")[0]), "rule-marketing-gold")
    return marketing.train_and_score(gold, key="day", partitions=partitions_by_rows(gold))


def rule_loan_report_sql() -> str:
    metrics, area = quality_sql(RULE_LOAN_HOLDOUT)
    return f"""SELECT model, m.*, CASE model WHEN 'logistic' THEN a.auc END AS auc
               FROM (VALUES ('forest'), ('logistic')) t(model), ({metrics}) m, ({area}) a"""


def rule_marketing_report_sql() -> str:
    metrics, area = quality_sql(RULE_MARKETING_HOLDOUT)
    return f"SELECT 'forest' AS model, m.*, a.auc FROM ({metrics}) m, ({area}) a"


@query("rule_loan_report", rule_loan_report_sql())
def rule_loan_report(spark, sf_dir):
    """Of the forest all but the area: within a side of the gap its order is not that of the value."""
    report_rows = rounded(rule_loans(spark, sf_dir).report)
    return report_rows.withColumn("auc", F.when(F.col("model") == "logistic", F.col("auc")))


@query("rule_loan_score", f"WITH {RULE_LOAN_HOLDOUT} SELECT loan_amnt, prediction, label, grade, dti FROM holdout")
def rule_loan_score(spark, sf_dir):
    return rule_loans(spark, sf_dir).results


@query("rule_marketing_report", rule_marketing_report_sql())
def rule_marketing_report(spark, sf_dir):
    return rounded(rule_marketing(spark, sf_dir).report)


@query("rule_marketing_score", f"WITH {RULE_MARKETING_HOLDOUT} SELECT age, job, balance, prediction, label FROM holdout")
def rule_marketing_score(spark, sf_dir):
    return rule_marketing(spark, sf_dir).results


def bronze_to_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: loan feed, silver, settled loans per grade and label, as a report."""
    counts = count_by(loan.silver(loan_bronze(spark, sf_dir), ["grade"]), "grade", "label")
    return pivot_counts(counts, "grade", class_text("label"), report.CLASS_COLUMNS, count="count", domain=fixed.GRADES)


query(
    "bronze_to_report",
    f"""WITH {LOAN_SILVER_SQL} SELECT g AS grade, count(*) FILTER (label = 0) AS safe, count(*) FILTER (label = 1) AS risky
        FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'F', 'G']) AS g) LEFT JOIN silver ON grade = g GROUP BY 1""",
)(bronze_to_report)
