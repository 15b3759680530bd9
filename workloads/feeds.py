"""Loan and marketing feeds derived from the given tables.

Orders play loans, customers play contacts. Every row of the source table
becomes one feed row; on the way some values are damaged on purpose (missing,
not a number, cut short, not JSON), so that casts, fills and drops have work.
The SQL beside each feed states the values a clean reading must find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill import fixed_values as fixed
from feedmill.operators.splitting import key_bucket
from feedmill.plans.feed import encode_rows
from feedmill.sources.scratch import new_path
from feedmill.sources.tables import read_csv

HEADER_LINE = ";".join(f'"{name}"' for name in fixed.MARKETING_FIELDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- loans --------------------------------------------------------------------

def loan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as a CSV reader with type inference would hand them over."""
    orders = table(spark, sf_dir, "orders").withColumn("noise", key_bucket("o_orderkey", seed=7, buckets=10) < 2)
    return orders.selectExpr(
        """CASE WHEN o_orderstatus = 'P' THEN 'Current'
                WHEN (o_totalprice > 250000) <> noise THEN 'Charged Off'
                ELSE 'Fully Paid' END AS loan_status""",
        """CASE WHEN o_orderkey % 11 = 0 THEN NULL
                WHEN o_orderkey % 13 = 0 THEN 'n/a'
                WHEN o_orderkey % 17 = 0 THEN concat(' ', CAST(o_totalprice AS STRING), ' ')
                ELSE CAST(o_totalprice AS STRING) END AS loan_amnt""",
        """CASE WHEN o_orderkey % 7 = 0 THEN concat(CAST(o_orderkey % 25 AS STRING), '.5%')
                ELSE CAST(5 + o_orderkey % 20 AS STRING) END AS int_rate""",
        "o_totalprice / 36 AS installment",
        """CASE WHEN o_custkey % 19 = 0 THEN ''
                ELSE CAST(5000 + o_custkey * 100 AS STRING) END AS annual_inc""",
        """CASE WHEN o_orderkey % 23 = 0 THEN 'NaN'
                ELSE CAST(CAST(o_orderkey % 400 AS DOUBLE) / 10 AS STRING) END AS dti""",
        "600 + o_orderkey % 250 AS fico_range_low",
        "CASE WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B'
                WHEN '3-MEDIUM' THEN 'C' WHEN '4-NOT SPECIFIED' THEN 'D' END AS grade""",
        "CASE WHEN o_orderkey % 10 <> 0 THEN concat(CAST(o_custkey % 11 AS STRING), ' years') END AS emp_length",
        "CASE o_custkey % 5 WHEN 1 THEN 'RENT' WHEN 2 THEN 'OWN' WHEN 3 THEN 'MORTGAGE' WHEN 4 THEN 'OTHER' END AS home_ownership",
        "o_orderkey % 29 = 0 AS cut_off",
    )


def loan_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan feed; some of its texts break off inside the JSON."""
    rows = loan_rows(spark, sf_dir)
    encoded = rows.select("cut_off", F.to_json(F.struct(*fixed.LOAN_FIELDS)).alias("value"))
    return encoded.select(F.when(F.col("cut_off"), '{"loan_status": ').otherwise(F.col("value")).alias("value"))


LOAN_SILVER_SQL = """
silver AS (
  SELECT
    CASE WHEN (o_totalprice > 250000) <> noise THEN 'Charged Off' ELSE 'Fully Paid' END AS loan_status,
    o_totalprice AS loan_amnt,
    CASE WHEN o_orderkey % 7 = 0 THEN 0.0::DOUBLE ELSE (5 + o_orderkey % 20)::DOUBLE END AS int_rate,
    o_totalprice / 36 AS installment,
    (5000 + o_custkey * 100)::DOUBLE AS annual_inc,
    CASE WHEN o_orderkey % 23 = 0 THEN 0.0::DOUBLE ELSE (o_orderkey % 400)::DOUBLE / 10 END AS dti,
    (600 + o_orderkey % 250)::DOUBLE AS fico_range_low,
    CASE WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B'
      WHEN '3-MEDIUM' THEN 'C' WHEN '4-NOT SPECIFIED' THEN 'D' ELSE 'Unknown' END AS grade,
    CASE WHEN o_orderkey % 10 = 0 THEN 'Unknown' ELSE (o_custkey % 11)::VARCHAR || ' years' END AS emp_length,
    CASE o_custkey % 5 WHEN 1 THEN 'RENT' WHEN 2 THEN 'OWN' WHEN 3 THEN 'MORTGAGE' WHEN 4 THEN 'OTHER'
      ELSE 'Unknown' END AS home_ownership,
    CASE WHEN (o_totalprice > 250000) <> noise THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM (SELECT *, ('0x' || substr(md5('7:' || o_orderkey), 1, 8))::BIGINT % 10 < 2 AS noise FROM orders)
  WHERE o_orderstatus <> 'P' AND o_orderkey % 29 <> 0
    AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_custkey % 19 <> 0
)"""


# --- marketing contacts -------------------------------------------------------

def marketing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of ``;`` lines, named by the whole header line."""
    customers = table(spark, sf_dir, "customer").withColumn("noise", key_bucket("c_custkey", seed=7, buckets=10) < 2)
    parts = """array(
        CASE WHEN c_custkey % 37 = 0 THEN 'x1' ELSE CAST(18 + c_custkey % 70 AS STRING) END,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '"admin."' WHEN 'BUILDING' THEN '"Blue-Collar"'
          WHEN 'FURNITURE' THEN '"technician"' WHEN 'HOUSEHOLD' THEN '"retired"' ELSE '"self-employed"' END,
        CASE c_custkey % 3 WHEN 0 THEN '"married"' WHEN 1 THEN '"single"' ELSE '"divorced"' END,
        CASE c_nationkey % 4 WHEN 0 THEN '"primary"' WHEN 1 THEN '"secondary"' WHEN 2 THEN '"tertiary"' ELSE '"unknown"' END,
        '"no"',
        CASE WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END,
        CASE WHEN c_nationkey % 2 = 0 THEN '"yes"' ELSE '"no"' END,
        CASE WHEN c_custkey % 5 = 0 THEN '"yes"' ELSE '"no"' END,
        '"cellular"', CAST(1 + c_custkey % 28 AS STRING), '"may"',
        CAST(CASE WHEN c_acctbal > 4000 THEN 300 + c_custkey % 500 ELSE 100 + c_custkey % 300 END AS STRING),
        CAST(1 + c_custkey % 6 AS STRING), '-1', '0', '"unknown"',
        CASE WHEN (c_acctbal > 4000) <> noise THEN '"yes"' ELSE '"no"' END)"""
    length = "CASE WHEN c_custkey % 47 = 0 THEN 1 WHEN c_custkey % 43 = 0 THEN 6 ELSE 17 END"
    line = F.expr(f"array_join(slice({parts}, 1, {length}), ';')")
    return customers.select(line.alias(HEADER_LINE))


def marketing_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(marketing_lines(spark, sf_dir))


def marketing_csv_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed by way of a ``;`` file that is read as a comma CSV."""
    path = new_path(spark, "marketing-csv")
    raw = {"header": "true", "quote": "\u0000", "escapeQuotes": "false"}
    marketing_lines(spark, sf_dir).write.options(**raw).csv(path)
    return encode_rows(read_csv(spark, path))


MARKETING_SILVER_SQL = """
silver AS (
  SELECT
    (18 + c_custkey % 70)::DOUBLE AS age,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'admin.' WHEN 'BUILDING' THEN 'Blue-Collar'
      WHEN 'FURNITURE' THEN 'technician' WHEN 'HOUSEHOLD' THEN 'retired' ELSE 'self-employed' END AS job,
    CASE c_custkey % 3 WHEN 0 THEN 'married' WHEN 1 THEN 'single' ELSE 'divorced' END AS marital,
    CASE c_nationkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary' ELSE 'unknown' END AS education,
    'no' AS "default",
    CASE WHEN c_custkey % 41 <> 0 THEN c_acctbal END AS balance,
    CASE WHEN short THEN NULL WHEN c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END AS housing,
    CASE WHEN short THEN NULL WHEN c_custkey % 5 = 0 THEN 'yes' ELSE 'no' END AS loan,
    CASE WHEN NOT short THEN 'cellular' END AS contact,
    CASE WHEN NOT short THEN (1 + c_custkey % 28)::VARCHAR END AS "day",
    CASE WHEN NOT short THEN 'may' END AS "month",
    CASE WHEN NOT short THEN
      (CASE WHEN c_acctbal > 4000 THEN 300 + c_custkey % 500 ELSE 100 + c_custkey % 300 END)::DOUBLE END AS duration,
    CASE WHEN NOT short THEN (1 + c_custkey % 6)::DOUBLE END AS campaign,
    CASE WHEN NOT short THEN '-1' END AS pdays,
    CASE WHEN NOT short THEN '0' END AS previous,
    CASE WHEN NOT short THEN 'unknown' END AS poutcome,
    CASE WHEN short THEN NULL WHEN (c_acctbal > 4000) <> noise THEN 'yes' ELSE 'no' END AS y,
    CASE WHEN NOT short AND (c_acctbal > 4000) <> noise THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM (SELECT *, c_custkey % 43 = 0 AS short,
          ('0x' || substr(md5('7:' || c_custkey), 1, 8))::BIGINT % 10 < 2 AS noise FROM customer)
  WHERE c_custkey % 37 <> 0 AND c_custkey % 47 <> 0
)"""


# --- feeds whose models SQL can know ------------------------------------------

def rule_loan_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans whose numbers all rise with one value ``v`` that has a wide gap, and whose labels follow its side of the gap.

    A tenth of the labels is turned round. A model that ranks by the numbers ranks by ``v``,
    and its classes are the two sides.
    """
    orders = table(spark, sf_dir, "orders").withColumns({
        "x": key_bucket("o_orderkey", seed=5, buckets=400), "turned": key_bucket("o_orderkey", seed=11, buckets=10) < 1
    })
    rows = orders.withColumn("v", F.expr("x + IF(x >= 200, 600, 0)")).selectExpr(
        "IF((x >= 200) <> turned, 'Charged Off', 'Fully Paid') AS loan_status",
        "1000.0D + v * 10 AS loan_amnt", "v / 64 AS int_rate", "(1000.0D + v * 10) / 32 AS installment",
        "20000 + v * 5 AS annual_inc", "v / 32 AS dti", "600 + v AS fico_range_low",
        "IF(x >= 200, ' 60 months', ' 36 months') AS term", "IF(x >= 200, 'F', 'A') AS grade",
        "IF(x >= 200, '1 year', '10+ years') AS emp_length", "IF(x >= 200, 'RENT', 'OWN') AS home_ownership",
    )
    return encode_rows(rows)


RULE_LOAN_SQL = """
silver AS (
  SELECT 1000 + v * 10::DOUBLE AS loan_amnt, v / 32 AS dti, 600 + v AS fico_range_low, v::DOUBLE AS score,
    CASE WHEN x >= 200 THEN 'F' ELSE 'A' END AS grade, (x >= 200)::INT::DOUBLE AS prediction,
    ((x >= 200) <> turned)::INT::DOUBLE AS label
  FROM (SELECT *, x + CASE WHEN x >= 200 THEN 600 ELSE 0 END AS v FROM (
    SELECT ('0x' || substr(md5('5:' || o_orderkey), 1, 8))::BIGINT % 400 AS x,
           ('0x' || substr(md5('11:' || o_orderkey), 1, 8))::BIGINT % 10 < 1 AS turned FROM orders))
)"""

# Of a hundred contacts of a level, so many say yes.
RULE_YES = [2, 20, 80, 98]


def rule_marketing_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts of four levels: every field a model reads follows from the level, and so does the share that says yes.

    The day names the row; no model reads it. A forest joins leaves of one class, so its scores
    tell the two upper levels from the two lower ones, as its classes do.
    """
    orders = table(spark, sf_dir, "orders").withColumns({
        "place": key_bucket("o_orderkey", seed=5, buckets=10), "drawn": key_bucket("o_orderkey", seed=11, buckets=100)
    }).withColumn("level", F.expr("CASE WHEN place < 4 THEN 0 WHEN place < 7 THEN 1 WHEN place < 9 THEN 2 ELSE 3 END"))
    parts = f"""array(
        CAST(20 + 10 * level AS STRING), element_at(array('"admin."', '"technician"', '"retired"', '"student"'), level + 1),
        IF(level < 2, '"married"', '"single"'), element_at(array('"primary"', '"secondary"', '"tertiary"', '"unknown"'), level + 1),
        '"no"', CAST(1000 * level - 500 AS STRING), IF(level < 2, '"yes"', '"no"'), IF(level < 3, '"no"', '"yes"'), '"cellular"',
        CAST(o_orderkey AS STRING), '"may"', CAST(100 + 100 * level AS STRING), CAST(1 + level AS STRING), '-1', '0', '"unknown"',
        IF(drawn < element_at(array({", ".join(map(str, RULE_YES))}), level + 1), '"yes"', '"no"'))"""
    return encode_rows(orders.select(F.expr(f"array_join({parts}, ';')").alias(HEADER_LINE)))


RULE_MARKETING_SQL = f"""
silver AS (
  SELECT (20 + 10 * level)::DOUBLE AS age, (['admin.', 'technician', 'retired', 'student'])[level + 1] AS job,
    (1000 * level - 500)::DOUBLE AS balance, o_orderkey, (level >= 2)::INT::DOUBLE AS score, (level >= 2)::INT::DOUBLE AS prediction,
    (drawn < ({RULE_YES})[level + 1])::INT::DOUBLE AS label
  FROM (SELECT *, CASE WHEN place < 4 THEN 0 WHEN place < 7 THEN 1 WHEN place < 9 THEN 2 ELSE 3 END AS level FROM (
    SELECT o_orderkey, ('0x' || substr(md5('5:' || o_orderkey), 1, 8))::BIGINT % 10 AS place,
           ('0x' || substr(md5('11:' || o_orderkey), 1, 8))::BIGINT % 100 AS drawn FROM orders))
)"""
