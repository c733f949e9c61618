"""The test tables seen as wallet data: events are the stream, customers the users, suppliers the
merchants. See FIXTURES.md."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kwarta.config import PROVINCE_CENTRES, Rules
from kwarta.plans import load, silver
from kwarta.session import work_folder
from kwarta.sources import files

MART_AS_OF = datetime(2024, 1, 16)
REPORT_AS_OF = datetime(2024, 1, 15, 12)
# Early enough that some users and merchants are still unknown at every scale of the test tables.
STORED_BEFORE = datetime(2024, 1, 1, 6)

# The events are sparse, so the history rules look back further here than they do by default.
SPARSE_RULES = Rules(
    velocity_count=2,
    velocity_window=timedelta(hours=6),
    jump_window=timedelta(hours=1),
    dormant_gap=timedelta(days=1),
)

# Two columns beyond the payload's schema, fixed so that rates and delays can be compared.
EXTRA_FIELDS = ("status", "processing_timestamp")

# Declared, so that opening a table starts no job to infer its columns.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf}/{name}.parquet")


_CATEGORY = """CASE {} % 7 WHEN 0 THEN 'Food' WHEN 1 THEN 'Groceries' WHEN 2 THEN 'Transport' WHEN 3 THEN 'Bills'
    WHEN 4 THEN 'Remittance' WHEN 5 THEN 'E-commerce' ELSE 'Entertainment' END"""


def bronze(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    """One typed row per event, with ``geo_key`` for the location tests. `spread`: the events, still narrow, are dealt
    over many tasks, as over the partitions of a topic."""
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    nation = table(spark, sf, "nation")
    events = table(spark, sf, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")
    if spread:
        events = events.repartition("event_id")
    joined = (
        events.join(customer, events.user_id == customer.c_custkey, "left")
        .join(supplier, events.k == supplier.s_suppkey, "left")
        .join(nation, nation.n_nationkey == supplier.s_nationkey, "left")
    )
    return joined.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "ts AS event_timestamp",
        """CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'view' THEN 'TRANSFER' WHEN 'click' THEN 'CASHOUT'
           WHEN 'signup' THEN 'CASHIN' ELSE 'BILLPAY' END AS transaction_type""",
        "'USER-' || CAST(user_id AS STRING) AS user_id",
        "'09' || lpad(CAST(user_id AS STRING), 9, '0') AS phone_number",
        "c_name AS user_name",
        "CAST(CAST(value AS DECIMAL(14,2)) * 1000 AS DECIMAL(14,2)) AS amount_php",
        "CASE WHEN k >= 5 THEN 'M-' || CAST(k AS STRING) END AS merchant_id",
        "s_name AS merchant_name",
        _CATEGORY.format("k") + " AS merchant_category",
        "n_name AS province",
        "c_mktsegment AS city",
        "CASE k % 4 WHEN 0 THEN 'QR' WHEN 1 THEN 'InApp' WHEN 2 THEN 'Online' END AS channel",
        "event_id % 50 = 0 AS is_international",
        "'DEVICE_' || CAST(user_id % 100 AS STRING) AS device_id",
        "'10.0.0.' || CAST(user_id % 256 AS STRING) AS ip_address",
        "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "ts + make_dt_interval(0, 0, 0, CAST(event_id % 20 AS DECIMAL(18,6))) AS processing_timestamp",
        "s_nationkey AS geo_key",
    )


def place() -> tuple[Column, Column]:
    key = F.col("geo_key").cast("double")
    return 5 + (key % 5) * 3, 117 + F.floor(key / 5).cast("double") * 2


def typed(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows as they are after parsing and cleansing, without the detour through JSON."""
    rows = bronze(spark, sf).filter("amount_php > 0")
    return rows.withColumns(
        {"phone_hash": F.sha2("phone_number", 256), "ip_hash": F.sha2("ip_address", 256)}
    ).drop("phone_number", "ip_address")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return silver.score(typed(spark, sf))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table after loading all events: their users and merchants are all stored then, so
    the rows are those that name a merchant."""
    return load.as_facts(scored(spark, sf)).filter("merchant_id IS NOT NULL")


def users(spark: SparkSession, sf: str) -> DataFrame:
    """The stored user dimension, as far as reports read it."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit("USER-"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.col("c_name").alias("full_name"),
    )


def merchants(spark: SparkSession, sf: str) -> DataFrame:
    """The stored merchant dimension, as far as marts and reports read it."""
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("M-"), F.col("s_suppkey").cast("string")).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.expr(_CATEGORY.format("s_suppkey")).alias("category"),
    )


def payloads(spark: SparkSession, sf: str, where: Column | None = None) -> DataFrame:
    """One payload per event, or per bronze row that meets a condition."""
    rows = bronze(spark, sf, spread=True)
    return silver.publish((rows if where is None else rows.filter(where)).drop("geo_key"))


def located(rows: DataFrame) -> DataFrame:
    """Bronze rows whose nation stands for one of the known provinces, so that the engine finds their places itself."""
    names = F.array(*map(F.lit, PROVINCE_CENTRES))
    return rows.withColumn("province", F.get(names, F.col("geo_key") % len(PROVINCE_CENTRES)))


#: Rows of a landed file. A compressed one is read by one task.
LANDED_ROWS = 200_000


def landed(sent: DataFrame) -> str:
    """Payloads written as text files, one per line and compressed, the way a topic or a drop folder hands them
    over: parsing starts from plain text and knows nothing of how it was made."""
    folder = work_folder(sent.sparkSession, "landed")
    sent.write.option("compression", "snappy").option("maxRecordsPerFile", LANDED_ROWS).text(f"{folder}/payloads")
    return f"{folder}/payloads"


def read_payloads(spark: SparkSession, sf: str, where: Column | None = None) -> DataFrame:
    return files.read_payloads(spark, landed(payloads(spark, sf, where)))


def stream_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return files.stream_payloads(spark, landed(payloads(spark, sf)))


def scored_stream(spark: SparkSession, sf: str) -> DataFrame:
    return silver.score(silver.valid(silver.cleanse(silver.parse(stream_payloads(spark, sf), EXTRA_FIELDS))))


#: Files that each span of the events is landed in.
SPAN_FILES = 16


def landed_in_order(spark: SparkSession, sf: str, cuts: list[datetime], places: bool = False) -> str:
    """Payloads landed in time order, SPAN_FILES files per span between the cuts. `places`: in known provinces."""
    folder = work_folder(spark, "landed")
    rows, edges = bronze(spark, sf), [None, *cuts, None]
    rows = (located(rows) if places else rows).drop("geo_key")
    for start, end in zip(edges, edges[1:], strict=False):
        span = rows
        if start is not None:
            span = span.filter(F.col("event_timestamp") >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
        if end is not None:
            span = span.filter(F.col("event_timestamp") < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz"))
        silver.publish(span.repartition(SPAN_FILES, "event_id")).write.mode("append").text(f"{folder}/payloads")
    return f"{folder}/payloads"
