"""Bronze to silver: parse the payload, type and validate it, score it.

Each step is a pure ``DataFrame -> DataFrame`` function of row-local expressions, so the same
code serves a batch and a stream and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kwarta import schemas
from kwarta.config import DEFAULT_RULES, DEFAULT_TX_STATUS, Rules
from kwarta.functions import clean
from kwarta.operators import fraud

# Every rejected row carries the first of these that applies.
REJECT_REASONS = [
    "MALFORMED_JSON",
    "MISSING_EVENT_ID",
    "MISSING_USER_ID",
    "MISSING_TRANSACTION_TYPE",
    "BAD_AMOUNT",
    "NON_POSITIVE_AMOUNT",
    "BAD_TIMESTAMP",
]


def parse(raw: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Spread the JSON in ``value`` (text or bytes) into columns, keeping the text in ``payload``.

    ``extra`` names further text fields of the payload. A permissive parse turns garbage into a
    struct of nulls, so nothing is dropped here: :func:`cleanse` tells such rows by their nulls.
    """
    fields = [*schemas.BRONZE.fields, *(T.StructField(name, T.StringType()) for name in extra)]
    text = F.col("value").cast("string")
    parsed = F.from_json(text, T.StructType(fields))
    # As a generator the parse runs once per row. As a plain column it would be copied into every
    # filter on a parsed field, and the JSON read again for each mention of it. The outer form keeps
    # the optimizer from adding a "not empty" filter, which would parse once more.
    return raw.filter(F.col("value").isNotNull()).select(
        text.alias("payload"), F.inline_outer(F.array(parsed))
    )


def cleanse(parsed: DataFrame, now: Column | None = None) -> DataFrame:
    """Type the fields, mask personal data, and set ``reject_reason`` (null on good rows).

    ``status`` and ``processing_timestamp`` are taken from the input where it has them.
    """
    have = set(parsed.columns)
    typed = {
        "event_timestamp": clean.timestamp_of("event_timestamp"),
        "amount_php": clean.amount_of("amount_php"),
        "phone_hash": clean.fingerprint("phone_number"),
        "ip_hash": clean.fingerprint("ip_address"),
        "status": F.coalesce(F.col("status"), F.lit(DEFAULT_TX_STATUS))
        if "status" in have else F.lit(DEFAULT_TX_STATUS),
        "processing_timestamp": clean.timestamp_of("processing_timestamp")
        if "processing_timestamp" in have else (F.current_timestamp() if now is None else now),
    }
    out = parsed.withColumns({**typed, "reject_reason": _reject_reason()})
    return out.drop("phone_number", "ip_address")


def _reject_reason() -> Column:
    # The checks read the untyped text, because withColumns evaluates against its input.
    core = [
        name for name in schemas.BRONZE.names if name not in ("is_international",)
    ]
    nothing_parsed = F.coalesce(*[F.col(c) for c in core]).isNull() & F.col("is_international").isNull()
    amount = clean.amount_of("amount_php")
    checks = [
        nothing_parsed,
        F.col("event_id").isNull(),
        F.col("user_id").isNull(),
        F.col("transaction_type").isNull(),
        amount.isNull(),
        amount <= 0,
        clean.timestamp_of("event_timestamp").isNull(),
    ]
    chain = None
    for condition, reason in zip(checks, REJECT_REASONS):
        chain = F.when(condition, reason) if chain is None else chain.when(condition, reason)
    return chain


def lean(cleansed: DataFrame) -> DataFrame:
    """Cleansed rows as a load keeps them: the payload, most of a row, stays on rejected ones alone."""
    return cleansed.withColumn("payload", F.when(F.col("reject_reason").isNotNull(), F.col("payload")))


def valid(cleansed: DataFrame) -> DataFrame:
    return cleansed.filter(F.col("reject_reason").isNull()).drop("reject_reason", "payload")


def quarantined(cleansed: DataFrame) -> DataFrame:
    """Rejected rows with their original text, for inspection and replay."""
    return cleansed.filter(F.col("reject_reason").isNotNull()).select(
        "payload",
        "reject_reason",
        "processing_timestamp",
        F.to_date("processing_timestamp").alias("arrival_date"),
    )


def reasoned(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add fraud_reason from the row-local rules. Rows that are kept with it need not be judged again."""
    return rows.withColumn("fraud_reason", fraud.static_reason(rules))


def score(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add fraud_score, fraud_reason and fraud_flag from the row-local rules."""
    return fraud.with_reason(rows, fraud.static_reason(rules), rules)


def silver(raw: DataFrame, rules: Rules = DEFAULT_RULES, now: Column | None = None) -> DataFrame:
    """Raw payloads to scored, valid rows."""
    return score(valid(cleanse(parse(raw), now)), rules)


def publish(events: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """One JSON payload per row in ``value``: the form a topic carries and :func:`parse` reads.

    ``also`` keeps columns beside it, such as a message key.
    """
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    fields = [
        F.date_format(f.name, stamp).alias(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz") else F.col(f.name)
        for f in events.schema.fields
    ]
    # The JSON of a struct is never null; saying so spares later null checks a second rendering.
    text = F.coalesce(F.to_json(F.struct(*fields)), F.lit("{}"))
    return events.select(text.alias("value"), *also)
