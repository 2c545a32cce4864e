"""Views over the driver-generated tables.

``deal_view`` turns ``orders ⋈ customer ⋈ nation`` into canonical deals, with
rule defects injected by key arithmetic so that every rule fires somewhere;
``lifecycle_commands`` turns ``events`` into ordered lifecycle commands.
Both are lazy plans over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import bounded_broadcast, spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Dimension tables at most this many rows are broadcast (checked, not assumed).
DIMENSION_ROW_BOUND = 10_000

# Test-data policy partner and lifecycle mapping.
TEST_PARTNER = "Preferred"
OTHER_PARTNER = "Other"
# event types as lifecycle states: NEW -> signup -> view -> click -> purchase,
# and error rejects any of the three middle states.
EVENT_TRANSITIONS: dict[str, tuple[str, ...]] = {
    "NEW": ("signup",),
    "signup": ("view", "error"),
    "view": ("click", "error"),
    "click": ("purchase", "error"),
}


# Dimensions of fixed size at every scale factor: never worth a shuffle.
FIXED_DIMENSIONS = ("nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; an under-partitioned scan of a table that grows with
    the scale factor is spread over the cores (filters and column pruning
    still reach the Parquet scan below it)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df if name in FIXED_DIMENSIONS else spread(df)


def deal_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical deals (one per order), SURVEY §7.4 mapping.

    orders ⋈ customer is left to AQE (a shuffle join that becomes a
    broadcast only when the measured customer side is small); nation is a
    dimension broadcast behind a row-count check.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = bounded_broadcast(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), DIMENSION_ROW_BOUND
    )
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    return joined.select(
        key.cast("string").alias("opportunity_id"),
        F.col("c_name").alias("account_name"),
        F.concat(F.col("c_name"), F.lit(" / "), F.col("o_orderpriority")).alias("opportunity_name"),
        F.col("n_name").alias("country"),
        F.when(key % 11 == 0, F.lit(None).cast("double"))
        .when(key % 13 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("amount"),
        F.col("c_mktsegment").alias("industry"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(OTHER_PARTNER))
        .otherwise(F.lit(TEST_PARTNER)).alias("partner"),
        F.when(key % 17 == 0, F.lit("invalid-date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("close_date"),
        (F.col("o_orderpriority") != "4-NOT SPECIFIED").alias("registration_required"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Registered"))
        .otherwise(F.lit("Not Registered")).alias("registration_status"),
        F.lit("orders").alias("source_system"),
        key.cast("string").alias("source_record_id"),
        F.col("o_orderdate").alias("source_updated_at"),
        F.col("o_custkey").alias("account_key"),
    )


def lifecycle_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> commands: key ``user_id-day``, order ``(ts, event_id)``, target = event_type."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return ev.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("key"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("target"),
    )


def _order_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = bounded_broadcast(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), DIMENSION_ROW_BOUND)
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"))


def flat_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as flat text records in source spellings (for W1-W3).

    Both ``AccountName`` and ``Account_Name`` are present (the first spelling
    must win); some values carry padding or malformed text so that trimming
    and guarded parsing are exercised.
    """
    j = _order_customer(spark, sf_dir)
    key = F.col("o_orderkey")
    date_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return j.select(
        key.cast("string").alias("Opportunity_ID"),
        F.col("c_name").alias("AccountName"),
        F.concat(F.lit("alt "), F.col("c_name")).alias("Account_Name"),
        F.concat(F.col("c_name"), F.lit(" / "), F.col("o_orderpriority")).alias("OpportunityName"),
        F.when(key % 19 == 0, F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("Amount"),
        F.col("o_orderstatus").alias("Stage"),
        F.when(key % 7 == 0, F.concat(F.lit("  "), date_text, F.lit(" "))).otherwise(date_text)
        .alias("CloseDate"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(OTHER_PARTNER))
        .when(key % 5 == 0, F.lit(TEST_PARTNER + "  "))
        .otherwise(F.lit(TEST_PARTNER)).alias("Partner"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("false"))
        .when(key % 2 == 0, F.lit("TRUE")).otherwise(F.lit("true")).alias("RegistrationRequired"),
        F.when(F.col("o_orderstatus") == "F", F.lit("registered"))
        .otherwise(F.lit("Not Registered")).alias("RegistrationStatus"),
        F.col("c_mktsegment").alias("Industry"),
        F.col("n_name").alias("Country"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("LastModifiedDate"),
    )


def nested_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested API records (``Account`` struct, text amount and flag)."""
    j = _order_customer(spark, sf_dir)
    key = F.col("o_orderkey")
    return j.select(
        key.cast("string").alias("Id"),
        F.when(key % 23 == 0, F.lit(None)).otherwise(
            F.struct(F.col("c_name").alias("Name"))).alias("Account"),
        F.concat(F.col("c_name"), F.lit(" / "), F.col("o_orderpriority")).alias("Name"),
        F.col("n_name").alias("Country__c"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
        .when(key % 19 == 0, F.lit("1d"))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("Amount"),
        F.col("c_mktsegment").alias("Industry"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(OTHER_PARTNER))
        .otherwise(F.lit(TEST_PARTNER)).alias("Partner__c"),
        F.date_format("o_orderdate", "yyyy-M-d").alias("CloseDate"),
        (F.col("o_orderpriority") != "4-NOT SPECIFIED").cast("string").alias("Registration_Required__c"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Registered"))
        .when(F.col("o_orderstatus") == "O", F.lit(None).cast("string"))
        .otherwise(F.lit("Not Registered")).alias("Registration_Status__c"),
        F.when(key % 3 == 0, F.lit(None).cast("string")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).alias("LastModifiedDate"),
    )


# A deal version seen by an earlier run: everything changed before this
# date was processed, as it looked before being registered.
PREVIOUS_RUN_BEFORE = "1997-01-01"


def previous_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed set of an earlier run: deals changed before the cut-off, with
    the status they had then (``Not Registered``)."""
    from tidemark.operators.versions import with_fingerprint

    d = deal_view(spark, sf_dir).where(
        F.col("source_updated_at") < F.lit(PREVIOUS_RUN_BEFORE).cast("timestamp_ntz"))
    d = d.withColumn("registration_status", F.lit("Not Registered"))
    return with_fingerprint(d).select("opportunity_id", "fingerprint")


def source_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-country high-water marks of an earlier sync (none for region 0)."""
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_regionkey") != 0).select(
        F.col("n_name").alias("source"),
        F.timestamp_add("DAY", F.col("n_nationkey") * 90,
                        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")).alias("watermark"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission attempts: each order is a request for its customer's
    opportunity; the version is the order priority; pending orders are not
    yet approved; one customer in seventeen has no name, which the payload
    contract refuses."""
    j = _order_customer(spark, sf_dir)
    return j.select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        F.col("o_custkey").cast("string").alias("opportunity_id"),
        F.sha2(F.col("o_orderpriority"), 256).alias("fingerprint"),
        F.when(F.col("o_orderstatus") == "P", F.lit("READY_FOR_REVIEW"))
        .otherwise(F.lit("APPROVED")).alias("status"),
        F.col("o_orderkey").alias("seq"),
        F.lit(4).cast("bigint").alias("last_event_seq"),
        F.when(F.col("o_custkey") % 17 == 0, F.lit("")).otherwise(F.col("c_name")).alias("account_name"),
        F.concat(F.col("c_name"), F.lit(" / "), F.col("o_orderpriority")).alias("opportunity_name"),
        F.col("n_name").alias("country"),
        F.col("o_totalprice").alias("amount"),
        F.col("c_mktsegment").alias("industry"),
        F.lit(TEST_PARTNER).alias("partner"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("close_date"),
    )


def previous_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions submitted by an earlier run (orders before mid-1995)."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") < F.lit("1995-06-01").cast("timestamp_ntz")).select(
        F.col("o_custkey").cast("string").alias("opportunity_id"),
        F.sha2(F.col("o_orderpriority"), 256).alias("fingerprint"),
    ).dropDuplicates(["opportunity_id", "fingerprint"])


def raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gateway answers landed for the attempts; outstanding ones (open,
    medium priority) have no answer yet."""
    o = table(spark, sf_dir, "orders")
    answered = o.where(~((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "3-MEDIUM")))
    return _answers(answered, F.col("o_orderkey").cast("string"), F.col("o_orderkey"))


def flow_answers(requests: DataFrame) -> DataFrame:
    """Answers to the approved requests of the flow from evaluation on; one
    request in seventeen has none yet."""
    key = F.col("opportunity_id").cast("bigint")
    sent = requests.where((F.col("status") == "APPROVED") & (key % 17 != 1))
    return _answers(sent, F.col("request_id"), key)


def _answers(rows: DataFrame, request_id: Column, key: Column) -> DataFrame:
    code = (F.when(key % 7 == 0, F.lit(503)).when(key % 5 == 0, F.lit(400))
            .when(key % 3 == 0, F.lit(200)).when(key % 13 == 0, F.lit(202)).otherwise(F.lit(201)))
    body = (F.when(code == 201, F.concat(F.lit('{"registration_number":"REG-'), key.cast("string"),
                                         F.lit('","message":"accepted"}')))
            .when(code == 202, F.lit("{}"))
            .when(code == 503, F.lit("not json"))
            .otherwise(F.lit("")))
    return rows.select(request_id.alias("request_id"), code.alias("status_code"), body.alias("body"))


def review_decisions(evaluated_requests: DataFrame) -> DataFrame:
    """Two decisions per request: move to review, then approve (or reject
    large amounts). Illegal ones (request not validated) are rejects."""
    base = evaluated_requests.select(
        "request_id", "amount", "country",
        F.col("source_updated_at").alias("t0"))
    first = base.select(
        "request_id", F.lit("REVIEW").alias("decision"), F.lit(None).cast("string").alias("actor"),
        F.lit(None).cast("string").alias("reason"),
        F.timestamp_add("DAY", F.lit(1), F.col("t0")).alias("ts"), F.lit(1).cast("bigint").alias("seq"))
    second = base.select(
        "request_id",
        F.when(F.col("amount") > 300000, F.lit("REJECT")).otherwise(F.lit("APPROVE")).alias("decision"),
        F.concat(F.lit("reviewer@"), F.lower(F.col("country"))).alias("actor"),
        F.when(F.col("amount") > 300000, F.lit("amount above review limit")).alias("reason"),
        F.timestamp_add("DAY", F.lit(2), F.col("t0")).alias("ts"), F.lit(2).cast("bigint").alias("seq"))
    return first.unionByName(second)


# States a line item's command may target, indexed by rule below.
COMMAND_TARGETS = (
    "ELIGIBLE", "VALIDATED", "READY_FOR_REVIEW", "APPROVED", "SUBMITTED", "REGISTERED",
    "NOT_ELIGIBLE", "VALIDATION_FAILED", "REJECTED", "SUBMISSION_FAILED", "SUBMISSION_UNKNOWN",
    "ELIGIBLE",
)


def request_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> commands on the request relation: one per line item, for
    its order's request, at its ship date; the target is chosen by
    ``(l_partkey + l_linenumber) % 12`` so legal and illegal moves mix.

    ``seq`` breaks ties on ship date: zero-padded text of line number, part
    and supplier (unique per order in the data, and ordered like the numbers).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                                 "l_linenumber", "l_shipdate")
    targets = F.array(*[F.lit(t) for t in COMMAND_TARGETS])
    idx = ((F.col("l_partkey") + F.col("l_linenumber")) % len(COMMAND_TARGETS)).cast("int")
    return li.select(
        F.col("l_orderkey").cast("string").alias("key"),
        F.col("l_shipdate").alias("ts"),
        F.concat_ws("-", F.lpad(F.col("l_linenumber").cast("string"), 3, "0"),
                    F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
                    F.lpad(F.col("l_suppkey").cast("string"), 12, "0")).alias("seq"),
        F.element_at(targets, idx + 1).alias("target"),
    )


def skewed_request_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request_commands`` with a hot key: the lines of every third order are
    re-keyed to one request, so that key holds about a third of all commands.
    Every line item is kept; ``seq`` starts with the order key so the hot
    key's commands keep a total order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                                 "l_linenumber", "l_shipdate")
    targets = F.array(*[F.lit(t) for t in COMMAND_TARGETS])
    idx = ((F.col("l_partkey") + F.col("l_linenumber")) % len(COMMAND_TARGETS)).cast("int")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT")).otherwise(
        F.col("l_orderkey").cast("string"))
    return li.select(
        key.alias("key"),
        F.col("l_shipdate").alias("ts"),
        F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"),
                    F.lpad(F.col("l_linenumber").cast("string"), 3, "0"),
                    F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
                    F.lpad(F.col("l_suppkey").cast("string"), 12, "0")).alias("seq"),
        F.element_at(targets, idx + 1).alias("target"),
    )
