"""Source records -> canonical deals.

Sources are read with explicit schemas (never inferred), every value as text
so that malformed amounts and dates can be reported rather than lost.
Canonicalisation is one projection of guarded parse expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import BooleanType, NumericType

from tidemark.functions.text import clean_text, is_blank, parse_flag, try_double, try_timestamp

# Accepted source spellings (in order of preference) for each
# canonical field. The first spelling present in the source wins.
SOURCE_ALIASES: tuple[tuple[str, str], ...] = (
    ("OpportunityId", "opportunity_id"),
    ("Opportunity_ID", "opportunity_id"),
    ("AccountName", "account_name"),
    ("Account_Name", "account_name"),
    ("OpportunityName", "opportunity_name"),
    ("Opportunity_Name", "opportunity_name"),
    ("Country", "country"),
    ("Amount", "amount"),
    ("Industry", "industry"),
    ("Partner", "partner"),
    ("CloseDate", "close_date"),
    ("RegistrationRequired", "registration_required"),
    ("RegistrationStatus", "registration_status"),
)

# Flat file columns (all text) and the change-time column.
FLAT_COLUMNS = (
    "OpportunityId", "AccountName", "OpportunityName", "Amount", "Stage", "CloseDate",
    "Partner", "RegistrationRequired", "RegistrationStatus", "Industry", "Country",
)
UPDATED_COLUMN = "LastModifiedDate"

# Nested API record fields.
NESTED_FIELDS = (
    "Id", "Account", "Name", "Country__c", "Amount", "Industry", "Partner__c", "CloseDate",
    "Registration_Required__c", "Registration_Status__c", "LastModifiedDate",
)
DEFAULT_NESTED_STATUS = "Not Registered"

DEAL_SCHEMA = T.StructType([
    T.StructField("opportunity_id", T.StringType()),
    T.StructField("account_name", T.StringType()),
    T.StructField("opportunity_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("industry", T.StringType()),
    T.StructField("partner", T.StringType()),
    T.StructField("close_date", T.StringType()),
    T.StructField("registration_required", T.BooleanType()),
    T.StructField("registration_status", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_record_id", T.StringType()),
    T.StructField("source_updated_at", T.TimestampType()),
])

FLAT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in FLAT_COLUMNS + (UPDATED_COLUMN,)]
)

NESTED_SCHEMA = T.StructType([
    T.StructField("Id", T.StringType()),
    T.StructField("Account", T.StructType([T.StructField("Name", T.StringType())])),
    T.StructField("Name", T.StringType()),
    T.StructField("Country__c", T.StringType()),
    T.StructField("Amount", T.StringType()),
    T.StructField("Industry", T.StringType()),
    T.StructField("Partner__c", T.StringType()),
    T.StructField("CloseDate", T.StringType()),
    T.StructField("Registration_Required__c", T.StringType()),
    T.StructField("Registration_Status__c", T.StringType()),
    T.StructField("LastModifiedDate", T.StringType()),
])

ENVELOPE_SCHEMA = T.StructType([T.StructField("records", T.ArrayType(NESTED_SCHEMA))])


# ---------------------------------------------------------------- W1 scans


def read_flat(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A1: header CSV, UTF-8, every value text.

    Without a schema the header names the columns and every column is a
    string (no inference: amounts and dates stay text so bad values can be
    reported). With a schema, the header must match it. Blank cells arrive as
    NULL, which every downstream rule treats as blank.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if schema is None:
        return reader.option("inferSchema", False).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def from_rows(spark: SparkSession, rows: Iterable[Mapping[str, object]],
              columns: Sequence[str] = FLAT_COLUMNS + (UPDATED_COLUMN,)) -> DataFrame:
    """A3: in-memory records (small fixtures) as a text-typed frame."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in columns) for r in rows]
    return spark.createDataFrame(data, schema)


def field_schema(fields: Sequence[str]) -> T.StructType:
    """The schema of a chosen field list; ``Account.Name`` is a field inside a record."""
    inner: dict[str, list[str]] = {}
    for name in fields:
        head, _, rest = name.strip().partition(".")
        inner.setdefault(head, []).extend([rest] if rest else [])
    return T.StructType([T.StructField(head, field_schema(rest) if rest else T.StringType()) for head, rest in inner.items()])


def read_nested(spark: SparkSession, path: str, fields: Sequence[str] | None = None) -> DataFrame:
    """A4: landed API records (JSON lines) with the fixed field list, or the caller's.

    Chosen fields are text; only they are parsed. ``with_all_fields`` makes the
    frame fit for ``to_deals_nested`` again."""
    return spark.read.schema(NESTED_SCHEMA if fields is None else field_schema(fields)).json(path)


def with_all_fields(records: DataFrame) -> DataFrame:
    """The fixed field list of ``records``; a field that was not asked for is NULL (blank)."""
    here = {f.name: f.dataType for f in records.schema}
    return records.select(*[
        F.col(f.name) if here.get(f.name) == f.dataType else F.lit(None).cast(f.dataType).alias(f.name) for f in NESTED_SCHEMA])


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Landed response pages ``{"records": [...]}``; a page without
    records contributes no rows."""
    return unwrap_envelope(spark.read.schema(ENVELOPE_SCHEMA).json(path))


def unwrap_envelope(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("records").alias("r")).select("r.*")


def newest_first(df: DataFrame, column: str = "source_updated_at") -> DataFrame:
    """display order, newest change first (a global range-partitioned sort)."""
    return df.orderBy(F.col(column).desc_nulls_last())


def oldest_first(df: DataFrame, column: str = "source_updated_at") -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_first())


# ---------------------------------------------------------------- W2 aliases


def alias_plan(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(source, canonical) pairs chosen from the exact column names present.

    Decided at plan time on ``df.columns`` (Spark resolves names
    case-insensitively, so the choice must not go through the resolver).
    """
    present = set(columns)
    spellings: dict[str, list[str]] = {}
    for spelling, canonical in SOURCE_ALIASES:
        spellings.setdefault(canonical, []).append(spelling)
    firsts = ((next((s for s in known if s in present), None), canonical) for canonical, known in spellings.items())
    return [(source, canonical) for source, canonical in firsts if source is not None]


def normalize_fields(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """B1: rename known spellings to canonical names, drop the rest.

    Values are untouched; canonical fields with no spelling present are
    omitted. Columns in ``keep`` pass through unchanged.
    """
    plan = alias_plan(df.columns)
    cols = [F.col(f"`{src}`").alias(dst) for src, dst in plan]
    cols += [F.col(f"`{k}`") for k in keep if k in df.columns]
    return df.select(*cols)


# ---------------------------------------------------------------- W3 deals


def _text_or_blank(df: DataFrame, name: str) -> Column:
    return clean_text(name) if name in df.columns else F.lit("")


def to_deals_flat(raw: DataFrame, source_system: str = "flat-file") -> DataFrame:
    """Flat records -> canonical deals.

    Text fields are trimmed (all Unicode whitespace) and NULL reads as blank;
    a malformed amount becomes NULL (reported later as missing); the flag is
    true only for the text ``true``; the change time parses ISO-8601 text
    (``Z`` = UTC, naive = UTC) and is NULL when malformed.
    """
    df = normalize_fields(raw, keep=(UPDATED_COLUMN,))
    amount = try_double("amount") if "amount" in df.columns else F.lit(None).cast("double")
    flag = parse_flag("registration_required") if "registration_required" in df.columns else F.lit(False)
    updated = (try_timestamp(UPDATED_COLUMN) if UPDATED_COLUMN in df.columns
               else F.lit(None).cast("timestamp"))
    opp = _text_or_blank(df, "opportunity_id")
    return df.select(
        opp.alias("opportunity_id"),
        _text_or_blank(df, "account_name").alias("account_name"),
        _text_or_blank(df, "opportunity_name").alias("opportunity_name"),
        _text_or_blank(df, "country").alias("country"),
        amount.alias("amount"),
        _text_or_blank(df, "industry").alias("industry"),
        _text_or_blank(df, "partner").alias("partner"),
        _text_or_blank(df, "close_date").alias("close_date"),
        flag.alias("registration_required"),
        _text_or_blank(df, "registration_status").alias("registration_status"),
        F.lit(source_system).alias("source_system"),
        opp.alias("source_record_id"),
        updated.cast("timestamp").alias("source_updated_at"),
    )


def _nested_amount(df: DataFrame) -> Column:
    c = F.col("Amount")
    if isinstance(df.schema["Amount"].dataType, NumericType):
        return F.coalesce(c.cast("double"), F.lit(0.0))
    # missing / blank / zero -> 0.0 (the nested source's default); bad text -> NULL
    return F.when(is_blank(c), F.lit(0.0)).otherwise(try_double(c))


def _nested_flag(df: DataFrame) -> Column:
    c = F.col("Registration_Required__c")
    if isinstance(df.schema["Registration_Required__c"].dataType, BooleanType):
        return F.coalesce(c, F.lit(False))
    return parse_flag(c)


def to_deals_nested(records: DataFrame, source_system: str = "api") -> DataFrame:
    """Nested API records -> canonical deals.

    ``Account.Name`` is NULL-safe (missing parent -> ''); a missing amount is
    0.0 while malformed text is NULL; the flag is parsed, not truthiness;
    the status defaults to ``Not Registered``. Text is trimmed as in B3 so a
    deal's fingerprint does not depend on its source.
    """
    opp = clean_text("Id")
    status = F.when(F.col("Registration_Status__c").isNull(), F.lit(DEFAULT_NESTED_STATUS)).otherwise(
        clean_text("Registration_Status__c"))
    return records.select(
        opp.alias("opportunity_id"),
        clean_text(F.col("Account.Name")).alias("account_name"),
        clean_text("Name").alias("opportunity_name"),
        clean_text("Country__c").alias("country"),
        _nested_amount(records).alias("amount"),
        clean_text("Industry").alias("industry"),
        clean_text("Partner__c").alias("partner"),
        clean_text("CloseDate").alias("close_date"),
        _nested_flag(records).alias("registration_required"),
        status.alias("registration_status"),
        F.lit(source_system).alias("source_system"),
        opp.alias("source_record_id"),
        try_timestamp("LastModifiedDate").cast("timestamp").alias("source_updated_at"),
    )
