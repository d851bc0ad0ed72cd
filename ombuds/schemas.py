"""Declared RAW tables: columns, keys, and which columns a merge updates."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

AUDIT = "_ingestion_time"


def _raw(*names: str) -> T.StructType:
    """Every business column is text; the audit column is a timestamp without zone."""
    fields = [T.StructField(name, T.StringType()) for name in names]
    return T.StructType([*fields, T.StructField(AUDIT, T.TimestampNTZType())])


@dataclass(frozen=True)
class RawTable:
    name: str
    schema: T.StructType
    #: column whose value identifies a row for the daily merge; ``None`` for full refresh tables
    merge_key: str | None = None
    #: columns a merge overwrites on a match; ``None`` means all but the key
    update: tuple[str, ...] | None = None
    #: accepted spellings of a column in landed files; ``None`` matches all columns ignoring case
    spellings: dict[str, tuple[str, ...]] | None = field(default=None, hash=False)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def business(self) -> list[str]:
        return [name for name in self.columns if name != AUDIT]


# Column names, merge keys, updated columns and accepted spellings.
CUSTOMERS = RawTable(
    "customers",
    _raw("customer_id", "name", "gender", "date_of_birth", "signup_date", "email", "address", "load_time"),
)
AGENTS = RawTable("agents", _raw("id", "name", "experience", "state", "load_time"))
CALL_CENTER_LOGS = RawTable(
    "call_center_logs",
    _raw(
        "source_row_id", "call_id", "customer_id", "complaint_catego_ry", "agent_id", "call_start_time",
        "call_end_time", "resolutionstatus", "calllogsgenerationdate", "load_time",
    ),
    merge_key="source_row_id",
    update=("call_id", "resolutionstatus", "call_end_time", AUDIT),
)
WEB_COMPLAINTS = RawTable(
    "web_complaints",
    _raw(
        "source_row_id", "request_id", "customer_id", "complaint_catego_ry", "agent_id", "resolutionstatus",
        "request_date", "resolution_date", "webformgenerationdate", "load_time",
    ),
    merge_key="request_id",
    spellings={"source_row_id": ("source_row_id", "SOURCE_ROW_ID", "Source_Row_Id")},
)
SOCIAL_MEDIA = RawTable(
    "social_media",
    _raw(
        "complaint_id", "customer_id", "complaint_catego_ry", "agent_id", "resolutionstatus", "request_date",
        "resolution_date", "media_channel", "mediacomplaintgenerationdate", "load_time",
    ),
    merge_key="complaint_id",
    spellings={"complaint_id": ("complaint_id", "COMPLAINT_ID", "Complaint_Id")},
)

RAW_TABLES = {
    table.name: table for table in (CUSTOMERS, AGENTS, CALL_CENTER_LOGS, WEB_COMPLAINTS, SOCIAL_MEDIA)
}

UNIFIED = T.StructType(
    [
        T.StructField("complaint_pk", T.StringType()),
        T.StructField("source_complaint_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("complaint_category", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)
