"""Where each source is read from and landed, by run date. Only names are built here."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

STATIC = "static"


class UnknownSource(ValueError):
    pass


class BadRunDate(ValueError):
    pass


@dataclass(frozen=True)
class Route:
    #: what to read: a file below the lake root, or a table name
    source: str
    #: folder the source is landed in, below the target root
    target: str
    #: file format, or "jdbc"
    kind: str
    #: day partition, ``None`` for sources that are replaced whole
    day: str | None = None


# Source names, file names and landing folders.
CALL_LOGS, MEDIA, WEB_FORMS, AGENT_SHEET = "call_logs", "media_complaint", "web_forms", "agents"
CUSTOMERS_FILE = "customers/customers_dataset.csv"
CALL_LOGS_FILE = "call logs/call_logs_day_{day}.csv"
MEDIA_FILE = "social_medias/media_complaint_day_{day}.json"
WEB_FORM_TABLE = "customer_complaints.Web_form_request_{suffix}"
RAW_FOLDERS = {
    "customers": "raw/customers",
    "agents": "raw/agents",
    "call_center_logs": "raw/call_logs",
    "web_complaints": "raw/postgres",
    "social_media": "raw/social_media",
}


def day_suffix(run_date: str) -> str:
    """``2025-11-20`` as ``2025_11_20``; anything else is an error."""
    try:
        return datetime.strptime(run_date, "%Y-%m-%d").strftime("%Y_%m_%d")
    except ValueError as error:
        raise BadRunDate(f"run date must look like YYYY-MM-DD, not {run_date!r}") from error


def route(run_date: str, source: str, sheet_file: str | None = None) -> Route:
    """Source and target of one extract. A run date of ``STATIC`` means the customer file."""
    if run_date == STATIC.upper() or source == STATIC:
        return Route(CUSTOMERS_FILE, RAW_FOLDERS["customers"], "csv")
    if source == CALL_LOGS:
        return Route(CALL_LOGS_FILE.format(day=run_date), RAW_FOLDERS["call_center_logs"], "csv", run_date)
    if source == MEDIA:
        return Route(MEDIA_FILE.format(day=run_date), RAW_FOLDERS["social_media"], "json", run_date)
    if source == WEB_FORMS:
        table = WEB_FORM_TABLE.format(suffix=day_suffix(run_date))
        return Route(table, RAW_FOLDERS["web_complaints"], "jdbc", run_date)
    if source == AGENT_SHEET:
        name = sheet_file or "agents/agents.csv"
        return Route(name, RAW_FOLDERS["agents"], name.rsplit(".", 1)[-1])
    raise UnknownSource(f"no source named {source!r}")
