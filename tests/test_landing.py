import datetime as dt

import pytest

from conftest import rows
from ombuds.sources import landing
from ombuds.sources.jdbc import JdbcReader
from ombuds.sources.paths import AGENT_SHEET, CALL_LOGS, MEDIA, STATIC, WEB_FORMS, BadRunDate, UnknownSource, route

RUN = dt.datetime(2025, 11, 21, 6)
DAY = "2025-11-20"


def put(tmp_path, name, text):
    path = tmp_path / "lake" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def land(spark, tmp_path, day, source, **more):
    roots = (f"file://{tmp_path}/lake", f"file://{tmp_path}/out")
    return landing.land(spark, *roots, day, source, run_time=RUN, **more)


def test_routes():
    assert route("STATIC", "anything") == route(DAY, STATIC)
    assert route(DAY, STATIC).day is None
    assert route(DAY, CALL_LOGS).source == "call logs/call_logs_day_2025-11-20.csv"
    assert route(DAY, MEDIA).source == "social_medias/media_complaint_day_2025-11-20.json"
    assert route(DAY, WEB_FORMS).source == "customer_complaints.Web_form_request_2025_11_20"
    assert route(DAY, AGENT_SHEET, "x/staff.json").kind == "json"
    with pytest.raises(UnknownSource):
        route(DAY, "fax")
    with pytest.raises(BadRunDate):
        route("20-11-2025", WEB_FORMS)


def test_static_customers(spark, tmp_path):
    put(tmp_path, "customers/customers_dataset.csv", 'customer_id,name,join_date\n007,"Ode, Ida ""Io""",2019-12-31\n8,,')
    done = land(spark, tmp_path, "STATIC", STATIC)
    assert (done.status, done.rows) == (landing.LANDED, 2)
    stamp = "2025-11-21 06:00:00"
    assert rows(spark.read.parquet(done.path)) == [("007", 'Ode, Ida "Io"', "2019-12-31", stamp), ("8", None, None, stamp)]


def test_call_logs(spark, tmp_path):
    header = "call ID,customeR iD,COMPLAINT_catego ry,agent ID,call_start_time"
    put(tmp_path, f"call logs/call_logs_day_{DAY}.csv", header + "\n0042,q-9,\"Line, fault\",,1999-12-31 23:59:59")
    df = spark.read.parquet(land(spark, tmp_path, DAY, CALL_LOGS).path)
    assert df.columns == [
        "call_id", "customer_id", "complaint_catego_ry", "agent_id", "call_start_time", "load_time", "dt",
    ]
    assert df.first().dt == dt.date(2025, 11, 20)
    assert tuple(df.first())[:5] == ("0042", "q-9", "Line, fault", None, "1999-12-31 23:59:59")


def test_social_media(spark, tmp_path):
    text = '{"complaint_id": {"0": "a7", "1": "b8"}, "date": {"0": "2025-11-20", "1": "2025-11-20"}}'
    put(tmp_path, f"social_medias/media_complaint_day_{DAY}.json", text)
    done = land(spark, tmp_path, DAY, MEDIA)
    assert done.rows == 2
    assert rows(spark.read.parquet(done.path), "complaint_id", "date") == [("a7", DAY), ("b8", DAY)]


def test_missing_sources_are_skipped(spark, tmp_path):
    assert land(spark, tmp_path, "2025-11-25", CALL_LOGS) == landing.Landing(landing.SKIPPED)

    def no_table(spark, table):
        raise RuntimeError(f'ERROR: relation "{table}" does not exist')

    assert land(spark, tmp_path, DAY, WEB_FORMS, table_reader=no_table).status == landing.SKIPPED


def test_other_source_errors_are_not_skipped(spark, tmp_path):
    def refused(spark, table):
        raise RuntimeError("connection refused")

    with pytest.raises(RuntimeError, match="refused"):
        land(spark, tmp_path, DAY, WEB_FORMS, table_reader=refused)


def test_web_form_table(spark, tmp_path):
    asked = []

    def reader(spark, table):
        asked.append(table)
        return spark.createDataFrame([(1, "a", dt.datetime(2025, 1, 1))], "column1 int, `Col 2` string, t timestamp_ntz")

    df = spark.read.parquet(land(spark, tmp_path, DAY, WEB_FORMS, table_reader=reader).path)
    assert asked == ["customer_complaints.Web_form_request_2025_11_20"]
    assert rows(df, "source_row_id", "col_2", "t") == [("1", "a", "2025-01-01 00:00:00")]


def test_jdbc_options():
    plain = JdbcReader("jdbc:x", {"user": "u"}).reader_options("s.t")
    assert plain == {"url": "jdbc:x", "dbtable": "s.t", "fetchsize": "10000", "user": "u"}
    split = JdbcReader("jdbc:x", partition_column="id", lower=1, upper=9, partitions=4).reader_options("t")
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4"


def test_sheet(spark, tmp_path):
    put(tmp_path, "agents/agents.csv", "iD,NamE,experience,state\n0300,Ümit,,\n")
    done = land(spark, tmp_path, DAY, AGENT_SHEET)
    assert rows(spark.read.parquet(done.path), "id", "name") == [("0300", "Ümit")]


def test_empty_sheet_writes_nothing(spark, tmp_path):
    put(tmp_path, "agents/agents.csv", "iD,NamE,experience,state\n")
    assert land(spark, tmp_path, DAY, AGENT_SHEET).status == landing.EMPTY
    assert not (tmp_path / "out").exists()


def test_landing_a_day_again_replaces_only_that_day(spark, tmp_path):
    for day, text in ((DAY, "a\n1\n2"), ("2025-11-21", "a\n3"), (DAY, "a\n4")):
        put(tmp_path, f"call logs/call_logs_day_{day}.csv", text)
        done = land(spark, tmp_path, day, CALL_LOGS)
    assert done.rows == 1
    assert rows(spark.read.parquet(done.path), "a") == [("3",), ("4",)]
