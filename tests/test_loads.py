import datetime as dt

from conftest import rows
from ombuds.operators.tables import VersionedTable
from ombuds.plans import pipeline
from ombuds.schemas import AUDIT, CALL_CENTER_LOGS, CUSTOMERS, RAW_TABLES, SOCIAL_MEDIA, UNIFIED, WEB_COMPLAINTS
from ombuds.session import conf
from ombuds.sources import landing
from ombuds.sources.paths import AGENT_SHEET, CALL_LOGS, MEDIA, STATIC, WEB_FORMS
from ombuds.streaming import daily
from ombuds.streaming.daily import load_available

import pytest

RUN = [dt.datetime(2025, 11, day, 6) for day in range(20, 25)]


def house(spark, tmp_path):
    return pipeline.Warehouse(spark, f"file://{tmp_path}/landed", f"file://{tmp_path}/house", buckets=2)


def land_web(spark, folder, day, *records):
    names = ["request_id", "customer_id", "resolutionstatus", "resolution_date", "load_time"]
    data = [tuple(r) + (None,) * (4 - len(r)) + (day,) for r in records]
    df = spark.createDataFrame(data, ", ".join(f"{name} string" for name in names))
    df.coalesce(1).write.parquet(f"{folder}/raw/postgres/dt={day}")


def test_daily_load_takes_each_file_once(spark, tmp_path):
    wh = house(spark, tmp_path)
    land_web(spark, wh.landed, "2025-11-20", ("1", "a", "Backlog"), ("2", "a", "Backlog", "2025-01-01"))
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[0]).loaded == 1
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[1]).loaded == 0
    land_web(spark, wh.landed, "2025-11-21", ("2", "a", "Resolved"), ("3", "b", "Backlog"))
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[2]).loaded == 1
    found = rows(wh.raw("web_complaints").read(), "request_id", "resolutionstatus", "resolution_date", AUDIT)
    assert found == [
        ("1", "Backlog", None, RUN[0]),
        ("2", "Resolved", None, RUN[2]),
        ("3", "Backlog", None, RUN[2]),
    ]


def test_load_lost_before_the_ledger_is_written_can_be_repeated(spark, tmp_path, monkeypatch):
    wh = house(spark, tmp_path)
    land_web(spark, wh.landed, "2025-11-20", ("1", "a", "Backlog"))
    with monkeypatch.context() as patched:
        patched.setattr(pipeline.Ledger, "record", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[0])
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[0]).loaded == 1
    assert rows(wh.raw("web_complaints").read(), "request_id") == [("1",)]


def test_static_load_replaces_and_keeps_the_old_table_when_empty(spark, tmp_path):
    wh, path = house(spark, tmp_path), f"file://{tmp_path}/landed/raw/customers"
    columns = "customer_id string, name string"
    spark.createDataFrame([("1", "Ann"), ("2", "Bob")], columns).write.parquet(path)
    pipeline.load_static(wh, CUSTOMERS, RUN[0])
    spark.createDataFrame([("1", "Anna")], columns).write.mode("overwrite").parquet(path)
    pipeline.load_static(wh, CUSTOMERS, RUN[1])
    assert rows(wh.raw("customers").read(), "customer_id", "name", AUDIT) == [("1", "Anna", RUN[1])]
    spark.createDataFrame([], columns).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError):
        pipeline.load_static(wh, CUSTOMERS, RUN[2])
    assert wh.raw("customers").read().count() == 1


def test_calls_merge_on_their_own_id(spark, tmp_path):
    wh = house(spark, tmp_path)
    assert wh.raw("call_center_logs").key == "call_id"
    columns = "source_row_id string, call_id string, customer_id string, resolutionstatus string"
    for day, status in ((1, "Backlog"), (2, "Resolved")):
        data = [("0", "c1", f"customer{day}", status), ("1", f"c{day}0", "x", status)]
        spark.createDataFrame(data, columns).write.parquet(f"{wh.folder('call_center_logs')}/dt=2025-11-{day:02}")
        pipeline.load_daily(wh, CALL_CENTER_LOGS, RUN[day])
    found = rows(wh.raw("call_center_logs").read(), "call_id", "customer_id", "resolutionstatus")
    assert found == [("c1", "customer1", "Resolved"), ("c10", "x", "Backlog"), ("c20", "x", "Resolved")]


def test_two_days_from_sources_to_marts(spark, tmp_path):
    wh, lake = house(spark, tmp_path), tmp_path / "lake"

    def put(name, text):
        (lake / name).parent.mkdir(parents=True, exist_ok=True)
        (lake / name).write_text(text)

    def reader(status):
        def read(spark, table):
            data = [(0, "w1", "1", "Billing", "9", status, "2025-11-20 10:59:00", "2025-11-20 11:01:00")]
            names = "column1 int, request_id string, customer_id string, complaint_catego_ry string, agent_id string, resolutionstatus string, request_date string, resolution_date string"
            return spark.createDataFrame(data, names)

        return read

    put("customers/customers_dataset.csv", "customer_id,name,DATE of biRTH,email\n1,Ann,1990-05-05,a@x\n2,Bob,oops,\n")
    put("agents/agents.csv", "iD,NamE,experience,state\n9,Zed,Mid,RI\n")
    header = ",call ID,customeR iD,COMPLAINT_catego ry,agent ID,call_start_time,call_end_time,resolutionstatus"
    put(
        "call logs/call_logs_day_2025-11-20.csv",
        f"{header}\n0,c1,1,Network,9,2025-11-20 10:00:00,2025-11-20 10:03:00,Backlog\n",
    )
    put(
        "social_medias/media_complaint_day_2025-11-21.json",
        '{"complaint_id":{"0":"s1"},"customeR iD":{"0":"2"},"media_channel":{"0":"LinkedIn"},"request_date":{"0":"2025-11-21"}}',
    )
    statuses = []
    for number, day in enumerate(("2025-11-20", "2025-11-21")):
        for source in (STATIC, AGENT_SHEET, CALL_LOGS, MEDIA, WEB_FORMS):
            done = landing.land(
                spark, f"file://{lake}", wh.landed, day, source, run_time=RUN[number],
                table_reader=reader("Backlog" if number == 0 else "Resolved"),
            )
            statuses.append(done.status)
        for name in ("customers", "agents"):
            pipeline.load_static(wh, RAW_TABLES[name], RUN[number])
        for name in ("call_center_logs", "web_complaints", "social_media"):
            if (tmp_path / "landed" / "raw" / wh.folder(name).rsplit("/", 1)[1]).exists():
                pipeline.load_daily(wh, RAW_TABLES[name], RUN[number])
        pipeline.build_marts(wh, dt.date(2025, 11, 21))
    assert statuses.count(landing.SKIPPED) == 2

    fact = rows(wh.unified().read(), "source_complaint_id", "customer_id", "channel", "status", "ingested_at")
    assert fact == [
        ("c1", "1", "Call Center", "Backlog", RUN[0]),
        ("s1", "2", "Social Media", None, RUN[1]),
        ("w1", "1", "Web Form", "Resolved", RUN[1]),
    ]
    marts = {}
    for name in ("dim_customers", "dim_agents", "fct_calls", "fct_web_complaints", "dim_date"):
        frame = VersionedTable(spark, f"{wh.root}/marts/{name}", spark.read.parquet(f"{wh.root}/marts/{name}/data/version=2/bucket=0").schema)
        marts[name] = frame.read()
    assert rows(marts["dim_customers"], "customer_id", "customer_age") == [("1", 35), ("2", None)]
    assert marts["fct_calls"].first().call_duration_seconds == 180
    assert marts["fct_web_complaints"].first().time_to_resolve_hours == 1
    assert marts["dim_date"].count() == 2192

    failures = {(row.table, row.column): row.failures for row in pipeline.check_raw(wh).collect() if row.failures}
    assert failures == {("customers", "email"): 1}
    marts["fct_unified_complaints"] = wh.unified().read()
    assert pipeline.check_marts(marts).where("failures > 0").isEmpty()
    assert spark.read.parquet(pipeline.publish_clustered(wh)).count() == 3


def test_stream_takes_each_file_once(spark, tmp_path):
    folder = f"file://{tmp_path}"
    target = VersionedTable(spark, f"{folder}/web", WEB_COMPLAINTS.schema, "request_id", 2)
    fact = VersionedTable(spark, f"{folder}/fact", UNIFIED, "complaint_pk", 2)

    def load(run_time):
        return load_available(
            spark, WEB_COMPLAINTS, f"{folder}/raw/postgres", target, f"{folder}/checkpoint", run_time, fact
        )

    land_web(spark, folder, "2025-11-20", ("1", "a", "Backlog"), ("2", "a", "Backlog"))
    assert load(RUN[0]) == 1
    assert load(RUN[1]) == 0
    land_web(spark, folder, "2025-11-21", ("2", "a", "Resolved"))
    assert load(RUN[2]) == 1
    assert rows(target.read(), "request_id", "resolutionstatus", AUDIT) == [
        ("1", "Backlog", RUN[0]),
        ("2", "Resolved", RUN[2]),
    ]
    assert rows(fact.read(), "source_complaint_id", "status") == [("1", "Backlog"), ("2", "Resolved")]


def test_stream_keeps_columns_a_partial_merge_ignores(spark, tmp_path):
    folder = f"file://{tmp_path}"
    target = VersionedTable(spark, f"{folder}/calls", CALL_CENTER_LOGS.schema, "source_row_id", 2)
    fact = VersionedTable(spark, f"{folder}/fact", UNIFIED, "complaint_pk", 2)
    columns = "source_row_id string, call_id string, customer_id string, resolutionstatus string"
    for day, (who, status) in enumerate((("ann", "Backlog"), ("bob", "Resolved"))):
        spark.createDataFrame([("0", "c1", who, status)], columns).write.parquet(f"{folder}/in/dt={day}")
        load_available(spark, CALL_CENTER_LOGS, f"{folder}/in", target, f"{folder}/cp", RUN[day], fact)
    assert rows(fact.read(), "customer_id", "status") == [("ann", "Resolved")]


def test_stream_in_small_batches(spark, tmp_path):
    folder = f"file://{tmp_path}"
    target = VersionedTable(spark, f"{folder}/web", SOCIAL_MEDIA.schema, "complaint_id", 2)
    for part in range(3):
        df = spark.createDataFrame([(str(part),), ("x",)], "complaint_id string")
        df.coalesce(1).write.parquet(f"{folder}/in/dt={part}")
    merged = load_available(
        spark, SOCIAL_MEDIA, f"{folder}/in", target, f"{folder}/cp", RUN[0], files_per_batch=1
    )
    assert merged == 3 and rows(target.read(), "complaint_id") == [("0",), ("1",), ("2",), ("x",)]


def test_failed_tests_keep_the_marts_of_the_last_good_build(spark, tmp_path):
    wh, path = house(spark, tmp_path), f"file://{tmp_path}/landed/raw/customers"
    day = dt.date(2025, 11, 21)
    for names in (["Ida"], ["Ida", "Ole"]):
        people = spark.createDataFrame([("7", name) for name in names], "customer_id string, name string")
        people.write.mode("overwrite").parquet(path)
        pipeline.load_static(wh, CUSTOMERS, RUN[0])
        if len(names) == 1:
            pipeline.build_marts(wh, day)
    with pytest.raises(pipeline.FailedTests, match="unique of dim_customers.customer_id"):
        pipeline.build_marts(wh, day)
    shape = pipeline.marts.dim_customers(wh.staging()["stg_customers"]).schema
    assert rows(pipeline.mart(wh, "dim_customers", shape).read(), "customer_name") == [("Ida",)]
    assert rows(pipeline.read_marts(wh)["dim_customers"], "customer_name") == [("Ida",)]


def test_readers_see_all_marts_of_one_build(spark, tmp_path, monkeypatch):
    wh, path = house(spark, tmp_path), f"file://{tmp_path}/landed/raw/customers"
    with pytest.raises(RuntimeError, match="no complete build"):
        pipeline.read_marts(wh)

    def deliver(day, name, *complaints):
        people = spark.createDataFrame([("a", name)], "customer_id string, name string")
        people.write.mode("overwrite").parquet(path)
        pipeline.load_static(wh, CUSTOMERS, RUN[day])
        land_web(spark, wh.landed, f"2025-11-2{day}", *complaints)
        pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[day])

    deliver(0, "Ann", ("1", "a", "Backlog"))
    pipeline.build_marts(wh, dt.date(2025, 11, 21))
    deliver(1, "Anna", ("1", "a", "Resolved"), ("2", "a", "Backlog"))
    with monkeypatch.context() as patched:
        # The last step of a build is lost: its tables are written, but no build names them.
        patched.setattr(pipeline, "_last_build", lambda _: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            pipeline.build_marts(wh, dt.date(2025, 11, 21))
    old = pipeline.read_marts(wh)
    assert sorted(old) == sorted(["dim_customers", "dim_agents", "dim_date", "fct_calls", "fct_web_complaints", "fct_social_media", pipeline.FACT])
    assert rows(old["dim_customers"], "customer_name") == [("Ann",)]
    assert rows(old[pipeline.FACT], "source_complaint_id", "status") == [("1", "Backlog")]
    pipeline.build_marts(wh, dt.date(2025, 11, 21))
    new = pipeline.read_marts(wh)
    assert rows(new["dim_customers"], "customer_name") == [("Anna",)]
    assert rows(new[pipeline.FACT], "source_complaint_id", "status") == [("1", "Resolved"), ("2", "Backlog")]


def test_skipped_files_are_reported_and_stay_new(spark, tmp_path):
    wh = house(spark, tmp_path)
    land_web(spark, wh.landed, "2025-11-20", ("1", "a", "Backlog"))
    bad = tmp_path / "landed" / "raw" / "postgres" / "dt=2025-11-21" / "bad.parquet"
    bad.parent.mkdir(parents=True)
    bad.write_bytes(b"damaged")
    done = pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[0])
    assert done.loaded == 1 and [name.rsplit("/", 1)[1] for name in done.rejected] == ["bad.parquet"]
    assert wh.ledger("web_complaints").new_files(wh.folder("web_complaints")).count() == 1
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[1]).loaded == 0
    bad.unlink()
    land_web(spark, wh.landed, "2025-11-22", ("2", "b", "Backlog"))
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[2]) == pipeline.Load(1)


def test_files_without_rows_are_loaded_and_those_without_bytes_reported(spark, tmp_path):
    wh = house(spark, tmp_path)
    land_web(spark, wh.landed, "2025-11-20", ("1", "a", "Backlog"))
    land_web(spark, wh.landed, "2025-11-21")
    none = tmp_path / "landed" / "raw" / "postgres" / "dt=2025-11-21" / "none.parquet"
    none.write_bytes(b"")
    for run, loaded in ((RUN[0], 2), (RUN[1], 0)):
        done = pipeline.load_daily(wh, WEB_COMPLAINTS, run)
        assert done.loaded == loaded and done.rejected == (f"file:{none}",)
    none.unlink()
    assert pipeline.load_daily(wh, WEB_COMPLAINTS, RUN[2]) == pipeline.Load()


def test_static_load_with_a_damaged_file_keeps_the_old_table(spark, tmp_path):
    wh, path = house(spark, tmp_path), tmp_path / "landed" / "raw" / "customers"
    people = spark.createDataFrame([("1", "Ann"), ("2", "Bob")], "customer_id string, name string")
    people.repartition(2, "name").write.parquet(f"file://{path}")
    assert pipeline.load_static(wh, CUSTOMERS, RUN[0]).rejected == ()
    damaged = sorted(file for file in path.glob("*.parquet"))[0]
    content = damaged.read_bytes()
    damaged.write_bytes(b"damaged")
    for checksum in path.glob(".*.crc"):
        checksum.unlink()
    done = pipeline.load_static(wh, CUSTOMERS, RUN[1])
    assert done.loaded == 0 and [name.rsplit("/", 1)[1] for name in done.rejected] == [damaged.name]
    assert {row[AUDIT] for row in wh.raw("customers").read().collect()} == {RUN[0]}
    done = pipeline.load_static(wh, CUSTOMERS, RUN[2], partial=True)
    assert len(done.rejected) == 1 and wh.raw("customers").read().count() < 2
    damaged.write_bytes(content)
    assert pipeline.load_static(wh, CUSTOMERS, RUN[3]).rejected == ()
    assert wh.raw("customers").read().count() == 2


def test_stream_quarantines_damaged_files_and_takes_them_when_put_right(spark, tmp_path):
    folder = f"file://{tmp_path}"
    target = VersionedTable(spark, f"{folder}/web", WEB_COMPLAINTS.schema, "request_id", 2)
    source = tmp_path / "raw" / "postgres"

    def load(run_time):
        return load_available(spark, WEB_COMPLAINTS, f"{folder}/raw/postgres", target, f"{folder}/checkpoint", run_time)

    def held():
        return sorted(row.path.rsplit("/", 1)[1] for row in daily.quarantined(spark, target).collect())

    land_web(spark, folder, "2025-11-20", ("1", "a", "Backlog"))
    (source / "dt=2025-11-20" / "bad.parquet").write_bytes(b"damaged")
    (source / "dt=2025-11-20" / "none.parquet").write_bytes(b"")
    typed = spark.createDataFrame([("2", 7)], "request_id string, customer_id int")
    typed.coalesce(1).write.parquet(f"{folder}/raw/postgres/dt=2025-11-21")
    assert load(RUN[0]) == 1
    assert held() == ["bad.parquet", "none.parquet"]
    assert rows(target.read(), "request_id", "customer_id") == [("1", "a"), ("2", "7")]
    assert load(RUN[1]) == 0
    land_web(spark, folder, "2025-11-22", ("3", "c", "Backlog"))
    [good] = (source / "dt=2025-11-22").glob("*.parquet")
    for name in ("bad", "none"):
        (source / "dt=2025-11-20" / f"{name}.parquet").write_bytes(good.read_bytes())
    assert load(RUN[2]) == 2 and held() == []
    assert load(RUN[3]) == 0
    assert rows(target.read(), "request_id", AUDIT) == [("1", RUN[0]), ("2", RUN[0]), ("3", RUN[2])]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    target = VersionedTable(spark, f"{folder}/web", WEB_COMPLAINTS.schema, "request_id", 2)
    fact = VersionedTable(spark, f"{folder}/fact", UNIFIED, "complaint_pk", 2)

    def load(run_time):
        place = (f"{folder}/raw/postgres", target, f"{folder}/checkpoint", run_time, fact)
        return load_available(spark, WEB_COMPLAINTS, *place)

    land_web(spark, folder, "2025-11-20", ("1", "a", "Backlog"))
    with monkeypatch.context() as patched:
        patched.setattr(daily, "_complaints_of", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            load(RUN[0])
    assert rows(target.read(), "request_id", AUDIT) == [("1", RUN[0])] and fact.read().isEmpty()
    assert load(RUN[1]) == 1  # the same batch, with the time it had
    assert rows(target.read(), "request_id", AUDIT) == [("1", RUN[0])]
    assert rows(fact.read(), "source_complaint_id", "ingested_at") == [("1", RUN[0])]


def test_a_late_day_is_written_by_many_tasks_and_no_request_is_in_two_files(spark, tmp_path):
    from checks.queries import _put_right

    day = f"file://{tmp_path}/day"
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        _put_right(spark.range(400).selectExpr("cast(id % 200 as string) request_id", "id"), day)
    found = spark.read.parquet(day).selectExpr("request_id", "_metadata.file_name file")
    names = {row.file for row in found.select("file").distinct().collect()}
    assert "part-0.parquet" in names and len(names) > 1
    assert found.distinct().count() == 200 and found.count() == 400
