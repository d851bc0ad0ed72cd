import datetime as dt
import hashlib
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan, rows
from ombuds.operators.dedup import latest_per_key
from ombuds.operators.quality import QualityError
from ombuds.operators.tables import VersionedTable
from ombuds.operators.upsert import BatchSize, batch_size, measured, upsert
from ombuds.plans.pipeline import fill_audit
from ombuds.schemas import AUDIT

COLUMNS = f"k string, a string, b string, {AUDIT} timestamp_ntz"
DAY = [dt.datetime(2025, 1, day) for day in range(1, 9)]


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS)


# dedup


def test_latest_row_wins_and_null_time_counts_as_latest(spark):
    df = frame(spark, [("x", "old", "", DAY[0]), ("x", "new", "", DAY[1]), ("y", "a", "", DAY[5]), ("y", "b", "", None)])
    assert rows(latest_per_key(df, "k"), "k", "a") == [("x", "new"), ("y", "b")]


def test_ties_do_not_depend_on_row_order(spark):
    data = [("x", a, b, DAY[0]) for a in "pq" for b in "uvw"]
    for order in (data, data[::-1]):
        assert rows(latest_per_key(frame(spark, order).repartition(3), "k"), "a", "b") == [("q", "w")]


def test_load_time_breaks_ties_first(spark):
    df = spark.createDataFrame(
        [("x", "z", "2025-01-01", DAY[0]), ("x", "a", "2025-01-02", DAY[0])], f"k string, a string, load_time string, {AUDIT} timestamp_ntz"
    )
    assert rows(latest_per_key(df, "k"), "a") == [("a",)]


def test_null_keys_are_one_group(spark):
    df = frame(spark, [(None, "a", "", DAY[0]), (None, "b", "", DAY[1]), ("x", "c", "", DAY[0])])
    assert rows(latest_per_key(df, "k"), "k", "a") == [(None, "b"), ("x", "c")]


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = frame(spark, [("x", "a", "", DAY[0])] * 5)
    text = plan(latest_per_key(df, "k"))
    assert text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


# merge laws, against a plain reading of the rules


def merged_by_hand(target, source, update):
    """Update matched rows in place, then add unmatched source rows."""
    names = ["k", "a", "b", AUDIT]
    update = names if update is None else update
    by_key = {row[0]: dict(zip(names, row)) for row in source if row[0] is not None}
    out = []
    for row in target:
        new = by_key.get(row[0])
        old = dict(zip(names, row))
        out.append(tuple(new[n] if new and n in update else old[n] for n in names))
    known = {row[0] for row in target if row[0] is not None}
    out += [row for row in source if row[0] is None or row[0] not in known]
    return sorted(out, key=lambda row: [(value is not None, str(value)) for value in row])


keys = st.sampled_from(["1", "2", "3", "4", "5", None])
texts = st.sampled_from(["p", "q", None])
row = st.tuples(keys, texts, texts, st.sampled_from(DAY))
source_rows = st.lists(row, max_size=8, unique_by=lambda r: r[0])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=10), source_rows, st.sampled_from([None, ("a", AUDIT), ("b",)]))
def test_upsert_follows_the_rules(spark, target, source, update):
    got = upsert(frame(spark, target), frame(spark, source), "k", update)
    assert got.columns == ["k", "a", "b", AUDIT]
    assert rows(got) == merged_by_hand(target, source, update)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(source_rows, source_rows)
def test_replacing_rows_of_a_unique_target(spark, target, source):
    got = upsert(frame(spark, target), frame(spark, source), "k", unique_target=True)
    assert rows(got) == merged_by_hand(target, source, None)


def test_merging_twice_is_merging_once(spark):
    target = frame(spark, [("1", "a", "b", DAY[0]), ("2", "a", "b", DAY[0])])
    source = frame(spark, [("2", None, "n", DAY[1]), ("3", "c", "n", DAY[1])])
    for update in (None, ("a", AUDIT)):
        once = upsert(target, source, "k", update)
        assert rows(upsert(once, source, "k", update)) == rows(once)


def test_new_nulls_overwrite_old_values(spark):
    target = frame(spark, [("1", "a", "b", DAY[0])])
    source = frame(spark, [("1", None, None, DAY[1])])
    assert rows(upsert(target, source, "k")) == [("1", None, None, DAY[1])]
    assert rows(upsert(target, source, "k", ("a",))) == [("1", None, "b", DAY[0])]


def stored_target(spark, folder):
    text = f"timestamp_ntz'2025-01-01' {AUDIT}"
    spark.range(20000).selectExpr("cast(id as string) k", "'a' a", "'b' b", text).write.parquet(f"{folder}/t")
    return spark.read.parquet(f"{folder}/t")


def test_measured_small_batch_does_not_shuffle_the_target(spark, folder):
    source = frame(spark, [("5", "new", "new", DAY[1]), (None, "x", "y", DAY[1])])
    small = BatchSize(rows=2, key_bytes=1, all_bytes=60)
    for update in (None, ("a",)):
        target = stored_target(spark, f"{folder}/{update}")
        merged = upsert(target, source, "k", update, small, unique_target=update is None)
        assert len(merged.collect()) == 20001
        text = plan(merged)
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(k" not in first_branch(text)


def first_branch(text):
    """The plan of the rewritten target rows: the first input of the union."""
    return text.split("Union", 1)[1].split("\n   :- ", 2)[1]


def test_large_batch_is_not_broadcast(spark, folder):
    source = frame(spark, [("5", "new", "new", DAY[1])])
    large = BatchSize(rows=10**8, key_bytes=10**9, all_bytes=10**10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert(stored_target(spark, folder), source, "k", None, large)
        assert len(merged.collect()) == 20000
        assert "SortMergeJoin" in plan(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_batch_size_is_measured_while_writing(spark, folder):
    df, seen = measured(frame(spark, [("abc", "é", None, DAY[0]), (None, "", "12", None)]), "k")
    df.write.parquet(f"{folder}/b")
    assert batch_size(seen) == BatchSize(rows=2, key_bytes=3, all_bytes=3 + 2 + 2)


def test_audit_column(spark):
    df = frame(spark, [("1", "", "", None), ("2", "", "", DAY[0])])
    assert rows(fill_audit(df, DAY[3]), AUDIT) == [(DAY[3],), (DAY[3],)]
    assert rows(fill_audit(df, DAY[3], only_missing=True), AUDIT) == [(DAY[0],), (DAY[3],)]
    assert dict(fill_audit(df.drop(AUDIT), DAY[3], only_missing=True).dtypes)[AUDIT] == "timestamp_ntz"


# stored tables


def table(spark, folder, buckets=4):
    return VersionedTable(spark, f"{folder}/table", frame(spark, []).schema, "k", buckets)


def test_table_before_the_first_write_is_empty(spark, folder):
    assert table(spark, folder).read().isEmpty() and table(spark, folder).version() == 0


def test_table_merges_like_frames(spark, folder):
    stored = table(spark, folder)
    first = [(str(i), "a", "b", DAY[0]) for i in range(40)] + [(None, "n", "", DAY[0])]
    second = [(str(i), None, "c", DAY[1]) for i in range(35, 45)] + [(None, "m", "", DAY[1])]
    stored.merge(frame(spark, first))
    stored.merge(frame(spark, second), update=("a",))
    assert rows(stored.read()) == merged_by_hand(first, second, ("a",))


def test_batch_is_deduplicated(spark, folder):
    stored = table(spark, folder)
    stored.merge(frame(spark, [("1", "late", "", DAY[3]), ("1", "early", "", DAY[0])]))
    assert rows(stored.read(), "k", "a") == [("1", "late")]


def test_empty_batch_changes_nothing(spark, folder):
    stored = table(spark, folder)
    stored.merge(frame(spark, [("1", "a", "", DAY[0])]))
    assert stored.merge(frame(spark, [])) == 1 and stored.version() == 1


def test_new_keys_rewrite_nothing(spark, folder):
    stored = table(spark, folder)
    stored.merge(frame(spark, [(str(i), "a", "", DAY[0]) for i in range(40)]))
    before = set(stored.read().inputFiles())
    stored.merge(frame(spark, [(str(i), "a", "", DAY[1]) for i in range(100, 140)]))
    after = set(stored.read().inputFiles())
    assert before < after and stored.read().count() == 80


def test_a_change_rewrites_only_its_folder(spark, folder):
    stored = table(spark, folder)
    for day in range(3):
        stored.merge(frame(spark, [(f"{day}-{i}", "a", "", DAY[day]) for i in range(40)]))
    live = set(stored._live()[1])
    stored.merge(frame(spark, [("1-7", "changed", "", DAY[5])]))
    gone = live - set(stored._live()[1])
    assert len(gone) == 1 and gone.pop()[0] == 2
    assert stored.read().count() == 120
    assert rows(stored.read().where("a = 'changed'"), "k") == [("1-7",)]


def test_only_folders_that_share_a_bit_with_the_batch_are_scanned(spark, folder, monkeypatch):
    stored, scanned = table(spark, folder, buckets=2), []
    for day in range(4):
        stored.merge(frame(spark, [(f"{day}-{i}", "a", "", DAY[day]) for i in range(30)]))
    scan = VersionedTable._folders_with
    monkeypatch.setattr(VersionedTable, "_folders_with", lambda self, keys, found: scanned.append(found) or scan(self, keys, found))
    stored.merge(frame(spark, [("2-7", "changed", "", DAY[5]), ("9-9", "new", "", DAY[5])]))
    assert [len(found) for found in scanned] == [1] and scanned[0][0][0] == 3
    stored.merge(frame(spark, [("9-10", "new", "", DAY[6])]))
    assert len(scanned) == 1  # a new key: no folder is even scanned
    assert stored.read().count() == 122 and rows(stored.read().where("a = 'changed'"), "k") == [("2-7",)]


def test_bitmaps_that_are_full_change_no_result(spark, folder, monkeypatch):
    """Bitmaps of 8 bits say yes to nearly everything."""
    monkeypatch.setattr("ombuds.operators.tables._BITS", 8)
    stored = table(spark, folder)
    first = [(str(i), "a", "b", DAY[0]) for i in range(300)]
    second = [(str(i), None, "c", DAY[1]) for i in range(250, 320)]
    stored.merge(frame(spark, first))
    stored.merge(frame(spark, second), update=("a",))
    assert rows(stored.read()) == merged_by_hand(first, second, ("a",))


@pytest.mark.parametrize("buckets", [1, 3])
def test_a_range_of_days_opens_its_files_only(spark, folder, buckets):
    schema = frame(spark, []).schema
    stored = VersionedTable(spark, f"{folder}/t", schema, "k", buckets, cluster=AUDIT, file_rows=10)
    data = [(f"{day}-{i}", "a", "", DAY[day] + dt.timedelta(hours=23 * (i % 2))) for day in range(8) for i in range(30)]
    stored.merge(frame(spark, [*data, ("none", "a", "", None)]))
    stored.merge(frame(spark, [("3-1", "moved", "", DAY[6]), ("8-1", "new", "", DAY[2])]))
    found = stored.read_between(DAY[2].date(), DAY[3].date())
    assert rows(found, "k") == sorted([(f"{day}-{i}",) for day in (2, 3) for i in range(30) if (day, i) != (3, 1)] + [("8-1",)])
    assert len(found.inputFiles()) <= len(stored.read().inputFiles()) / 2
    assert stored.read_between(dt.date(2030, 1, 1), dt.date(2030, 1, 2)).isEmpty()
    assert stored.read().count() == 242


def test_a_merge_leaves_no_staged_batch_behind(spark, folder, monkeypatch):
    from ombuds.session import path_exists

    stored, staged = table(spark, folder), []
    stage = VersionedTable._stage
    monkeypatch.setattr(VersionedTable, "_stage", lambda self, batch: staged.append(stage(self, batch)) or staged[-1])
    for day in range(3):
        stored.merge(frame(spark, [("1", "a", "", DAY[day])]))
    assert len(staged) == 2 and not any(path_exists(spark, path) for *_, path in staged)


def test_readers_keep_the_state_they_opened(spark, folder):
    stored = table(spark, folder)
    stored.replace(frame(spark, [("1", "old", "", DAY[0])]))
    opened = stored.read()
    stored.replace(frame(spark, [("1", "new", "", DAY[1])]))
    assert rows(opened, "a") == [("old",)] and rows(stored.read(), "a") == [("new",)]


def test_failed_refresh_leaves_the_old_state(spark, folder):
    stored = table(spark, folder, buckets=1)
    stored.replace(frame(spark, [("1", "old", "", DAY[0])]))

    def reject(df):
        raise ValueError("bad data")

    with pytest.raises(ValueError, match="bad data"):
        stored.replace(frame(spark, [("1", "new", "", DAY[1])]), check=reject)
    assert rows(stored.read(), "a") == [("old",)] and stored.version() == 1
    stored.replace(frame(spark, [("2", "newer", "", DAY[1])]))
    assert rows(stored.read(), "a") == [("newer",)]


def test_refresh_may_read_the_table_it_replaces(spark, folder):
    stored = table(spark, folder)
    stored.replace(frame(spark, [("1", "a", "", DAY[0]), ("2", "a", "", DAY[0])]))
    stored.replace(stored.read().where("k = '2'"))
    assert rows(stored.read(), "k") == [("2",)]


def test_refresh_with_repeated_keys_fails(spark, folder):
    stored = table(spark, folder)
    with pytest.raises(QualityError, match="k repeats"):
        stored.replace(frame(spark, [("1", "a", "", DAY[0]), ("1", "b", "", DAY[0]), (None, "", "", DAY[0])]))
    assert stored.version() == 0


def test_null_keys_are_spread_over_buckets(spark, folder):
    stored = table(spark, folder, buckets=8)
    stored.replace(frame(spark, [(None, str(i), "", DAY[0]) for i in range(200)]))
    assert len(stored._live()[1]) == 8 and stored.read().count() == 200


def test_changed_bucket_number_is_an_error(spark, folder):
    table(spark, folder, 4).merge(frame(spark, [("1", "a", "", DAY[0])]))
    with pytest.raises(ValueError, match="buckets"):
        table(spark, folder, 8).read()


def test_erase(spark, folder):
    stored = table(spark, folder)
    stored.replace(frame(spark, [(str(i), "ann" if i % 2 else None, "", DAY[0]) for i in range(10)]))
    stored.erase(spark.createDataFrame([("ann",), (None,)], "who string"), "a")
    assert stored.read().count() == 5 and stored.read().where("a = 'ann'").isEmpty()
    assert stored.erase(spark.createDataFrame([("nobody",)], "who string"), "a") == 2


def test_expire_deletes_what_no_reader_needs(spark, folder, tmp_path):
    stored = table(spark, folder, buckets=1)
    for day in range(3):
        stored.replace(frame(spark, [("1", str(day), "", DAY[day])]))
    assert stored.expire(keep=1) == [f"{folder}/table/data/version=1/bucket=0"]
    assert (tmp_path / "table/data/version=2/bucket=0").exists()
    assert rows(stored.read(), "a") == [("2",)]


def test_view(spark, folder):
    stored = table(spark, folder)
    stored.replace(frame(spark, [("1", "a", "", DAY[0])]))
    stored.register("stored_view")
    assert spark.sql("SELECT k FROM stored_view").first().k == "1"


@pytest.mark.parametrize("update", [None, ("b",)])
def test_a_large_batch_is_merged_with_one_shuffle_of_each_side(spark, folder, monkeypatch, update):
    monkeypatch.setattr("ombuds.operators.upsert.BROADCAST_BYTES", 0)
    monkeypatch.setattr("ombuds.operators.tables.TASK_BYTES", 2000)
    monkeypatch.setattr("ombuds.operators.tables.FIRST_KEYS", 2)
    table = VersionedTable(spark, f"{folder}/t", frame(spark, []).schema, "k", buckets=4)
    old = [(f"k{i}", f"a{i}", "old", DAY[0]) for i in range(60)] + [(None, "x", "old", DAY[0])] * 3
    new = [(f"k{i}", f"c{i}", "new", DAY[1]) for i in range(30, 90)] + [(None, "y", "new", DAY[1])]
    table.replace(frame(spark, old))
    published, publish = [], table._publish
    monkeypatch.setattr(table, "_publish", lambda df, *more, **named: published.append(plan(df)) or publish(df, *more, **named))
    table.merge(frame(spark, new), update)
    assert rows(table.read()) == rows(upsert(frame(spark, old), frame(spark, new), "k", update))
    assert "Join" not in published[0] and published[0].count("Exchange") == 1
    in_file = table.read().selectExpr("_metadata.file_path file", "k").where("k is not null").groupBy("k").count()
    assert in_file.where("count > 1").isEmpty()


@pytest.mark.parametrize("buckets", [1, 2])
def test_stored_digests_take_no_more_than_their_bits_need(spark, folder, tmp_path, buckets):
    """Keys of the fact are digests in hexadecimal: 16 bytes of each are told by 32 characters."""
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("key"))
    table = VersionedTable(spark, f"{folder}/table", keys.schema, "key" if buckets > 1 else None, buckets)
    table.replace(keys)
    size = sum(file.stat().st_size for file in tmp_path.glob("table/data/**/*.parquet"))
    assert table.read().count() == 20_000 and size < 20_000 * 24


@pytest.mark.parametrize("few", [True, False])
def test_erase_leaves_rows_in_their_buckets_without_a_shuffle(spark, folder, monkeypatch, few):
    monkeypatch.setattr("ombuds.operators.tables.BROADCAST_BYTES", 1 << 20 if few else -1, raising=False)
    stored = VersionedTable(spark, f"{folder}/t", frame(spark, []).schema, "k", buckets=4, cluster=AUDIT, file_rows=7)
    data = [(f"k{i}", f"a{i % 5}", "", DAY[i % 3]) for i in range(60)] + [(None, "a1", "x", DAY[0]), (None, "a2", "y", DAY[0])]
    stored.replace(frame(spark, data))
    hints, kind = [], type(frame(spark, []))
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda df, name, *more: hints.append(name) or hint(df, name, *more))
    stored.erase(spark.createDataFrame([("a1",), (None,)], "who string"), "a")
    assert ("rebalance" in hints) is not few
    assert rows(stored.read()) == rows(frame(spark, [row for row in data if row[1] != "a1"]))
    placed = stored._rows(stored._live()[1], with_place=True).select("bucket", stored._bucket_of().alias("own"))
    assert placed.where("bucket <> own").isEmpty()
    assert rows(stored.read_between(DAY[0].date(), DAY[0].date())) == rows(
        frame(spark, [row for row in data if row[1] != "a1" and row[3] == DAY[0]])
    )


def test_bitmaps_are_grouped_by_one_number(spark, folder):
    """Sorted for by one number, and the same bitmaps as by three columns."""
    table = VersionedTable(spark, f"{folder}/t", T.StructType([T.StructField("k", T.StringType())]), "k", buckets=3)
    keys = spark.range(200).select(F.when(F.col("id") % 9 != 0, F.col("id").cast("string")).alias("k"))
    keyed = keys.withColumn("bucket", table._bucket_of()).withColumn("parts", F.explode(F.array(F.lit(1), F.lit(8))))
    found = table._bits(keyed, F.col("parts"))
    hashed = F.xxhash64("k", F.lit("bitmap"))
    part = F.pmod(F.shiftrightunsigned(hashed, 20), F.col("parts")).cast("int").alias("part")
    bits = keyed.where("k is not null").select("bucket", "parts", part, hashed.bitwiseAND(F.lit(32767)).alias("bit"))
    want = bits.groupBy("bucket", "parts", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    assert sorted(found.collect()) == sorted(want.collect()) and found.schema.names == want.schema.names
    sorts = [line.split("Sort [")[1].split("], ")[0] for line in plan(found).splitlines() if " Sort [" in line]
    assert sorts and all(by.startswith("place#") and "," not in by for by in sorts)


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
@pytest.mark.parametrize("update", [None, ("b",)])
def test_a_merge_in_waves_writes_what_one_wave_does(spark, folder, monkeypatch, update, broadcast):
    """Buckets after buckets, each time with their part of the staged batch alone, which then goes."""
    from ombuds.session import path_exists

    monkeypatch.setattr("ombuds.operators.upsert.BROADCAST_BYTES", broadcast)
    monkeypatch.setattr("ombuds.operators.tables.WAVE_BYTES", 3000)
    stored = VersionedTable(spark, f"{folder}/t", frame(spark, []).schema, "k", buckets=11, cluster=AUDIT)
    one = [(f"k{i % 50}", f"a{i}", "old", DAY[i % 3]) for i in range(70)] + [(None, f"x{i}", "old", DAY[i]) for i in range(3)]
    two = [(f"k{i % 60 + 30}", f"c{i}", "new", DAY[3 + i % 2]) for i in range(80)] + [(None, f"y{i}", "new", DAY[i]) for i in range(3)]
    left, write = [], VersionedTable._write
    staged, slices = [], VersionedTable._sliced
    monkeypatch.setattr(VersionedTable, "_sliced", lambda self, batch: staged.append(slices(self, batch)) or staged[-1])

    def writes(self, *args):
        left.append(sum(path_exists(spark, f"{staged[-1][2]}/_slice={number}") for number in range(8)))
        return write(self, *args)

    monkeypatch.setattr(VersionedTable, "_write", writes)
    stored.merge(frame(spark, one), update)
    assert len(left) > 2 and left == sorted(set(left), reverse=True)
    first = latest_per_key(frame(spark, one), "k")
    assert rows(stored.read()) == rows(first)
    left.clear()
    stored.merge(frame(spark, two), update)
    assert len(left) > 2 and left == sorted(set(left), reverse=True)
    assert rows(stored.read()) == rows(upsert(first, latest_per_key(frame(spark, two), "k"), "k", update))
    assert [row.rows for row in stored.counts().orderBy("version").collect()] == [51, 92]
    placed = stored._rows(stored._live()[1], with_place=True).select("bucket", stored._bucket_of().alias("own"))
    assert placed.where("bucket <> own").isEmpty()


def test_merges_leave_no_shuffles_of_rows(spark, folder):
    """Those of the pointer are a few rows."""

    def shuffled():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        files = [found.apply(i) for i in range(found.size())]
        return {file.getName(): file.length() for file in files if file.getName().startswith("shuffle_")}

    before = shuffled()
    stored = table(spark, folder)
    digests = [hashlib.md5(str(i).encode()).hexdigest() for i in range(3000)]
    for day in range(2):
        stored.merge(frame(spark, [(digest, "a", "", DAY[day]) for digest in digests]))
    deadline = time.monotonic() + 20  # they are deleted a moment later
    while (left := sum(size for name, size in shuffled().items() if name not in before)) > 30_000 and time.monotonic() < deadline:
        time.sleep(0.2)
    assert left <= 30_000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
