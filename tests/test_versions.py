"""Warehouse tables in parts: shared folders, key index, concurrent commits, cleaning; and the journal of runs."""

import json
import re
import threading
import time
import uuid
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bookpipe.operators.align import align, with_record_date
from bookpipe.plans import nightly
from bookpipe.plans.nightly import Zones, run_batch
from bookpipe.schemas import ENTITIES, RECORD_DATE, TS
from bookpipe.sources import versions
from bookpipe.sources.commits import Commits, Files
from bookpipe.sources.tables import Layers, create_databases, create_tables, publish_days, read_day, replace_day, stage_day
from bookpipe.sources.versions import VersionedTable
from test_batch import DAY, FILES, land

REVIEWS, USERS = ENTITIES["reviews"], ENTITIES["users"]
FEW = 1_000


@pytest.fixture
def database(spark, tmp_path):
    name = f"w_{uuid.uuid4().hex[:8]}"
    create_databases(spark, [name], str(tmp_path))
    return name


@pytest.fixture
def zones(tmp_path):
    run = uuid.uuid4().hex[:8]
    (tmp_path / "landing").mkdir()
    return Zones(str(tmp_path / "landing"), str(tmp_path), Layers(f"s_{run}", f"w_{run}", f"a_{run}"))


def reviews(spark, rows):
    """(key, text, day of January 2024 or None)"""
    frame = spark.createDataFrame([(k, t, None if d is None else datetime(2024, 1, d, 12)) for k, t, d in rows], "review_id long, review_text string, record_create_timestamp timestamp_ntz")
    return with_record_date(align(frame, REVIEWS.warehouse))


def users(spark, rows):
    return align(spark.createDataFrame(rows, "user_id long, user_name string"), USERS.warehouse)


def open_reviews(spark, database):
    table = VersionedTable(spark, f"{database}.reviews", REVIEWS.warehouse, "review_id", dated=True)
    table.register()
    return table


def open_users(spark, database):
    table = VersionedTable(spark, f"{database}.users", USERS.warehouse, "user_id")
    table.register()
    return table


def upsert(table, rows, tmp_path, ignored=(), few=FEW, run=None):
    return table.upsert(rows, run or uuid.uuid4().hex[:8], str(tmp_path / "scratch" / uuid.uuid4().hex), few, ignored)


def content(spark, table):
    names = {"reviews": ("review_id", "review_text", RECORD_DATE), "users": ("user_id", "user_name")}[table.name]
    return Counter((row[0], row[1], *(d and d.day for d in row[2:])) for row in spark.table(table.table).select(*names).collect())


def files_of(table):
    """The files of each part of the current version."""
    return {part: sorted(path.name for path in Path(table.home.removeprefix("file:"), folder).glob("*.parquet"))
            for part, (folder, _) in table.current().parts.items()}


@pytest.mark.parametrize("few", [0, FEW])
def test_files_of_untouched_days_keep_their_names(spark, database, tmp_path, monkeypatch, few):
    monkeypatch.setattr(versions, "ROWS_PER_PART", 1)
    table = open_reviews(spark, database)
    assert content(spark, table) == Counter()
    rows = [(k, f"t{k}", 1 + k % 9) for k in range(90)]
    assert upsert(table, reviews(spark, rows), tmp_path, few=few)
    first, files = table.current(), files_of(table)
    assert first.span == 1 and len(first.parts) == 9 and first.rows == 90
    assert content(spark, table) == Counter(rows)
    # Key 0 changes, key 1 moves to another day, key 900 is new on a new day.
    assert upsert(table, reviews(spark, [(0, "new", 1), (1, "t1", 7), (2, "t2", 3), (900, "x", 20)]), tmp_path, few=few)
    changed = {k: (k, t, d) for k, t, d in rows} | {0: (0, "new", 1), 1: (1, "t1", 7), 900: (900, "x", 20)}
    assert content(spark, table) == Counter(changed.values())
    later = files_of(table)
    day = {part: (int(part) - (datetime(2024, 1, 1) - datetime(1970, 1, 1)).days + 1) for part in later}
    assert {day[part] for part in later if later[part] != files.get(part)} == {1, 2, 7, 20}
    assert table.current().rows == 91
    # The version before is still there.
    assert table.read(first).count() == 90


def test_nothing_is_written_when_nothing_differs(spark, database, tmp_path):
    table = open_reviews(spark, database)
    rows = reviews(spark, [(1, "a", 1), (2, None, 2), (2, None, 2), (3, "", None)])
    assert upsert(table, rows, tmp_path)
    before = sorted(str(path) for path in (tmp_path / database).rglob("*") if path.is_file())
    assert not upsert(table, rows, tmp_path)
    assert not upsert(table, reviews(spark, [(3, "", None)]), tmp_path)
    assert sorted(str(path) for path in (tmp_path / database).rglob("*") if path.is_file()) == before
    # Rows that repeat count, and null is not empty.
    assert upsert(table, reviews(spark, [(2, None, 2)]), tmp_path) and upsert(table, reviews(spark, [(3, None, None)]), tmp_path)
    assert content(spark, table) == Counter([(1, "a", 1), (2, None, 2), (3, None, None)])


def test_many_nights_equal_a_dictionary(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "ROWS_PER_PART", 3)
    monkeypatch.setattr(versions, "GENERATIONS", 2)
    reviewed, people = open_reviews(spark, database), open_users(spark, database)
    expected, names = {}, {}
    for night in range(6):
        rows = [(k, f"t{k}-{(k + night) // 5}", 1 + (k * 7 + night // 3) % 20) for k in range(night * 5, night * 5 + 25)]
        upsert(reviewed, reviews(spark, rows), tmp_path, few=FEW if night % 2 else 0)
        expected |= {row[0]: row for row in rows}
        assert content(spark, reviewed) == Counter(expected.values())
        assert len(reviewed.current().index) <= 3
        rows = [(k, f"n{k % 3}{night // 2}") for k in range(0, 8 * (night + 1) ** 2, 1 + night)]
        upsert(people, users(spark, rows), tmp_path)
        names |= dict(rows)
        assert content(spark, people) == Counter(names.items())
    # More keys than the first parts were meant for; parts hold keys that follow each other.
    version = people.current()
    assert len(version.parts) > 8 and max(rows for _, rows in version.parts.values()) < 30
    ranges = sorted(people.read(version, [part]).agg(F.min("user_id"), F.max("user_id")).first()[:] for part in list(version.parts)[:6])
    assert all(a[1] < b[0] for a, b in zip(ranges[:-1], ranges[1:], strict=True))


def test_keys_at_the_ends_of_their_type(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "ROWS_PER_PART", 2)
    table = open_users(spark, database)
    rows = [(-(2**63), "least"), (2**63 - 1, "greatest"), (0, "zero"), *((k, f"n{k}") for k in range(10**12, 10**12 + 40))]
    upsert(table, users(spark, rows[2:]), tmp_path)
    upsert(table, users(spark, rows[:2]), tmp_path)
    assert content(spark, table) == Counter(rows)
    assert upsert(table, users(spark, [(2**63 - 1, "changed")]), tmp_path) and not upsert(table, users(spark, rows[:1]), tmp_path)


def test_a_table_that_began_small_is_divided_anew(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "ROWS_PER_PART", 4)
    table = open_reviews(spark, database)
    expected = {}
    for night, size in enumerate((1, 60, 61, 62)):
        rows = [(k, f"t{k}", 1 + k % 30) for k in range(size)]
        upsert(table, reviews(spark, rows), tmp_path)
        expected |= {row[0]: row for row in rows}
        assert content(spark, table) == Counter(expected.values())
    assert len(table.current().parts) > 5


def test_null_keys_are_added(spark, database, tmp_path):
    table = open_reviews(spark, database)
    upsert(table, reviews(spark, [(1, "a", 1), (None, "b", 1)]), tmp_path)
    upsert(table, reviews(spark, [(None, "c", 2)]), tmp_path)
    assert content(spark, table) == Counter([(1, "a", 1), (None, "b", 1), (None, "c", 2)])


def test_ignored_columns_make_no_change(spark, database, tmp_path):
    table = open_users(spark, database)
    rows = users(spark, [(1, "a"), (2, "b")])
    assert upsert(table, rows.withColumn(TS, F.localtimestamp()), tmp_path, ignored=(TS,))
    assert not upsert(table, rows.withColumn(TS, F.localtimestamp()), tmp_path, ignored=(TS,))
    assert upsert(table, rows.withColumn(TS, F.localtimestamp()), tmp_path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_index_is_joined_where_it_lies(spark, database, tmp_path):
    table = open_reviews(spark, database)
    for night in range(3):
        upsert(table, reviews(spark, [(k, f"t{night}", 1) for k in range(night, 50)]), tmp_path)
    version = table.current()
    assert len(version.index) == 3
    plan = plan_of(table.changed_keys(version, reviews(spark, [(1, "x", 1)])))
    # The new rows' marks are grouped and dealt into the buckets; that is all that moves.
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 2 and "BroadcastExchange" not in plan
    scans = re.findall(r"FileScan parquet (\S+?)\[([^\]]*)\]", plan)
    assert len(scans) == 3 and all("__index_" in name for name, _ in scans)
    assert {re.sub(r"#\d+L?", "", column) for _, columns in scans for column in columns.split(",")} == {"key", "n", "high", "low", "days"}
    assert plan.count("Bucketed: true") == 3


def test_a_ranking_opens_its_days_only(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "ROWS_PER_PART", 1)
    table = open_reviews(spark, database)
    upsert(table, reviews(spark, [(k, "t", 1 + k) for k in range(20)]), tmp_path)
    rows = table.between("2024-01-10 00:00:00.000000", "2024-01-10 23:59:59.999999")
    assert [row.review_id for row in rows.collect()] == [9]
    assert len(rows.inputFiles()) == 1
    assert table.between("2023-01-01", "2023-12-31").isEmpty()


def test_a_number_is_given_once(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "log"))
    won, gate = [], threading.Barrier(8)

    def race(me):
        gate.wait()
        if commits.commit(1, {"by": me}):
            won.append(me)

    threads = [threading.Thread(target=race, args=(n,)) for n in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == 1 and commits.latest()[1]["by"] == won[0]
    for n in range(5):
        commits.change(lambda known: {**known, f"k{n}": n})
    assert commits.latest()[0] == 6 and not [name for name in commits.files.names() if name.startswith(".") and not name.endswith(".crc")]


def test_an_upsert_that_is_overtaken_starts_again(spark, database, tmp_path, monkeypatch):
    table, other = open_reviews(spark, database), open_reviews(spark, database)
    upsert(table, reviews(spark, [(1, "a", 1), (2, "b", 2)]), tmp_path)
    commit, tries = VersionedTable._commit, []

    def slow(self, version):
        tries.append(version.number)
        if len(tries) == 1:
            # Another run changes key 1 and adds key 3 meanwhile.
            assert upsert(other, reviews(spark, [(1, "theirs", 1), (3, "theirs", 3)]), tmp_path)
        return commit(self, version)

    monkeypatch.setattr(VersionedTable, "_commit", slow)
    assert upsert(table, reviews(spark, [(2, "ours", 5), (4, "ours", 1)]), tmp_path)
    assert tries == [2, 2, 3]
    assert content(spark, table) == Counter([(1, "theirs", 1), (3, "theirs", 3), (2, "ours", 5), (4, "ours", 1)])


def test_two_nights_over_one_root_at_once(spark, zones, tmp_path):
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    header = FILES["reviews.csv"].split("\n")[0] + "\n"
    errors = []

    def night(key):
        try:
            landing = tmp_path / f"landing{key}"
            landing.mkdir()
            (landing / "reviews.csv").write_text(header + f"{key},7,10,1,night {key},5,,,u,2024-01-11 10:00:00\n101,8,10,1,changed,5,,,u,2024-01-11 10:00:00\n")
            run_batch(spark, Zones(str(landing), zones.root, zones.layers), "2024-01-11" if key == 200 else DAY)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=night, args=(key,)) for key in (200, 300)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    texts = {row.review_id: row.review_text for row in spark.table(f"{zones.layers.warehouse}.reviews").collect()}
    assert texts[200] == "night 200" and texts[300] == "night 300" and texts[101] == "changed" and texts[102] == "ok" and len(texts) == 7
    days = {str(row.ds) for row in spark.table(f"{zones.layers.analytics}.popular_authors_review_count").collect()}
    assert days == {DAY, "2024-01-11"}


def test_old_versions_go_unless_they_are_leased(spark, database, tmp_path):
    table = open_reviews(spark, database)
    for night in range(5):
        upsert(table, reviews(spark, [(k, f"t{night}", 1) for k in range(20)]), tmp_path)
    assert table.commits.numbers() == [1, 2, 3, 4, 5]
    table.clean()
    assert table.commits.numbers() == [1, 2, 3, 4, 5]
    table.commits.lease("reader", 3)
    (tmp_path / database / "reviews__left" / "part=1").mkdir(parents=True)
    time.sleep(0.05)
    table.clean(seconds=0)
    assert table.commits.numbers() == [3, 4, 5]
    assert not (tmp_path / database / "reviews__left").exists()
    assert table.read(versions.Version(3, **{k: v for k, v in table.commits.read(3).items() if k != "made"})).count() == 20
    table.commits.release("reader")
    table.commits.lease("ended", 1, seconds=-1)
    table.clean(seconds=0)
    assert table.commits.numbers() == [4, 5] and table.commits.leased() == {}
    assert len(list((tmp_path / database).glob("reviews__*"))) == 2
    assert content(spark, table) == Counter((k, "t4", 1) for k in range(20))
    # The index of later nights is made of all its tables.
    assert not upsert(table, reviews(spark, [(5, "t4", 1)]), tmp_path)


def test_another_session_finds_the_versions(spark, database, tmp_path):
    upsert(open_reviews(spark, database), reviews(spark, [(1, "a", 1)]), tmp_path)
    other = spark.newSession()
    name = f"o_{uuid.uuid4().hex[:8]}"
    other.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / database}'")
    table = open_reviews(other, name)
    assert content(other, table) == Counter([(1, "a", 1)])
    assert not upsert(table, reviews(other, [(1, "a", 1)]), tmp_path)


def test_the_layout_of_earlier_releases_is_taken_over(spark, tmp_path):
    run = uuid.uuid4().hex[:8]
    layers = Layers(f"s_{run}", f"w_{run}", f"a_{run}")
    create_databases(spark, layers.all, str(tmp_path))
    warehouse, analytics = tmp_path / layers.warehouse, tmp_path / layers.analytics
    reviews(spark, [(1, "a", 1), (2, "b", 2)]).write.parquet(str(warehouse / "reviews__20240101"))
    (warehouse / "_current_reviews").write_text("reviews__20240101")
    spark.createDataFrame([(7, 3)], "author_id long, review_count long").write.parquet(str(analytics / "popular_authors_review_count" / f"ds={DAY}"))
    for _ in range(2):
        create_tables(spark, layers)
        assert spark.table(f"{layers.warehouse}.reviews").count() == 2 and spark.table(f"{layers.warehouse}.users").count() == 0
        assert [(row.author_id, str(row.ds)) for row in spark.table(f"{layers.analytics}.popular_authors_review_count").collect()] == [(7, DAY)]
    assert not upsert(VersionedTable(spark, f"{layers.warehouse}.reviews", REVIEWS.warehouse, "review_id", True), reviews(spark, [(1, "a", 1)]), tmp_path)


# Days of the analytics tables

def test_a_day_is_published_by_one_commit(spark, tmp_path):
    run = uuid.uuid4().hex[:8]
    layers = Layers(f"s_{run}", f"w_{run}", f"a_{run}")
    create_databases(spark, layers.all, str(tmp_path))
    create_tables(spark, layers)
    one, two = (f"{layers.analytics}.{name}" for name in ("popular_authors_review_count", "popular_authors_average_rating"))

    def ranked(key):
        return spark.createDataFrame([(key, key * 10)], "author_id long, review_count long")

    def keys(table):
        return {(row.author_id, str(row.ds)) for row in spark.table(table).collect()}

    publish_days(spark, {one: stage_day(ranked(1), one, DAY), two: stage_day(ranked(1), two, DAY)}, DAY)
    staged = stage_day(ranked(2), one, DAY)
    assert [row.author_id for row in read_day(spark, one, staged).collect()] == [2]
    # What is staged and not published is not seen, in this session or in a new one.
    create_tables(spark, layers)
    assert keys(one) == keys(two) == {(1, DAY)}
    publish_days(spark, {one: staged, two: stage_day(ranked(3), two, DAY)}, DAY)
    assert keys(one) == {(2, DAY)} and keys(two) == {(3, DAY)}
    replace_day(ranked(9), one, "2024-01-11")
    assert keys(one) == {(2, DAY), (9, "2024-01-11")} and keys(two) == {(3, DAY)}


def test_a_ranking_that_fails_leaves_the_old_day(spark, zones, monkeypatch):
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    names = [f"{zones.layers.analytics}.{name}" for name in ("popular_authors_review_count", "popular_authors_average_rating", "best_authors")]
    before = {name: Counter(map(tuple, spark.table(name).collect())) for name in names}
    land(zones, {"reviews.csv": FILES["reviews.csv"].replace("101,8,10,1,fine,3", "101,8,20,2,fine,1")})

    def fails(*_):
        raise RuntimeError("third ranking")

    monkeypatch.setattr(nightly, "best", fails)
    with pytest.raises(RuntimeError, match="third ranking"):
        run_batch(spark, zones, DAY)
    assert {name: Counter(map(tuple, spark.table(name).collect())) for name in names} == before
    monkeypatch.undo()
    run_batch(spark, zones, DAY)
    assert {name: Counter(map(tuple, spark.table(name).collect())) for name in names} != before


# Journal

def runs(tmp_path):
    return sorted(path.name for path in (tmp_path / "_runs").iterdir()) if (tmp_path / "_runs").exists() else []


def test_a_failed_run_is_gone_on_with(spark, zones, tmp_path, monkeypatch):
    land(zones, FILES)
    load = nightly.load_warehouse

    def killed(spark, zones, entity, *more):
        if entity.name == "reviews":
            raise RuntimeError("killed")
        return load(spark, zones, entity, *more)

    monkeypatch.setattr(nightly, "load_warehouse", killed)
    with pytest.raises(RuntimeError, match="killed"):
        run_batch(spark, zones, DAY)
    (failed,) = runs(tmp_path)
    assert "failed.json" in Files(spark, f"{tmp_path}/_runs/{failed}").names()
    monkeypatch.undo()
    # Everything is processed already, so no raw file is read again.
    monkeypatch.setattr(nightly, "read_raw", lambda *_: pytest.fail("parsed again"))
    run_batch(spark, zones, DAY)
    assert runs(tmp_path) == [failed] and "done.json" in Files(spark, f"{tmp_path}/_runs/{failed}").names()
    assert spark.table(f"{zones.layers.warehouse}.reviews").count() == 5
    assert spark.table(f"{zones.layers.analytics}.best_authors").count() == 2


def test_another_run_removes_what_a_dead_one_left(spark, zones, tmp_path, monkeypatch):
    land(zones, FILES)

    def killed(df, path):
        df.write.parquet(path)
        raise RuntimeError("killed")

    monkeypatch.setattr(nightly, "write_processed", killed)
    with pytest.raises(RuntimeError, match="killed"):
        run_batch(spark, zones, DAY)
    monkeypatch.undo()
    (failed,) = runs(tmp_path)
    assert list((tmp_path / "processed").glob(f"*/{failed}"))
    # A process that was killed has said nothing, and is dead when its lease is over.
    journal = tmp_path / "_runs" / failed
    (journal / "failed.json").unlink()
    run_batch(spark, zones, "2024-01-11")
    assert failed in runs(tmp_path) and list((tmp_path / "processed").glob(f"*/{failed}"))
    start = json.loads((journal / "start.json").read_text())
    (tmp_path / "kept").mkdir()
    (journal / ".start.json.crc").unlink(missing_ok=True)
    (journal / "start.json").write_text(json.dumps(start | {"until": 0, "application": "other", "checkpoints": str(tmp_path / "kept")}))
    run_batch(spark, zones, "2024-01-11")
    assert failed not in runs(tmp_path) and not list(tmp_path.glob(f"*/*/{failed}")) and not (tmp_path / "kept").exists()


@pytest.mark.parametrize("processed_csv", [False, True])
def test_unchanged_files_are_not_read_again(spark, zones, monkeypatch, processed_csv):
    zones = Zones(zones.landing, zones.root, zones.layers, processed_csv, changed_only=True)
    land(zones, FILES)
    run_batch(spark, zones, DAY)

    def warehouse():
        return {name: Counter(map(tuple, spark.table(f"{zones.layers.warehouse}.{name}").collect())) for name in ENTITIES}

    before, read, parsed = warehouse(), nightly.read_raw, []
    monkeypatch.setattr(nightly, "read_raw", lambda spark, path, entity: parsed.append(entity.name) or read(spark, path, entity))
    run_batch(spark, zones, "2024-01-11")
    assert parsed == [] and warehouse() == before
    assert spark.table(f"{zones.layers.staging}.reviews").count() == 5
    land(zones, {"reviews.csv": FILES["reviews.csv"].replace("fine", "changed")})
    run_batch(spark, zones, "2024-01-11")
    assert parsed == ["reviews"] and warehouse() != before
    # A run that takes other files in between makes the first ones new again.
    land(zones, FILES)
    run_batch(spark, zones, "2024-01-11")
    assert set(parsed[1:]) == set(ENTITIES)
    assert {name: rows for name, rows in warehouse().items() if name != "users"} == {name: rows for name, rows in before.items() if name != "users"}


def test_processed_csv_folders_do_not_pile_up(spark, zones, tmp_path):
    land(zones, FILES)
    for _ in range(3):
        run_batch(spark, Zones(zones.landing, zones.root, zones.layers, processed_csv=True), DAY)
    assert all(len(list(folder.iterdir())) == 2 for folder in (tmp_path / "processed").iterdir())


def test_layouts_are_kept(spark, database):
    table = open_users(spark, database)
    assert spark.table(table.table).schema == StructType(USERS.warehouse.fields)


def test_marks_are_grouped_by_hash_with_all_days(spark, database):
    table = open_reviews(spark, database)
    marks = table._marks(reviews(spark, [(1, "a", 1), (2, "a", 1), (2, "b", 5), (3, "a", 1), (3, "b", 3), (3, "c", 4)]))
    assert "ObjectHashAggregate" not in plan_of(marks) and "SortAggregate" not in plan_of(marks)
    first = (datetime(2024, 1, 1) - datetime(1970, 1, 1)).days
    days = {row.key: [day - first for day in row.days] for row in marks.collect()}
    assert days == {1: [0], 2: [0, 4], 3: [0, 1, 2, 3]}
    dateless = reviews(spark, [(1, "a", 1)]).unionByName(reviews(spark, [(1, "b", 1), (2, "c", 1)]).withColumn("record_date", F.lit(None).cast("date")))
    assert {row.key: row.days for row in table._marks(dateless).collect()} == {1: [first, versions.NO_DAY], 2: [versions.NO_DAY]}


def test_parts_of_near_and_far_keys(spark):
    keys = [-(1 << 63), -(1 << 61) - 1, -8, -7, -1, 0, 6, 7, (1 << 61) + 1, (1 << 63) - 1]
    rows = spark.createDataFrame([(key,) for key in keys], "key long")
    for origin, span in ((0, 7), (-3, 7), ((1 << 62), 5), (5, 10**18)):
        got = {row.key: row.part for row in rows.select("key", versions.VersionedTable._part_of(F.col("key"), origin, span).alias("part")).collect()}
        assert got == {key: (key - origin) // span for key in keys if -(1 << 63) <= (key - origin) // span < 1 << 63}


def test_the_first_index_is_written_by_one_shuffle(spark, database, tmp_path):
    """The hashes of the rows are dealt into the buckets and grouped there; no changed keys are written beside the index."""
    table = open_reviews(spark, database)
    plan = plan_of(table._marks(reviews(spark, [(1, "x", 1)]), buckets=8))
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 1
    rows = [(1, "a", 1), (2, "a", 1), (2, "b", 5), (3, None, None), (None, "n", 2)]
    scratch = tmp_path / "scratch"
    assert table.upsert(reviews(spark, rows), "first", str(scratch), FEW) and not scratch.exists()
    version = table.current()
    stored = spark.table(table._generation(version.index[0], version.buckets))
    fields = ("key", "n", "high", "low", "days")
    assert sorted(map(tuple, stored.select(*fields).collect())) == sorted(map(tuple, table._marks(reviews(spark, rows)).select(*fields).collect()))
    assert content(spark, table) == Counter((k, t, d) for k, t, d in rows)
    # The same rows change nothing; another text does.
    assert not upsert(table, reviews(spark, rows[:-1]), tmp_path)
    assert upsert(table, reviews(spark, [(1, "z", 1)]), tmp_path) and content(spark, table)[1, "z", 1] == 1


def test_a_view_is_there_while_it_is_pointed_elsewhere(spark, database):
    name, errors, done = f"{database}.moving", [], threading.Event()
    versions.point_view(spark, name, "SELECT 0 AS a")

    def read():
        while not done.is_set():
            try:
                spark.table(name)
            except Exception as error:  # noqa: BLE001
                errors.append(error)

    def point(first):
        try:
            for n in range(first, first + 40):
                versions.point_view(spark, name, f"SELECT {n} AS a, {n} AS b")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    reader, *writers = [threading.Thread(target=read), *(threading.Thread(target=point, args=(n,)) for n in (100, 200))]
    for thread in (reader, *writers):
        thread.start()
    for thread in writers:
        thread.join()
    done.set()
    reader.join()
    assert not errors and spark.table(name).first().b in (139, 239)
