"""The whole batch on small CSV files: idempotence, changed records, missing sources, gates."""

import os
import subprocess
import sys
import uuid
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bookpipe.operators.quality import EmptyTableError
from bookpipe.plans.nightly import Zones, run_batch
from bookpipe.schemas import ANALYTICS, ENTITIES, RECORD_DATE
from bookpipe.session import partitions_for, shuffles_for, INITIAL_PARTITIONS
from bookpipe.sources.tables import Layers, create_databases, create_tables, publish, replace_day

DAY = "2024-01-10"
FILES = {
    "author.csv": "author_id,name,role,average_rating,ratings_count,text_reviews_count,record_create_timestamp\n"
                  "1, Ann   Lee ,writer,4.5,10,2,2024-01-01 00:00:00\n"
                  "1,Ann Old,writer,4.5,10,2,2023-01-01 00:00:00\n"
                  "2,Bob,editor,x,10,2,2024-01-01 00:00:00\n",
    "book.csv": "book_id,title,authors,published,record_create_timestamp\n"
                '10,"One, two",1,1999,2024-01-01 00:00:00\n'
                "20,Two,2,99999,2024-01-01 00:00:00\n",
    "user.csv": "user_id,user_name,has_image\n7,eve,true\n8,sam,no idea\n",
    "reviews.csv": "review_id,user_id,book_id,author_id,review_text,review_rating,review_added_date,"
                   "review_updated_date,review_url,record_create_timestamp\n"
                   '100,7,10,1,"good\n""very"" good",5,Wed Jan 10 08:00:00 -0800 2024,never,u,2024-01-10 09:00:00.123456\n'
                   "100,7,10,1,older,1,,,u,2024-01-10 08:00:00\n"
                   "101,8,10,1,fine,3,,,u,2024-01-10 10:00:00\n"
                   "102,8,20,2,ok,4,,,u,2024-01-10 11:00:00\n"
                   "103,8,20,2,midnight,1,,,u,2024-01-10 00:00:00\n"
                   "104,8,20,2,next day,1,,,u,2024-01-11 01:00:00\n",
}


@pytest.fixture
def zones(tmp_path):
    run = uuid.uuid4().hex[:8]
    landing = tmp_path / "landing"
    landing.mkdir()
    return Zones(str(landing), str(tmp_path), Layers(f"s_{run}", f"w_{run}", f"a_{run}"))


def land(zones, files):
    for name, text in files.items():
        with open(f"{zones.landing}/{name}", "w") as out:
            out.write(text)


def content(spark, zones):
    names = [f"{layer}.{name}" for layer in (zones.layers.staging, zones.layers.warehouse) for name in ENTITIES]
    names += [f"{zones.layers.analytics}.{name}" for name in ANALYTICS]
    return {name.split(".")[0][0] + "." + name.split(".")[1]: Counter(tuple(row) for row in spark.table(name).collect())
            for name in names}


@pytest.mark.parametrize("processed_csv", [False, True])
def test_batch(spark, zones, processed_csv):
    zones = Zones(zones.landing, zones.root, zones.layers, processed_csv)
    land(zones, FILES)
    # The users source has no timestamp column, so its load time differs between runs.
    land(zones, {"user.csv": "user_id,user_name,has_image,record_create_timestamp\n"
                             "7,eve,true,2024-01-01\n8,sam,no idea,2024-01-01\n", "notes.csv": "x\n"})
    assert run_batch(spark, zones, DAY)
    first = content(spark, zones)
    assert run_batch(spark, zones, DAY)
    assert content(spark, zones) == first

    warehouse = zones.layers.warehouse
    names = {row.author_id: (row.name, row.average_rating) for row in spark.table(f"{warehouse}.authors").collect()}
    assert names == {1: ("Ann Lee", 4.5), 2: ("Bob", None)}
    books = {row.book_id: (row.title, row.published) for row in spark.table(f"{warehouse}.books").collect()}
    assert books == {10: ("One, two", 1999), 20: ("Two", None)}
    reviews = {row.review_id: row for row in spark.table(f"{warehouse}.reviews").collect()}
    assert set(reviews) == {100, 101, 102, 103, 104}
    assert reviews[100].review_text == 'good\n"very" good'
    assert reviews[100].review_added_date == datetime(2024, 1, 10, 8)
    assert reviews[100].review_update_date is None
    assert reviews[100].record_create_timestamp == datetime(2024, 1, 10, 9, 0, 0, 123000)
    assert reviews[104].record_date == date(2024, 1, 11)
    assert spark.table(f"{warehouse}.reviews").columns == [*ENTITIES["reviews"].warehouse.names, RECORD_DATE]

    def ranked(table, value):
        rows = spark.table(f"{zones.layers.analytics}.{table}").collect()
        assert {row.ds for row in rows} == {date.fromisoformat(DAY)}
        return {row[0]: row[value] for row in rows}

    # Midnight is outside the strict window, so author 2 and book 20 have one review that day.
    assert ranked("popular_authors_review_count", "review_count") == {1: 2, 2: 1}
    assert ranked("popular_authors_average_rating", "average_review_rating") == {1: 4.0, 2: 4.0}
    assert ranked("best_authors", "review_count") == {1: 2, 2: 1}
    assert ranked("popular_books_review_count", "review_count") == {10: 2, 20: 1}
    assert ranked("best_books", "average_reviews_rating") == {10: 4.0, 20: 4.0}


def test_next_day_changes_add_up(spark, zones):
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    header = FILES["reviews.csv"].split("\n")[0] + "\n"
    land(zones, {"reviews.csv": header + "101,8,10,1,changed,5,,,u,2024-01-11 10:00:00\n"
                                         "105,8,20,2,new,2,,,u,2024-01-11 10:00:00\n"})
    run_batch(spark, zones, "2024-01-11")
    texts = {row.review_id: row.review_text for row in spark.table(f"{zones.layers.warehouse}.reviews").collect()}
    assert texts == {100: 'good\n"very" good', 101: "changed", 102: "ok", 103: "midnight", 104: "next day", 105: "new"}
    table = spark.table(f"{zones.layers.analytics}.popular_authors_review_count")
    assert {(str(row.ds), row.author_id, row.review_count) for row in table.collect()} == {
        (DAY, 1, 2), (DAY, 2, 1), ("2024-01-11", 2, 2), ("2024-01-11", 1, 1)}


def test_many_replaced_keys_take_the_other_way(spark, zones, monkeypatch):
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    before = content(spark, zones)
    monkeypatch.setattr("bookpipe.plans.nightly.BROADCAST_KEYS", 0)
    # Changed and changed back, so that every night replaces keys.
    land(zones, {"reviews.csv": FILES["reviews.csv"].replace("fine", "changed")})
    run_batch(spark, zones, DAY)
    assert content(spark, zones)["w.reviews"] != before["w.reviews"]
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    after = content(spark, zones)
    # The users source carries no timestamp: its rows get the time of each load.
    assert {name: rows for name, rows in after.items() if not name.endswith(".users")} == {
        name: rows for name, rows in before.items() if not name.endswith(".users")}
    assert sum(after["w.users"].values()) == 2


def test_a_night_without_changes_writes_no_version(spark, zones, tmp_path):
    land(zones, FILES)

    def versions(name):
        return sorted(path.name for path in (tmp_path / zones.layers.warehouse).glob(f"{name}__*"))

    run_batch(spark, zones, DAY)
    before = versions("reviews")
    run_batch(spark, zones, DAY)
    assert versions("reviews") == before
    land(zones, {"reviews.csv": FILES["reviews.csv"].replace("fine", "changed")})
    run_batch(spark, zones, DAY)
    assert versions("reviews") != before
    for zone in ("working", "changed", "merged"):
        assert not list((tmp_path / zone).rglob("*.parquet"))


def test_a_failed_run_leaves_staging(spark, zones, monkeypatch):
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    before = content(spark, zones)

    def fails(rows, path):
        rows.select(F.raise_error(F.lit("lost")).cast("string").alias("x")).write.parquet(path)

    monkeypatch.setattr("bookpipe.plans.nightly.write_processed", fails)
    with pytest.raises(Exception, match="lost"):
        run_batch(spark, zones, DAY)
    assert content(spark, zones) == before


def nightly(tmp_path, landing, ds):
    """One night in a process of its own, as a scheduler runs it."""
    command = [sys.executable, "-m", "bookpipe", "--landing", landing, "--root", "root", "--ds", ds]
    paths = {"PYTHONPATH": str(Path(__file__).resolve().parents[1]), "SPARK_LOCAL_IP": "127.0.0.1"}
    return subprocess.run(command, cwd=tmp_path, env=os.environ | paths, capture_output=True, text=True, timeout=300)


def test_nights_in_processes_of_their_own(spark, tmp_path):
    for night, key in (("one", 1), ("two", 2)):
        (tmp_path / night).mkdir()
        day = f"2024-01-{9 + key}"
        rows = {
            "author.csv": f"AUTHOR_ID,Name,record_create_timestamp\n{key},name {key},{day} 01:00:00\n",
            "book.csv": f"book_id,title,authors,record_create_timestamp\n{key},title {key},{key},{day} 01:00:00\n",
            "user.csv": f"user_id,user_name,record_create_timestamp\n{key},user {key},{day} 01:00:00\n",
            "reviews.csv": f"review_id,user_id,book_id,author_id,review_rating,record_create_timestamp\n{key},{key},{key},{key},4.0,{day} 01:00:00\n",
        }
        for name, text in rows.items():
            (tmp_path / night / name).write_text(text)
        done = nightly(tmp_path, night, day)
        assert done.returncode == 0, done.stderr[-3000:]
    layers = Layers("s_two", "warehouse", "a_two")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS warehouse LOCATION '{tmp_path}/root/warehouse'")
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS a_two LOCATION '{tmp_path}/root/analytics'")
        create_tables(spark, layers)
        assert sorted(map(tuple, spark.table("warehouse.authors").select("author_id", "name").collect())) == [(1, "name 1"), (2, "name 2")]
        assert spark.table("warehouse.reviews").count() == 2
        for name in ANALYTICS:
            assert {str(row.ds) for row in spark.table(f"a_two.{name}").select("ds").collect()} == {"2024-01-10", "2024-01-11"}
        # The current version and the one before.
        assert len(list((tmp_path / "root/warehouse").glob("reviews__*"))) == 2
    finally:
        for name in ("warehouse", "a_two"):
            spark.sql(f"DROP DATABASE {name} CASCADE")
    (tmp_path / "none").mkdir()
    (tmp_path / "none/notes.txt").write_text("x")
    assert nightly(tmp_path, "none", "2024-01-12").returncode == 2


def test_a_missing_source_leaves_its_warehouse_table(spark, zones, tmp_path):
    land(zones, FILES)
    run_batch(spark, zones, DAY)
    before = content(spark, zones)
    later = Zones(str(tmp_path / "later"), zones.root, zones.layers)
    (tmp_path / "later").mkdir()
    land(later, {"author.csv": FILES["author.csv"]})
    assert run_batch(spark, later, DAY)
    after = content(spark, later)
    assert {name: rows for name, rows in after.items() if not name.startswith("s.")} == {
        name: rows for name, rows in before.items() if not name.startswith("s.")}
    assert after["s.authors"] == before["s.authors"] and not after["s.reviews"]


def test_nothing_registered_means_nothing_runs(spark, zones):
    land(zones, {"notes.csv": "x\n1\n"})
    assert not run_batch(spark, zones, DAY)
    assert not spark.catalog.databaseExists(zones.layers.warehouse)


def test_an_empty_warehouse_table_stops_the_batch(spark, zones):
    land(zones, {name: text for name, text in FILES.items() if name != "book.csv"})
    with pytest.raises(EmptyTableError, match="books"):
        run_batch(spark, zones, DAY)


def test_a_day_without_reviews_stops_a_first_batch(spark, zones):
    land(zones, FILES)
    with pytest.raises(EmptyTableError, match="popular_authors_review_count"):
        run_batch(spark, zones, "2020-01-01")


# Tables

@pytest.fixture
def layers(spark, tmp_path):
    run = uuid.uuid4().hex[:8]
    layers = Layers(f"s_{run}", f"w_{run}", f"a_{run}")
    create_databases(spark, layers.all, str(tmp_path))
    create_databases(spark, layers.all, str(tmp_path))
    return layers


def test_created_tables_have_the_fixed_layouts(spark, layers):
    create_tables(spark, layers)
    create_tables(spark, layers)
    for name, entity in ENTITIES.items():
        kinds = [(field.name, field.dataType.simpleString()) for field in entity.warehouse]
        kinds += [(RECORD_DATE, "date")] if entity.dated else []
        assert spark.table(f"{layers.warehouse}.{name}").dtypes == kinds
    for name, layout in ANALYTICS.items():
        assert spark.table(f"{layers.analytics}.{name}").dtypes == [
            *((field.name, field.dataType.simpleString()) for field in layout), ("ds", "date")]


def test_publish_replaces_and_keeps_two_versions(spark, layers):
    table = f"{layers.staging}.numbers"
    for n in range(4):
        publish(spark.range(n + 1), table)
        assert spark.table(table).count() == n + 1
    publish(spark.table(table).where("id > 0"), table)
    assert sorted(row.id for row in spark.table(table).collect()) == [1, 2, 3]
    assert len(spark.catalog.listTables(layers.staging, "numbers__*")) == 2


def test_a_failed_write_leaves_the_table(spark, layers):
    table = f"{layers.staging}.numbers"
    publish(spark.range(3), table)
    with pytest.raises(Exception):
        publish(spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("id")), table)
    assert spark.table(table).count() == 3


def test_replace_day(spark, layers):
    create_tables(spark, layers)
    name = "popular_authors_review_count"
    table = f"{layers.analytics}.{name}"

    def ranking(*keys):
        return spark.createDataFrame([(k, k * 10) for k in keys], "author_id long, review_count long")

    replace_day(ranking(1, 2), table, "2024-01-01")
    replace_day(ranking(3), table, "2024-01-02")
    replace_day(ranking(4), table, "2024-01-01")
    got = {(str(row.ds), row.author_id, row.review_count) for row in spark.table(table).collect()}
    assert got == {("2024-01-01", 4, 40), ("2024-01-02", 3, 30)}
    replace_day(ranking(4).where("false"), table, "2024-01-01")
    assert {str(row.ds) for row in spark.table(table).collect()} == {"2024-01-02"}
    with pytest.raises(ValueError):
        replace_day(ranking(1), table, "not a day")


def test_shuffle_sizing(spark):
    assert partitions_for(0, 200) == 200
    assert partitions_for(10 * 2**40, 200) == 100_000
    assert partitions_for(2**40, 200) == 16_384
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    with shuffles_for(spark, 2**40):
        assert spark.conf.get(INITIAL_PARTITIONS) == "16384"
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before
