"""The verification queries: every operator over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe import fixtures as fx
from bookpipe.functions.dates import parse_posted_date
from bookpipe.functions.text import remove_extra_spaces
from bookpipe.operators.align import align, with_load_time, with_record_date
from bookpipe.operators.latest import BROADCAST_KEYS, latest_lookup
from bookpipe.operators.quality import non_empty_report
from bookpipe.operators.timewindow import day_bounds, day_window, within
from bookpipe.operators.upsert import replaced, upsert
from bookpipe.plans.analytics import AUTHORS, BOOKS, best, popular_by_average, popular_by_count
from bookpipe.plans.clean import clean
from bookpipe.plans.nightly import Zones, run_batch
from bookpipe.schemas import ENTITIES, STAGING_REVIEWS, TS, WAREHOUSE_AUTHORS, WAREHOUSE_REVIEWS
from bookpipe.session import shared_folder
from bookpipe.sources.processed import read_processed_csv, write_processed_csv
from bookpipe.sources.raw import landing_report, read_raw
from bookpipe.sources.tables import Layers, create_databases, create_tables, publish, replace_day, warehouse_table

DAY, NEXT_DAY = "2024-01-10", "2024-01-11"
YEAR = ("1997-01-01 00:00:00", "1998-01-01 00:00:00")
BATCH_DAY = "1997-06-15"
BATCH_OFFSET = "0.123456"
UPSERT_SINCE = "2000-01-01"
AUTHORS_SINCE = "2001-10-25"
BOOKS_SINCE = "2001-10-01"


def _layers() -> Layers:
    """Databases of their own for one run, so that runs do not meet."""
    run = uuid.uuid4().hex[:12]
    return Layers(f"staging_{run}", f"warehouse_{run}", f"analytics_{run}")


def _since(ts: str, day: str):
    return F.col(ts) >= F.lit(day).cast("timestamp_ntz")


# Latest records and cleaning

def latest_lookup_query(spark, folder):
    return latest_lookup(fx.ratings(spark, folder), "review_id")


def _stored(spark, rows):
    """Written once, so that an operator that reads its input twice does not derive it twice."""
    path = shared_folder(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def latest_reviews(spark, folder):
    return clean(_stored(spark, fx.reviews(spark, folder)), ENTITIES["reviews"], stored=True)


def latest_users(spark, folder):
    rows = fx.table(spark, folder, "events").select(
        "user_id", F.col("event_type").alias("user_name"), F.col("ts").alias(TS))
    return clean(rows, ENTITIES["users"])


def _reviewed_authors(spark, folder):
    """An author record per order line; the name has stray white space."""
    return fx.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("author_id"),
        F.concat(F.lit("  "), "l_returnflag", F.lit("\t "), "l_linestatus", F.lit("\n")).alias("name"),
        F.col("l_shipdate").alias(TS))


def _reviewed_books(spark, folder):
    return fx.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("book_id"), F.col("l_returnflag").alias("title"),
        F.col("l_quantity").cast("int").alias("num_pages"), F.col("l_shipdate").alias(TS))


def latest_authors(spark, folder):
    return clean(_reviewed_authors(spark, folder), ENTITIES["authors"])


def latest_books(spark, folder):
    return clean(_reviewed_books(spark, folder), ENTITIES["books"])


def clean_text(spark, folder):
    return fx.table(spark, folder, "documents").select(
        "doc_id", remove_extra_spaces(F.col("text")).alias("text"))


def parse_datetime(spark, folder):
    return fx.table(spark, folder, "events").select(
        "event_id", parse_posted_date(fx.posted_text(F.col("ts"))).alias("posted_at"))


# Rankings

def day_window_filter(spark, folder):
    return day_window(fx.activity(spark, folder), DAY)


def popular_authors_review_count(spark, folder):
    return popular_by_count(fx.activity(spark, folder), fx.active_dimension(spark, folder), AUTHORS,
                            *day_bounds(DAY))


def popular_authors_average_rating(spark, folder):
    return popular_by_average(fx.ratings(spark, folder), fx.author_dimension(spark, folder), AUTHORS, *YEAR)


def _best(spark, folder, subject, dimension, n):
    reviews = fx.ratings(spark, folder)
    return best(popular_by_average(reviews, dimension, subject, *YEAR, n=n),
                popular_by_count(reviews, dimension, subject, *YEAR, n=n), subject)


def best_authors(spark, folder):
    return _best(spark, folder, AUTHORS, fx.author_dimension(spark, folder), 10)


def popular_books_review_count(spark, folder):
    return popular_by_count(fx.ratings(spark, folder), fx.book_dimension(spark, folder), BOOKS, *YEAR)


def popular_books_average_rating(spark, folder):
    return popular_by_average(fx.ratings(spark, folder), fx.book_dimension(spark, folder), BOOKS, *YEAR)


def best_books(spark, folder):
    return _best(spark, folder, BOOKS, fx.book_dimension(spark, folder), 500)


# Alignment and upserts

def align_authors(spark, folder):
    return fx.author_dimension(spark, folder)


def align_reviews(spark, folder):
    rows = fx.reviews(spark, folder).withColumn("review_url", F.lit("dropped"))
    dated = rows.withColumns({name: parse_posted_date(F.col(name))
                              for name in ENTITIES["reviews"].date_columns})
    return align(dated, WAREHOUSE_REVIEWS, ENTITIES["reviews"].renames)


def _review_split(spark, folder):
    """Reviews before a day as the target, those from then on as the staging rows."""
    rows, since = fx.ratings(spark, folder), _since(TS, UPSERT_SINCE)
    entity = ENTITIES["reviews"]
    return _stored(spark, clean(rows.where(~since), entity)), _stored(spark, clean(rows.where(since), entity))


def upsert_reviews(spark, folder):
    return upsert(*_review_split(spark, folder), "review_id")


def upsert_replaced(spark, folder):
    return replaced(*_review_split(spark, folder), "review_id")


def upsert_authors(spark, folder):
    recent = _reviewed_authors(spark, folder).where(_since(TS, AUTHORS_SINCE))
    staging = align(clean(recent, ENTITIES["authors"]), WAREHOUSE_AUTHORS)
    return upsert(fx.author_dimension(spark, folder), staging, "author_id")


def upsert_books(spark, folder):
    recent = _reviewed_books(spark, folder).where(_since(TS, BOOKS_SINCE))
    staging = align(clean(recent, ENTITIES["books"]), ENTITIES["books"].warehouse)
    return upsert(fx.book_dimension(spark, folder), staging, "book_id")


def upsert_users(spark, folder):
    staging = align(latest_users(spark, folder), ENTITIES["users"].warehouse)
    return upsert(fx.user_dimension(spark, folder), staging, "user_id")


# Checks, files and tables

def dq_non_empty(spark, folder):
    return non_empty_report({
        "reviews": fx.ratings(spark, folder), "authors": fx.authors(spark, folder),
        "books": fx.books(spark, folder), "users": fx.users(spark, folder)})


def default_timestamp(spark, folder):
    return with_load_time(fx.authors(spark, folder)).select(
        "author_id", F.col(TS).isNotNull().alias("has_timestamp"))


def csv_ingest(spark, folder):
    """Whole texts with quotes, commas and line breaks through the raw CSV format."""
    landing = shared_folder(spark)
    documents = fx.table(spark, folder, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"),
        F.col("lang").alias("spoiler_state"), F.col("n_chars").alias("review_read_count"),
        F.col("source").alias("review_url"))
    fx.write_raw(documents, f"{landing}/reviews.csv")
    return read_raw(spark, f"{landing}/reviews.csv", ENTITIES["reviews"])


def stage_roundtrip(spark, folder):
    root, layers = shared_folder(spark), _layers()
    events = fx.table(spark, folder, "events").select(
        F.col("event_id").alias("review_id"), F.col("user_id").alias("author_id"),
        F.col("value").alias("review_rating"), F.col("event_type").alias("spoiler_state"),
        F.col("props").alias("review_url"), F.col("ts").alias(TS))
    write_processed_csv(align(events, STAGING_REVIEWS), f"{root}/processed/reviews")
    create_databases(spark, [layers.staging], root)
    table = f"{layers.staging}.reviews"
    publish(read_processed_csv(spark, f"{root}/processed/reviews", STAGING_REVIEWS), table)
    return spark.table(table)


def source_allowlist(spark, folder):
    landing = shared_folder(spark)
    contents = {
        "author.csv": fx.authors(spark, folder), "book.csv": fx.books(spark, folder),
        "user.csv": fx.users(spark, folder), "reviews.csv": fx.reviews(spark, folder),
        "notes.csv": fx.table(spark, folder, "nation"),
    }
    for name, rows in contents.items():
        fx.write_raw(rows, f"{landing}/{name}")
    read = inheritable_thread_target(spark)(lambda entity: read_raw(spark, f"{landing}/{entity.source}", entity))
    with ThreadPoolExecutor(len(ENTITIES)) as pool:
        counts = non_empty_report(dict(zip((entity.source for entity in ENTITIES.values()), pool.map(read, ENTITIES.values()), strict=True)))
    counts = counts.select(F.col("table_name").alias("source"), "row_count")
    return landing_report(spark, landing).join(F.broadcast(counts), "source", "left").select(
        "source", "selected", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def analytics_append(spark, folder):
    """Two days, the first one twice: each day is there once."""
    root, layers = shared_folder(spark), _layers()
    create_databases(spark, layers.all, root)
    create_tables(spark, layers)
    table = f"{layers.analytics}.popular_authors_review_count"
    for day in (DAY, NEXT_DAY, DAY):
        ranked = popular_by_count(fx.activity(spark, folder), fx.active_dimension(spark, folder),
                                  AUTHORS, *day_bounds(day))
        replace_day(ranked, table, day)
    return spark.table(table)


def table_schemas(spark, folder):
    """Type and filled rows of each warehouse column after creating and loading the tables."""
    root, layers = shared_folder(spark), _layers()
    create_databases(spark, layers.all, root)
    create_tables(spark, layers)
    contents = {
        "authors": fx.author_dimension(spark, folder), "books": fx.book_dimension(spark, folder),
        "users": fx.user_dimension(spark, folder), "reviews": align_reviews(spark, folder),
    }
    reports = []
    for name, rows in contents.items():
        table = f"{layers.warehouse}.{name}"
        layout = ENTITIES[name].warehouse
        rows = upsert(spark.table(table).select(layout.names), rows, ENTITIES[name].key)
        if ENTITIES[name].dated:
            rows = with_record_date(rows)
        warehouse_table(spark, layers, ENTITIES[name]).replace(rows, uuid.uuid4().hex)
        stored = spark.table(table)
        filled = stored.agg(*[F.count(column).alias(column) for column in layout.names])
        reports.append(filled.unpivot([], layout.names, "column_name", "filled_rows").select(
            F.lit(name).alias("table_name"), "column_name",
            F.create_map(*[F.lit(part) for field in stored.schema
                           for part in (field.name, field.dataType.simpleString())])[F.col("column_name")]
            .alias("data_type"), "filled_rows"))
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def _batch_landing(spark, folder):
    """The four entities as CSV in a landing zone of their own."""
    root = shared_folder(spark)
    zones = Zones(f"{root}/landing", root, _layers())
    moment = F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_linenumber") + F.lit(BATCH_OFFSET).cast("decimal(8,6)"))
    timed = fx.table(spark, folder, "lineitem").withColumn("l_shipdate", moment)
    orders = fx.table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id")).hint("merge")
    reviews = timed.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        fx.review_id(), "user_id",
        F.col("l_partkey").alias("book_id"), F.col("l_suppkey").alias("author_id"),
        F.col("l_quantity").alias("review_rating"),
        fx.posted_text(F.col("l_shipdate")).alias("review_added_date"), F.col("l_shipdate").alias(TS))
    fx.write_raw(fx.authors(spark, folder), f"{zones.landing}/author.csv")
    fx.write_raw(fx.books(spark, folder), f"{zones.landing}/book.csv")
    fx.write_raw(fx.users(spark, folder), f"{zones.landing}/user.csv")
    fx.write_raw(reviews, f"{zones.landing}/reviews.csv")
    return zones


def batch_reviews(spark, folder):
    """Warehouse reviews after one batch, with all columns."""
    zones = _batch_landing(spark, folder)
    run_batch(spark, zones, BATCH_DAY)
    return spark.table(f"{zones.layers.warehouse}.reviews")


def batch_rankings(spark, folder):
    """The six rankings of the day after one batch, with the attributes that the landed files have."""
    zones = _batch_landing(spark, folder)
    run_batch(spark, zones, BATCH_DAY)
    report = None
    for subject in (AUTHORS, BOOKS):
        for name in (subject.by_count, subject.by_average, subject.best):
            rows = spark.table(f"{zones.layers.analytics}.{name}")

            def given(column, kind="string", rows=rows):
                return (F.col(column) if column in rows.columns else F.lit(None)).cast(kind)

            part = rows.select(
                F.lit(name).alias("table_name"), F.col(subject.key).alias("id"), given("review_count", "long").alias("review_count"),
                given(subject.average, "double").alias("mean_rating"), F.coalesce(given("name"), given("title")).alias("label"),
                "average_rating", given("publisher").alias("publisher"), given("format").alias("format"),
                given("num_pages", "int").alias("num_pages"), "ds")
            report = part if report is None else report.unionByName(part)
    return report


def warehouse_upsert(spark, folder):
    """Reviews before a day loaded into a warehouse table, then those from then on upserted into it, and once more."""
    root, layers, entity = shared_folder(spark), _layers(), ENTITIES["reviews"]
    create_databases(spark, layers.all, root)
    create_tables(spark, layers)
    table = warehouse_table(spark, layers, entity)
    before, since = (_stored(spark, with_record_date(align(rows, entity.warehouse))) for rows in _review_split(spark, folder))
    for night, rows in enumerate((before, since, since)):
        table.upsert(rows, f"night{night}", f"{root}/changed/{night}", BROADCAST_KEYS)
    return spark.table(table.table)


def nightly_batch(spark, folder):
    """The whole batch twice over the four entities as CSV; counts and key sums of all tables."""
    zones = _batch_landing(spark, folder)
    for _ in range(2):
        run_batch(spark, zones, BATCH_DAY)
    layers = zones.layers
    keys = {f"{layer}.{name}": entity.key for name, entity in ENTITIES.items()
            for layer in (layers.staging, layers.warehouse)}
    keys |= {f"{layers.analytics}.{name}": subject.key for subject in (AUTHORS, BOOKS)
             for name in (subject.by_count, subject.by_average, subject.best)}
    report = None
    for name, key in keys.items():
        layer, table = name.split(".")
        part = spark.table(name).agg(F.count(key).alias("row_count"), F.coalesce(F.sum(key), F.lit(0)).alias("key_sum")).select(
            F.lit(f"{layer.split('_')[0]}.{table}").alias("table_name"), "row_count", "key_sum")
        report = part if report is None else report.unionByName(part)
    return report


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_lookup": latest_lookup_query,
    "latest_reviews": latest_reviews,
    "latest_users": latest_users,
    "latest_authors": latest_authors,
    "latest_books": latest_books,
    "clean_text": clean_text,
    "parse_datetime": parse_datetime,
    "day_window_filter": day_window_filter,
    "popular_authors_review_count": popular_authors_review_count,
    "popular_authors_average_rating": popular_authors_average_rating,
    "best_authors": best_authors,
    "popular_books_review_count": popular_books_review_count,
    "popular_books_average_rating": popular_books_average_rating,
    "best_books": best_books,
    "align_authors": align_authors,
    "align_reviews": align_reviews,
    "upsert_reviews": upsert_reviews,
    "upsert_replaced": upsert_replaced,
    "upsert_authors": upsert_authors,
    "upsert_books": upsert_books,
    "upsert_users": upsert_users,
    "dq_non_empty": dq_non_empty,
    "default_timestamp": default_timestamp,
    "csv_ingest": csv_ingest,
    "stage_roundtrip": stage_roundtrip,
    "source_allowlist": source_allowlist,
    "analytics_append": analytics_append,
    "table_schemas": table_schemas,
    "warehouse_upsert": warehouse_upsert,
    "batch_reviews": batch_reviews,
    "batch_rankings": batch_rankings,
    "nightly_batch": nightly_batch,
}
