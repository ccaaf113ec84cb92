"""Catalog tables of the three layers.

Staging tables are views over one stored copy, or over the processed files. A new one is written in full next to the old one, then the view
is pointed to it: readers see the old rows or the new ones, and a failed write changes nothing. Kept are the current one and the one before it; a reader that
is still on an older one fails.

Warehouse tables are versioned in parts (see ``versions``). The days of the analytics tables are folders, and numbered versions (see ``commits``) say which folder holds
a table's day. The state lies in the folders, not in the session's catalog: a new session registers what it finds there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from bookpipe.operators.align import align
from bookpipe.schemas import ANALYTICS, ENTITIES, Entity
from bookpipe.sources.commits import KEPT_SECONDS, Commits
from bookpipe.sources.versions import VersionedTable, point_view

KEPT = timedelta(seconds=KEPT_SECONDS)


@dataclass(frozen=True)
class Layers:
    """Database names of the layers."""

    staging: str = "staging"
    warehouse: str = "warehouse"
    analytics: str = "analytics"

    @property
    def all(self) -> tuple[str, str, str]:
        return self.staging, self.warehouse, self.analytics


def create_databases(spark: SparkSession, names: Iterable[str], root: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root.rstrip('/')}/{name}'")


def warehouse_table(spark: SparkSession, layers: Layers, entity: Entity) -> VersionedTable:
    return VersionedTable(spark, f"{layers.warehouse}.{entity.name}", entity.warehouse, entity.key, entity.dated)


def create_tables(spark: SparkSession, layers: Layers) -> None:
    """Register the warehouse and analytics tables that lie in the folders; those that do not are empty and typed.

    What lies there in the layout of earlier releases, one folder per table and one per day, is taken over.
    """
    for entity in ENTITIES.values():
        table = warehouse_table(spark, layers, entity)
        if not table.current().number and (old := _current(spark, table.table)) is not None:
            table.replace(spark.read.schema(table.columns).parquet(f"{table.home}/{old}"), "taken")
        table.register()
    number, known = _days(spark, layers.analytics).latest()
    if not number and (old := _old_days(spark, layers.analytics)):
        _days(spark, layers.analytics).change(lambda later: old | later)
        known = old
    for name, layout in ANALYTICS.items():
        table = f"{layers.analytics}.{name}"
        if not spark.catalog.tableExists(table):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(layout)}, ds date) USING parquet PARTITIONED BY (ds) "
                      f"LOCATION '{_folder(spark, table)}/_versions/{name}'")
        _place(spark, table, known.get(name, {}))


def _old_days(spark: SparkSession, database: str) -> dict[str, dict[str, str]]:
    """Days of the analytics tables that lie in partition folders: table -> day -> folder."""
    home = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark, f"{database}."))
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, dict[str, str]] = {}
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(home, "*/ds=*")) or []:
        name, day = status.getPath().getParent().getName(), status.getPath().getName()
        if name in ANALYTICS:
            found.setdefault(name, {})[day.removeprefix("ds=")] = f"{name}/{day}"
    return found


def _folder(spark: SparkSession, table: str) -> str:
    """Where the database of a table keeps its tables."""
    return spark.catalog.getDatabase(table.split(".")[0]).locationUri.rstrip("/")


def _pointer(spark: SparkSession, table: str):
    """File system and path of the file that names the table's current version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark, table)}/_current_{table.split('.')[1]}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _current(spark: SparkSession, table: str) -> str | None:
    files, path = _pointer(spark, table)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _point(spark: SparkSession, table: str, version: str) -> None:
    """Name the current version, by a rename that replaces the file at once."""
    files, path = _pointer(spark, table)
    jvm = spark._jvm
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path.toString()}.{version}")
    stream = files.create(fresh, True)
    stream.writeBytes(version)
    stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, path, options)


def _ddl(layout: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in layout)


def _new_version(table: str) -> str:
    return f"{table}__{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"


def _switch(spark: SparkSession, table: str, stored: str) -> None:
    """Make a stored version the current one. Versions but this and the one before go, also those of earlier sessions."""
    database, name = table.split(".")
    before = _current(spark, table)
    _point(spark, table, stored.split(".")[1])
    point_view(spark, table, f"SELECT * FROM {stored}")
    files, path = _pointer(spark, table)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"{name}__*")
    for status in files.globStatus(pattern):
        version = status.getPath().getName()
        if version not in (stored.split(".")[1], before):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{version}")
            files.delete(status.getPath(), True)


def publish(df: DataFrame, table: str) -> DataFrame:
    """Store the rows as a new version of the table and make it the current one. Returns the stored rows."""
    stored = _new_version(table)
    df.write.format("parquet").saveAsTable(stored)
    _switch(df.sparkSession, table, stored)
    return df.sparkSession.table(stored)


def publish_folder(spark: SparkSession, folder: str, table: str) -> None:
    """Make the parquet files of a folder the table, without a copy. Of the older folders beside it, the last one stays."""
    point_view(spark, table, f"SELECT * FROM parquet.`{folder}`")
    remove_older(spark, folder)


def remove_older(spark: SparkSession, folder: str) -> None:
    """Remove the folders beside this one that are older, but the one before it. Folders are named in the order of their writing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    older = sorted((status.getPath().toString() for status in files.listStatus(path.getParent())
                    if status.getPath().getName() < path.getName()), reverse=True)
    for name in older[1:]:
        remove_folder(spark, name)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _days(spark: SparkSession, database: str) -> Commits:
    """The versions of all days of a database: table -> day -> folder."""
    return Commits(spark, f"{_folder(spark, f'{database}.')}/_versions/days")


def _place(spark: SparkSession, table: str, days: Mapping[str, str]) -> None:
    """Let the partitions of the catalog table lie where these days do."""
    home, known = _folder(spark, table), {row[0].removeprefix("ds=") for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()}
    for day in known & set(days):
        spark.sql(f"ALTER TABLE {table} PARTITION (ds = DATE'{day}') SET LOCATION '{home}/{days[day]}'")
    if fresh := " ".join(f"PARTITION (ds = DATE'{day}') LOCATION '{home}/{days[day]}'" for day in sorted(set(days) - known)):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {fresh}")


def stage_day(df: DataFrame, table: str, ds: str) -> str:
    """Write one day of an analytics table into a folder of its own, which no table shows yet. Returns the folder, below that of the database."""
    spark, name = df.sparkSession, table.split(".")[1]
    day = date.fromisoformat(ds).isoformat()
    layout = StructType([field for field in spark.table(table).schema if field.name != "ds"])
    folder = f"{name}__days/{day}/{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    align(df, layout).write.parquet(f"{_folder(spark, table)}/{folder}")
    return folder


def read_day(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """Rows of a staged day."""
    layout = StructType([field for field in spark.table(table).schema if field.name != "ds"])
    return spark.read.schema(layout).parquet(f"{_folder(spark, table)}/{folder}")


def publish_days(spark: SparkSession, staged: Mapping[str, str], ds: str) -> None:
    """Make staged folders the given day of their tables, all of one database, by one commit. Other days stay as they are."""
    day = date.fromisoformat(ds).isoformat()
    (database,) = {table.split(".")[0] for table in staged}
    commits, names = _days(spark, database), {table.split(".")[1]: folder for table, folder in staged.items()}
    commits.change(lambda known: known | {name: known.get(name, {}) | {day: folder} for name, folder in names.items()})
    latest = commits.latest()[1]
    for table in staged:
        name = table.split(".")[1]
        _place(spark, table, {day: latest[name][day]})
    used = {folder for content in commits.prune() for days in content.values() if isinstance(days, dict) for folder in days.values()}
    for name in names:
        parent = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark, f'{database}.')}/{name}__days/{day}")
        files = parent.getFileSystem(spark._jsc.hadoopConfiguration())
        # A folder that no version shows may be about to be published; the time in its name says how old it is.
        for status in files.listStatus(parent):
            folder = f"{name}__days/{day}/{status.getPath().getName()}"
            if folder not in used and folder < min(names[name], f"{name}__days/{day}/{datetime.now(timezone.utc) - KEPT:%Y%m%d%H%M%S%f}"):
                files.delete(status.getPath(), True)


def replace_day(df: DataFrame, table: str, ds: str) -> None:
    """Replace one day of an analytics table, also by nothing. Other days stay as they are."""
    publish_days(df.sparkSession, {table: stage_day(df, table, ds)}, ds)
