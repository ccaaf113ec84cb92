"""Warehouse tables in parts, of which a new version shares those that it does not change.

A table's rows lie in parts: spans of days for tables with a record date, spans of the key for the others. A version says which folder
holds each part. An upsert writes the parts that lose or gain rows, and the next version takes all other folders from the one before it. Beside
the rows lies an index: for each key the number of its rows, sums of their hashes, and their days, bucketed and sorted by key. What a night brings is compared with
the index, so that neither the rows nor a shuffle of what is stored are needed to find the keys that have changed and the parts that hold them.

Versions are committed by number (see ``commits``). A session sees a version as a catalog table whose partitions are the parts, and the
table's name as a view of it without the part column.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from bookpipe.operators.upsert import survivors
from bookpipe.schemas import CODEC, RECORD_DATE, TS
from bookpipe.sources.commits import KEPT_SECONDS, Commits

PART = "part"
# Rows that a part is meant to have, and times as many, on average, at which a table is divided anew.
ROWS_PER_PART, GROWTH = 4_000_000, 8
# Parts that a table is divided into at most, if its keys are far apart.
MOST_PARTS = 10_000
# Partitions that are added to the catalog by one statement.
ADDED = 1_000
# Keys that an index bucket is meant to have, and index tables from which on they are merged into one.
KEYS_PER_BUCKET, LEAST_BUCKETS, GENERATIONS = 2_000_000, 8, 6
# The day of rows without a date.
NO_DAY = -1_000_000
INDEX_TYPE = "key long, n long, high long, low long, days array<int>"
MARKS = ("n", "high", "low")

_registering, _pointing = threading.Lock(), threading.Lock()


def point_view(spark: SparkSession, name: str, query: str) -> None:
    """Make the query the view. Spark's CREATE OR REPLACE drops the view first, so that other threads would not find it for a moment."""
    with _pointing:
        spark.sql(f"{'ALTER' if spark.catalog.tableExists(name) else 'CREATE'} VIEW {name} AS {query}")


@dataclass(frozen=True)
class Version:
    """``parts``: part -> [folder, rows]. ``origin``, ``span``: part 0 begins at this day or key, and each has so many. ``index``: folders, oldest first."""

    number: int = 0
    origin: int = 0
    span: int = 0
    parts: dict[str, list] = field(default_factory=dict)
    index: list[str] = field(default_factory=list)
    buckets: int = 0

    @property
    def rows(self) -> int:
        return sum(rows for _, rows in self.parts.values())


class VersionedTable:
    """One warehouse table, named ``database.name``, in the folder of its database."""

    def __init__(self, spark: SparkSession, table: str, layout: StructType, key: str, dated: bool = False):
        self.spark, self.table, self.key, self.dated = spark, table, key, dated
        self.database, self.name = table.split(".")
        self.columns = StructType([*layout.fields, *([StructField(RECORD_DATE, DateType())] if dated else [])])
        self.order = TS if dated else key
        self.home = spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
        self.commits = Commits(spark, f"{self.home}/_versions/{self.name}")
        # The version that the last upsert of this object has left.
        self.reached = 0

    # Versions and the catalog

    def current(self) -> Version:
        number, content = self.commits.latest()
        return Version(number, **{k: v for k, v in content.items() if k not in ("made", "number")})

    def _columns(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)

    def _stored(self, version: Version) -> str:
        """The catalog table of a version, created where this session does not have it."""
        name = f"{self.database}.{self.name}__v{version.number}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self._columns()}, {PART} bigint) USING parquet PARTITIONED BY ({PART}) "
                           f"LOCATION '{self.home}/_versions/{self.name}/none'")
            added = [f"PARTITION ({PART} = {part}) LOCATION '{self.home}/{folder}'" for part, (folder, _) in version.parts.items()]
            for n in range(0, len(added), ADDED):
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[n : n + ADDED])}")
        return name

    def register(self) -> None:
        """Point the view to the latest version. This session forgets versions but that and the one before."""
        with _registering:
            version = self.current()
            names = ", ".join(f"`{f.name}`" for f in self.columns)
            point_view(self.spark, self.table, f"SELECT {names} FROM {self._stored(version)}")
            for known in self.spark.catalog.listTables(self.database, f"{self.name}__v*"):
                if int(known.name.rsplit("__v", 1)[1]) < version.number - 1:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{known.name}")

    def read(self, version: Version | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of a version, of the given parts or all; other parts are not opened."""
        with _registering:
            rows = self.spark.table(self._stored(version or self.current()))
        if parts is not None:
            rows = rows.where(F.col(PART).isin([int(part) for part in parts]))
        return rows.select(self.columns.names)

    def between(self, low: str, high: str) -> DataFrame:
        """Rows of the parts that may hold dates from ``low`` to ``high``, written as YYYY-MM-DD, with or without a time."""
        version = self.current()
        first, last = ((date.fromisoformat(day[:10]) - date(1970, 1, 1)).days for day in (low, high))
        low, high = ((day - version.origin) // version.span if version.span else 0 for day in (first, last))
        return self.read(version, [part for part in version.parts if low <= int(part) <= high])

    # Parts

    def _day(self) -> Column:
        return F.coalesce(F.unix_date(RECORD_DATE), F.lit(NO_DAY))

    @staticmethod
    def _part_of(place: Column, origin: int, span: int) -> Column:
        """The part of a day or key, in whole numbers that no key overflows; long ones are several times faster than decimals."""
        near = F.lit(abs(origin) < 1 << 61) & place.between(-(1 << 61), 1 << 61)
        close = place.cast("long") - F.lit(origin).cast("long")
        short = F.call_function("div", close - F.pmod(close, F.lit(span).cast("long")), F.lit(span).cast("long"))
        after = place.cast("decimal(20,0)") - F.lit(origin).cast("decimal(20,0)")
        span_ = F.lit(span).cast("decimal(20,0)")
        return F.when(near, short).otherwise(F.floor((after - F.pmod(after, span_)) / span_).cast("long"))

    def _part(self, origin: int, span: int) -> Column:
        return self._part_of(self._day() if self.dated else F.coalesce(F.col(self.key), F.lit(origin)), origin, span)

    def _division(self, rows: DataFrame) -> tuple[int, int]:
        """Origin and span with which parts get about ``ROWS_PER_PART`` rows, if days or keys are spread evenly between the outermost hundredths."""
        place = F.unix_date(RECORD_DATE) if self.dated else F.col(self.key)
        n, low, high, inner = rows.agg(F.count(place), F.min(place), F.max(place), F.percentile_approx(place, [0.01, 0.99])).first()
        if not n:
            return 0, 1
        span = max(1, (inner[1] - inner[0] + 1) * ROWS_PER_PART // n, (high - low) // MOST_PARTS)
        # Spans of days lie alike in all tables.
        return (0 if self.dated else low), min(span, 10**18)

    def _write(self, rows: DataFrame, origin: int, span: int, run: str) -> dict[str, list]:
        """Write rows in parts, sorted within files, and say which parts there are.

        Ranges of part, order and key's hash are a function of the rows alone, so a task that is run again writes the same. A part of any size is
        spread over tasks, and a task holds few parts.
        """
        folder = f"{self.name}__{run}"
        part = self._part(origin, span)
        parts = rows.repartitionByRange(part, self.order, F.xxhash64(self.key)).withColumn(PART, part).sortWithinPartitions(PART, self.order)
        parts.write.mode("overwrite").option("compression", CODEC).partitionBy(PART).parquet(f"{self.home}/{folder}")
        layout = StructType([*self.columns.fields, StructField(PART, LongType())])
        counts = self.spark.read.schema(layout).parquet(f"{self.home}/{folder}").groupBy(PART).count().collect()
        return {str(row[0]): [f"{folder}/{PART}={row[0]}", row[1]] for row in counts}

    # Index

    def _marks(self, rows: DataFrame, ignored: Sequence[str] = (), buckets: int = 0) -> DataFrame:
        """An index row for each key. Rows are compared by sums of hashes; the hash passes over nulls, so which columns are null is hashed too.

        With ``buckets`` the rows' hashes are dealt into these before they are grouped, so that nothing moves again when an index is written.
        """
        names = [name for name in self.columns.names if name not in ignored]
        row = F.xxhash64(F.lit(",".join(names)), *names, *[F.isnull(name) for name in names])
        hashed = rows.where(F.col(self.key).isNotNull()).select(
            F.col(self.key).cast("long").alias("key"), row.alias("row"), *([F.unix_date(RECORD_DATE).alias("day")] if self.dated else []))
        if buckets:
            hashed = hashed.repartition(buckets, "key")
        marks = [F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("row", 32)).alias("high"), F.sum(F.col("row").bitwiseAND(0xFFFFFFFF)).alias("low")]
        days = F.lit(None).cast("array<int>")
        if self.dated:
            # Numbers only, which are grouped by hash; sets of days would be sorted by key.
            marks += [F.count("day").alias("dated"), F.min("day").alias("first"), F.max("day").alias("last")]
            days = self._days()
        return hashed.groupBy("key").agg(*marks).select("key", *MARKS, days.alias("days"))

    @staticmethod
    def _days() -> Column:
        """The days of a key, from numbers; of three or more rows of several days, all from the first to the last: parts are then rewritten that need not be."""
        first, last, none = F.col("first"), F.col("last"), F.array().cast("array<int>")
        dated = F.when(F.col("dated") == 0, none).when(first == last, F.array(first)).when(F.col("dated") == 2, F.array(first, last)).otherwise(
            F.sequence(first, last))
        return F.concat(dated, F.when(F.col("dated") < F.col("n"), F.array(F.lit(NO_DAY))).otherwise(none))

    def _generation(self, folder: str, buckets: int) -> str:
        name = f"{self.database}.{self.name}__index_{folder.rsplit('/', 1)[1].replace('-', '_')}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({INDEX_TYPE}) USING parquet OPTIONS (compression '{CODEC}') CLUSTERED BY (key) SORTED BY (key) "
                           f"INTO {buckets} BUCKETS LOCATION '{self.home}/{folder}'")
        return name

    def changed_keys(self, version: Version, rows: DataFrame, ignored: Sequence[str] = ()) -> DataFrame:
        """Index rows of those keys whose rows differ from the version's, with ``known`` and the days that they had.

        Only the marks of the new rows are shuffled, into the buckets of the index; each index table is read where it lies.
        """
        marks = self._marks(rows, ignored)
        if not version.index:
            return marks.withColumns({"known": F.lit(False), "old_days": F.lit(None).cast("array<int>")})
        found = marks.repartition(version.buckets, "key")
        names = []
        for n, folder in enumerate(reversed(version.index)):
            stored = self.spark.table(self._generation(folder, version.buckets))
            found = found.join(stored.select("key", F.struct(*MARKS, "days").alias(f"old{n}")).hint("merge"), "key", "left")
            names.append(f"old{n}")
        found = found.withColumn("old", F.coalesce(*names))
        same = F.lit(True)
        for name in MARKS:
            same &= F.col(name) == F.col(f"old.{name}")
        return found.where(F.col("old").isNull() | ~same).select(
            "key", *MARKS, "days", F.col("old").isNotNull().alias("known"), F.col("old.days").alias("old_days"))

    def _indexed(self, version: Version, changed: DataFrame, n: int, run: str) -> tuple[list[str], int]:
        """Add an index table of the ``n`` changed keys, or when there are many tables, one for all keys in place of them."""
        rows, before, buckets = changed.select("key", *MARKS, "days"), list(version.index), version.buckets
        if len(before) >= GENERATIONS:
            rows = rows.withColumn("age", F.lit(-1))
            for age, folder in enumerate(reversed(before)):
                rows = rows.unionByName(self.spark.table(self._generation(folder, buckets)).withColumn("age", F.lit(age)))
            latest = F.min_by(F.struct(*MARKS, "days"), "age").alias("row")
            rows, before, buckets = rows.groupBy("key").agg(latest).select("key", "row.*"), [], 0
        buckets = buckets or max(LEAST_BUCKETS, -(-(version.rows + n) // KEYS_PER_BUCKET))
        folder = f"_index/{self.name}/{run}"
        # Hash partitions are the buckets, so a task writes one sorted file.
        rows.repartition(buckets, "key").write.insertInto(self._generation(folder, buckets), overwrite=True)
        return [*before, folder], buckets

    def _first_index(self, rows: DataFrame, run: str, ignored: Sequence[str] = ()) -> tuple[list[str], int]:
        """The index of a table that has none, of all rows. Their hashes are shuffled once, into its buckets."""
        folder, buckets = f"_index/{self.name}/{run}", max(LEAST_BUCKETS, -(-rows.count() // KEYS_PER_BUCKET))
        self._marks(rows, ignored, buckets).write.insertInto(self._generation(folder, buckets), overwrite=True)
        return [folder], buckets

    # Changes

    def _next(self, base: Version, rows: DataFrame, run: str, scratch: str, few: int, ignored: Sequence[str]) -> Version | None:
        """The version that follows ``base`` by an upsert of the rows, written but not committed; None if it would be the same."""
        spark, keyless = self.spark, rows.where(F.col(self.key).isNull())
        if base.index:
            self.changed_keys(base, rows, ignored).write.mode("overwrite").option("compression", CODEC).parquet(scratch)
            changed = spark.read.parquet(scratch)
        else:
            index, buckets = self._first_index(rows, run, ignored)
            changed = spark.table(self._generation(index[0], buckets)).withColumns({
                "known": F.lit(False), "old_days": F.lit(None).cast("array<int>")})
        n = changed.count()
        if not n and keyless.isEmpty():
            return None
        keys = changed.select(F.col("key").alias(self.key))
        fresh = rows
        if base.index:
            fresh = rows.join(F.broadcast(keys) if n <= few else keys, self.key, "left_semi").select(rows.columns).unionByName(keyless)
        origin, span, touched = base.origin, base.span, set(base.parts)
        divided = base.rows <= GROWTH * ROWS_PER_PART * len(base.parts) or span == 1
        if base.parts and divided:
            part = self._part(origin, span)
            if self.dated:
                days = changed.select(F.explode(F.concat("days", F.coalesce("old_days", F.array().cast("array<int>")))).alias("day"))
                found = days.select(self._part_of(F.col("day"), origin, span).alias(PART))
            else:
                found = keys.select(part.alias(PART))
            # One row per part.
            touched = {str(row[0]) for row in found.unionByName(keyless.select(part.alias(PART))).distinct().collect()}
        merged = fresh
        if reread := sorted(touched & set(base.parts)):
            replaced = changed.where("known").select(F.col("key").alias(self.key))
            merged = survivors(self.read(base, reread), replaced, self.key, n <= few).unionByName(fresh)
        if not (base.parts and divided):
            origin, span = self._division(merged)
        parts = {part: stored for part, stored in base.parts.items() if part not in touched} | self._write(merged, origin, span, run)
        if base.index:
            index, buckets = self._indexed(base, changed, n, run)
        return Version(base.number + 1, origin, span, parts, index, buckets)

    def replace(self, rows: DataFrame, run: str) -> None:
        """Make these rows the table, whatever it holds. They are worked out twice, for the size of the parts and for the parts."""
        rows = rows.select(self.columns.names)
        while True:
            number, (origin, span) = self.current().number, self._division(rows)
            parts = self._write(rows, origin, span, run)
            written = self.spark.read.schema(self.columns).parquet(f"{self.home}/{self.name}__{run}")
            index, buckets = self._first_index(written, run)
            if self._commit(Version(number + 1, origin, span, parts, index, buckets)):
                return self.register()

    def upsert(self, rows: DataFrame, run: str, scratch: str, few: int, ignored: Sequence[str] = ()) -> bool:
        """Replace the keys of ``rows`` by these rows; false if nothing differs. Rows with a null key are added.

        ``rows`` has the table's columns and is read several times, so it should be stored. ``ignored`` columns do not make a row different.
        At most ``few`` keys are broadcast. If another run commits first, the changes are worked out again from its version. Files that no version holds are left to ``clean``.
        """
        rows, attempt = rows.select(self.columns.names), 0
        try:
            while True:
                base = self.current()
                self.commits.lease(run, base.number)
                version = self._next(base, rows, f"{run}_{attempt}" if attempt else run, scratch, few, ignored)
                if version is None or self._commit(version):
                    self.reached = (version or base).number
                    self.register()
                    return version is not None
                attempt += 1
        finally:
            self.commits.release(run)

    def _commit(self, version: Version) -> bool:
        return self.commits.commit(version.number, {k: v for k, v in asdict(version).items() if k != "number"})

    def clean(self, seconds: float = KEPT_SECONDS) -> None:
        """Remove old versions, and folders older than that which no kept version holds and no running upsert is writing."""
        kept = self.commits.prune(seconds)
        used = {folder for content in kept for folder, _ in content.get("parts", {}).values()}
        used |= {folder for content in kept for folder in content.get("index", [])}
        leased = tuple(self.commits.leased())
        jvm = self.spark._jvm
        home = jvm.org.apache.hadoop.fs.Path(self.home)
        files = home.getFileSystem(self.spark._jsc.hadoopConfiguration())
        now = jvm.java.lang.System.currentTimeMillis()
        for pattern, depth in ((f"{self.name}__*", 1), (f"{self.name}__*/{PART}=*", 2), (f"_index/{self.name}/*", 3)):
            for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(home, pattern)) or []:
                folder = "/".join(status.getPath().toString().split("/")[-depth:])
                run = folder.split("/")[-1] if depth == 3 else folder.split("/")[0].removeprefix(f"{self.name}__")
                if run.startswith(leased) and leased or status.getModificationTime() > now - seconds * 1000:
                    continue
                if not any(name == folder or name.startswith(f"{folder}/") for name in used):
                    files.delete(status.getPath(), True)
