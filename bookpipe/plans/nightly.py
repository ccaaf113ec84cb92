"""The whole batch: select sources, clean, stage, upsert, gate, rank, gate."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from bookpipe.operators.align import align, with_load_time, with_record_date
from bookpipe.operators.latest import BROADCAST_KEYS
from bookpipe.operators.quality import gate
from bookpipe.operators.timewindow import day_bounds
from bookpipe.plans.analytics import SUBJECTS, Subject, best, popular_by_average, popular_by_count
from bookpipe.plans.clean import clean
from bookpipe.plans.journal import Journal, dead_runs, take_over
from bookpipe.schemas import CODEC, ENTITIES, RECORD_DATE, TS, Entity
from bookpipe.sources.commits import Files
from bookpipe.sources.processed import read_processed_csv, write_processed, write_processed_csv
from bookpipe.sources.raw import landing_report, listing, read_raw
from bookpipe.session import checkpoint_folder, qualified, shuffles_for
from bookpipe.sources.tables import (
    Layers, create_databases, create_tables, publish, publish_days, publish_folder, read_day, remove_folder, remove_older, stage_day, warehouse_table)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Zones:
    """Folders and databases of one installation. ``root`` must be reachable by all executors.

    ``processed_csv`` writes the processed zone as ``|`` gzip CSV for outside readers; by default
    it is parquet, which splits, keeps types and tells null from the empty string. ``run`` names the
    folders of one run, so that a run neither overwrites what readers see nor meets another one. With ``changed_only`` an entity whose files
    are those of the last run, by path, length and time, is not read again; its processed rows and its load time stay.
    """

    landing: str
    root: str
    layers: Layers = field(default_factory=Layers)
    processed_csv: bool = False
    changed_only: bool = False
    run: str = "run"

    def folder(self, zone: str, entity: Entity) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{entity.name}/{self.run}"


def select_sources(spark: SparkSession, landing: str) -> dict[str, Row]:
    """Registered sources in the landing zone with their sizes; every other one is skipped and logged."""
    report = landing_report(spark, landing).persist()
    for row in report.where("NOT selected").orderBy("source").toLocalIterator():
        log.warning("no transformation is defined for %s", row.source)
    found = {row.source: row for row in report.where("selected").collect()}
    report.unpersist()
    return found


def process(spark: SparkSession, zones: Zones, entity: Entity, source: Row | None) -> bool:
    """Raw source to processed zone. The text is parsed once, into a columnar working copy.

    Tells whether the source has timestamps of its own; otherwise the rows have the time of this load.
    """
    timed = True
    if source is not None:
        working = zones.folder("working", entity)
        raw = read_raw(spark, f"{zones.landing.rstrip('/')}/{entity.source}", entity)
        timed = TS in raw.columns
        with_load_time(raw).write.mode("overwrite").option("compression", CODEC).parquet(working)
        rows = clean(spark.read.parquet(working), entity, stored=True)
    else:
        rows = spark.createDataFrame([], entity.staging)
    rows = align(rows, entity.staging, entity.renames)
    if zones.processed_csv:
        write_processed_csv(rows, zones.folder("processed", entity))
    else:
        write_processed(rows, zones.folder("processed", entity))
    remove_folder(spark, zones.folder("working", entity))
    return timed


def stage(spark: SparkSession, zones: Zones, entity: Entity) -> DataFrame:
    """Replace the staging table by the processed zone, and return this run's rows. Parquet is used where it lies."""
    folder, table = zones.folder("processed", entity), f"{zones.layers.staging}.{entity.name}"
    if zones.processed_csv:
        rows = publish(read_processed_csv(spark, folder, entity.staging), table)
        remove_older(spark, folder)
        return rows
    publish_folder(spark, folder, table)
    return spark.read.schema(entity.staging).parquet(folder)


def load_warehouse(spark: SparkSession, zones: Zones, entity: Entity, staged: DataFrame, timed: bool = True) -> int:
    """Upsert the staged rows into the warehouse table, and return the number of the version that has them.

    Raw files bring the old records again each night. Keys whose rows are the same on both sides are found in the table's index and left
    alone, so that a night without changes writes nothing, and one with changes the parts that hold them. A load time that
    differs does not make a record another one.
    """
    table = warehouse_table(spark, zones.layers, entity)
    if staged.isEmpty():
        return table.current().number
    rows = align(staged, entity.warehouse, entity.renames)
    if entity.dated:
        rows = with_record_date(rows)
    ignored = () if timed else (TS, RECORD_DATE) if entity.dated else (TS,)
    scratch = zones.folder("changed", entity)
    table.upsert(rows, zones.run, scratch, BROADCAST_KEYS, ignored)
    remove_folder(spark, scratch)
    return table.reached


def rank_subject(spark: SparkSession, layers: Layers, subject: Subject, ds: str) -> None:
    """Replace one subject's three rankings of the day, by one commit. The best ones are found in what was just written."""
    low, high = day_bounds(ds)
    reviews = warehouse_table(spark, layers, ENTITIES["reviews"]).between(low, high)
    dimension = spark.table(f"{layers.warehouse}.{subject.entity}")
    by_count, by_average, both = (f"{layers.analytics}.{name}" for name in (subject.by_count, subject.by_average, subject.best))
    staged = {
        by_count: stage_day(popular_by_count(reviews, dimension, subject, low, high, settled=True), by_count, ds),
        by_average: stage_day(popular_by_average(reviews, dimension, subject, low, high, settled=True), by_average, ds),
    }
    averages, counts = (read_day(spark, table, staged[table]) for table in (by_average, by_count))
    staged[both] = stage_day(best(averages, counts, subject), both, ds)
    publish_days(spark, staged, ds)


def warehouse_tables(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    return {f"{layers.warehouse}.{name}": spark.table(f"{layers.warehouse}.{name}") for name in ENTITIES}


def popular_tables(spark: SparkSession, layers: Layers) -> dict[str, DataFrame]:
    names = [f"{layers.analytics}.{name}" for subject in SUBJECTS.values()
             for name in (subject.by_count, subject.by_average)]
    return {name: spark.table(name) for name in names}


def _each(spark: SparkSession, step: Callable, items: Iterable) -> None:
    """Run a step for all items at once: small entities fill the gaps of the big one."""
    with ThreadPoolExecutor(len(ENTITIES)) as pool:
        for _ in pool.map(inheritable_thread_target(spark)(step), items):
            pass


def _marks(spark: SparkSession, path: str) -> list[int]:
    """Number of files below a path, and a hash of their paths, lengths and times. Their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return list(files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def _task(spark: SparkSession, zones: Zones, ds: str) -> dict:
    """What a run does, to tell whether another one can go on with it: its day, its kind and its files."""
    return {"ds": ds, "processed_csv": zones.processed_csv, "layers": list(zones.layers.all), "files": _marks(spark, zones.landing)}


def _taken(spark: SparkSession, zones: Zones, entity: Entity, marks: list[int]) -> dict | None:
    """What the ledger of sources says of an entity, if these are the files that were taken last and their processed rows are still there."""
    entry = Files(spark, f"{zones.root}/_sources").read(f"{entity.name}.json") if zones.changed_only else None
    if entry is None or entry["marks"] != marks or entry["processed_csv"] != zones.processed_csv:
        return None
    return entry if Files(spark, replace(zones, run=entry["run"]).folder("processed", entity)).names() else None


def _remove_left(spark: SparkSession, zones: Zones, run: str, start: dict) -> None:
    """Remove what a dead run left: working files, processed files that were not staged, its checkpoints, its journal."""
    steps = Journal(spark, zones.root, run).files.names()
    dead = replace(zones, run=run)
    for entity in ENTITIES.values():
        for zone in ("working", "changed", *(() if f"stage-{entity.name}.json" in steps else ("processed",))):
            remove_folder(spark, dead.folder(zone, entity))
    if start.get("checkpoints") and start["application"] != spark.sparkContext.applicationId:
        remove_folder(spark, start["checkpoints"])
    remove_folder(spark, f"{zones.root}/_runs/{run}")


def _resumed(spark: SparkSession, zones: Zones, task: dict) -> str | None:
    """A dead run of the same task, which then goes on as this one. All other dead runs are removed."""
    found = None
    for run, start in dead_runs(spark, zones.root).items():
        if take_over(spark, zones.root, run):
            if found is None and start["task"] == task:
                found = run
            else:
                _remove_left(spark, zones, run, start)
    return found


def run_batch(spark: SparkSession, zones: Zones, ds: str) -> bool:
    """Run everything for the day ``ds``; false if the landing zone holds no registered source.

    A rerun with the same input changes nothing: files and staging are replaced, the upsert is by
    key, and rankings replace their day. After a run that died, one of the same day over the same files takes the processed files that it had finished; any other run removes
    what it left. Runs over one root may go on at the same time: each loads its own files, and tables are committed by number.
    """
    zones = replace(zones, landing=qualified(spark, zones.landing), root=qualified(spark, zones.root).rstrip("/"))
    found = select_sources(spark, zones.landing)
    if not found:
        log.warning("no registered source in %s", zones.landing)
        return False
    layers = zones.layers
    checkpoint_folder(spark, default=f"{zones.root}/checkpoints")
    task = _task(spark, zones, ds)
    run = _resumed(spark, zones, task) or f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    zones, journal = replace(zones, run=run), Journal(spark, zones.root, run)
    journal.start(task)
    try:
        journal.step("run", _run, spark, zones, journal, found, ds)
    except BaseException:
        journal.end(failed=True)
        raise
    journal.end(failed=False)
    return True


def _run(spark: SparkSession, zones: Zones, journal: Journal, found: dict[str, Row], ds: str) -> None:
    layers, entities, staged = zones.layers, ENTITIES.values(), {}
    create_databases(spark, layers.all, zones.root)
    create_tables(spark, layers)
    warehouse = listing(spark, f"{zones.root}/{layers.warehouse}").agg(F.sum("length")).first()[0]
    stored_bytes = sum(row.bytes for row in found.values()) + (warehouse or 0)

    ledger, marks = Files(spark, f"{zones.root}/_sources"), {
        entity.name: _marks(spark, f"{zones.landing.rstrip('/')}/{entity.source}") for entity in entities if entity.source in found}
    taken = {entity.name: _taken(spark, zones, entity, marks[entity.name]) for entity in entities if entity.name in marks}

    def processed(entity: Entity) -> None:
        if not taken.get(entity.name):
            journal.step(f"process-{entity.name}", process, spark, zones, entity, found.get(entity.source), again=False)

    def staging(entity: Entity) -> None:
        entry = taken.get(entity.name)
        own = replace(zones, run=entry["run"]) if entry else zones
        staged[entity.name] = journal.step(f"stage-{entity.name}", stage, spark, own, entity)

    def loaded(entity: Entity) -> None:
        entry, version = taken.get(entity.name), warehouse_table(spark, layers, entity).current().number
        timed = entry["timed"] if entry else journal.result(f"process-{entity.name}")
        # Rows that no other run has followed are there already.
        if not entry or entry["version"] != version:
            version = journal.step(f"load-{entity.name}", load_warehouse, spark, zones, entity, staged[entity.name], timed)
        if entity.name in marks:
            ledger.replace(f"{entity.name}.json", {
                "marks": marks[entity.name], "processed_csv": zones.processed_csv, "run": entry["run"] if entry else zones.run, "timed": timed,
                "version": version})

    with shuffles_for(spark, stored_bytes):
        _each(spark, processed, entities)
        _each(spark, staging, entities)
        _each(spark, loaded, entities)
        journal.step("gate-warehouse", gate, warehouse_tables(spark, layers))
        _each(spark, lambda subject: journal.step(f"rank-{subject.entity}", rank_subject, spark, layers, subject, ds), SUBJECTS.values())
        journal.step("gate-analytics", gate, popular_tables(spark, layers))
    for entity in entities:
        warehouse_table(spark, layers, entity).clean()
