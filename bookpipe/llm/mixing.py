"""Mix sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookpipe.llm.text import store

SEED = "mixture"
# A source's documents are narrowed down, 256 ways at a time, to at most so many distinct keys that one task sorts them.
TASK_ROWS = 1_000
KEY_DIGITS = 48
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words that ASCII white space divides; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def order_key(seed: str) -> Column:
    """Where a document stands in the seeded order of its source, as hex digits.

    The id decides, then the text, so that only rows that repeat both are tied. A null counts as empty.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.concat(F.md5(name.cast("binary")), F.lpad(F.lower(F.hex(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))), 16, "0"))


def numbered(spark: SparkSession, rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``place``, their number from 0 in the given order, by prefix sums over partition totals."""
    part, row = F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__row")
    ranged = store(spark, rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", part, row))
    totals = ranged.groupBy("__part").count()
    # One row per partition of the sort.
    base = totals.select("__part", (F.sum("count").over(Window.orderBy("__part")) - F.col("count")).alias("__base"))
    return ranged.join(F.broadcast(base), "__part").withColumn("place", F.col("__base") + F.col("__row")).drop("__part", "__row", "__base")


def water_fill(spark: SparkSession, sources: DataFrame, total: int, most: int) -> DataFrame:
    """Divide ``total`` among sources by weight, none above ``most`` times its size.

    ``sources`` has source_size and a whole positive weight, and is read from files. Each round clamps the sources whose
    share is above their cap and divides what these leave among the others, until none is above. All comparisons are of whole
    numbers. Adds cap, target (double) and need, the target rounded to whole words, halves up. If even all caps are less than
    ``total``, every target is its cap.
    """
    rows = sources.withColumn("cap", F.col("source_size") * most)
    rest, weights = int(total), rows.agg(F.sum("weight")).first()[0] or 0
    clamped, before = F.lit(False), 0
    while weights:
        share = F.col("weight").cast("decimal(18,0)") * F.lit(rest).cast("decimal(19,0)")
        clamped = share > F.col("cap").cast("decimal(19,0)") * F.lit(weights).cast("decimal(18,0)")
        held = rows.agg(F.count_if(clamped), F.sum(F.when(clamped, F.col("cap"))), F.sum(F.when(~clamped, F.col("weight")))).first()
        if held[0] == before:
            break
        before, rest, weights = held[0], int(total) - held[1], held[2] or 0
    if not weights:
        clamped = F.lit(True)
    target = F.when(clamped, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(float(rest)) / F.lit(float(weights or 1)))
    return store(spark, rows.withColumn("target", target).withColumn("need", F.least(F.col("cap"), F.floor(target + 0.5))))


def _of_source(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Join by source, null like any other. ``sources`` is read from files, so Spark broadcasts it by its size or shuffles."""
    kept = [name for name in sources.columns if name != "source"]
    marked = sources.select(F.col("source").alias("__source"), *kept)
    return rows.join(marked, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def cut_points(spark: SparkSession, sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Where in the seeded order of its source each target is reached.

    ``sizes`` has a (source, key, size) per document, and ``sources`` the water-filled rows; both are read from files. Of the target, whole
    repetitions of the source come first. What is ``left`` is less than the source: its documents are taken in the order of their keys until it is
    reached. The key where that happens is found digits at a time: sums per next two digits, combined before the shuffle, tell
    which digits hold it, and only those documents are looked at again, until few distinct keys are left to sort.

    Adds copies, cut_key (null if nothing is left) and part: the words that each document with the cut key gives.
    """
    filled = F.col("source_size") > 0
    copies = F.when(filled, F.expr("need div greatest(source_size, 1)")).otherwise(0)
    state = store(spark, sources.withColumn("copies", copies).withColumn("left", F.col("need") - F.col("copies") * F.col("source_size"))
                  .withColumn("prefix", F.when(F.col("left") > 0, F.lit(""))))

    def inside(digits: int) -> DataFrame:
        open_ = state.filter("left > 0").select("source", "left", "prefix")
        return _of_source(sizes.filter("size > 0"), open_).filter(F.substring("key", 1, digits) == F.col("prefix"))

    def reached(rows: DataFrame, name: str, columns: list[Column]) -> DataFrame:
        """The first row of each source at which the running sum of sizes is ``left`` or more."""
        upto = F.sum("size").over(Window.partitionBy("source").orderBy(name))
        return rows.withColumn("upto", upto).filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("size") < F.col("left"))).select("source", *columns)

    digits = 0
    while digits < KEY_DIGITS:
        most = inside(digits).groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if most <= TASK_ROWS:
            break
        digits += 2
        sums = inside(digits - 2).groupBy("source", "left", F.substring("key", 1, digits).alias("next")).agg(F.sum("size").alias("size"))
        found = reached(sums, "next", [F.col("next"), (F.col("left") - (F.col("upto") - F.col("size"))).alias("remaining")])
        state = store(spark, _of_source(state, found, "left").withColumn("prefix", F.coalesce("next", "prefix"))
                      .withColumn("left", F.coalesce("remaining", "left")).drop("next", "remaining"))
    tied = inside(digits).groupBy("source", "left", "key").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    # Documents that repeat one another share alike; so a source may stay short of its target by less than a word for each of them.
    found = reached(tied, "key", [F.col("key").alias("cut_key"), F.expr("(left - (upto - size)) div rows").alias("part")])
    return store(spark, _of_source(state.drop("left", "prefix"), found, "left"))


def mix(spark: SparkSession, docs: DataFrame, weigh, share: int = 100, most: int = 3, seed: str = SEED) -> DataFrame:
    """How often each document is taken into a mixture of sources.

    ``weigh`` gets the distinct sources (source, source_size) and adds a whole positive weight to each. The mixture has ``share`` percent of all
    words, divided by ``water_fill``. A document is taken ``copies`` times whole, and of one more repetition its first ``part``
    words: all of them for the documents that stand before the source's cut in the seeded order, some for the one at the cut, none for the rest.
    So the words taken from a source are its target rounded to whole words, except where equal rows meet the cut. The same rows, weights and seed
    give the same mixture, however the rows are partitioned.

    Returns the columns doc_id, text, source, size (words), source_size, target, copies, part, taken. A null text has no words; null is a
    source of its own. A source without words gets nothing. Rows with equal doc_id and text, or with null ones, are taken each on its own. An empty table gives no row.
    Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    rows = rows.withColumns({"size": word_count(F.col("text")), "key": order_key(seed)})
    sizes = store(spark, rows.select("source", "key", "size"))
    sources = store(spark, weigh(store(spark, sizes.groupBy("source").agg(F.sum("size").alias("source_size")))))
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share // 100
    plan = cut_points(spark, sizes, water_fill(spark, sources, total, most))
    extra = F.when(F.col("key") < F.col("cut_key"), F.col("size")).when(F.col("key") == F.col("cut_key"), F.col("part")).otherwise(0)
    placed = _of_source(rows, plan.select("source", "source_size", "target", "copies", "cut_key", "part")).withColumn("part", extra)
    return placed.select("doc_id", "text", "source", "size", "source_size", "target", "copies", "part",
                         (F.col("copies") * F.col("size") + F.col("part")).alias("taken"))


def repetitions(mixed: DataFrame) -> DataFrame:
    """The texts of a mixture: (doc_id, source, repetition, text), a row for each whole and each partial repetition.

    A partial repetition ends with its last taken word. A document without words is in no repetition.
    """
    whole = F.col("copies") + (F.col("part") == F.col("size")).cast("int")
    rows = mixed.filter("size > 0").withColumn("repetition", F.explode(F.sequence(F.lit(0), F.col("copies"))))
    # Two columns, as a text is divided into words only where a part of it is taken.
    first = F.array_join(F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.lit(1), F.col("part").cast("int")), " ")
    return rows.filter((F.col("repetition") < F.col("copies")) | (F.col("part") > 0)).select(
        "doc_id", "source", "repetition", F.when(F.col("repetition") < whole, F.col("text")).otherwise(first).alias("text"))
