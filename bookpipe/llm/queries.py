"""One query per operator over the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookpipe.llm import decontaminate, exact, language, licenses, mixing, neardup, packing, periods, phrases, quality, repeats, scoring, sentences
from bookpipe.llm.text import held_out
from bookpipe.session import shared_folder, ship_package

KEEP_SCORE = 0.3
SEQUENCE = 2_048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.learn(spark, docs.filter(~held_out(5, 0))), held_out(5, 0))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"), held_out(5, 0))
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(spark, documents(spark, sf_dir), held_out(7, 2))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.remove_repeated_spans(spark, documents(spark, sf_dir))


def new_index(spark: SparkSession) -> exact.DigestIndex:
    """An empty index in a folder of its own, with a bucket per shuffle partition."""
    folder = shared_folder(spark)
    return exact.DigestIndex(spark, f"{folder}/digests", f"digests_{folder.rsplit('-', 1)[-1]}", int(spark.conf.get("spark.sql.shuffle.partitions")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_index(spark).add(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, documents(spark, sf_dir), tokenizer(), SEQUENCE).drop("ids")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(spark, documents(spark, sf_dir), length=100)


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, documents(spark, sf_dir), words=3, percent=85)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where a tenth of the texts, by doc_id, repeats some of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    marked = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.col("g")
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    placed = marked.select("doc_id", "text", "words", g.alias("g"), n.alias("n"), a.alias("a")).withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    left = F.col("n") - F.col("a")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int")))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), left)), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(with_planted_periods(documents(spark, sf_dir)), least=6, times=4)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = found.select("doc_id", "runs", best.alias("best"), "collapsed")
    return listed.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


SOURCE_WEIGHTS = [5, 2, 1]


def by_turns(spark: SparkSession):
    """Weights that repeat along the sources in code point order, null last."""
    def weigh(sources: DataFrame) -> DataFrame:
        placed = mixing.numbered(spark, sources, F.col("source").asc_nulls_last())
        return placed.withColumn("weight", F.element_at(F.array(*map(F.lit, SOURCE_WEIGHTS)), (F.col("place") % len(SOURCE_WEIGHTS) + 1).cast("int"))).drop("place")
    return weigh


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, documents(spark, sf_dir), by_turns(spark), share=100, most=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark, documents(spark, sf_dir), least=10, longest=3, top=2_000, percent=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_quality, op3_lm_scoring, op4_substring_dedup, op5_exact_dedup, op6_decontamination, op7_packing,
        op8_suffix_dedup, op9_minhash_dedup, op10_license_scan, op11_periodic_runs, op12_source_mixing, op13_phrases)
}
