"""A corpus from raw documents: known languages, no near copies, no repeated passages, no benchmark items, mixed.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. ``run`` writes each result to
the shared folder and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.llm.batches import batches_of
from seqframe.llm.decontamination import without_contaminated
from seqframe.llm.language_id import held_out, recognised, trained
from seqframe.llm.mixing import mixed_documents
from seqframe.llm.prefix_join import one_of_each
from seqframe.llm.repeats import without_repeats
from seqframe.session import leaving_result, written

#: Bytes of a repeated string, and words of a passage, which may be shorter.
REPEAT, PASSAGE = 256, 51
#: Whole texts that a task is handed at a time.
ROWS_AT_A_TIME = 1_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(work: Stage) -> Stage:
    """A stage that leaves none of its intermediate tables to those that follow."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return leaving_result(spark, lambda: work(spark, docs, sf_dir))

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language that the labelled ones teach, go."""
    with batches_of(spark, ROWS_AT_A_TIME):
        return written(recognised(docs, trained(docs.filter(~held_out("doc_id", 4, 2)))), "zstd")


@stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five-word shingles, 0.8) the document with the smallest id stays."""
    return one_of_each(docs, n=5, num=80, den=100)


@stage
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of ``REPEAT`` bytes that occur again, and passages of ``PASSAGE`` words that other texts have, are cut from all
    texts; documents that lose all their words go."""
    cut = without_repeats(docs.withColumn("n_chars", F.col("n_chars") - F.coalesce(F.char_length("text"), F.lit(0))), length=REPEAT, words=PASSAGE)
    cut = cut.withColumn("n_chars", F.col("n_chars") + F.coalesce(F.char_length("text"), F.lit(0)))
    with batches_of(spark, ROWS_AT_A_TIME):
        return written(cut.filter(F.col("text").isNull() | (F.col("text").rlike(r"[^\x20\x09-\x0D]"))), "zstd")


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in shards."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
]

#: Stages that hand whole texts to Python write their result themselves, so that the bound on rows holds when they run.
WRITTEN = (language_id, suffix_array_dedup)

#: Component search, suffix sorting and a fitted classifier have no SQL form; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus: columns of documents and mix_shard, a row as often as the mix takes it (action).

    Null and blank texts go with the first stage, as no language has them. Of repeated rows and of copies one stays; rows
    with null or equal ids are told apart by their content. An empty table gives an empty corpus.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if k < len(STAGES) - 1 and work not in WRITTEN:
            docs = written(docs)
    return docs
