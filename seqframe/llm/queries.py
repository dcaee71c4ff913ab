"""The registered queries of the operators: whole tables, the parameters of their contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.llm.decontamination import contaminations
from seqframe.llm.hard_negatives import hard_negatives
from seqframe.llm.language_id import language_id
from seqframe.llm.license_scan import scan_licenses
from seqframe.llm.lm_scoring import scored_corpus
from seqframe.llm.mixing import mix_report
from seqframe.llm.packing import packed
from seqframe.llm.prefix_join import near_duplicate_classes
from seqframe.llm.quality_rules import quality_rules
from seqframe.llm.repeats import repeat_report
from seqframe.llm.token_counts import token_counts
from seqframe.llm.url_filters import filter_urls
from seqframe.llm.whitening import whitened

#: Rules of the contract: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(documents(spark, sf_dir))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(documents(spark, sf_dir), n=3, num=90, den=100)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), limit=1024)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_corpus(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are the next one, as the contract has it; anchors are ids divisible by 50."""
    label = F.col("label").cast("long")
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    table = table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(table, F.col("vec_id") % 50 == 0)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_license_scans": op2_license_scans,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}

#: The join and its classes in SQL; links are met from both ends and followed until nothing new is reached.
CLASSES_SQL = r"""with recursive
  w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
  s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
      else list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2]))) end as s from w),
  e as (select doc_id, len(s) as n, unnest(s) as x from s),
  links as (select a.doc_id as a, b.doc_id as b from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
  reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a)
  select s.doc_id, len(s.s)::bigint as n_shingles, r.least as component_id
  from s join (select a, min(b) as least from reach group by a) r on s.doc_id = r.a"""

#: Every anchor against all rows, its first positives, and the first rows between their bounds.
NEGATIVES_SQL = r"""with
  r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x
    from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
  s as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2]))::bigint as score
    from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
  p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
  n as (select p.anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
      row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id) as k
    from p join s on p.anchor_id = s.anchor_id and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
  select anchor_id, positive_id, k::integer as rank, negative_id, positive_score, negative_score from n where k <= 3"""

#: The other operators fit models, sort suffixes or draw at random: tests hold them against brute force.
ORACLES: dict[str, str] = {"op4_ngram_jaccard_join": CLASSES_SQL, "op11_hard_negatives": NEGATIVES_SQL}
