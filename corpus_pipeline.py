"""Corpus pipeline: language ID, quality, near-duplicates, packing.

``run(spark, sf_dir)`` takes the table ``documents`` through the stages; each
stage's result is written as Parquet under the shared folder and read again as
the next one's input. The first three return the columns of ``documents`` for
the rows they keep; packing returns one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidystar.llm import language_id, near_dedup, packing, quality
from tidystar.llm.common import cut_lineage, fresh_name, read_table, share_package, small_batches, tokenizer_path

#: How far the best language of a kept text is at least from chance (0) towards certainty (1).
LEAST_CERTAINTY = 1 / 15
#: A text whose quality score is lower is rejected.
LEAST_QUALITY = 0.3


def least_language_score(n_labels: int) -> float:
    """A text whose best language is less likely than this is rejected: relative to chance among the labels."""
    return 1 / n_labels + LEAST_CERTAINTY * (1 - 1 / n_labels)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language the model recognises (NULL or letterless texts go).

    Without any labelled document there is no language to miss: all texts with letters stay.
    """
    share_package(small_batches(spark))
    lang, score = fresh_name(docs, "stage_lang"), fresh_name(docs, "stage_score")
    model = language_id.fit(docs, F.lit(True))
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model, docs.columns, lang_out=lang, score_out=score)
    return found.where((F.col(lang) != language_id.UNDETERMINED)
                       & (F.col(score) >= least_language_score(len(model.labels)))).drop(lang, score)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality reaches ``LEAST_QUALITY``."""
    share_package(small_batches(spark))
    score = fresh_name(docs, "stage_score")
    model = quality.fit(spark, docs, read_table(spark, sf_dir, "labels"), F.lit(True))
    return quality.score(docs, model, docs.columns, out=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    share_package(small_batches(spark))
    return near_dedup.keep_one_per_group(spark, docs, shingle_words=5, threshold=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    share_package(small_batches(spark))
    return packing.pieces_digest(packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [("language_id", keep_identified), ("quality", keep_good),
          ("near_dedup", keep_one_of_near_copies), ("packing", pack)]

#: The stages train models and hash texts; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
