"""Corpus pipeline: quality, exact copies, near copies, benchmark passages, piece ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import decontam, exact_dedup, pieces, quality, similar
from tickweave.llm.common import cells, free_name
from tickweave.plans.session import saved, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1, by the labels that are not held out.

    Null and empty texts are scored as an empty text; equal texts, and so repeated rows, have one score; without labels all stay (0.5).
    """
    labels = table(spark, sf_dir, "labels").filter(~quality.fold(F.col("doc_id")))
    name = free_name(docs, "quality")
    return quality.classify(docs, cells(docs), labels, into=name).filter(F.col(name)["predicted"] == 1).select(*docs.columns)


def keep_one_of_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the one with the smallest doc_id.

    Null counts as empty. Rows that repeat the smallest doc_id of a group all stay; a null doc_id stays only where its group has no other.
    """
    return exact_dedup.drop_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that pairs of similarity 0.8 or more link, by five-word shingles, the one with the smallest doc_id.

    Texts without words are one group. Rows go by their doc_id: all rows of one that goes, none without one.
    """
    return similar.drop_near(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Null and wordless texts have none; repeated rows fare alike."""
    name = free_name(docs, "hits")
    return decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), into=name).filter(F.size(F.col(name)["spans"]) == 0).select(*docs.columns)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the best segmentation, n_pieces, the n best scores, the changes that make the best the others, and whether decoding gives the text back.

    One row a row. Null and empty texts have no ids and one segmentation, of score 0.
    """
    name = free_name(docs, "pieces")
    out = pieces.encode_pieces(docs, into=name)
    p = F.col(name)
    return out.select("doc_id", p["ids"].alias("ids"), F.size(p["ids"]).cast("long").alias("n_pieces"), p["n_best"]["score"].alias("n_best_scores"), p["n_best"]["changes"].alias("n_best_changes"), p["exact"].alias("exact"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_one_of_exact_copies),
    ("simhash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", keep_uncontaminated),
    ("sentencepiece encoding", to_pieces),
]

#: The classifier, the fingerprints and the segmentation have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
