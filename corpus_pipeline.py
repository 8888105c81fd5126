"""A training corpus from ``documents`` (counted as part of ``ledgerflow.llm``).

Every stage reads what the one before it kept, from a written table.

Defined results, for every stage: a null text counts as empty; rows are told
apart by id and text, and null ids are passed through; other columns than those
of ``documents`` are dropped, whatever their names; an empty table gives an
empty table. What a stage makes of empty texts, ties and repeated rows is said
at the stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import crf, decontaminate, linededup, ngramjoin, packing
from ledgerflow.llm.common import read_table, shared_table, ship
from ledgerflow.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: The columns that every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Documents that score lower are rejected.
QUALITY = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose lines' length-weighted marginal of "good" is at
    least ``QUALITY``. The model learns from labelled rows of ``docs``. Each row
    is judged alone, so rows that repeat stay or go together; a score of
    ``QUALITY`` itself stays; empty texts have no bad line and stay."""
    model = crf.train(docs, read_table(spark, sf_dir, "labels"))
    return crf.filter_quality(docs, model, QUALITY).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that an earlier document has; a document that loses all of its
    lines goes with them, one that was empty before stays. Rows that share an id
    are one document, never copies of each other; a null id is the smallest."""
    ship(spark)
    kept = linededup.apply_keep(docs, linededup.line_keep_bitmaps(docs))
    return kept.where("n_dropped < n_lines").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents stays: the one with
    the smallest id (null ids last, ties by text hash). Rows that repeat id and
    text become one; texts without words link with nothing and all stay."""
    ship(spark)
    return ngramjoin.deduplicate(docs).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item (three quarters or more of its
    shingles) go, each row by its own text; empty texts contain nothing."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's token ids, cut into pieces of at most 1,024 and placed in
    sequences. An empty text is the closing id alone; rows that repeat are all
    packed; pieces of equal length are interchangeable."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Packing (and the trained classifier) have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
