"""The stages of the corpus pipeline and the way they are strung together.

A stage takes documents and returns documents; the last one returns tokens. In
between, every stage's rows are written as Parquet and read again.

1. toxicity: documents with a score of at least ``toxicity.THRESHOLD`` go.
2. line-dedup: of each class of near-equal lines only the earliest stays, as
   op10 decides, however many documents hold it. A document whose every line
   went, such as a whole copy, goes too.
3. near-dedup: of each group of near-copies the document with the smallest
   doc_id stays. Documents without words are no copies of each other.
4. mixture: each document is repeated as often as its source's target says,
   which may be never.
5. tokens: every copy is encoded.

Defined results: rows are told by their doc_id and text, so rows that share an
id are documents of their own. Documents with a null doc_id come after all others: the
second and third stage remove what they repeat. Of rows equal in id and text the third stage leaves one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from kpiloom.llm import lines, minhash, mixing, pieces, toxicity
from kpiloom.llm.common import ship, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LINE_DOCUMENTS = 1  # a class of any number of documents, as op10 has it


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_repeats(docs, LINE_DOCUMENTS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_copies(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.tokenised(docs, pieces.default_model())


def shipped(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", shipped(toxicity_stage)),
    ("line-dedup", shipped(line_stage)),
    ("near-dedup", shipped(near_stage)),
    ("mixture", shipped(mixture_stage)),
    ("tokens", shipped(token_stage)),
]


def run(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]] = STAGES) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
