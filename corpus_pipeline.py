"""Clean a corpus in stages, each on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All stages but the last return
the columns of ``documents``.

In all stages a null text is like an empty one and stays null where it stays; a text is taken whole, however
long; further columns of any name pass through; an empty table gives an empty one.  Rows with null ids and
repeated rows are told apart below.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.llm.attention import filter_quality
from docmart.llm.decontamination import filter_contaminated
from docmart.llm.line_dedup import line_dedup
from docmart.llm.minhash import drop_near_duplicates
from docmart.llm.mixing import mix_sources
from docmart.llm.shared import drop_at_end, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A null or empty text has the score of one empty passage. Each row is judged by its own text, so
    repeated rows, and rows with a null id, go or stay by that alone.
    """
    return filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; a document whose lines all go stays, with an empty text.

    No row goes: null texts stay null, a null source is a source of its own, and each repeated row, or row with
    a null id, counts as a page. ``n_chars`` is counted anew, null for a null text.
    """
    out = line_dedup(docs, counts=False).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id.

    Null, empty and wordless texts are like no other and stay, and so do rows with a null id. Of rows with one id
    and text one stays; rows of one id with different texts go or stay together.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages cover a twentieth or more go.

    Null and empty texts have no words and stay; ids are not looked at, so repeated rows go or stay together.
    """
    return filter_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get equal weights, in a global random order.

    Rows with equal ids get equal numbers of copies, null ids count as one id and a null source as the source ``''``. Adds
    ``mix_copy`` and ``mix_order``, and replaces columns of these names.
    """
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
#: SQL can express neither the classifier nor the near duplicates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is kept in the cluster's shared folder."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    drop_at_end(spark, folder)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{k}_{name}")
            docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs
