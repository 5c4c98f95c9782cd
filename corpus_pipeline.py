"""A training-corpus pipeline of five operators; each stage's output is written as Parquet and read as the next one's input.

Stages but the last return the columns of ``documents``; ``n_chars`` follows the text.
A null text is an empty one from the first stage on. Repeated rows are copies: the first of a group stays, of equal ids the first
read; ties in similarity or score change nothing, as stages compare with thresholds; an empty table stays empty
through all stages; columns other than those of ``documents`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, table, tune
from tallyforge.llm.decontamination import find_leaks
from tallyforge.llm.near_duplicates import near_duplicates
from tallyforge.llm.queries import tokenizer_file
from tallyforge.llm.sentencepiece_codec import Pieces, code_texts
from tallyforge.llm.substring_dedup import drop_repeats
from tallyforge.llm.toxicity import score_texts, train, training_rows

ALSO = ("lang", "source", "n_chars")


def documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold stay."""
    model = train(training_rows(docs, table(spark, sf_dir, "labels")))
    return documents(score_texts(docs, model, also=ALSO).where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return documents(near_duplicates(docs, also=ALSO).where("first"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand more than once are cut out of the texts."""
    return documents(drop_repeats(docs, also=ALSO, text_out=True))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark items are cut out of the texts."""
    return documents(find_leaks(docs, table(spark, sf_dir, "benchmark"), also=ALSO, text_out=True))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts and digests of what is left, with the proof that it decodes."""
    return code_texts(docs, Pieces.read(tokenizer_file("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", remove_benchmark),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole of ``documents``."""
    tune(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
