"""The corpus pipeline: from ``documents`` to token ids in five stages.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame. :func:`run` writes each stage's result as Parquet into
the shared folder and reads it again as the next one's documents. All stages
but the last return the columns of ``documents``; ``n_chars`` follows the text.

Every stage takes any documents: other columns are dropped, an empty table gives
an empty one, texts are processed whole whatever their length, and rows are
never told apart by an id alone (ids may be null or repeated). What a stage does
with null, empty and repeated texts stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm import bpe, linededup, mixing, quality, simhash
from ebbflow.llm.common import configure, table
from ebbflow.llm.queries import QUALITY_THRESHOLD, vocabulary
from ebbflow.session import work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (operator 9), taught by the labels of rows
    that are not held out, gives a score of 0.3 or more. Null, empty and blank
    texts share one score, that of no words, and equal texts one score, so they
    stay or go together; a tie with the threshold stays."""
    configure(spark)
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=tuple(COLUMNS)).filter(F.col("score") >= QUALITY_THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat or nearly repeat an earlier one
    (operator 6). A document may be left without lines. Null texts stay null, the
    empty text stays empty; of rows equal in all columns the first has the lines
    that are kept. Null ids stand last in the order of lines."""
    configure(spark)
    return linededup.remove(docs.select(*COLUMNS), num=4, den=5).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 2): three-word
    shingles, two bits. Null and empty texts are one group; equal rows are
    duplicates, of which one stays."""
    configure(spark)
    return simhash.keep_one(docs.select(*COLUMNS), width=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (operator 10). A null
    source is a source; null and empty texts have no words and are not taken;
    rows equal in id and text share what the cut leaves them."""
    configure(spark)
    return mixing.mixed(docs.select(*COLUMNS), weights=(5, 2, 1), max_epochs=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (operator 3), with digests of the ids and of
    the text decoded from them. A null text counts as empty and has no ids; every
    row has a row, repeated ones too."""
    configure(spark)
    return bpe.encode(docs, vocabulary(), keep=("doc_id", "source"), outputs=("ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL cannot learn the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage{n}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
