"""From raw documents to packed training sequences, in stages.

A stage takes the documents that the one before kept and returns them with the columns
they had; the last returns packed pieces. Rows are found again by id and text, so rows
that repeat an id are judged each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import fresh, kept, only_kept, table, working, written
from tidegate.llm.exact_dedup import exact_groups
from tidegate.llm.near_dedup import near_classes
from tidegate.llm.packing import pack_documents
from tidegate.llm.queries import RANKS
from tidegate.llm.substring import remove_repeats
from tidegate.llm.toxicity import score_toxicity

# Columns may have any name, so stages work on numbered ones.
ID, TEXT, LENGTH = "doc_id", "text", "n_chars"


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*(F.col(number).alias(name) for name, number in names.items()))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic.

    A null text counts as empty, and an empty text as the machine's bias says; texts of any
    length are read whole. Rows that repeat are judged each, and alike. Without labels, or
    with those of one kind only, nothing is learned and all or none are toxic. An empty
    table stays one; further columns, of any names, are kept.
    """
    inner, names = _numbered(docs)
    labels = table(spark, sf_dir, "labels").withColumnRenamed(ID, names[ID])
    judged = score_toxicity(inner, labels, "toxic", id_col=names[ID], text_col=names[TEXT], carry=tuple(names.values()))
    return _named(judged.filter("predicted = 0"), names)


def _one_of_each(spark: SparkSession, docs: DataFrame, classes) -> DataFrame:
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(TEXT))
    with working(spark):
        return only_kept(keyed, classes(keyed, id_col=ID, text_col=TEXT, key=F.col(key)), ID, key).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id.

    Null and empty texts are equal, and white space counts as one space; null ids come
    last, and of rows that repeat id and text one stays. Texts of any length are compared
    whole. An empty table stays one; further columns, of any names, are kept.
    """
    return _one_of_each(spark, docs, exact_groups)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id.

    Null ids come last, and of rows that repeat id and text one stays. Texts under five
    words, empty and null ones too, are near-duplicates only of texts of the same words.
    Texts of any length are compared whole. An empty table stays one; further columns, of
    any names, are kept.
    """
    return _one_of_each(spark, docs, near_classes)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without passages that a document with a smaller id has.

    ``n_chars`` follows the text; a text that loses nothing stays as it is, null and empty
    ones too. Rows that share an id are not compared with one another, and a null id counts
    as above all others. Texts of any length are compared whole. An empty table stays one;
    further columns, of any names, are kept.
    """
    inner, names = _numbered(docs)
    missing = fresh(inner, "missing")
    inner = inner.withColumn(missing, F.col(names[TEXT]).isNull())
    others = tuple(c for c in inner.columns if c != names[TEXT])
    cleaned = remove_repeats(inner, id_col=names[ID], text_col=names[TEXT], with_text=True, carry=others)
    cleaned = cleaned.withColumn(names[TEXT], F.when(F.col(missing), F.lit(None).cast("string")).otherwise(F.col("kept_text")))
    if LENGTH in names:
        length = F.char_length(names[TEXT]).cast(docs.schema[LENGTH].dataType)
        cleaned = cleaned.withColumn(names[LENGTH], F.when(F.col("n_removed") > 0, length).otherwise(F.col(names[LENGTH])))
    return _named(cleaned, names)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens.

    A null text counts as empty and is one piece of the end token; longer documents are cut.
    Rows that repeat are packed each, pieces of one length in any order. An empty table
    gives no pieces; further columns do not matter.
    """
    return pack_documents(docs, RANKS, capacity=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# Classes depend on a trained model, and sequences on tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result written before the next reads it.

    The run owns a folder for them, which is gone when the packed pieces are written.
    """
    docs = table(spark, sf_dir, "documents")
    with working(spark):
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), name)
        return kept(STAGES[-1][1](spark, docs, sf_dir), "packed")
