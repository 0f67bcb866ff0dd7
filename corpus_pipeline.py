"""From raw documents to packed training sequences in five stages.

Each stage takes the documents its predecessor kept and decides over all of them: toxic documents
go, documents that lose too much to line rules go and the others stay cleaned, of near-duplicates
the smallest id stays, passages that an earlier document has are cut, and the rest is packed.

Stages read the columns of documents and no others: further columns, whatever their names, neither matter nor come
along.  An empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm import neardup, packing, quality, substring, toxicity
from stockyard.llm.texts import DOCUMENTS
from stockyard.workspace import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Toxicity from which a document goes, similarity in percent of near-duplicates, words of a repeated passage.
TOXIC, SIMILAR, PASSAGE = 0.3, 80, 50
#: Tokens of a sequence and the id that ends a document.
SEQUENCE, END = 2048, 1


def _rewritten(docs: DataFrame, text: str) -> DataFrame:
    """The columns of documents with a new text; the length column follows it."""
    changed = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return docs.select(*[changed.get(c, F.col(c)).alias(c) for c in DOCUMENTS])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC; the models learn from the labels of the documents at hand.

    A null or empty text is scored like any other and a text of any length in whole; equal texts get equal scores, so
    repeated rows stay or go together, and rows with a null id are scored but teach nothing.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, carry=DOCUMENTS).where(F.col("score") < TOXIC).select(*DOCUMENTS)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that broke one.

    Null, empty and short texts (fewer than 50 words) go.  Rows are judged one by one: repeated rows and null ids make no difference.
    """
    return _rewritten(quality.clean(docs, carry=DOCUMENTS).where("kept"), "clean_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id, and of repeated rows one.

    Rows that share an id are one document: they stay or go together, and those that differ in any column are all kept.  Texts
    without words are near to nothing; rows with a null id take no part and stay as they are.
    """
    found = neardup.near_duplicates(docs, neardup.Plan(percent=SIMILAR)).where("doc_id IS NOT NULL")
    verdicts = found.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    special = materialize(verdicts.where("n > 1 OR NOT kept"), "verdicts")
    # a table of its own, so that the few ids are known to be few and no text moves on their account
    repeated = materialize(special.where("kept").select("doc_id"), "repeated")
    rows = docs.select(*DOCUMENTS)
    once = rows.join(special, "doc_id", "left_anti")
    again = rows.join(repeated, "doc_id", "left_semi").distinct()
    return once.select(*DOCUMENTS).union(again.select(*DOCUMENTS))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has.

    Null and empty texts stay as they are, rows with a null id are neither cut nor a source, and rows that share an id are no
    sources for each other.  A text may end up empty.
    """
    return _rewritten(substring.remove_repeats(docs, PASSAGE, carry=DOCUMENTS), "kept_text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences that mix the sources as the documents do.

    Null and empty texts are the end token alone, a long text is cut into pieces, a null source is a source of its own,
    and repeated rows are packed one by one.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END, SEQUENCE)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality rules", clean_lines),
    ("near-dedup", drop_near_duplicates),
    ("substring dedup", cut_passages),
    ("packing", pack_sequences),
]
#: The stages learn models, build signatures and cut tokens: beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage returns is written once, for the next one reads it several times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = materialize(docs, f"stage-{i}")
    return docs
