"""From raw documents to token ids in five stages, each written as Parquet and read again.

1. toxicity: documents the classifier rejects (score 0.7 or more) go
2. n-gram Jaccard join: of each class of near duplicates one document stays, the least id (then the least row hash)
3. benchmark decontamination: documents with a benchmark window go
4. personal data: spans are replaced by their kind; ``n_chars`` follows the text
5. SentencePiece: the token ids join the columns

Each stage takes all that the one before kept. Stages 1 to 4 return the columns of ``documents`` (and any extra columns it has). Documents
without words are no near duplicates and stay. Rows that repeat are near duplicates of each other. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripspark.llm import decontaminate, ngram_join, pii, sentence_pieces, toxicity
from tripspark.llm.common import row_hash, stored
from tripspark.llm.queries import PIECES, new_path, table

#: Two classifiers, components by iteration and a Viterbi segmentation are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def _rows(docs: DataFrame) -> DataFrame:
    """(row, rid, text): each whole row as one column, so that no name of the document's can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_hash().alias("rid"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Train on the labelled documents, keep what scores below 0.7."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return toxicity.score(rows, model, "row").filter("score < 0.7").select("doc_id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class, and all without words. Rows that repeat are reduced before they are shuffled."""
    near = stored(spark, ngram_join.near_duplicates(docs).select("rid", "root", "doc_id"), "near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    keep = near.filter("root is not null").groupBy("root").agg(first.alias("first")).select("first.rid")
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    one = _rows(docs).filter(has_word).dropDuplicates(["rid"]).join(keep, "rid")
    return one.select("row.*").unionByName(docs.filter(~has_word))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    rows = _rows(docs)
    index = decontaminate.stored_index(rows, new_path(spark, "index"), id_col="rid")
    found = decontaminate.search(index, table(spark, sf_dir, "benchmark"))
    hit = stored(spark, found.filter("n_hit > 0").select(F.col("doc_id").alias("rid")).distinct(), "hit")
    return rows.join(hit, "rid", "left_anti").select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in texts; ``n_chars``, where it is, counts the new text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids of each text."""
    return sentence_pieces.encode(docs, sentence_pieces.read_model(PIECES))


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("decontaminate", drop_contaminated),
          ("pii", redact_personal_data), ("sentence_pieces", encode_pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
