"""Corpus pipeline: five stages over ``documents``, each one of the text operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and reads it
again as the next one's docs.  All stages but the last return the columns of docs.  Verdicts come back under the rows'
numbers (see ``common.with_numbers``), so rows that repeat a doc_id, or have none, have verdicts of their own; a list of up
to half a million numbers goes to the texts, a longer one meets them in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import jaccard, langid, linededup, sentencepiece
from tidegrid.llm.common import ROW, by_number, intermediate, returned, stored, with_numbers
from tidegrid.llm.decontamination import decontaminate


def _without(mine: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``mine`` but those whose number is in ``dropped`` (uid)."""
    return by_number(mine, stored(dropped.select(F.col("uid").alias(ROW)), "dropped"), ROW, "left_anti").select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters (null and empty ones among them), and those in no language that was learned.

    The verdict is each row's own, so it is taken where the row is scored: rows are read once more than for learning, and
    not shuffled.  Equal rows have equal verdicts; texts of any length are parsed whole; without labelled rows all go.
    """
    mark = ["__lang", "__score", "__bits", "__foreign"]
    found = langid.tagged(docs, langid.fit(docs), *mark)
    return found.where((F.col("__lang") != langid.UNKNOWN) & ~F.col("__foreign")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, and of equal sets, the one with the least doc_id stays; of its repeated rows, the first.

    A group whose doc_ids are all null keeps its first row.  Null, empty and wordless texts are linked with nothing and stay.
    """
    mine = with_numbers(docs)
    found = jaccard.near_duplicates(mine).where("class_id is not null")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    firsts = found.groupBy("group_id").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    dropped = found.join(firsts, "group_id").where(F.col("uid") != F.col("first.uid"))
    return _without(mine, dropped, docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that earlier documents have; n_chars, where there is one, follows.

    Null and empty texts stay as they are; null doc_ids rank last, repeated ones by their row; a text of which all goes stays
    as an empty one.
    """
    cut = linededup.with_kept_text(docs, from_words=True, prefix="__")
    changed = F.col("__n_removed_units") > 0
    out = {"text": F.when(changed, F.col("__kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length("__kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.select(*[out.get(c, F.col(c)).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more lies in windows of benchmark items; null and wordless ones stay."""
    mine = with_numbers(docs)
    found = decontaminate(mine, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(mine, found.where("contaminated"), docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, with whether they decode to it; null and empty texts have none."""
    vocabulary = sentencepiece.load_vocabulary()
    both = sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, decoded="decoded")
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_ids"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]

#: Language ID and the piece trie have no SQL form; the chain is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage.  Each stage's output is written; what it needed besides is removed then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with intermediate(spark):
            docs = returned(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
