"""A training-corpus pipeline over ``documents``: quality rules, quality classifier, line dedup, near duplicates, packing.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm.jaccard_join import join_components
from coppice.llm.line_dedup import dedup_lines
from coppice.llm.ordinal import ratings, select, train
from coppice.llm.packing import pack
from coppice.llm.quality_rules import judge
from coppice.llm.shared import stored


def _rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, which tells rows apart: the key if it is never null nor repeated, else a number, written with the rows."""
    again = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if again.isEmpty():
        return docs.withColumn("__row", F.col("doc_id"))
    return stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, whatever their keys: null and repeated keys are judged row by row, null and empty texts go."""
    rows = _rows(docs)
    rejected = judge(rows, key="__row").where(~F.col("kept")).select("__row")
    return rows.join(rejected, "__row", "left_anti").select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely junk or toxic than clean go, null and repeated keys alike. With no labels of two grades all stay."""
    return select(docs, train(docs, ratings(spark.read.parquet(f"{sf_dir}/labels.parquet"))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines of any length go, and near copies with a tenth of the words edited; so do documents that had lines and have none left. ``n_chars`` follows the text.

    Rows that share a key are documents of their own; rows with a null key keep their lines.
    """
    out = dedup_lines(docs, short=True, words_per_edit=10).where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, of those with the smallest id; a null id comes last."""
    rows = _rows(docs)
    groups = stored(join_components(rows, key="__row").select("__row", "component_id"), "groups")
    # Null and empty texts have no group but their own, so they stay.
    ids = rows.select("__row", F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    first = groups.join(ids, "__row").groupBy("component_id").agg(F.min(F.struct("unnamed", "doc_id", "__row")).alias("first"))
    others = groups.join(first.select(F.col("first.__row").alias("__row")), "__row", "left_anti").select("__row")
    return rows.join(others, "__row", "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, null and repeated keys included."""
    import public_tokenizers as P

    return pack(docs, P.path("word_bpe_49k.json"), window=2048)


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates), ("packing", packing)]

#: Tokenising, hashed regression and packing can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again before the next. An empty table gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k + 1}")
    return docs
