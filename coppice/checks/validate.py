"""Validation: one row per violation, and a summary row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CHANGE_TAGS, CHARSETS, STATUSES


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, rule: every rule that a row breaks (its expression is true)."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))
    return rows.select(F.col(key).alias("key"), F.explode(broken).alias("rule"))


def element_rules() -> dict[str, Column]:
    r = F.col("representation")
    base = F.regexp_extract("file", r"^(\d+)", 1).try_cast("long")  # all digits: tags may have more than four
    return {
        "tag is missing": F.col("tag").isNull(),
        "change_tag is unknown": F.col("change_tag").isNotNull() & ~F.col("change_tag").isin(CHANGE_TAGS),
        "status is unknown": F.col("status").isNotNull() & ~F.col("status").isin(STATUSES),
        "provenance is missing": F.col("provenance.page").isNull(),
        "notation is missing": r.isNotNull() & r.raw.isNull(),
        "charset is unknown": r.charset.isNotNull() & ~r.charset.isin(CHARSETS),
        "tag outside its file's range": ~F.col("tag").between(base, base + 699),
    }


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def validate(elements: DataFrame, queue: DataFrame | None) -> DataFrame:
    """key, rule: all errors; ``queue`` None means that the review queue is missing."""
    spark = elements.sparkSession
    found = violations(elements, "tag", element_rules()).unionByName(duplicates(elements, "tag").select(F.col("tag").alias("key"), F.lit("tag is repeated").alias("rule")))
    none = elements.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("int").alias("key"), F.lit("no elements").alias("rule"))
    found = found.unionByName(none)
    return found if queue is not None else found.unionByName(spark.createDataFrame([(None, "review queue is missing")], "key int, rule string"))


def summary(elements: DataFrame, queue: DataFrame) -> DataFrame:
    active = F.col("status") == "active"
    a = elements.agg(
        F.countDistinct("file").alias("files"), F.count("*").alias("elements"), F.count_if(active).alias("active"), F.count_if(F.col("status") == "retired").alias("retired"),
        F.count_if(active & F.col("name").isNull()).alias("active_without_name"), F.count_if(active & F.col("representation").isNull()).alias("active_without_repr"),
    )
    return a.crossJoin(queue.agg(F.count("*").alias("review_entries")))  # one row each
