"""Cross-checks against other readings of the same directory: a mirror's table, and texts read by an OCR program."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normal_description, normal_name, similarity
from ..operators.lookup import only_in

#: The least similarities.
NAME_RATIO, DESCRIPTION_RATIO = 0.80, 0.85


def compared(elements: DataFrame, mirror: DataFrame) -> DataFrame:
    """Active elements that the mirror has, with repr_same and desc_same (null where there is nothing to compare) and name_same."""
    e = elements.where("status = 'active'").select("tag", "name", "description", "representation")
    m = mirror.select("tag", F.col("name").alias("m_name"), F.col("desc").alias("m_desc"), F.col("type").alias("m_type"), F.col("max_length").alias("m_max"))
    r = F.col("representation")
    same = F.when(r.isNotNull(), r.charset.eqNullSafe(F.col("m_type")) & r.max_length.eqNullSafe(F.col("m_max")))
    a, b = normal_description(F.col("description")), normal_description(F.coalesce("m_desc", F.lit("")))
    return e.join(m, "tag").select(
        "*", same.alias("repr_same"), F.coalesce(normal_name(F.col("name")) == normal_name(F.col("m_name")), F.lit(False)).alias("name_same"), F.when(F.col("description").isNotNull(), similarity(a, b) >= DESCRIPTION_RATIO).alias("desc_same")
    )


def counters(elements: DataFrame, mirror: DataFrame) -> DataFrame:
    """One row: joined, repr_match, repr_diff, name_match, desc_match, desc_diff, only_ours, only_mirror."""
    c = compared(elements, mirror)
    own = c.agg(
        F.count("*").alias("joined"), F.count_if("repr_same").alias("repr_match"), F.count_if(~F.col("repr_same")).alias("repr_diff"), F.count_if("name_same").alias("name_match"),
        F.count_if("desc_same").alias("desc_match"), F.count_if(~F.col("desc_same")).alias("desc_diff"),
    )
    active = elements.where("status = 'active'")
    ours = only_in(active, mirror, "tag", "tag").agg(F.count("*").alias("only_ours"))
    theirs = only_mirror(elements, mirror).agg(F.count("*").alias("only_mirror"))
    return own.crossJoin(ours).crossJoin(theirs)  # one row each


def only_mirror(elements: DataFrame, mirror: DataFrame) -> DataFrame:
    """tag of the mirror's entries that no active element has."""
    return only_in(mirror, elements.where("status = 'active'"), "tag", "tag").select("tag")


def differences(elements: DataFrame, mirror: DataFrame) -> DataFrame:
    """kind (repr, desc), tag, ours, other of what differs."""
    c = compared(elements, mirror)
    r = c.where("NOT repr_same").select(F.lit("repr").alias("kind"), "tag", F.col("representation.raw").alias("ours"), F.concat_ws("..", "m_type", "m_max").alias("other"))
    d = c.where("NOT desc_same").select(F.lit("desc").alias("kind"), "tag", F.substring("description", 1, 100).alias("ours"), F.substring("m_desc", 1, 100).alias("other"))
    return r.unionByName(d)


def ocr_results(expected: DataFrame, ocr: DataFrame) -> DataFrame:
    """tag, field, expected, ocr, ratio, pass, unreadable.

    ``expected`` has tag, field (name or repr) and expected; ``ocr`` has tag, field, ocr. Rows without an expected or a
    read text make no result. A name passes by similarity. A notation passes if the first one in the read text is the
    expected one; a text without any says nothing, so its pass is null.
    """
    j = expected.join(ocr, ["tag", "field"]).where(F.col("expected").isNotNull() & (F.col("ocr") != ""))
    found = F.nullif(F.regexp_extract("ocr", r"\b((?:an|a|n)(?:\.\.\d+|\d+))\b", 1), F.lit(""))
    named: Column = F.col("field") == "name"
    j = j.withColumn("found", F.when(~named, found))
    ratio = F.when(named, similarity(normal_name(F.col("expected")), normal_name(F.col("ocr")), empty_is_zero=True)).otherwise((F.col("found") == F.col("expected")).cast("double"))
    j = j.withColumn("ratio", ratio)
    passed = F.when(named, F.col("ratio") >= NAME_RATIO).otherwise(F.col("found") == F.col("expected"))
    return j.select("tag", "field", "expected", F.coalesce("found", "ocr").alias("ocr"), "ratio", passed.alias("pass"), (~named & F.col("found").isNull()).alias("unreadable"))


def agreement(results: DataFrame, examples: int = 5) -> DataFrame:
    """field, passes, total (without the unreadable), unreadable, and the first failures by tag."""
    first = Window.partitionBy("field").orderBy("tag", "expected", "ocr")
    failed = results.where("NOT pass").withColumn("n", F.row_number().over(first)).where(F.col("n") <= examples)
    shown = F.struct("n", "tag", F.substring("expected", 1, 60).alias("expected"), F.substring("ocr", 1, 60).alias("ocr"))
    failed = failed.groupBy("field").agg(F.transform(F.array_sort(F.collect_list(shown)), lambda x: F.struct(x.tag, x.expected, x.ocr)).alias("failures"))
    counts = results.groupBy("field").agg(F.count_if("pass").alias("passes"), (F.count("*") - F.count_if("unreadable")).alias("total"), F.count_if("unreadable").alias("unreadable"))
    return counts.join(failed, "field", "left")
