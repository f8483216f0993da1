"""From positioned words to elements: lines, rows, cells, joined texts, elements and what a person should review."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.fragments import joined
from ..functions.notation import notation
from ..functions.text import null_if_blank
from . import ordered as O
from .lookup import interval_route

#: The columns with text, and those whose words make the vocabulary.
TEXT_COLUMNS = ["name", "description", "representation", "old_name", "business_term", "notes", "bridges"]
VOCABULARY_COLUMNS = ["name", "description", "old_name", "business_term"]


def status_of(change_tag: Column) -> Column:
    return F.when(change_tag == "x", "retired").otherwise("active")


def rows_of(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (row_id, change_tag, tag) and cells (row_id, column, fragments) of words (page, word_no, text, x, y)."""
    lines = O.layout_lines(words)
    heads = O.row_heads(lines, S.CHANGE_TAGS)
    route = interval_route(F.col("x"), S.INTERVALS)
    cells = O.layout_cells(O.layout_rows(lines, S.CHANGE_TAGS).where(route.isin(TEXT_COLUMNS)), route)
    return heads, cells


def vocabulary(cells: DataFrame) -> DataFrame:
    return O.vocabulary_tally(cells.where(F.col("column").isin(VOCABULARY_COLUMNS)))


def review_rules(rows: DataFrame, change_tag: str, name: str, representation: str, parsed: str, cells: Column) -> Column:
    """Array of review entries (field, raw_fragments, issue, confidence) of a row, in rule order.

    ``representation`` is the printed notation, ``parsed`` its struct, ``cells`` a map from columns to fragments.
    """
    tag = F.col(change_tag)

    def entry(when: Column, field: str, fragments: Column, issue: str) -> Column:
        return F.when(when, F.struct(F.lit(field).alias("field"), fragments.alias("raw_fragments"), F.lit(issue).alias("issue"), F.lit("low").alias("confidence")))

    cell = lambda c: F.coalesce(F.try_element_at(cells, F.lit(c)), F.array().cast("array<string>"))
    unknown = ~F.coalesce(tag.isin(S.CHANGE_TAGS), F.lit(False))
    return F.array_compact(
        F.array(
            entry(F.col(representation).isNotNull() & F.col(parsed).isNull(), "representation", cell("representation"), "unparsable representation notation"),
            entry(F.col(name).isNull() & ~tag.eqNullSafe("x"), "name", cell("name"), "missing name on non-retired element"),
            entry(unknown, "change_tag", F.array(tag), "unknown change tag"),
            entry(~unknown & ~tag.isin(S.LEGEND_TAGS), "change_tag", F.array(tag), "change tag outside printed legend (section 4.1)"),
        )
    )


@dataclass(frozen=True)
class Extraction:
    """``rows`` (row_id, change_tag, tag), ``cells`` (row_id, column, fragments), ``elements`` and ``reviews``."""

    rows: DataFrame
    cells: DataFrame
    elements: DataFrame
    reviews: DataFrame

    def persist(self) -> Extraction:
        """Keeps the tables that several readers share; lost blocks are computed again."""
        for d in (self.cells, self.rows, self.elements):
            d.persist()
        return self

    def unpersist(self) -> None:
        for d in (self.elements, self.rows, self.cells):
            d.unpersist()


def extract(words: DataFrame) -> Extraction:
    """Elements with ``row_id``, and the review queue, of words (page, word_no, text, x, y). A row with an unknown change tag makes no element."""
    heads, cells = rows_of(words)
    texts = joined(cells, vocabulary(cells), ["row_id", "column"])
    per = texts.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("column", "text"))).alias("texts"))
    raw = cells.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("column", "fragments"))).alias("cells"))
    r = heads.join(per, "row_id", "left").join(raw, "row_id", "left")
    text = lambda c: F.try_element_at("texts", F.lit(c))
    r = r.select("row_id", "change_tag", "tag", "cells", *[(null_if_blank(text(c)) if c == "name" else text(c)).alias(c) for c in TEXT_COLUMNS])
    r = r.withColumn("parsed", notation(F.col("representation")))
    r = r.withColumn("reviews", review_rules(r, "change_tag", "name", "representation", "parsed", F.col("cells")))
    page = F.col("row_id.page")
    kept = r.where(F.col("change_tag").isin(S.CHANGE_TAGS))
    elements = kept.select("row_id", "tag", "name", "description", F.col("parsed").alias("representation"), "change_tag", status_of(F.col("change_tag")).alias("status"), "old_name", "business_term", "notes", "bridges", F.struct(page.alias("page")).alias("provenance"))
    reviews = r.select(page.alias("page"), "tag", F.explode("reviews").alias("r")).select("page", "tag", "r.field", "r.raw_fragments", "r.issue", "r.confidence")
    return Extraction(heads, cells, elements, reviews)


def wrapped_cells(cells: DataFrame, fragments: str = "fragments") -> DataFrame:
    """One row: wrapped_cells, the number of cells of more than one line."""
    return cells.agg(F.count_if(F.size(fragments) > 1).alias("wrapped_cells"))


def statistics(x: Extraction) -> DataFrame:
    """One row: rows, elements, reviews, change_tags (a map) and wrapped_cells."""
    tags = x.rows.groupBy("change_tag").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("change_tag", "n")))).alias("change_tags"))
    counts = x.elements.agg(F.count("*").alias("elements")).crossJoin(x.reviews.agg(F.count("*").alias("reviews"))).crossJoin(wrapped_cells(x.cells))  # one row each
    return tags.crossJoin(counts).select("rows", "elements", "reviews", "change_tags", "wrapped_cells")
