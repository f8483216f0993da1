"""Order-sensitive operators: gap sessions, record grouping, first and last per key, inversions, layout rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan as S
from .intervals import interval_join


def gap_sessions(rows: DataFrame, group: list[str], order: list[str], value: Column, gap: float, result: str = "session", spread: bool = False) -> DataFrame:
    """Numbers sessions from 0: a new one begins where the value exceeds the previous row's by more than ``gap``.

    ``spread`` is for groups that are too large for a task, up to all rows as one (``group`` empty): rows are then dealt
    by ranges of the order, see ``scan``, and ``order`` must break ties.
    """
    if spread:
        s = S.lagged(S.ordered(rows.withColumn("__value", value), group, order), group, F.col("__value"), "__previous")
        new = F.coalesce((F.col("__value") - F.col("__previous") > gap).cast("int"), F.lit(0))
        return S.plain(S.running(s, group, new, result)).drop("__value", "__previous")
    w = Window.partitionBy(*group).orderBy(*order)
    r = rows.withColumn("__new", F.coalesce((value - F.lag(value).over(w) > gap).cast("int"), F.lit(0)))
    return r.withColumn(result, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__new")


def group_records(rows: DataFrame, group: list[str], order: list[str], starts: Column, text: str, skip: Column | None = None, separator: str = " ", spread: bool = False) -> DataFrame:
    """group, record, text: each row that starts a record and those after it, joined in order; rows before a first start go.

    ``spread`` as in ``gap_sessions``; a record must fit a task.
    """
    if spread:
        r = S.plain(S.running(S.ordered(rows.withColumn("__start", starts), group, order), group, F.col("__start").cast("int"), "record")).drop("__start")
    else:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        r = rows.withColumn("record", F.sum(starts.cast("int")).over(w).cast("long"))
    r = r.where("record > 0")
    if skip is not None:
        r = r.where(~skip)
    parts = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t"))))
    return r.groupBy(*group, "record").agg(F.array_join(F.transform(parts, lambda x: x["__t"]), separator).alias(text))


def first_per_key(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def last_per_key(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def inversions(rows: DataFrame, group: list[str], order: list[str], value: str, spread: bool = False) -> DataFrame:
    """The rows whose value is below that of the row before; ``previous`` holds it. ``spread`` as in ``gap_sessions``."""
    if spread:
        r = S.plain(S.lagged(S.ordered(rows, group, order), group, F.col(value), "previous"))
    else:
        r = rows.withColumn("previous", F.lag(value).over(Window.partitionBy(*group).orderBy(*order)))
    return r.where(F.col(value) < F.col("previous"))


def layout_lines(words: DataFrame, gap: float = 3.0) -> DataFrame:
    """Words (page, word_no, text, x, y) with ``line``: page header and margin cropped, gap to the previous word's y."""
    kept = words.where((F.col("y") >= 79) & (F.col("x") >= 60))
    return gap_sessions(kept, ["page"], ["y", "x", "word_no"], F.col("y"), gap, "line")


def _per_line(lines: DataFrame, tags: list[str]) -> DataFrame:
    """page, line, n (row starts of the page up to here), start, and the change tag and number of a start."""
    tag_words = (F.col("x") >= 60) & (F.col("x") < 100)
    uid_words = (F.col("x") >= 100) & (F.col("x") < 130)
    per = lines.groupBy("page", "line").agg(
        F.count_if(tag_words).alias("t1"), F.count_if(uid_words).alias("u1"), F.max(F.when(tag_words, F.lower("text"))).alias("change_tag"), F.max(F.when(uid_words, F.col("text"))).alias("uid")
    )
    starts = (F.col("t1") == 1) & (F.col("u1") == 1) & F.col("change_tag").isin(tags) & F.col("uid").rlike(r"^\d{4}$")
    per = per.withColumn("start", F.coalesce(starts, F.lit(False)).cast("int"))
    return per.withColumn("n", F.sum("start").over(Window.partitionBy("page").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))


def layout_rows(lines: DataFrame, tags: list[str]) -> DataFrame:
    """Words with ``row_id``: (page of its start, number there). Lead lines of a page go on with the last row of the page before, if that page starts any; else they are dropped."""
    per = _per_line(lines, tags)
    before = per.groupBy("page").agg(F.max("n").alias("last")).select((F.col("page") + 1).alias("page"), "last")
    r = per.join(before, "page", "left").withColumn("row_id", F.when(F.col("n") > 0, F.struct("page", "n")).when(F.col("last") > 0, F.struct((F.col("page") - 1).alias("page"), F.col("last").alias("n"))))
    return lines.join(r.where("row_id IS NOT NULL").select("page", "line", "row_id"), ["page", "line"])


def row_heads(lines: DataFrame, tags: list[str]) -> DataFrame:
    """row_id, change_tag, tag of each row start."""
    return _per_line(lines, tags).where("start = 1").select(F.struct("page", "n").alias("row_id"), "change_tag", F.col("uid").cast("int").alias("tag"))


def layout_cells(words: DataFrame, route: Column) -> DataFrame:
    """row_id, column, fragments: the words of each line of a cell joined by a space in reading order, the lines in order."""
    line = words.withColumn("column", route).groupBy("row_id", "column", "page", "line").agg(F.array_sort(F.collect_list(F.struct("y", "x", "word_no", "text"))).alias("ws"))
    line = line.withColumn("fragment", F.array_join(F.transform("ws", lambda w: w.text), " "))
    return line.groupBy("row_id", "column").agg(F.transform(F.array_sort(F.collect_list(F.struct("page", "line", "fragment"))), lambda x: x.fragment).alias("fragments"))


def row_bands(words: DataFrame, margin: float = 3.0, height: float = 60.0) -> DataFrame:
    """page, tag, y0, y1 of each number in the second column: from just above it to just above the next one that is lower by more than ``margin``, else ``height`` lower.

    A range frame over y in millionths, the precision of printed boxes, finds the next one in a sorted pass.
    """
    uids = words.where((F.col("x") >= 100) & (F.col("x") < 130) & F.col("text").rlike(r"^\d{4}$"))
    uids = uids.select("page", F.col("text").cast("int").alias("tag"), "y", F.round(F.col("y") * 1_000_000).cast("long").alias("at"))
    below = Window.partitionBy("page").orderBy("at").rangeBetween(round(margin * 1_000_000) + 1, Window.unboundedFollowing)
    return uids.select("page", "tag", (F.col("y") - 1).alias("y0"), F.coalesce(F.min("y").over(below) - 1, F.col("y") + height).alias("y1"))


def band_cells(words: DataFrame, bands: DataFrame, columns: Column, parts: int | None = None) -> DataFrame:
    """page, tag, column, fragments: the words of each band by column, those of a line joined by a space, the lines in order.

    ``words`` are those of ``layout_lines``, ``columns`` names the column of a word by its place. This is the printed
    text of what an OCR program reads in a band, so it is what its reading is held against. Words outside of every band
    and columns without a name go; a word in two bands counts in both. ``parts`` is the number of tasks for tables of any
    size, see ``parts_for``.
    """
    own = words.withColumn("column", columns).where("column IS NOT NULL")
    held = interval_join(own, bands.select("page", "tag", "y0", "y1"), ["page"], "y", "y0", "y1", 60.0, parts)
    if parts:
        held = held.repartition(parts, "page", "tag", "column")  # both groupings below find their rows together
    line = held.groupBy("page", "tag", "column", "line").agg(F.array_sort(F.collect_list(F.struct("y", "x", "word_no", "text"))).alias("ws"))
    line = line.withColumn("fragment", F.array_join(F.transform("ws", lambda w: w.text), " "))
    return line.groupBy("page", "tag", "column").agg(F.transform(F.array_sort(F.collect_list(F.struct("line", "fragment"))), lambda x: x.fragment).alias("fragments"))


def vocabulary_tally(cells: DataFrame, fragments: str = "fragments") -> DataFrame:
    """word, strict, loose: words that no line end can have broken count as strict, last words of lines that are not the last as loose."""
    from ..functions.text import clean_word

    f = cells.select(F.posexplode(fragments).alias("i", "line"), F.size(fragments).alias("n"))
    w = f.select("i", "n", F.split(F.btrim("line"), r"\s+").alias("ws")).select("i", "n", F.posexplode("ws").alias("j", "w"), F.size("ws").alias("m"))
    loose = (F.col("i") < F.col("n") - 1) & (F.col("j") == F.col("m") - 1)
    w = w.select(clean_word(F.col("w")).alias("word"), loose.alias("is_loose")).where("word IS NOT NULL")
    return w.groupBy("word").agg(F.count_if(~F.col("is_loose")).alias("strict"), F.count_if("is_loose").alias("loose"))
