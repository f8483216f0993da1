"""Content checks: rows of (check, status, detail). Each counts all that differs and names the first ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.notation import bridges, first_zones
from ..functions.text import name_tail
from ..operators import scan as S
from ..operators.lookup import characters, content_diff, dangling_references, multiset_diff

#: The known tails of element names.
NAME_TAILS = ["Text", "Code", "Identifier", "Indicator", "Amount", "Quantity", "Measure", "DateTime", "Text.Text", "Rate", "Time", "Number"]


def _row(name: str, bad: DataFrame, detail: Column, otherwise: str, order: Column | None = None, limit: int = 20, separator: str = "; ", fine: DataFrame | None = None, lead: str = "") -> DataFrame:
    """One row: pass if ``bad`` is empty, else ``otherwise`` with how many there are and the first details in order, at most ``limit``.

    ``fine`` is one row of one text, the detail of a pass.
    """
    named = bad.select(detail.alias("d"), (detail if order is None else order).alias("o"))
    first = named.orderBy("o", "d").limit(limit).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "d"))), lambda x: x.d), separator).alias("detail"))
    one = first.crossJoin(named.agg(F.count("*").alias("n")))  # one row each
    one = one.crossJoin(fine.select(F.col(fine.columns[0]).alias("fine"))) if fine is not None else one.withColumn("fine", F.lit(""))
    told = F.concat(F.lit(lead) if lead else F.concat(F.col("n").cast("string"), F.lit(": ")), "detail")
    return one.select(F.lit(name).alias("check"), F.when(F.col("n") == 0, "pass").otherwise(otherwise).alias("status"), F.when(F.col("n") == 0, F.col("fine")).otherwise(F.substring(told, 1, 400)).alias("detail"))


def reading_order(rows: DataFrame) -> DataFrame:
    """page, tag, previous, previous_page: rows (page, n, tag) whose tag is below that of the row before, over page ends too.

    All pages are one order, so rows are dealt by ranges of it.
    """
    s = S.lagged(S.ordered(rows.select("page", "n", "tag"), [], ["page", "n", "tag"]), [], F.struct("tag", "page"), "before")
    return s.select("page", "tag", F.col("before.tag").alias("previous"), F.col("before.page").alias("previous_page")).where(F.col("tag") < F.col("previous"))


def tag_order(rows: DataFrame) -> DataFrame:
    """``rows`` (page, n, tag) in reading order, not in the sorted order of the stored files."""
    detail = F.format_string("%d->%d (p%d/p%d)", "previous", "tag", "previous_page", "page")
    fine = rows.agg(F.format_string("tags monotonic across all %d rows in reading order", F.count("*")))
    return _row("tag_order", reading_order(rows), detail, "report", F.struct("page", "tag"), separator=", ", fine=fine)


def replacement_count(elements: DataFrame) -> DataFrame:
    """One row: n, the retired elements whose notes hold four digits."""
    return elements.agg(F.count_if((F.col("status") == "retired") & F.col("notes").rlike(r"\d{4}")).alias("n"))


def retired_references(elements: DataFrame) -> DataFrame:
    d = dangling_references(elements.where("status = 'retired' AND notes IS NOT NULL"), "tag", "notes", elements, "tag")
    fine = replacement_count(elements).select(F.format_string("%d replacement references all resolve to existing tags", "n"))
    return _row("retired_references", d, F.concat_ws("->", "key", "ref"), "report", F.struct("key", "ref"), separator=", ", fine=fine)


def zone_total(elements: DataFrame, text: str = "bridges") -> DataFrame:
    """One row: zones, how many all bridge texts hold."""
    return elements.agg(F.coalesce(F.sum(F.size(first_zones(F.col(text)))), F.lit(0)).alias("zones"))


def bridge_faults(elements: DataFrame) -> DataFrame:
    """tag, fault: bridge texts without an entry, and zones out of range or order."""
    e = elements.where("bridges IS NOT NULL").select("tag", F.size(bridges(F.col("bridges"))).alias("n"), first_zones(F.col("bridges")).alias("zones"))
    none = e.where("n = 0").select("tag", F.lit("bridges without a scheme entry").alias("fault"))
    z = e.select("tag", F.explode("zones").alias("z")).select("tag", "z.*")
    fault = lambda a, b, most, what: F.when(~(F.col(a).between(1, most) & F.col(b).between(1, most) & (F.col(a) <= F.col(b))), F.format_string(f"{what} %d-%d out of range", a, b))
    both = F.array_compact(F.array(fault("line_from", "line_to", 99, "lines"), fault("pos_from", "pos_to", 82, "positions")))
    return none.unionByName(z.select("tag", F.explode(both).alias("fault")))


def bridge_zones(elements: DataFrame) -> DataFrame:
    fine = zone_total(elements).select(F.format_string("%d UNLK zones parsed, spans in range", "zones"))
    return _row("bridge_zones", bridge_faults(elements), F.concat_ws(": ", "tag", "fault"), "fail", F.col("tag"), 5, fine=fine)


def name_tails(elements: DataFrame, name: str = "name") -> DataFrame:
    """tail, n, known: the distribution of name tails, unstripped."""
    t = elements.where(F.col(name).isNotNull()).groupBy(name_tail(F.col(name)).alias("tail")).agg(F.count("*").alias("n"))
    return t.withColumn("known", F.col("tail").isin(NAME_TAILS) | F.col("tail").startswith("DateTime"))


def open_endings(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.where(F.col(text).isNotNull() & ~F.col(text).endswith(".")).select(key)


def text_length(rows: DataFrame, text: str) -> DataFrame:
    """One row: n, the characters of all texts."""
    return rows.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("n"))


def cell_texts(elements: DataFrame) -> DataFrame:
    """text: the seven printed cells of each element, those that are not null."""
    cells = F.array_compact(F.array("name", "description", "representation.raw", "old_name", "business_term", "notes", "bridges"))
    return elements.select(F.explode(cells).alias("text"))


def character_conservation(words: DataFrame, cells: DataFrame, rows: DataFrame, elements: DataFrame) -> DataFrame:
    """Two stages: the words of the text columns against the raw cell lines (routing), and these against the elements' texts (joining).

    ``words`` has text and x, ``cells`` row_id, column and fragments, ``rows`` row_id and change_tag. The only loss
    that is allowed is the point printed for the name of a retired element.
    """
    table = words.where("x >= 130").select("text")
    raw = cells.select("row_id", "column", F.explode("fragments").alias("text"))
    dots = cells.where((F.col("column") == "name") & (F.col("fragments") == F.array(F.lit(".")))).join(rows.where("change_tag = 'x'"), "row_id", "left_semi").select(F.lit(".").alias("text"))
    routing = multiset_diff(characters(table, "text"), characters(raw, "text"), "ch", "n").withColumn("stage", F.lit("routing"))
    joining = multiset_diff(characters(raw, "text"), characters(cell_texts(elements).unionByName(dots), "text"), "ch", "n").withColumn("stage", F.lit("joining"))
    # The second stage speaks only where the first is clean.
    joining = joining.join(routing.limit(1).select(F.lit("joining").alias("stage")), "stage", "left_anti")
    fine = text_length(table, "text").select(F.format_string("%d word chars -> raw fragments -> cells, exact multiset match in both stages", "n"))
    return _row("character_conservation", routing.unionByName(joining), F.format_string('%s: "%s": %d vs %d', "stage", "ch", "n_left", "n_right"), "fail", F.col("ch"), 100, fine=fine)


def uid_reconciliation(words: DataFrame, elements: DataFrame) -> DataFrame:
    """Every four-digit word of the second column against the elements' tags, by number of occurrences."""
    uids = words.where((F.col("x") >= 100) & (F.col("x") < 130) & F.col("text").rlike(r"^\d{4}$")).select(F.col("text").cast("int").alias("tag"))
    fine = uids.agg(F.format_string("%d UID words, per-tag counts match", F.count("*")))
    return _row("uid_reconciliation", multiset_diff(uids, elements.select("tag"), "tag"), F.format_string("%d: %d words, %d elements", "tag", "n_left", "n_right"), "fail", F.col("tag"), fine=fine)


def regeneration(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Two sets of files (path, content): what a fresh extraction writes, and what is stored."""
    fine = fresh.agg(F.format_string("all %d files byte-identical to fresh extraction", F.count("*")))
    return _row("regeneration", content_diff(fresh, stored, "path", "content"), F.concat_ws(" ", "path", "status"), "fail", fine=fine)


def tails_report(elements: DataFrame) -> DataFrame:
    """Always a report: the eight commonest tails, then the unknown ones."""
    t = name_tails(elements).withColumn("line", F.concat_ws("=", "tail", "n"))
    joined = lambda d: d.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "tail", "line"))), lambda x: x.line), " ").alias("x"))
    top, odd = joined(t.orderBy(F.desc("n"), "tail").limit(8)), joined(t.where("NOT known").orderBy(F.desc("n"), "tail").limit(20))
    one = top.select(F.col("x").alias("top")).crossJoin(odd.select(F.col("x").alias("odd")))  # one row each
    told = F.concat(F.lit("tails: "), "top", F.when(F.col("odd") == "", " (no unknown tails)").otherwise(F.concat(F.lit(" | unknown tails: "), "odd")))
    return one.select(F.lit("name_tails").alias("check"), F.lit("report").alias("status"), told.alias("detail"))


def endings_report(elements: DataFrame) -> DataFrame:
    """Always a report."""
    fine = elements.agg(F.format_string("all %d descriptions end with a period", F.count("description")))
    return _row("description_endings", open_endings(elements, "tag", "description"), F.col("tag").cast("string"), "report", F.col("tag"), 10, ", ", fine).withColumn("status", F.lit("report"))


def verify(elements: DataFrame) -> DataFrame:
    """The checks that need nothing but the elements."""
    return reduce(DataFrame.unionByName, [retired_references(elements), bridge_zones(elements), tails_report(elements), endings_report(elements)])


def verify_source(elements: DataFrame, words: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """All eight checks: those of ``verify``, and those that read the source's words again; regeneration if the ``stored`` files (path, content) are given.

    The checks run here, one after the other, as they share one extraction; the result holds their eight rows.
    """
    from ..operators.extraction import extract
    from ..operators.ordered import layout_lines
    from ..sinks.writers import review_file, stored_form, yaml_files

    kept = layout_lines(words).persist()
    x = extract(words).persist()
    order = x.rows.select("row_id.page", "row_id.n", "tag")
    fresh = yaml_files(x.elements.drop("row_id")).unionByName(review_file(x.reviews))
    parts = [regeneration(stored_form(fresh), stored)] if stored is not None else []
    parts += [character_conservation(kept, x.cells, x.rows, elements), uid_reconciliation(kept, elements), tag_order(order), retired_references(elements), bridge_zones(elements), tails_report(elements), endings_report(elements)]
    told = [tuple(p.first()) for p in parts]
    x.unpersist()
    kept.unpersist()
    return words.sparkSession.createDataFrame(told, "check string, status string, detail string")
