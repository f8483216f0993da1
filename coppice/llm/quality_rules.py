"""Quality rules by distribution divergence, with DataFrame functions only.

A document's histogram of character classes and its histogram of common words are compared with those of its
language by Jensen-Shannon distance (base 2, so from 0 to 1). The references are the sums over all documents of a
language that pass the base rules and are long enough; each document counts with weight one, so that a few long ones
don't rule. A document of fewer than ``min_words`` words, or of a language with fewer than ``min_reference`` such
documents, is not judged by its distributions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Parts into which a language's rows are dealt where its reference can't be broadcast.
SALTS = 64

#: The commonest function words of the languages that the rules know.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are with as be this by from or at an not have but".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au plus ne se ce il sont".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}

#: Character classes, by what a pattern finds (loud marks count twice); white space is counted with the words, lower case and the rest is what is left.
CLASSES = {"symbol": r"[#*$%&|<>]", "digit": "[0-9]", "upper": r"\p{Lu}", "point": r"[.,;:!?'\"()-]", "loud": "[!|]"}

_GAP = r"[\x20\x09-\x0D]+"


def _found(c: Column, pattern: str) -> Column:
    """How many characters of a class a text has; a text without any is only scanned."""
    size = F.length if "Lu" in pattern else F.octet_length  # the bytes of ASCII characters need no counting
    return F.when(c.rlike(pattern), size(c) - size(F.regexp_replace(c, pattern, ""))).otherwise(0)


def _repeated(hashes: Column) -> Column:
    """A hash of each 5-word window, made of the words' hashes, so that each word's letters are read once."""
    n = F.size(hashes)
    window = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(5)])
    return F.when(n < 5, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - 5, F.lit(0))), window))


def _without_blanks(c: Column) -> Column:
    for x in " \t\n\x0b\x0c\r":
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def features(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """key, lang, the base counts, and the two histograms ``classes`` and ``common``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = docs.select(F.col(key).alias("key"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), t.alias("t"))
    inner = F.btrim("t", F.lit(" \t\n\x0b\x0c\r"))
    d = d.withColumn("words", F.when(inner != "", F.split(inner, _GAP)).otherwise(F.array().cast("array<string>")))
    d = d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    d = d.withColumn("windows", _repeated(F.col("hashes")))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""))
    every = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    # The common words of a text as one string: counting one of them is then a byte search.
    seen = F.filter("words", lambda w: F.lower(w).isin(every))
    d = d.withColumn("seen", F.concat(F.lit(" "), F.lower(F.array_join(seen, "  ")), F.lit(" ")))
    # The sorted (window, position) pairs tell which windows stand next to an equal one; the runs of their positions are joined.
    order = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("order", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), order))
    twice = F.array_sort(F.filter(F.transform("order", lambda x, k: F.when((x.h == F.get("order", k - 1).h) | (x.h == F.get("order", k + 1).h), x.i)), lambda i: i.isNotNull()))
    d = d.withColumn("twice", twice)
    covered = F.aggregate(F.transform("twice", lambda i, k: F.when(k + 1 < F.size("twice"), F.least(F.lit(5), F.get("twice", k + 1) - i)).otherwise(5)), F.lit(0).cast("long"), lambda a, x: a + x)
    n_chars = F.length("t")
    d = d.withColumns({k: _found(F.col("t"), p) for k, p in CLASSES.items()}).withColumn("word_chars", F.length(_without_blanks(F.col("t"))))
    classes = F.array(*[F.col(k).cast("double") for k in CLASSES], (n_chars - F.col("word_chars")).cast("double"), F.greatest(F.lit(0), F.col("word_chars") - sum(F.col(k) for k in CLASSES if k != "loud")).cast("double"))
    listed = F.create_map(*[x for k, ws in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, ws)))])
    common = F.transform(F.get(F.filter(F.array(F.element_at(listed, F.col("lang"))), lambda x: x.isNotNull()), F.lit(0)), lambda w: ((F.octet_length("seen") - F.octet_length(F.replace("seen", F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2)).cast("double"))
    n_words = F.size("words").cast("long")
    return d.select(
        "key", "lang", n_words.alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        F.col("symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        classes.alias("classes"),
        F.when(common.isNotNull(), F.concat(common, F.array((n_words - F.aggregate(common, F.lit(0.0), lambda a, x: a + x)).cast("double")))).alias("common"),
    )


def _shares(a: Column) -> Column:
    """Histogram with sum 1, each count raised by a half so that an unseen class costs a finite distance."""
    total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x + 0.5)
    return F.transform(a, lambda x: (x + 0.5) / total)


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""

    def term(x: Column, y: Column) -> Column:
        m = (x + y) / 2
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    d = F.aggregate(F.zip_with(p, q, lambda x, y: (term(x, y) + term(y, x)) / 2), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.when(d < 0, 0.0).otherwise(d))  # null without a reference


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", min_words: int = 30, min_reference: int = 20, max_class_distance: float = 0.16, class_noise: float = 0.8, max_word_distance: float = 0.20, word_noise: float = 1.0, max_broadcast: int = 1000
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept.

    A null or empty text has no words and fails the base rules. Null or unknown languages have no word histogram; they
    share one class reference. Repeated rows are judged one by one; extra columns are not read; an empty table gives no
    rows. The distances are null where a guard holds, and a null distance rejects nothing. The references are broadcast
    if they are ``max_broadcast`` rows at most; more are joined with each language's rows salted.
    """
    from pyspark import StorageLevel

    f = features(docs, key, text, lang)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    f = f.withColumn("base_failed", base).withColumn("classes", _shares(F.col("classes"))).withColumn("common", _shares(F.col("common")))
    f = f.persist(StorageLevel.DISK_ONLY)  # counts only, no texts; lost blocks are computed again from the input
    good = f.where(~F.col("base_failed") & (F.col("n_words") >= min_words))
    # Sums by position keep the aggregation map-side; the result has a row for each language and position.
    def reference(column: str) -> DataFrame:
        each = good.where(F.col(column).isNotNull()).select("lang", F.posexplode(column).alias("k", "x")).groupBy("lang", "k").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
        return each.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s.x).alias(f"ref_{column}"), F.max("n").alias(f"n_{column}"))

    refs = reference("classes").join(reference("common"), "lang", "left").where(F.col("n_classes") >= min_reference)
    refs = stored(refs, "references")
    # Rows go to their reference, not to the task of their language, of which a corpus has few.
    if refs.count() <= max_broadcast:
        j = f.join(F.broadcast(refs), "lang", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        j = f.withColumn("salt", F.pmod(F.xxhash64("key", "classes"), F.lit(SALTS)).cast("int")).join(refs.withColumn("salt", salts), ["lang", "salt"], "left")
    j = j.withColumn("long", F.col("n_words") >= min_words)
    j = j.withColumn("class_distance", F.when(F.col("long"), js_distance(F.col("classes"), F.col("ref_classes"))))
    j = j.withColumn("word_distance", F.when(F.col("long"), js_distance(F.col("common"), F.col("ref_common"))))
    noise = 1 / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))  # what sampling adds to a distance shrinks with the root of the length
    far = F.coalesce(F.col("class_distance") > max_class_distance + class_noise * noise, F.lit(False)) | F.coalesce(F.col("word_distance") > max_word_distance + word_noise * noise, F.lit(False))
    return j.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", (~F.col("base_failed") & ~far).alias("kept"))
