"""YAML element files and review queues as a Python data source: one partition per file."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from ..schemas import ELEMENT, REVIEW
from .paths import content, exists, listed

_FILE = f"file string, file_no int, category string, ord int, {ELEMENT}"


class YamlSource(DataSource):
    """``format("coppice_yaml")``: option ``path`` is a folder or a file, ``kind`` is elements (default) or review.

    With ``prune`` files are known by their names, ``first-last.yaml``, to hold nothing but tags of that range, and a
    condition on ``tag`` opens none but those that it can meet. ``spark.sql.python.filterPushdown.enabled`` must be set.
    """

    @classmethod
    def name(cls) -> str:
        return "coppice_yaml"

    def schema(self) -> str:
        return _FILE if self.options.get("kind", "elements") == "elements" else f"file string, ord int, {REVIEW}"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PruningReader(self.options) if self.options.get("prune", "false").lower() == "true" else _Reader(self.options)


def name_range(path: str) -> tuple[int, int] | None:
    """First and last tag of a file by its name; None if the name says nothing."""
    m = re.fullmatch(r"(\d+)-(\d+)\.yaml", path.rpartition("/")[2])
    return (int(m[1]), int(m[2])) if m else None


def may_meet(f: Filter) -> Callable[[int, int], bool] | None:
    """Whether a range of tags, by its first and last, can hold one that meets a condition; None if it is none on ``tag``."""
    if getattr(f, "attribute", None) != ("tag",):
        return None
    match f:
        case EqualTo(value=v) | EqualNullSafe(value=v) if v is not None:
            return lambda lo, hi: lo <= v <= hi
        case GreaterThan(value=v):
            return lambda lo, hi: hi > v
        case GreaterThanOrEqual(value=v):
            return lambda lo, hi: hi >= v
        case LessThan(value=v):
            return lambda lo, hi: lo < v
        case LessThanOrEqual(value=v):
            return lambda lo, hi: lo <= v
        case In(value=vs):
            return lambda lo, hi: any(v is not None and lo <= v <= hi for v in vs)
    return None


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.kind = options["path"], options.get("kind", "elements")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((i, f)) for i, f in enumerate(listed(self.path, ".yaml"))]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        import yaml

        if partition is None:  # Spark asks once where there is no partition
            return
        number, path = partition.value
        data = yaml.load(content(path), Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader)) or {}
        name = path.rpartition("/")[2]
        if self.kind != "elements":
            for i, e in enumerate(data.get("entries") or []):
                yield (name, i, e.get("page"), e.get("tag"), e.get("field"), e.get("raw_fragments"), e.get("issue"), e.get("confidence"))
            return
        text = lambda v: None if v is None else str(v)
        for i, e in enumerate(data.get("elements") or []):
            r, p = e.get("representation"), e.get("provenance")
            shape = None if r is None else (text(r.get("raw")), text(r.get("charset")), r.get("min_length"), r.get("max_length"))
            yield (name, number, text(data.get("category")), i, e.get("tag"), text(e.get("name")), text(e.get("description")), shape, text(e.get("change_tag")), text(e.get("status")), text(e.get("old_name")), text(e.get("business_term")), text(e.get("notes")), text(e.get("bridges")), None if p is None else (p.get("page"),))


class _PruningReader(_Reader):
    """Opens the files that conditions on ``tag`` can meet."""

    def __init__(self, options) -> None:
        super().__init__(options)
        self.tests: list[Callable[[int, int], bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keeps what a condition on ``tag`` says of a file's range; every condition is left to Spark too, as a range holds more than it asks for."""
        self.tests = [t for f in filters if (t := may_meet(f)) is not None]
        return filters

    def partitions(self) -> list[InputPartition]:
        fits = lambda path: (r := name_range(path)) is None or all(t(*r) for t in self.tests)
        return [p for p in super().partitions() if fits(p.value[1])]


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    spark.dataSource.register(YamlSource)
    return spark.read.format("coppice_yaml").option("path", path).option("kind", kind).load()


def elements(spark: SparkSession, path: str, prune: bool = False) -> DataFrame:
    """All elements of a folder, with file, file_no (path order), category and ord (place in the file).

    ``prune`` trusts the files' names: conditions on ``tag`` leave files of other ranges unopened. Validation must not,
    as it looks for tags outside of their file's range.
    """
    if not prune:
        return _read(spark, path, "elements")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(YamlSource)
    return spark.read.format("coppice_yaml").option("path", path).option("prune", "true").load()


def review_queue(spark: SparkSession, path: str) -> DataFrame:
    """Review entries; a missing file gives no rows here and an error in ``checks.validate``."""
    return _read(spark, path, "review") if exists(path) else spark.createDataFrame([], f"file string, ord int, {REVIEW}")


def context_terms(spark: SparkSession, path: str) -> DataFrame:
    """term, iri of the ``@context`` map of a YAML-LD file; one row each."""
    lines = spark.read.text(path, wholetext=True).select(F.regexp_extract_all("value", F.lit(r'(?m)^\s+([\w"@-]+:\s+\S+)\s*$'), F.lit(1)).alias("ls"))
    t = lines.select(F.explode("ls").alias("l")).select(F.regexp_replace(F.regexp_extract("l", r"^([^:]+):", 1), '"', "").alias("term"), F.regexp_replace(F.regexp_extract("l", r"^[^:]+:\s+(\S+)$", 1), '"', "").alias("iri"))
    return t.where(F.col("iri") != "")
