"""Byte ranges of files: a large file is many tasks' work, and a range knows how to read on past its end."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import opened


def byte_ranges(spark: SparkSession, path: str, split_bytes: int, pattern: str | None = None) -> DataFrame:
    """path, begin, end, length of the ranges of all files under ``path`` that hold anything, each row a task's work.

    They are dealt over as many tasks as there are ranges: without a number Spark would put these few small rows, and so
    the reading of all files, into one task.
    """
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path).where("length > 0").select("path", "length")
    each = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("begin"))
    return apart(each.select("path", "begin", F.least(F.col("begin") + split_bytes, F.col("length")).alias("end"), "length"), max(1, each.count()))


def apart(ranges: DataFrame, n: int) -> DataFrame:
    """``ranges`` over ``n`` tasks."""
    return ranges.repartition(n, F.col("path"), F.col("begin"))


class Lines:
    """The lines of a file that begin in a range, as bytes, and what follows them."""

    def __init__(self, path: str, begin: int, end: int, length: int) -> None:
        self.file, self.length = opened(path), length
        self.begin, self.end = self._line_start(begin), self._line_start(end)

    def _line_start(self, at: int, step: int = 1 << 16) -> int:
        """Where the first line begins at ``at`` or later."""
        if at <= 0 or at >= self.length:
            return max(0, min(at, self.length))
        at -= 1  # a line may begin right here
        while at < self.length:
            k = self.read(at, step).find(b"\n")
            if k >= 0:
                return at + k + 1
            at += step
        return self.length

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(max(0, min(n, self.length - at)))

    def text(self) -> str:
        return self.own().decode("utf-8")

    def own(self) -> bytes:
        return self.read(self.begin, self.end - self.begin)

    def after(self, step: int = 1 << 16) -> Iterator[bytes]:
        """The lines past the range, without their ends, as far as the reader wants them."""
        at, rest = self.end, b""
        while at < self.length:
            piece = self.read(at, step)
            at += len(piece)
            *lines, rest = (rest + piece).split(b"\n")
            yield from lines
        if rest:
            yield rest

    def more(self, n: int) -> str:
        """About ``n`` bytes past the range, up to a line end."""
        return self.read(self.end, self._line_start(min(self.length, self.end + n)) - self.end).decode("utf-8")

    def close(self) -> None:
        self.file.close()
