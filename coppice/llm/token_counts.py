"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the corpus's most frequent chunks (see ``chunks``) with their numbers of tokens. It is
found over all documents: each task sends the counts of its own ``per_task`` most frequent chunks, so what is shuffled
is bounded by the number of tasks, and the ``table_size`` largest sums are broadcast. Tier two is a cache in each
Python worker; only what misses both is encoded by the library. No chunk of a text is ever shuffled, and neither tier
can change a count, only its cost.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .shared import numbered

_libraries: dict = {}
_caches: dict = {}


def library(path: str):
    """A function from a list of texts to their numbers of tokens, loaded once in each worker."""
    if path not in _libraries:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _libraries[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            import tokenizers

            model = tokenizers.Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            _libraries[path] = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
    return _libraries[path]


def _split(path: str, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Chunks where the library treats them alike alone; a sentencepiece model sees whole texts."""
    return (texts, np.arange(len(texts) + 1)) if path.endswith(".model") else C.chunked(texts)


def frequent(docs: DataFrame, text: str = "text", per_task: int = 1024, table_size: int = 32768, longest: int = 64) -> list[str]:
    """The most frequent chunks of all texts, most frequent first, at most ``table_size`` of up to ``longest`` bytes."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        for batch in batches:
            for _, texts in C.slices(batch, "text"):
                index, distinct = C.coded(C.chunked(texts)[0])
                n = np.bincount(index, minlength=len(distinct))
                for k in np.argsort(-n, kind="stable")[: 4 * per_task]:
                    if len(c := distinct[int(k)].as_py()) <= longest:
                        found[c] = found.get(c, 0) + int(n[k])
            if len(found) > 64 * per_task:
                found = dict(sorted(found.items(), key=lambda x: (-x[1], x[0]))[: 32 * per_task])
        best = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:per_task]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in best], pa.string()), pa.array([v for _, v in best], pa.int64())], ["chunk", "n"])

    per = numbered(docs, text).select("text").mapInArrow(top, "chunk string, n long")
    return [r.chunk for r in per.groupBy("chunk").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "chunk").limit(table_size).collect()]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024, cache_size: int = 400_000) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null keys stay as they are; other columns, also
    ones named like the results, are not read; an empty table gives no rows. Texts of any length are counted whole.
    """
    spark = docs.sparkSession
    table: list[str] = [] if path.endswith(".model") else frequent(docs, text)
    known = spark.sparkContext.broadcast((table, library(path)(table) if table else []))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, memo = library(path), _caches.setdefault(path, C.Memo(cache_size))
        first, lengths = pa.array(known.value[0], pa.large_string()), np.array([*known.value[1], -1], dtype=np.int64)
        for batch in batches:
            for part, texts in C.slices(batch, "text"):
                pieces, off = _split(path, texts)
                index, distinct = C.coded(pieces)
                at = pc.index_in(distinct, value_set=first).fill_null(len(first)).to_numpy(zero_copy_only=False)
                n = lengths[at]
                missing = np.flatnonzero(n < 0)
                n[missing] = memo.values(distinct.take(pa.array(missing)), lambda new: [pa.array(encode(new.to_pylist()), pa.int64())])[0].to_numpy()
                tokens = C.summed(n[index], off) if len(index) else np.zeros(len(texts), np.int64)
                size = np.diff(C.raw(texts)[1])
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    rows = numbered(docs, text).select(F.col(key).alias("key"), "text")
    return rows.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
