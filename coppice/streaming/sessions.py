"""Gap sessions on a stream: the batch operator's sessions, from rows in any order within a bound on lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_sessions(rows: DataFrame, key: str, time: str, gap_us: int, lateness: str) -> DataFrame:
    """key, first, last, n of the sessions of a stream: as in ``ordered.gap_sessions``, a new one begins where ``time`` exceeds the previous row's by more than ``gap_us``.

    State is one row for each open session, and merges as late rows close gaps. A session is given out once, when no row
    that is on time can reach it any more. A row is late if its time lies more than ``lateness`` before the greatest time
    of earlier batches: such a row is dropped and counted in ``numRowsDroppedByWatermark``. Rows without a time are
    dropped; rows without a key are sessions of the null key. Repeated rows count each.
    """
    # Spark's windows end a gap after the last row and hold what begins before that end, so a microsecond more takes in a gap of just gap_us.
    window = F.session_window("__time", f"{gap_us + 1} microseconds")
    r = rows.select(F.col(key).alias(key), F.col(time).cast("timestamp").alias("__time")).withColumn("__at", F.col("__time")).withWatermark("__time", lateness)
    return r.groupBy(window.alias("__window"), key).agg(F.min("__at").alias("first"), F.max("__at").alias("last"), F.count("*").alias("n")).select(key, "first", "last", "n")


def run_once(sessions: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Takes in all that the stream has now, batch after batch, writes closed sessions as Parquet to ``folder`` and stops. Run again with the same ``checkpoint`` it goes on where it stopped, each session written once."""
    q = sessions.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
