"""Profile the batches of a stream as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.profile import profile_batch
from ..spec import ProfileSpec


QUERY_ID = "sql.streaming.queryId"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def profile_stream(stream: DataFrame, spec: ProfileSpec, checkpoint: str, name: str = "stream",
                   clock: Callable[[], dt.datetime] = _now, available_now: bool = False) -> StreamingQuery:
    """Profile every micro-batch of a stream as a batch of the source.

    Batches are named after the stream, its query id, which lives in the checkpoint, and their number: one that is delivered again
    after a failure is found in the ledger and skipped, and those of a new checkpoint, which counts from 0 again, are not.
    ``clock`` gives the analysis time of a batch.
    """

    def profile(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
            if not query:
                raise RuntimeError("the micro-batch does not tell its query's id")
            profile_batch(batch.sparkSession, batch, f"{name}-{query}-{number}", spec, clock())

    writer = stream.writeStream.foreachBatch(profile).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
