"""Test rows that arrive as a stream, scored against a training set that stands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clearset.jobs import reference


def score_stream(rows: DataFrame, train: DataFrame, out: str, checkpoint: str, k: int = 5, bits: int = 64) -> StreamingQuery:
    """Start a query that adds each micro-batch of (id, vec, hash, text) to the log ``out``; a batch
    that is run again replaces its own part.  The training set is fitted when the first query
    starts and kept in ``out``.  Read scores with ``stream_scores``."""
    ref = reference.fit(train, f"{out}/_reference", k, bits)

    def absorb(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            reference.absorb(ref, batch, out, number)

    return rows.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_scores(train: DataFrame, out: str, k: int = 5, bits: int = 64, fitted: bool = False) -> DataFrame:
    """(id, dup_score, ood_score) of all rows that the stream has brought so far, the same however it was
    cut into batches: among each other, or ``fitted`` against the training set."""
    ref = reference.fit(train, f"{out}/_reference", k, bits)
    return (reference.fitted_scores if fitted else reference.current_scores)(ref, out)
