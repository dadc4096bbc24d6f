"""F10 on a stream: a drift baseline that grows with every micro-batch.

Each batch is one more batch of counts, written under its batch id: a batch
replayed after a failure replaces itself, so the state counts every row once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from nutrilake.operators.drift import DriftBaseline


def start_baseline_stream(stream: DataFrame, baseline: DriftBaseline, checkpoint_dir: str, available_now: bool = True):
    """Feed ``baseline`` from a streaming DataFrame; returns the StreamingQuery.
    ``freeze`` the baseline when the stream has ended or at any time between."""
    writer = (stream.writeStream.foreachBatch(lambda batch, batch_id: baseline.add(batch, batch_id) and None)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
