"""Queue messages: each id once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedupe_messages(
    messages: DataFrame, key: str = "message_id", time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Each message id once. With a time column, ids older than `delay` are forgotten and
    the state stays bounded; without, ids are remembered for good."""
    if time is None:
        return messages.dropDuplicates([key])
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
