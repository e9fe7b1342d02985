"""How a stream is started: in a bounded run or on a clock, always checkpointed."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "5 minutes"


@contextmanager
def kept(decoded: DataFrame) -> Iterator[DataFrame]:
    """A decoded batch on memory and disk while its several outputs are written, so that its JSON is parsed once."""
    held = decoded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def send(messages: DataFrame, topic: str, servers: str) -> None:
    """Publish ``value`` (and ``key``, if any) to a topic. Delivery is at least
    once: a replayed batch is sent again, and readers drop what they hold."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()


def each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    bounded: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Run ``handle`` per micro-batch.

    ``bounded`` handles what is there, in batches capped by the source, including
    the last part batch, and stops.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if bounded else {"processingTime": every}
    return writer.trigger(**trigger).start()
