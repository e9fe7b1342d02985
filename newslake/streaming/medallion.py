"""Trade messages to the bronze and silver layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslake.operators import trades
from newslake.sources.lake import batch_path, write_hours
from newslake.streaming.runs import each_batch, kept


def layer_paths(root: str) -> dict[str, str]:
    return {name: f"{root}/{name}" for name in ("bronze", "silver", "dead_letter")}


def write_layers(batch: DataFrame, batch_id: int, root: str) -> None:
    """One micro-batch to both layers and the dead letters.

    A trade without a time is placed by its arrival, which is part of the message
    and so the same when the batch is replayed.
    """
    paths = layer_paths(root)
    arrival = F.col("arrived_at")
    failed_at = F.unix_micros(arrival).cast("string")
    with kept(trades.decode_trades(batch)) as decoded:
        write_hours(trades.bronze(decoded, anchor=arrival), paths["bronze"], batch_id)
        write_hours(trades.silver(decoded, anchor=arrival), paths["silver"], batch_id)
        bad = trades.rejected(decoded, failed_at)
        bad.write.mode("overwrite").parquet(batch_path(paths["dead_letter"], batch_id))


def start(
    messages: DataFrame, root: str, checkpoint: str, bounded: bool = False
) -> StreamingQuery:
    return each_batch(
        messages, lambda batch, n: write_layers(batch, n, root), checkpoint, bounded
    )
