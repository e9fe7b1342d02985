"""Raw articles to the refined lake and to the topic the embedding stream reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newslake.operators import decode, news, publish
from newslake.schemas import RAW_ARTICLE
from newslake.sources.lake import batch_path, write_hours
from newslake.sources.messages import REFINED_TOPIC
from newslake.streaming.runs import each_batch, kept, send


def write_refined(
    batch: DataFrame, batch_id: int, root: str, servers: str | None = None
) -> None:
    """One micro-batch to the lake, the dead letters, and the refined topic, or text
    files where there is no broker."""
    with kept(decode.parse(batch, RAW_ARTICLE)) as parsed:
        with kept(news.refine(decode.good(parsed, RAW_ARTICLE, "arrived_at"), anchor=F.col("arrived_at"))) as refined:
            write_hours(refined, f"{root}/refined", batch_id)
            sent = publish.refined_messages(refined)
            if servers:
                send(sent, REFINED_TOPIC, servers)
            else:
                sent.write.mode("overwrite").text(batch_path(f"{root}/messages", batch_id))
        decode.bad(parsed).write.mode("overwrite").parquet(batch_path(f"{root}/dead_letter", batch_id))


def start(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    bounded: bool = False,
    servers: str | None = None,
) -> StreamingQuery:
    return each_batch(
        messages, lambda batch, n: write_refined(batch, n, root, servers), checkpoint, bounded
    )
