"""Streams equal batches; restarts and replays change nothing."""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import functions as F

from newslake.operators import embed, trades, vectors
from newslake.schemas import REFINED_ARTICLE, SILVER_TRADE
from newslake.sources import commits, lake, messages
from newslake.streaming import ingest, medallion, refine

from tests.test_trades import envelope

ARTICLE = {"title": "t", "link": "https://n.example/1", "published_at": "2026-01-27T15:10:00+00:00",
           "content": "a@b.example text", "content_length": 16, "source": "coinness",
           "crawled_at": "2026-01-27T15:11:00+00:00", "news_type": "breaking"}


def put(path, name, *values):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.txt", "w", encoding="utf-8") as out:
        out.writelines(v + "\n" for v in values)
    # File streams go by modification time; keep the order of the names.
    os.utime(f"{path}/{name}.txt", (1_700_000_000 + ord(name),) * 2)


def run(start, spark, topic, *args, **kwargs):
    stream = messages.file_stream(spark, topic, 1)
    start(stream, *args, bounded=True, **kwargs).awaitTermination()


def test_medallion(spark, folder):
    topic, root = folder("topic"), folder("lake")
    good = [envelope(t=i) for i in range(5)]
    put(topic, "a", *good[:3], "{broken")
    put(topic, "b", *good[3:], envelope(t=9, p="n/a"), envelope(t=10, drop=["T"]))
    run(medallion.start, spark, topic, root, f"{root}/checkpoint")
    paths = medallion.layer_paths(root)

    def ids():
        return sorted(r.trade_id for r in lake.scan(spark, paths["silver"], SILVER_TRADE).collect())

    assert ids() == [0, 1, 2, 3, 4, 10]
    assert spark.read.parquet(paths["bronze"]).count() == 7
    assert spark.read.parquet(paths["dead_letter"]).count() == 2
    # Nothing new: nothing happens. Something new: only that is added.
    run(medallion.start, spark, topic, root, f"{root}/checkpoint")
    assert len(ids()) == 6
    put(topic, "c", envelope(t=11))
    run(medallion.start, spark, topic, root, f"{root}/checkpoint")
    assert ids() == [0, 1, 2, 3, 4, 10, 11]


def test_replayed_batch_is_not_doubled(spark, folder):
    root = folder("replay")
    rows = spark.createDataFrame([(envelope(t=i),) for i in range(3)], "value string")
    batch = rows.withColumn("arrived_at", F.lit("2026-01-28 00:00:00").cast("timestamp"))
    for _ in range(2):
        medallion.write_layers(batch, 7, root)
    assert spark.read.parquet(medallion.layer_paths(root)["silver"]).count() == 3


def test_stream_equals_batch(spark, folder):
    topic, root = folder("topic"), folder("lake")
    values = [envelope(t=i, T=1769539097525 + i * 1_800_000, p=str(i)) for i in range(20)]
    put(topic, "a", *values[:7])
    put(topic, "b", *values[7:])
    run(medallion.start, spark, topic, root, f"{root}/checkpoint")
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    batch = trades.silver(trades.decode_trades(rows))
    stream = lake.scan(spark, medallion.layer_paths(root)["silver"], SILVER_TRADE)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_refine(spark, folder):
    topic, root = folder("topic"), folder("lake")
    put(topic, "a", json.dumps(ARTICLE), json.dumps({**ARTICLE, "published_at": "bad"}), "5")
    run(refine.start, spark, topic, root, f"{root}/checkpoint")
    rows = lake.scan(spark, f"{root}/refined", REFINED_ARTICLE).collect()
    assert [r.content for r in rows] == ["text", "text"]
    assert {r.source for r in rows} == {"coinness-breaking"}
    assert {r.content_length for r in rows} == {16}
    sent = [json.loads(r.value) for r in spark.read.text(f"{root}/messages").collect()]
    assert sorted(str(m["published_at"]) for m in sent) == ["2026-01-27T15:10:00.000000+00:00", "None"]
    assert spark.read.parquet(f"{root}/dead_letter").first().original_data == '{"_raw":"5"}'


class Sizes:
    """Embeds to two numbers; refuses 'bad'; gives three numbers for 'wide'."""

    def __call__(self, texts):
        words = texts.to_pylist()
        if any("bad" in w for w in words):
            raise ValueError("bad")
        return np.ones((len(words), 3 if any("wide" in w for w in words) else 2))


def message(link, content, **more):
    return json.dumps({"title": "t", "link": link, "content": content, "source": "s",
                       "published_at": "2026-01-27T15:10:00+00:00", **more})


def test_embedding_stream(spark, folder):
    topic, root = folder("topic"), folder("vectors")
    put(topic, "a", message("u1", "one"), message("u1", "copy"), message("", "no link"),
        message("u2", "bad"), message("u3", ""), "{broken")
    put(topic, "b", message("u1", "again"), message("", "linked", url="u4"), message("", "no link"))
    put(topic, "c", message("u5", "wide"))
    kwargs = {"embedder": Sizes(), "dimension": 2, "waits": (0, 0, 0)}
    run(ingest.start, spark, topic, root, f"{root}_checkpoint", **kwargs)
    table = vectors.current(spark, root)
    rows = {(r.url, r.content) for r in table.collect()}
    assert rows == {("u1", "one"), ("", "no link"), ("u4", "linked")} or rows == {
        ("u1", "copy"), ("", "no link"), ("u4", "linked")}
    errors = sorted(r.error_msg for r in spark.read.parquet(f"{root}_dead_letter").collect())
    assert errors == sorted([embed.GAVE_UP, "malformed JSON", vectors.WRONG_SIZE])


def test_stream_and_batch_share_a_table(spark, folder, monkeypatch):
    """Batch run 0 and stream batch 0 both survive, URLs are checked across writers, and folders stay few."""
    monkeypatch.setattr(vectors.keep_few_folders, "__defaults__", (2,))
    topic, root = folder("topic"), folder("shared")
    loaded = spark.createDataFrame([("t", "from batch", "u1", "s"), ("t", "both", "u2", "s")], "title string, content string, link string, source string")
    loaded = loaded.withColumn("published_at", F.lit("2026-01-27 15:10:00").cast("timestamp"))
    ingest.ingest(spark, loaded, root, 0, embed.HashedWords(2), F.lit("now"), ["published_at", "title", "content"], path="p")
    put(topic, "a", message("u2", "both"), message("u3", "from stream"))
    put(topic, "b", message("u3", "again"), message("u4", "later"))
    put(topic, "c", message("u5", "last"))
    kwargs = {"embedder": Sizes(), "dimension": 2, "waits": (0, 0, 0)}
    run(ingest.start, spark, topic, root, f"{root}_checkpoint", **kwargs)
    stored = sorted(r.content for r in vectors.current(spark, root).collect())
    assert stored == ["both", "from batch", "from stream", "last", "later"]
    state = commits.state(spark, root)
    assert state.done == {"batch": 0, "stream": 2} and len(state.folders) <= 2
    rows = spark.createDataFrame([(message("u9", "not twice"),)], "value string").withColumn("arrived_at", F.current_timestamp())
    ingest.write_vectors(rows, 2, root, Sizes(), 2)  # a replay after the commit does nothing
    assert commits.state(spark, root) == state


def test_ingest_twice_stores_nothing_new(spark, folder):
    root = folder("ingest")
    loaded = spark.createDataFrame(
        [("t", "x" * 701, "u1", "s"), ("t", "dup", "u1", "s"), ("t", "", "u2", "s"),
         ("t", "y", "u3", "s")],
        "title string, content string, link string, source string",
    ).withColumn("published_at", F.lit("2026-01-27 15:10:00").cast("timestamp"))

    def go(version):
        report = ingest.ingest(spark, loaded, root, version, embed.HashedWords(8),
                               F.lit("now"), ["published_at", "title", "content"], path="p")
        return report.first().asDict()

    # The first of two articles with one URL is 'dup', by the order given.
    first = go(0)
    assert first == {"status": "success", "articles_loaded": 4, "articles_processed": 2,
                     "articles_skipped": 1, "chunks_uploaded": 2, "target_path": "p"}
    assert go(0) == first  # a repeated run replaces itself
    again = go(1)
    assert (again["articles_processed"], again["chunks_uploaded"]) == (0, 0)
    assert again["articles_skipped"] == 3
    table = vectors.current(spark, root)
    assert sorted(r.content for r in table.collect()) == ["dup", "y"]


def test_no_data(spark, folder):
    report = ingest.ingest_slice(spark, folder("none"), folder("none"), 0, embed.HashedWords(8),
                                 F.lit("now"), year=2026).first()
    assert (report.status, report.articles_loaded) == ("no_data", 0)


def test_failing_chunk_fails_the_batch_ingest(spark, folder):
    loaded = spark.createDataFrame([("t", "bad", "u", "s")],
                                   "title string, content string, link string, source string")
    loaded = loaded.withColumn("published_at", F.current_timestamp())

    class Refuses:
        def __call__(self, texts):
            raise ValueError

    original = embed.ATTEMPTS
    try:
        embed.ATTEMPTS = 0
        ingest.ingest(spark, loaded, folder("bad"), 0, Refuses(), F.lit("now"), ["title"])
        raise AssertionError("must fail")
    except Exception as error:
        assert "embedding failed" in str(error)
    finally:
        embed.ATTEMPTS = original
