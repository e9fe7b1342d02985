"""Embedding, search, deduplication and the vector table."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newslake.functions.vectors import cosine
from newslake.operators import dedup, embed, retrieval, search, vectors
from newslake.sources import commits


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of all vectors are copies of one, so equal scores abound."""
    rng = np.random.default_rng(3)
    points = rng.normal(size=(600, 8))
    points[::3] = points[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    return points, spark.createDataFrame(rows, "id long, vector array<double>").repartition(5)


def brute_force(questions, points, k):
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    asked = questions / np.linalg.norm(questions, axis=1, keepdims=True)
    scores = np.round(asked @ unit.T, search.SCORE_DIGITS)
    return {
        q: sorted(range(len(points)), key=lambda i: (-scores[q][i], i))[:k]
        for q in range(len(questions))
    }


@pytest.mark.parametrize("block_bytes", [8 * 8 * 3, search.BLOCK_BYTES])
@pytest.mark.parametrize("k", [1, 5])
def test_nearest_is_exact(spark, corpus, k, block_bytes):
    points, table = corpus
    questions = np.vstack([points[:6], np.random.default_rng(5).normal(size=(4, 8))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(questions)]
    asked = spark.createDataFrame(rows, "question_id long, vector array<double>")
    hits = search.nearest(asked, table, k, 8, block_bytes).collect()
    got = {q: [h.id for h in sorted(hits, key=lambda h: h.rank) if h.question_id == q]
           for q in range(len(questions))}
    assert got == brute_force(questions, points, k)
    assert all(-1 <= h.score <= 1 for h in hits)


def test_nearest_keeps_k_per_task_before_the_merge(spark, corpus):
    _, table = corpus
    block = spark.sparkContext.broadcast(([1], np.ones((1, 8))))
    schema = "question_id long, id long, score double"
    hits = search.block_hits(table, block, 3, 8, spark.createDataFrame([], schema).schema)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_the_driver_holds_one_block_of_questions(spark, corpus, monkeypatch):
    """Many small partitions of questions, blocks of three: no more than three are ever in the driver, and none is lost."""
    points, table = corpus
    rows = [(i, [float(x) for x in points[i]]) for i in range(14)]
    asked = spark.createDataFrame(rows, "question_id long, vector array<double>").repartition(14)
    held, real = [], search._matrix
    monkeypatch.setattr(search, "_matrix", lambda v, d: (held.append(len(v)), real(v, d))[1])
    hits = search.nearest(asked, table, 2, 8, 3 * 8 * 8).collect()
    assert sorted(held) == [2, 3, 3, 3, 3]
    got = {q: [h.id for h in sorted(hits, key=lambda h: h.rank) if h.question_id == q] for q in range(14)}
    assert got == brute_force(points[:14], points, 2)
    assert search.nearest(asked.limit(0), table, 2, 8).count() == 0


def test_vectors_of_another_size_are_dead_letters(spark):
    points = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [1.0]), ("c", None)], "id string, vector array<double>"
    )
    fits, rest = vectors.split_by_dimension(points, 2)
    assert [r.id for r in fits.collect()] == ["a"]
    assert sorted(r.id for r in rest.collect()) == ["b", "c"]


def test_nan_components_score_zero(spark):
    table = spark.createDataFrame(
        [("a", [float("nan"), 1.0]), ("b", [1.0, 0.0])], "id string, vector array<double>"
    )
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "question_id long, vector array<double>")
    hits = search.nearest(asked, table, 2, 2).orderBy("rank").collect()
    assert [(h.id, h.score) for h in hits] == [("b", 1.0), ("a", 0.0)]


def test_cosine(spark):
    a = F.array(F.lit(1.0), F.lit(2.0))
    zero = F.array(F.lit(0.0), F.lit(0.0))
    row = spark.range(1).select(cosine(a, a).alias("one"), cosine(a, zero).alias("none")).first()
    assert row.one == pytest.approx(1.0) and row.none == 0.0


def test_hashed_words():
    matrix = embed.HashedWords(32)(pa.array(["Ab, ab c", "", None, "c AB ab"]))
    assert matrix.shape == (4, 32)
    assert np.allclose(matrix[0], matrix[3])
    assert not matrix[1].any() and not matrix[2].any()
    assert np.linalg.norm(matrix[0]) == pytest.approx(1.0)


class Flaky:
    """Fails for 'bad'; fails twice for 'slow' when it stands alone."""

    def __init__(self):
        self.calls, self.slow = [], 0

    def __call__(self, texts):
        words = texts.to_pylist()
        self.calls.append(words)
        if "bad" in words:
            raise ValueError("bad")
        if words == ["slow"]:
            self.slow += 1
            if self.slow < 3:
                raise TimeoutError
        return np.ones((len(words), 2))


def test_only_failing_texts_fail():
    model = Flaky()
    got, errors = embed.embed_batch(model, pa.array(["a", "bad", "slow", "b", "c"]), (0, 0, 0))
    assert errors == [None, embed.GAVE_UP, None, None, None]
    assert [v is None for v in got] == [False, True, False, False, False]
    assert model.calls.count(["bad"]) == embed.ATTEMPTS


def test_batches_succeed_in_one_call():
    model = Flaky()
    embed.embed_batch(model, pa.array(["a", "b"]), (0,))
    assert model.calls == [["a", "b"]]


def test_an_outage_costs_the_waits_once(monkeypatch):
    slept, calls = [], []
    monkeypatch.setattr(embed.time, "sleep", slept.append)

    def down(texts):
        calls.append(len(texts))
        raise OSError

    got, errors = embed.embed_batch(down, pa.array([str(i) for i in range(1000)]), (1, 2, 4))
    assert got == [None] * 1000 and errors == [embed.GAVE_UP] * 1000
    assert sum(slept) == 7 and calls[:3] == [1000] * 3 and len(calls) == 3 + 2 * 1000 - 2


def test_a_short_failure_is_over_after_a_wait(monkeypatch):
    monkeypatch.setattr(embed.time, "sleep", lambda wait: None)
    calls = []

    def recovers(texts):
        calls.append(len(texts))
        if len(calls) < 3:
            raise OSError
        return [[1.0]] * len(texts)

    assert embed.embed_batch(recovers, pa.array(["a", "b", "c"]), (1, 2, 4))[1] == [None] * 3
    assert calls == [3, 3, 3]


def articles(spark, *rows):
    return spark.createDataFrame(list(rows), "n int, url string, content string")


def test_not_stored(spark):
    a = articles(spark, (1, "u", "x"), (2, "", "x"), (3, None, "x"), (4, "v", "x"))
    stored = articles(spark, (9, "u", ""), (9, "u", ""), (9, "", ""), (9, None, ""))
    for found in (dedup.not_stored(a, stored), dedup.not_stored_batch(a, stored)):
        assert sorted(r.n for r in found.collect()) == [2, 3, 4]
    assert [r.n for r in dedup.already_stored(a, stored).collect()] == [1]


def test_one_per_url_and_id(spark):
    rows = [(i, "hot", f"c{i}") for i in range(1000)]
    rows += [(2000, "", "same"), (2001, None, "same"), (2002, "other", "same")]
    a = articles(spark, *rows).repartition(4)
    by_url = sorted(r.n for r in dedup.one_per_url(a, "n").collect())
    assert by_url == [0, 2000, 2001, 2002]
    assert sorted(r.n for r in dedup.one_per_id(a, "n").collect()) == [0, 2000, 2002]


def test_find_url_is_pushed_down(spark, folder):
    path = folder("urls")
    articles(spark, (1, "u", "x"), (2, "v", "x")).write.parquet(path)
    found = dedup.find_url(spark.read.parquet(path), "u")
    assert [r.n for r in found.collect()] == [1]
    assert "EqualTo(url,u)" in found._jdf.queryExecution().executedPlan().toString()


def points(spark, *rows):
    frame = spark.createDataFrame(list(rows), "url string, title string")
    frame = frame.withColumns({
        "vector": F.array(F.lit(1.0).cast("float")), "source": F.lit("s"),
        "content": F.col("url"), "published_at": F.lit("2026-01-01T00:00:00+00:00"),
    })
    return vectors.article_points(frame, F.lit("now"))


def titles(spark, root):
    return sorted(r.title for r in vectors.current(spark, root).collect())


def test_upsert_keeps_one_row_per_id(spark, folder):
    root = folder("upsert")
    assert vectors.current(spark, root).count() == 0
    vectors.upsert(points(spark, ("u", "old"), ("v", "only")), root, 0)
    vectors.upsert(points(spark, ("u", "new"), ("w", "added")), root, 1)
    vectors.upsert(points(spark, ("u", "new"), ("w", "added")), root, 1)  # replay
    assert titles(spark, root) == ["added", "new", "only"]
    vectors.upsert(points(spark, ("u", "older"), ("v", "only")), root, 0)  # a late replay stays in its place
    assert titles(spark, root) == ["added", "new", "only"]
    vectors.compact(spark, root)
    assert len(commits.state(spark, root).folders) == 1 and titles(spark, root) == ["added", "new", "only"]
    assert commits.delete_unreferenced(spark, root, vectors.DATA) == 4 and titles(spark, root) == ["added", "new", "only"]


def test_two_writers_with_the_same_batch_number(spark, folder):
    root = folder("writers")
    vectors.upsert(points(spark, ("u", "batch"), ("v", "batch only")), root, 0, "batch")
    vectors.upsert(points(spark, ("u", "stream"), ("w", "stream only")), root, 0, "stream")
    assert titles(spark, root) == ["batch only", "stream", "stream only"]
    now = commits.state(spark, root)
    assert now.done == {"batch": 0, "stream": 0} and now.committed("stream", 0) and not now.committed("stream", 1)


def test_a_number_is_given_once(spark, folder):
    """Of two commits that saw the same log, one gets the number and the other the next; both survive."""
    root = folder("race")
    vectors.upsert(points(spark, ("u", "a")), root, 0, "first")
    seen = commits.state(spark, root)
    stale = [seen, None]
    real = commits.state

    def late(spark, root):  # the second writer read the log before the first one committed
        return stale.pop(0) if stale[0] is not None else real(spark, root)

    vectors.upsert(points(spark, ("v", "b")), root, 0, "second")
    folder_name, buckets = vectors._write(points(spark, ("w", "c")), root)
    commits.state = late
    try:
        assert commits.commit(spark, root, folder_name, "third", 0, buckets) == 2
    finally:
        commits.state = real
    assert titles(spark, root) == ["a", "b", "c"]


def test_folders_without_a_commit_are_not_read(spark, folder):
    root = folder("halfway")
    vectors.upsert(points(spark, ("u", "a")), root, 0)
    vectors._write(points(spark, ("u", "never committed")), root)
    assert titles(spark, root) == ["a"] and len(commits.unreferenced(spark, root, vectors.DATA)) == 1


def test_compaction_keeps_what_is_committed_meanwhile(spark, folder):
    root = folder("compaction")
    vectors.upsert(points(spark, ("u", "a")), root, 0)
    vectors.upsert(points(spark, ("u", "b"), ("x", "x")), root, 1)
    live = list(commits.state(spark, root).folders.values())
    merged, buckets = vectors._write(vectors.current(spark, root).drop(vectors.VERSION), root)
    vectors.upsert(points(spark, ("u", "c")), root, 2)
    commits.replace(spark, root, live, merged, buckets)
    assert titles(spark, root) == ["c", "x"]
    vectors.upsert(points(spark, ("u", "d")), root, 2)
    with pytest.raises(commits.Conflict):
        commits.replace(spark, root, live, merged, buckets)
    vectors.keep_few_folders(spark, root, 1)
    assert titles(spark, root) == ["d", "x"] and len(commits.state(spark, root).folders) == 1


def test_a_batch_of_one_url_reads_one_bucket(spark, folder):
    root = folder("buckets")
    vectors.upsert(points(spark, *[(f"u{i}", "t") for i in range(200)]), root, 0)
    wanted = vectors.buckets_of(points(spark, ("u7", "t"), ("", "no url")))
    assert len(wanted) == 1
    rows = vectors.all_versions(spark, root, wanted)
    files = rows.inputFiles()
    assert files and all(f"/{vectors.BUCKET}={wanted[0]}/" in f for f in files)
    assert rows.where("url = 'u7'").count() == 1 and rows.count() < 200
    assert vectors.all_versions(spark, root, wanted, ("batch", 0)).count() == 0


def test_context_and_references(spark):
    hits = spark.createDataFrame(
        [(1, 2, "", "b", "u2", "s", "p", 0.5), (1, 1, "t", "a", "u1", "s", "p", 0.9)],
        "question_id int, rank int, title string, content string, url string, source string,"
        " published_at string, score double",
    )
    context = retrieval.context(hits)
    assert context.first().context == "[t]\na\n\n---\n\n[제목 없음]\nb"
    listed = retrieval.references(hits).first().reference_news
    assert [(r.url, r.score) for r in listed] == [("u1", 0.9), ("u2", 0.5)]
    asked = spark.createDataFrame([(1, None), (2, None), (3, "e")], "question_id int, error string")
    texts = {r.question_id: r.context for r in retrieval.context_or_default(asked, context).collect()}
    assert texts[2] == retrieval.NOTHING_FOUND and texts[3] == retrieval.SEARCH_FAILED


def test_transcript_pages(spark):
    turns = spark.range(300).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    pages = sorted(retrieval.transcript(turns, 64).collect(), key=lambda r: r.page)
    assert [len(p.turns) for p in pages] == [64, 64, 64, 64, 44]
    assert [t.turn for p in pages for t in p.turns] == list(range(300))


def test_copies_of_a_text_are_stored_once(spark, folder):
    """Chunks carry the whole text; what is stored grows with the texts, not with the texts times their chunks."""
    rng = random.Random(5)
    texts = [f"{rng.getrandbits(400_000):x}" for _ in range(24)]
    rows = [(f"u{i}", t, t[:700], k) for i, t in enumerate(texts) for k in range(20)]
    made = spark.createDataFrame(rows, "url string, full_content string, content string, chunk_index int").coalesce(1)
    made = made.selectExpr("*", "array(1f) AS vector", "'s' AS source", "'t' AS title", "'2024-01-01' AS published_at")
    root = folder("copies")
    vectors.upsert(vectors.chunk_points(made, F.lit("now")), root, 0)
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{root}/{vectors.DATA}") for f in names)
    assert size < 3 * sum(map(len, texts))
    assert vectors.current(spark, root).count() == len(rows)


def test_first_of_an_id_without_sorting_articles(spark):
    """Rows with one key, equal rows too, leave one row; null order comes first; no whole row is aggregated."""
    rows = [("u", 3, "c"), ("u", 2, "b"), ("u", 2, "b"), ("v", 1, "a"), ("w", None, "n"), ("w", 0, "z"), (None, 5, "x"), (None, 6, "x"), (None, 7, "y")]
    kept = dedup.one_per_id(spark.createDataFrame(rows, "url string, n int, content string"), "n")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([("u", 2, "b"), ("v", 1, "a"), ("w", None, "n"), (None, 5, "x"), (None, 7, "y")], key=str)
    assert "min_by" not in kept._jdf.queryExecution().toString()
