"""Search as SQL table functions, against the search by blocks."""

from __future__ import annotations

from newslake.operators import embed, search, search_sql
from newslake.operators.sqltool import isolated_session

DIMENSION = 64
WORDS = "coin rate bank trade price hour news chain block fee".split()


def _setup(spark):
    session = isolated_session(spark)
    embedder = embed.HashedWords(DIMENSION)
    rows = [(f"id{i:03}", " ".join(WORDS[j] for j in range(10) if (i * 7 + 3) >> j & 1), None if i % 5 else f"t{i}") for i in range(120)]
    articles = session.createDataFrame(rows, "id string, content string, title string")
    table = embed.with_vectors(articles, embedder, "content").selectExpr(
        "id", "if(id = 'id007', array(float(1)), vector) AS vector", "title", "content", "id AS url", "'s' AS source", "current_timestamp() AS published_at")
    table = session.createDataFrame(table.collect(), table.schema)
    return session, table, embedder


def _by_blocks(session, table, embedder, text, k):
    asked = embed.with_vectors(session.createDataFrame([(text, text)], "question_id string, text string"), embedder, "text")
    found = search.search(asked, table, k, DIMENSION, search_sql.FIELDS).drop("question_id")
    return sorted(tuple(r) for r in found.select("rank", "id", *search_sql.FIELDS, "score").collect())


def test_one_question(spark):
    session, table, embedder = _setup(spark)
    search_sql.register_search(session, table, embedder, DIMENSION)
    for text in ("coin price", "it's a \"bank\"", "", "nothing known"):
        got = sorted(tuple(r) for r in session.sql("SELECT * FROM search_news(:q, 7)", {"q": text}).collect())
        assert got == _by_blocks(session, table, embedder, text, 7)
    assert session.sql("SELECT * FROM search_news('coin')").count() == 3
    assert session.sql("SELECT * FROM search_news('coin', 1000)").count() == 119  # one vector does not fit
    assert session.sql("SELECT * FROM search_news('coin', 0)").count() == 0
    assert session.sql("SELECT score FROM search_news(NULL, 2)").collect() == [(0.0,), (0.0,)]
    plan = session.sql("SELECT * FROM search_news('coin')")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=3" in plan


def test_questions_of_a_table(spark):
    session, table, embedder = _setup(spark)
    texts = ["coin price", "bank fee", "coin price", "", None]
    asked = session.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")
    search_sql.register_questions(session, table, asked, embedder, DIMENSION)
    asked.createOrReplaceTempView("asked")
    rows = session.sql("SELECT n, f.* FROM asked, LATERAL search_news_of(text, 4) f")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    for n in range(3):
        assert sorted(tuple(r)[1:] for r in rows.collect() if r.n == n) == _by_blocks(session, table, embedder, texts[n], 4)
    assert {r.n for r in rows.collect()} == {0, 1, 2}
    assert session.sql("SELECT * FROM search_news_of('never asked', 4)").count() == 0
    left = session.sql("SELECT n, f.id FROM asked LEFT JOIN LATERAL search_news_of(text, 1) f").collect()
    assert sorted(r.n for r in left if r.id is None) == [3, 4]
