"""Text search: how the scoring is spread."""

import re

from riskloom.plans import search


def test_tasks_follow_the_scored_rows(spark, monkeypatch):
    docs = spark.range(40).selectExpr("id", "concat('red fox ', id) AS text")
    asked = spark.range(5).selectExpr("id AS q", "'red fox' AS words")
    monkeypatch.setattr(search, "TASK_ROWS", 10, raising=False)
    found = search.text_topk(docs, asked, "id", "text", "q", "words", k=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(id#\d+L, 40\), REPARTITION_BY_NUM", plan)
    assert [(r["q"], r["id"], r["rank"]) for r in found.orderBy("q", "rank").collect()] == [(q, d, d + 1) for q in range(5) for d in (0, 1)]
