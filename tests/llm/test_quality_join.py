"""How trusted rows are marked: by the same join at every size."""

from quire.llm import quality_rules as Q


def test_few_trusted_ids_are_joined_like_many(spark):
    docs = spark.createDataFrame([(k, f"w{k} w{k % 3}") for k in range(50)] + [(None, "x")], "doc_id long, text string")
    few, many = (spark.createDataFrame([(k,) for k in range(n)] + [(None,)], "doc_id long") for n in (1, 40))
    plans = [Q.gram_counts(docs, t)._jdf.queryExecution().sparkPlan().toString() for t in (few, many)]
    assert all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans)
    rows = {n: Q.gram_counts(docs, t).selectExpr("sum(good)", "sum(n)").first() for n, t in ((1, few), (40, many))}
    assert tuple(rows[1]) == (3, 151) and tuple(rows[40]) == (120, 151)
