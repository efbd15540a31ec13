from indicata.llm.skew import salted_join
from indicata.llm.store import written


def test_equals_a_plain_left_join(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 500) END AS k")
    values = written(rows.where("k IS NOT NULL AND k <> 'k5'").groupBy("k").count().selectExpr("k", "`count` AS n", "upper(k) AS v"), "values")
    got = sorted([tuple(r) for r in salted_join(rows, values, "k", "n", "id").select("id", "k", "v").collect()])
    want = sorted([tuple(r) for r in rows.join(values, "k", "left").select("id", "k", "v").collect()])
    assert got == want and len(got) == 5000
    assert salted_join(rows, values.limit(0), "k", "n", "id").where("v IS NOT NULL").count() == 0
