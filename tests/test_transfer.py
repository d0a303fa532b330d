import pytest

from riskspark.operators import learners as le


def test_bundle_checks_the_target_and_keeps_source_medians(spark):
    src = spark.createDataFrame([(i, float(i % 7), float(i % 5), int(i % 7 > 3)) for i in range(120)], "id long, a double, b double, y int")
    bundle = le.fit_source(src, ["a", "b"], "y")
    assert bundle.medians == {"a": 3.0, "b": 2.0}
    target = spark.createDataFrame([(1, 6.0, 2.0), (2, None, 2.0), (3, 3.0, 2.0), (4, 0.0, 2.0)], "id long, a double, b double")
    m = {r["id"]: r["__margin"] for r in bundle.margin(target).collect()}
    assert m[1] > m[3] == m[2] > m[4]
    with pytest.raises(ValueError, match="'b'"):
        bundle.margin(target.drop("b"))
    with pytest.raises(ValueError, match="'a'"):
        bundle.margin(target.selectExpr("id", "'x' a", "b"))
