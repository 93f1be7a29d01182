import numpy as np
from pyspark.sql import functions as F

from sirenlake.operators import anomaly


def planted(spark):
    rng = np.random.default_rng(3)
    normal = [(i, *rng.normal((40.4, -80.0), 0.02), int(rng.integers(9, 17)), int(rng.integers(0, 5)), 6, "E3") for i in range(400)]
    odd = [(1000 + i, 45.0 + i, -70.0 - i, 3, 6, 12, "E1") for i in range(10)]
    data = [(i, float(a), float(b), h, d, m, p) for i, a, b, h, d, m, p in normal + odd]
    return spark.createDataFrame(data, "incident_id int, latitude double, longitude double, hour int, day_of_week int, month int, priority_code string")


def test_planted_outliers_come_first_and_scores_ignore_partitioning(spark):
    df = planted(spark)
    nodes = anomaly.isolation_forest_fit(df, ["incident_id"])
    assert nodes.select("tree").distinct().count() == 100
    assert nodes.where("node = 1").agg(F.max("rows")).first()[0] == 256
    scored = anomaly.isolation_forest_score(df, nodes).cache()
    recall = anomaly.recall_top_share(scored, "anomaly_score", ["incident_id"]).first()
    assert recall.recall > 0.7 and recall.top_rows == 82 and recall.high_priority_rows == 10
    assert scored.where("is_anomaly").count() == 21
    shuffled = df.repartition(5, "hour")
    again = anomaly.isolation_forest_score(shuffled, anomaly.isolation_forest_fit(shuffled, ["incident_id"]), flag=False)
    a = {r.incident_id: r.anomaly_score for r in scored.collect()}
    b = {r.incident_id: r.anomaly_score for r in again.collect()}
    assert max(abs(a[k] - b[k]) for k in a) < 1e-6


def test_recall_without_high_priority_rows_is_zero(spark):
    df = spark.createDataFrame([(i, -0.5, "E3") for i in range(10)], "incident_id int, anomaly_score double, priority_code string")
    assert anomaly.recall_top_share(df, "anomaly_score", ["incident_id"]).first().recall == 0.0


def test_average_path_length():
    assert anomaly.average_path(1) == 0 and anomaly.average_path(2) == 1
    assert abs(float(anomaly.average_path(256)) - 10.2448) < 1e-3
