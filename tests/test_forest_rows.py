"""The rows of the leak study's forests are dealt out evenly, the same way each time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlake.ml import split as SP
from churnlake.params import FEATURES
from churnlake.plans import q_ml as QM


class _Fit(Exception):
    pass


@pytest.mark.parametrize("rows_per_task, tasks", [(100, 12), (5000, None)])
def test_the_leak_study_fits_on_rows_that_are_dealt_out(spark, monkeypatch, rows_per_task, tasks):
    users = spark.range(1200).select(F.col("id").alias("user_id"), (F.col("id") % 10 == 0).cast("int").alias("churned"),
                                     *[(F.col("id") % 7).alias(f) for f in FEATURES])
    day = dt.datetime(2001, 1, 1)
    subs = spark.createDataFrame([(i, i, day, day) for i in range(0, 1200, 3)],
                                 "subscription_id long, user_id long, start_date timestamp, end_date timestamp")
    domain = type("Domain", (), {"__init__": lambda self, *a: None, "matrix": users, "subscriptions": subs})
    monkeypatch.setattr(QM, "Domain", domain)
    monkeypatch.setattr(SP, "ROWS_PER_FIT_TASK", rows_per_task, raising=False)
    seen = []

    def fit(train, params):
        seen.append(train)
        raise _Fit

    monkeypatch.setattr(QM.TR, "fit_forest", fit)
    for _ in range(2):
        with pytest.raises(_Fit):
            QM.q_leaky_vs_honest(spark, "")
    got = [t.select(F.spark_partition_id().alias("task"), "user_id", "w_balanced").collect() for t in seen]
    want = SP.stratified_split(users, test_frac=QM.LEAK_TEST_FRAC, val_frac=0.0).where("split = 'train'")
    assert sorted(r.user_id for r in got[0]) == sorted(r.user_id for r in want.collect())
    if tasks:
        sizes = [sum(r.task == t for r in got[0]) for t in range(tasks)]
        assert sum(sizes) == len(got[0]) == 840 and 35 < min(sizes) and max(sizes) < 105
        assert got[0] == got[1]
    else:
        assert len({r.task for r in got[0]}) < 12
