"""Published versions: what readers see, what failures leave, and jobs per write."""

import pytest
from pyspark.sql import functions as F
from riskloom import constants as K
from riskloom.operators import load as L
from riskloom.sources import published as P
from riskloom.sources.store import path_exists, scratch_path


def jobs_of(spark, run):
    """Number of jobs that ``run`` starts."""
    group = scratch_path(spark, "jobs")
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_see_the_newest_version(spark):
    path = scratch_path(spark, "published")
    with pytest.raises(ValueError, match="nothing is published"):
        P.read_published(spark, path)
    assert P.publish(spark.range(3), path).number == 1
    held = P.read_published(spark, path)
    second = P.publish(spark.range(5), path, {"most": F.max("id")}, note={"by": "test", "at": 1.5})
    assert second.facts == {"rows": 5, "most": 4} and P.version(spark, path) == second and second.note == {"by": "test", "at": 1.5}
    assert ids(held) == [0, 1, 2] and ids(P.read_published(spark, path)) == [0, 1, 2, 3, 4] and ids(P.read_published(spark, path, 1)) == [0, 1, 2]
    P.publish(spark.range(1), path)
    assert P.versions(spark, path) == [2, 3] and not path_exists(spark, held.inputFiles()[0])
    with pytest.raises(ValueError, match="not kept"):
        P.read_published(spark, path, 1)


def test_what_fails_leaves_the_last_version(spark, monkeypatch):
    path = scratch_path(spark, "published")
    P.publish(spark.range(3), path)

    def refuse(found):
        raise ValueError(f"{found['rows']} rows are too many")

    with pytest.raises(ValueError, match="9 rows"):
        P.publish(spark.range(9), path, accept=refuse)
    bad = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error("bad row").cast("long")).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        P.publish(bad, path)

    def crash(*_):
        raise KeyboardInterrupt  # between the gate and the commit

    monkeypatch.setattr(P, "_commit", crash)
    with pytest.raises(KeyboardInterrupt):
        P.publish(spark.range(9), path)
    assert ids(P.read_published(spark, path)) == [0, 1, 2] and P.versions(spark, path) == [1]
    assert P.remove_unfinished(spark, path, 0) == 0  # nothing was left behind


def test_of_two_writers_one_wins(spark):
    path = scratch_path(spark, "published")
    first = P.publish(spark.range(1), path)
    P.publish(spark.range(2), path, after=1)
    with pytest.raises(P.Conflict):
        P.publish(spark.range(9), path, after=1)
    with pytest.raises(P.Conflict):
        P._commit(spark, path, first)  # the rename itself refuses a number that is taken
    assert ids(P.read_published(spark, path)) == [0, 1] and ids(first.read(spark)) == [0]


def test_lost_drivers_leave_folders_that_can_be_removed(spark):
    path = scratch_path(spark, "published")
    P.publish(spark.range(1), path)
    spark.range(4).write.parquet(f"{path}/_data/half")
    assert P.remove_unfinished(spark, path) == 0 and P.remove_unfinished(spark, path, -1) == 1
    assert ids(P.read_published(spark, path)) == [0] and P.remove_unfinished(spark, scratch_path(spark, "none")) == 0


def test_a_gated_write_is_one_job(spark):
    path, view = scratch_path(spark, "published"), "published_rows"
    made = []
    assert jobs_of(spark, lambda: made.append(P.publish_view(spark.range(0, 50, 1, 4), path, view, facts={"odd": F.count_if(F.col("id") % 2 == 1)}))) == 1
    assert made[0].facts == {"rows": 50, "odd": 25} and spark.table(view).count() == 50


STAGED = "customer_id int, payment_discipline_score double, income_stability_index double, financial_resilience_score double, risk_score double, risk_band string"


def staged(spark, *resilience):
    return spark.createDataFrame([(i, 1.0, 2.0, r, 0.5, "Low") for i, r in enumerate(resilience)], STAGED)


def test_promotion_is_all_or_nothing(spark):
    path = scratch_path(spark, "production")
    found = []
    assert jobs_of(spark, lambda: found.append(L.promote(staged(spark, 5.0, 6.0), path))) == 1
    assert sorted(r[K.FEATURES[2]] for r in found[0].collect()) == [5.0, 6.0]
    for rows, message in ((staged(spark, 5.0, None, 1.0), "in 2 rows"), (staged(spark), "empty")):
        with pytest.raises(ValueError, match=message):
            L.promote(rows, path)
        assert P.read_published(spark, path).count() == 2
