"""The streaming change log: several arrivals, restart, and a batch that runs twice."""

import datetime

import pytest
from test_scale import expected_changes, updates  # noqa: F401
from pyspark.sql import functions as F
from riskloom.sources.store import scratch_path
from riskloom.streaming import audit_stream as S


def as_set(df):
    return {(r.customer_id, r.event_id, r.change) for r in df.collect()}


def test_arrivals_one_by_one(spark, updates, monkeypatch):  # noqa: F811
    monkeypatch.setattr(S, "LONGEST", 2)
    rows, df = updates
    source, stream = scratch_path(spark, "updates"), S.AuditStream.fresh(spark)
    for i in range(5):
        df.where(F.col("event_id").between(i * 120, i * 120 + 119)).write.mode("append").parquet(source)
        stream.run(S.read_updates(spark, source, df.schema))
    assert as_set(stream.log(spark)) == expected_changes(rows)
    assert stream.log(spark).count() == len(expected_changes(rows))


def test_a_repeated_batch_replaces_its_output(spark, updates):  # noqa: F811
    rows, df = updates
    stream = S.AuditStream.fresh(spark)
    first, second = df.where("event_id < 300"), df.where("event_id >= 300")
    stream.process(first, 0)
    stream.process(second, 1)
    stream.process(second, 1)
    assert as_set(stream.log(spark)) == expected_changes(rows)
    assert stream.log(spark).count() == len(expected_changes(rows))


T0 = datetime.datetime(2024, 1, 1)
UPDATE = "customer_id bigint, event_id bigint, event_time timestamp_ntz, risk_score double"


def at(spark, *rows):
    return spark.createDataFrame([(c, e, T0 + datetime.timedelta(hours=h), s) for c, e, h, s in rows], UPDATE)


def test_lost_state_is_an_error(spark, monkeypatch):
    stream = S.AuditStream.fresh(spark)
    with pytest.raises(RuntimeError, match="batch 6 is missing"):
        stream.process(at(spark, (1, 1, 1, 0.5)), 7)
    stream.process(at(spark, (1, 1, 1, 0.5)), 0)
    stream.process(at(spark, (2, 2, 1, 0.5)), 1)
    lost = buckets(spark, stream, 1)[0]
    S.remove_path(spark, f"{stream.state_path}/batch=0/bucket={lost}")
    with pytest.raises(RuntimeError, match=f"batch 0 is missing in bucket {lost}"):
        stream.process(at(spark, (1, 3, 2, 0.5)), 2)
    stream.process(at(spark, (2, 3, 2, 0.5)), 2)  # another bucket's customers are not held up


def buckets(spark, stream, *customers):
    rows = spark.createDataFrame([(c,) for c in customers], "customer_id bigint")
    return [r[0] for r in rows.select(S.bucket_of(F.col("customer_id"), stream.buckets)).collect()]


def files(spark, stream, *customers):
    """Batch and bucket of the state files that a batch of some customers reads."""
    index = stream.index_after(spark, max(int(x) for x in range(50) if S.path_exists(spark, stream._index_path(x))))
    read = stream.state(spark, index, sorted(set(buckets(spark, stream, *customers)))).inputFiles()
    return {tuple(int(p.split("=")[1]) for p in f.split("/")[-3:-1]) for f in read}


def test_only_the_buckets_of_a_batch_are_read(spark, monkeypatch):
    monkeypatch.setattr(S, "LONGEST", 3)
    stream = S.AuditStream.fresh(spark, 8)
    everyone = list(range(40))
    stream.process(at(spark, *[(c, c, 0, 1.0) for c in everyone]), 0)
    (own,) = buckets(spark, stream, 7)
    others = [c for c in everyone if buckets(spark, stream, c) != [own]][:5]
    for i in range(1, 7):
        stream.process(at(spark, (7, 100 + i, i, float(i))), i)
    assert {b for _, b in files(spark, stream, 7)} == {own} and len(files(spark, stream, 7)) <= 3
    assert files(spark, stream, *others) == {(0, b) for b in buckets(spark, stream, *others)}  # never copied since
    last = {r.customer_id: r.last_score for r in stream.known_before(spark, 7).collect()}
    assert last == {c: 1.0 for c in everyone} | {7: 6.0}


def test_a_repeated_batch_after_a_full_copy(spark, monkeypatch):
    monkeypatch.setattr(S, "LONGEST", 2)
    stream = S.AuditStream.fresh(spark, 2)
    for i in range(6):
        for _ in range(2):
            stream.process(at(spark, (1, i, i, float(i)), (2, 10 + i, i, float(i % 2))), i)
    assert {r.customer_id: r.last_score for r in stream.known_before(spark, 6).collect()} == {1: 5.0, 2: 1.0}
    assert stream.log(spark).count() == 12


def test_a_late_event_moves_no_state(spark):
    stream = S.AuditStream.fresh(spark)
    stream.process(at(spark, (1, 1, 10, 1.0)), 0)
    stream.process(at(spark, (1, 2, 5, 2.0)), 1)
    stream.process(at(spark, (1, 3, 11, 1.0), (2, 4, 0, 3.0)), 2)
    got = {(r.event_id, r.change, r.previous_score) for r in stream.log(spark).collect()}
    assert got == {(1, "INSERT", None), (2, "LATE", 1.0), (4, "INSERT", None)}


def test_old_state_goes(spark, monkeypatch):
    monkeypatch.setattr(S, "LONGEST", 2)
    stream = S.AuditStream.fresh(spark, 1)
    for i in range(7):
        stream.process(at(spark, (i % 3, i, i, float(i))), i)
    there = [S.path_exists(spark, f"{stream.state_path}/batch={i}/bucket=0") for i in range(7)]
    assert there == [False, False, True, True, True, True, True] or sum(there) <= 4
    assert stream.index_after(spark, 6)[0] == [6] or len(stream.index_after(spark, 6)[0]) <= 2
    assert {r.customer_id: r.last_score for r in stream.known_before(spark, 7).collect()} == {0: 6.0, 1: 4.0, 2: 5.0}


def test_a_hot_hour_is_cut(spark):
    from riskloom.operators.changes import change_log

    rows = [(1, e, e / 10000, float(e % 7 // 3)) for e in range(900)]
    scores = [r[3] for r in rows]
    want = {e for e in range(900) if e == 0 or scores[e] != scores[e - 1]}
    assert {r.event_id for r in change_log(at(spark, *rows), parts=6).collect()} == want
