"""Sessions of an event stream against plain loops: order of arrival, repeats, late rows."""

import random
from collections import Counter
from datetime import datetime, timedelta

from riskloom.sources.store import scratch_path
from riskloom.streaming.event_sessions import EVENTS, EventSessions, heartbeat

START = datetime(2024, 5, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def feed(spark, stream, source, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)
    return stream.run(spark.readStream.schema(EVENTS).parquet(source))


def close(spark, stream, source):
    heartbeat(spark, "2024-07-01 00:00:00").write.mode("append").parquet(source)
    return stream.run(spark.readStream.schema(EVENTS).parquet(source))


def brute(rows, gap):
    out, by = Counter(), {}
    for i, customer, _, value, time in {r[0]: r for r in rows}.values():
        by.setdefault(customer, []).append((time, value or 0.0))
    for customer, events in by.items():
        session = []
        for e in [*sorted(events), None]:
            if session and (e is None or e[0] - session[-1][0] > gap):
                out[customer, session[0][0], session[-1][0], len(session), round(sum(v for _, v in session), 6)] += 1
                session = []
            if e:
                session.append(e)
    return out


def stored(stream, spark):
    return Counter((r.customer_id, r.started_at, r.last_at, r.events, round(r.total_value, 6)) for r in stream.read(spark).collect())


def test_sessions_whatever_the_order_inside_the_delay(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), "click", rng.choice([None, 1.5, 2.25]), at(rng.randrange(0, 600))) for i in range(150)]
    rows.sort(key=lambda r: r[4] + timedelta(minutes=rng.randrange(0, 50)))  # at most fifty minutes out of order
    stream, source = EventSessions.fresh(spark, "30 minutes", "1 hour"), scratch_path(spark, "events")
    for i in range(0, 150, 50):
        part = rows[i : i + 50]
        assert feed(spark, stream, source, part + part[:10]) == 0  # some come twice
    open_ones = sum(stored(stream, spark).values())
    assert close(spark, stream, source) == 0
    assert stored(stream, spark) == brute(rows, timedelta(minutes=30)) and open_ones < sum(stored(stream, spark).values())


def test_a_gap_of_exactly_the_limit_goes_on(spark):
    rows = [(1, 7, "a", 1.0, at(0)), (2, 7, "a", 1.0, at(30)), (3, 7, "a", 1.0, at(61))]
    stream, source = EventSessions.fresh(spark, "30 minutes", "1 hour"), scratch_path(spark, "events")
    feed(spark, stream, source, rows)
    close(spark, stream, source)
    assert stored(stream, spark) == brute(rows, timedelta(minutes=30))


def test_late_rows_are_counted(spark):
    stream, source = EventSessions.fresh(spark, "30 minutes", "1 hour"), scratch_path(spark, "events")
    assert stream.late(spark).collect() == []
    on_time = [(1, 7, "a", 1.0, at(0)), (2, 7, "a", 1.0, at(300))]
    feed(spark, stream, source, on_time)
    assert feed(spark, stream, source, [(3, 7, "a", 1.0, at(10)), (4, 8, "a", 1.0, at(20)), (5, 8, "a", 1.0, at(280))]) == 2
    close(spark, stream, source)
    assert stored(stream, spark) == brute([*on_time, (5, 8, "a", 1.0, at(280))], timedelta(minutes=30))
    assert stream.late(spark).agg({"rows": "sum"}).first()[0] == 2
