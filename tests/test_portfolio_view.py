"""The view that changes are counted into, against recomputation."""

import random

import pytest
from riskloom.operators.portfolio_view import PortfolioView, change_rows, deltas
from riskloom.sources.published import versions
from riskloom.sources.store import scratch_path

ROWS = "customer_id int, risk_band string, risk_score double"


def frame(spark, rows):
    return spark.createDataFrame([(k, *v) for k, v in rows.items()], ROWS)


def recomputed(rows):
    out = {}
    for band, score in rows.values():
        n, known = out.get(band, (0, []))
        out[band] = n + 1, known + ([score] if score is not None else [])
    return {b: (n, round(sum(s) / len(s), 9) if s else None) for b, (n, s) in out.items()}


def stored(view, spark):
    return {r.risk_band: (r.customer_count, None if r.avg_risk_score is None else round(r.avg_risk_score, 9)) for r in view.read(spark).collect()}


def rounds(seed, n):
    """Snapshots of a table to which customers are added, from which they go, and in which they change."""
    rng = random.Random(seed)
    row = lambda: (rng.choice(["Low", "Medium", "High", None]), rng.choice([None, 0.0, round(rng.random(), 4), -0.1]))
    rows = {i: row() for i in range(60)}
    yield rows
    for _ in range(n):
        rows = {k: row() if rng.random() < 0.2 else v for k, v in rows.items() if rng.random() > 0.15}
        rows |= {max(rows, default=0) + 1 + i: row() for i in range(rng.randrange(12))}
        yield rows
    yield {}


def test_changes_counted_in_equal_a_recomputation(spark):
    view, last = PortfolioView(scratch_path(spark, "view")), None
    for batch, rows in enumerate(rounds(1, 4)):
        if last is None:
            view.build(frame(spark, rows))
        else:
            changes = change_rows(frame(spark, last), frame(spark, rows))
            assert changes.count() == sum(last.get(k) != rows.get(k) for k in {*last, *rows})
            view.apply(changes, batch)
            view.apply(changes, batch)  # again, as after a lost driver
        assert stored(view, spark) == recomputed(rows)
        last = rows


def test_only_changes_and_stored_bands_are_read(spark):
    view, path = PortfolioView(scratch_path(spark, "view")), scratch_path(spark, "all")
    old = {i: ("Low", 0.25) for i in range(500)}
    frame(spark, old).write.parquet(path)
    view.build(spark.read.parquet(path))
    new = old | {3: ("High", 0.75)}
    del new[4]
    change = change_rows(frame(spark, {3: old[3], 4: old[4]}), frame(spark, {3: new[3]}))
    assert {r.risk_band: (r.customers, r.scores, float(r.total)) for r in deltas(change).collect()} == {"Low": (-2, -2, -0.5), "High": (1, 1, 0.75)}
    made = view.apply(change, 1)
    assert made.facts["rows"] == 2 and not any(path in f for f in made.read(spark).inputFiles())
    assert stored(view, spark) == recomputed(new)


def test_changes_that_do_not_fit_are_refused(spark):
    view = PortfolioView(scratch_path(spark, "view"))
    with pytest.raises(ValueError, match="not built"):
        view.read(spark)
    view.build(frame(spark, {1: ("Low", 0.5)}))
    before = stored(view, spark)
    gone = change_rows(frame(spark, {1: ("High", 0.5)}), frame(spark, {}))
    with pytest.raises(ValueError, match="do not fit"):
        view.apply(gone, 1)
    assert stored(view, spark) == before and versions(spark, view.path) == [1]


def test_a_change_stream_is_counted_in_once(spark):
    view, source, checkpoint = PortfolioView(scratch_path(spark, "view")), scratch_path(spark, "changes"), scratch_path(spark, "checkpoint")
    tables = list(rounds(2, 3))
    view.build(frame(spark, tables[0]))
    for last, rows in zip(tables, tables[1:]):
        changes = change_rows(frame(spark, last), frame(spark, rows))
        changes.coalesce(1).write.mode("append").parquet(source)
        view.follow(spark.readStream.schema(changes.schema).parquet(source), checkpoint)
        assert stored(view, spark) == recomputed(rows)
