"""Known survey answers with known metrics, and reading of malformed lines."""

import pytest
from pyspark.sql import functions as F
from riskloom import constants as K
from riskloom.operators import survey as Q
from riskloom.sources import store as S

FORM = [
    ("Evet", "5 → Çok iyi", "MEDIUM", "4", "Evet"),
    ("Emin Değilim", "4", "MEDIUM", "3", "Kısmen"),
    ("Hayır", "3", "HIGH", "2", "Kısmen"),
    ("Emin Değilim", "2", "LOW", "2", "Hayır"),
    ("Evet", "4", "MEDIUM", "4", "Evet"),
]
TERMINAL = [("evet", "10", "10", "8", "evet", "10", "LOW", "10"), ("evet", "10", "8", "10", "evet", "10", "MEDIUM", "5")]


@pytest.fixture(scope="module")
def form(spark):
    return spark.createDataFrame(FORM, "decision string, rating string, prediction string, trust string, understood string")


@pytest.fixture(scope="module")
def terminal(spark):
    return spark.createDataFrame(
        TERMINAL,
        "understood string, understanding_score string, usability_score string, trust_score string, decision string, "
        "decision_score string, prediction string, prediction_score string",
    )


def test_form_metrics(form):
    m = Q.form_metrics(form).first()
    assert [m.understanding, m.explanation, m.trust, m.decision, m.overall] == pytest.approx([7.4, 6.5, 5.0, 5.5, 6.1])


def test_terminal_metrics(terminal):
    got = [(r.Metric, r.Value) for r in Q.terminal_metrics(terminal).collect()]
    assert [n for n, _ in got] == list(K.SURVEY_METRIC_NAMES.values())
    assert [v for _, v in got] == pytest.approx([10.0, 9.0, 9.0, 10.0, 7.5, 9.175])


def test_combined_metrics(form, terminal):
    numbers = terminal.select(*[F.col(c).cast("double").alias(c) for c in Q.MEASURES])
    m = Q.combined_metrics(Q.form_scores(form), numbers).first()
    got = [m.understanding_score, m.usability_score, m.trust_score, m.decision_score, m.prediction_score, m.final_score]
    assert got == pytest.approx([8.142857, 7.428571, 6.857143, 8.428571, 7.5, 7.625], abs=1e-6)


def test_adaptive_metrics(terminal):
    numbers = terminal.select("prediction", *[F.col(c).cast("double").alias(c) for c in Q.MEASURES])
    assert Q.adaptive_metrics(numbers).first().trust == 7.5
    assert Q.adaptive_metrics(numbers.select("prediction")).first().trust == 5.0
    with pytest.raises(ValueError):
        Q.adaptive_metrics(numbers.select("decision_score"))


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12,\n13,,15\n", encoding="utf-8")
    rows = S.read_csv_skip_bad(spark, str(tmp_path / "bad.csv"), ["a", "b", "c"]).collect()
    assert sorted(tuple(r) for r in rows if r.a != "13") == [("1", "2", "3"), ("4", "5", None)]
    assert [tuple(r) for r in rows if r.a == "13"] == [("13", None, "15")]


def test_headers_are_stripped(spark):
    df = spark.createDataFrame([(1, 2)], ["  a ", "b"])
    assert S.strip_headers(df).columns == ["a", "b"]


def test_metadata_documents(spark, tmp_path):
    from pyspark.sql.types import StructType

    (tmp_path / "metadata.json").write_text(
        '{\n  "model_hash": "01bd",\n  "features": [\n    "payment_discipline_score"\n  ],\n  "model_type": "gbt"\n}', encoding="utf-8"
    )
    schema = StructType.fromDDL("model_hash string, features array<string>, model_type string")
    row = S.read_json_records(spark, str(tmp_path), schema).first()
    assert (row.model_hash, row.features, row.model_type) == ("01bd", ["payment_discipline_score"], "gbt")
