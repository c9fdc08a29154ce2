from collections import defaultdict

import plain
import pytest
from compare import connect, differences

from fraudlens.llm import mixing
from fraudlens.llm.queries import CHECKS, QUERIES


def test_whole_table(spark, sf_dir):
    got = QUERIES["op10_raked_mixing"](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(CHECKS["op10_raked_mixing"]).df()) is None
    assert 0 < got.kept.sum() < len(got)


def test_only_native_operators(spark, sf_dir):
    plan = QUERIES["op10_raked_mixing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_targets_are_met(spark):
    rows = [
        (i, plain.prose(i, 20 + i % 7), ["en", "fr"][i % 3 == 0], ["big", "small"][i % 10 == 0], 0) for i in range(400)
    ]
    df = spark.createDataFrame(rows, plain.DOCS)
    half = {
        "source": [("=big", 0.8), ("=small", 0.2)], "lang": [("=en", 0.6), ("=fr", 0.4)], "topic": [("=prose", 1.0)]
    }
    targets = {d: spark.createDataFrame(v, "value string, share double") for d, v in half.items()}
    out = mixing.mix(df, targets, fraction=0.4, cycles=25).collect()
    total = sum(r.n_tokens for r in out)
    expected = defaultdict(float)
    for r in out:
        expected["=" + r.source] += r.n_tokens * r.probability
        expected["=" + r.lang] += r.n_tokens * r.probability
    for value, share in half["source"] + half["lang"]:
        assert abs(expected[value] / (0.4 * total) - share) < 1e-6
    assert abs(sum(r.n_tokens for r in out if r.kept) / (0.4 * total) - 1) < 0.2


def test_awkward_rows(spark):
    df = plain.awkward_docs(spark, extra=True)
    out = mixing.mix(df)
    rows = out.collect()
    assert len(rows) == df.count()
    assert all(0 <= r.probability <= 1 for r in rows)
    assert all(r.n_tokens == 0 and not r.kept for r in rows if not (r.text or "").strip(" \n\t"))
    assert mixing.mix(plain.empty_docs(spark)).collect() == []
    kept = mixing.sample(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in rows)
    repeated = [r.kept for r in rows if r.doc_id == 9]
    assert len(set(repeated)) == 1
    assert mixing.sample(plain.empty_docs(spark)).collect() == []


def test_clashing_columns_pass(spark):
    df = plain.awkward_docs(spark)
    want = sorted((str(r.doc_id), r.n_tokens, r.kept) for r in mixing.mix(df, cycles=2).collect())
    for c in ("_source", "_lang", "_topic", "_tokens", "v_source", "v_topic", "tokens", "number", "weight", "c0", "total", "value"):
        df = df.selectExpr("*", f"'x' AS {c}")
    mixed = mixing.mix(df, cycles=2)
    assert mixed.columns == [*df.columns, "topic", "n_tokens", "probability", "kept"]
    assert sorted((str(r.doc_id), r.n_tokens, r.kept) for r in mixed.collect()) == want
    assert {r.number for r in mixing.sample(df, cycles=2).collect()} == {"x"}


def test_topic_and_tokens_from_columns(spark):
    rows = [(i, "x", "en", "a", i % 3, "ab"[i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, topic string")
    out = mixing.mix(df, topic="topic", tokens="n_tokens", cycles=2).collect()
    assert all(r.topic == "ab"[r.doc_id % 2] and r.n_tokens == r.doc_id % 3 for r in out) and len(out) == 30


def test_residuals(spark):
    cells = [("=a", "=en", "=x", 100), ("=a", "=fr", "=x", 50), ("=b", "=en", "=x", 30), ("=b", "=fr", "=x", 80)]
    cells = spark.createDataFrame(cells, "v_source string, v_lang string, v_topic string, tokens long")
    shares = {"source": [("=a", 0.5), ("=b", 0.5)], "lang": [("=en", 0.4), ("=fr", 0.6)], "topic": [("=x", 1.0)]}
    targets = {d: spark.createDataFrame(v, "value string, share double") for d, v in shares.items()}
    out = mixing.residuals(mixing.rake(cells, targets, 0.5, 12)).collect()
    assert {(r.dimension, r["value"], round(r.goal, 6)) for r in out} == {
        ("source", "a", 65), ("source", "b", 65), ("lang", "en", 52), ("lang", "fr", 78), ("topic", "x", 130)
    }
    assert all(abs(r.goal - r.reached) < 1e-6 for r in out)
    far = mixing.residuals(mixing.rake(cells, targets, 1.0, 5)).collect()  # "b" has only 110 of the 130 tokens
    assert [round(r.goal - r.reached, 6) for r in far if r["value"] == "b"] == [20]


@pytest.mark.parametrize("value", ["nowhere", None])
def test_values_without_target_get_nothing(spark, value):
    df = spark.createDataFrame([(1, "a b", "en", value, 0), (2, "a b", "en", "a", 0)], plain.DOCS)
    shares = {"source": "=a", "lang": "=en", "topic": "=prose"}
    targets = {d: spark.createDataFrame([(v, 1.0)], "value string, share double") for d, v in shares.items()}
    got = {r.doc_id: r.probability for r in mixing.mix(df, targets, fraction=0.5).collect()}
    assert got == {1: 0.0, 2: 1.0}
