import zlib

import numpy as np
import plain
import pytest

from fraudlens.llm import quality

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    from fraudlens.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op8_boosted_tree_quality"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    return rows, labels, spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_held_out_accuracy(scored):
    rows, labels, n = scored
    assert len(rows) == n
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([a for a, b in held if b == 1]) > 0.98


def test_awkward_rows(spark):
    df = plain.awkward_docs(spark, extra=True)
    labels = [(i, i % 2, None) for i in range(12)] + [(None, 1, 0), (4, None, 1), (4, 1, 1), (999, 1, 0)]
    model = quality.train(df, spark.createDataFrame(labels, LABELS))
    out = quality.score_documents(df, model)
    assert out.count() == df.count()
    assert sorted(out.columns) == sorted(df.columns)
    rows = out.collect()
    assert len({r.score for r in rows if not (r.text or "")}) == 1
    kept = quality.drop_rejected(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in rows)
    assert all(r.score == "x" for r in kept.collect())
    assert quality.score_documents(plain.empty_docs(spark), model).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 0), (2, 0, 0)]])
def test_without_two_labels_there_are_no_trees(spark, labels):
    model = quality.train(plain.awkward_docs(spark), spark.createDataFrame(labels, LABELS))
    scores = model.score(np.zeros((3, len(quality.FEATURES))))
    assert len(model.feature) == 0 and len(set(scores.tolist())) == 1


def test_trees_learn_and_are_bounded(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    model = quality.fit(x, y, trees=60)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    one = [model.base + sum(_walk(f, t, v, row) for f, t, v in zip(model.feature, model.threshold, model.leaf)) for row in x[:50]]
    assert np.allclose(model.score(x[:50]), 1 / (1 + np.exp(-np.array(one))))


def _walk(feature, threshold, leaf, row):
    node = 0
    while node < len(feature):
        node = 2 * node + 1 + (row[feature[node]] > threshold[node])
    return leaf[node - len(feature)]


def test_sample_bound(spark):
    df = plain.awkward_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(16)], LABELS)
    a, b = (quality.train(df.repartition(n), labels.repartition(n), most_rows=6) for n in (1, 4))
    assert a.base == b.base and (a.leaf == b.leaf).all()


def test_what_is_fitted_is_bounded(spark, monkeypatch):
    """Rows that repeat a labelled doc_id do not widen the sample, in whatever order they come."""
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((x, y)))
    rows = [(7, f"text {i} of seven", "en", "a", 0) for i in range(500)] + [(i, f"text {i}", "en", "a", 0) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], LABELS)
    for n in (1, 5):
        quality.train(spark.createDataFrame(rows, plain.DOCS).repartition(n), labels, most_rows=10)
    (x, y), (again, _) = seen
    assert len(x) == len(y) == 10 and (x == again).all()
    quality.train(spark.createDataFrame(rows, plain.DOCS), labels)
    used = sum(not zlib.crc32(str(i).encode()) % 5 == 0 for i in range(30))
    assert len(seen[2][0]) == used


def test_clashing_columns(spark):
    df = plain.awkward_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(16)], LABELS)
    want = quality.train(df, labels)
    for c in ("_id", "_y", "_doc", "_text", "_first", "quality", "log_bytes"):
        df = df.selectExpr("*", f"'x' AS {c}")
    got = quality.train(df, labels.selectExpr("*", "1 AS _id", "2 AS _y", "3 AS _doc", "'t' AS text"))
    assert got.base == want.base and (got.leaf == want.leaf).all()
