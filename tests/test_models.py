import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from fraudlens.operators import features, models
from fraudlens.plans import catalog, training
from fraudlens.plans.layers import TRAIN_TEST, TX_KEYS
from fraudlens.operators.ordering import chronological_split
from fraudlens.session import new_path, stage
from fraudlens.sources import runs, topics, views
from fraudlens.streaming import scoring
from fraudlens.operators.silver import envelope


@pytest.fixture(scope="module")
def gold(spark, sf_dir):
    return stage(features.card_features(views.card_tx(spark, sf_dir)), "gold")


@pytest.fixture(scope="module")
def card_model(gold):
    return models.train_card(gold, views.TEST_MERCHANTS, maxIter=2)


def test_reference_parameters():
    assert models.CARD_PARAMS["maxIter"] == 200 and models.CARD_PARAMS["maxDepth"] == 4
    assert models.WIDE_PARAMS["maxIter"] == 300 and models.WIDE_PARAMS["stepSize"] == 0.05


def test_scores_are_probabilities_and_survive_saving(spark, gold, card_model):
    path = new_path(spark, "model")
    runs.save_model(card_model, path)
    first = models.score(gold, card_model).select("transaction_id", "score")
    again = models.score(gold, runs.load_model(path)).select("transaction_id", "score")
    assert first.exceptAll(again).count() == 0
    low, high = first.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low < high <= 1


def test_model_ranks_frauds_above_normals(gold, card_model):
    by_label = models.score(gold, card_model).groupBy("is_fraud").agg(F.avg("score").alias("s"))
    means = {r.is_fraud: r.s for r in by_label.collect()}
    assert means[1] > means[0] + 0.2


def test_unknown_merchant_and_missing_country_are_scored(gold, card_model):
    odd = gold.limit(3).withColumns(
        {"merchant_category": F.lit("casino"), "is_foreign": F.lit(None).cast("int")}
    )
    assert models.score(odd, card_model).filter(F.col("score").isNull()).count() == 0


def test_importance_lists_every_input(spark, card_model):
    rows = models.feature_importance(spark, card_model).collect()
    expected = [*models.CARD_NUMERIC_FEATURES, *models.merchant_columns(views.TEST_MERCHANTS)]
    assert sorted(r.feature for r in rows) == sorted(expected)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert models.feature_importance(spark, card_model, 2).count() == 2


def test_training_without_frauds_is_refused(gold):
    with pytest.raises(ValueError, match="no positive rows"):
        models.train_card(gold.filter("is_fraud = 0"), views.TEST_MERCHANTS, maxIter=1)


def test_another_learner_can_be_plugged_in(spark, sf_dir):
    wide = views.wide_tx(spark, sf_dir)
    learner = LogisticRegression(labelCol="is_fraud", weightCol="weight", maxIter=5)
    model = models.train_wide(wide, estimator=learner)
    assert models.score(wide, model).filter("score BETWEEN 0 AND 1").count() == wide.count()


def test_evaluation_is_logged(spark, gold, card_model):
    split = chronological_split(gold, TX_KEYS, TRAIN_TEST)
    scored = models.score(split.filter("split = 'test'"), card_model)
    path = new_path(spark, "runs")
    row = models.evaluate_and_log(scored, path, "fraud-detection", {"maxIter": 2}).first()
    logged = runs.latest_run(spark, path, "fraud-detection").first()
    assert logged.metrics["pr_auc"] == row.pr_auc > 0
    assert row.tp + row.fp + row.fn + row.tn == 200


def test_live_and_batch_scores_agree(spark, sf_dir, gold, card_model):
    """Rows in time order give the same scores live as from gold."""
    records = views.card_topic(spark, sf_dir, offsets=False)
    path = new_path(spark, "topic")
    for low, high in ((0, 500), (500, 10**9)):
        part = records.filter(F.col("offset").between(low, high - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    stream = envelope(topics.read_topic(spark, path=path, cap=1))
    out = new_path(spark, "scored")
    scored = scoring.score_cards(stream, card_model)
    topics.drain(topics.append_stream(scored, out, new_path(spark, "checkpoint")))
    live = spark.read.parquet(out)

    from fraudlens.operators.silver import decode, scorable
    from fraudlens.schemas import CARD_TX

    accepted = scorable(decode(envelope(records), CARD_TX)).filter("card_id IS NOT NULL")
    accepted = accepted.withColumn("event_time", F.col("event_time").cast("timestamp"))
    batch = models.score(features.card_features(accepted), card_model)
    columns = ["transaction_id", F.round("score", 6).alias("score"), "n_prev", "tx_1h"]
    assert live.count() == accepted.count()
    assert live.select(*columns).exceptAll(batch.select(*columns)).count() == 0
    assert live.filter("latency_ms > 0").count() == live.count()


def test_unreadable_wide_messages_are_not_scored(spark, sf_dir):
    wide = views.wide_tx(spark, sf_dir)
    model = models.train_wide(wide, maxIter=1)
    records = views.wide_topic(spark, sf_dir)
    bad = records.limit(3).withColumn("value", F.lit("no json").cast("binary"))
    scored = scoring.score_wide(envelope(records.unionByName(bad)), model)
    assert scored.count() == records.count()


def test_wide_scoring_is_stateless(spark, sf_dir):
    wide = views.wide_tx(spark, sf_dir)
    model = models.train_wide(wide, maxIter=2)
    path = new_path(spark, "topic")
    records = views.wide_topic(spark, sf_dir)
    records.write.parquet(path)
    out = new_path(spark, "alerts")
    stream = envelope(topics.read_topic(spark, path=path))
    alerts = scoring.live_wide_alerts(stream, model, run_id=3, threshold=0.0)
    topics.drain(topics.append_stream(alerts, out, new_path(spark, "checkpoint")))
    rows = spark.read.parquet(out)
    assert rows.count() == records.count()
    assert {r.run_id for r in rows.select("run_id").distinct().collect()} == {3}


def plain_metrics(rows, threshold=0.5):
    """Cells, ratios and step-wise area, row by row."""
    cells = {"tp": 0, "fp": 0, "fn": 0, "tn": 0}
    for y, p in rows:
        cells[("tp" if y else "fp") if p >= threshold else ("fn" if y else "tn")] += 1
    tp, fp, fn = cells["tp"], cells["fp"], cells["fn"]
    precision, recall = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    positives, area = tp + fn, 0.0
    for score in {p for _, p in rows}:
        flagged = [y for y, p in rows if p >= score]
        gained = sum(y for y, p in rows if p == score)
        area += gained / positives * sum(flagged) / len(flagged) if positives else 0.0
    return cells, precision, recall, f1, area


@pytest.mark.parametrize("kind", ["card", "wide"])
def test_metrics_queries_against_plain_evaluation(spark, sf_dir, kind):
    scored = getattr(training, f"{kind}_test")(spark, sf_dir).select("is_fraud", "score").collect()
    cells, precision, recall, f1, area = plain_metrics([(r.is_fraud, r.score) for r in scored])
    (row,) = catalog.QUERIES[f"train_{kind}_metrics"](spark, sf_dir).collect()
    assert {c: row[c] for c in cells} == cells and sum(cells.values()) == len(scored)
    assert (row.precision, row.recall, row.f1) == pytest.approx((precision, recall, f1), abs=2e-6)
    assert row.pr_auc == pytest.approx(area, abs=2e-6)


def test_importance_query(spark, sf_dir):
    rows = catalog.QUERIES["feature_importance_values"](spark, sf_dir).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0, abs=1e-4) and len(rows) == 29
    assert len({r.importance for r in rows}) > 5 and all(r.importance >= 0 for r in rows)


def test_costs_query_against_plain_costs(spark, sf_dir):
    found = {r.strategy: r for r in catalog.QUERIES["cost_threshold_costs"](spark, sf_dir).collect()}
    rows = training.cost_scores(spark, sf_dir).collect()
    assert {r.row_id: r.split for r in rows} == {
        r.row_id: r.split
        for r in chronological_split(views.wide_tx(spark, sf_dir), ["row_id"], [(0.6, "train"), (0.8, "validation"), (1.0, "test")]).collect()
    }

    def cost(part, t):
        alerts = sum(r.score >= t for r in part)
        return 5.0 * alerts + sum(r.Amount for r in part if r.is_fraud and r.score < t), alerts

    validation, test = ([r for r in rows if r.split == s] for s in ("validation", "test"))
    best = min((round(cost(validation, round(i * 0.02, 2))[0], 2), round(i * 0.02, 2)) for i in range(1, 50))[1]
    base = sum(r.Amount for r in test if r.is_fraud)
    assert found["no model"].cost == pytest.approx(base, abs=0.01)
    for name, t in (("default threshold", 0.5), ("validation threshold", best)):
        money, alerts = cost(test, t)
        row = found[name]
        assert (row.threshold, row.alerts) == (t, alerts) and row.cost == pytest.approx(money, abs=0.01)
        assert row.saving_pct == pytest.approx(100 * (1 - money / base), abs=1e-3)


def card_rows(spark, n):
    """Gold-like rows with many equal ones; the label follows the amount and the country."""
    i = F.col("id")
    return spark.range(n).select(
        (F.pmod(i * 37, F.lit(300)) / 3.0).alias("amount"),
        (F.pmod(i * 11, F.lit(40)) / 8.0).alias("amount_ratio"),
        F.pmod(i, F.lit(3)).alias("tx_1h"),
        F.pmod(i, F.lit(2)).cast("int").alias("is_foreign"),
        F.when(i % 7 > 0, F.element_at(F.array(F.lit("view"), F.lit("click")), (i % 2 + 1).cast("int"))).alias("merchant_category"),
        ((F.pmod(i * 37, F.lit(300)) > 200) & (i % 3 > 0)).cast("int").alias("is_fraud"),
    )


def test_cells_give_the_model_of_all_rows(spark):
    rows = card_rows(spark, 1500)
    params = models.CARD_PARAMS | {"maxIter": 5}
    plain = GBTClassifier(featuresCol="features", labelCol="is_fraud", weightCol="weight", **params)
    old = models.train_card(rows, views.TEST_MERCHANTS, estimator=plain)
    new = models.train_card(rows, views.TEST_MERCHANTS, maxIter=5)
    a, b = ([r.score for r in models.score(rows, m).collect()] for m in (old, new))
    assert a == pytest.approx(b, abs=1e-9) and len({round(s, 6) for s in a}) > 5
    assert models.feature_names(new) == models.feature_names(old)


def test_rounds_see_cells_however_many_rows_there_are(spark, monkeypatch):
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, params=None: (seen.append(df.count()), fit(self, df))[1])
    rows = card_rows(spark, 600)
    models.train_card(rows, views.TEST_MERCHANTS, maxIter=1)
    many = rows.crossJoin(spark.range(5).select(F.col("id").alias("copy")))
    models.train_card(many, views.TEST_MERCHANTS, maxIter=1)
    assert seen[0] == seen[1] <= 600


def test_cut_points():
    assert models.cut_points([(3.0, 1.0), (1.0, 1.0), (3.0, 5.0)], 31) == [2.0]
    assert models.cut_points([(7.0, 1.0)], 31) == []
    assert models.cut_points([(float(i), 1.0) for i in range(100)], 3) == [24.5, 49.5, 74.5]
    assert models.cut_points([(0.0, 97.0), (1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], 1) == [0.5]


def test_missing_numbers_are_refused_as_before(spark):
    rows = card_rows(spark, 300).withColumn("amount", F.when(F.col("amount") == 0, F.lit(float("nan"))).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="NaN"):
        models.train_card(rows, views.TEST_MERCHANTS, maxIter=1)


def test_features_are_worked_out_once_for_training_and_test(spark, sf_dir, monkeypatch):
    calls, card_features = [], features.card_features
    monkeypatch.setattr(training, "_FITTED", {})
    monkeypatch.setattr(training.features, "card_features", lambda df: (calls.append(1), card_features(df))[1])
    monkeypatch.setattr(training.models, "train_card", lambda train, words, fit=models.train_card: fit(train, words, maxIter=1))
    assert training.card_test(spark, sf_dir).count() == 200 and len(calls) == 1
