import pytest
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from matchlake import ml
from matchlake.ml.growing import fit_trees
from matchlake.sources import counted

STATS = (
    "team_id bigint, team_name string, league string, season int, squad_market_value_eur double, "
    "avg_player_market_value_eur double, players_count bigint, rank bigint, points bigint, goal_diff bigint"
)


@pytest.fixture(scope="module")
def matches(spark):
    """Matches whose outcome follows the difference of the squad values."""
    df = spark.range(600).withColumnRenamed("id", "match_id").withColumn("source", F.lit("a"))
    for i, name in enumerate(ml.FEATURES):
        df = df.withColumn(name, (F.pmod(F.xxhash64("match_id", F.lit(i)), F.lit(100))).cast("double"))
    gap = F.col("home_squad_market_value_eur") - F.col("away_squad_market_value_eur")
    target = F.when(gap > 15, 0).when(gap < -15, 2).otherwise(1)
    return df.withColumn("market_value_diff_eur", gap).withColumn("target", target).persist()


@pytest.fixture(scope="module")
def model(matches):
    return ml.fit_forest(ml.split(matches)[0], trees=15)


def test_feature_rows_need_every_feature(frame):
    df = frame([(1.0, 2.0, 1), (None, 2.0, 1), (float("nan"), 2.0, 1), (1.0, 2.0, None)], "a double, b double, t int")
    assert ml.feature_rows(df, ["a", "b"]).count() == 2
    assert ml.feature_rows(df, ["a", "b"], "t").count() == 1


def test_split_does_not_depend_on_the_layout(matches):
    first, second = (
        {r.match_id for r in ml.split(matches.repartition(n))[0].select("match_id").collect()} for n in (1, 7)
    )
    assert first == second and 0.7 < len(first) / 600 < 0.9
    train, test = ml.split(matches)
    assert train.count() + test.count() == 600
    assert train.join(test, "match_id").count() == 0
    assert {r.match_id for r in ml.split(matches, seed=1)[0].collect()} != first


def test_evaluation_equals_sparks_evaluator(matches, model):
    predictions = model.transform(ml.split(matches)[1]).cache()
    ours = ml.evaluate(predictions).first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1")):
        evaluator = MulticlassClassificationEvaluator(labelCol="target", predictionCol="prediction", metricName=metric)
        assert ours[name] == pytest.approx(evaluator.evaluate(predictions))
    assert ours.accuracy > 0.7


def test_evaluation_of_a_class_never_predicted(frame):
    df = frame([(0, 0.0), (0, 1.0), (1, 1.0), (2, 1.0)], "target int, prediction double")
    evaluator = MulticlassClassificationEvaluator(labelCol="target", metricName="f1")
    assert ml.evaluate(df).first().f1 == pytest.approx(evaluator.evaluate(df))


def test_importances_are_sorted_and_complete(spark, model):
    table = ml.importances(spark, model).collect()
    assert {r.feature for r in table} == set(ml.FEATURES)
    assert [r.importance for r in table] == sorted((r.importance for r in table), reverse=True)
    assert table[0].feature == "market_value_diff_eur"
    assert sum(r.importance for r in table) == pytest.approx(1)


def test_saved_model_scores_alike(matches, model, tmp_path):
    ml.save_model(model, str(tmp_path / "m"))
    ml.save_model(model, str(tmp_path / "m"))
    loaded = ml.load_model(str(tmp_path / "m"))
    columns = ("match_id", "prob_gana_local", "prob_empate", "prob_gana_visitante", "pronostico")
    assert (
        ml.with_forecast(model, matches).select(*columns).exceptAll(ml.with_forecast(loaded, matches).select(*columns)).isEmpty()
    )


def test_fit_does_not_depend_on_the_layout(matches):
    weights = [
        ml.fit_forest(matches.repartition(n).orderBy(F.rand(n)), trees=5).stages[-1].featureImportances
        for n in (1, 6)
    ]
    assert weights[0] == weights[1]


def test_published_predictions(matches, model):
    future = matches.select(
        F.lit("2025-05-01 18:00:00").cast("timestamp").alias("match_date"),
        F.lit("x").alias("league"),
        F.lit("h").alias("home_team_name"),
        F.lit("a").alias("away_team_name"),
        *ml.FEATURES,
    )
    incomplete = future.limit(1).withColumn("home_rank", F.lit(None).cast("double"))
    scored = ml.score(model, future.unionByName(incomplete))
    assert scored.columns == [
        "fecha", "liga", "local", "visitante", "prob_gana_local", "prob_empate", "prob_gana_visitante", "pronostico"
    ]
    collected = scored.collect()
    assert len(collected) == 600 and collected[0].fecha == "2025-05-01 18:00:00"
    for r in collected:
        assert r.prob_gana_local + r.prob_empate + r.prob_gana_visitante == pytest.approx(100, abs=0.02)
        assert r.pronostico in ("Gana Local", "Empate", "Gana Visitante")


def test_two_class_model_gives_the_third_class_no_share(spark, matches):
    counted(matches)[0].count()  # a session that has observed counts can't go to tasks
    model = ml.fit_forest(matches.filter("target < 2"), trees=3)
    assert {r.prob_gana_visitante for r in ml.with_forecast(model, matches).collect()} == {0.0}


@pytest.fixture(scope="module")
def stats(frame):
    return frame(
        [
            (1, "Inter", "s", 2024, 90.0, 9.0, 20, 1, 80, 40),
            (2, "Inter Miami", "m", 2025, 10.0, 1.0, 20, 1, 50, 10),
            (3, "Roma", "s", 2025, 50.0, 5.0, 20, 5, 60, 10),
            (4, "Nulls", "s", 2025, None, 5.0, 20, 5, 60, 10),
        ],
        STATS,
    )


def test_pairings_by_search(frame, stats, model):
    asked = frame(
        [(1, "roma", "INTER M"), (2, "ROMA", "roma"), (3, "ajax", "roma"), (4, "roma", None), (5, "nulls", "roma")],
        "n int, home_team string, away_team string",
    )
    scored = {r.n: r for r in ml.score_pairings(asked, stats, model).collect()}
    assert {n: r.status for n, r in scored.items()} == {
        1: "ok", 2: "ok", 3: "home_not_found", 4: "away_not_found", 5: "incomplete"
    }
    assert scored[1].cross_league and not scored[2].cross_league
    assert (scored[1].local, scored[1].visitante, scored[1].liga) == ("Roma", "Inter Miami", "s")
    assert scored[1].pronostico and scored[5].pronostico is None and scored[3].prob_empate is None


def test_pairings_by_exact_name_fill_missing_figures(frame, stats, model):
    asked = frame(
        [(1, "Roma", "Inter"), (2, "roma", "Inter"), (3, "Roma", "Roma"), (4, "Nulls", "Roma")],
        "n int, home_team string, away_team string",
    )
    scored = ml.score_pairings(asked, stats, model, lookup="exact", null_fill=0.0).collect()
    assert {r.n: r.status for r in scored} == {1: "ok", 2: "home_not_found", 3: "same_team", 4: "ok"}
    with pytest.raises(ValueError):
        ml.score_pairings(asked, stats, model, lookup="other")


def test_pairings_by_name_and_league(frame, model):
    figures = ", ".join(f"{name} double" for name in ml.pairings.PROFILE)
    nan = float("nan")
    stats = frame(
        [(1, "Roma", "it", *[1.0] * 6), (2, "Roma", "br", *[2.0] * 6), (3, "Inter", "it", *[1.0] * 5, nan)],
        f"team_id int, team_name string, league string, {figures}",
    )
    asked = frame(
        [(1, "Roma", "Roma", "br"), (2, "Roma", "Inter", "it"), (3, "Roma", "Inter", "br"), (4, "Inter", "Roma", None)],
        "n int, home_team string, away_team string, league string",
    )
    scored = {r.n: r for r in ml.score_pairings(asked, stats, model, lookup="exact").collect()}
    assert {n: (r.status, r.liga) for n, r in scored.items()} == {
        1: ("same_team", "br"), 2: ("incomplete", "it"), 3: ("away_not_found", "br"), 4: ("incomplete", "it")
    }
    with pytest.raises(ValueError):
        ml.score_pairings(asked, stats, model)


def test_tasks_of_a_fit_follow_its_rows(matches):
    assert [ml.fit_tasks(n) for n in (0, 1_600_000, 1_600_001, 100_000_000)] == [16, 16, 17, 1000]
    by_rows, given = (ml.fit_forest(matches, trees=3, **how) for how in ({}, {"tasks": 16}))
    first, second = (m.stages[-1].toDebugString.split("\n", 1)[1] for m in (by_rows, given))
    assert first == second


def test_a_fit_keeps_its_rows_on_disk_and_without_their_keys(matches, monkeypatch):
    kept, kind = [], type(matches)
    persist = kind.persist
    monkeypatch.setattr(kind, "persist", lambda df, *level: kept.append((df.columns, *level)) or persist(df, *level))
    ml.fit_forest(matches, trees=1, tasks=16)
    (columns, level), *others = kept
    assert columns == [*ml.FEATURES, "target"] and level == StorageLevel.DISK_ONLY and not others


@pytest.mark.parametrize(
    ("rows", "classes", "trees", "depth", "memory"),
    [(20, 3, 3, 5, 256), (3000, 3, 30, 5, 256), (12000, 7, 5, 8, 256), (3000, 2, 1, 4, 256), (3000, 3, 3, 4, 0)],
)
def test_a_grown_forest_is_sparks_node_by_node(spark, tmp_path, rows, classes, trees, depth, memory):
    df = spark.range(rows, numPartitions=5)
    # Many and few values, zeros, negative ones, a constant and only zeros.
    for i, (values, least) in enumerate([(1 << 30, 0), (1000, -300), (40, 0), (3, -1), (1, 5), (1, 0)]):
        df = df.withColumn(f"f{i}", F.pmod(F.xxhash64("id", F.lit(i)), F.lit(values)) + F.lit(float(least)))
    noise = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(300))
    target = F.when(F.col("f1") + noise > 400, 0).when(F.col("f2") > 20, classes - 1).otherwise(F.pmod("id", F.lit(2)))
    names = [f"f{i}" for i in range(6)]
    df = df.withColumn("target", target).filter("id % 5 != 2 or id > 100").select(*names, "target").persist()
    forest = RandomForestClassifier(labelCol="target", numTrees=trees, maxDepth=depth, maxMemoryInMB=memory, seed=42)
    models = (
        Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), forest]).fit(df).stages[1],
        fit_trees(df, names, forest),
    )
    nodes = []
    for i, model in enumerate(models):
        model.write().save(str(tmp_path / str(i)))
        nodes.append(sorted(map(str, spark.read.parquet(str(tmp_path / str(i) / "data")).collect())))
    assert nodes[0] == nodes[1] and len(nodes[0]) > trees
    assert models[0].featureImportances == models[1].featureImportances
    assert {p.name: v for p, v in models[0].extractParamMap().items()} == {
        p.name: v for p, v in models[1].extractParamMap().items()
    }


def test_a_fit_makes_no_passes_row_by_row(matches, monkeypatch):
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *_: pytest.fail("every row was looked up in every tree"))
    assert ml.fit_forest(matches, trees=3, tasks=16).stages[-1].getNumTrees == 3


@pytest.mark.parametrize("wrong", ["target + 0.5", "target - 3", "double('inf')"])
def test_a_fit_refuses_what_is_no_class(matches, wrong):
    with pytest.raises(Exception, match="(?i)class|label|finite"):
        ml.fit_forest(matches.withColumn("target", F.expr(wrong)), trees=1, tasks=16)
