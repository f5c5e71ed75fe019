"""The behaviour-log engine: hand-computed rows, orderings with ties, and guards."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from skein.functions import scalars
from skein.operators import candidates, features, history, metrics, model, profile, sampling, select
from skein.plans import flows
from skein.schema import COUNTS
from skein.sources import logs, sinks
from skein.streaming import incremental

TARGET = "2014-12-18"
ROWS = [
    (1, 10, 4, "a", 5, "2014-12-17 23"), (1, 10, 1, "", 5, "2014-12-15 00"), (1, 11, 4, "a", 5, "2014-12-18 08"), (2, 99, 4, "a", 6, "2014-12-17 10"),
    (2, 10, 3, "a", 5, "2014-12-04 05"), (2, 10, 1, "a", 5, "2014-12-03 05"), (3, 12, 1, "", 7, "2014-12-19 01"),
]
ITEMS = [(10, "x", 5), (11, "", 5), (12, "y", 7)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("logs")
    text = ["\t".join(map(str, r)) for r in ROWS]
    (d / "behavior_a.txt").write_text("\n".join(text[:4]) + "\n")
    (d / "behavior_b.txt").write_text("\n".join(text[4:]) + "\n")
    (d / "items.txt").write_text("\n".join("\t".join(map(str, r)) for r in ITEMS) + "\n")
    return d


@pytest.fixture(scope="module")
def log(spark, folder):
    return logs.read_log(spark, logs.DataFiles.in_folder(str(folder)).logs)


@pytest.fixture(scope="module")
def items(spark, folder):
    return logs.read_items(spark, str(folder / "items.txt"))


@pytest.fixture(scope="module")
def past(log, items):
    return history.history(history.of_items(log, items), TARGET)


def test_sources(spark, log, items, folder):
    assert log.count() == 7 and log.where("user_geohash IS NULL").count() == 2
    assert {r.item_id for r in logs.item_ids(items).collect()} == {10, 11, 12}
    files = logs.DataFiles.in_folder(str(folder)).logs
    assert logs.read_log(spark, files, rows_per_file=2).count() == 4
    with pytest.raises(FileNotFoundError, match="nowhere"):
        logs.read_log(spark, ["/nowhere"])


def test_profile(log, items):
    p = profile.log_profile(log).first()
    assert (p.n_rows, p.n_missing_geohash, p.first_day, p.last_day, p.n_users) == (7, 2, "2014-12-03", "2014-12-19", 3)
    assert profile.items_profile(items).first().n_missing_geohash == 1
    assert profile.target_ratio(log, items).first().n_target == 6
    assert "| n_rows |" in sinks.markdown({"log": [profile.log_profile(log, False).first().asDict()]})


def test_history(log, items, past):
    s = {(r.user_id, r.item_id): r for r in history.scores(past).collect()}
    assert s[1, 10].score == pytest.approx(9.114125) and s[2, 10].score == pytest.approx(0.616618, abs=1e-6) and len(s) == 2
    rows = history.of_items(log, items)
    assert [tuple(r) for r in history.labels(rows, TARGET).collect()] == [(1, 11)]
    assert {r.user_id for r in history.active_users(past).collect()} == {1, 2}
    assert {tuple(r) for r in history.item_category_map(rows).collect()} == {(10, 5), (11, 5), (12, 7)}
    pair = {(r.user_id, r.item_id): r for r in history.features_of(past, "pair").collect()}
    a, b = pair[1, 10], pair[2, 10]
    assert (a.last_hours_gap, a.b4_1d, a.b1_1d, a.b1_3d, a.b4_14d) == (1, 1, 0, 1, 1) and (b.last_hours_gap, b.b3_7d, b.b3_14d) == (331, 0, 1)


@pytest.mark.parametrize("scope", history.SCOPES)
def test_partials_give_the_same_features(log, items, past, scope):
    want = sorted(map(str, history.features_of(past, scope).collect()))
    assert sorted(map(str, history.features_of_daily(history.daily(past), scope).collect())) == want
    kept = incremental.partials(history.of_items(log, items))
    assert sorted(map(str, history.features_of_daily(incremental.history_of(kept, TARGET), scope).collect())) == want


def test_streamed_partials(spark, log, items, past, tmp_path):
    rows = history.of_items(log, items)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    incremental.maintain(stream, str(tmp_path / "kept"), str(tmp_path / "ck")).awaitTermination()
    kept = incremental.history_of(incremental.read(spark, str(tmp_path / "kept")), TARGET)
    assert sorted(map(str, incremental.scores_of(kept).collect())) == sorted(map(str, history.scores(past).collect()))


def _scored(spark, seed, n=60):
    r = random.Random(seed)
    pairs = r.sample([(u, i) for u in range(12) for i in range(12)], n)
    return [(u, i, float(r.randint(0, 6))) for u, i in pairs]


@pytest.mark.parametrize("seed", range(4))
def test_selection_is_that_of_heaps(spark, seed):
    data = _scored(spark, seed)
    df = spark.createDataFrame(data, "user_id long, item_id long, score double")
    key = lambda x: (-x[2], x[0], x[1])
    for n, cap, pool in ((10, 0, None), (100, 0, None), (20, 2, None), (10, 2, 30), (5, 1, 100)):
        rows = heapq.nsmallest(pool or n if cap else n, data, key)
        out, seen = [], {}
        for x in rows:
            seen[x[0]] = seen.get(x[0], 0) + 1
            if not cap or seen[x[0]] <= cap:
                out.append(x)
        assert [tuple(r) for r in select.global_topn(df, n, "score", cap, pool).collect()] == out[:n]
    got = {(r.user_id, r.item_id, r.rn) for r in select.per_user_topk(df, 3).collect()}
    want = {(u, i, k + 1) for u in range(12) for k, (_, i) in enumerate(sorted((-s, i) for v, i, s in data if v == u)[:3])}
    assert got == want
    pct = {(r.user_id, r.item_id): r.pct for r in select.score_order(df).collect()}
    assert pct == {(u, i): pytest.approx((k + 1) / len(data)) for k, (s, u, i) in enumerate(sorted((s, u, i) for u, i, s in data))}


@pytest.mark.parametrize("seed", range(3))
def test_metrics(spark, seed):
    data = _scored(spark, seed)
    r = random.Random(seed)
    truth = set(r.sample([(u, i) for u in range(12) for i in range(12)], 20))
    df = spark.createDataFrame(data, "user_id long, item_id long, score double")
    labels = spark.createDataFrame(list(truth), "user_id long, item_id long")
    order = sorted(data, key=lambda x: (-x[2], x[0], x[1]))
    for m in metrics.global_top(df, labels, [5, 20, 500]).collect():
        hits = sum((u, i) in truth for u, i, _ in order[: m.n])
        assert (m.predictions, m.hits, m.labels) == (min(m.n, 60), hits, 20)
    none = metrics.per_user(df, labels.limit(0), [1, 2]).collect()
    assert {(m.hits, m.recall, m.f1) for m in none} == {(0, 0.0, 0.0)}


def test_feature_counts_and_values(log, items):
    t = flows.Tables.build(log, items, TARGET)
    full = t.candidates(5)
    assert [len(features.names(full.columns, e)) for e in (True, False)] == [152, 141]
    plain = candidates.full(t.scores, 5, {s: t.features[s] for s in ("pair", "user", "item")})
    assert [len(features.names(plain.columns, e)) for e in (True, False)] == [96, 90]
    assert len(features.names(candidates.base(t.scores, 5).columns)) == 17
    built, names = features.build(full)
    assert features.non_finite(built, names).first()[0] == 0
    row = built.where("user_id = 1 AND item_id = 10").first()
    assert row.p_engage_14d == 11 and row.strong_intent_flag == 0 and row.p_buy_click_ratio_14d == 0.5 and row.user_score_std == pytest.approx(0.0, abs=1e-2)
    assert features.aligned(built.select("user_id"), ["zz"]).first().zz == 0.0
    scored = features.hybrid(full.withColumn("p", F.lit(0.5)), "p", features.Rules.neutral())
    assert {r.hybrid for r in scored.collect()} == {0.5}
    strong = features.hybrid(full.withColumn("p", F.lit(0.5)), "p", features.Rules(60, 1.0, 0.25, 0, 0, 0))
    assert {(r.user_id, r.hybrid) for r in strong.collect()} == {(1, 0.625), (2, 0.5)}


def test_negative_score_and_missing_category(spark, log, items):
    t = flows.Tables.build(log, items, TARGET)
    extra = spark.createDataFrame([(7, 77, -5_000_000_000, -5.0)], "user_id long, item_id long, units long, score double")
    full = candidates.full(t.scores.unionByName(extra), 5, t.features, t.category_map)
    built, _ = features.build(full)
    r = built.where("user_id = 7").first()
    assert r.log_score == 0 and r.item_category == -1 and r.c_last_hours_gap == 99999 and r.p_b1_1d == 0


def test_scalars():
    assert scalars.int_grid("10, 10,,20") == [10, 20]
    with pytest.raises(ValueError):
        scalars.int_grid(" , ")


def _labelled(spark):
    r = random.Random(1)
    rows = [(u, i, 1 + i, float(r.randint(0, 50)), int(r.random() < 0.1)) for u in range(40) for i in range(10)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rn long, score double, label int")


def test_sampling(spark):
    rows = _labelled(spark)
    n1 = rows.where("label = 1").count()
    for mode in ("random", "hard", "mixed"):
        got = sampling.training_rows(rows, 3, mode)
        assert got.where("label = 1").count() == n1 and got.where("label = 0").count() == 3 * n1 and got.distinct().count() == got.count()
        assert sorted(map(str, got.collect())) == sorted(map(str, sampling.training_rows(rows, 3, mode).collect()))
    bounded = sampling.bounded_rows(rows, 5, 100)
    assert bounded.where("label = 1").count() == 5 and bounded.where("label = 0").count() == 100 and bounded.distinct().count() == 105
    q = sampling.quotas(sampling.strata(rows), 77).collect()
    assert sum(r.quota for r in q) == 77 and all(r.quota <= r.n_rows for r in q)
    with pytest.raises(ValueError, match="positive"):
        sampling.training_rows(rows.where("label = 0"))
    train, valid = sampling.split_by_user(rows)
    assert train.count() + valid.count() == rows.count() and valid.where("user_id % 5 <> 0").count() == 0


def test_model(spark, tmp_path):
    rows = _labelled(spark).withColumn("x", F.col("label") * 2.0 + F.col("score") / 50)
    params = model.ModelParams(num_boost_round=3, num_leaves=7, min_data_in_leaf=2, valid_ratio=0.2)
    fitted = model.train(rows, ["x", "score"], params)
    sinks.save_model(fitted, str(tmp_path / "m"))
    again = sinks.load_model(str(tmp_path / "m"))
    a, b = ({(r.user_id, r.item_id): r.probability_1 for r in model.predict(m, rows).collect()} for m in (fitted, again))
    assert a == b and all(0 <= p <= 1 for p in a.values())
    good = [a[r.user_id, r.item_id] for r in rows.where("label = 1").collect()]
    assert min(good) > sum(a.values()) / len(a)
    two = {(r.user_id, r.item_id): r.probability_1 for r in model.predict_two(fitted, again, rows, 0.3).collect()}
    assert two == {k: pytest.approx(v) for k, v in a.items()}
    with pytest.raises(ValueError, match="finite"):
        model.train(rows.withColumn("x", F.lit(None).cast("double")), ["x"], params)
    with pytest.raises(ValueError, match="classes"):
        model.train(rows.where("label = 0"), ["x"], params)
    best, trials = model.search(lambda p: -abs(p["learning_rate"] - 0.05), 8, seed=1)
    assert len(trials) == 8 and best["f1"] == max(t["f1"] for t in trials) and model.search(lambda p: 0.0, 3)[0]["trial"] == 0


def test_orchestration():
    rules, value, probes = flows.coordinate_search(lambda r: -abs(r.strong_bonus - 0.5) - abs(r.cvr_weight - 0.1), {"strong_bonus": [0.1, 0.5, 0.9], "cvr_weight": [0.1, 0.25]})
    assert (rules.strong_bonus, rules.cvr_weight, value, len(probes)) == (0.5, 0.1, 0.0, 5)
    best, _, probes = flows.patient_scan(lambda x: -x, [1, 2, 3, 4, 5, 6])
    assert best == 1 and len(probes) == 4
    assert [flows.gate(x) for x in (0.09, 0.08, 0.079, 0.01)] == ["sprint", "main", "tune", "continue"]
    assert flows.choose_strategy({"f1": 0.1}, {"f1": 0.1}) == "per_user" and flows.rank_models({"a": 0.1, "b": 0.2}) == ["b", "a"]
    assert flows.override(None, 7) == 7
    for bad in (lambda: flows.override(0, 7), lambda: flows.require_protocol({"metric_protocol": "x"})):
        with pytest.raises(ValueError):
            bad()

    def fails():
        raise ValueError

    assert flows.with_fallbacks([fails, lambda: 5]) == 5


def test_submission(spark, log, items, tmp_path):
    scored = history.scores(history.history(history.of_items(log, items), TARGET))
    sinks.export_per_user(scored, 3, str(tmp_path / "a"))
    assert sinks.check_submission(spark, str(tmp_path / "a")) == {"rows": 2, "duplicates": 0, "malformed": 0, "valid": True}
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.txt").write_text("user_id\titem_id\n1\t2\n1\t2\n")
    assert not sinks.check_submission(spark, str(tmp_path / "b"))["valid"]
    sinks.write_json(spark, {"f1": 0.1}, str(tmp_path / "s.json"))
    assert '"f1": 0.1' in (tmp_path / "s.json").read_text()


def test_counts_of_windows(spark, tmp_path):
    assert [n for n, _, _ in COUNTS][:5] == ["b1_1d", "b2_1d", "b3_1d", "b4_1d", "b1_3d"] and len(COUNTS) == 16
    rows = [("2024-01-01 10:00:00", "view", 1), ("2024-01-01 23:59:59", "view", 1), ("2024-01-02 00:00:00", "view", 2), ("2024-01-01 01:00:00", "purchase", 3)]
    data = spark.createDataFrame(rows, "ts string, event_type string, id long")
    data.coalesce(1).write.parquet(str(tmp_path / "in"))

    def drained(name, make, mode):
        out = make(spark.readStream.schema(data.schema).parquet(str(tmp_path / "in")))
        out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    got = {(str(r.window.start)[:10], r.event_type): r.n for r in drained("counted", incremental.windowed_counts, "complete")}
    assert got == {("2024-01-01", "view"): 2, ("2024-01-02", "view"): 1, ("2024-01-01", "purchase"): 1}
    assert sorted(r.id for r in drained("deduped", lambda s: incremental.first_of_each(s, ["id"]), "append")) == [1, 2, 3]


def test_time_filters_reach_the_scan(spark, log, items, tmp_path):
    log.write.parquet(str(tmp_path / "log"))
    rows = spark.read.parquet(str(tmp_path / "log"))
    plan = history.history(rows, TARGET)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(time,2014-12-04)" in plan and "LessThan(time,2014-12-18)" in plan
    assert "StringStartsWith(time,2014-12-18)" in history.labels(rows, TARGET)._jdf.queryExecution().toString()


def test_features_without_moments_or_ranks(spark):
    rows = spark.createDataFrame([(1, 1, 2.0, "7"), (1, 2, 4.0, "x"), (2, 1, 1.0, None)], "user_id long, item_id long, score double, rn string")
    built, names = features.build(candidates.fallback_stats(rows))
    got = {(r.user_id, r.item_id): r for r in built.collect()}
    assert {"user_score_std", "item_score_std"} <= set(names)
    assert got[1, 1].user_score_std == pytest.approx(2**0.5) and got[2, 1].user_score_std == 0
    built, _ = features.build(candidates.fallback_stats(rows).withColumn("rn", F.lit(None).cast("long")))
    assert {(r.rn, r.rank_inv) for r in built.collect()} == {(999.0, 1 / 999)}
    assert [r.x for r in rows.orderBy("user_id", "item_id").select(scalars.finite(F.col("rn")).alias("x")).collect()] == [7.0, 0.0, 0.0]


def test_order_is_not_in_one_task(spark):
    rows = spark.createDataFrame([(u, i, float(i % 3)) for u in range(20) for i in range(20)], "user_id long, item_id long, score double")
    plan = select.score_order(rows)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_split_needs_both_sides(spark):
    with pytest.raises(ValueError, match="empty"):
        sampling.split_by_user(spark.createDataFrame([(1,), (2,)], "user_id long"))


def test_fallbacks_after_spark_errors_and_over_time(spark):
    import time

    def broken():
        return spark.sql("select * from there_is_no_such_table").collect()

    assert flows.with_fallbacks([broken, lambda: spark.range(3).count()]) == 3

    def slow():
        time.sleep(30)

    begun = time.monotonic()
    with pytest.raises(RuntimeError):
        flows.with_fallbacks([slow, lambda: 1], hours=1 / 3600)
    assert time.monotonic() - begun < 15


def test_submission_with_two_models(spark, log, items):
    t = flows.Tables.build(log, items, TARGET)
    built, _ = features.build(t.candidates(5))
    sample = metrics.attach_labels(built, t.scores.where("user_id = 1")).unionByName(metrics.attach_labels(built, t.scores.where("user_id = 2")))
    one, two = (model.train(sample, names, model.ModelParams(2, 0.5, 7, 1, valid_ratio=0.01)) for names in (["score", "p_b4_14d"], ["i_b1_14d", "score"]))
    best, rules = {"k": 5, "n": 2}, features.Rules.neutral()
    got = flows.fused(t, 5, one, rules, two, 0.25)
    parts = [{(r.user_id, r.item_id): r.probability_1 for r in model.predict(m, built).collect()} for m in (one, two)]
    assert {(r.user_id, r.item_id): r.hybrid for r in got.collect()} == {k: pytest.approx(0.75 * v + 0.25 * parts[1][k]) for k, v in parts[0].items()}
    want = sorted(((r.user_id, r.item_id) for r in select.global_topn(got, 2, "hybrid").collect()))
    assert sorted(tuple(r) for r in flows.submit(t, one, best, rules, 0, two, 0.25).collect()) == want


def test_flows_from_the_command_line(spark, tmp_path):
    from skein.__main__ import run

    r = random.Random(6)
    days = [f"2014-12-{d:02d} {h:02d}" for d in range(8, 19) for h in (3, 15)]
    rows = [(r.randint(1, 25), r.randint(1, 15), r.choice([1, 1, 1, 2, 3, 4]), "g", r.randint(1, 3), r.choice(days)) for _ in range(3000)]
    (tmp_path / "behavior_a.txt").write_text("\n".join("\t".join(map(str, x)) for x in rows[:1500]) + "\n")
    (tmp_path / "behavior_b.txt").write_text("\n".join("\t".join(map(str, x)) for x in rows[1500:]) + "\n")
    (tmp_path / "items.txt").write_text("\n".join(f"{i}\tg\t1" for i in range(1, 13)) + "\n")
    where = ["--data-dir", str(tmp_path)]
    one = run(spark, ["baseline", *where, "--output-dir", str(tmp_path / "a"), "--topk-grid", "2,4"])
    assert one["k"] in (2, 4) and one["submission"]["valid"] and (tmp_path / "a" / "summary.json").exists()
    small = ["--global-topn-grid", "5,20", "--candidate-topk", "6", "--num-boost-round", "2", "--num-leaves", "7", "--min-data-in-leaf", "2"]
    two = run(spark, ["rerank", *where, "--output-dir", str(tmp_path / "b"), *small])
    assert two["best"]["n"] in (5, 20) and two["submission"]["rows"] == two["best"]["n"]
    both = ["--model-path", str(tmp_path / "b" / "model"), "--second-model-path", str(tmp_path / "b" / "model"), "--second-model-weight", "0.4"]
    three = run(spark, ["fusion", *where, "--output-dir", str(tmp_path / "c"), *small, *both, "--candidate-topk-grid", "3,6", "--global-topn", "7"])
    assert three["best"]["n"] == 7 and three["submission"]["rows"] == 7 and len(three["trials"]) == 4


def test_presets_are_the_reference_s():
    got = {n: (p.num_leaves, p.min_data_in_leaf, p.learning_rate, p.num_boost_round) for n, p in flows.PRESETS.items()}
    assert got == {
        "P1": (63, 50, 0.05, 400), "P2": (127, 100, 0.03, 600), "S1": (255, 120, 0.03, 1200),
        "S2": (383, 120, 0.025, 1600), "S3": (511, 150, 0.02, 2200), "S4": (383, 120, 0.025, 1600),
    }
    assert {n: r["candidate_topk"] for n, r in flows.PRESET_ROWS.items()} == {"S1": 50, "S2": 50, "S3": 50, "S4": 60}
