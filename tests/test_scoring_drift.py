"""Request routing, batch summary, drift split and KS statistic."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.operators import drift as D
from barline.operators import scoring as S


def _requests(spark):
    rows = [(1, "known", [{"close": float(i)} for i in range(12)]),
            (2, "unknown", [{"close": 1.0}] * 12),
            (3, "known", []),
            (4, "known", [{"close": 1.0}] * 3)]
    return spark.createDataFrame(rows, "request_id long, asset_name string, features array<map<string,double>>")


def test_routing_precedence(spark):
    served = spark.createDataFrame([("known",)], "asset_name string")
    got = {r["request_id"]: r["error"] for r in S.route_requests(_requests(spark), served, 5).collect()}
    assert got[1] is None
    assert got[2] == "Model for 'unknown' not available"
    assert got[3] == "Features list cannot be empty"
    assert got[4] == "Validation error: Input data must contain at least 5 rows for LSTM context."
    summ = S.batch_summary(S.route_requests(_requests(spark), served, 5)).collect()[0]
    assert (summ["total_requests"], summ["successful"], summ["failed"]) == (4, 1, 3)


def test_explode_requests_missing_key_is_null(spark):
    rows = [(1, "k", [{"close": 1.0, "rsi": 2.0}, {"close": 3.0}])]
    df = spark.createDataFrame(rows, "request_id long, asset_name string, features array<map<string,double>>")
    got = S.explode_requests(df, feature_names=("close", "rsi")).orderBy("pos").collect()
    assert [(r["pos"], r["close"], r["rsi"]) for r in got] == [(0, 1.0, 2.0), (1, 3.0, None)]


def _payloads(spark):
    texts = ['[{"close": 1.5, "rsi": 2}, {"close": "3", "x y": true, "pos": 4}]', "[]", '[{"close": 1', "", None, '{"close": 1}', "[1, 2]",
             "[null]", " [ {} , {} ] ", '[{"close": null, "payload_error": 7}]', "plain", '[{"a": [1, 2]}, {"close": 1e3}]']
    return spark.createDataFrame(list(enumerate(texts)), "request_id long, payload string").withColumn("asset_name", F.lit("known"))


def test_payloads_become_a_frame_over_the_union_of_keys(spark):
    parsed = S.parse_payloads(_payloads(spark))
    assert S.payload_keys(parsed) == ["a", "close", "payload_error", "pos", "rsi", "x y"]
    frame = S.explode_requests(parsed)
    assert frame.columns == ["request_id", "asset_name", "pos", "a", "close", "payload_error_", "pos_", "rsi", "x y", "payload_error"]
    got = {(r["request_id"], r["pos"]): r for r in frame.collect()}
    bad = {2, 3, 4, 5, 6, 7, 10}
    assert set(got) == {(0, 0), (0, 1), (8, 0), (8, 1), (9, 0), (11, 0), (11, 1)} | {(i, None) for i in bad}
    assert all(got[i, None]["payload_error"] == S.BAD_PAYLOAD and got[i, None]["close"] is None for i in bad)
    assert (got[0, 0]["close"], got[0, 0]["rsi"], got[0, 0]["x y"]) == (1.5, 2.0, None)
    assert (got[0, 1]["close"], got[0, 1]["pos_"], got[0, 1]["x y"], got[0, 1]["payload_error"]) == (3.0, 4.0, None, None)
    assert got[9, 0]["payload_error_"] == 7.0 and got[9, 0]["close"] is None and got[11, 0]["a"] is None and got[11, 1]["close"] == 1000.0


def test_payload_routing_and_key_bound(spark):
    served = spark.createDataFrame([("known",)], "asset_name string")
    parsed = S.parse_payloads(_payloads(spark))
    got = {r["request_id"]: (r["n_rows"], r["error"]) for r in S.route_requests(parsed, served, 2).collect()}
    assert got[0] == (2, None) and got[11] == (2, None) and got[2] == (0, S.BAD_PAYLOAD)
    assert got[1] == (0, "Features list cannot be empty") and got[8] == (2, "Features list cannot be empty")
    assert got[9][1].startswith("Validation error")
    with pytest.raises(ValueError):
        S.payload_keys(parsed, max_keys=3)
    none = parsed.where("request_id < 0")
    assert S.explode_requests(none).count() == 0 and S.route_requests(none, served, 2).count() == 0


def test_scoring_reports_a_missing_price(spark):
    models = spark.createDataFrame([("known", 0.0, 10.0, [0.0, 0.5, 0.5])], "asset_name string, x_min double, x_max double, weights array<double>")
    out = {r["request_id"]: r for r in S.score_requests(S.parse_payloads(_payloads(spark)), models, 2).collect()}
    assert out[0]["prediction"] == pytest.approx(2.25) and out[0]["status"] == "ok"
    assert out[11]["status"] == "failed" and "'close' is missing" in out[11]["error"] and out[11]["prediction"] is None


def _days(spark, n):
    start = dt.date(2024, 1, 1)
    return spark.createDataFrame([("X", start + dt.timedelta(days=i), float(i)) for i in range(n)],
                                 "asset_name string, day date, v double")


def test_drift_split_long_and_short(spark):
    long = D.split_reference_current(_days(spark, 120)).groupBy("side").count().collect()
    assert {r["side"]: r["count"] for r in long} == {"reference": 60, "current": 30}
    short = D.split_reference_current(_days(spark, 50)).groupBy("side").count().collect()
    assert {r["side"]: r["count"] for r in short} == {"reference": 33, "current": 17}


def test_ks_statistic_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(0, 1, 60).round(1), rng.normal(0.5, 1, 30).round(1)  # rounding creates ties
    rows = [("X", "reference", float(v)) for v in ref] + [("X", "current", float(v)) for v in cur]
    df = spark.createDataFrame(rows, "asset_name string, side string, v double")
    got = D.ks_statistics(df, ["v"]).collect()[0]
    grid = np.union1d(ref, cur)
    d = max(abs((ref <= x).mean() - (cur <= x).mean()) for x in grid)
    assert got["ks_stat"] == pytest.approx(d)
    assert got["drifted"] == (got["p_value"] < 0.05)


def test_ks_pvalue_series(spark):
    df = spark.createDataFrame([(60.0, 30.0, 0.0), (60.0, 30.0, 0.5), (60.0, 30.0, 1.0)], "a double, b double, d double")
    p = [r[0] for r in df.select(D.ks_pvalue(F.col("a"), F.col("b"), F.col("d"))).collect()]
    assert p[0] == 1.0 and 0.0 < p[1] < 0.05 and p[2] == pytest.approx(0.0, abs=1e-12)


def test_drift_columns_and_summary(spark):
    cols = ["day", "asset_name", "close", "return", "rsi", "ma_3", "target", "lag_1"]
    df = spark.createDataFrame([], ", ".join(f"{c} double" for c in cols))
    assert D.drift_columns(df) == ["return", "rsi"]
    ks = spark.createDataFrame([("X", "a", True), ("X", "b", False), ("Y", "a", False)],
                               "asset_name string, column string, drifted boolean")
    got = {r["asset_name"]: (r["drift_share"], r["drift_detected"]) for r in D.drift_summary(ks).collect()}
    assert got == {"X": (0.5, True), "Y": (0.0, False)}


def test_drift_report_json(spark, tmp_path):
    from barline.sources.files import write_json

    ks = spark.createDataFrame([("BTC-USD", "a", 0.5, 0.01, True), ("BTC-USD", "b", 0.1, 0.9, False)],
                               "asset_name string, column string, ks_stat double, p_value double, drifted boolean")
    rep = D.drift_report(ks, D.drift_summary(ks))
    r = rep.collect()[0]
    assert r["report_name"] == "btc-usd" and len(r["columns"]) == 2 and r["drift_share"] == 0.5
    write_json(rep, str(tmp_path / "drift"), ("report_name",))
    back = spark.read.json(str(tmp_path / "drift"))
    assert back.count() == 1


def test_score_requests_values(spark):
    models = spark.createDataFrame([("known", 0.0, 10.0, [0.0, 0.5, 0.5])],
                                   "asset_name string, x_min double, x_max double, weights array<double>")
    out = {r["request_id"]: r for r in S.score_requests(_requests(spark), models, 2).collect()}
    # last two closes of request 1 are 10 and 11 → scaled 1.0, 1.1 → mean 1.05 → 10.5
    assert out[1]["status"] == "ok" and out[1]["prediction"] == pytest.approx(10.5)
    assert out[2]["prediction"] is None and out[3]["prediction"] is None


def _brute_force_p(ref, cur):
    """Share of all relabellings of the pooled sample whose KS distance reaches the observed one."""
    import itertools

    import numpy as np

    def dist(a, b):
        grid = np.sort(np.concatenate([a, b]))
        fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
        fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
        return np.max(np.abs(fa - fb))

    pooled = np.concatenate([ref, cur])
    d_obs = dist(ref, cur)
    idx = range(len(pooled))
    hits = total = 0
    for pick in itertools.combinations(idx, len(ref)):
        mask = np.zeros(len(pooled), bool)
        mask[list(pick)] = True
        total += 1
        hits += dist(pooled[mask], pooled[~mask]) >= d_obs - 1e-12
    return d_obs, hits / total


@pytest.mark.parametrize("m,n,seed", [(3, 4, 0), (5, 5, 1), (6, 3, 2), (7, 8, 3), (4, 9, 4)])
def test_exact_ks_p_matches_enumeration(m, n, seed):
    import numpy as np

    from barline.operators.drift import exact_tail_probability

    rng = np.random.default_rng(seed)
    ref, cur = rng.normal(size=m), rng.normal(0.7, 1.0, size=n)
    d, want = _brute_force_p(ref, cur)
    assert exact_tail_probability(m, n, float(d)) == pytest.approx(want, rel=1e-12, abs=1e-15)


def test_exact_ks_p_known_values_and_large_samples():
    from barline.operators.drift import exact_tail_probability

    # fully separated samples of 3 and 3: 2 of the C(6,3) = 20 orders reach D = 1
    assert exact_tail_probability(3, 3, 1.0) == pytest.approx(0.1, rel=1e-12)
    assert exact_tail_probability(5, 7, 0.0) == 1.0
    # large samples: finite, in [0, 1], monotone in d
    ps = [exact_tail_probability(2000, 1500, d) for d in (0.02, 0.05, 0.08)]
    assert all(0.0 <= p <= 1.0 for p in ps) and ps[0] > ps[1] > ps[2]


def test_exact_ks_key_agrees_with_local_p_values(spark):
    from barline.operators.drift import exact_tail_probability
    from barline.plans.catalog import QUERIES
    from conftest import SF001

    rows = QUERIES["drift_ks_exact"](spark, SF001).collect()
    assert rows
    for r in rows:
        want = exact_tail_probability(r.n_ref, r.n_cur, r.ks_stat)
        assert r.p_value == pytest.approx(round(want, 4), abs=1e-4)
        assert r.drifted == (want < 0.05)


def test_one_sided_asset_does_not_stop_the_drift_test(spark):
    from barline.operators.drift import drift_summary, ks_statistics

    rows = [("A", "reference" if i < 20 else "current", float(i % 7)) for i in range(40)] + [("B", "current", 1.0)]
    got = {r["asset_name"]: r for r in ks_statistics(spark.createDataFrame(rows, "asset_name string, side string, x double"),
                                                     ["x"]).collect()}
    assert got["A"]["p_value"] is not None and got["B"]["p_value"] is None and got["B"]["n_ref"] == 0
    assert drift_summary(spark.createDataFrame(list(got.values()))).count() == 2


def test_chi_square_pvalue_against_closed_forms(spark):
    from pyspark.sql import functions as F

    def tail(x, dof):  # closed forms: erfc and exp with their finite sums
        if dof % 2 == 0:
            return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))
        return math.erfc(math.sqrt(x / 2)) + math.exp(-x / 2) * sum(
            (x / 2) ** (k - 0.5) / math.gamma(k + 0.5) for k in range(1, (dof + 1) // 2))

    cases = [(x, dof) for dof in range(1, 12) for x in (1e-6, 0.1, 1.0, 2.9, 3.1, 7.0, 13.0, 40.0, 120.0)]
    got = spark.createDataFrame(cases, "x double, dof int").select("x", "dof", D.chi_square_pvalue(F.col("x"), F.col("dof")).alias("p"))
    for r in got.collect():
        assert r["p"] == pytest.approx(tail(r["x"], r["dof"]), rel=1e-9, abs=1e-14)
    edge = spark.createDataFrame([(0.0, 0), (0.0, 3), (math.inf, 2), (None, 2)], "x double, dof int")
    assert [r[0] for r in edge.select(D.chi_square_pvalue(F.col("x"), F.col("dof"))).collect()] == [1.0, 1.0, 0.0, None]


def test_drift_test_is_chosen_by_the_number_of_values(spark):
    rows = [("A", "reference", float(i % 3), 7.0, i / 10, 1.0, None) for i in range(60)]
    rows += [("A", "current", 0.0 if i < 25 else 1.0, 7.0, i / 10, 2.0 if i == 0 else 1.0, 5.0) for i in range(30)]
    rows += [("A", "current", None, None, math.nan, None, None)]
    split = spark.createDataFrame(rows, "asset_name string, side string, three double, same double, many double, unseen double, one_sided double")
    got = {r["column"]: r for r in D.drift_tests(split, ["three", "same", "many", "unseen", "one_sided"]).collect()}
    # 25, 5, 0 against 10 each
    assert got["three"]["test"] == "chi_square" and got["three"]["statistic"] == pytest.approx(22.5 + 2.5 + 10)
    assert got["three"]["p_value"] == pytest.approx(math.exp(-17.5)) and got["three"]["drifted"]
    assert (got["same"]["test"], got["same"]["p_value"], got["same"]["drifted"]) == ("chi_square", 1.0, False)
    assert got["many"]["test"] == "ks" and got["many"]["statistic"] == pytest.approx(0.5) and got["many"]["n_cur"] == 30
    assert got["unseen"]["statistic"] == math.inf and got["unseen"]["p_value"] == 0.0
    assert got["one_sided"]["statistic"] is None and got["one_sided"]["drifted"] is None
    plain = D.ks_statistics(split.where("many = many AND NOT isnan(many)"), ["many"]).collect()[0]
    assert (plain["ks_stat"], plain["p_value"]) == (got["many"]["statistic"], got["many"]["p_value"])


def test_drift_tests_empty_table(spark):
    empty = spark.createDataFrame([], "asset_name string, side string, three double")
    assert D.drift_tests(empty, ["three"]).count() == 0
