"""Fit, scoring, evaluation and deals against brute force and stated identities."""

import math
import random

import numpy as np
import pytest

from lotwise.functions.keys import with_keys
from lotwise.operators import rank
from lotwise.params import Params
from lotwise.plans import deals, effects, evaluate, scoring
from lotwise.plans.effects import PriceModel
from lotwise.workspace import new_path

P = Params()
COLUMNS = (
    "id string, make string, model string, trim string, cylinder int, gear_type string, year int,"
    " price double, mileage double, mileage_range double, split string"
)


def _rows(n=400, seed=3):
    """Listings with a hot make, rare trims and a missing make."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        make = None if rng.random() < 0.03 else ("Hot" if rng.random() < 0.5 else f"M{rng.randrange(4)}")
        mileage = None if rng.random() < 0.02 else float(rng.randrange(0, 9) * 7000)
        tier = None if mileage is None else math.ceil(mileage / 10000) * 10000.0
        kind = "train" if rng.random() < 0.7 else rng.choice(["test", "validation"])
        rows.append(
            (f"r{i}", make, f"m{rng.randrange(3)}", f"t{rng.randrange(4)}", 4, "auto", 2014 + rng.randrange(6),
             float(rng.randrange(20, 300) * 1000), mileage, tier, kind)
        )
    return rows


def _mean(xs):
    return sum(xs) / len(xs)


class Brute:
    """Sequential residual fit, written row by row."""

    def __init__(self, rows):
        def text(v):
            return "NA" if v is None else str(v)

        self.rows = []
        for r in rows:
            d = dict(zip([c.split()[0] for c in COLUMNS.split(", ")], r))
            d["model_key"] = f"{text(d['make'])}-{text(d['model'])}"
            d["trim_key"] = "-".join(
                [text(d["make"]), d["model_key"], text(d["trim"]), text(d["cylinder"]), text(d["gear_type"])]
            )
            self.rows.append(d)
        train = [d for d in self.rows if d["split"] == "train"]
        self.mu = _mean([d["price"] for d in train])
        self.make = self._effect(train, lambda d: d["make"], lambda d: self.mu)
        self.model = self._effect(train, lambda d: d["model_key"], lambda d: self.mu + self.make[d["make"]])
        self.trim = self._effect(
            train, lambda d: d["trim_key"], lambda d: self.mu + self.make[d["make"]] + self.model[d["model_key"]]
        )
        self.year = self._effect(
            train,
            lambda d: (d["trim_key"], d["year"]),
            lambda d: self.mu + self.make[d["make"]] + self.model[d["model_key"]] + self.trim[d["trim_key"]],
        )
        self.line = self._lines(self.year)
        tiers = {}
        for d in self.rows:
            tiers.setdefault((d["trim_key"], d["year"]), []).append(d["mileage_range"])
        self.tier = {k: None if None in v else _mean(v) for k, v in tiers.items()}
        self.tier_line = self._lines(self.tier)
        by_trim = {}
        for d in self.rows:
            by_trim.setdefault(d["trim_key"], []).append(d)
        self.price = {k: _mean([d["price"] for d in v]) for k, v in by_trim.items()}
        self.mean_year = {k: _mean([d["year"] for d in v]) for k, v in by_trim.items()}

    @staticmethod
    def _effect(rows, key, explained):
        left = {}
        for d in rows:
            left.setdefault(key(d), []).append(d["price"] - explained(d))
        return {k: _mean(v) for k, v in left.items()}

    @staticmethod
    def _lines(points):
        by_trim = {}
        for (trim, year), y in points.items():
            by_trim.setdefault(trim, []).append((year, y))
        out = {}
        for trim, pts in by_trim.items():
            if len(pts) == 1:
                out[trim] = (pts[0][1], 0.0)
            elif any(y is None for _, y in pts):
                out[trim] = (None, None)
            else:
                slope, intercept = np.polyfit([x - 2000 for x, _ in pts], [y for _, y in pts], 1)
                out[trim] = (intercept - 2000 * slope, slope)
        return out

    def predict(self, d):
        t = d["trim_key"]
        if t not in self.trim:
            return None
        a, b = self.line[t]
        aa, bb = self.tier_line[t]
        price = self.price[t]
        flat = price * 0.1 * (d["year"] - self.mean_year[t]) if abs(b) < 1e-9 else 0.0
        pred1 = self.mu + self.make[d["make"]] + self.model[d["model_key"]] + self.trim[t] + a + b * d["year"] + flat
        if aa is None or bb is None or d["mileage"] is None:
            return None
        expected = max(aa + bb * d["year"], 0.0)
        pred2 = pred1 + 0.16 * pred1 * (expected - d["mileage_range"]) / 100000
        return max(pred2, 0.2 * price)


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows()
    return rows, with_keys(spark.createDataFrame(rows, COLUMNS)).cache()


@pytest.fixture(scope="module")
def model(data):
    return effects.fit(data[1], P)


def test_effects_match_brute_force(data, model):
    brute = Brute(data[0])
    assert model.mu == pytest.approx(brute.mu)
    assert {r["make"]: r["b_make"] for r in model.make.collect()} == pytest.approx(brute.make)
    assert {r["model_key"]: r["b_model"] for r in model.model.collect()} == pytest.approx(brute.model, abs=1e-6)
    trims = {r["trim_key"]: r for r in model.trim.collect()}
    for trim, effect in brute.trim.items():
        assert trims[trim]["b_trim"] == pytest.approx(effect, abs=1e-6)
        assert trims[trim]["b"] == pytest.approx(brute.line[trim][1], abs=1e-5)
        assert trims[trim]["a"] == pytest.approx(brute.line[trim][0], abs=1e-2)
        assert trims[trim]["bb"] == pytest.approx(brute.tier_line[trim][1], abs=1e-5)
    years = {(r["trim_key"], r["year"]): r["b_year"] for r in model.trim_year.collect()}
    for key, effect in brute.year.items():
        assert years[key] == pytest.approx(effect, abs=1e-6)


def test_predictions_match_brute_force(data, model):
    brute = Brute(data[0])
    got = {r["id"]: r["pred3"] for r in scoring.score(data[1], model, P).collect()}
    want = {d["id"]: brute.predict(d) for d in brute.rows}
    assert any(v is None for v in want.values())
    for row_id, value in want.items():
        assert (got[row_id] is None) == (value is None), row_id
        if value is not None:
            assert got[row_id] == pytest.approx(value, abs=1e-3)


def test_fit_on_train_only(data):
    m = effects.fit(data[1], Params(fit_on="train"))
    train = [r for r in data[0] if r[-1] == "train"]
    brute = Brute(train)
    trims = m.trim.collect()
    got = {r["trim_key"]: r["price_pmmt"] for r in trims if r["price_pmmt"] is not None}
    assert got == pytest.approx(brute.price)
    # listings are counted over all rows all the same
    full = {r["trim_key"]: r["listing_count"] for r in effects.fit(data[1], P).trim.collect()}
    assert {r["trim_key"]: r["listing_count"] for r in trims} == full


def test_reloaded_model_scores_the_same(spark, data, model):
    path = new_path(spark, "model")
    model.save(path)
    again = PriceModel.load(spark, path)
    one = {r["id"]: r["pred3"] for r in scoring.score(data[1], model, P).collect()}
    two = {r["id"]: r["pred3"] for r in scoring.score(data[1], again, P).collect()}
    assert one == two
    with pytest.raises(Exception):
        model.save(path)


def test_shuffle_join_scores_the_same(data, monkeypatch):
    from lotwise import workspace

    one = {r["id"]: r["pred3"] for r in scoring.score(data[1], effects.fit(data[1], P), P).collect()}
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", -1)
    spark = data[1].sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        two = {r["id"]: r["pred3"] for r in scoring.score(data[1], effects.fit(data[1], P), P).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert one == pytest.approx(two, nan_ok=True)


def test_unseen_trim_has_no_prediction(spark, model):
    car = spark.createDataFrame([("Hot", "m0", "new", 4, "auto", 2016, 1000.0)],
                                "make string, model string, trim string, cylinder int, gear_type string, year int, mileage double")
    row = scoring.score(with_keys(car), model, P).first()
    assert row["pred3"] is None and row["stage_make"] is not None


def test_ladder_matches_brute_force(data, model):
    errors = evaluate.stage_errors(data[1], model, P)
    ladder = {r["stage"]: r for r in evaluate.rmse_ladder(errors).collect()}
    brute = Brute(data[0])
    test = [d for d in brute.rows if d["split"] == "test"]
    preds = [brute.predict(d) for d in test]
    mean = _mean([p for p in preds if p is not None])
    rmse = math.sqrt(_mean([(d["price"] - (mean if p is None else p)) ** 2 for d, p in zip(test, preds)]))
    assert ladder[5]["rmse"] == pytest.approx(rmse, rel=1e-6)
    assert ladder[5]["improvement"] == pytest.approx(ladder[4]["rmse"] - ladder[5]["rmse"])
    train = [d["price"] for d in brute.rows if d["split"] == "train"]
    assert ladder[0]["rmse"] == pytest.approx(np.std(train)) and ladder[0]["improvement"] == 0
    log = evaluate.metrics_log(errors).collect()
    assert len(log) == 7 and sum(r["method_on_validation"] is not None for r in log) == 1


def test_imputation(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "id string, pred double")
    got = {r["id"]: r["pred"] for r in evaluate.impute_missing_prediction(df, "pred").collect()}
    assert got == {"a": 1.0, "b": 2.0, "c": 3.0}


# --- deals: identities on our own output ------------------------------------------


@pytest.fixture(scope="module")
def full_deals(study):
    from lotwise.catalog.study import P as TP

    return deals.deals_full_linear(study.scored, TP).collect()


def test_deal_identities(full_deals):
    assert full_deals
    for r in full_deals:
        gap = (r["L_Predicted_Price"] - r["Price"]) / r["Price"] * 100
        assert r["L_Price_Gap_Percentage"] == pytest.approx(gap) and gap > 20
        before = r["Average_Price_per_Trim"] + r["Year_Effect"]
        want = max(before + r["Mileage_Effect"], 0.2 * r["Average_Price_per_Trim"])
        assert r["L_Predicted_Price"] == pytest.approx(want)
        off = r["Average_Milerange_per_Trim_Year_LR"] - math.ceil(r["Mileage"] / 10000) * 10000
        assert r["Mileage_Effect"] == pytest.approx(0.16 * before * off / 100000, abs=1e-6)
        assert r["Trim"].startswith(f"{r['Make']}-{r['Model']}-")
        assert r["Mileage"] < 80000
    assert list(full_deals[0].asDict()) and set(deals.LINEAR_COLUMNS) == set(full_deals[0].asDict())


def test_sorted_deals(spark, study):
    from lotwise.catalog.study import P as TP

    rows = deals.sorted_deals(deals.deals_recent_linear(study.fresh_scored, TP)).collect()
    keys = [(r["Trim"], -r["L_Price_Gap_Percentage"], r["Id"]) for r in rows]
    assert rows and keys == sorted(keys)


def test_backtest_and_guard(spark):
    rows = [("1", 315.0, 200980.0), ("2", 100.0, 120.0), ("3", 100.0, 130.0), ("4", 100.0, 140.0)]
    df = spark.createDataFrame(rows, "Id string, Price double, Average_Price_per_Trim double")
    status = spark.createDataFrame([("2", "Sold"), ("3", "sold "), ("4", None)], "Id string, status string")
    plain = deals.outcome_backtest(df, status).first()
    assert (plain["recommended"], plain["sold"], plain["hit_rate"]) == (4, 2, 0.5)
    guarded = deals.outcome_backtest(df, status, guard=0.1).first()
    assert (guarded["recommended"], guarded["sold"]) == (3, 2)


def test_formatted_export(spark):
    df = spark.createDataFrame([(120000.0, 73700.0, 159320.184)], "Price double, Mileage double, L_Predicted_Price double")
    row = deals.formatted(df).first()
    assert tuple(row) == ("120,000", "73,700", "159,320.18")


def test_scoring_plan_has_no_shuffle(study, capsys):
    study.scored.select("id", "pred3").explain()
    plan = capsys.readouterr().out
    assert plan.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert "price_raw" not in plan and "link" not in plan


def test_filters_reach_the_scan(study, capsys):
    from lotwise.catalog.study import P as TP

    deals.filters.deal_filter_full(study.scored, TP).select("id").explain()
    plan = capsys.readouterr().out
    assert "LessThan(mileage,80000.0)" in plan and "EqualTo(date_sold,)" in plan


def test_missing_keys(spark):
    fresh = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "trim_key string")
    known = spark.createDataFrame([("a",)], "trim_key string")
    assert sorted(r[0] for r in rank.missing_trims(fresh, known).collect()) == ["b", "c"]
