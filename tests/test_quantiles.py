import numpy as np
import pytest

from peerbench.operators import quantiles as q

PROBS = {"a": 0.05, "b": 0.5, "c": 0.95}


def samples():
    rng = np.random.default_rng(7)
    return {
        "normal": rng.normal(size=3000),
        "wide": np.exp(rng.normal(scale=40, size=2000)) * rng.choice([-1, 1], 2000),
        "ties": rng.integers(-3, 4, 2500).astype(float),
        "hot": np.where(rng.random(3000) < 0.4, 5.0, rng.random(3000) * 10),
        "near": 1 + rng.integers(0, 5000, 3000) * 2.0**-52,
        "tiny": np.array([5e-324, 0.0, -5e-324, 1e-300, -1e308, 1e308]),
        "one": np.array([3.5]),
        "six": np.arange(6.0),
        "five": np.arange(5.0),
    }


@pytest.fixture(scope="module")
def data(spark):
    rows = [(k, float(v)) for k, vs in samples().items() for v in vs]
    rows += [("normal", float("nan")), ("normal", float("inf")), ("normal", None), ("none", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(7).cache()


def trimmed(values):
    lo, hi = np.quantile(values, [0.05, 0.95])
    kept = values[(values >= lo) & (values <= hi)]
    return kept.mean(), len(kept)


@pytest.mark.parametrize("exact_rows", [100_000, 20])
@pytest.mark.parametrize("small_rows", [200_000, 0])
def test_quantiles_equal_numpy(data, monkeypatch, exact_rows, small_rows):
    monkeypatch.setattr(q, "SMALL_ROWS", small_rows)
    got = {r["k"]: r for r in q.grouped_quantiles(data, ["k"], "v", PROBS, exact_rows).collect()}
    assert set(got) == set(samples())
    for k, values in samples().items():
        assert got[k]["n_values"] == len(values)
        want = np.quantile(values, list(PROBS.values()))
        assert [got[k][n] for n in PROBS] == pytest.approx(want, rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("exact_rows", [100_000, 20])
def test_trimmed_mean_equals_numpy(data, exact_rows):
    out = q.trimmed_mean(data, ["k"], "v", scale=None, exact_rows=exact_rows)
    got = {r["k"]: r for r in out.collect()}
    assert set(got) == {k for k, v in samples().items() if len(v) > 5}
    for k, row in got.items():
        mean, n = trimmed(samples()[k])
        assert row["n_used"] == n
        assert row["avg_value"] == pytest.approx(mean, rel=1e-9)
        assert row["n_total"] == len(samples()[k])


def test_min_n_and_scale(data):
    got = q.trimmed_mean(data.where("k in ('six', 'five')"), ["k"], "v", min_n=1, scale=2)
    assert {(r["k"], r["avg_value"], r["n_used"]) for r in got.collect()} == {
        ("six", 2.5, 4), ("five", 2.0, 3)}


def test_same_result_for_any_partitioning(data):
    def run(df):
        return sorted(map(tuple, q.trimmed_mean(df, ["k"], "v").collect()))

    assert run(data.coalesce(1)) == run(data.repartition(13))
