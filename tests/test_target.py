import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickroll.operators import quantiles, target

from conftest import rows_by


def _labels(spark, values):
    return spark.createDataFrame([(f"s{i}", float(v)) for i, v in enumerate(values)],
                                 "user_session string, session_value double")


def test_negative_target_log_variants(spark):
    df = _labels(spark, [-0.5, -2.0])
    c = rows_by(target.log_target(df, clip_negative=True), "user_session")
    assert c["s0"]["y"] == 0.0 and c["s1"]["y"] == 0.0
    p = rows_by(target.log_target(df, clip_negative=False), "user_session")
    assert p["s0"]["y"] == pytest.approx(math.log1p(-0.5)) and p["s1"]["y"] is None


def test_winsorize_bounds(spark):
    df = _labels(spark, [1, 2, 3, 4, 10])
    up = rows_by(target.winsorize_upper(df, "session_value", 0.995), "user_session")
    assert up["s4"]["session_value"] == pytest.approx(9.88)
    two = rows_by(target.winsorize_two_sided(df, "session_value", 0.995), "user_session")
    assert two["s0"]["session_value"] == pytest.approx(1.02)
    assert two["s4"]["session_value"] == pytest.approx(9.88)
    # inactive parameters leave the values alone
    same = rows_by(target.winsorize_upper(df, "session_value", 0.3), "user_session")
    assert same["s4"]["session_value"] == 10


def test_inverse_roundtrip(spark):
    df = target.log_target(_labels(spark, [0.0, 12.5]), clip_negative=True)
    back = rows_by(target.inverse_target(df, "y", "back"), "user_session")
    assert back["s1"]["back"] == pytest.approx(12.5)


def test_exact_quantiles_with_a_hot_value(spark):
    vals = [0.0] * 4000 + list(np.linspace(1, 100, 2001))
    df = _labels(spark, vals)
    probs = [0.0, 0.25, 0.5, 0.66, 0.75, 0.995, 1.0]
    got = quantiles.exact_quantiles(df, "session_value", probs)
    assert got == pytest.approx(list(np.quantile(np.array(vals), probs)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=300),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_match_numpy(spark, vals, probs):
    got = quantiles.exact_quantiles(_labels(spark, vals), "session_value", probs)
    assert got == pytest.approx(list(np.quantile(np.array(vals), probs)), rel=1e-9, abs=1e-6)


def _bits(x):
    b = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -b if x < 0 else b


def test_ordered_key_is_the_bits_of_the_double(spark):
    rng = np.random.default_rng(0)
    powers = 2.0 ** np.arange(-1074, 1024)
    v = np.concatenate([rng.integers(0, 2**64, 5000, dtype=np.uint64).view(np.float64), powers, -powers, np.nextafter(powers[52:], 0), np.nextafter(powers[52:-1], np.inf),
                        [0.0, -0.0, np.inf, -np.inf, 5e-324, 1.7976931348623157e308], np.arange(-300, 300) / 100])
    v = [float(x) for x in v if x == x]
    got = spark.createDataFrame([(x,) for x in v], "x double").select("x", quantiles.ordered_key(F.col("x")).alias("k")).collect()
    assert [r.k for r in got] == [_bits(r.x) for r in got]


def test_close_values_take_four_passes_at_most(spark, monkeypatch):
    """Values that differ in their last bits only."""
    vals = [1.0 + i * 2.0 ** -52 for i in range(300)] * 3
    seen = []
    window = quantiles.Window.partitionBy
    monkeypatch.setattr(quantiles.Window, "partitionBy", lambda *a: (seen.append(a), window(*a))[1])
    got = quantiles.exact_quantiles(_labels(spark, vals), "session_value", [0.1, 0.5, 0.995])
    assert got == list(np.quantile(np.array(vals), [0.1, 0.5, 0.995]))
    assert len([a for a in seen if "_up" in a]) == 4


def test_quantiles_by_group(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g) if g < 6 else None, float(x)) for g, x in zip(rng.integers(0, 7, 1500), rng.normal(50, 10, 1500), strict=True)]
    rows += [(9, None), (9, float("nan")), (10, 4.0)]
    got = {r.g: (r.n, r.q) for r in quantiles.quantiles_by(spark.createDataFrame(rows, "g int, x double"), "x", [0.1, 0.5, 0.995], ["g"]).collect()}
    assert set(got) == {None, 0, 1, 2, 3, 4, 5, 10}
    for g, (n, q) in got.items():
        mine = [x for k, x in rows if k == g and x is not None]
        assert n == len(mine) and q == pytest.approx(list(np.quantile(mine, [0.1, 0.5, 0.995])))
