"""Quantiles by narrowing histograms against pandas and the ranking of all values."""
import math
import os
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emporium.operators.quantiles import exact_quantiles
from emporium.operators.selection import Cell, _in_order, narrowed_quantiles, stacked_values
from emporium.session import ensure_checkpoint_dir

PROBS = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


def as_dict(df):
    return {(r.column_name, r.prob): r.value for r in df.collect()}


def test_equal_to_pandas_and_to_the_ranking(spark):
    rng = np.random.default_rng(5)
    n = 6000
    pdf = pd.DataFrame({"spread": rng.normal(size=n) * 10.0 ** rng.integers(-200, 200, n),
                        "close": 1.0 + rng.integers(0, 4000, n) * 2.0 ** -52,
                        "cents": rng.integers(1, 90_000, n) / 100,
                        "hot": np.where(rng.random(n) < 0.4, 19.9, rng.normal(20, 1, n)),
                        "one": np.full(n, -3.0)})
    pdf.loc[::7, "cents"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    got, ranked = as_dict(narrowed_quantiles(df, list(pdf), PROBS)), as_dict(exact_quantiles(df, list(pdf), PROBS))
    assert got == ranked
    for c in pdf:
        for p in PROBS:
            assert math.isclose(got[c, p], pdf[c].quantile(p), rel_tol=1e-9, abs_tol=1e-300), (c, p)


def test_any_bit_pattern(spark):
    """Neighbouring doubles, subnormals, both zeros, infinities."""
    rng = random.Random(2)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(900)]
    values += [5e-324 * k for k in range(-40, 40)] + [0.0, -0.0] * 20 + [math.inf, -math.inf, 1.7976931348623157e308]
    near = [math.ldexp(1.0, k) for k in range(-4, 5)]
    values += near + [np.nextafter(v, 0).item() for v in near] + [np.nextafter(v, math.inf).item() for v in near]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    kept = sorted(0.0 if v == 0 else v for v in values if not math.isnan(v))
    n = len(kept)
    got = as_dict(narrowed_quantiles(df, ["x"], [k / (n - 1) for k in range(0, n, 11)]))
    for (_, p), value in got.items():
        at = (n - 1) * p
        low, high = kept[math.floor(at)], kept[math.ceil(at)]
        assert value == (low if low == high else low + (at - math.floor(at)) * (high - low))
    assert math.copysign(1, as_dict(narrowed_quantiles(
        spark.createDataFrame([(-0.0,), (0.0,), (-0.0,)], "x double"), ["x"], [0.0]))["x", 0.0]) == 1


def test_empty_null_and_typed_columns(spark):
    df = spark.sql("SELECT CAST(id AS DECIMAL(12,2)) AS d, CAST(id AS INT) AS i, CAST(NULL AS DOUBLE) AS v, "
                   "double('NaN') AS column FROM range(5)")
    got = as_dict(narrowed_quantiles(df, ["d", "i", "v", "column"], [0.5]))
    assert got == {("d", 0.5): 2.0, ("i", 0.5): 2.0, ("v", 0.5): None, ("column", 0.5): None}
    assert set(as_dict(narrowed_quantiles(df.limit(0), ["d", "i"], PROBS)).values()) == {None}
    assert narrowed_quantiles(df, [], PROBS).count() == narrowed_quantiles(df, ["i"], []).count() == 0
    with pytest.raises(ValueError):
        narrowed_quantiles(df, ["i"], [1.5])


def test_overlapping_cells_are_joined():
    rows = [dict(low=4.0, high=9.0, rows=2), dict(low=1.0, high=4.0, rows=3), dict(low=10.0, high=10.0, rows=1)]
    assert _in_order(0, 7, rows) == [Cell(0, 1.0, 9.0, 7, 5), Cell(0, 10.0, 10.0, 12, 1)]


def test_nothing_is_left_behind(spark):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    df = spark.range(20_000).select(F.sqrt(F.col("id") + 0.5).alias("x"))
    assert as_dict(narrowed_quantiles(df, ["x"], [0.5]))["x", 0.5] == pytest.approx(math.sqrt(10_000), abs=1e-2)
    assert not [f for f in os.listdir(folder) if f.startswith("selection-")]


def test_shuffled_rows_do_not_grow_with_the_values(spark):
    """The widest exchange of a pass holds cells, whatever the number of distinct values."""
    from emporium.operators.selection import _magnitudes
    few, many = (_magnitudes(stacked_values(spark.range(n).select(F.rand(3).alias("x")), ["x"])).where("low > 0.001")
                 for n in (2_000, 200_000))
    assert few.count() <= many.count() <= 10 * 8
