"""All settings in one pass against the operators one by one."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.scalar import noleap_doy
from gridloom.operators import bias, units
from gridloom.operators.kernel import Setting, adjust_grid
from gridloom.operators.windows import series_keys

W, NQ = 9, 6


def table(spark, seed, models, scenarios, years=3, first=1999):
    """Two cells of daily precipitation-like values with dry days, gaps and a leap day."""
    rng, rows = np.random.default_rng(seed), []
    for m in models:
        for s in scenarios:
            for c in (1, 2):
                for i in range(365 * years + 1):
                    if rng.random() > 0.02:
                        v = None if rng.random() < 0.02 else 0.0 if rng.random() < 0.3 + 0.1 * len(m or "") else float(rng.gamma(2, 3))
                        rows.append((m, s, c, dt.date(first, 1, 1) + dt.timedelta(days=i), v))
    df = spark.createDataFrame(rows, "model string, scenario string, cell_id long, date date, value double")
    return df.drop(*(n for n, given in (("model", models), ("scenario", scenarios)) if given == [None])).withColumns({"year": F.year("date"), "doy": noleap_doy(F.col("date"))})


@pytest.fixture(scope="module")
def sides(spark):
    ref, hist = table(spark, 1, [None], [None]), table(spark, 2, ["a", "bb"], ["historical"])
    return ref.cache(), hist.cache(), table(spark, 3, ["a", "bb"], ["low", "high"], 2, 2020).withColumns({"note": F.lit("kept"), "value": F.col("value") + 0.5}).cache()


def same(made, want, columns):
    key = [c for c in columns if c != "value"]
    a = {tuple(r[c] for c in key): r["value"] for r in made.collect()}
    b = {tuple(r[c] for c in key): r["value"] for r in want.collect()}
    assert a.keys() == b.keys() and a
    assert all((x is None) == (b[k] is None) and (x is None or abs(x - b[k]) < 1e-8 * max(1, abs(x))) for k, x in a.items())


@pytest.mark.parametrize("kind", ["+", "*"])
def test_methods(sides, kind):
    ref, hist, sim = sides
    settings = [Setting("qdm", None, W, NQ), Setting("qm", None, W, NQ), *(Setting("dqm", t, W, NQ) for t in ("mean", "poly1", "poly3", "loess"))]
    made = adjust_grid(ref, hist, sim, [*settings, settings[0]], kind).cache()
    qmap = bias.qdm_train(ref, hist, kind, NQ, W).cache()
    same(made.where("method = 'qdm'"), bias.qdm_adjust(qmap, sim, kind, NQ, W), sim.columns)
    same(made.where("method = 'qm'"), bias.eqm_adjust(qmap, sim, kind), sim.columns)
    for t in ("mean", "poly1", "poly3", "loess"):
        same(made.where(f"trend = '{t}'"), bias.dqm_adjust(ref, hist, sim, kind, NQ, W, t), sim.columns)


def test_sweep_of_adaptation_and_jitter(sides):
    ref, hist, sim = sides
    made = bias.param_sweep(ref, hist, sim, "+", [W, 5], [NQ], (None, 1.5, 4.0), (None, 0.4), seed=7).cache()
    assert made.select("window", "nq", "adapt", "jitter").distinct().count() == 12
    noisy = lambda df, j: df if j is None else units.jitter_under(df, j, [*series_keys(df), "date"], 9)
    for w, a, j in ((W, None, 0.4), (W, 1.5, None), (5, 4.0, 0.4)):
        r, h = noisy(ref, j), noisy(hist, j)
        h = h if a is None else bias.adapt_freq(r, h, a, w, 7)
        want = bias.qdm_adjust(bias.qdm_train(r, h, "+", NQ, w), sim, "+", NQ, w)
        same(made.where((F.col("window") == w) & F.col("adapt").eqNullSafe(F.lit(a)) & F.col("jitter").eqNullSafe(F.lit(j))), want, sim.columns)


def test_shuffles_do_not_depend_on_the_number_of_settings(sides):
    ref, hist, sim = sides
    plan = lambda n: bias.param_sweep(ref, hist, sim, "+", list(range(3, 3 + 2 * n, 2)), [NQ])._jdf.queryExecution().executedPlan().toString()
    assert plan(1).count("Exchange") == plan(9).count("Exchange") and plan(9).count("FlatMapGroupsInArrow") == 1


def test_empty_and_unmatched(spark, sides):
    ref, hist, sim = sides
    assert adjust_grid(ref, hist, sim.where("false"), [Setting()]).count() == 0
    alone = adjust_grid(ref, hist.where("model = 'a'"), sim, [Setting(window=W, nq=NQ)])
    assert alone.where("model = 'bb'").count() == sim.where("model = 'bb'").count() and alone.where("model = 'bb' and value is not null").count() == 0
    assert adjust_grid(ref.where("false"), hist, sim, [Setting("dqm", "mean", W, NQ)]).count() == 0
    with pytest.raises(ValueError):
        Setting("dqm")
