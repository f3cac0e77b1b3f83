import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.timeseries import LINKS
from groundswell.operators import timeseries as TS

DAYS = [0, 12, 24, 48, 60]


def test_inversion_with_missing_pairs(spark, rng):
    rows, want = [], {}
    for col in range(40):
        kept = [p for p in LINKS if rng.random() > 0.3] if col % 2 else LINKS
        if not any(0 in p[1:] for p in kept):
            kept = [LINKS[0], *kept]
        phases = rng.normal(size=len(kept))
        rows += [(p, a, b, 0, col, float(x)) for (p, a, b), x in zip(kept, phases)]
        days = sorted({d for _, a, b in kept for d in (a, b)})
        design = np.zeros((len(kept), len(days)))
        for i, (_, a, b) in enumerate(kept):
            design[i, days.index(b)] += 1
            design[i, days.index(a)] -= 1
        tied = {0}
        for _ in LINKS:
            tied |= {d for _, a, b in kept if tied & {a, b} for d in (a, b)}
        free = [k for k, d in enumerate(days) if d in tied and d]
        x = np.linalg.lstsq(design[:, free], phases, rcond=None)[0]
        want[col] = {d: None for d in days} | {0: 0.0} | {days[k]: v for k, v in zip(free, x)}
    df = spark.createDataFrame(
        rows, "pair_id int, ref_idx int, sec_idx int, row int, col int, phase double")
    got: dict = {}
    for r in TS.invert_network(df).collect():
        got.setdefault(r["col"], {})[r["idx"]] = r["phase"]
    assert set(got) == set(want)
    for col, series in want.items():
        assert got[col] == pytest.approx(series)


@pytest.mark.parametrize("seed", range(4))
def test_stacked_networks_equal_one_by_one(seed):
    rng = np.random.default_rng(seed)
    days, pixels, rows = 9, 60, []
    for p in range(pixels):
        pairs = [(a, b) for a in range(days) for b in range(a + 1, min(days, a + 4)) if rng.random() < rng.choice([0.25, 0.9])]
        rows += [(p, a, b, rng.normal()) for a, b in pairs for _ in range(rng.integers(1, 3))]
    p, a, b, f = (np.array(c) for c in zip(*rows))
    present, got = TS.solve_networks(p, a, b, f, pixels, days, 0)
    for k in range(pixels):
        own = p == k
        tied = {0} if 0 in {*a[own], *b[own]} else set()
        for _ in range(days):
            tied |= {d for x, y in zip(a[own], b[own]) if tied & {x, y} for d in (x, y)}
        free = sorted(tied - {0})
        design = np.array([[int(y == d) - int(x == d) for d in free] for x, y in zip(a[own], b[own])], float).reshape(own.sum(), len(free))
        want = np.full(days, np.nan)
        want[sorted(tied)] = 0.0
        want[free] = np.linalg.lstsq(design, f[own], rcond=None)[0] if free else []
        assert got[k] == pytest.approx(want, nan_ok=True)
        assert set(np.flatnonzero(present[k])) == {*a[own], *b[own]}


def test_work_does_not_grow_with_the_kinds_of_gaps():
    """2,000 pixels that each lack other pairs take about as long as 2,000 that lack none."""
    rng = np.random.default_rng(1)
    links = np.array([(a, b) for a in range(20) for b in range(a + 1, min(20, a + 4))])

    def took(share):
        keep = rng.random((2000, len(links))) >= share
        p, k = np.nonzero(keep)
        start = time.perf_counter()
        TS.solve_networks(p, links[k, 0], links[k, 1], rng.normal(size=len(p)), 2000, 20, 0)
        return time.perf_counter() - start

    whole, gaps = (min(took(share) for _ in range(5)) for share in (0.0, 0.3))
    assert gaps < 3 * whole


def test_clean_ramp_gives_its_rate(spark):
    rate = 0.5  # phase per year
    rows = [(p, a, b, 0, c, rate * (DAYS[b] - DAYS[a]) / 365.25 * (c + 1), 0.9)
            for p, a, b in LINKS for c in range(3)]
    stack = spark.createDataFrame(
        rows, "pair_id int, ref_idx int, sec_idx int, row int, col int, phase double, coherence double")
    dates = spark.createDataFrame(list(enumerate(DAYS)), "idx int, day int")
    series = TS.invert_network(stack)
    for r in TS.timeseries_velocity(series, dates).collect():
        assert r["velocity"] == pytest.approx(rate * (r["col"] + 1))
        assert r["velocity_std"] == pytest.approx(0.0, abs=1e-7)
    assert TS.temporal_coherence(stack, series).agg(F.min("value")).first()[0] == pytest.approx(1.0)
    ref = TS.reference_phase(stack, (0, 0))
    assert ref.where("col = 0 AND abs(phase) > 1e-12").count() == 0


def test_no_reference_pixel_leaves_phases(spark):
    stack = spark.createDataFrame(
        [(1, 0, 1, 0, 0, 0.3, 0.2)],
        "pair_id int, ref_idx int, sec_idx int, row int, col int, phase double, coherence double")
    assert TS.reference_phase(stack).first()["phase"] == 0.3
    assert TS.reference_phase(stack, (5, 5)).count() == 0
    assert TS.modify_network(stack).count() == 0
    assert TS.apply_delay(stack) is stack


def test_reference_pixel_does_not_move(spark, rng):
    from groundswell.plans.flows import timeseries_flow

    rows = [(p, a, b, r, c, float(rng.normal()), 0.9) for p, a, b in LINKS for r in range(6) for c in range(5)]
    stack = spark.createDataFrame(
        rows, "pair_id int, ref_idx int, sec_idx int, row int, col int, phase double, coherence double")
    dates = spark.createDataFrame(list(enumerate(DAYS)), "idx int, day int")
    found = []
    for at in ((0, 0), (5, 3)):
        out = timeseries_flow(stack, dates, reference=at)["series"]
        at_ref = out.where(f"row = {at[0]} and col = {at[1]}").collect()
        assert [r["phase"] for r in at_ref] == pytest.approx([0.0] * 5, abs=1e-9)
        found.append({(r["row"], r["col"], r["idx"]): r["phase"] for r in out.collect()})
    assert any(abs(found[0][k] - found[1][k]) > 1e-3 for k in found[0])


def test_pair_without_phase_at_the_reference_is_dropped(spark):
    stack = spark.createDataFrame(
        [(1, 0, 1, 0, 0, 1.0, 0.9), (1, 0, 1, 0, 1, 3.0, 0.8), (2, 1, 2, 0, 0, None, 0.9), (2, 1, 2, 0, 1, 5.0, 0.8)],
        "pair_id int, ref_idx int, sec_idx int, row int, col int, phase double, coherence double")
    got = TS.reference_phase(stack, (0, 0)).collect()
    assert sorted((r["pair_id"], r["col"], r["phase"]) for r in got) == [(1, 0, 0.0), (1, 1, 2.0)]


def test_layers_are_dealt_by_their_own_rows(spark):
    """Layers made from few rows by pixel: the aggregate by pair and pixel has a shuffle of its own."""
    from groundswell.sources import stack as SK

    pixels = spark.range(40).select(F.col("id").cast("int").alias("row"), F.lit(0).alias("col"))
    layer = pixels.select(F.explode(F.sequence(F.lit(1), F.lit(5))).alias("pair_id"), "row", "col").withColumn(
        "value", F.col("pair_id") * 100.0 + F.col("row"))
    pairs = spark.range(1, 7).select(F.col("id").cast("int").alias("pair_id"))
    out = SK.load_stack(pairs, layer, layer.where("pair_id <> 2"))
    assert "REPARTITION_BY_COL" in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["pair_id"], r["row"]): (r["phase"], r["coherence"]) for r in out.collect()}
    want = {(p, r): (p * 100.0 + r, None if p == 2 else p * 100.0 + r) for p in range(1, 6) for r in range(40)}
    assert got == {**want, (6, None): (None, None)}
