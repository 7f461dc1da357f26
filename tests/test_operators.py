"""Operators against brute force and by their properties."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fragloom.functions import lowess as kernel
from fragloom.functions.lowess import corrected, lowess
from fragloom.operators import cohort as co, gc, matrix as mx, metrics as me, model as md
from fragloom.operators.intervals import overlap_join
from fragloom.operators.joins import lookup_join, product_rows, top_rows_per_group
from fragloom.operators.ranking import exact_quantiles, hash_rank, running_totals
from fragloom.params import Params


def direct_lowess(x, y, frac, iterations=3):
    """Plain loop over points, straight from the definition."""
    order = np.argsort(x, kind="mergesort")
    x, y = x[order], y[order]
    n, k = len(x), int(frac * len(x) + 1e-10)
    robust, fit = np.ones(n), np.zeros(n)
    for step in range(iterations + 1):
        for i in range(n):
            distance = np.sort(np.abs(x - x[i]))
            h = distance[k - 1]
            d = np.abs(x - x[i]) / h if h > 0 else np.where(x == x[i], 0.0, 1.0)
            w = np.where(d < 1, (1 - np.minimum(d, 1) ** 3) ** 3, 0.0) * robust
            w = w / w.sum()
            mean = (w * x).sum()
            spread = max((w * (x - mean) ** 2).sum(), 1e-12)
            fit[i] = (w * (1 + (x[i] - mean) * (x - mean) / spread) * y).sum()
        if step < iterations:
            r = np.abs(y - fit)
            u = r / (6 * np.median(r)) if np.median(r) > 0 else (r > 0).astype(float)
            u = np.where(u >= 0.999, 1.0, np.where(u <= 0.001, 0.0, u))
            robust = (1 - u * u) ** 2
    return x, fit


@pytest.mark.parametrize("ties", [False, True])
def test_lowess_equals_the_loop(ties):
    rng = np.random.default_rng(3)
    x = rng.normal(0.41, 0.05, 300)
    if ties:
        x = np.round(x, 2)
    y = np.column_stack([np.sin(9 * x) + rng.normal(0, 0.1, 300), rng.gamma(2, 1, 300)])
    fit_x, fits = lowess(x, y, 0.3)
    for c in range(2):
        sorted_x, want = direct_lowess(x, y[:, c], 0.3)
        got = fits[np.searchsorted(fit_x, sorted_x), c]
        np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-10)


def test_lowess_keeps_a_line_and_corrects_it_away():
    x = np.linspace(0.3, 0.6, 200)
    fit_x, fits = lowess(x, 2 * x + 1, 0.3)
    np.testing.assert_allclose(fits[:, 0], 2 * fit_x + 1, atol=1e-10)
    np.testing.assert_allclose(corrected(2 * x + 1, x)[:, 0], np.median(2 * x + 1), atol=1e-10)


def test_correction_without_gc_spread_is_identity():
    y = np.array([3.0, 1.0, 2.0, 5.0, 4.0, 9.0])
    np.testing.assert_allclose(corrected(y, np.full(6, 0.5))[:, 0], y)
    np.testing.assert_allclose(corrected(y[:4], np.array([0.1, 0.2, 0.3, 0.4]))[:, 0], y[:4])


def levels_of(x, block):
    x = np.sort(x)
    levels, size = np.unique(x, return_counts=True)
    before = np.cumsum(size) - size
    number = before // block
    rows = [levels[number == i] for i in np.unique(number)]
    start = np.array([before[number == i][0] for i in np.unique(number)])
    return x, levels, before, number, np.array([r[0] for r in rows]), np.array([r[-1] for r in rows]), start


@pytest.mark.parametrize("n, block, ties", [(500, 16, 0), (3000, 100, 0), (3000, 64, 40), (50, 8, 3), (10, 100, 0), (700, 1, 0)])
def test_block_plan_covers_every_neighbourhood(n, block, ties):
    x = np.random.default_rng(n + ties).random(n)
    x, levels, before, number, first, last, start = levels_of(np.round(x * ties) / ties if ties else x, block)
    k = kernel.neighbours(n, 0.3)
    low, high = kernel.block_ranks(first, last, start, n, k)
    plan = kernel.block_plan(first, last, start, n, 0.3)
    ids = np.unique(number)
    middles = (x[: n - k] + x[k:]) / 2
    left = np.minimum(np.searchsorted(middles, levels), n - k)
    radius = np.maximum(levels - x[left], x[left + k - 1] - levels)
    for i, block_id in enumerate(ids):
        mine = number == block_id
        assert low[i] <= left[mine].min() and left[mine].max() <= high[i]
        rows = plan[plan[:, 0] == i]
        near, far = rows[rows[:, 2] == 0, 1], rows[rows[:, 2] != 0, 1]
        inside = np.unique(np.concatenate([
            number[np.abs(levels - p) < h] for p, h in zip(levels[mine], radius[mine])] + [number[mine]]))
        assert set(np.searchsorted(ids, inside)) <= {*near, *far}
        for j in far:  # whole inside every radius, on one side
            assert ((np.abs(levels[number == ids[j]][:, None] - levels[mine]) <= radius[mine] * (1 + 1e-12)).all())
            assert j != i
        some = np.isin(number, ids[near])
        got = kernel.window_radius(levels[mine], levels[some], before[some], n, k, low[i], high[i])
        np.testing.assert_array_equal(got, radius[mine])


def test_merged_moments_are_those_of_all_levels():
    rng = np.random.default_rng(8)
    x, r, ry = np.sort(rng.random(90)), rng.random((90, 2)), rng.random((90, 2))
    parts = kernel.merged([kernel.node(x[a:b], r[a:b], ry[a:b]) for a, b in ((0, 1), (1, 30), (30, 90))])
    whole = kernel.node(x, r, ry)
    np.testing.assert_allclose(parts.r, whole.r, atol=1e-12)
    np.testing.assert_allclose(parts.ry, whole.ry, atol=1e-12)
    assert kernel.merged([]) is None


def bins_of(sample, gc_content, rng):
    n = len(gc_content)
    return pd.DataFrame({
        "sample_id": sample, "chrom": "chr1", "start": np.arange(n) * 10, "end": np.arange(n) * 10 + 10,
        "bin_id": [f"b{i}" for i in range(n)], "short_long_ratio": 1.0, "mean_fragment_length": 167.0,
        "gc_content": gc_content, **{m: rng.random(n) for m in gc.METRICS}})


def test_ranged_correction_equals_the_kernel(spark):
    rng = np.random.default_rng(11)
    frames = [bins_of("many", rng.random(700), rng), bins_of("ties", np.round(rng.random(400), 2), rng),
              bins_of("four", rng.random(4), rng), bins_of("flat", np.full(30, 0.41), rng),
              bins_of("hot", np.where(rng.random(300) < 0.5, 0.4, rng.random(300)), rng)]
    counts = spark.createDataFrame(pd.concat(frames))
    missing = counts.limit(1).withColumn("gc_content", F.lit(None).cast("double")).withColumn("bin_id", F.lit("none"))
    got = gc.correct_gc_ranged(counts.union(missing), block=24).toPandas().set_index(["sample_id", "bin_id"])
    assert len(got) == sum(map(len, frames)) + 1
    for frame in frames:
        sample = frame["sample_id"][0]
        want = corrected(frame[gc.METRICS].to_numpy(), frame["gc_content"].to_numpy())
        rows = got.loc[[(sample, b) for b in frame["bin_id"]]]
        if sample == "many":  # the median is that of all bins, the one without gc included
            continue
        np.testing.assert_allclose(rows[[m + gc.SUFFIX for m in gc.METRICS]].to_numpy(), want, atol=1e-9)
    none = got[got.index.get_level_values("bin_id") == "none"]
    assert none[[m + gc.SUFFIX for m in gc.METRICS]].isna().all(axis=None)


def test_method_of_correction_and_the_flat_rule(spark):
    rng = np.random.default_rng(2)
    frames = [bins_of("line", rng.random(40), rng), bins_of("flat", np.full(9, 0.4), rng), bins_of("few", rng.random(3), rng)]
    counts = spark.createDataFrame(pd.concat(frames))
    got = gc.correct(counts, 40, method="linear").toPandas()
    for frame in frames:
        y, x = frame["coverage_total"].to_numpy(), frame["gc_content"].to_numpy()
        flat = len(x) < 5 or x.min() == x.max()
        fit = np.full(len(x), np.median(y)) if flat else np.polyval(np.polyfit(x, y, 1), x)
        rows = got[got["sample_id"] == frame["sample_id"][0]].sort_values("start")
        np.testing.assert_allclose(rows["coverage_total_gc_corrected"], y - fit + np.median(y), atol=1e-10)
    with pytest.raises(ValueError):
        gc.correct(counts, 40, method="cubic")
    wide = gc.correct(counts, gc.SAMPLE_BINS + 1)
    assert "FlatMapGroupsInPandas" not in wide._jdf.queryExecution().executedPlan().toString()


def test_spark_correction_equals_the_kernel(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({
        "sample_id": np.repeat(["a", "b"], 80), "chrom": "chr1", "start": np.tile(np.arange(80) * 10, 2),
        "end": np.tile(np.arange(80) * 10 + 10, 2), "bin_id": [f"b{i}" for i in np.tile(np.arange(80), 2)],
        "short_long_ratio": 1.0, "mean_fragment_length": 167.0, "gc_content": np.tile(rng.random(80), 2),
        **{m: rng.random(160) for m in gc.METRICS}})
    out = gc.correct_gc(spark.createDataFrame(pdf)).toPandas()
    for sample, part in pdf.groupby("sample_id"):
        want = corrected(part[gc.METRICS].to_numpy(), part["gc_content"].to_numpy())
        got = out[out.sample_id == sample].set_index("bin_id").loc[part["bin_id"]]
        np.testing.assert_allclose(got[[m + gc.SUFFIX for m in gc.METRICS]].to_numpy(), want)


INTERVALS = "id bigint, chrom string, start bigint, `end` bigint"


@pytest.mark.parametrize("options", [{}, {"max_bytes": 0}, {"max_bytes": 0, "salts": 4}])
def test_overlap_join_equals_nested_loop(spark, options):
    r = random.Random(4)
    spans = lambda n, top: [
        (i, f"c{r.randint(1, 2)}", s, s + r.choice([0, 1, 50, 16384, 16385, 70000, 2_000_000][:top]))
        for i, s in enumerate(r.randint(0, 3_000_000) for _ in range(n))]
    left, right = spans(300, 7), [s for s in spans(60, 7) if s[3] > s[2]]
    a = spark.createDataFrame(left, INTERVALS)
    b = spark.createDataFrame(right, INTERVALS).select(
        F.col("id").alias("rid"), "chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    want = sorted((x[0], y[0]) for x in left for y in right if x[1] == y[1] and x[2] < y[3] and x[3] > y[2])
    got = overlap_join(a, b, **options)
    assert sorted((q["id"], q["rid"]) for q in got.collect()) == want
    kept = overlap_join(a, b, "left_anti", **options)
    assert sorted(q["id"] for q in kept.collect()) == sorted({x[0] for x in left} - {p[0] for p in want})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_salted_lookup_keeps_every_row(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), "id")
    small = spark.createDataFrame([(1, "hot"), (900, "cold"), (5000, "unused")], "k bigint, v string")
    for how, n in (("inner", 701), ("left", 1000), ("left_semi", 701), ("left_anti", 299)):
        for options in ({}, {"max_bytes": 0}, {"max_bytes": 0, "salts": 16}):
            assert lookup_join(big, small, ["k"], how, **options).count() == n


def test_product_has_every_pair(spark):
    rows = spark.range(7).withColumnRenamed("id", "a")
    items = spark.range(13).withColumnRenamed("id", "b")
    assert product_rows(rows, items).distinct().count() == 91


def test_top_rows_of_a_hot_group(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"), "id")
    out = top_rows_per_group(df, ["g"], [F.col("id").desc()], 4, index="n")
    got = {(r["g"], r["n"]): r["id"] for r in out.collect()}
    ids = {}
    for i in range(2000):
        ids.setdefault("hot" if i % 3 == 0 else f"g{i % 5}", []).append(i)
    assert got == {(g, n + 1): v for g, all_ids in ids.items() for n, v in enumerate(sorted(all_ids, reverse=True)[:4])}


def test_running_totals_with_a_hot_range(spark):
    r = random.Random(7)
    rows = [(g, v, r.randint(1, 5)) for g in ("a", "b", None) for v in {round(r.gauss(0, 1e-6), 12) for _ in range(400)} | {5.0, -7.0}]
    df = spark.createDataFrame(rows, "g string, v double, n bigint")
    out = running_totals(df, "v", ["n"], ["g"], parts=8).collect()
    for g in ("a", "b", None):
        mine = sorted((v, n) for h, v, n in rows if h == g)
        seen, want = 0, {}
        for v, n in mine:
            want[v] = seen
            seen += n
        assert {q["v"]: q["n_before"] for q in out if q["g"] == g} == want
        assert {q["n_total"] for q in out if q["g"] == g} == {seen}


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.random(501), np.full(300, 0.25)])
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    got = exact_quantiles(df, "x", {"a": 0.0, "b": 0.37, "c": 0.95, "d": 1.0}, parts=16).head()
    np.testing.assert_allclose(list(got), np.quantile(values, [0.0, 0.37, 0.95, 1.0]))


def test_hash_rank_counts_every_row(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"), F.md5(F.col("id").cast("string")).alias("h"))
    got = hash_rank(df, ["g"], "h", "n", "size").orderBy("g", "h").collect()
    for g in (0, 1):
        assert [r["n"] for r in got if r["g"] == g] == list(range(1, 1501))
    assert {r["size"] for r in got} == {1500}


def scored_frame(spark, n=400, seed=2):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    s = np.round(0.3 * y + rng.random(n), 2)
    return y, s, spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")


def test_areas_equal_pair_counting(spark):
    y, s, df = scored_frame(spark)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    ap = sum((pos == t).sum() / len(pos) * (pos >= t).sum() / (s >= t).sum() for t in np.unique(s))
    got = me.areas(df, "y", "s").head()
    assert got["roc_auc"] == pytest.approx(auc) and got["pr_auc"] == pytest.approx(ap)
    turned = me.areas(df.withColumn("s", -F.col("s")), "y", "s").head()
    assert turned["roc_auc"] == pytest.approx(1 - auc)
    one = me.areas(df.filter("y = 1"), "y", "s").head()
    assert one["roc_auc"] is None and one["pr_auc"] is None


def test_threshold_without_controls(spark):
    _, _, df = scored_frame(spark)
    got = me.thresholds_at_specificity(df.filter("y = 1"), "y", "s").collect()
    assert [r["threshold"] for r in got] == [0.5, 0.5, 0.5]


def test_thresholds_and_sensitivity(spark):
    y, s, df = scored_frame(spark)
    limits = me.thresholds_at_specificity(df, "y", "s")
    found = {r["specificity"]: r for r in me.sensitivity_at_thresholds(df, limits, "y", "s").collect()}
    for q in (0.95, 0.98, 0.99):
        t = np.quantile(s[y == 0], q)
        assert found[q]["threshold"] == pytest.approx(t)
        assert found[q]["sensitivity"] == pytest.approx((s[y == 1] >= found[q]["threshold"]).mean())


def test_one_value_histogram(spark):
    df = spark.createDataFrame([("a", 0.5)] * 3, "label string, s double")
    row = me.score_histogram(df, "s", "label").collect()
    assert len(row) == 1 and row[0]["n_samples"] == 3 and row[0]["bin"] == 10


def test_sample_z_has_mean_zero_and_sd_one(spark):
    rng = np.random.default_rng(9)
    rows = [("s1", f"c:{i}-{i + 1}", *map(float, rng.random(5))) for i in range(50)] + [("s2", "c:0-1", 1.0, 1.0, 1.0, 1.0, 1.0)]
    columns = ["sample_id", "bin_id", "coverage_total_gc_corrected", "coverage_short_gc_corrected",
               "coverage_long_gc_corrected", "short_long_ratio", "mean_fragment_length"]
    df = spark.createDataFrame(rows, columns)
    z = mx.sample_z_features(df).toPandas()
    total = z[(z.sample_id == "s1") & z.feature_name.str.endswith("_total_gc_corrected_sample_z")].value
    assert total.mean() == pytest.approx(0, abs=1e-12) and total.std() == pytest.approx(1)
    assert z[z.sample_id == "s2"].value.isna().all()
    flat = df.filter("sample_id = 's1'").withColumn("short_long_ratio", F.lit(2.0))
    same = mx.sample_z_features(flat).filter(F.col("feature_name").contains("short_long_ratio"))
    assert {r["value"] for r in same.collect()} == {0.0}


def toy_cohort(spark, n=60, features=12):
    rng = np.random.default_rng(11)
    labels = [(f"p{i:03d}", "lung_cancer" if i % 3 == 0 else "control") for i in range(n)]
    rows = [(s, f"f{j:02d}", None if (i + j) % 17 == 0 else float(rng.normal(0, 1) + (2.5 if lab != "control" and j < 3 else 0)))
            for i, (s, lab) in enumerate(labels) for j in range(features)]
    return (spark.createDataFrame(rows, "sample_id string, feature_name string, value double"),
            spark.createDataFrame(labels, "sample_id string, label string"))


def test_split_sizes_of_the_published_cohort(spark):
    df = spark.range(286).select(F.col("id").cast("string").alias("sample_id"), (F.col("id") < 86).cast("int").alias("y"))
    split = co.stratified_split(df)
    counts = {(r["partition"], r["y"]): r["count"] for r in split.groupBy("partition", "y").count().collect()}
    assert counts == {("train", 0): 150, ("test", 0): 50, ("train", 1): 64, ("test", 1): 22}
    small = co.stratified_split(df.filter("sample_id < 3"))
    assert {r[0] for r in small.select("partition").distinct().collect()} <= {"train"} or small.count() >= 8


def test_training_end_to_end(spark, tmp_path):
    features, labels = toy_cohort(spark)
    done = md.train(features, labels, Params(max_features=6), md.Learner(trees=10, tree_depth=5, rounds=5))
    assert set(done.metrics) == set(md.CANDIDATES)
    best = done.metrics[done.model.name]
    assert best["roc_auc"] > 0.9 and best["roc_auc"] == max(b["roc_auc"] for b in done.metrics.values())
    assert done.metadata["train_class_counts"] == {"0": 30, "1": 15}
    assert done.metadata["test_class_counts"] == {"0": 10, "1": 5}
    assert best["heldout_test"]["tp"] + best["heldout_test"]["fn"] == 5
    cv = done.cv_predictions.toPandas()
    assert len(cv) == 60 and cv[cv.partition == "test"].cv_probability.isna().all()
    assert cv[cv.partition == "train"].cv_probability.notna().all()
    md.save(done.model, str(tmp_path / "m"))
    again = md.load(spark, str(tmp_path / "m"))
    noise = features.unionByName(features.limit(1).withColumn("feature_name", F.lit("unknown")))
    got = md.predict(again, noise, labels).toPandas().set_index("sample_id")
    tested = done.test_predictions.toPandas().set_index("sample_id")
    np.testing.assert_allclose(got.loc[tested.index].cancer_probability, tested.test_probability)
    assert (got.qc_pass).all() and set(got.model_version) == {"0.1.0"}
    with pytest.raises(ValueError, match="two classes"):
        md.train(features, labels.withColumn("label", F.lit("control")))


def test_pivot_refuses_unbounded_width(spark):
    features, _ = toy_cohort(spark)
    with pytest.raises(ValueError):
        mx.pivot_features(features, limit=5)


def test_motifs_of_fragments_beyond_the_bound(spark):
    from fragloom.operators.regions import end_motif_counts
    from fragloom.sources.readers import chunk_sequence
    sequence = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(400))
    reference = chunk_sequence(spark.createDataFrame([("1", sequence)], "chrom string, sequence string"), 50, 40)
    fragments = spark.createDataFrame(
        [("s", "1", 3, 103), ("s", "1", 10, 40), ("s", "1", 0, 41)], "sample_id string, chrom string, start bigint, `end` bigint")
    rows = lambda bound: sorted(map(tuple, end_motif_counts(fragments, reference, 50, 40, bound).collect()))
    assert rows(40) == rows(None)
    assert sum(n for _, _, n in rows(40)) == 9


def test_zero_keeps_all_features(spark):
    from fragloom.operators.cohort import select_k_best
    scored = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "feature_name string, f_value double")
    assert select_k_best(scored, 0).count() == 3 and select_k_best(scored, 2).count() == 2


def test_all_sheet_errors_are_there(spark):
    from fragloom.operators.samples import SheetErrors, validate
    columns = "sample_id string, label string, fastq_1 string, fastq_2 string, bam string, cram string, line bigint"
    sheet = spark.createDataFrame([("", "", "", "", "", "", i) for i in range(300)], columns)
    for column in ("batch", "age", "sex", "stage", "split", "patient_id", "source_type", "sequencing_center", "cancer_type", "smoking_status"):
        sheet = sheet.withColumn(column, sheet["label"])
    try:
        validate(sheet)
    except SheetErrors as failure:
        assert failure.errors.count() >= 300
        assert str(failure).endswith(f"{failure.errors.count()} errors in all")
    except ValueError as missing:
        pytest.skip(str(missing))
    else:
        raise AssertionError("no error")


def test_report_without_labels(spark):
    from fragloom.plans.evaluation import report_tables
    metadata = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    predictions = spark.createDataFrame(
        [("a", 0.9, "cancer_like", 0.5), ("b", 0.1, "control_like", 0.5)],
        "sample_id string, cancer_probability double, classification string, threshold_used double")
    tables = report_tables(metadata, predictions)
    assert "roc_curve" not in tables and "confusion" not in tables
    for table in tables.values():
        table.collect()
    assert tables["ranked_predictions"].count() == 2


# Selection inside the folds, and vectors


def long_values(spark, samples=60, features=9, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(f"s{i}", f"f{j}", None if rng.random() < 0.2 else float(np.round(rng.normal(i % 2 * j, 2), 1)))
            for i in range(samples) for j in range(features)]
    rows += [(f"s{i}", "constant", 4.0) for i in range(samples)] + [("s0", "rare", 1.5), ("s3", "none", None)]
    training = spark.createDataFrame(
        [(f"s{i}", i % 2, i % 7 % 3 if i else 2) for i in range(samples)], "sample_id string, y int, fold int")
    return spark.createDataFrame(rows, "sample_id string, feature_name string, value double"), training


@pytest.mark.parametrize("limit", [100_000, 0])
@pytest.mark.parametrize("folds", [3, 0])
def test_fold_statistics_equal_those_of_exploded_rows(spark, monkeypatch, limit, folds):
    monkeypatch.setattr(co, "MEDIAN_COHORT_LIMIT", limit)
    features, training = long_values(spark)
    if not folds:
        training = training.withColumn("fold", F.lit(None).cast("int"))
    got = co.fold_stats(co.join_labels(features, training, "fold"), training, folds)
    every = training.withColumn("fit_fold", F.explode(F.array(*[F.lit(f) for f in range(folds + 1)])))
    every = every.filter((F.col("fit_fold") == folds) | (F.col("fold") != F.col("fit_fold")))
    sizes = every.groupBy("fit_fold", "y").agg(F.count(F.lit(1)).alias("n_class"))
    want = co.selection_stats(co.join_labels(features, every, "fit_fold"), sizes, ["fit_fold", "feature_name"])
    key = ["fit_fold", "feature_name"]
    a, b = (x.toPandas().sort_values(key).set_index(key) for x in (got, want))
    assert list(a.index) == list(b.index)
    np.testing.assert_allclose(a[b.columns].to_numpy().astype(float), b.to_numpy().astype(float), atol=1e-9)


def test_fold_statistics_shuffle_the_values_once(spark):
    features, training = long_values(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = features.join(F.broadcast(training), "sample_id")
        plan = co.fold_stats(rows, training, 3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(feature_name") == 1 and "Expand" not in plan
    assert plan.index("Generate") < plan.index("Window")  # printed from the top: fits appear after the sums


def test_vectors_of_all_fits(spark):
    from pyspark.ml.functions import vector_to_array
    features, _ = long_values(spark)
    features = features.union(spark.createDataFrame([("s1", "f1", 99.0), ("s2", "f0", None)], features.schema))
    index = spark.createDataFrame(
        [(0, 0, "f0", 1.0, 2.0), (0, 1, "f1", None, 1.0), (1, 0, "constant", 3.0, 0.5), (1, 1, "f1", -1.0, 4.0), (1, 2, "gone", 7.0, 1.0)],
        "fit int, idx int, feature_name string, fill double, scale double")
    samples = spark.createDataFrame([("s1",), ("s2",), ("stranger",), ("s1",)], "sample_id string")
    vectors = mx.model_vectors(features, index, samples, ["fit"])
    got = {(r[0], r[1]): r[2] for r in vectors.select("sample_id", "fit", vector_to_array("features")).collect()}
    values = {}
    for r in features.collect():
        if r.value is not None:
            values[r.sample_id, r.feature_name] = max(r.value, values.get((r.sample_id, r.feature_name), -np.inf))
    want = {}
    for sample in ("s1", "s2", "stranger"):
        for fit in (0, 1):
            rows = sorted(r for r in index.collect() if r.fit == fit)
            want[sample, fit] = [values.get((sample, r.feature_name), r.fill or 0.0) / r.scale for r in rows]
    assert got == want
    single = mx.model_vectors(features, index.filter("fit = 1").drop("fit"), samples)
    assert {r[0]: r[1] for r in single.select("sample_id", vector_to_array("features")).collect()} == {
        s: v for (s, fit), v in want.items() if fit == 1}
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# Union of groups, and the summary document


def test_union_shuffles_shared_names_only(spark):
    schema = "sample_id string, feature_name string, value double"
    bins = spark.createDataFrame([(s, f"bin{i}", float(i)) for s in "ab" for i in range(50)] + [("a", "both", 1.0)], schema)
    arms = spark.createDataFrame([("a", "both", 2.0), ("b", "both", 3.0), ("a", "arm", None)], schema)
    late = spark.createDataFrame([("b", "arm", 9.0), ("a", "alone", 5.0)], schema)
    got = mx.union_features(bins, arms, late)
    want = {("a", "both"): 2.0, ("b", "both"): 3.0, ("a", "arm"): None, ("b", "arm"): 9.0, ("a", "alone"): 5.0}
    rows = {(r.sample_id, r.feature_name): r.value for r in got.collect()}
    assert rows == {**want, **{(s, f"bin{i}"): float(i) for s in "ab" for i in range(50)}} and got.count() == len(rows)
    apart = mx.union_features(bins.filter("feature_name <> 'both'"), late.filter("feature_name = 'alone'"))
    assert "Exchange" not in apart._jdf.queryExecution().executedPlan().toString()
    assert apart.count() == 101
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1  # of the rows that share a name


def test_summary_document(spark, tmp_path):
    import json
    from fragloom.plans.evaluation import analysis_summary, report_files, report_tables
    from fragloom.sources import writers as wr
    metadata = spark.createDataFrame([("a", "control"), ("b", "lung_cancer"), ("c", None)], "sample_id string, label string")
    scores = spark.createDataFrame(
        [("a", 0.2, "lower_fragmentome_score"), ("b", 0.9, "elevated_fragmentome_score"), ("c", 0.2, None), ("d", None, None)],
        "sample_id string, cancer_probability double, classification string")
    cv = spark.createDataFrame([(1, 0.9), (0, 0.1), (0, None)], "y_true int, cv_probability double")
    one_class = spark.createDataFrame([(1, 0.9)], "y_true int, test_probability double")
    facts = {"model_name": "logistic_l2", "nested": {"0.95": [1, 2.5]}}
    summary = analysis_summary(metadata, scores, cv, one_class, model_metadata=facts)
    path = str(tmp_path / "summary")
    wr.write_json_summary(summary, path)
    document = json.loads(spark.read.text(path).head()[0])
    assert document["n_samples"] == 4 and document["n_predictions"] == 3 and document["unique_score_count"] == 2
    assert document["classification_counts"] == {
        "null": 2, "lower_fragmentome_score": 1, "elevated_fragmentome_score": 1}
    assert document["class_counts"] == {"0": 3, "1": 1}
    assert document["confusion_matrix"] == {"tp": 1, "tn": 3, "fp": 0, "fn": 0}
    assert (document["sensitivity"], document["specificity"], document["roc_auc"]) == (1.0, 1.0, 1.0)
    assert document["cross_validated_predictions"] == {"n_samples": 2, "unique_score_count": 2, "roc_auc": 1.0, "pr_auc": 1.0}
    assert "heldout_test_predictions" not in document and "classification_warning" not in document
    assert document["model_metadata"] == facts
    assert "few unique values" in document["score_warning"] and "supplied prediction file" in document["evaluation_warning"]
    bare = analysis_summary(metadata.drop("label"), scores)
    wr.write_json_summary(bare, path)
    plain = json.loads(spark.read.text(path).head()[0])
    assert not {"class_counts", "confusion_matrix", "roc_auc", "sensitivity", "evaluation_warning"} & set(plain)
    report_files({"top_scores": report_tables(metadata, scores)["top_scores"]}, summary, str(tmp_path / "report"))
    assert (tmp_path / "report" / "top_scores" / "_SUCCESS").exists()
    assert (tmp_path / "report" / "prediction_analysis_summary" / "_SUCCESS").exists()


def test_lookups_that_grow_are_not_broadcast(spark):
    """Rows that explode makes, and long texts, are not in the estimates of adaptive execution."""
    from fragloom.operators.regions import end_motif_counts, wps
    from fragloom.sources.readers import chunk_sequence
    sizes = spark.range(4).groupBy((F.col("id") % 2).cast("string").alias("chrom")).agg(F.count(F.lit(1)).alias("n"))
    genome = chunk_sequence(sizes.select("chrom", F.repeat(F.lit("ACGGT"), 4000).alias("sequence")), 64, 8)
    fragments = spark.range(500).select(
        F.lit("s").alias("sample_id"), (F.col("id") % 2).cast("string").alias("chrom"),
        (F.col("id") * 31).alias("start"), (F.col("id") * 31 + 90).alias("end"))
    regions = spark.range(20_000).select(
        (F.col("id") % 2).cast("string").alias("chrom"), F.col("id").alias("start"), (F.col("id") + 9).alias("end"),
        F.col("id").cast("string").alias("name"))
    for df, n in ((end_motif_counts(fragments, genome, 64, 8), 1500), (wps(fragments, regions, spark.range(1).select(F.lit("s").alias("sample_id"))), None)):
        rows = df.collect()
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert n is None or sum(r["n"] for r in rows) == n


@pytest.mark.parametrize("copies", [1, 30])
def test_counts_on_intervals_equal_counted_hits(spark, copies):
    from fragloom.operators.coverage import fragment_hits
    r = random.Random(9)
    rows = [(f"s{r.randint(1, 3)}", f"c{r.randint(1, 2)}", s, s + r.choice([0, 1, 167, 2048, 9000])) for s in
            (r.choice([r.randint(-50, 30_000), 2048, 4096, 100]) for _ in range(300))] * copies
    spans = [(f"c{r.randint(1, 3)}", s, s + r.choice([1, 60, 2048, 25_000])) for s in
             (r.choice([r.randint(-50, 30_000), 2048, 267, 0]) for _ in range(60))]
    fragments = spark.createDataFrame(rows, "sample_id string, chrom string, start bigint, `end` bigint").withColumn(
        "length", F.col("end") - F.col("start"))
    bins = spark.createDataFrame(spans * 2, "chrom string, start bigint, `end` bigint")
    counted = fragment_hits(fragments, bins, lengths=False)
    want = {}
    for sample, chrom, s, e in rows:
        for c, rs, re_ in set(spans):
            if c == chrom and s < re_ and e > rs:
                want[sample, c, rs, re_] = want.get((sample, c, rs, re_), 0) + 1
    assert {tuple(q)[:4]: q["n"] for q in counted.collect()} == want
    hits = fragment_hits(fragments, bins).groupBy("sample_id", "chrom", "start", "end").count()
    assert {tuple(q)[:4]: q["count"] for q in hits.collect()} == want


def forest_rows(spark, n=600, features=9, seed=3):
    rng = np.random.default_rng(seed)
    y = (np.arange(n) % 3 == 0).astype(int)
    x = rng.normal(size=(n, features)) + y[:, None] * np.linspace(0, 1.2, features)
    x[:, 4] = rng.integers(0, 3, n)
    return x, y, rows_of(spark, x, y)


def rows_of(spark, x, y):
    from pyspark.ml.linalg import Vectors
    return spark.createDataFrame(
        [(f"p{i:04d}", int(c), Vectors.dense(row)) for i, (row, c) in enumerate(zip(x.tolist(), y))], ["sample_id", "y", "features"])


def plain_tree(x, cuts, times, y, weight, tree, seed, depth, heap=1):
    """Probability of class 1 at the leaf of each row, one node at a time."""
    from fragloom.operators import forest as fo
    binned = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1)

    def leaf(rows, heap):
        w = np.array([(times[rows] * (y[rows] == c)).sum() * weight[c] for c in (0, 1)])
        gini = lambda v: 1 - ((v / v.sum()) ** 2).sum()
        best, found = fo.LEAST_GAIN, None
        if w.all() and heap.bit_length() <= depth:
            for f in fo.chosen(np.array([heap]), tree, seed, x.shape[1])[0]:
                for cut in range(fo.BINS - 1):
                    left = binned[rows, f] <= cut
                    a = np.array([(times[rows][left] * (y[rows][left] == c)).sum() * weight[c] for c in (0, 1)])
                    if a.sum() and (w - a).sum() > 1e-9:
                        gain = gini(w) - (a.sum() * gini(a) + (w - a).sum() * gini(w - a)) / w.sum()
                        if gain > best + 1e-13:
                            best, found = gain, (f, cut)
        if found is None:
            return {heap: (None, w[1] / w.sum())}
        f, cut = found
        left = binned[rows, f] <= cut
        return {heap: (f, cut), **leaf(rows[left], 2 * heap), **leaf(rows[~left], 2 * heap + 1)}

    nodes = leaf(np.flatnonzero(times), heap)

    def value(row):
        at = heap
        while nodes[at][0] is not None:
            at = 2 * at + int(binned[row, nodes[at][0]] > nodes[at][1])
        return nodes[at][1]
    return np.array([value(i) for i in range(len(x))])


def forest_scores(model, rows):
    from pyspark.ml.functions import vector_to_array
    return np.array([r[0] for r in model.transform(rows).orderBy("sample_id").select(vector_to_array("probability")[1]).collect()])


@pytest.mark.parametrize("node_rows", [1 << 15, 60])
def test_forest_is_that_of_a_plain_loop(spark, node_rows):
    from fragloom.operators import forest as fo
    x, y, rows = forest_rows(spark, 300, 5)
    weights = {0: 300 / (2 * 200), 1: 300 / (2 * 100)}
    model = fo.fit_forest(rows, weights, 300, 4, 6, 7, node_rows)
    key = np.array([r[0] for r in rows.orderBy("sample_id").select(F.xxhash64("sample_id")).collect()])
    expected = np.mean([plain_tree(x, model.cuts, fo.draws(key, t, 7), y, (weights[0], weights[1]), t, 7, 6) for t in range(4)], axis=0)
    np.testing.assert_allclose(forest_scores(model, rows), expected, atol=1e-9)


def test_forest_of_many_parts_is_the_same(spark, tmp_path):
    from fragloom.operators import forest as fo
    x, y, rows = forest_rows(spark, 3000)
    weights = {0: 0.75, 1: 1.5}
    whole = fo.fit_forest(rows, weights, 3000, 5, 30, 7)
    assert whole.parts.count() == 5 and len(whole.top.nodes) == 5
    cut = fo.fit_forest(rows.repartition(7), weights, 3000, 5, 30, 7, 100)
    assert cut.parts.count() > 100 and cut.top.part.sum() == cut.parts.count()
    scores = forest_scores(whole, rows)
    np.testing.assert_array_equal(scores, forest_scores(cut, rows))
    cut.save(str(tmp_path / "f"))
    np.testing.assert_array_equal(scores, forest_scores(fo.Forest.load(str(tmp_path / "f")), rows))
    x, y, other = forest_rows(spark, 3000, seed=4)
    assert ((forest_scores(whole, other) > 0.5) == y).mean() > 0.8


def test_forest_is_as_good_as_that_of_spark(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from fragloom.operators import forest as fo
    _, _, rows = forest_rows(spark, 1500)
    _, y, other = forest_rows(spark, 1500, seed=5)
    own = forest_scores(fo.fit_forest(rows, {0: 0.75, 1: 1.5}, 1500, 40, 30, 7), other)
    weighted = rows.withColumn("weight", F.when(F.col("y") == 1, 1.5).otherwise(0.75))
    theirs = forest_scores(RandomForestClassifier(
        labelCol="y", numTrees=40, maxDepth=30, seed=7, featureSubsetStrategy="sqrt", weightCol="weight").fit(weighted), other)
    area = lambda s: np.mean(s[y == 1][:, None] > s[y == 0]) + np.mean(s[y == 1][:, None] == s[y == 0]) / 2
    assert abs(area(own) - area(theirs)) < 0.02 and abs(own.mean() - theirs.mean()) < 0.03


def test_forest_of_equal_rows_of_one_class_and_of_none(spark):
    from fragloom.operators import forest as fo
    x, y = np.ones((400, 3)), np.arange(400) % 2
    same = rows_of(spark, x, y)
    model = fo.fit_forest(same, {0: 1.0, 1: 1.0}, 400, 3, 30, 7, 50)
    assert model.parts.count() == 0 and len(model.top.nodes) == 3  # nothing splits: no task gets all rows
    assert len(set(forest_scores(model, same))) == 1
    one = rows_of(spark, x, y * 0)
    assert set(forest_scores(fo.fit_forest(one, {0: 1.0}, 400, 3, 30, 7), one)) == {0.0}
    with pytest.raises(ValueError):
        fo.fit_forest(one.limit(0), {}, 0, 3, 30, 7)


def test_boosting_starts_no_task_for_each_file(spark, monkeypatch):
    """Hundreds of passes: 40 small parts of a table are few tasks, a large table has at most as many as cores unless they would be too large."""
    from pyspark.ml.functions import array_to_vector
    seen = []

    class Watched:
        def fit(self, train):
            seen.append((train.rdd.getNumPartitions(), train.count(), {r["y"]: r["weight"] for r in train.distinct().collect()}))

    monkeypatch.setattr(md, "_classifier", lambda *a: Watched())
    rows = spark.range(80).selectExpr("'s' || id AS sample_id", "CAST(id % 4 = 0 AS INT) AS y", "array(double(id % 4), 1D) AS v").repartition(40)
    rows = rows.select("sample_id", "y", array_to_vector("v").alias("features"))
    md.fit("gradient_boosting", rows)
    assert seen == [(1, 80, {0: 80 / 120, 1: 2.0})]
    assert md.training_tasks(0, 12) == 1
    assert md.training_tasks(10 << 20, 12) == 12
    assert md.training_tasks(3 << 19, 12) == 3
    assert md.training_tasks(1 << 30, 12) == 128


def test_fold_vectors_are_made_by_many_tasks_and_not_joined(spark):
    """Vectors are far larger than what they are made of: they are joined to nothing, and their tasks are not merged."""
    features = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("b", "y", 4.0), (None, "x", 1.0)], "sample_id string, feature_name string, value double")
    index = spark.createDataFrame([(0, 0, "x", 2.0, 1.0), (1, 0, "x", 5.0, 2.0), (1, 1, "y", 7.0, 1.0)], "fit_fold int, idx int, feature_name string, fill double, scale double")
    samples = spark.createDataFrame([("a", 0, "p"), ("b", 1, "q"), ("c", 0, None), ("b", 1, "q"), (None, 0, "r")], "sample_id string, y int, label string")
    vectors = md.fold_vectors(features, index, samples)
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[: plan.index("MapInArrow")]
    assert vectors.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = sorted((r["sample_id"], r["fit_fold"], r["y"], r["label"] or "", tuple(r["features"])) for r in vectors.collect())
    assert found == sorted([
        ("a", 0, 0, "p", (1.0,)), ("a", 1, 0, "p", (0.5, 7.0)), ("c", 0, 0, "", (2.0,)), ("c", 1, 0, "", (2.5, 7.0)),
        *2 * [("b", 0, 1, "q", (3.0,)), ("b", 1, 1, "q", (1.5, 4.0))]])


def test_driver_garbage_is_collected_while_models_are_trained(spark, monkeypatch):
    import threading
    from fragloom import session
    seen, twice = [], threading.Event()
    collect = session.collect_garbage

    def counted(own):
        collect(own)
        seen.append(threading.current_thread())
        if len(seen) > 1:
            twice.set()

    monkeypatch.setattr(session, "COLLECT_S", 0.01)
    monkeypatch.setattr(session, "collect_garbage", counted)
    before = threading.active_count()
    with session.collected(spark), session.collected(spark):  # the inner one does nothing
        assert twice.wait(30) and len(set(seen)) == 1
    made = len(seen)
    assert threading.active_count() <= before and spark.range(3).count() == 3 and len(seen) == made
    with pytest.raises(ValueError), session.collected(spark):
        raise ValueError
    twice.clear()
    waited = []
    monkeypatch.setattr(md, "fit", lambda *_: waited.append(twice.wait(30)))
    monkeypatch.setattr(md, "score", lambda _, rows, *columns: rows)
    rows = spark.range(6).selectExpr("0 as fit_fold", "int(id % 2) as fold").union(spark.range(6).selectExpr("1", "int(id % 2)"))
    assert md.cross_validate("logistic_l2", rows, 2).count() == 6
    assert waited == [True, True]  # none before: the heap grew to its limit
