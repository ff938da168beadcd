"""Properties, worked examples and brute force on a small panel with gaps, nulls and missing ticks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loomstep.functions.scalar import clip, sanitize
from loomstep.operators import crossval, daily, history, preprocess, selection, validate, xday
from loomstep.plans import pipeline
from loomstep.schema import KEYS, positive_ints, require_columns
from loomstep.sources import dated
from loomstep.sources.settings import Settings, load_settings

SCHEMA = "symbol_id int, date_id int, time_id int, x double"


def tiny(seed=1):
    r = random.Random(seed)
    rows = [(s, d, t, None if r.random() < 0.45 else round(r.gauss(0, 1), 3)) for s in range(3) for d in (0, 1, 2, 3, 4, 6, 7, 12, 13) for t in range(14) if r.random() > 0.1]
    r.shuffle(rows)
    return rows


def result(df, column="x"):
    return {tuple(r[k] for k in KEYS): r[column] for r in df.collect()}


def test_folds():
    assert crossval.sliding_folds(39, 2, 7, 4) == [(1, 0, 20, 27, 33), (2, 6, 26, 33, 39)]
    assert crossval.sliding_folds(30, 2, 2, 4) == [(1, 0, 16, 18, 23), (2, 5, 21, 23, 28)]
    assert crossval.sliding_folds(799, 2, 7, 4)[0].tr_hi == 528
    assert crossval.sliding_folds(5, 2, 5, 4) == []


def test_impute_against_brute_force(spark):
    rows = tiny()
    value = {r[:3]: r[3] for r in rows}

    def step(value, before, far, only=lambda k: True):
        out = dict(value)
        for k, v in value.items():
            if v is None and only(k):
                past = [o for o in value if value[o] is not None and before(o, k)]
                if past:
                    o = max(past, key=lambda o: (o[1], o[2]))
                    if far(o, k):
                        out[k] = value[o]
        return out

    value = step(value, lambda o, k: o[0] == k[0] and o[1:] < k[1:], lambda o, k: k[1] - o[1] <= 2, lambda k: k[2] < 10)
    day = lambda v: step(v, lambda o, k: o[:2] == k[:2] and o[2] < k[2], lambda o, k: k[2] - o[2] <= 3)
    value = day(value)
    value = step(value, lambda o, k: (o[0], o[2]) == (k[0], k[2]) and o[1] < k[1], lambda o, k: k[1] - o[1] <= 2)
    value = day(value)
    got = preprocess.causal_impute(spark.createDataFrame(rows, SCHEMA), ["x"], ttl_days_open=2, max_gap=3, ttl_days_same_tick=2)
    assert result(got) == value


@pytest.mark.parametrize(("window", "ddof", "shift"), [(1, 0, 0.0), (7, 1, 1e6), (20, 0, 0.0), (500, 1, 0.0)])
def test_clip_against_brute_force(spark, window, ddof, shift):
    rows = [(*r[:3], r[3] if r[3] is None else shift + (30.0 if i % 17 == 0 else r[3]), r[2] % 2) for i, r in enumerate(sorted(tiny(5)))]
    least = min(window, 4)
    want = {}
    for i, (s, d, t, x, b) in enumerate(rows):
        past = [o[3] for o in rows[:i] if (o[0], o[4]) == (s, b)][-window:]
        past = [v for v in past if v is not None]
        if x is not None and len(past) >= max(least, ddof + 1):
            mean = math.fsum(past) / len(past)
            std = math.sqrt(math.fsum((v - mean) ** 2 for v in past) / (len(past) - ddof))
            x = min(max(x, mean - 2 * std), mean + 2 * std)
        want[s, d, t] = x
    df = spark.createDataFrame(rows, SCHEMA + ", time_bucket int")
    got = preprocess.rolling_sigma_clip(df, ["x"], window=window, k=2.0, ddof=ddof, min_valid=least)
    assert got.columns == df.columns and result(got) == {k: v if v is None else pytest.approx(v, rel=1e-12, abs=1e-9) for k, v in want.items()}
    assert preprocess.rolling_sigma_clip(df.limit(0), ["x"]).count() == 0


def test_rows_later_change_nothing_before(spark):
    rows = tiny(2)
    late = [r if r[1] < 7 else (*r[:3], 99.0) for r in rows]
    for make in (
        lambda d: preprocess.causal_impute(d, ["x"]),
        lambda d: history.stage_c(d, ["x"], cast="double").withColumnRenamed("x__rmean5", "x"),
        lambda d: xday.stage_b(d, ["x"], lags=(1, 2), cast="double").withColumnRenamed("x_same_t_prev1", "x"),
    ):
        a, b = (result(make(spark.createDataFrame(x, SCHEMA))) for x in (rows, late))
        assert {k: v for k, v in a.items() if k[1] < 7} == {k: v for k, v in b.items() if k[1] < 7}


def test_ewm_against_recursion(spark):
    rows = [(0, d, t, float((d * 7 + t * 3) % 5)) for d in (0, 1, 2, 5, 6) for t in range(4)]
    got = result(history.ewm(spark.createDataFrame(rows, SCHEMA), ["x"], [3], "double"), "x__ewm3")
    y, last = None, None
    for s, d, t, x in rows:
        y = x if y is None or d - last > 1 else 0.5 * y + 0.5 * x
        last = d
        assert math.isclose(got[s, d, t], y)


def test_scalars(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (5.0,)], "x double")
    assert [r[0] for r in df.select(sanitize(F.col("x"))).collect()] == [None, None, None, 5.0]
    assert [r[0] for r in df.where("x is null or x = 5").select(clip(F.col("x"), -1.0, 1.0)).collect()] == [None, 1.0]


def test_preconditions(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(KeyError):
        require_columns(df, ["y"])
    with pytest.raises(ValueError):
        positive_ints([0, -1], "lags")
    assert preprocess.causal_impute(df, ["x"]).count() == 0 and history.stage_c(df, ["x"]).count() == 0


def test_dated_and_matrix(spark, tmp_path):
    df = spark.createDataFrame(tiny(3), SCHEMA).withColumn("w", F.lit(1.0))
    path = str(tmp_path / "panel")
    dated.write_dated(df, path, days=5)
    got = dated.read_dated(spark, path, 4, 6, days=5)
    assert {r["date_id"] for r in got.collect()} == {4, 6}
    assert "PartitionFilters: [isnotnull(date_block" in got._jdf.queryExecution().toString()
    for block in (0, 1, 2):
        validate.assert_time_monotone(spark, f"{path}/date_block={block}")
    meta = dated.write_matrix(dated.to_matrix(df, ["x"], target="x", weight="w", low=0, high=4), str(tmp_path / "m"))
    again, rows = dated.read_matrix(spark, str(tmp_path / "m"))
    assert again == meta and rows.count() == meta["n_rows"] and meta["dates"] == [0, 4]
    dated.write_names(spark, ["b", "", "a"], str(tmp_path / "names"))
    assert sorted(dated.read_names(spark, str(tmp_path / "names"))) == ["a", "b"]


def test_stages_and_cores(spark, tmp_path):
    assert pipeline.padded_cores(list(range(10)), 3, 4) == [(0, 3, 6), (4, 7, 9)]
    assert pipeline.padded_cores(list(range(3)), 3, 4) == []
    df = spark.createDataFrame(tiny(4), SCHEMA).withColumn("r", F.coalesce("x", F.lit(0.0)))
    found = pipeline.stages(df, ["r"], ["x"])
    assert list(found) == ["stage_a", "stage_b", *(f"stage_c_{g}" for g in history.GROUPS)]
    assert len(found["stage_a"].columns) == 3 + 30 and len(found["stage_c_rz"].columns) == 3 + 12
    (tmp_path / "s.yaml").write_text("clip: {window: 9}\nc: {lags: [1, 2]}\n")
    s = load_settings(spark, str(tmp_path / "s.yaml"))
    assert (s.clip.window, s.clip.k, s.c.lags, s.pad_days) == (9, 3.0, (1, 2), Settings().pad_days)
    assert selection.refit_rounds([100, 60]) == 88


def exchanges(df):
    """Exchanges of the plan that is run in the end."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stages_deal_rows_out_seldom(spark):
    df = spark.createDataFrame(tiny(6), SCHEMA).withColumn("r", F.col("x") * 2)
    assert exchanges(daily.stage_a(df, ["r", "x"])) <= 2
    assert exchanges(history.stage_c(df, ["r", "x"], cross=["x"])) <= 2


def test_stage_a_keeps_repeated_and_odd_rows(spark):
    rows = [(0, 0, 1, 1.0), (0, 0, 1, 1.0), (0, 1, 1, 2.0), (0, 1, None, 3.0), (None, 1, 1, 4.0), (0, None, 1, 5.0)]
    got = daily.stage_a(spark.createDataFrame(rows, SCHEMA), ["x"], cast="double").collect()
    assert sorted([tuple(r)[:3] for r in got], key=str) == sorted([r[:3] for r in rows], key=str)
    assert {(r["symbol_id"], r["date_id"], r["x_prevday_mean"]) for r in got} == {(0, 0, None), (0, 1, 1.0), (None, 1, None), (0, None, None)}


def test_ewm_of_nulls_and_long_runs(spark):
    r = random.Random(8)
    rows = [(s, 0, t, r.gauss(0, 1), None if r.random() < 0.3 else r.gauss(0, 1)) for s in range(2) for t in range(1500)]
    got = history.ewm(spark.createDataFrame(rows, SCHEMA + ", z double"), ["x", "z"], [1, 2, 30], "double").collect()
    found = {(x["symbol_id"], x["time_id"]): x for x in got}
    for c, at in (("x", 3), ("z", 4)):
        for span in (1, 2, 30):
            y, a, of = None, 2 / (span + 1), None
            for row in rows:
                y, of = (y if row[0] == of else None), row[0]
                if row[at] is not None:
                    y = row[at] if y is None else (1 - a) * y + a * row[at]
                have = found[row[0], row[2]][f"{c}__ewm{span}"]
                assert have == y if y is None else math.isclose(have, y, rel_tol=1e-9, abs_tol=1e-12)


def test_written_files_are_checked(spark, tmp_path):
    df = spark.createDataFrame(tiny(7), SCHEMA)
    got = pipeline.write_checked(df, str(tmp_path / "a"), 0, 13)
    assert got.columns == df.columns and got.count() == df.count()
    with pytest.raises(AssertionError):
        pipeline.write_checked(df, str(tmp_path / "b"), 0, 11)  # no day 11
    assert pipeline.write_checked(df, str(tmp_path / "c"), 0, 11, check=False).agg(F.max("date_id")).first()[0] == 7
    df.coalesce(1).orderBy(F.desc("time_id")).write.parquet(str(tmp_path / "d"))
    with pytest.raises(AssertionError):
        validate.assert_time_monotone(spark, str(tmp_path / "d"))
    dated.write_dated(df, str(tmp_path / "f"), days=5, file_values=200)
    assert len(spark.read.parquet(str(tmp_path / "f")).inputFiles()) > 5
    validate.assert_time_monotone(spark, str(tmp_path / "f"))
    assert sorted(map(str, dated.read_dated(spark, str(tmp_path / "f")).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        pipeline.run(df.withColumn("w", F.lit(1.0)), ["x"], ["x"], str(tmp_path / "e"), target="x", s=Settings(first_date=99))


def test_raw_reader_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, i, 0, float(i), i // 4) for i in range(12)], "symbol_id long, date_id long, time_id short, x double, partition_id int")
    df.write.partitionBy("partition_id").parquet(str(tmp_path / "raw"))
    got = dated.read_raw(spark, f"file://{tmp_path}/raw", 3, 8)
    assert sorted(r["date_id"] for r in got.collect()) == list(range(3, 9)) and dict(got.dtypes)["date_id"] == "int"
    dated.write_summary(spark, {"mean_wr2": 0.5}, str(tmp_path / "s"))
    assert dated.read_summary(spark, str(tmp_path / "s")) == {"mean_wr2": 0.5}
    dated.write_report(df.limit(2), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    assert dated.run_tag(900, 1698, 2, 7, 4, 42, "top9") == "900-1698__cv2-g7-r4__seed42__top9"
    assert dated.matrix_columns(df, target="x", weight="w") == ["partition_id"]
    assert dated.matrix_columns(df, target="t", weight="w", chosen=["x", "q"], always=["x"]) == ["x"]


def test_settings_of_all_sections(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("first_date: 3\nfolds: {gap_days: 2}\ntrees: {depth: 4}\nselection: {k: 9, always: [a]}\n")
    s = load_settings(spark, f"file://{tmp_path}/s.yaml")
    assert (s.first_date, s.last_date, s.folds.gap_days, s.folds.n_splits, s.trees.depth, s.selection.k, s.selection.always) == (3, None, 2, 2, 4, 9, ("a",))
    (tmp_path / "t.yaml").write_text("more: 1\n")
    with pytest.raises(KeyError):
        load_settings(spark, str(tmp_path / "t.yaml"))


def long_panel():
    """Two symbols of 40 days with missing ticks; one day is long, so that it spans chunks."""
    r = random.Random(11)
    rows = [(s, d, t, None if r.random() < 0.4 else r.gauss(0, 1) + (40.0 if r.random() < 0.02 else 0.0), t % 2) for s in range(2) for d in range(40) if d % 11 != 7 for t in range(60 if d == 20 else 8) if r.random() > 0.2]
    return [*rows, (None, 3, 1, 1.0, 0), (0, None, 1, 2.0, 1), (1, 5, 1, 2.0, None)]


@pytest.mark.parametrize("chunk", [1, 9, 30])
def test_chunks_change_nothing(spark, chunk):
    df = spark.createDataFrame(long_panel(), SCHEMA + ", time_bucket int").withColumn("_chunk", F.lit("kept"))
    for whole, parts in (
        (preprocess.rolling_sigma_clip(df, ["x"], window=9, k=1.5, min_valid=3), preprocess.rolling_sigma_clip(df, ["x"], window=9, k=1.5, min_valid=3, chunk_rows=chunk)),
        (preprocess.causal_impute(df, ["x"], ttl_days_open=2, max_gap=3, ttl_days_same_tick=3), preprocess.causal_impute(df, ["x"], ttl_days_open=2, max_gap=3, ttl_days_same_tick=3, chunk_days=chunk)),
        (preprocess.impute_open(df, ["x"], ttl_days=4), preprocess.impute_open(df, ["x"], ttl_days=4, chunk_days=chunk)),
    ):
        assert parts.columns == df.columns
        rows = [sorted(map(tuple, d.collect()), key=str) for d in (whole, parts)]
        assert [r[:3] for r in rows[0]] == [r[:3] for r in rows[1]] and {r[5] for r in rows[1]} == {"kept"}
        assert [r[3] for r in rows[0]] == pytest.approx([r[3] for r in rows[1]])
    clipped = preprocess.rolling_sigma_clip(df, ["x"], window=9, k=1.5, min_valid=3, chunk_rows=chunk)
    assert sum(a[3] != b[3] for a, b in zip(sorted(df.collect(), key=str), sorted(clipped.collect(), key=str), strict=True)) > 3


@pytest.mark.parametrize("chunk", [1, 9, 30])
def test_runs_in_chunks_of_days(spark, chunk):
    """Windows over runs of a panel with gaps are those of whole symbols, rows of a null day apart."""
    df = spark.createDataFrame([r for r in long_panel() if r[1] is not None], SCHEMA + ", time_bucket int")
    how = {"lags": (1, 6), "returns": (1, 2), "diffs": (3,), "rz": (4, 7), "cross": ["x"], "cast": "double", "chunk_days": chunk}
    whole = history.stage_c(df, ["x"], **how)
    parts = history.stage_c(df, ["x"], **how, groups=("lags", "ret", "diff", "rz", "csrank"))
    assert parts.columns == [c for c in whole.columns if "ewm" not in c] and len(parts.columns) == 16
    rows = [sorted((tuple(r[:3]), tuple(r[3:])) for r in d.select(F.coalesce("symbol_id", F.lit(-1)), *parts.columns[1:]).collect()) for d in (whole, parts)]
    assert [k for k, _ in rows[0]] == [k for k, _ in rows[1]]
    for (_, a), (_, b) in zip(*rows, strict=True):
        assert [x is None for x in a] == [x is None for x in b] and [x or 0 for x in a] == pytest.approx([x or 0 for x in b])
    assert exchanges(parts) <= 2


def test_one_symbol_is_many_tasks(spark):
    """With one symbol, the windows of clip, fill and runs run in as many tasks as there are chunks, as far as these are dealt apart."""
    rows = [(0, d, t, float(d * t % 7), 0) for d in range(64) for t in range(20)]
    df = spark.createDataFrame(rows, SCHEMA + ", time_bucket int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for made in (
            preprocess.rolling_sigma_clip(df, ["x"], window=10, chunk_rows=100),
            preprocess.causal_impute(df, ["x"], ttl_days_open=1, ttl_days_same_tick=1, chunk_days=4),
            history.stage_c(df, ["x"], groups=("lags", "ret", "diff", "rz"), chunk_days=4),
        ):
            assert made.select(F.spark_partition_id().alias("p"), "*").groupBy("p").count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_order_across_files(spark, tmp_path):
    """Files that are in order in themselves but not from one to the next are found, whatever the stretches."""
    for i, days in enumerate(([0, 1], [2, 4], [3, 5])):
        spark.createDataFrame([(0, d, t, 1.0) for d in days for t in range(3)], SCHEMA).coalesce(1).sortWithinPartitions("date_id", "time_id").write.parquet(str(tmp_path / f"m/part={i}"))
    rows = validate.read_in_order(spark, str(tmp_path / "m"))
    for stretch in (1, 4, 100):
        assert tuple(validate.order_breaks(rows, stretch=stretch).first()) == (18, 0, 0, 1)
    with pytest.raises(AssertionError, match="1 files"):
        validate.assert_time_monotone(spark, str(tmp_path / "m"))
    assert tuple(validate.order_breaks(rows.limit(0)).first()) == (0, 0, 0, 0)
    found = dated.footer_range(spark, str(tmp_path / "m"))
    assert tuple(found.first()) == (0, 5, 18)
    assert "PushedAggregation: [MIN(date_id), MAX(date_id), COUNT(*)]" in found._jdf.queryExecution().toString()


def small_run(spark, path, pad=2, core=3, days=None):
    from loomstep.sources.settings import StageA, StageB, StageC

    rows = [(s, d, t, math.sin(s + d * 3 + t) if (s + d + t) % 5 else None, float((d * t + s) % 7), 1.0) for s in range(2) for d in range(days or 9) for t in range(4)]
    df = spark.createDataFrame(rows, "symbol_id int, date_id int, time_id int, x double, r double, weight double").repartition(3)
    s = Settings(daily_ticks=4, buckets=2, pad_days=pad, core_days=core, a=StageA((1,), (1,), (2,), "double"), b=StageB((1, 2), cast="double"), c=StageC((1,), (1,), (1,), (2,), (2,), True, ("x",), "double"))
    return df, s, str(path)


def test_cores_as_keys(spark, tmp_path):
    """All cores in one plan give what each gives on its own; rows of other cores and of the padding change nothing."""
    df, s, _ = small_run(spark, tmp_path)
    clean = pipeline.clean_panel(df, ["x"], s)
    cores = pipeline.cores_of(clean, s)
    assert cores == [(0, 2, 4), (3, 5, 7), (6, 8, 8)]
    for name in pipeline.STAGES:
        make = lambda rows, name=name: pipeline.stages(rows, ["r"], ["x"], s)[name]
        got = pipeline.on_cores(clean, cores, make)
        one = [pipeline.on_core(clean, make, *c) for c in cores]
        assert got.dtypes == one[0].dtypes
        assert sorted(map(str, got.collect())) == sorted(str(r) for part in one for r in part.collect()), name


def test_stitch_moves_no_rows(spark, tmp_path):
    """The parts lie in buckets of the keys, so their joins need no exchange, also where they are read in another session."""
    from loomstep.sources.bucketed import read_bucketed

    df, s, out = small_run(spark, tmp_path)
    clean, buckets = pipeline.write_clean(df, ["x"], f"{out}/clean", s, columns=10**7)
    assert buckets == 11
    parts = pipeline.write_stages(clean, ["r"], ["x"], f"{out}/stages", buckets, s)
    again = [read_bucketed(spark.newSession(), f"{out}/stages/{n}", buckets) for n in pipeline.STAGES]
    for found in (parts, again):
        base = clean if found is parts else read_bucketed(again[0].sparkSession, f"{out}/clean", buckets)
        base.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        made = pipeline.panel(base, found, ["x"], target="r", low=2, high=8, daily_ticks=4)
        made.write.format("noop").mode("overwrite").save()
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 8 and "Exchange" not in plan
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert pipeline.write_panel(clean, parts, f"{out}/panel", ["x"], target="r", s=s).count() == 56


def test_buckets_hold_few_rows():
    """Joining a bucket is one task, so narrow panels are cut by rows as well."""
    from loomstep.sources.bucketed import buckets_of

    assert [buckets_of(n, 40) for n in (1000, 10**6, 36 * 10**6)] == [1, 8, 275]
    assert buckets_of(10**6, 3303) == 50


def test_stitch_keeps_all_rows_and_columns(spark):
    base = spark.createDataFrame([(0, 1, t, float(t), "a") for t in (0, 1, 1, 2)], SCHEMA + ", `o.k` string")
    parts = [spark.createDataFrame([(0, 1, t, t * 10) for t in (1, 2, 9)], "symbol_id int, date_id int, time_id int, y int"), spark.createDataFrame([(0, 1, 2, 5)], "symbol_id int, date_id int, time_id int, z int")]
    got = pipeline.stitch(base, parts)
    assert got.columns == [*KEYS, "x", "o.k", "y", "z"]
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 0, 0.0, "a", None, None), (0, 1, 1, 1.0, "a", 10, None), (0, 1, 1, 1.0, "a", 10, None), (0, 1, 2, 2.0, "a", 20, 5)]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin") == 2 and "struct(y" in plan and "struct(z" in plan


def test_chunks_send_no_rows(spark, tmp_path):
    """Rows meet the days of their chunks in a shuffle; a table of days is by estimate larger than a small file of rows."""
    spark.createDataFrame([r for r in long_panel() if None not in r[:3]], SCHEMA + ", time_bucket int").write.parquet(str(tmp_path / "p"))
    made = preprocess.rolling_sigma_clip(spark.read.parquet(str(tmp_path / "p")), ["x"], window=9, chunk_rows=30)
    made.write.format("noop").mode("overwrite").save()
    assert "BroadcastExchange" not in made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_wide_frames_are_rounded_as_narrow_ones(spark):
    from loomstep.plans import queries

    df = spark.range(200).select("id", *(F.when(F.col("id") % 9 != i % 9, F.sin(F.col("id") * i) * F.pow(F.lit(10.0), F.lit(i % 12 - 4))).alias(f"c.{i}") for i in range(queries.WIDE + 2))).toDF("id", *(f"c{i}" for i in range(queries.WIDE + 2)))
    names = df.columns[1:]
    assert queries._round(df, names).dtypes == queries._round(df, names[:3]).select("id", *(F.col(c) for c in names)).dtypes
    assert queries._round(df, names).collect() == df.select("id", *(F.round(c, 6).alias(c) for c in names)).collect()


def test_jobs_do_not_grow_with_cores(spark, tmp_path):
    jobs = []
    for days, core in ((9, 9), (9, 1)):
        df, s, out = small_run(spark, tmp_path / str(core), core=core, days=days)
        spark.sparkContext.setJobGroup(f"cores{core}", "run")
        made = pipeline.run(df, ["r"], ["x"], out, target="r", s=s)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"cores{core}")))
        assert made.count() == 56
    assert jobs[1] <= jobs[0] + 3


def test_dense_blocks(spark, tmp_path):
    """The bytes are those of the matrix in the order of keys, by ranges of rows and as whole files."""
    import numpy as np

    from loomstep.sources import dense

    df = spark.createDataFrame([(s, d, t, None if x is None else x * 1.7, d + 0.5) for s, d, t, x in tiny(12)], SCHEMA + ", z double").withColumn("weight", F.lit(2.0))
    path = str(tmp_path / "m")
    dated.write_matrix(dated.to_matrix(df, ["x", "z"], target="z", weight="weight", low=1, high=12).repartition(4), path)
    meta = dense.write_dense(spark, path, f"{path}.dense")
    rows = sorted((r for r in df.collect() if 1 <= r["date_id"] <= 12), key=lambda r: (r["date_id"], r["time_id"], r["symbol_id"]))
    want = np.array([[np.nan if r["x"] is None else r["x"], r["z"]] for r in rows], np.float32)
    assert meta["n_rows"] == len(rows)
    for low, high in ((0, len(rows)), (3, 17), (len(rows) - 1, len(rows) + 5), (9, 9)):
        got = dense.dense_rows(spark, f"{path}.dense", low, high)
        assert got["X"].tobytes() == want[low:high].tobytes() and got["date"].tolist() == [r["date_id"] for r in rows[low:high]]
    files = dense.export_maps(spark, f"{path}.dense", str(tmp_path / "maps"))
    assert np.memmap(files["X"], np.float32, "r", shape=(len(rows), 2)).tobytes() == want.tobytes()
    assert np.fromfile(files["y"], np.float32).tolist() == want[:, 1].tolist() and set(np.fromfile(files["w"], np.float32)) == {2.0}


def test_real_width(spark):
    """79 features and 9 responders give 3298 columns besides keys, target and weight, as the default settings name them."""
    features, responders = [f"feature_{i:02d}" for i in range(79)], [f"responder_{i}" for i in range(9)]
    moving = [c for c in features if c not in ("feature_09", "feature_10", "feature_11")]
    kinds = "symbol_id int, date_id int, time_id int, weight float, time_bucket byte, " + ", ".join(f"{c} float" for c in [*features, *responders])
    clean = spark.createDataFrame([], kinds)
    parts = [pipeline.stage(clean, name, responders, moving) for name in pipeline.STAGES]
    assert [len(p.columns) - 3 for p in parts] == [270, 119, 1216, 228, 228, 912, 228, 14]
    made = pipeline.panel(clean, [spark.createDataFrame([], p.schema) for p in parts], features, target="responder_6", low=0, high=9)
    assert len(made.columns) == 3298 + 5 and len(set(made.columns)) == len(made.columns)
    assert pipeline.widest(clean.drop("time_bucket"), responders, moving, Settings()) == 1219
