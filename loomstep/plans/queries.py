"""One query for each operator over the event panels, and the same in DuckDB SQL.

Results are rounded to six digits on both sides; features and responders are square roots, so that no exact
value lies on the edge of rounding.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstep import windows
from loomstep.functions.scalar import clip_upper, cyclic_time, sanitize, time_bucket, trend_weights
from loomstep.operators import crossval, daily, history, preprocess, quality, selection, validate, xday
from loomstep.operators.boosting import Binned, fit, write_binned
from loomstep.plans import pipeline
from loomstep.schema import DATE, KEYS, SYMBOL, TIME, free_names
from loomstep.sources.dated import footer_range, read_dated, read_names, read_raw, to_matrix, write_dated, write_matrix
from loomstep.sources.dense import unpacked, write_dense
from loomstep.sources.panels import DAILY_TICKS, duck_panel, event_panel
from loomstep.sources.scratch import delete, scratch_path
from loomstep.sources.settings import Clip, Fill, Settings, StageA, StageB, StageC, Trees

FEATURES, RESPONDERS = ["feature_00", "feature_01"], ["responder_0", "responder_1", "responder_2"]
K = ", ".join(KEYS)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


#: Columns beyond which _round() goes by an array.
WIDE = 32


def _round(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """df with the columns as double, rounded. Many are rounded as one array: written out one by one they make a method too long for the JVM to compile."""
    chosen = [c for c in df.columns if c in columns]
    if len(chosen) <= WIDE:
        return df.select(*(F.round(F.col(c).cast("double"), digits).alias(c) if c in columns else F.col(c) for c in df.columns))
    [held] = free_names(df, "rounded")
    all_of = F.transform(F.array(*(F.col(c).cast("double") for c in chosen)), lambda x: F.round(x, digits))
    rows = df.select(*(c for c in df.columns if c not in columns), all_of.alias(held))
    place = {c: i for i, c in enumerate(chosen)}
    return rows.select(*(F.get(held, F.lit(place[c])).alias(c) if c in place else F.col(c) for c in df.columns))


def _values(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The keys as they are, all else rounded."""
    return _round(df, [c for c in df.columns if c not in keys])


def _r(expression: str, name: str) -> str:
    return f"ROUND(CAST({expression} AS DOUBLE), 6) AS {name}"


def _bucketed(kind: str = "dense") -> str:
    return f"p AS ({duck_panel(kind)}), b AS (SELECT *, CAST(LEAST(time_id * 6 // {DAILY_TICKS}, 5) AS TINYINT) AS time_bucket FROM p)"


def _with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("time_bucket", time_bucket(F.col(TIME), DAILY_TICKS))


_CLIP_W = "WINDOW w AS (PARTITION BY symbol_id, time_bucket ORDER BY date_id, time_id ROWS BETWEEN 480 PRECEDING AND 1 PRECEDING)"


def _clip_sql(x: str) -> str:
    bound = f"LEAST(GREATEST({x}, AVG({x}) OVER w - 3 * STDDEV_SAMP({x}) OVER w), AVG({x}) OVER w + 3 * STDDEV_SAMP({x}) OVER w)"
    return f"CASE WHEN {x} IS NOT NULL AND COUNT({x}) OVER w >= 10 THEN {bound} ELSE {x} END"


def _clip(spark: SparkSession, d: str) -> DataFrame:
    rows = preprocess.rolling_sigma_clip(_with_bucket(event_panel(spark, d)), FEATURES, window=480, k=3.0, min_valid=10)
    return _round(rows.select(*KEYS, "time_bucket", *FEATURES), FEATURES)


#: Short limits, so that every step leaves and fills some values.
FILL = {"open_ticks": (0, 10), "ttl_days_open": 2, "max_gap": 3, "ttl_days_same_tick": 2}
_STEPS = {
    "open": ("symbol_id", "date_id, time_id", "date_id", 2, "time_id >= 0 AND time_id < 10"),
    "intraday": ("symbol_id, date_id", "time_id", "time_id", 3, "TRUE"),
    "same_tick": ("symbol_id, time_id", "date_id", "date_id", 2, "TRUE"),
}


def _fill_sql(source: str, step: str) -> str:
    part, order, at, limit, only = _STEPS[step]
    one = lambda x: (
        f"CASE WHEN {x} IS NULL AND {only} AND {at} - last_value(CASE WHEN {x} IS NOT NULL THEN {at} END IGNORE NULLS) OVER w <= {limit} "
        f"THEN last_value({x} IGNORE NULLS) OVER w ELSE {x} END AS {x}"
    )
    frame = f"WINDOW w AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"SELECT {K}, {', '.join(map(one, FEATURES))} FROM {source} {frame}"


def _filled(steps: list[str], tail: str = "SELECT {k}, {x} FROM {last}") -> str:
    parts, last = [f"p AS ({duck_panel('gappy')})"], "p"
    for i, step in enumerate(steps):
        parts.append(f"s{i} AS ({_fill_sql(last, step)})")
        last = f"s{i}"
    return f"WITH {', '.join(parts)} " + tail.format(k=K, x=", ".join(_r(x, x) for x in FEATURES), last=last)


def _gappy(spark: SparkSession, d: str) -> DataFrame:
    return event_panel(spark, d, "gappy").select(*KEYS, *FEATURES)


# --- Stage A --------------------------------------------------------------------------------------------------

TAILS, DIFFS, ROLL = (1, 3), (1,), (3,)


def _daily_sql() -> str:
    """The daily table before and after its values move on by a day; a: per day, e: with what is derived, f: moved."""
    ends = []
    for c in RESPONDERS:
        ends += [f"max(CASE WHEN n = {k} THEN {c} END) AS {c}_tail{k}" for k in (1, 2, 3)]
        ends += [f"max(CASE WHEN n = 1 THEN {c} END) AS {c}_close", f"AVG({c}) AS {c}_mean", f"STDDEV_SAMP({c}) AS {c}_std"]
    derived, names = [], []
    for c in RESPONDERS:
        before = f"CASE WHEN gap = 1 THEN lag({c}_close) OVER o END"
        own = {f"{c}_prev_tail_lag{k}": f"{c}_tail{k}" for k in (1, 2, 3)} | {f"{c}_prevday_{n}": f"{c}_{n}" for n in ("close", "mean", "std")}
        own |= {f"{c}_prev_tail_d1": f"{c}_tail1 - {c}_tail2", f"{c}_prev2day_close": before, f"{c}_overnight_gap": f"{c}_close - ({before})"}
        own |= {f"{c}_prevday_close_minus_mean": f"{c}_close - {c}_mean"}
        own |= {f"{c}_close_roll3_mean": f"AVG({c}_close) OVER t", f"{c}_close_roll3_std": f"STDDEV_SAMP({c}_close) OVER t"}
        derived += [f"{e} AS {n}" for n, e in own.items()]
        names += own
    moved = ", ".join(f"CASE WHEN gap = 1 THEN lag({n}) OVER o END AS {n}" for n in names)
    return f"""p AS ({duck_panel("gappy")}),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol_id, date_id ORDER BY time_id DESC) AS n FROM p),
a AS (SELECT symbol_id, date_id, {", ".join(ends)} FROM r GROUP BY symbol_id, date_id),
g AS (SELECT *, coalesce(date_id - lag(date_id) OVER (PARTITION BY symbol_id ORDER BY date_id), 1) AS gap FROM a),
s AS (SELECT *, CAST(sum(CAST(gap <> 1 AS INT)) OVER (PARTITION BY symbol_id ORDER BY date_id) AS INT) AS streak FROM g),
e AS (SELECT symbol_id, date_id, gap, {", ".join(derived)} FROM s WINDOW o AS (PARTITION BY symbol_id ORDER BY date_id),
  t AS (PARTITION BY symbol_id, streak ORDER BY date_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
f AS (SELECT symbol_id, date_id, {moved} FROM e WINDOW o AS (PARTITION BY symbol_id ORDER BY date_id))"""


def _daily_names(wanted: str) -> list[str]:
    return [n for n in _names_a() if wanted in n]


def _names_a() -> list[str]:
    kinds = ["prev_tail_lag1", "prev_tail_lag2", "prev_tail_lag3", "prevday_close", "prevday_mean", "prevday_std", "prev_tail_d1"]
    kinds += ["prev2day_close", "overnight_gap", "prevday_close_minus_mean", "close_roll3_mean", "close_roll3_std"]
    return [f"{c}_{n}" for c in RESPONDERS for n in kinds]


def _daily(wanted: str) -> Query:
    names, day = _daily_names(wanted), (SYMBOL, DATE)

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = daily.daily_features(event_panel(spark, d, "gappy"), RESPONDERS, lags=TAILS, diffs=DIFFS, rolling=ROLL, cast="double")
        return _values(rows.select(*day, *names), day)

    return Query(run, f"WITH {_daily_sql()} SELECT symbol_id, date_id, {', '.join(_r(n, n) for n in names)} FROM f")


def _stage_a(spark: SparkSession, d: str) -> DataFrame:
    rows = daily.stage_a(event_panel(spark, d, "gappy"), RESPONDERS, lags=TAILS, diffs=DIFFS, rolling=ROLL, cast="double")
    return _values(rows.select(*KEYS, *_names_a()))


# --- Stage B --------------------------------------------------------------------------------------------------

LAGS = (1, 2, 4)


def _stage_b_sql(kind: str = "dense") -> str:
    w, n = trend_weights(len(LAGS)), len(LAGS)
    value = lambda c, k: f"CASE WHEN date_id - lag(date_id, {k}) OVER w = {k} THEN lag({c}, {k}) OVER w END AS {c}_same_t_prev{k}"
    first = ", ".join(value(c, k) for c in RESPONDERS for k in LAGS)
    stat, last = [], []
    for c in RESPONDERS:
        past = ", ".join(f"{c}_same_t_prev{k}" for k in LAGS)
        stat += [f"list_filter([{past}], lambda x: x IS NOT NULL) AS {c}_l"]
        last += [f"list_avg({c}_l) AS {c}_same_t_last{n}_mean", f"CASE WHEN len({c}_l) > 1 THEN list_stddev_samp({c}_l) END AS {c}_same_t_last{n}_std"]
        terms = " + ".join(
            f"coalesce({x} * (({c}_same_t_prev{k} - list_avg({c}_l)) / (CASE WHEN len({c}_l) > 1 THEN list_stddev_samp({c}_l) END + 1e-9)), 0)"
            for x, k in zip(w, LAGS, strict=True)
        )
        last += [f"({terms}) / greatest(len({c}_l), 1) AS {c}_same_t_last{n}_slope"]
    near = ", ".join(f"{c}_same_t_prev1" for c in RESPONDERS)
    stat += [f"list_filter([{near}], lambda x: x IS NOT NULL) AS near"]
    last += ["list_avg(near) AS prev1_same_t_mean_3rep", "CASE WHEN len(near) > 1 THEN list_stddev_samp(near) END AS prev1_same_t_std_3rep"]
    return f"""p AS ({duck_panel(kind)}),
q AS (SELECT {K}, {first} FROM p WINDOW w AS (PARTITION BY symbol_id, time_id ORDER BY date_id)),
u AS (SELECT *, {", ".join(stat)} FROM q), v AS (SELECT *, {", ".join(last)} FROM u)"""


def _names_b() -> list[str]:
    n = len(LAGS)
    each = [f"same_t_prev{k}" for k in LAGS] + [f"same_t_last{n}_{x}" for x in ("mean", "std", "slope")]
    return [f"{c}_{x}" for c in RESPONDERS for x in each] + ["prev1_same_t_mean_3rep", "prev1_same_t_std_3rep"]


def _b(wanted: str, kind: str = "dense") -> Query:
    names = [n for n in _names_b() if wanted in n]

    def run(spark: SparkSession, d: str) -> DataFrame:
        return _values(xday.stage_b(event_panel(spark, d, kind), RESPONDERS, lags=LAGS, cast="double").select(*KEYS, *names))

    return Query(run, f"WITH {_stage_b_sql(kind)} SELECT {K}, {', '.join(_r(n, n) for n in names)} FROM v")


# --- Stage C --------------------------------------------------------------------------------------------------

_STREAK = f"""p AS ({duck_panel("gappy")}),
h AS (SELECT *, date_id - lag(date_id) OVER (PARTITION BY symbol_id ORDER BY date_id, time_id) AS gap FROM p),
c AS (SELECT *, CAST(sum(CAST(coalesce(gap, 0) > 1 AS INT)) OVER (PARTITION BY symbol_id ORDER BY date_id, time_id) AS INT) AS streak FROM h)"""
_RUN = "WINDOW w AS (PARTITION BY symbol_id, streak ORDER BY date_id, time_id), v AS (PARTITION BY symbol_id, streak ORDER BY date_id, time_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
C = {"lags": (1, 3), "returns": (1,), "diffs": (2,), "rz": (5,), "spans": (10,)}


def _z(x: str) -> str:
    return f"CASE WHEN STDDEV_SAMP({x}) OVER v > 1e-9 THEN ({x} - AVG({x}) OVER v) / (STDDEV_SAMP({x}) OVER v + 1e-9) END"


def _c_parts(x: str) -> dict[str, dict[str, str]]:
    past = f"lag({x}, 1) OVER w"
    return {
        "lags": {f"{x}__lag{k}": f"lag({x}, {k}) OVER w" for k in C["lags"]},
        "ret": {f"{x}__ret1": f"CASE WHEN abs({past}) > 1e-12 AND {x} IS NOT NULL THEN LEAST(GREATEST({x} / ({past}) - 1, -10), 10) END"},
        "diff": {f"{x}__diff2": f"{x} - lag({x}, 2) OVER w"},
        "rmean": {f"{x}__rmean5": f"AVG({x}) OVER v"},
        "rstd": {f"{x}__rstd5": f"STDDEV_SAMP({x}) OVER v"},
        "rz": {f"{x}__rz5": _z(x)},
    }


def _c(part: str, group: str | None = None) -> Query:
    names = {n: e for x in FEATURES for n, e in _c_parts(x)[part].items()}

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = history.stage_c(_gappy(spark, d), FEATURES, **C, groups=(group or part,), cast="double")
        return _values(rows.select(*KEYS, *names))

    return Query(run, f"WITH {_STREAK} SELECT {K}, {', '.join(_r(e, n) for n, e in names.items())} FROM c {_RUN}")


_EWM = f"""
SELECT {K}, {{}} FROM (SELECT {K}, {", ".join(f"list(coalesce({x}, 0.0)) OVER (PARTITION BY symbol_id, streak ORDER BY date_id, time_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {x}" for x in FEATURES)} FROM c)"""
_EWM_VALUE = "list_reduce({x}, lambda a, b: a * (1 - 2.0 / 11) + b * (2.0 / 11))"


def _ewm(spark: SparkSession, d: str) -> DataFrame:
    return _values(history.ewm(preprocess.zero_fill(_gappy(spark, d), FEATURES), FEATURES, [10], "double"))


_RANK_SQL = """CASE WHEN {x} IS NULL THEN NULL WHEN count({x}) OVER s > 1 THEN
  (rank() OVER (PARTITION BY date_id, time_id ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY date_id, time_id, {x}) - 1) / 2.0 - 0.5) / count({x}) OVER s ELSE 0.5 END"""
_SECTION = "WINDOW s AS (PARTITION BY date_id, time_id)"


def _section(column: Callable[[str], Column], suffix: str, sql: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _values(event_panel(spark, d).select(*KEYS, *(column(x).alias(f"{x}__{suffix}") for x in FEATURES)))

    return Query(run, f"WITH p AS ({duck_panel()}) SELECT {K}, {', '.join(_r(sql.format(x=x), f'{x}__{suffix}') for x in FEATURES)} FROM p {_SECTION}")


_CS_Z = "CASE WHEN STDDEV_SAMP({x}) OVER s > 1e-9 THEN ({x} - AVG({x}) OVER s) / (STDDEV_SAMP({x}) OVER s + 1e-9) END"


def _stage_c(spark: SparkSession, d: str) -> DataFrame:
    rows = preprocess.zero_fill(_gappy(spark, d), FEATURES)
    return _values(history.stage_c(rows, FEATURES, **C, cross=["feature_00"], cast="double"))


def _stage_c_sql() -> str:
    zero = ", ".join(f"coalesce({x}, 0.0) AS {x}" for x in FEATURES)
    names = {n: e for x in FEATURES for p in _c_parts(x).values() for n, e in p.items()}
    section = {"feature_00__cs_z": _CS_Z.format(x="feature_00"), "feature_00__csrank": _RANK_SQL.format(x="feature_00")}
    lists = {f"{x}__ewm10": f"list({x}) OVER (PARTITION BY symbol_id, streak ORDER BY date_id, time_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)" for x in FEATURES}
    first = ", ".join(f"{e} AS {n}" for n, e in (names | section | lists).items())
    last = [_r(n, n) for n in (names | section)] + [_r(_EWM_VALUE.format(x=n), n) for n in lists]
    streak = _STREAK.replace("c AS (SELECT *,", "c AS (SELECT * REPLACE (" + zero + "),")
    return f"WITH {streak}, x AS (SELECT {K}, {first} FROM c {_RUN}, s AS (PARTITION BY date_id, time_id)) SELECT {K}, {', '.join(last)} FROM x"


# --- Panel, quality, validation -------------------------------------------------------------------------------


def _padded(spark: SparkSession, d: str) -> DataFrame:
    """Stage B on cores of 5 days, each made from a range padded by 5 days, all in one plan."""
    rows = event_panel(spark, d)
    days = [r[0] for r in quality.distinct_days(rows).orderBy(DATE).collect()]
    make = lambda x: xday.stage_b(x, RESPONDERS, lags=LAGS, cast="double")
    cores = pipeline.padded_cores(days, 5, 5)
    return _values(pipeline.on_cores(rows, cores, make) if cores else make(rows.limit(0)))


def _stitched(spark: SparkSession, d: str) -> DataFrame:
    rows = _with_bucket(event_panel(spark, d))
    parts = [xday.stage_b(rows, ["responder_0"], lags=(1,), stats_columns=[], across=False, cast="double"), history.stage_c(rows, ["feature_00"], lags=(1,), cast="double", groups=("lags",))]
    days = validate.date_range(rows).first()
    made = pipeline.panel(rows, parts, FEATURES, target="responder_1", low=days["min_date"], high=days["max_date"], daily_ticks=DAILY_TICKS)
    return _round(made, [c for c in made.columns if c not in (*KEYS, "time_bucket")], 4)


_RUN_S = Settings(
    daily_ticks=DAILY_TICKS, pad_days=5, core_days=13, clip=Clip(480, 3.0, 1, 10), fill=Fill(**FILL), a=StageA(TAILS, DIFFS, ROLL, "double"),
    b=StageB(LAGS, cast="double"), c=StageC(**C, cross=("feature_00",), cast="double"),
)


def _whole_run(spark: SparkSession, d: str) -> DataFrame:
    """Raw to clean to stages A, B and six groups of C to panel, each written, checked and read back; two padded cores."""
    out = scratch_path(spark, "panel_run")
    made = pipeline.run(event_panel(spark, d), RESPONDERS, FEATURES, out, target="responder_0", s=_RUN_S)
    for part in ("clean", "stages"):
        delete(spark, f"{out}/{part}")
    return _values(made, (*KEYS, "time_bucket"))


def _clean_sql(kind: str, raw: str) -> str:
    """From p, the raw panel, to s3, whose features are clipped and imputed."""
    return (
        f"{_bucketed(kind)}, o AS (SELECT {K}, {', '.join(f'{_clip_sql(x)} AS {x}' for x in FEATURES)} FROM b {_CLIP_W}), "
        f"s0 AS ({_fill_sql('o', 'open')}), s1 AS ({_fill_sql('s0', 'intraday')}), s2 AS ({_fill_sql('s1', 'same_tick')}), s3 AS ({_fill_sql('s2', 'intraday')})"
    ).replace("p AS (", f"{raw} AS (", 1).replace("FROM p)", f"FROM {raw})")


def _whole_run_sql() -> str:
    """Cores are told apart by keys that are moved by 1000 for each, so that windows over keys stay within a core."""
    stage_a = _daily_sql().replace(f"p AS ({duck_panel('gappy')}),\n", "")
    stage_b = _stage_b_sql().replace(f"p AS ({duck_panel()}),\n", "")
    streak = _STREAK.replace(f"p AS ({duck_panel('gappy')}),\n", "")
    names = {n: e for x in FEATURES for p in _c_parts(x).values() for n, e in p.items()}
    section = {"feature_00__cs_z": _CS_Z.format(x="feature_00"), "feature_00__csrank": _RANK_SQL.format(x="feature_00")}
    lists = {f"{x}__ewm10": f"list({x}) OVER (PARTITION BY symbol_id, streak ORDER BY date_id, time_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)" for x in FEATURES}
    first = ", ".join(f"{e} AS {n}" for n, e in (names | section | lists).items())
    last = [_r(f"x.{n}", n) for n in (names | section)] + [_r(_EWM_VALUE.format(x=f"x.{n}"), n) for n in lists]
    zero = ", ".join(f"coalesce(s3.{x}, 0.0) AS {x}" for x in FEATURES)
    own = ["responder_0", "weight", *FEATURES]
    return f"""WITH {_clean_sql("dense", "raw")},
w AS (SELECT b.* REPLACE ({zero}) FROM b JOIN s3 USING ({K})),
i AS (SELECT date_id, row_number() OVER (ORDER BY date_id) - 1 AS n FROM (SELECT DISTINCT date_id FROM w)),
k AS (SELECT l.n // 13 + 1 AS k, f.date_id AS read_from, l.date_id AS low, (SELECT max(h.date_id) FROM i h WHERE h.n < l.n + 13) AS high FROM i l JOIN i f ON f.n = l.n - 5 WHERE (l.n - 5) % 13 = 0),
p AS (SELECT w.* REPLACE (CAST(symbol_id + 1000 * k AS INT) AS symbol_id, CAST(date_id + 1000 * k AS INT) AS date_id), k, low, high FROM w JOIN k ON date_id BETWEEN read_from AND high),
{stage_a}, {stage_b}, {streak}, x AS (SELECT {K}, {first} FROM c {_RUN}, s AS (PARTITION BY date_id, time_id))
SELECT CAST(p.symbol_id - 1000 * k AS INT) AS symbol_id, CAST(p.date_id - 1000 * k AS INT) AS date_id, p.time_id, p.time_bucket, {", ".join(_r(f"p.{c}", c) for c in own)},
  {", ".join(_r(e.replace("time_id", "p.time_id"), n) for n, e in _TIME_SQL.items())}, {", ".join(_r(f"f.{n}", n) for n in _names_a())}, {", ".join(_r(f"v.{n}", n) for n in _names_b())}, {", ".join(last)}
FROM p LEFT JOIN f USING (symbol_id, date_id) LEFT JOIN v USING ({K}) LEFT JOIN x USING ({K}) WHERE p.date_id - 1000 * k BETWEEN low AND high"""


def _r4(expression: str, name: str) -> str:
    return f"ROUND(CAST({expression} AS DOUBLE), 4) AS {name}"


_TIME_SQL = {
    "time_pos": "CAST(time_id AS FLOAT)",
    "time_sin": f"CAST(sin(time_id * (2 * pi() / {DAILY_TICKS})) AS FLOAT)",
    "time_cos": f"CAST(cos(time_id * (2 * pi() / {DAILY_TICKS})) AS FLOAT)",
}
_STITCH_SQL = f"""WITH {_bucketed()},
x AS (SELECT *, lag(date_id) OVER t AS d1, lag(responder_0) OVER t AS r1 FROM b WINDOW t AS (PARTITION BY symbol_id, time_id ORDER BY date_id)),
h AS (SELECT *, date_id - lag(date_id) OVER (PARTITION BY symbol_id ORDER BY date_id, time_id) AS gap FROM x),
c AS (SELECT *, sum(CAST(coalesce(gap, 0) > 1 AS INT)) OVER (PARTITION BY symbol_id ORDER BY date_id, time_id) AS streak FROM h),
f AS (SELECT *, lag(feature_00) OVER (PARTITION BY symbol_id, streak ORDER BY date_id, time_id) AS l1 FROM c)
SELECT {K}, time_bucket, {", ".join(_r4(c, c) for c in ("responder_1", "weight", *FEATURES))}, {", ".join(_r4(e, n) for n, e in _TIME_SQL.items())},
  {_r4("CASE WHEN date_id - d1 = 1 THEN r1 END", "responder_0_same_t_prev1")}, {_r4("l1", "feature_00__lag1")} FROM f"""


def _pruned(spark: SparkSession, d: str) -> DataFrame:
    """Days 9 to 18 of a dataset written in blocks of 7 days: two of its five folders are read."""
    path = scratch_path(spark, "dated")
    write_dated(event_panel(spark, d), path, days=7)
    return _values(read_dated(spark, path, 9, 18, days=7).select(*KEYS, "feature_00"))


def _raw_scan(spark: SparkSession, d: str) -> DataFrame:
    """Ticks from folders partition_id=*, one for each week, from day 8 on."""
    path = scratch_path(spark, "raw")
    event_panel(spark, d).withColumn("partition_id", F.floor(F.col(DATE) / 7).cast("int")).write.partitionBy("partition_id").parquet(path)
    return read_raw(spark, path, 8).select(*KEYS, "partition_id")


def _monotone(spark: SparkSession, d: str) -> DataFrame:
    rows = validate.read_in_order(spark, f"{d}/events.parquet")
    rows = rows.select("file", "row", F.expr("datediff(CAST(ts AS DATE), DATE '2024-01-01')").alias(DATE), F.col("user_id").alias(TIME))
    return validate.order_breaks(rows).select("date_breaks", "time_breaks")


def _matrix_order(spark: SparkSession, d: str) -> DataFrame:
    """Order of time within and across files of events, 300 ids in each."""
    rows = spark.read.parquet(f"{d}/events.parquet")
    day = F.expr("datediff(CAST(ts AS DATE), DATE '2024-01-01')")
    return validate.order_breaks(rows.select(F.expr("event_id div 300").alias("file"), F.col("event_id").alias("row"), day.alias(DATE), (F.col("user_id") % 50).alias(TIME)), stretch=70)


def _written_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Order of a matrix as it was written, file after file, and its rows and dates from the files' own statistics."""
    path = scratch_path(spark, "matrix")
    try:
        write_matrix(to_matrix(event_panel(spark, d), FEATURES, target="responder_0", weight="weight", low=0, high=10**9), path)
        found = validate.order_breaks(validate.read_in_order(spark, path)).first()
        dates = footer_range(spark, path).first()
    finally:
        delete(spark, path)
        delete(spark, f"{path}.manifest")
    return spark.createDataFrame([(*found, dates["min_date"], dates["max_date"])], "n_rows long, date_breaks long, time_breaks long, file_breaks long, min_date int, max_date int")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    """The matrix written, packed to dense blocks, and its rows by place as they are unpacked again."""
    path = scratch_path(spark, "matrix")
    try:
        write_matrix(to_matrix(event_panel(spark, d), FEATURES, target="responder_0", weight="weight", low=0, high=10**9), path)
        write_dense(spark, path, f"{path}.dense")
    finally:
        delete(spark, path)
        delete(spark, f"{path}.manifest")
    return _round(unpacked(spark, f"{path}.dense"), ["y", "w", *FEATURES], 3)


def _folds(spark: SparkSession, d: str) -> DataFrame:
    return crossval.fold_table(event_panel(spark, d), 2, 2, 4)


_FOLDS_SQL = """n AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS n FROM events), v AS (SELECT n, (n - 2) // 6 AS s, (n - 2) % 6 AS m FROM n),
k AS (SELECT CAST(unnest(range(1, 3)) AS INT) AS fold, n, s, m FROM v),
a AS (SELECT fold, n, s, 4 * s + 2 + (fold - 1) * s + least(fold - 1, m) AS lo, s + CAST(fold <= m AS INT) AS size FROM k),
folds AS (SELECT fold, CAST(lo - 2 - 4 * s AS INT) AS tr_lo, CAST(lo - 2 AS INT) AS tr_hi, CAST(lo AS INT) AS va_lo, CAST(lo + size AS INT) AS va_hi FROM a WHERE s > 0 AND lo + size <= n)"""


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    rows = event_panel(spark, d)
    return crossval.assign_folds(rows.select(*KEYS), crossval.fold_table(rows, 2, 2, 4)).select(*KEYS, "fold", "part")


def _wr2(spark: SparkSession, d: str) -> DataFrame:
    rows = event_panel(spark, d).withColumn("guess", F.col("responder_0") * 0.5 + 0.1)
    return _round(crossval.weighted_r2(rows, "responder_0", "guess", "weight", [SYMBOL]), ["wr2"])


def _importance(spark: SparkSession, d: str) -> DataFrame:
    """Share of each column in the absolute correlation with the target: a stand-in score to rank by."""
    names = [*FEATURES, "responder_1", "responder_2"]
    rows = event_panel(spark, d).agg(*(F.abs(F.corr(c, "responder_0")).alias(c) for c in names)).withColumn("k", F.lit(0))
    return rows.unpivot("k", names, "feature", "gain_share").drop("k")


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    rows = event_panel(spark, d)
    days = validate.date_range(rows).first()
    rows = to_matrix(rows, FEATURES, target="responder_0", weight="weight", low=days["min_date"], high=days["max_date"])
    return _round(rows, ["y", "w", *FEATURES], 3)


TREES = Trees(rounds=3, patience=3, rate=0.3, leaves=6, depth=3, min_rows=5, min_weight=0.0, l1=0.1, l2=1.0, feature_fraction=1.0, bag_fraction=0.8, bag_every=1)


def _with_binned(spark: SparkSession, d: str, make: Callable[[Binned, DataFrame], DataFrame]) -> DataFrame:
    """make() over the event panel's binned features, which are deleted afterwards, and two folds."""
    rows, path = event_panel(spark, d), scratch_path(spark, "binned")
    try:
        binned = write_binned(rows, [*FEATURES, "responder_1"], path, y="responder_0", weight="weight")
        return make(binned, crossval.fold_table(rows, 2, 2, 4))
    finally:
        delete(spark, path)


def _selected(spark: SparkSession, d: str) -> DataFrame:
    """feature_01 and the best other feature by gain share, as the file of names has them."""
    names = scratch_path(spark, "names")
    _with_binned(spark, d, lambda b, folds: selection.select_features(b, folds, names, k=1, always=["feature_01"], trees=TREES))
    found = read_names(spark, names)
    delete(spark, names)
    return spark.createDataFrame(list(enumerate(found, 1)), "rank int, feature string")


def _searched(spark: SparkSession, d: str) -> DataFrame:
    space = {"leaves": (2, 6), "rate": (0.1, 0.3), "l2": (0.0, 20.0)}
    return _with_binned(spark, d, lambda b, folds: selection.search_parameters(b, folds, space=space, trials=4, first=3, trees=TREES))


def _stump_panel(spark: SparkSession, d: str) -> DataFrame:
    """Features of few values, one with nulls, so that each value is a code of its own."""
    rows = event_panel(spark, d)
    coarse = F.when(F.col("feature_01").isNotNull(), F.least(F.floor(F.col("feature_01") / 3), F.lit(4)))
    return rows.select(*KEYS, "weight", "responder_0", F.floor("responder_1").cast("double").alias("s"), coarse.cast("double").alias("f"), SYMBOL)


def _stump(spark: SparkSession, d: str) -> DataFrame:
    """The one split of the first tree: its feature, threshold, side of nulls, gain, and what its leaves and the base predict."""
    path = scratch_path(spark, "binned")
    try:
        binned = write_binned(_stump_panel(spark, d).toDF(*KEYS, "weight", "responder_0", "s", "f", "k"), ["s", "f", "k"], path, y="responder_0", weight="weight")
        p = replace(TREES, rounds=1, leaves=2, rate=1.0, l1=2.0, l2=3.0, min_rows=10, bag_fraction=1.0)
        model = fit(binned, binned.rows.withColumn("valid", F.lit(False)), p)
    finally:
        delete(spark, path)
    t = model.trees[0]
    row = (binned.features[t.feature[0]], binned.edges[t.feature[0]][t.code[0] - 1], t.null_left[0], round(t.gain[0], 6), round(model.base, 6), round(t.value[t.left[0]], 6), round(t.value[t.right[0]], 6))
    return spark.createDataFrame([row], "feature string, threshold double, null_left boolean, gain double, base double, low double, high double")


_STUMP_SQL = f"""WITH p AS ({duck_panel()}), m AS (SELECT sum(weight * responder_0) / sum(weight) AS base FROM p),
x AS (SELECT unnest(['s', 'f', 'k']) AS feature, unnest([floor(responder_1), CASE WHEN feature_01 IS NOT NULL THEN least(floor(feature_01 / 3), 4) END, CAST(symbol_id AS DOUBLE)]) AS v, weight AS w, weight * (base - responder_0) AS g FROM p, m),
t AS (SELECT feature, sum(g) AS g, sum(w) AS h, count(*) AS n, coalesce(sum(g) FILTER (v IS NULL), 0) AS g0, coalesce(sum(w) FILTER (v IS NULL), 0) AS h0, count(*) FILTER (v IS NULL) AS n0 FROM x GROUP BY feature),
c AS (SELECT feature, v, sum(sum(g)) OVER o AS g, sum(sum(w)) OVER o AS h, sum(count(*)) OVER o AS n FROM x WHERE v IS NOT NULL GROUP BY feature, v WINDOW o AS (PARTITION BY feature ORDER BY v)),
s AS (SELECT c.feature, v, nl, c.g + nl * g0 AS gl, c.h + nl * h0 AS hl, c.n + nl * n0 AS nn, t.g, t.h, t.n FROM c JOIN t USING (feature), (SELECT unnest([0, 1]) AS nl) WHERE nl = 0 OR n0 > 0),
q AS (SELECT *, sign(gl) * greatest(abs(gl) - 2, 0) AS kl, sign(g - gl) * greatest(abs(g - gl) - 2, 0) AS kr, sign(g) * greatest(abs(g) - 2, 0) AS k FROM s WHERE nn >= 10 AND n - nn >= 10),
r AS (SELECT *, kl ** 2 / (hl + 3) + kr ** 2 / (h - hl + 3) - k ** 2 / (h + 3) AS gain FROM q)
SELECT feature, v AS threshold, nl = 1 AS null_left, ROUND(gain, 6) AS gain, ROUND((SELECT base FROM m), 6) AS base, ROUND(-kl / (hl + 3), 6) AS low, ROUND(-kr / (h - hl + 3), 6) AS high FROM r ORDER BY gain DESC LIMIT 1"""


_P, _G = f"WITH p AS ({duck_panel()})", f"WITH p AS ({duck_panel('gappy')})"
_EACH_NULL = [f"{x}_null_frac" for x in FEATURES]
_FRAC_SQL = f"SELECT date_id, {', '.join(_r(f'AVG(CAST({x} IS NULL AS DOUBLE))', f'{x}_null_frac') for x in FEATURES)} FROM p GROUP BY date_id"
_LONG_SQL = " UNION ALL ".join(f"SELECT date_id, '{x}' AS feature, {_r(f'AVG(CAST({x} IS NULL AS DOUBLE))', 'null_frac')} FROM p GROUP BY date_id" for x in FEATURES)


def _pivot(spark: SparkSession, d: str) -> DataFrame:
    rows = event_panel(spark, d)
    days = [r[0] for r in quality.distinct_days(rows).orderBy(DATE).collect()]
    return _values(quality.null_fractions_pivot(rows, FEATURES, days), ("feature",))


def _dups(spark: SparkSession, d: str) -> DataFrame:
    """Keys with the tick cut to hours of ticks, so that some repeat."""
    return quality.duplicate_keys(event_panel(spark, d).withColumn(TIME, F.floor(F.col(TIME) / 16).cast("int")))


QUERIES: dict[str, Query] = {
    "time_bucket": Query(lambda s, d: _with_bucket(event_panel(s, d)).select(*KEYS, "time_bucket"), f"WITH {_bucketed()} SELECT {K}, time_bucket FROM b"),
    "sanitize": Query(
        lambda s, d: _values(event_panel(s, d).select(*KEYS, sanitize(F.when(F.col("feature_00") > 100, F.lit(float("inf"))).when(F.col("feature_00") < 5, F.lit(float("nan"))).otherwise(F.col("feature_00"))).alias("feature_00"))),
        f"{_P} SELECT {K}, {_r('CASE WHEN feature_00 > 100 OR feature_00 < 5 THEN NULL ELSE feature_00 END', 'feature_00')} FROM p",
    ),
    "clip_upper": Query(
        lambda s, d: _values(event_panel(s, d).select(*KEYS, clip_upper(F.col("feature_00"), F.lit(50.0)).alias("feature_00"))),
        f"{_P} SELECT {K}, {_r('CASE WHEN feature_00 > 50 THEN 50 ELSE feature_00 END', 'feature_00')} FROM p",
    ),
    "rolling_sigma_clip": Query(_clip, f"WITH {_bucketed()} SELECT {K}, time_bucket, {', '.join(_r(_clip_sql(x), x) for x in FEATURES)} FROM b {_CLIP_W}"),
    "impute_open": Query(lambda s, d: _values(preprocess.impute_open(_gappy(s, d), FEATURES, ttl_days=2)), _filled(["open"])),
    "impute_intraday": Query(lambda s, d: _values(preprocess.impute_intraday(_gappy(s, d), FEATURES, max_gap=3)), _filled(["intraday"])),
    "impute_same_tick": Query(lambda s, d: _values(preprocess.impute_same_tick(_gappy(s, d), FEATURES, ttl_days=2)), _filled(["same_tick"])),
    "impute_full": Query(lambda s, d: _values(preprocess.causal_impute(_gappy(s, d), FEATURES, **FILL)), _filled(["open", "intraday", "same_tick", "intraday"])),
    "zero_fill": Query(lambda s, d: _values(preprocess.zero_fill(_gappy(s, d), FEATURES)), f"{_G} SELECT {K}, {', '.join(_r(f'coalesce({x}, 0)', x) for x in FEATURES)} FROM p"),
    "clean_panel": Query(
        lambda s, d: _values(pipeline.clean_panel(event_panel(s, d, "gappy"), FEATURES, _RUN_S).select(*KEYS, *FEATURES)),
        f"WITH {_clean_sql('gappy', 'p')} SELECT {K}, {', '.join(_r(f'coalesce({x}, 0)', x) for x in FEATURES)} FROM s3",
    ),
    "panel_run": Query(_whole_run, _whole_run_sql()),
    "daily_tail_lags": _daily("_prev_tail_"),
    "daily_close_stats": _daily("_prevday_"),
    "daily_overnight_gap": _daily("_overnight_gap"),
    "daily_segmented_roll": _daily("_roll3_"),
    "daily_gap_streak": Query(
        lambda s, d: daily.day_streaks(event_panel(s, d, "gappy").select(SYMBOL, DATE).distinct()),
        f"WITH {_daily_sql()} SELECT symbol_id, date_id, gap, streak FROM s",
    ),
    "stage_a": Query(_stage_a, f"WITH {_daily_sql()} SELECT {K}, {', '.join(_r(n, n) for n in _names_a())} FROM p LEFT JOIN f USING (symbol_id, date_id)"),
    "same_tick_prev": _b("_prev", "gappy"),
    "same_tick_stats": _b("last3_"),
    "same_tick_slope": _b("_slope", "gappy"),
    "cross_responder_prev1": _b("rep"),
    "stage_b": _b(""),
    "tick_streak": Query(lambda s, d: history.tick_streaks(event_panel(s, d, "gappy")).select(*KEYS, "streak"), f"WITH {_STREAK} SELECT {K}, streak FROM c"),
    "hist_lag": _c("lags"),
    "hist_diff": _c("diff"),
    "hist_ret": _c("ret"),
    "hist_roll_mean": _c("rmean", "rz"),
    "hist_roll_std": _c("rstd", "rz"),
    "hist_rz": _c("rz"),
    "hist_ewm": Query(_ewm, f"WITH {_STREAK} " + _EWM.format(", ".join(_r(_EWM_VALUE.format(x=x), f"{x}__ewm10") for x in FEATURES))),
    "cs_z": _section(history.cross_section_z, "cs_z", _CS_Z),
    "cs_rank": _section(history.cross_section_rank, "csrank", _RANK_SQL),
    "stage_c": Query(_stage_c, _stage_c_sql()),
    "time_features": Query(
        lambda s, d: _round(event_panel(s, d).select(*KEYS, *(e.alias(n) for n, e in cyclic_time(F.col(TIME), DAILY_TICKS).items())), list(_TIME_SQL), 4),
        f"{_P} SELECT {K}, {', '.join(_r4(e, n) for n, e in _TIME_SQL.items())} FROM p",
    ),
    "panel_stitch": Query(_stitched, _STITCH_SQL),
    "date_block_prune": Query(_pruned, f"{_P} SELECT {K}, {_r('feature_00', 'feature_00')} FROM p WHERE date_id BETWEEN 9 AND 18"),
    "raw_scan": Query(_raw_scan, f"{_P} SELECT {K}, CAST(date_id // 7 AS INT) AS partition_id FROM p WHERE date_id >= 8"),
    "padded_core": Query(_padded, f"WITH {_stage_b_sql()} SELECT {K}, {', '.join(_r(n, n) for n in _names_b())} FROM v WHERE date_id >= 5"),
    "distinct_days": Query(lambda s, d: quality.distinct_days(event_panel(s, d)), f"{_P} SELECT DISTINCT date_id FROM p"),
    "dup_keys": Query(_dups, f"{_P} SELECT symbol_id, date_id, CAST(time_id // 16 AS INT) AS time_id, count(*) AS n FROM p GROUP BY ALL HAVING count(*) > 1"),
    "date_gaps": Query(
        lambda s, d: quality.date_gaps(event_panel(s, d, "gappy")),
        f"""{_G}, d AS (SELECT DISTINCT symbol_id, date_id FROM p), g AS (SELECT *, CAST(date_id - lag(date_id) OVER (PARTITION BY symbol_id ORDER BY date_id) AS BIGINT) AS gap FROM d)
SELECT symbol_id, count(*) AS n_gaps, max(gap) AS max_gap, min(gap) AS min_gap, CAST(sum(gap) - 1 AS BIGINT) AS total_missing_dates, CAST(sum(gap - 1) AS BIGINT) AS missing_dates FROM g WHERE gap > 1 GROUP BY symbol_id""",
    ),
    "null_counts": Query(lambda s, d: quality.null_counts(event_panel(s, d), FEATURES), f"{_P} SELECT {', '.join(f'count(*) - count({x}) AS {x}' for x in FEATURES)} FROM p"),
    "null_frac_daily": Query(lambda s, d: _round(quality.null_fractions(event_panel(s, d), FEATURES), _EACH_NULL), f"{_P} {_FRAC_SQL}"),
    "null_frac_long": Query(lambda s, d: _round(quality.null_fractions_long(event_panel(s, d), FEATURES), ["null_frac"]), f"{_P} {_LONG_SQL}"),
    "null_frac_pivot": Query(
        _pivot,
        f"{_P}, l AS ({_LONG_SQL}), m AS (SELECT feature, null_frac, 'day_' || date_id AS day FROM l) SELECT * FROM (PIVOT m ON day USING max(null_frac) GROUP BY feature)",
    ),
    "symbol_stats": Query(
        lambda s, d: _values(quality.symbol_stats(event_panel(s, d), [*FEATURES, *RESPONDERS]), (SYMBOL,)),
        f"{_P} SELECT symbol_id, {', '.join(_r(f'{f}({x})', f'{x}_{n}') for x in [*FEATURES, *RESPONDERS] for f, n in (('avg', 'mean'), ('stddev_samp', 'std'), ('min', 'min'), ('max', 'max')))} FROM p GROUP BY symbol_id",
    ),
    "nunique": Query(
        lambda s, d: quality.distinct_counts(event_panel(s, d), [*FEATURES, *RESPONDERS]),
        f"{_P} SELECT symbol_id, {', '.join(f'count(DISTINCT {x}) AS {x}_n_unique' for x in [*FEATURES, *RESPONDERS])} FROM p GROUP BY symbol_id",
    ),
    "nunique_all": Query(
        lambda s, d: quality.distinct_counts(event_panel(s, d), [*FEATURES, *RESPONDERS], by=[]),
        f"{_P} SELECT {', '.join(f'count(DISTINCT {x}) AS {x}_n_unique' for x in [*FEATURES, *RESPONDERS])} FROM p",
    ),
    "low_std": Query(
        lambda s, d: _round(quality.low_deviation(event_panel(s, d, "gappy"), RESPONDERS, 2.0), ["std"]),
        f"{_G} " + " UNION ALL ".join(f"SELECT symbol_id, '{x}' AS feature, {_r(f'stddev_samp({x})', 'std')} FROM p GROUP BY symbol_id HAVING stddev_samp({x}) < 2.0" for x in RESPONDERS),
    ),
    "monotone_check": Query(
        _monotone,
        """WITH e AS (SELECT row_number() OVER () AS r, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d, user_id AS u FROM events),
l AS (SELECT *, lag(d) OVER (ORDER BY r) AS pd, lag(u) OVER (ORDER BY r) AS pu FROM e)
SELECT count(*) FILTER (d < pd) AS date_breaks, count(*) FILTER (d = pd AND u < pu) AS time_breaks FROM l""",
    ),
    "matrix_order": Query(
        _matrix_order,
        """WITH e AS (SELECT event_id // 300 AS f, event_id AS r, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d, user_id % 50 AS t FROM events),
l AS (SELECT *, lag(d) OVER w AS pd, lag(t) OVER w AS pt FROM e WINDOW w AS (PARTITION BY f ORDER BY r)),
s AS (SELECT f, count(*) AS n, count(*) FILTER (d < pd) AS db, count(*) FILTER (d = pd AND t < pt) AS tb, arg_min(d * 100 + t, r) AS first, arg_max(d * 100 + t, r) AS last FROM l GROUP BY f),
o AS (SELECT *, lag(last) OVER (ORDER BY f) AS before FROM s)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(db) AS BIGINT) AS date_breaks, CAST(sum(tb) AS BIGINT) AS time_breaks, count(*) FILTER (first < before) AS file_breaks FROM o""",
    ),
    "matrix_written": Query(_written_matrix, f"{_P} SELECT count(*) AS n_rows, 0 AS date_breaks, 0 AS time_breaks, 0 AS file_breaks, min(date_id) AS min_date, max(date_id) AS max_date FROM p"),
    "range_check": Query(lambda s, d: validate.date_range(event_panel(s, d)), f"{_P} SELECT min(date_id) AS min_date, max(date_id) AS max_date, count(*) AS n_rows FROM p"),
    "day_index": Query(lambda s, d: crossval.day_index(event_panel(s, d)), f"{_P} SELECT date_id, CAST(row_number() OVER (ORDER BY date_id) - 1 AS INT) AS day FROM (SELECT DISTINCT date_id FROM p)"),
    "sliding_cv_folds": Query(_folds, f"WITH {_FOLDS_SQL} SELECT * FROM folds"),
    "cv_assignment": Query(
        _assigned,
        f"""WITH {_FOLDS_SQL}, p AS ({duck_panel()}), i AS (SELECT date_id, row_number() OVER (ORDER BY date_id) - 1 AS day FROM (SELECT DISTINCT date_id FROM p))
SELECT {K}, fold, CASE WHEN day < tr_hi THEN 'train' ELSE 'valid' END AS part FROM p JOIN i USING (date_id) JOIN folds ON day >= tr_lo AND day < tr_hi OR day >= va_lo AND day < va_hi""",
    ),
    "wr2": Query(
        _wr2,
        f"""{_P}, m AS (SELECT *, sum(weight * responder_0) OVER s / sum(weight) OVER s AS mean, responder_0 * 0.5 + 0.1 AS guess FROM p WINDOW s AS (PARTITION BY symbol_id))
SELECT symbol_id, {_r('1 - sum(weight * (responder_0 - guess) ** 2) / sum(weight * (responder_0 - mean) ** 2)', 'wr2')} FROM m GROUP BY symbol_id""",
    ),
    "matrix_project": Query(
        _matrix,
        f"{_P} SELECT {K}, {', '.join(f'ROUND(CAST(CAST({e} AS FLOAT) AS DOUBLE), 3) AS {n}' for n, e in {'y': 'responder_0', 'w': 'weight', **{x: x for x in FEATURES}}.items())} FROM p",
    ),
    "dense_blocks": Query(
        _dense,
        f"{_P} SELECT row_number() OVER (ORDER BY date_id, time_id, symbol_id) - 1 AS place, date_id, {', '.join(f'ROUND(CAST(CAST({e} AS FLOAT) AS DOUBLE), 3) AS {n}' for n, e in {'y': 'responder_0', 'w': 'weight', **{x: x for x in FEATURES}}.items())} FROM p",
    ),
    "topk_features": Query(
        lambda s, d: selection.top_features(_importance(s, d), 2, ["feature_01"]),
        f"""{_P}, c AS ({" UNION ALL ".join(f"SELECT '{x}' AS feature, abs(corr({x}, responder_0)) AS s FROM p" for x in ("feature_00", "responder_1", "responder_2"))}),
r AS (SELECT feature, row_number() OVER (ORDER BY s DESC, feature) + 1 AS rank FROM c)
SELECT CAST(1 AS INT) AS rank, 'feature_01' AS feature UNION ALL SELECT CAST(rank AS INT), feature FROM r WHERE rank <= 3""",
    ),
    "gbt_cv": Query(lambda s, d: _with_binned(s, d, lambda b, folds: selection.fit_folds(b, folds, TREES)[0])),
    "gain_share": Query(lambda s, d: _with_binned(s, d, lambda b, folds: selection.fit_folds(b, folds, TREES)[1])),
    "gbt_stump": Query(_stump, _STUMP_SQL),
    "select_features": Query(_selected),
    "parameter_search": Query(_searched),
}

