"""Stage C: histories of each feature within runs without a gap of days, and comparisons across symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstep import windows
from loomstep.functions.scalar import EPS, clip
from loomstep.operators.chunks import CHUNK_DAYS, on_day_chunks
from loomstep.schema import DATE, KEYS, SYMBOL, TIME, positive_ints, require_columns


def tick_streaks(df: DataFrame, *more: str, name: str = "streak") -> DataFrame:
    """df with the number of the run of ticks: a new one begins where more than one day lies between two rows.

    more: further keys of the windows, such as a chunk of the history, here and below; runs are then numbered in each.
    """
    w = windows.of_symbol(*more)
    gap = F.coalesce(F.col(DATE) - F.lag(DATE).over(w), F.lit(0))
    rows = df.withColumn("_gap", gap)
    return rows.withColumn(name, F.sum((F.col("_gap") > 1).cast("int")).over(windows.so_far(w)).cast("int")).drop("_gap")


def lagged(c: str, k: int, *more: str) -> Column:
    return F.lag(c, k).over(windows.of_streak(*more))


def difference(c: str, k: int, *more: str) -> Column:
    return F.col(c) - lagged(c, k, *more)


def relative_return(c: str, k: int, *more: str, bound: float = 10.0) -> Column:
    """Value over the value k rows before, less 1, within bounds; null where that value is next to 0."""
    past = lagged(c, k, *more)
    return clip(F.when(F.abs(past) > 1e-12, F.col(c) / past - 1), -bound, bound)


def rolling(c: str, n: int, *more: str) -> tuple[Column, Column, Column]:
    """Mean, sample deviation and distance from the mean in deviations over the last n rows of the run."""
    frame = windows.last_rows(windows.of_streak(*more), n)
    mean, std = F.avg(c).over(frame), F.stddev_samp(c).over(frame)
    return mean, std, F.when(std > EPS, (F.col(c) - mean) / (std + EPS))


def ewm(df: DataFrame, columns: list[str], spans: list[int], cast: str = "float") -> DataFrame:
    """Keys and {column}__ewm{span}: y = (1 - a) * y before + a * x with a = 2 / (span + 1), from the run's first value.

    Nulls leave y as it is. Rows are dealt out by symbol once.
    """
    rows = tick_streaks(df.select(*KEYS, *columns).repartition(SYMBOL))
    names = [f"{c}__ewm{s}" for c in columns for s in spans]
    return with_ewm(rows, columns, spans, cast).select(*KEYS, *names)


def with_ewm(rows: DataFrame, columns: list[str], spans: list[int], cast: str = "float") -> DataFrame:
    """rows, which are dealt by symbol and have their streak, with the columns of ewm(); the others are carried along.

    Spark has no such recursion: a worker goes through its sorted rows batch by batch, so it holds one batch and
    the last y of each column, however long a run.
    """
    names = [f"{c}__ewm{s}" for s in spans for c in columns]
    kind = T.FloatType() if cast == "float" else T.DoubleType()
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, kind) for n in names)])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last = [np.full(len(columns), np.nan) for _ in spans]
        run_of = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns])
            keys = np.column_stack([batch.column(k).fill_null(-1).to_numpy(zero_copy_only=False) for k in (SYMBOL, "streak")])
            starts = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)
            made = [np.empty_like(x) for _ in spans]
            for lo, hi in zip(starts, np.append(starts[1:], len(x)), strict=True):
                for i, s in enumerate(spans):
                    before = last[i] if tuple(keys[lo]) == run_of else np.full(len(columns), np.nan)
                    made[i][lo:hi] = _smoothed(x[lo:hi], 2 / (s + 1), before)
                    last[i] = made[i][hi - 1]
                run_of = tuple(keys[lo])
            out = np.column_stack(made).astype("float32" if cast == "float" else "float64")
            arrays = [pa.array(column, mask=np.isnan(column)) for column in out.T]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=schema.names)

    return rows.sortWithinPartitions(SYMBOL, "streak", DATE, TIME).mapInArrow(run, schema)


def _smoothed(x, a: float, y):
    """y after each row of x, by column, from y before it (NaN: none); NaN in x leaves y.

    Blocks of rows are sums of x over growing powers, so short that these stay below 10 ** 4.
    """
    import numpy as np

    out, at, block = np.empty_like(x), 0, max(1, int(np.log(1e4) / -np.log1p(-a))) if a < 1 else 1
    power = (1 - a) ** np.arange(1, block + 1)[:, None]
    while at < len(x):
        part = x[at : at + block]
        if np.isnan(y).any() or np.isnan(part).any() or a == 1:
            part = part[:1]
            y = np.where(np.isnan(part[0]), y, np.where(np.isnan(y), part[0], (1 - a) * y + a * part[0]))
            out[at] = y
        else:
            p = power[: len(part)]
            out[at : at + len(part)] = (y + np.cumsum(a * part / p, axis=0)) * p
            y = out[at + len(part) - 1]
        at += len(part)
    return out


def cross_section_z(c: str) -> Column:
    w = windows.across_symbols()
    std = F.stddev_samp(c).over(w)
    return F.when(std > EPS, (F.col(c) - F.avg(c).over(w)) / (std + EPS))


def cross_section_rank(c: str) -> Column:
    """Average rank less one half over the number of values; 0.5 for a single value; null for null."""
    w = windows.across_symbols()
    n = F.count(c).over(w)
    equal = F.count(F.lit(1)).over(w.partitionBy(DATE, TIME, c))
    rank = F.rank().over(w.orderBy(F.col(c).asc_nulls_last())) + (equal - 1) / 2
    return F.when(F.col(c).isNotNull(), F.when(n > 1, (rank - 0.5) / n).otherwise(0.5))


#: Groups of stage C in the order in which they are made and written.
GROUPS = ("lags", "ret", "diff", "rz", "ewm", "csrank")


def stage_c(
    df: DataFrame,
    columns: list[str],
    *,
    lags: tuple[int, ...] = (1, 3),
    returns: tuple[int, ...] = (1,),
    diffs: tuple[int, ...] = (1,),
    rz: tuple[int, ...] = (5,),
    spans: tuple[int, ...] = (10,),
    keep_rolling: bool = True,
    cross: list[str] | None = None,
    cast: str = "float",
    groups: tuple[str, ...] = GROUPS,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Keys and the features of the chosen groups. Comparisons across symbols take an exchange by tick.

    Windows over runs are made in chunks of chunk_days of a symbol, in one exchange: a run has a row on each of its
    days, so k rows before a row lie no more than k days back, and that is the halo. Exponential means have no such
    bound: where they are chosen, they share one exchange by symbol with the windows. Rows of a null day are a chunk.
    Plans of over 100 columns leave code generation, so wide panels are made group by group.
    """
    require_columns(df, [*KEYS, *columns])
    back = {"lags": positive_ints(lags, "lags"), "ret": positive_ints(returns, "returns"), "diff": positive_ints(diffs, "diffs"), "rz": positive_ints(rz, "rz")}
    back = {g: ks for g, ks in back.items() if g in groups and columns}

    def over_runs(*more: str) -> dict[str, Column]:
        made: dict[str, Column] = {}
        for c in columns:
            made |= {f"{c}__lag{k}": lagged(c, k, *more) for k in back.get("lags", ())}
            made |= {f"{c}__ret{k}": relative_return(c, k, *more) for k in back.get("ret", ())}
            made |= {f"{c}__diff{k}": difference(c, k, *more) for k in back.get("diff", ())}
            for n in back.get("rz", ()):
                mean, std, z = rolling(c, n, *more)
                made |= ({f"{c}__rmean{n}": mean, f"{c}__rstd{n}": std} if keep_rolling else {}) | {f"{c}__rz{n}": z}
        return made

    def windowed(rows: DataFrame, *more: str) -> DataFrame:
        made = over_runs(*more)
        names.extend(made)
        return rows.select(*KEYS, *more, "streak", *wide, *(e.cast(cast).alias(n) for n, e in made.items()))

    chosen = [c for c in columns if c in (cross or [])] if "csrank" in groups else []
    wide = [c for c in columns if c in chosen or "ewm" in groups]
    rows, names, smooth = df.select(*KEYS, *columns), [], []
    if "ewm" in groups:
        smooth = [f"{c}__ewm{s}" for c in columns for s in positive_ints(spans, "spans")]
        rows = with_ewm(windowed(tick_streaks(rows.repartition(SYMBOL))), columns, positive_ints(spans, "spans"), cast)
    elif any(back.values()):
        rows = on_day_chunks(rows, lambda part, chunk: windowed(tick_streaks(part, chunk), chunk), halo=max(map(max, filter(None, back.values()))), days=chunk_days)
    section = {f"{c}__cs_z": cross_section_z(c) for c in chosen} | {f"{c}__csrank": cross_section_rank(c).cast(cast) for c in chosen}
    return rows.select(*KEYS, *names, *(e.alias(n) for n, e in section.items()), *smooth)
