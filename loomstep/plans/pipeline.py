"""From raw ticks to a panel: clean, feature stages, assembly.

clean_panel(), stages() and panel() are lazy frames on one plan. A whole run writes what each step makes, checks
the files and reads them back, so that cleaning runs once and each stage reads files and not the plans before it.
All padded cores of days are made by one job a stage, and the parts lie in buckets of the same keys, so that
stitching them moves no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep.functions.scalar import cyclic_time, time_bucket
from loomstep.operators.daily import stage_a
from loomstep.operators.history import GROUPS, stage_c
from loomstep.operators.preprocess import causal_impute, rolling_sigma_clip, zero_fill
from loomstep.operators.quality import distinct_days
from loomstep.operators.validate import assert_panel_shard, assert_time_monotone, date_range
from loomstep.operators.xday import stage_b
from loomstep.schema import DATE, KEYS, SYMBOL, TIME, free_names
from loomstep.sources.bucketed import buckets_of, write_bucketed
from loomstep.sources.dated import read_dated, write_dated
from loomstep.sources.settings import Settings


def clean_panel(df: DataFrame, features: list[str], s: Settings = Settings()) -> DataFrame:
    """Bucket, clip, impute, zero-fill; weight and responders are carried along instead of joined again."""
    rows = df.withColumn("time_bucket", time_bucket(F.col(TIME), s.daily_ticks, s.buckets))
    rows = rolling_sigma_clip(rows, features, **asdict(s.clip))
    return zero_fill(causal_impute(rows, features, **asdict(s.fill)), features)


def padded_cores(days: list[int], pad: int, core: int) -> list[tuple[int, int, int]]:
    """(read from, core from, core to) over the sorted distinct days: cores of core days after the first pad days.

    With pad days or fewer nothing can be made, so there are none.
    """
    return [(days[at - pad], days[at], days[min(at + core, len(days)) - 1]) for at in range(pad, len(days), core)]


def on_core(df: DataFrame, make: Callable[[DataFrame], DataFrame], read_from: int, low: int, high: int) -> DataFrame:
    """make() over the padded range, of which the core stays.

    A filter of dates does not sink below windows over symbols, so the range that is read is stated here.
    """
    return make(df.where(F.col(DATE).between(read_from, high))).where(F.col(DATE).between(low, high))


#: What stages() makes, in the order of writing.
STAGES = ("stage_a", "stage_b", *(f"stage_c_{g}" for g in GROUPS))


def stage(df: DataFrame, name: str, responders: list[str], features: list[str], s: Settings = Settings()) -> DataFrame:
    """One of STAGES, with keys; not run until written."""
    if name == "stage_a":
        return stage_a(df, responders, **asdict(s.a))
    if name == "stage_b":
        return stage_b(df, responders, **(asdict(s.b) | {"stats_columns": list(s.b.stats_columns) if s.b.stats_columns else None}))
    return stage_c(df, features, **(asdict(s.c) | {"cross": list(s.c.cross), "groups": (name.removeprefix("stage_c_"),)}))


def stages(df: DataFrame, responders: list[str], features: list[str], s: Settings = Settings()) -> dict[str, DataFrame]:
    """Each of STAGES by name."""
    return {name: stage(df, name, responders, features, s) for name in STAGES}


def write_checked(df: DataFrame, path: str, low: int, high: int, *, check: bool = True, exact: bool = True, counted: DataFrame | None = None) -> DataFrame:
    """Writes rows of dates low to high in blocks of dates counted from low, and reads them back.

    counted: as of write_dated(). check: the files must be in order of time and (exact) reach from low to high, or an AssertionError is raised.
    """
    spark = df.sparkSession
    inside = F.col(DATE).between(low, high)
    write_dated(df.where(inside), path, first=low, counted=None if counted is None else counted.where(inside))
    if check and exact:
        assert_panel_shard(spark, path, low, high)
    elif check:
        assert_time_monotone(spark, path)
    return read_dated(spark, path)


def on_cores(df: DataFrame, cores: list[tuple[int, int, int]], make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What on_core() makes of each of padded_cores(), put together, as one plan whatever their number.

    Each row unfolds to the cores whose padded range has its day, by a table of days. Cores are told apart by the keys:
    symbols and dates are moved so far for each core that windows over symbols, days, ticks or runs without a gap stay
    within one, and are moved back in the end. So a symbol is as many tasks as there are cores.
    """
    spark, (low, high) = df.sparkSession, (min(c[0] for c in cores), max(c[2] for c in cores))
    apart, far = high - low + 1000, 1 << 33
    spans = spark.createDataFrame([(i, a, b) for i, (a, _, b) in enumerate(cores)], "core long, a int, b int")
    [core, day] = free_names(df, "core", "day")
    # Two rows for each day of the panel, about.
    days = spans.select(F.col("core").alias(core), F.explode(F.sequence("a", "b")).alias(day))
    rows = df.join(F.broadcast(days), F.col(DATE) == F.col(day))
    kinds = dict(df.dtypes)
    moved = {SYMBOL: (F.col(SYMBOL) + F.col(core) * far).cast("long"), DATE: (F.col(DATE) + F.col(core) * apart).cast("int")}
    made = make(rows.select(*(moved[c].alias(c) if c in moved else F.col(c) for c in df.columns)))
    of = F.floor((F.col(DATE) - low) / F.lit(apart))
    back = {SYMBOL: F.col(SYMBOL) - of * far, DATE: F.col(DATE) - of * apart}
    own = [F.get(F.array(*(F.lit(c[k]) for c in cores)), of.cast("int")) for k in (1, 2)]
    inside = made.where(back[DATE].between(*own))
    return inside.select(*(back[c].cast(kinds[c]).alias(c) if c in back else F.col(c) for c in made.columns))


def widest(raw: DataFrame, responders: list[str], features: list[str], s: Settings) -> int:
    """Columns of the widest part of the panel, about: those of one column's features for each of them."""
    none = raw.where("false")
    found = [len(raw.columns) + 1]
    for name in STAGES:
        columns = responders if name in ("stage_a", "stage_b") else features
        found.append(len(KEYS) + len(columns) * (len(stage(none, name, columns[:1], columns[:1], s).columns) - len(KEYS)) if columns else 0)
    return max(found)


def _write_part(df: DataFrame, path: str, buckets: int, check: bool) -> DataFrame:
    written = write_bucketed(df, path, buckets)
    if check:
        assert_time_monotone(df.sparkSession, path, across=False)
    return written


def write_clean(raw: DataFrame, features: list[str], path: str, s: Settings = Settings(), *, check: bool = True, columns: int = 100) -> tuple[DataFrame, int]:
    """(clean panel, buckets): clean_panel() of all dates of raw (of those of the settings, if they name any), in buckets
    by which a part of so many columns has files of a fit size. check: files must be in order of time and have each row of raw."""
    rows = raw.where(F.col(DATE) >= s.first_date) if s.first_date is not None else raw
    rows = rows.where(F.col(DATE) <= s.last_date) if s.last_date is not None else rows
    r = date_range(rows).first()
    if not r["n_rows"]:
        raise ValueError("no rows in these dates")
    buckets = buckets_of(r["n_rows"], columns)
    written = _write_part(clean_panel(rows, features, s), path, buckets, check)
    if check and date_range(written).first() != r:
        raise AssertionError(f"{path}: other rows or dates than {r}")
    return written, buckets


def cores_of(clean: DataFrame, s: Settings = Settings()) -> list[tuple[int, int, int]]:
    """padded_cores() over the days of a clean panel: as many numbers come to the driver as there are days."""
    days = [r[0] for r in distinct_days(clean).orderBy(DATE).collect()]
    return padded_cores(days, s.pad_days, s.core_days)


def write_stages(clean: DataFrame, responders: list[str], features: list[str], out: str, buckets: int, s: Settings = Settings(), *, check: bool = True) -> list[DataFrame]:
    """Writes each stage of all cores below out, one job each, and reads them back in the order of STAGES.

    Rows of a core are made from its padded range alone. check: as of write_clean(), with the days that cores cover.
    """
    cores = cores_of(clean, s)
    if not cores:
        raise ValueError("no day lies behind the first pad_days days")
    inside = F.col(DATE).between(cores[0][1], cores[-1][2])
    expected = date_range(clean.where(inside)).first() if check else None
    written = []
    for name in STAGES:
        frame = on_cores(clean, cores, lambda rows, name=name: stage(rows, name, responders, features, s))
        written.append(_write_part(frame, f"{out}/{name}", buckets, check))
        if check and date_range(written[-1]).first() != expected:
            raise AssertionError(f"{out}/{name}: other rows or dates than {expected}")
    return written


def write_panel(clean: DataFrame, parts: list[DataFrame], out: str, features: list[str], *, target: str, s: Settings = Settings(), check: bool = True) -> DataFrame:
    """Stitches the clean panel to the stages of the days that cores cover and writes it to out in order of time."""
    cores = cores_of(clean, s)
    low, high = cores[0][1], cores[-1][2]
    rows = panel(clean, parts, features, target=target, low=low, high=high, daily_ticks=s.daily_ticks)
    return write_checked(rows, out, low, high, check=check, counted=clean)


def run(raw: DataFrame, responders: list[str], features: list[str], out: str, *, target: str, s: Settings = Settings(), check: bool = True) -> DataFrame:
    """The whole way from raw ticks to the panel below out: clean, stage_a, stage_b, six groups of stage_c, panel."""
    clean, buckets = write_clean(raw, features, f"{out}/clean", s, check=check, columns=widest(raw, responders, features, s))
    parts = write_stages(clean, responders, features, f"{out}/stages", buckets, s, check=check)
    return write_panel(clean, parts, f"{out}/panel", features, target=target, s=s, check=check)


def stitch(base: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """base with the columns of each part, by keys; base rows without a match stay. Parts in buckets are joined where they lie.

    What isn't a key goes through the joins as one struct a part: with hundreds of columns one by one, the code made for
    the joins is too long for the JVM to compile.
    """
    plain = [[c for c in df.columns if c not in KEYS] for df in (base, *parts)]
    held = [f"_part{i}" for i in range(len(plain))]
    packed = [df.select(*KEYS, F.struct(*(F.col(f"`{c}`") for c in own)).alias(h)) for df, own, h in zip((base, *parts), plain, held, strict=True)]
    rows = packed[0]
    for part in packed[1:]:
        rows = rows.join(part.hint("merge"), list(KEYS), "left")
    return rows.select(*KEYS, *(F.col(h).getField(c).alias(c) for own, h in zip(plain, held, strict=True) for c in own))


def panel(clean: DataFrame, parts: list[DataFrame], features: list[str], *, target: str, weight: str = "weight", low: int, high: int, daily_ticks: int = 968) -> DataFrame:
    """Keys, bucket, target, weight, features, time features and the columns of the parts, of dates low to high."""
    base = clean.where(F.col(DATE).between(low, high)).select(*KEYS, "time_bucket", target, weight, *features)
    base = base.select("*", *(e.alias(n) for n, e in cyclic_time(F.col(TIME), daily_ticks).items()))
    return stitch(base, parts)
