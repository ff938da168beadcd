"""Parameters of a pipeline run; the defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Clip:
    window: int = 480
    k: float = 3.0
    ddof: int = 1
    min_valid: int = 10


@dataclass(frozen=True)
class Fill:
    open_ticks: tuple[int, int] = (0, 10)
    ttl_days_open: int = 7
    max_gap: int | None = 200
    ttl_days_same_tick: int | None = 7


@dataclass(frozen=True)
class StageA:
    lags: tuple[int, ...] = (1, 10, 50, 100, 500, 900, 950, 967)
    diffs: tuple[int, ...] = (1, 5, 10, 30)
    rolling: tuple[int, ...] = (3, 7, 14, 30)
    cast: str = "float"


@dataclass(frozen=True)
class StageB:
    lags: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7, 14, 21, 30)
    stats_columns: tuple[str, ...] | None = None
    across: bool = True
    cast: str = "float"


@dataclass(frozen=True)
class StageC:
    lags: tuple[int, ...] = (1, 2, 10, 50, 100, 500, 900, 950, 968, 1936, 2904, 3872, 4840, 5808, 6776, 7744)
    returns: tuple[int, ...] = (3, 10, 50)
    diffs: tuple[int, ...] = (3, 10, 50)
    rz: tuple[int, ...] = (3, 7, 14, 30)
    spans: tuple[int, ...] = (5, 10, 50)
    keep_rolling: bool = True
    cross: tuple[str, ...] = ("feature_06", "feature_59", "feature_04", "feature_76", "feature_75", "feature_60", "feature_26")
    cast: str = "float"


@dataclass(frozen=True)
class Folds:
    n_splits: int = 2
    gap_days: int = 7
    train_to_val: int = 4


@dataclass(frozen=True)
class Trees:
    rounds: int = 3000
    patience: int = 300
    rate: float = 0.01
    leaves: int = 128
    depth: int = 10
    min_rows: int = 5000
    min_weight: float = 5.0
    min_gain: float = 0.0
    l1: float = 0.1
    l2: float = 10.0
    feature_fraction: float = 0.8
    bag_fraction: float = 0.8
    bag_every: int = 3
    bins: int = 255
    seed: int = 42


#: The trees by which features are selected.
SELECTION_TREES = Trees(rounds=2000, patience=100, rate=0.05, leaves=63, depth=8, min_rows=200, min_weight=0.001, l1=0.0, l2=0.0, bag_every=1)


@dataclass(frozen=True)
class Selection:
    k: int = 1000
    always: tuple[str, ...] = ("time_pos", "time_sin", "time_cos", "time_bucket")


@dataclass(frozen=True)
class Settings:
    first_date: int | None = None
    last_date: int | None = None
    daily_ticks: int = 968
    buckets: int = 6
    pad_days: int = 30
    core_days: int = 30
    clip: Clip = field(default_factory=Clip)
    fill: Fill = field(default_factory=Fill)
    a: StageA = field(default_factory=StageA)
    b: StageB = field(default_factory=StageB)
    c: StageC = field(default_factory=StageC)
    folds: Folds = field(default_factory=Folds)
    trees: Trees = field(default_factory=Trees)
    selection: Selection = field(default_factory=Selection)
    selection_trees: Trees = SELECTION_TREES


def load_settings(spark: SparkSession, path: str) -> Settings:
    """Settings from YAML with the fields above, from any store that Spark reads.

    What the file leaves out keeps its default, an unknown field is an error.
    """
    import yaml

    given = yaml.safe_load(spark.read.text(path, wholetext=True).first()["value"]) or {}
    tuples = lambda d: {k: tuple(v) if isinstance(v, list) else v for k, v in d.items()}
    parts = {"clip", "fill", "a", "b", "c", "folds", "trees", "selection", "selection_trees"}
    unknown = set(given) - {f.name for f in fields(Settings)}
    if unknown:
        raise KeyError(f"unknown settings: {sorted(unknown)}")
    return Settings(**{k: replace(getattr(Settings(), k), **tuples(v)) if k in parts else v for k, v in given.items()})
