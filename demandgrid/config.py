"""Settings of a run; every default can be overridden per call."""

from __future__ import annotations

from dataclasses import dataclass, field

from . import constants as k


@dataclass(frozen=True)
class FeatureSettings:
    lag_periods: list[int] = field(default_factory=lambda: list(k.LAG_PERIODS))
    rolling_windows: list[int] = field(default_factory=lambda: list(k.ROLLING_WINDOWS))
    holidays: list[str] = field(default_factory=lambda: list(k.HOLIDAYS))
    target: str = k.TARGET
    time: str = k.TIME
    # rows of one series handled by one task; longer series are cut into overlapping blocks
    series_rows: int = 1_000_000
    block_rows: int = 250_000


@dataclass(frozen=True)
class DataSettings:
    train_path: str | None = None
    eval_path: str | None = None
    target: str = k.TARGET
    time: str = k.TIME
    fraction: float = k.SAMPLE_FRACTION
    seed: int = k.SEED


@dataclass(frozen=True)
class RunSettings:
    data: DataSettings = field(default_factory=DataSettings)
    features: FeatureSettings = field(default_factory=FeatureSettings)
    models: dict = field(default_factory=lambda: {name: dict(v) for name, v in k.MODEL_SETTINGS.items()})
    cv_folds: int = k.CV_FOLDS
    seed: int = k.SEED
