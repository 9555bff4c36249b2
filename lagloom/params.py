"""Analysis parameters. Every operator takes them as arguments; none reads the clock or the environment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

# Candle length per interval label, in milliseconds.
INTERVAL_MILLIS = {"1m": 60_000, "5m": 300_000, "15m": 900_000}

# The named series of the sample report (dataset, report name, source, metric).
NAMED_SERIES = (
    ("alt_data", "fear_greed", "fear_greed", "index"),
    ("alt_data", "dxy", "dxy", "close"),
    ("alt_data", "polymarket", "polymarket", "total_volume_24h"),
    ("macro_data", "treasury_10y", "fred", "treasury_10y"),
    ("macro_data", "google_trends_btc", "google_trends", "bitcoin"),
    ("macro_data", "google_trends_crypto", "google_trends", "crypto"),
    ("macro_data", "bdi", "bdi", "close"),
)

# Hypothesis states in report order.
HYPOTHESIS_STATES = ("DRAFT", "TESTING", "VALID", "GUGUR", "PAUSE")


@dataclass(frozen=True)
class AnalysisParams:
    """Settings of the lag correlation job."""

    price_dataset: str = "btc_ohlcv"
    symbol: str = "BTCUSDT"
    interval: str = "15m"
    lags: tuple[int, ...] = (0, 1, 4, 6)
    min_abs_r: float = 0.3
    max_p: float = 0.05
    min_samples: int = 30
    lookback_days: int = 120
    base_limit_days: int = 120
    max_window_days: int = 365
    skip_until_ready: tuple[str, ...] = ("polymarket",)
    expected_sources: tuple[str, ...] = ("fear_greed", "dxy", "polymarket", "fred", "google_trends")
    macro_sources: tuple[str, ...] = ("fred", "google_trends", "bdi")

    @property
    def base_window_days(self) -> int:
        """The base window never exceeds its limit, whatever lookback is asked for."""
        return min(self.lookback_days, self.base_limit_days)

    @property
    def target_name(self) -> str:
        return f"{self.price_dataset}.{self.symbol}.{self.interval}.close_1h"

    def base_cutoff(self, now: datetime) -> datetime:
        return now - timedelta(days=self.base_window_days)

    def max_cutoff(self, now: datetime) -> datetime:
        return now - timedelta(days=self.max_window_days)
