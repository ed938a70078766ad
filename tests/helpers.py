"""Small deterministic series for tests."""

from __future__ import annotations

import datetime
import random

START = datetime.datetime(2024, 1, 1)
SERIES = "zone string, datetime timestamp_ntz, tempF double, windspeedMiles double, humidity double, value double"


def hour(n: int) -> datetime.datetime:
    return START + datetime.timedelta(hours=n)


def series_rows(sizes: dict[str, int], seed: int = 7, gap: float = 0.2, missing: float = 0.0):
    """Hourly rows per zone with random gaps and random missing measures."""
    rng = random.Random(seed)
    rows = []
    for zone, size in sizes.items():
        at = 0
        for _ in range(size):
            at += 1 + (rng.random() < gap) * rng.randint(1, 60)
            cells = [round(rng.gauss(50, 20), 3) if rng.random() >= missing else None for _ in range(4)]
            rows.append((zone, hour(at), *cells))
    return rows


def series(spark, sizes: dict[str, int], **options):
    return spark.createDataFrame(series_rows(sizes, **options), SERIES)


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))
