"""Loudness and spectrum over time ranges, and the windowed series they are made from."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

ABSOLUTE_GATE, RELATIVE_GATE = -70.0, -10.0  # LUFS, and LU below the ungated mean
BANDS = 10
#: Centres of the octave bands in Hz.
CENTERS = (31.5, 63.0, 125.0, 250.0, 500.0, 1000.0, 2000.0, 4000.0, 8000.0, 16000.0)


def _clipped(windows: DataFrame, start_us: int, end_us: int, target: str | None) -> DataFrame:
    if end_us <= start_us:
        raise ValueError("end_us must be greater than start_us")
    df = windows if target is None else windows.filter(F.col("target_id") == target)
    df = df.filter((F.col("end_us") > F.col("start_us")) & (F.col("end_us") > start_us) & (F.col("start_us") < end_us))
    return df.withColumn("overlap_us", F.least("end_us", F.lit(end_us)) - F.greatest("start_us", F.lit(start_us)))


def _tenth(x):
    """One decimal, halves away from zero."""
    return F.round(x * 10) / 10


def loudness_range(windows: DataFrame, start_us: int, end_us: int, target: str | None = None) -> DataFrame:
    """Per stream (target_id): window_count, covered_us, integrated_lufs (gated twice), true_peak_dbtp.

    windows: target_id, start_us, end_us, momentary_lufs, true_peak_dbtp. Each window counts by its overlap with the range.
    The second gate needs the first one's mean, which is one row a stream and is joined back."""
    w = _clipped(windows, start_us, end_us, target)
    loud = F.when(F.col("momentary_lufs") > ABSOLUTE_GATE, F.col("momentary_lufs"))
    energy, weight = F.pow(F.lit(10.0), loud / 10), F.when(loud.isNotNull(), F.col("overlap_us").cast("double"))
    first = w.groupBy("target_id").agg(
        F.count("*").alias("window_count"), F.sum("overlap_us").alias("covered_us"),
        (10 * F.log10(F.sum(energy * weight) / F.sum(weight)) + RELATIVE_GATE).alias("gate"),
        F.max(F.pow(F.lit(10.0), F.col("true_peak_dbtp") / 20)).alias("peak"),
    )
    gated = (
        w.filter(loud.isNotNull()).join(first.select("target_id", "gate"), "target_id").filter(F.col("momentary_lufs") > F.col("gate"))
        .groupBy("target_id").agg(_tenth(10 * F.log10(F.sum(F.pow(F.lit(10.0), F.col("momentary_lufs") / 10) * F.col("overlap_us")) / F.sum("overlap_us"))).alias("integrated_lufs"))
    )
    peak = F.when(F.col("peak") > 0, _tenth(20 * F.log10("peak"))).alias("true_peak_dbtp")
    return first.join(gated, "target_id", "left").select("target_id", "window_count", "covered_us", "integrated_lufs", peak)


def spectrum_range(windows: DataFrame, start_us: int, end_us: int, target: str | None = None) -> DataFrame:
    """Per stream and band: mean and greatest level in dB over the range, by overlap; nulls are left out band by band.

    windows: target_id, start_us, end_us, bands (array). Bands beyond the tenth are not looked at."""
    w = _clipped(windows, start_us, end_us, target)
    each = w.select("target_id", "overlap_us", F.posexplode("bands").alias("band", "db")).filter((F.col("band") < BANDS) & F.col("db").isNotNull())
    power = F.pow(F.lit(10.0), F.col("db") / 10)
    return each.groupBy("target_id", "band").agg(
        F.count("*").alias("window_count"), _tenth(10 * F.log10(F.sum(power * F.col("overlap_us")) / F.sum("overlap_us"))).alias("mean_db"), _tenth(F.max("db")).alias("max_db")
    )


def envelope(samples: DataFrame, rate: int, window_us: int = 50_000) -> DataFrame:
    """Tumbling windows over (target_id, i, value): rms_db and peak_db, at least -120, to a tenth."""
    n = max(1, rate * window_us // 1_000_000)
    floor = lambda x: F.greatest(F.lit(-120.0), _tenth(20 * F.log10(F.nullif(x, F.lit(0.0)))))
    db = lambda x: F.when(x > 0, floor(x)).otherwise(-120.0)
    return (
        samples.withColumn("window", F.floor(F.col("i") / n)).groupBy("target_id", "window")
        .agg(db(F.sqrt(F.avg(F.col("value") * F.col("value")))).alias("rms_db"), db(F.max(F.abs("value"))).alias("peak_db"), F.count("*").alias("samples"))
        .withColumn("start_us", F.floor(F.col("window") * n * 1_000_000 / rate).cast("long"))
    )


def loudness_windows(frames: DataFrame, width: int = 400_000) -> DataFrame:
    """Windows of measured frames (target_id, at_us, momentary_lufs, true_peak_dbtp): the last measured loudness, the greatest peak."""
    return (
        frames.withColumn("start_us", (F.floor(F.col("at_us") / width) * width).cast("long")).groupBy("target_id", "start_us")
        .agg(
            F.max_by("momentary_lufs", F.when(F.col("momentary_lufs").isNotNull(), F.col("at_us"))).alias("momentary_lufs"),
            F.max("true_peak_dbtp").alias("true_peak_dbtp"), F.count("*").alias("frames"),
        )
        .withColumn("end_us", F.col("start_us") + width)
    )


def band_levels(samples: np.ndarray, rate: int) -> list[float | None]:
    """Octave-band levels in dB of one window: Hann-weighted power spectrum summed between half-octave edges."""
    n = samples.size
    if n == 0:
        return [None] * BANDS
    window = np.hanning(n + 1)[:n]
    power = np.abs(np.fft.rfft(samples * window)) ** 2 / max(1e-300, (window**2).sum() * n)
    power[1:] *= 2
    freq = np.fft.rfftfreq(n, 1 / rate)
    out = []
    for c in CENTERS:
        part = power[(freq >= c / 2**0.5) & (freq < c * 2**0.5)]
        total = part.sum() if c / 2**0.5 < rate / 2 and part.size else 0.0
        out.append(float(10 * np.log10(total)) if total > 0 else None)
    return out


def spectrum_windows(samples: DataFrame, rate: int, width_us: int = 400_000) -> DataFrame:
    """(target_id, start_us, bands) from samples (target_id, i, value); a window's samples are one group, bounded by its length."""
    per = rate * width_us / 1_000_000

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values("i")["value"].to_numpy(float)
        return pd.DataFrame({"target_id": [key[0]], "start_us": [int(key[1]) * width_us], "bands": [band_levels(values, rate)]})

    cells = samples.withColumn("window", F.floor(F.col("i") / per).cast("long"))
    return cells.groupBy("target_id", "window").applyInPandas(one, "target_id string, start_us long, bands array<double>")
