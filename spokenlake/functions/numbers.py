"""Numeric and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_RATE, FRAME_SAMPLES, FRAME_MS = 16_000, 256, 16


def format_duration(ms: Column, sign: str = ":") -> Column:
    """HH:MM:SS.mmm; with '-' for file names."""
    part = lambda unit, size: F.pmod(F.floor(ms / unit), F.lit(size)).cast("long")
    return F.format_string(f"%02d{sign}%02d{sign}%02d.%03d", F.floor(ms / 3_600_000).cast("long"), part(60_000, 60), part(1_000, 60), F.pmod(ms, F.lit(1_000)).cast("long"))


def samples_to_ms(samples: Column, rate: int = SAMPLE_RATE) -> Column:
    """Rounded half to even."""
    return F.bround(samples * 1000 / rate, 0).cast("long")


def ms_to_samples(ms: Column, rate: int = SAMPLE_RATE) -> Column:
    return F.bround(ms * rate / 1000, 0).cast("long")


def ms_to_frames(ms: Column, least: int = 1) -> Column:
    return F.greatest(F.lit(least), F.ceil(ms / float(FRAME_MS))).cast("long")


def source_time(local_ms: Column, start_ms: Column, end_ms: Column, padding_ms: int) -> Column:
    return F.least(end_ms, start_ms + F.greatest(F.lit(0), local_ms - padding_ms))


def adaptive_threshold(energy: Column, threshold: float) -> Column:
    return F.when(energy > 10_000, min(0.9, threshold * 1.2)).when(energy < 1_000, max(0.2, threshold * 0.8)).otherwise(threshold)


def format_size(size: Column) -> Column:
    """Bytes to TiB with one decimal, ties to the even digit (``%.1f`` alone takes them up); null for null."""
    shown = lambda unit, power: F.format_string(f"%.1f {unit}", F.bround(size / float(1 << 10 * power), 1))
    out = F.when(size.isNotNull(), shown("TiB", 4))
    for unit, power in (("GiB", 3), ("MiB", 2), ("KiB", 1), ("B", 0)):
        out = F.when(size < (1 << 10 * (power + 1)), shown(unit, power)).otherwise(out)
    return out


def lenient_int(text: Column) -> Column:
    """A non-negative whole number; null if it is none."""
    number = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("bigint"))
    return F.when(number >= 0, number)


def backoff(attempt: Column, base: float = 1.0, most: float = 8.0) -> Column:
    return F.least(base * F.pow(F.lit(2.0), attempt - 1), F.lit(most))


def retryable_status(status: Column) -> Column:
    return status.isin(408, 409, 429) | status.between(500, 599)


def coverage_status(has_text: Column, has_alignment: Column, ratio: Column) -> Column:
    return F.when(~has_text, "no_transcript").when(~has_alignment, "alignment_failed").when(ratio < 0.6, "low_coverage").otherwise("sufficient")


def anomalous(gap_ms: Column, status: Column) -> Column:
    return (gap_ms > 2000) | ~status.isin("no_speech", "sufficient")


def needs_probe(gap_ms: Column, status: Column) -> Column:
    return (status == "no_transcript") | ((status == "low_coverage") & (gap_ms > 2000))


def quietness(energy: Column, least: Column, most: Column) -> Column:
    """1 for the quietest, 0 for the loudest; 1 where all are equal."""
    return F.when(most == least, 1.0).otherwise(1.0 - (energy - least) / (most - least))


def boundary_loss(natural: Column, silence: Column, quiet: Column, full_silence: int = 19) -> Column:
    quality = (2.0 / 3.0) * F.least(F.lit(1.0), silence / full_silence) + (1.0 / 3.0) * quiet
    return F.when(natural, 0.05).otherwise(0.05 + 0.75 * (1.0 - quality))


def segment_loss(size: Column, least: int, most: int) -> Column:
    target = (least + most) / 2.0
    return 0.25 * F.abs(size - target) / target + F.greatest(F.lit(0.0), (least - size) / float(least))


def format_rate(per_minute: Column) -> Column:
    return F.when(per_minute.isNull(), "unlimited").otherwise(F.format_string("%.2f/min", per_minute.cast("double")))


def mono(channels: Column) -> Column:
    """The mean of a sample's channels, clipped to 16 bits."""
    mean = F.reduce(channels, F.lit(0.0), lambda a, x: a + x) / F.size(channels)
    return F.greatest(F.lit(-32768), F.least(F.lit(32767), F.bround(mean, 0))).cast("int")


def confidence(log_probs: Column) -> Column:
    return F.exp(F.array_max(log_probs))


def utc_text(at: Column) -> Column:
    """ISO text of an instant, in a session whose time zone is UTC."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_label(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd_HHmmss")
