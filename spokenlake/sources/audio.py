"""Audio: WAV files to frames, energy-based voice activity, features, and export of segments. Other formats are decoded
before they land; network fetches stay outside."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATE, FRAME = 16_000, 256
FRAMES = "path string, frame long, energy long, is_speech boolean"


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the WAV files below a path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path).select("path", "content")


def decode(content: bytes) -> tuple[np.ndarray, int]:
    """16-bit samples, channels averaged and clipped, and their rate."""
    with wave.open(io.BytesIO(content)) as w:
        if w.getsampwidth() != 2:
            raise ValueError("16-bit samples are expected")
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
        rate = w.getframerate()
    mixed = x[:, 0].astype(np.int64) if x.shape[1] == 1 else np.clip(np.rint(x.mean(1)), -32768, 32767).astype(np.int64)
    return mixed, rate


def resample(x: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    if rate == to or not len(x):
        return x
    return np.rint(np.interp(np.arange(int(len(x) * to / rate)) * rate / to, np.arange(len(x)), x)).astype(np.int64)


def energies(x: np.ndarray, size: int = FRAME) -> np.ndarray:
    """Summed absolute values of each whole or last frame."""
    padded = np.concatenate([np.abs(x), np.zeros(-len(x) % size, np.int64)])
    return padded.reshape(-1, size).sum(1)


def threshold_of(x: np.ndarray, threshold: float) -> float:
    """The configured threshold, raised in loud audio and lowered in quiet audio by its mean absolute value."""
    mean = np.abs(x).mean() if len(x) else 0.0
    return min(0.9, threshold * 1.2) if mean > 10_000 else max(0.2, threshold * 0.8) if mean < 1_000 else threshold


def speech_frames(x: np.ndarray, threshold: float = 0.5) -> np.ndarray:
    """A frame is speech if its energy exceeds a share, set by the threshold, of the loud frames' energy."""
    e = energies(x)
    loud = np.quantile(e, 0.95) if len(e) else 0
    return e > max(FRAME, loud * threshold_of(x, threshold) * 0.2)


def frames(audio: DataFrame, threshold: float = 0.5) -> DataFrame:
    """audio: path, content -> a row for each frame of 16 ms. One file's samples are in a task at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                x = resample(*decode(content.as_py()))
                e = energies(x)
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(e), pa.string()), pa.array(np.arange(len(e))), pa.array(e), pa.array(speech_frames(x, threshold))], names=["path", "frame", "energy", "is_speech"])

    return audio.select("path", "content").mapInArrow(run, FRAMES)


def mel_features(x: np.ndarray, bins: int = 80, window: int = 400, hop: int = 160, rate: int = RATE) -> np.ndarray:
    """Log energies in mel bands of each window."""
    if len(x) < window:
        return np.zeros((0, bins))
    cut = np.lib.stride_tricks.sliding_window_view(x.astype(np.float64), window)[::hop]
    power = np.abs(np.fft.rfft(cut * np.hamming(window), 512)) ** 2
    mel = lambda f: 1127 * np.log1p(f / 700)
    edges = np.linspace(mel(20), mel(rate / 2), bins + 2)
    at = mel(np.fft.rfftfreq(512, 1 / rate))
    up, down = (at - edges[:-2, None]) / np.diff(edges)[:-1, None], (edges[2:, None] - at) / np.diff(edges)[1:, None]
    return np.log(np.maximum(power @ np.clip(np.minimum(up, down), 0, None).T, 1e-10))


def normalised(features: np.ndarray, mean: np.ndarray, inverse_deviation: np.ndarray) -> np.ndarray:
    return (features - mean) * inverse_deviation


def token_table(spark: SparkSession, lines: list[str]) -> DataFrame:
    """token, id: a dictionary file's lines of a token and its id, which is the line's number where it is missing."""
    rows = [(p[0], int(p[1]) if len(p) > 1 else k) for k, p in enumerate(x.split() for x in lines) if p]
    return spark.createDataFrame(rows, "token string, id long")


def cut_segments(audio: DataFrame, segments: DataFrame, padding_ms: int = 0) -> DataFrame:
    """segments: path, index, start_ms, end_ms -> path, index, content: each as a WAV file with silence on both sides."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"path": [], "index": [], "content": []}
        if left.num_rows and right.num_rows:
            x = resample(*decode(left["content"][0].as_py()))
            quiet = np.zeros(RATE * padding_ms // 1000, "<i2")
            for r in right.sort_by("index").to_pylist():
                body = io.BytesIO()
                with wave.open(body, "wb") as w:
                    w.setnchannels(1), w.setsampwidth(2), w.setframerate(RATE)
                    w.writeframes(np.concatenate([quiet, x[r["start_ms"] * RATE // 1000 : r["end_ms"] * RATE // 1000].astype("<i2"), quiet]).tobytes())
                out["path"].append(r["path"]), out["index"].append(r["index"]), out["content"].append(body.getvalue())
        return pa.table({"path": pa.array(out["path"], pa.string()), "index": pa.array(out["index"], pa.int64()), "content": pa.array(out["content"], pa.binary())})

    given = segments.select("path", F.col("index").cast("long").alias("index"), F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"))
    return audio.groupBy("path").cogroup(given.groupBy("path")).applyInArrow(run, "path string, index long, content binary")
