"""Media columns: texts as WAV audio, short-time Fourier transforms and peak-pair fingerprints.

``encode_media`` stores each text's UTF-8 bytes, filled up with 255 to a positive multiple of 576,
as 8-bit mono samples of a WAV file in a binary column. ``fingerprint_media`` reads such a column
with the wave module. Frames of 288 samples, every 144, are windowed and transformed; each frame
keeps its strongest local maxima, and pairs of peaks of nearby frames become codes (first
frequency, second frequency, distance in frames) stored with their times.

Defined results: a null text is an empty one (one block of filling); a constant signal has no peaks
and no codes; equal texts give equal values; media that is null or no such WAV gives nulls; repeated
rows get a row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.llm.common import runs, text_bytes

BLOCK, FILL, RATE = 576, b"\xff", 8000
FRAME, HOP = 288, 144
#: Peaks of a frame, and how many frames apart the two of a pair may be.
PEAKS, REACH = 2, 2
#: Frames transformed at once; a long text's peaks are found part by part.
FRAMES_AT_ONCE = 8192
_HANN = np.hanning(FRAME).astype(np.float32)


def payload_of(text: bytes) -> bytes:
    """The text's bytes filled up to a positive multiple of the block."""
    return text + FILL * (-len(text) % BLOCK if text else BLOCK)


def write_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def read_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        if r.getnchannels() != 1 or r.getsampwidth() != 1:
            raise wave.Error("8-bit mono samples are expected")
        return r.readframes(r.getnframes())


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times (frames) and frequencies (bins) of the strongest local maxima of every frame, by time."""
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    times, bins = [], []
    for at in range(0, len(frames), FRAMES_AT_ONCE):
        part = frames[at : at + FRAMES_AT_ONCE].astype(np.float32)
        part -= part.mean(1, keepdims=True)
        power = np.abs(np.fft.rfft(part * _HANN, axis=1)) ** 2
        inner = power[:, 1:-1]
        top = np.where((inner > power[:, :-2]) & (inner >= power[:, 2:]) & (inner > 1.0), inner, 0)
        best = np.argsort(-top, axis=1, kind="stable")[:, :PEAKS]
        t, k = np.nonzero(np.take_along_axis(top, best, 1))
        times.append(t + at)
        bins.append(best[t, k] + 1)
    return np.concatenate(times), np.concatenate(bins)


def peak_pairs(times: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Times and codes of all pairs of peaks 1 to REACH frames apart, by time and code."""
    all_times, all_codes = [], []
    for ahead in range(1, (REACH + 1) * PEAKS):
        first, second = slice(0, len(times) - ahead), slice(ahead, None)
        if ahead >= len(times):
            break
        distance = times[second] - times[first]
        near = (distance >= 1) & (distance <= REACH)
        all_times.append(times[first][near])
        all_codes.append((bins[first][near] << 10 | bins[second][near] << 2 | distance[near]))
    if not all_times:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    t, c = np.concatenate(all_times), np.concatenate(all_codes)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``n_bytes`` of the text and ``media``, the WAV file, of every row."""

    def work(batches):
        for whole in batches:
            for batch in runs(whole, "text_"):
                texts = text_bytes(batch.column("text_"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col), pa.array([len(x) for x in texts], pa.int64()), pa.array([write_wav(payload_of(x)) for x in texts], pa.binary())],
                    names=[id_col, "n_bytes", "media"],
                )

    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text_"))
    return narrow.mapInArrow(work, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, media binary")


_FOUND = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, times array<int>, codes array<int>, feature string"


def _features(media: bytes | None) -> tuple:
    try:
        payload = read_wav(media)
    except (wave.Error, EOFError, TypeError):
        return (None,) * 8
    times, codes = peak_pairs(*peaks(np.frombuffer(payload, np.uint8))) if len(payload) >= FRAME else (np.zeros(0, np.int32),) * 2
    feature = f"{len(codes)}:{hashlib.sha256(times.tobytes() + codes.tobytes()).hexdigest()}"
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), times, codes, feature


def fingerprint_media(media: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """Read each WAV: size and digests of its payload and of itself, the time-coded pair codes
    (``times`` in frames, ``codes``) and ``feature``, their number and digest. ``keep`` names columns to pass on."""

    def work(batches):
        for whole in batches:
            for batch in runs(whole, media_col):
                columns = list(zip(*(_features(x) for x in batch.column(media_col).to_pylist())))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in (id_col, *keep)] + [pa.array(x, k) for x, k in zip(columns, kinds)],
                    names=[id_col, *keep, *(f.split()[0] for f in _FOUND.split(", "))],
                )

    kept = "".join(f"`{c}` {media.schema[c].dataType.simpleString()}, " for c in (id_col, *keep))
    return media.select(id_col, *keep, media_col).mapInArrow(work, kept + _FOUND)
