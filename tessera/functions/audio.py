"""Kernels over waveforms. Arrays of samples are handled by column expressions where Spark has them, numpy elsewhere."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Samples at or above this count as clipped.
CLIP_LEVEL = 0.99
LOW_BAND = (80.0, 300.0)
LOW_BAND_SAMPLES = 2048
_FRAME, _HOP = 2048, 512


def peak(samples: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double")))), F.lit(0.0))


def rms(samples: Column) -> Column:
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.when(F.size(samples) > 0, F.sqrt(total / F.size(samples))).otherwise(0.0)


def crest(samples: Column) -> Column:
    """Peak by root mean square, 0 in silence."""
    level = rms(samples)
    return F.when(level > 0, peak(samples) / level).otherwise(0.0)


def clip_fraction(samples: Column) -> Column:
    loud = F.size(F.filter(samples, lambda x: F.abs(x) >= CLIP_LEVEL))
    return F.when(F.size(samples) > 0, loud / F.size(samples)).otherwise(0.0)


def duration(samples: Column, rate: int) -> Column:
    return F.size(samples) / F.lit(float(rate))


def peak_normalize(samples: Column, level: float = 0.99) -> Column:
    """Samples clipped to -1 and 1, then scaled so that the largest is level; silence stays."""
    held = F.transform(samples, lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double"))))
    top = peak(held)
    return F.when(top > 0, F.transform(held, lambda x: x / top * level)).otherwise(held)


def low_band(x: np.ndarray, rate: int) -> float:
    """The share of spectral magnitude between 80 and 300 Hz in the first 2,048 samples, under a Hann window."""
    head = np.asarray(x, np.float64)[:LOW_BAND_SAMPLES]
    if len(head) < 2:
        return 0.0
    size = np.abs(np.fft.rfft(head * np.hanning(len(head))))
    hertz = np.fft.rfftfreq(len(head), 1 / rate)
    total = float(size.sum())
    return float(size[(hertz >= LOW_BAND[0]) & (hertz <= LOW_BAND[1])].sum()) / total if total > 0 else 0.0


def low_band_ratio(samples: Column, rate: int) -> Column:
    def ratio(rows: pd.Series) -> pd.Series:
        return rows.map(lambda x: None if x is None else low_band(x, rate)).astype("float64")

    return _series_udf(ratio, "double")(samples)


def _series_udf(f, kind: str):
    f.__annotations__ = {"rows": pd.Series, "return": pd.Series}
    return F.pandas_udf(f, kind)


def mono(x: np.ndarray) -> np.ndarray:
    return x.mean(axis=1) if x.ndim > 1 else x


def resample(x: np.ndarray, rate: int, to: int, half: int = 32) -> np.ndarray:
    """Windowed-sinc interpolation; the cutoff is the lower of both Nyquist frequencies."""
    if rate == to or not len(x):
        return x
    scale = min(1.0, to / rate)
    n = int(np.ceil(len(x) * to / rate))
    out = np.empty(n)
    reach = int(np.ceil(half / scale))
    taps = np.arange(-reach, reach + 1)
    padded = np.pad(x.astype(np.float64), reach + 1)
    for at in range(0, n, 4096):
        place = np.arange(at, min(n, at + 4096)) * rate / to
        base = np.floor(place).astype(int)
        off = taps - (place - base)[:, None]
        window = np.cos(np.pi * off / (2 * reach + 2)) ** 2
        weights = np.sinc(off * scale) * window * scale
        out[at : at + len(place)] = (padded[base[:, None] + taps + reach + 1] * weights).sum(axis=1)
    return out.astype(x.dtype)


def loud_part(x: np.ndarray, top_db: float = 60.0) -> tuple[int, int]:
    """First and last sample of the frames within top_db of the loudest (root mean square over centred frames)."""
    if not len(x):
        return 0, 0
    padded = np.pad(np.asarray(x, np.float64), _FRAME // 2)
    starts = np.arange(0, 1 + len(x) // _HOP) * _HOP
    squares = np.concatenate([[0.0], np.cumsum(padded**2)])
    level = np.sqrt(np.maximum(squares[np.minimum(starts + _FRAME, len(padded))] - squares[starts], 0) / _FRAME)
    if level.max() <= 1e-10:
        return 0, 0
    live = np.flatnonzero(20 * np.log10(np.maximum(level, 1e-10) / level.max()) > -top_db)
    return int(live[0] * _HOP), int(min(len(x), (live[-1] + 1) * _HOP))


def trim_silence(x: np.ndarray, rate: int, top_db: float = 60.0, margin_ms: float = 120.0, pad_ms: float = 80.0) -> np.ndarray:
    start, end = loud_part(x, top_db)
    kept = x[start : min(len(x), end + int(rate * margin_ms / 1000))]
    return np.concatenate([kept, np.zeros(int(rate * pad_ms / 1000), x.dtype)])


def trim_interval(samples: Column, top_db: float = 60.0) -> Column:
    """{start, end} of the loud part (see loud_part); both null for a null array."""

    def interval(rows: pd.Series) -> pd.DataFrame:
        found = [(None, None) if x is None else loud_part(np.asarray(x), top_db) for x in rows]
        return pd.DataFrame(found, columns=["start", "end"], dtype="Int32")

    interval.__annotations__ = {"rows": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(interval, "struct<start: int, end: int>")(samples)


def _biquad(x: np.ndarray, b: tuple, a: tuple) -> np.ndarray:
    """A second-order filter, as its impulse response: both filters here decay within some thousand samples."""
    n = min(len(x), 16384)
    response = np.zeros(n)
    y1 = y2 = 0.0
    for k in range(n):
        y = (b[k] if k < 3 else 0.0) - a[1] * y1 - a[2] * y2
        response[k], y1, y2 = y, y, y1
    size = 1 << (len(x) + n - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(response, size), size)[: len(x)]


def loudness(x: np.ndarray, rate: int) -> float:
    """Integrated loudness in LUFS by ITU-R BS.1770: K-weighting, blocks of 400 ms by 100 ms, both gates; mono."""

    # The coefficients of the standard's two filters.
    def shelf() -> tuple[tuple, tuple]:
        gain, q, fc = 3.999843853973347, 0.7071752369554196, 1681.974450955533
        k, vh = np.tan(np.pi * fc / rate), 10 ** (gain / 20)
        vb, a0 = vh**0.4996667741545416, 1 + k / q + k * k
        return (
            ((vh + vb * k / q + k * k) / a0, 2 * (k * k - vh) / a0, (vh - vb * k / q + k * k) / a0),
            (1.0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0),
        )

    def highpass() -> tuple[tuple, tuple]:
        q, fc = 0.5003270373238773, 38.13547087602444
        k = np.tan(np.pi * fc / rate)
        a0 = 1 + k / q + k * k
        return (1.0, -2.0, 1.0), (1.0, 2 * (k * k - 1) / a0, (1 - k / q + k * k) / a0)

    y = _biquad(_biquad(np.asarray(x, np.float64), *shelf()), *highpass())
    size, hop = int(0.4 * rate), int(0.1 * rate)
    if len(y) < size:
        return -np.inf
    squares = np.concatenate([[0.0], np.cumsum(y * y)])
    starts = np.arange(0, len(y) - size + 1, hop)
    power = (squares[starts + size] - squares[starts]) / size
    level = lambda p: -0.691 + 10 * np.log10(np.maximum(p, 1e-20))
    heard = power[level(power) > -70]
    if not len(heard):
        return -np.inf
    heard = heard[level(heard) > level(heard.mean()) - 10]
    return float(level(heard.mean())) if len(heard) else -np.inf


def normalize(x: np.ndarray, rate: int, to: int = 22050, lufs: float = -23.0, level: float = 0.99, **trim) -> np.ndarray:
    """Mono, resampled, trimmed, brought to a loudness, clipped and scaled to a peak.

    The last step decides the level: loudness acts only where samples clip.
    """
    y = trim_silence(resample(mono(x), rate, to), to, **trim)
    now = loudness(y, to)
    if np.isfinite(now):
        y = y * 10 ** ((lufs - now) / 20)
    y = np.clip(y, -1.0, 1.0)
    top = float(np.abs(y).max(initial=0.0))
    return y / top * level if top > 0 else y


def read_wav(content: bytes) -> tuple[np.ndarray, int]:
    """Samples between -1 and 1 (frames, or frames by channels) and the rate of a PCM file of 8, 16 or 32 bits."""
    with wave.open(io.BytesIO(content)) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / (1 << (8 * width - 1))
    return (x.reshape(-1, channels) if channels > 1 else x), rate


def write_wav(x: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.clip(np.round(x * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def _headers(content: pd.Series) -> pd.DataFrame:
    def one(raw: bytes | None) -> tuple:
        try:
            with wave.open(io.BytesIO(raw or b"")) as f:
                rate, n = f.getframerate(), f.getnframes()
                return rate, f.getnchannels(), 8 * f.getsampwidth(), n, n / rate
        except (wave.Error, EOFError, ZeroDivisionError):
            return None, None, None, None, 0.0

    return pd.DataFrame([one(c) for c in content], columns=["sample_rate", "channels", "bits", "frames", "seconds"])


def wav_header(content: Column) -> Column:
    """Format and duration of PCM files; 0 seconds and nulls where one can't be read."""
    kind = "struct<sample_rate: int, channels: int, bits: int, frames: long, seconds: double>"
    return F.pandas_udf(_headers, kind)(content)
