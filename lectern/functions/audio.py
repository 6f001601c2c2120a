"""Audio in Python: WAV bytes, spectra, resampling. Arrow-batched column functions at the end."""

from __future__ import annotations

import io
import struct
import wave
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

HEADER = T.StructType([T.StructField(n, t) for n, t in (("frames", T.LongType()), ("samplerate", T.IntegerType()), ("channels", T.IntegerType()), ("subtype", T.StringType()), ("duration", T.DoubleType()), ("error", T.StringType()))])


def wav_header(data: bytes | None) -> tuple:
    """Frames, rate, channels, subtype, duration and error of RIFF bytes."""
    if data is None:
        return (None, None, None, None, None, "missing_wav")
    try:
        if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
            raise ValueError("no RIFF header")
        at, form, size = 12, None, None
        while at + 8 <= len(data):
            name, length = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
            if name == b"fmt ":
                form = struct.unpack_from("<HHIIHH", data, at + 8)
            elif name == b"data":
                size = min(length, len(data) - at - 8)
                break
            at += 8 + length + (length & 1)
        if form is None or size is None:
            raise ValueError("no format or data")
        code, channels, rate, _, block, bits = form
        if not block or not rate:
            raise ValueError("no rate")
        subtype = {1: f"PCM_{bits}" if bits != 8 else "PCM_U8", 3: "FLOAT" if bits == 32 else "DOUBLE"}.get(code, f"FORMAT_{code}")
        return (size // block, rate, channels, subtype, size // block / rate, None)
    except (ValueError, struct.error):
        return (None, None, None, None, None, "invalid_audio")


def wav_bytes(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit WAV of int16 samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.asarray(samples, dtype="<i2").tobytes())
    return out.getvalue()


def wav_samples(data: bytes) -> np.ndarray:
    with wave.open(io.BytesIO(data)) as w:
        return np.frombuffer(w.readframes(w.getnframes()), dtype="<i2").reshape(-1, w.getnchannels()).mean(axis=1).astype("<i2")


def join_wavs(parts: list[bytes]) -> bytes:
    """One WAV of several; parts of another rate than the first are resampled."""
    rates = [wav_header(p)[1] for p in parts]
    samples = [wav_samples(p) if r == rates[0] else resample(wav_samples(p).astype(float), r, rates[0]).astype("<i2") for p, r in zip(parts, rates)]
    return wav_bytes(np.concatenate(samples), rates[0])


def resample(x: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Linear interpolation, an approximation of a filter-based resampler."""
    n = int(round(len(x) * wanted / rate))
    return np.interp(np.arange(n) * (rate / wanted), np.arange(len(x)), x) if len(x) and n else np.zeros(n)


@lru_cache(maxsize=8)
def _window(size: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2.0 * np.pi * np.arange(size) / size)


def stft_magnitude(x: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """Frames by bins of ``sqrt(re^2 + im^2 + 1e-6)`` with reflected edges and a Hann window."""
    pad = (n_fft - hop) // 2
    y = np.pad(np.asarray(x, dtype=float), pad, mode="reflect")
    rows = np.lib.stride_tricks.sliding_window_view(y, n_fft)[::hop] * _window(n_fft)
    z = np.fft.rfft(rows, axis=1)
    return np.sqrt(z.real**2 + z.imag**2 + 1e-6)


@lru_cache(maxsize=8)
def mel_filters(rate: int, n_fft: int, n_mels: int, low: float, high: float) -> np.ndarray:
    """Area-normalised triangles on the mel scale that is linear below 1 kHz."""
    to_mel = lambda f: np.where(f < 1000.0, f * 3.0 / 200.0, 15.0 + np.log(np.maximum(f, 1000.0) / 1000.0) * 27.0 / np.log(6.4))
    to_hz = lambda m: np.where(m < 15.0, m * 200.0 / 3.0, 1000.0 * np.exp((m - 15.0) * np.log(6.4) / 27.0))
    edges = to_hz(np.linspace(to_mel(np.array(low)), to_mel(np.array(high)), n_mels + 2))
    bins = np.arange(n_fft // 2 + 1) * rate / n_fft
    up = (bins - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - bins) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0.0, np.minimum(up, down)) * (2.0 / (edges[2:] - edges[:-2]))[:, None]


def log_mel(magnitude: np.ndarray, filters: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(magnitude @ filters.T, 1e-5))


@F.pandas_udf(HEADER)
def header(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([wav_header(x) for x in content], columns=[f.name for f in HEADER.fields])


@F.pandas_udf(T.BinaryType())
def pcm_bytes(samples: pd.Series) -> pd.Series:
    """Little-endian bytes of int16 samples."""
    return samples.map(lambda a: None if a is None else np.asarray(a, dtype="<i2").tobytes())


def as_wav(rate: int):
    @F.pandas_udf(T.BinaryType())
    def run(samples: pd.Series) -> pd.Series:
        return samples.map(lambda a: None if a is None else wav_bytes(np.asarray(a), rate))

    return run


def stft(n_fft: int, hop: int):
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(audio: pd.Series) -> pd.Series:
        return audio.map(lambda a: None if a is None or len(a) <= (n_fft - hop) // 2 else stft_magnitude(a, n_fft, hop).tolist())

    return run


def mel(rate: int, n_fft: int, hop: int, n_mels: int):
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(audio: pd.Series) -> pd.Series:
        filters = mel_filters(rate, n_fft, n_mels, 0.0, rate / 2)
        return audio.map(lambda a: None if a is None or len(a) <= (n_fft - hop) // 2 else log_mel(stft_magnitude(a, n_fft, hop), filters).tolist())

    return run


def resampled(rate: int, wanted: int):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(audio: pd.Series) -> pd.Series:
        return audio.map(lambda a: None if a is None else resample(np.asarray(a, dtype=float), rate, wanted).tolist())

    return run
