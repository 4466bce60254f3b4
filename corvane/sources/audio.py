"""Audio files: WAV through the standard library, anything else through ffmpeg where it is installed."""

from __future__ import annotations

import hashlib
import json
import math
import os
import shutil
import subprocess
import wave
from collections.abc import Iterator

import numpy as np

from corvane.functions.dsp import MOST_SAMPLES, RATE

_BLOCK = 1 << 20


def file_hash(path: str) -> str:
    """SHA-256 in blocks; an error if the file changes meanwhile."""
    before, digest = os.stat(path), hashlib.sha256()
    with open(path, "rb") as file:
        while block := file.read(_BLOCK):
            digest.update(block)
    after = os.stat(path)
    if (before.st_size, before.st_mtime_ns) != (after.st_size, after.st_mtime_ns):
        raise OSError(f"{path} changed while it was read")
    return digest.hexdigest()


def resolve(audio: str, manifest: str) -> str:
    """A path relative to the manifest's folder; it must exist."""
    path = os.path.normpath(os.path.join(os.path.dirname(os.path.abspath(manifest)), audio))
    if not os.path.isfile(path):
        raise FileNotFoundError(path)
    return path


def info(path: str) -> dict:
    """sample_rate, channels and duration of the first audio stream."""
    if path.lower().endswith(".wav"):
        with wave.open(path) as file:
            found = {"sample_rate": file.getframerate(), "channels": file.getnchannels(), "duration": file.getnframes() / file.getframerate()}
    else:
        told = subprocess.run(
            ["ffprobe", "-v", "error", "-select_streams", "a:0", "-show_entries", "stream=sample_rate,channels:format=duration", "-of", "json", path],
            check=True, capture_output=True,
        ).stdout
        told = json.loads(told)
        stream = told["streams"][0]
        found = {"sample_rate": int(stream["sample_rate"]), "channels": int(stream["channels"]), "duration": float(told["format"]["duration"])}
    if not math.isfinite(found["duration"]) or found["duration"] <= 0:
        raise ValueError(f"{path} has no duration")
    return found


def _frames(path: str, start: float = 0.0, end: float | None = None) -> tuple[np.ndarray, int, int]:
    """A WAV file's span as frames by channels, its rate and bytes a sample."""
    with wave.open(path) as file:
        width, channels, rate = file.getsampwidth(), file.getnchannels(), file.getframerate()
        first, last = round(start * rate), file.getnframes() if end is None else round(end * rate)
        file.setpos(min(first, file.getnframes()))
        raw = file.readframes(max(last - first, 0))
    if width == 3:  # widened to four bytes
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        raw, width = wide.tobytes(), 4
    kinds = {1: (np.uint8, 128.0, 128.0), 2: (np.int16, 0.0, 32768.0), 4: (np.int32, 0.0, 2147483648.0)}
    if width not in kinds:
        raise ValueError(f"{path}: {8 * width}-bit samples aren't supported")
    kind, zero, full = kinds[width]
    return ((np.frombuffer(raw, kind).astype(np.float64) - zero) / full).reshape(-1, channels), rate, width


def cut(path: str, start: float, end: float, rate: int | None = None) -> tuple[np.ndarray, int, int]:
    """A span with all its channels (frames by channels), its rate and bytes a sample; resampled only to another `rate`."""
    if path.lower().endswith(".wav"):
        audio, own, width = _frames(path, start, end)
    else:
        if not shutil.which("ffmpeg"):
            raise RuntimeError("ffmpeg is needed for this file")
        told = info(path)
        own, width = told["sample_rate"], 4
        command = ["ffmpeg", "-nostdin", "-v", "error", "-ss", str(start), "-i", path, "-t", str(end - start), "-map", "0:a:0", "-vn", "-f", "s32le", "-"]
        raw = subprocess.run(command, check=True, capture_output=True).stdout
        audio = (np.frombuffer(raw, "<i4") / 2147483648.0).reshape(-1, told["channels"])
    if not len(audio) or abs(len(audio) / own - (end - start)) > 0.1:
        raise ValueError(f"{path}: {start} to {end} can't be cut")
    if rate is not None and rate != own:
        audio = np.stack([_resample(channel, own, rate) for channel in audio.T], axis=1)
    return audio, rate or own, max(width, 2)


def _resample(audio: np.ndarray, rate: int, to: int = RATE, skip: int = 0, count: int | None = None) -> np.ndarray:
    """`count` samples at the rate `to` from the frame `skip` on, through a windowed sinc that passes what both rates can hold."""
    if count is None:
        count = round((len(audio) - skip) * to / rate)
    if rate == to or not len(audio) or count <= 0:
        return audio[skip : skip + max(count, 0)].astype(np.float32)
    common = math.gcd(rate, to)
    phases, step = to // common, rate // common
    half = _half(rate, to)
    padded = np.pad(np.asarray(audio, np.float64), (half, half + 1 + max(0, skip + count * step // phases + 1 - len(audio))))
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * half + 1)
    cutoff = min(1.0, to / rate) * 0.95
    out = np.empty(count, np.float32)
    for phase in range(min(phases, count)):
        first, rest = divmod(phase * step, phases)
        away = np.arange(-half, half + 1) - rest / phases
        kernel = cutoff * np.sinc(cutoff * away) * np.cos(np.pi * np.clip(away / (half + 1), -1, 1) / 2) ** 2
        at = skip + first + step * np.arange(len(range(phase, count, phases)))
        for a in range(0, len(at), 1 << 15):
            out[phase::phases][a : a + (1 << 15)] = windows[at[a : a + (1 << 15)]] @ (kernel / kernel.sum())
    return out


def _half(rate: int, to: int) -> int:
    """Frames on each side of a sample that `_resample` reads."""
    return math.ceil(24 * max(1.0, rate / to))


def decode(path: str, start: float = 0.0, end: float | None = None) -> np.ndarray:
    """At most 30 s of mono float32 at 16 kHz; an error if it is empty, not finite or of another length than asked."""
    if path.lower().endswith(".wav"):
        told = info(path)
        rate, last = told["sample_rate"], told["duration"] if end is None else end
        # Only the span is read, and what the filter needs around it.
        first, around = round(start * rate), _half(rate, RATE)
        skip = min(first, around)
        audio, _, _ = _frames(path, (first - skip) / rate, min(last + around / rate, told["duration"]))
        clip = _resample(audio.mean(axis=1), rate, RATE, skip, min(round((last - start) * RATE), round((told["duration"] - start) * RATE)))
    else:
        if not shutil.which("ffmpeg"):
            raise RuntimeError("ffmpeg is needed for this file")
        last = info(path)["duration"] if end is None else end
        told = ["ffmpeg", "-v", "error", "-ss", str(start), "-t", str(last - start), "-i", path, "-map", "0:a:0", "-ac", "1", "-ar", str(RATE), "-f", "f32le", "-"]
        clip = np.frombuffer(subprocess.run(told, check=True, capture_output=True).stdout, "<f4")
    if not 0 < len(clip) <= MOST_SAMPLES or not np.isfinite(clip).all() or abs(len(clip) / RATE - (last - start)) > 0.1:
        raise ValueError(f"{path}: {start} to {last} can't be decoded")
    return clip


def stream(path: str, start: float = 0.0, end: float | None = None, block: int = 320_000) -> Iterator[np.ndarray]:
    """Consecutive blocks of at most `block` samples."""
    if not 0 < block <= MOST_SAMPLES:
        raise ValueError("a block holds 1 to 480000 samples")
    last = info(path)["duration"] if end is None else end
    for k in range(math.ceil((last - start) * RATE / block)):
        yield decode(path, start + k * block / RATE, min(last, start + (k + 1) * block / RATE))


def write_wav(path: str, audio: np.ndarray, rate: int, width: int = 2) -> None:
    """Mono samples, or frames by channels, of `width` bytes under a temporary name, then renamed."""
    full = 1 << (8 * width - 1)
    part = f"{path}.partial"
    with wave.open(part, "wb") as file:
        file.setnchannels(1 if audio.ndim == 1 else audio.shape[1])
        file.setsampwidth(width)
        file.setframerate(rate)
        file.writeframes(np.clip((np.asarray(audio, np.float64) * full).round(), -full, full - 1).astype(f"<i{width}").tobytes())
    os.replace(part, path)


def verify(path: str, expected: int, rate: int) -> tuple[int, int]:
    """(frames, channels) of a written clip, read whole; an error if the rate differs or the frames do by more than one."""
    found = info(path)
    frames = len(_frames(path)[0])
    if found["sample_rate"] != rate or abs(frames - expected) > 1:
        raise ValueError(f"{path}: {frames} frames at {found['sample_rate']} Hz, expected {expected} at {rate}")
    return frames, found["channels"]
