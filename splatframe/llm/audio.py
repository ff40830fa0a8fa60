"""Audio features: 8-bit PCM clips, polyphase resampling, overlapped log-mel filterbanks, hysteresis segments.

A clip's bytes are kept losslessly as unsigned 8-bit mono samples in a RIFF/WAVE file. From the samples read
back: resampling by 3/4 with a windowed-sinc polyphase filter, log-mel energies of overlapping frames, and the
spans where the frame energy rises above a high threshold and stays above a low one. Energies are stored as Arrow
fixed-shape tensors of FRAMES x MELS values (one record batch in Arrow's stream format per clip) with their time
spans; a clip's last tensor is filled up with the log floor and its span ends with the clip.

Null and empty inputs are clips of one padding unit. Every clip is worked on alone and in blocks of frames, so
equal clips have equal features, and memory for the transforms does not grow with a clip's length.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.llm.common import table, text_bytes

RATE, UP, DOWN, TAPS = 16_000, 3, 4, 16
WINDOW, HOP, FFT, MELS, FRAMES = 400, 160, 512, 24, 64
UNIT = 192
BLOCK_FRAMES = 4096
FLOOR = 1e-8
SCHEMA = "doc_id long, n_bytes long, media binary, tensors binary, segments array<struct<start_s:double,end_s:double>>"
BATCH_BYTES = 16 << 20


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """Unsigned 8-bit mono PCM; an odd number of samples gets the format's pad byte."""
    pad = len(payload) % 2
    return b"RIFF" + struct.pack("<I", 36 + len(payload) + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload + bytes(pad)


def from_wav(media: bytes) -> tuple[bytes, int]:
    """Samples and rate of a file that to_wav() wrote; other chunks are skipped."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            form, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (form, channels, bits) != (1, 1, 8):
                raise ValueError("not 8-bit mono PCM")
        if name == b"data":
            return media[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _filters() -> np.ndarray:
    """UP phases of TAPS taps: a low pass below both rates' limits, each phase with gain 1."""
    n = np.arange(UP * TAPS) - (UP * TAPS - 1) / 2
    h = np.sinc(n / DOWN) * np.hanning(UP * TAPS + 2)[1:-1]
    phases = h.reshape(TAPS, UP).T
    return phases / phases.sum(1, keepdims=True)


def _mel_bank(rate: float) -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(60), mel(rate / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1) * rate / FFT
    up, down = (f - edges[:-2, None]) / np.diff(edges)[:-1, None], (edges[2:, None] - f) / np.diff(edges)[1:, None]
    return np.maximum(0, np.minimum(up, down)).T


PHASES, BANK, HANN = _filters(), _mel_bank(RATE * UP / DOWN), np.hanning(WINDOW + 1)[:-1]


def resampled(x: np.ndarray, first: int, last: int) -> np.ndarray:
    """Samples first..last-1 of x (8-bit codes) at UP/DOWN of its rate; silence surrounds x."""
    out = np.zeros(last - first)
    for phase in range(UP):
        m = np.arange(first + (phase - first) % UP, last, UP)
        if len(m):
            start = int(m[0] * DOWN // UP) - TAPS // 2
            need = start + DOWN * (len(m) - 1) + TAPS
            span = np.zeros(need - start)
            a, b = max(start, 0), min(need, len(x))
            if b > a:
                span[a - start : b - start] = (x[a:b].astype(np.float64) - 128) / 128
            y = np.zeros(len(m))
            for k in range(TAPS):
                y += PHASES[(phase * DOWN) % UP, TAPS - 1 - k] * span[k : k + DOWN * (len(m) - 1) + 1 : DOWN]
            out[m[0] - first :: UP] = y
    return out


def log_mel(samples: bytes) -> np.ndarray:
    """(frames, MELS) float32 in natural log units; the last frame is filled up with silence."""
    x = np.frombuffer(samples, np.uint8)
    total = -(-len(x) * UP // DOWN)
    frames = 1 + max(0, -(-(total - WINDOW) // HOP))
    out = np.empty((frames, MELS), np.float32)
    for f in range(0, frames, BLOCK_FRAMES):
        g = min(frames, f + BLOCK_FRAMES)
        y = resampled(x, f * HOP, (g - 1) * HOP + WINDOW)
        cut = np.lib.stride_tricks.sliding_window_view(y, WINDOW)[::HOP] * HANN
        power = np.abs(np.fft.rfft(cut, FFT)) ** 2
        out[f:g] = np.log(np.maximum(power @ BANK, FLOOR))
    return out


def hysteresis(energy: np.ndarray) -> list[tuple[int, int]]:
    """Runs of frames at or above the low threshold that reach the high one; both follow the clip's own energies."""
    mean, spread = float(energy.mean()), float(energy.std())
    on = np.flatnonzero(np.diff(np.concatenate([[0], energy >= mean - 0.25 * spread, [0]]).astype(np.int8)))
    high = np.concatenate([[0], np.cumsum(energy >= mean + 0.5 * spread)])
    return [(int(a), int(b)) for a, b in zip(on[::2], on[1::2], strict=True) if high[b] > high[a]]


def tensors(mel: np.ndarray, seconds: float) -> bytes:
    """Arrow stream: fixed-shape tensors with the time span of each."""
    hop_s, n = HOP * DOWN / UP / RATE, -(-len(mel) // FRAMES)
    full = np.full((n * FRAMES, MELS), np.log(FLOOR), np.float32)
    full[: len(mel)] = mel
    kind = pa.fixed_shape_tensor(pa.float32(), [FRAMES, MELS])
    values = pa.ExtensionArray.from_storage(kind, pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), FRAMES * MELS))
    starts = np.arange(n) * FRAMES * hop_s
    batch = pa.record_batch([values, pa.array(starts), pa.array(np.minimum(starts + ((FRAMES - 1) * HOP + WINDOW) * DOWN / UP / RATE, seconds))], names=["log_mel", "start_s", "end_s"])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def read_tensors(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def payload_of(text: str | None) -> tuple[bytes, int]:
    data = text_bytes(text)
    return data + b" " * (max(1, -(-len(data) // UNIT)) * UNIT - len(data)), len(data)


def audio_features(docs: DataFrame) -> DataFrame:
    """One row per clip: the stored file, its tensors with time spans, and its segments in seconds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hop_s = HOP * DOWN / UP / RATE
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))]
        names = ["doc_id", "n_bytes", "media", "tensors", "segments"]
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                payload, n = payload_of(text.as_py())
                media = to_wav(payload)
                samples, rate = from_wav(media)
                mel, seconds = log_mel(samples), len(samples) / rate
                segments = [{"start_s": a * hop_s, "end_s": min(seconds, (b - 1) * hop_s + WINDOW * DOWN / UP / rate)} for a, b in hysteresis(mel.mean(1))]
                rows.append((doc, n, media, tensors(mel, seconds), segments))
                size += 2 * len(media)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def digests(features: DataFrame) -> DataFrame:
    """What the stored files and tensors hold, read back from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n, media, data, segments in zip(*(batch.column(i) for i in range(5)), strict=True):
                media = media.as_py()
                payload, _ = from_wav(media)
                t = read_tensors(data.as_py())
                values = t.column("log_mel").combine_chunks()
                values = values.storage if isinstance(values, pa.ExtensionArray) else values.chunk(0).storage
                codes = np.rint(np.asarray(values.flatten()) * 8).astype("<i2")
                marks = [round(1000 * s[k]) for s in segments.as_py() for k in ("start_s", "end_s")]
                feature = f"{t.num_rows}x{FRAMES}x{MELS}:{len(marks) // 2}:{hashlib.sha256(codes.tobytes() + np.array(marks, '<i8').tobytes()).hexdigest()[:32]}"
                out.append((doc.as_py(), n.as_py(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            c = list(zip(*out, strict=True)) if out else [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(c, kinds, strict=True)], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return features.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(audio_features(table(spark, sf_dir, "documents")))
