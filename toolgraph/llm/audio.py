"""Media columns: texts as 8-bit sound, and audio features as fixed-shape tensors with time spans.

A text's UTF-8 bytes, padded with spaces to a positive multiple of 192, are the samples of a WAV file (unsigned 8 bit, one channel, 12 kHz). Features are
computed from the samples read back out of that file: polyphase resampling to 8 kHz (up 2, down 3, 16 taps a phase), frames of 256 with a hop of 128 under a Hann window, log energies of 20 mel
bands, and segments by hysteresis (a segment opens where the frame's energy is half a deviation above the mean and closes where it falls under the mean). The log-mel
frames are cut into tiles of 16 x 20 (the last one padded with zeros) and stored as an Arrow stream of fixed_shape_tensor<float>[16, 20] rows with their start and end seconds.

All of it is computed in double precision; log energies are rounded to 1/1024 before they are stored and segments are cut by the rounded ones, so that
machines whose last bits differ agree.

Edge cases: a null or empty text is 192 spaces; repeated rows give equal rows; an empty table gives an empty one; the features take memory in proportion to one text.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

UNIT, RATE, UP, DOWN, TAPS, FRAME, HOP, MELS, TILE, STEP = 192, 12_000, 2, 3, 16, 256, 128, 20, 16, 1024
OUT_RATE = RATE * UP // DOWN
SCHEMA = "doc_id long, n_bytes long, media binary, samples binary, tensors binary, segments array<struct<start_s:double,end_s:double>>"


def wav(payload: bytes) -> bytes:
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def samples_of(media: bytes) -> np.ndarray:
    """The samples of a WAV file, found by its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while media[at : at + 4] != b"data":
        at += 8 + struct.unpack_from("<I", media, at + 4)[0]
    size = struct.unpack_from("<I", media, at + 4)[0]
    return np.frombuffer(media, np.uint8, size, at + 8)


def _filters() -> np.ndarray:
    """Windowed-sinc low-pass at the lower Nyquist rate, split in UP phases of TAPS."""
    n = np.arange(UP * TAPS) - (UP * TAPS - 1) / 2
    h = np.sinc(n / max(UP, DOWN)) * np.hanning(UP * TAPS + 2)[1:-1]
    phases = h.reshape(TAPS, UP).T
    return (phases / phases.sum(axis=1, keepdims=True))[:, ::-1]


def _mel_bank() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(60), mel(OUT_RATE / 2), MELS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(FRAME, 1 / OUT_RATE)[:, None]
    low, mid, high = edges[:-2], edges[1:-1], edges[2:]
    return np.maximum(0, np.minimum((f - low) / (mid - low), (high - f) / (high - mid)))


_PHASES, _BANK, _WINDOW = _filters(), _mel_bank(), np.hanning(FRAME)
TENSOR = pa.fixed_shape_tensor(pa.float32(), [TILE, MELS])
_TILES = pa.schema([("start_s", pa.float64()), ("end_s", pa.float64()), ("log_mel", TENSOR)])


def resample(x: np.ndarray) -> np.ndarray:
    """UP / DOWN polyphase: output n has phase n * DOWN mod UP at input n * DOWN // UP."""
    n_out = -(-len(x) * UP // DOWN)
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(x, (TAPS // 2, TAPS)), TAPS)
    out = np.empty(n_out)
    for first in range(UP):
        phase, at = first * DOWN % UP, first * DOWN // UP
        count = len(out[first::UP])
        out[first::UP] = windows[at : at + DOWN * count : DOWN][:count] @ _PHASES[phase]
    return out


def log_mel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log band energies (frames x MELS) and each frame's log energy; the last frame is padded with zeros."""
    count = max(1, -(-(len(y) - FRAME) // HOP) + 1)
    y = np.pad(y, (0, max(0, (count - 1) * HOP + FRAME - len(y))))
    mels, energies = [], []
    windows = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
    for i in range(0, count, 2048):
        spectrum = np.fft.rfft(windows[i : i + 2048] * _WINDOW)
        power = spectrum.real**2 + spectrum.imag**2
        mels.append(np.round(np.log(power @ _BANK + 1e-6) * STEP) / STEP)
        energies.append(np.round(np.log(power.sum(axis=1) + 1e-6) * STEP) / STEP)
    return np.concatenate(mels).astype(np.float32), np.concatenate(energies)


def segments(energy: np.ndarray) -> list[tuple[float, float]]:
    mean = energy.mean()
    vote = (energy > mean + 0.5 * energy.std()).astype(np.int8) - (energy < mean)
    last = np.maximum.accumulate(np.where(vote != 0, np.arange(1, len(vote) + 1), 0))
    on = np.concatenate([[0], np.where(last > 0, vote[last - 1], 0) > 0, [0]]).astype(np.int8)
    edge = np.flatnonzero(np.diff(on))
    return [(a * HOP / OUT_RATE, ((b - 1) * HOP + FRAME) / OUT_RATE) for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]


def tensors(mel: np.ndarray) -> bytes:
    tiles = -(-len(mel) // TILE)
    full = np.zeros((tiles * TILE, MELS), np.float32)
    full[: len(mel)] = mel
    start = np.arange(tiles) * TILE * HOP / OUT_RATE
    end = (np.minimum(np.arange(1, tiles + 1) * TILE, len(mel)) - 1) * HOP / OUT_RATE + FRAME / OUT_RATE
    values = pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), TILE * MELS)
    batch = pa.record_batch([pa.array(start), pa.array(end), pa.ExtensionArray.from_storage(TENSOR, values)], schema=_TILES)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _TILES) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


@lean
def media_rows(batches):
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.large_binary())
        out: list[tuple] = []
        held = begin = 0
        for i in range(len(batch)):
            text = texts[i].as_py() or b""
            media = wav(text + b" " * (max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text)))
            samples = samples_of(media)
            mel, energy = log_mel(resample(samples.astype(float) / 128 - 1))
            out.append((len(text), media, samples.tobytes(), tensors(mel), [{"start_s": a, "end_s": b} for a, b in segments(energy)]))
            held += len(media)
            if held > 4 << 20 or i + 1 == len(batch):
                span = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
                cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary(), span), strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(begin, i + 1 - begin), *cols], ["doc_id", "n_bytes", "media", "samples", "tensors", "segments"])
                out, held, begin = [], 0, i + 1


def media_columns(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, the WAV file, the samples read back out of it, the tensors' Arrow stream, and energy segments in seconds, of each row's whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(media_rows, SCHEMA)
