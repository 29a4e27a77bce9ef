"""Media columns: audio stored losslessly, resampled by a polyphase filter, as log-mel tensors with time spans.

``encode_audio`` turns payload bytes into WAV files of unsigned 8-bit samples. ``audio_features`` reads such
files back and returns the payload, log-mel tensors of one fixed shape with their time spans, and the spans
that a two-threshold (hysteresis) energy detector finds active. Tensors are stored as Arrow's fixed-shape tensor
type, which Spark has no column type for: the column holds an Arrow IPC stream with a row for each tensor and its time
span, which ``read_tensors`` opens. Both are one pass without a shuffle; a task holds one Arrow batch.

Every sample is analysed: the resampling filter is centred, so its last outputs still see the last samples; the signal is
zero-padded to whole frames; the frames' window has no zero ends. Spans end where the signal ends, not the padding.

Cases: a null text counts as empty; an empty payload is padded to one unit; equal payloads give equal values,
because every file is processed by itself; rows are never merged, so repeated rows and ids stay; null ids
stay null; a text of any length is one signal, analysed whole; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, id_and_bytes, rows_of
from lexloom.session import ship

UNIT = 64  # payloads are padded to a multiple of this
RATE = 8_000  # samples a second of the stored files
UP, DOWN = 3, 8  # resampled to 3 kHz
TAPS = 10  # filter taps per phase
FRAME, HOP = 256, 128  # half-overlapping frames, in resampled samples
MELS = 20
WINDOW = 16  # frames of one tensor
HIGH_DB, LOW_DB = 1.0, -1.0  # thresholds over the file's median frame energy

MEDIA_SCHEMA = "doc_id long, n_bytes long, media binary"
FEATURE_SCHEMA = (
    "doc_id long, n_bytes long, media binary, payload binary, n_tensors long, tensors binary, "
    "active_spans array<array<float>>, feature string"
)


def padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % UNIT or (UNIT if not raw else 0))


def to_wav(payload: bytes) -> bytes:
    """A mono WAV file of unsigned 8-bit samples, one sample per payload byte."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload


def from_wav(media: bytes) -> bytes:
    """The sample bytes of the file's data chunk, found by walking its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at = 12
    while at + 8 <= len(media):
        kind, length = struct.unpack_from("<4sI", media, at)
        if kind == b"data":
            return media[at + 8 : at + 8 + length]
        at += 8 + length + (length & 1)
    raise ValueError("a WAV file without data")


def resampling_filter() -> np.ndarray:
    """UP phases of a Hann-windowed sinc low-pass, each with TAPS taps and unit gain."""
    n = UP * TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / DOWN) * np.hanning(n + 2)[1:-1]
    phases = h.reshape(TAPS, UP).T
    return (phases / phases.sum(axis=1, keepdims=True)).astype(np.float32)


def mel_bank() -> np.ndarray:
    """Triangular mel filters, as bins x MELS."""
    bins = FRAME // 2 + 1
    hz = np.linspace(0, RATE * UP / DOWN / 2, bins)
    top = 2595 * math.log10(1 + hz[-1] / 700)
    edges = 700 * (10 ** (np.linspace(0, top, MELS + 2) / 2595) - 1)
    up = (hz[:, None] - edges[None, :-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[None, 2:] - hz[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


def resample(x: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """Output sample n lies at input time n*DOWN/UP, amid its taps, and needs only those of phase n*DOWN mod UP."""
    n_out = -(-len(x) * UP // DOWN)
    ahead = TAPS // 2
    x = np.concatenate([np.zeros(TAPS - 1 - ahead, np.float32), x, np.zeros(ahead + DOWN, np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(x, TAPS)
    out = np.empty(n_out, np.float32)
    for r in range(min(UP, n_out)):
        count = len(range(r, n_out, UP))
        first, phase = divmod(r * DOWN, UP)
        out[r::UP] = windows[first : first + (count - 1) * DOWN + 1 : DOWN] @ phases[phase, ::-1]
    return out


def frame_window() -> np.ndarray:
    """A Hann window without its zero ends, which would drop a signal's first and last sample."""
    return np.hanning(FRAME + 2)[1:-1].astype(np.float32)


def framed(y: np.ndarray) -> np.ndarray:
    """Half-overlapping frames over all of y, the last one zero-padded."""
    short = FRAME - len(y) if len(y) < FRAME else -(len(y) - FRAME) % HOP
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([y, np.zeros(short, np.float32)]), FRAME)[::HOP]


def active_spans(energy: np.ndarray, end: float = math.inf) -> list[list[float]]:
    """Runs of frames above the low threshold that hold a frame above the high one, in seconds, up to the signal's end."""
    level = energy - np.median(energy)
    over = np.concatenate([[0], (level > LOW_DB).view(np.int8), [0]])
    edges = np.flatnonzero(np.diff(over))
    hop = HOP * DOWN / UP / RATE
    length = FRAME * DOWN / UP / RATE
    return [[a * hop, min(end, (b - 1) * hop + length)] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if level[a:b].max() > HIGH_DB]


def analyse(payload: bytes, phases: np.ndarray, bank: np.ndarray, hann: np.ndarray):
    x = (np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128
    frames = framed(resample(x, phases)) * hann
    power = np.abs(np.fft.rfft(frames, axis=1)).astype(np.float32) ** 2
    mel = np.log10(power @ bank + 1e-6)
    energy = 10 * np.log10((frames**2).mean(axis=1) + 1e-9)
    n = len(mel)
    windows = -(-n // WINDOW)
    filled = np.zeros((windows * WINDOW, MELS), np.float32)
    filled[:n] = mel
    hop = WINDOW * HOP * DOWN / UP / RATE
    end = len(payload) / RATE
    times = [[w * hop, end if w == windows - 1 else (w + 1) * hop] for w in range(windows)]
    active = active_spans(energy, end)
    means, spread = mel.mean(axis=0), mel.std(axis=0)
    feature = f"frames={n};active={len(active)};seconds={sum(b - a for a, b in active):.3f};mean={','.join(f'{v:.3f}' for v in means)};std={','.join(f'{v:.3f}' for v in spread)}"
    return filled.reshape(windows, WINDOW, MELS), times, active, feature


@frugal
def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, media = [], [], []
        for doc_id, raw in rows_of(batch, "doc_id", "raw"):
            ids.append(doc_id)
            sizes.append(len(raw or b""))
            media.append(to_wav(padded(raw or b"")))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


@frugal
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phases, bank, hann = resampling_filter(), mel_bank(), frame_window()
    nested = pa.list_(pa.list_(pa.float32()))
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            payloads, counts, stored, active, features = [], [], [], [], []
            for (media,) in rows_of(part, "media"):
                payload = from_wav(media)
                tensors, times, spans, feature = analyse(payload, phases, bank, hann)
                payloads.append(payload)
                counts.append(len(tensors))
                stored.append(write_tensors(tensors, times))
                active.append(spans)
                features.append(feature)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(payloads, pa.binary()), pa.array(counts, pa.int64()), pa.array(stored, pa.binary()), pa.array(active, nested), pa.array(features, pa.string())],
                ["doc_id", "n_bytes", "media", "payload", "n_tensors", "tensors", "active_spans", "feature"],
            )


def encode_audio(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each text's UTF-8 bytes, zero-padded, as a WAV file."""
    ship(docs.sparkSession)
    return id_and_bytes(docs, id_col, text_col).mapInArrow(_encode, MEDIA_SCHEMA)


def audio_features(media: DataFrame) -> DataFrame:
    """Payload read back, stored tensors (each WINDOW x MELS) with their time spans, active spans, a digest."""
    ship(media.sparkSession)
    return media.mapInArrow(_features, FEATURE_SCHEMA)


TENSORS = pa.schema([("tensor", pa.fixed_shape_tensor(pa.float32(), (WINDOW, MELS))), ("start", pa.float64()), ("end", pa.float64())])


def write_tensors(tensors: np.ndarray, times: list[list[float]]) -> bytes:
    """Tensors and their time spans as an Arrow IPC stream."""
    storage = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(tensors).reshape(-1)), WINDOW * MELS)
    batch = pa.RecordBatch.from_arrays([pa.ExtensionArray.from_storage(TENSORS.field("tensor").type, storage), *(pa.array([t[i] for t in times], pa.float64()) for i in (0, 1))], schema=TENSORS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, TENSORS) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def read_tensors(stored: bytes) -> pa.Table:
    """tensor (fixed shape), start and end in seconds."""
    return pa.ipc.open_stream(stored).read_all()


def op9_audio(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    got = audio_features(encode_audio(table(spark, sf_dir, "documents")))
    return got.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -UNIT, UNIT)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "n_tensors",
        F.sha2("tensors", 256).alias("tensors_sha256"),
        "active_spans",
    )
