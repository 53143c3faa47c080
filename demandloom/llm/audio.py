"""Audio columns: 8-bit PCM in WAV form, polyphase resampling, log-mel filterbanks and energy segments.

Features are stored as fixed-shape Arrow tensors: the frames of a recording are cut into spans of
time of SPAN_FRAMES frames, each a tensor [SPAN_FRAMES, BANDS] of 32-bit or, on demand, half floats with its start and end in seconds. They are
rows of an Arrow stream, one stream a recording, in a Parquet column.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.common import materialise, slices, table

RATE, TARGET_RATE = 12_000, 8_000
#: 25 ms frames every 10 ms at the target rate, over 20 bands.
FRAME, HOP, BANDS, FFT = 200, 80, 20, 256
#: Frames of one tensor; a recording's last one is filled up with zeros.
SPAN_FRAMES = 32
#: A segment opens at OPEN dB above the text's quietest tenth and closes below CLOSE dB; it lasts SHORTEST frames at least.
OPEN, CLOSE, SHORTEST = 1.5, 0.5, 3
TAPS = 8
UNIT = 192
_WAV = struct.Struct("<4sI4s4sIHHIIHH4sI")


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file of unsigned 8-bit samples."""
    pad = len(samples) & 1
    return _WAV.pack(b"RIFF", 36 + len(samples) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples)) + samples + b"\0" * pad


def wav_samples(data: bytes) -> tuple[int, bytes]:
    """Rate and samples of a file that wav() made."""
    head = _WAV.unpack_from(data)
    if head[0] != b"RIFF" or head[2] != b"WAVE" or head[10] != 8:
        raise ValueError("not an 8-bit WAV file")
    return head[7], data[_WAV.size : _WAV.size + head[12]]


def payload(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text and its payload: UTF-8, padded with spaces to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b" " * (-len(raw) % UNIT if raw else UNIT)


@lru_cache(maxsize=8)
def _filter(up: int, down: int) -> np.ndarray:
    """[up, taps]: the phases of a windowed-sinc low-pass filter."""
    taps = TAPS * max(1, -(-down // up))
    x = (np.arange(up * taps) - (up * taps - 1) / 2) / up
    cut = min(1.0, up / down)
    h = cut * np.sinc(cut * x) * np.hanning(up * taps + 2)[1:-1]
    h = h.reshape(taps, up).T
    return (h / h.sum(axis=1, keepdims=True)).astype(np.float32)


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """Polyphase resampling by up/down: each output meets only the taps of its own phase."""
    phases = _filter(up, down)
    taps = phases.shape[1]
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.full(taps // 2, x[0], np.float32), x.astype(np.float32), np.full(taps + down, x[-1], np.float32)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, taps)
    out = np.empty(n, np.float32)
    for k in range(min(up, n)):  # outputs k, k + up, ... share a phase and advance by ``down`` inputs
        at = k * down
        rows = windows[at // up :: down][: -(-(n - k) // up)]
        out[k::up] = rows @ phases[at % up][::-1]
    return out


@lru_cache(maxsize=4)
def _mel(rate: int) -> np.ndarray:
    """[FFT // 2 + 1, BANDS] triangular filters, equally wide on the mel scale."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(60), mel(rate / 2), BANDS + 2) / 2595) - 1)
    freq = np.arange(FFT // 2 + 1) * rate / FFT
    up = (freq[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[2:] - freq[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


_WINDOW = np.hanning(FRAME).astype(np.float32)


def log_mel(x: np.ndarray, rate: int = TARGET_RATE) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel bands [frames, BANDS] and energies in dB of overlapped frames; short input is padded to one frame."""
    if len(x) < FRAME:
        x = np.concatenate([x, np.zeros(FRAME - len(x), np.float32)])
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    bands, energy = [], []
    for k in range(0, len(frames), 2048):
        part = frames[k : k + 2048] * _WINDOW
        power = np.abs(np.fft.rfft(part, FFT).astype(np.complex64)) ** 2
        bands.append(np.log(power @ _mel(rate) + 1e-6))
        energy.append(10 * np.log10((part * part).mean(axis=1) + 1e-9))
    return np.concatenate(bands), np.concatenate(energy)


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """[first, last) frames of stretches that open above one level and close below a lower one."""
    floor = np.sort(energy)[len(energy) // 10]
    mark = np.where(energy >= floor + OPEN, 1, np.where(energy < floor + CLOSE, -1, 0))
    turns = np.nonzero(mark)[0]
    on = np.zeros(len(energy), bool)
    if len(turns):
        last = np.searchsorted(turns, np.arange(len(energy)), "right") - 1
        on = (last >= 0) & (mark[turns[np.maximum(last, 0)]] > 0)
    edges = np.nonzero(np.diff(np.concatenate([[0], on.view(np.int8), [0]])))[0].reshape(-1, 2)
    return [(int(a), int(b)) for a, b in edges if b - a >= SHORTEST]


def features(data: bytes) -> tuple[np.ndarray, list[tuple[float, float]], float]:
    """Of a stored file: log-mel bands [frames, BANDS], time spans in seconds of its segments, and its duration."""
    rate, raw = wav_samples(data)
    x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    common = np.gcd(rate, TARGET_RATE)
    bands, energy = log_mel(resample(x - x.mean(dtype=np.float64).astype(np.float32), int(TARGET_RATE // common), int(rate // common)))
    step = HOP / TARGET_RATE
    return bands, [(a * step, (b - 1) * step + FRAME / TARGET_RATE) for a, b in segments(energy)], len(raw) / rate


def tensor_schema(dtype: str = "float32") -> pa.Schema:
    """Columns of the stored tensors; ``dtype`` is float32, or float16 for half the bytes and errors of up to 0.004 in a log-mel value."""
    return pa.schema([("frames", pa.fixed_shape_tensor(pa.from_numpy_dtype(np.dtype(dtype)), (SPAN_FRAMES, BANDS))), ("n_frames", pa.int32()), ("start", pa.float64()), ("end", pa.float64())])


def pack_tensors(bands: np.ndarray, dtype: str = "float32") -> bytes:
    """An Arrow stream of the tensors [SPAN_FRAMES, BANDS] of all frames, the frames that each holds, and its time span in seconds."""
    schema, n = tensor_schema(dtype), -(-len(bands) // SPAN_FRAMES)
    full = np.zeros((n * SPAN_FRAMES, BANDS), dtype)
    full[: len(bands)] = bands
    first = np.arange(n) * SPAN_FRAMES
    held = np.minimum(len(bands) - first, SPAN_FRAMES)
    frames = pa.ExtensionArray.from_storage(schema.field("frames").type, pa.FixedSizeListArray.from_arrays(pa.array(full.reshape(-1)), SPAN_FRAMES * BANDS))
    step = HOP / TARGET_RATE
    columns = [frames, pa.array(held, pa.int32()), pa.array(first * step), pa.array((first + held - 1) * step + FRAME / TARGET_RATE)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
    return sink.getvalue().to_pybytes()


def unpack_tensors(data: bytes) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """The frames [frames, BANDS] that pack_tensors stored, and the time span of each tensor."""
    found = pa.ipc.open_stream(data).read_all().combine_chunks()
    tensors = found["frames"].chunk(0).to_numpy_ndarray() if found.num_rows else np.zeros((0, SPAN_FRAMES, BANDS), np.float32)
    kept = np.arange(SPAN_FRAMES) < found["n_frames"].to_numpy()[:, None]
    return tensors[kept], list(zip(found["start"].to_pylist(), found["end"].to_pylist(), strict=True))


def write_audio(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "audio") -> DataFrame:
    """The written table (doc_id, n_bytes, media): every text's payload as a WAV file.

    A null text counts as empty (one unit of spaces); very long texts are stored whole; other columns, whatever their names, play no part; null ids and repeated rows keep their own row; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = [payload(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for n, _ in made], pa.int64()), pa.array([wav(p) for _, p in made], pa.binary())], names=["doc_id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return materialise(rows.mapInArrow(run, "doc_id long, n_bytes long, media binary"), label, "zstd")


def write_features(stored: DataFrame, label: str = "audio-features", dtype: str = "float32") -> DataFrame:
    """The written table of features of each stored file: digests, seconds, tensors (see pack_tensors) and spans of its segments in seconds.

    ``dtype`` is that of the tensors. Equal stored bytes give equal features: nothing else enters them. An empty table gives an empty one.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, seconds double, tensors binary, spans array<struct<start: double, end: double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            out: dict[str, list] = {k: [] for k in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "seconds", "tensors")}
            spans = []
            for value in batch.column("media"):
                data = value.as_py()
                raw = wav_samples(data)[1]
                bands, found, seconds = features(data)
                spans.append([{"start": a, "end": b} for a, b in found])
                for k, v in zip(out, (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-16:]), len(data), hashlib.sha256(data).hexdigest(), seconds, pack_tensors(bands, dtype)), strict=True):
                    out[k].append(v)
            span = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))
            columns = [batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(out[k], t) for k, t in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.binary()), strict=True)), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", *out, "spans"])

    return materialise(stored.mapInArrow(run, schema), label, "zstd")


def feature_digest(tensors: bytes) -> str:
    """A digest of stored tensors: SHA-256 of all frames."""
    return hashlib.sha256(unpack_tensors(tensors)[0].tobytes()).hexdigest()


def op8_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tensors are stored as half floats here, for the disk that whole tables take; the payload is stored losslessly."""
    found = write_features(write_audio(table(spark, sf_dir, "documents")), dtype="float16")

    @F.arrow_udf("string")
    def digest(tensors: pa.Array) -> pa.Array:
        return pa.array([feature_digest(x.as_py()) for x in tensors], pa.string())

    spans = F.sha2(F.to_json("spans").cast("binary"), 256)
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", F.concat_ws(":", F.size("spans").cast("string"), spans, digest("tensors")).alias("feature"))
