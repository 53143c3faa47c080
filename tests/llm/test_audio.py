import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from demandloom.llm import audio


def test_polyphase_resampling_keeps_a_sine():
    x = np.sin(2 * np.pi * 500 * np.arange(12_000) / 12_000).astype(np.float32)
    y = audio.resample(x, 2, 3)
    want = np.sin(2 * np.pi * 500 * (np.arange(8_000) - 0.5) / 8_000)  # the filter's even length delays by half a sample
    assert len(y) == 8_000 and np.abs(y[100:-100] - want[100:-100]).max() < 1e-3
    high = np.sin(2 * np.pi * 5_500 * np.arange(12_000) / 12_000).astype(np.float32)  # above the new Nyquist frequency
    assert np.abs(audio.resample(high, 2, 3)[100:-100]).max() < 0.02


def test_mel_peak_and_hysteresis():
    t = np.arange(8_000) / 8_000
    bands, _ = audio.log_mel(np.sin(2 * np.pi * 1_000 * t).astype(np.float32))
    edges = 700 * (10 ** (np.linspace(2595 * np.log10(1 + 60 / 700), 2595 * np.log10(1 + 4_000 / 700), audio.BANDS + 2) / 2595) - 1)
    assert set(bands.argmax(axis=1)) == {int(np.abs(edges[1:-1] - 1_000).argmin())} and len(bands) == (8_000 - audio.FRAME) // audio.HOP + 1
    energy = np.array([0, 0, 0, 0, 3, 1, 1, 1, 0, 1, 1, 1, 2, 2, 0, 0, 0, 2, 0, 0.0])
    assert audio.segments(energy) == [(4, 8)]  # [12, 14) and [17, 18) are too short, and 1 alone opens none


def test_files_round_trip(spark):
    rows = [(1, "héllo"), (2, None), (3, ""), (4, "x" * 192), (5, "y" * 100_000), (5, "y" * 100_000), (None, "\U0001f600 end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit(b"clash"))
    stored = audio.write_audio(docs)
    got = audio.write_features(stored).collect()
    want = sorted(hashlib.sha256(audio.payload(t)[1]).hexdigest() for _, t in rows)
    assert sorted(r.payload_sha256 for r in got) == want
    for r in got:
        assert r.payload_bytes % 192 == 0 and r.payload_bytes >= 192 and r.n_bytes <= r.payload_bytes
    one = next(r for r in got if r.doc_id == 3)
    assert one.tail_crc32 == zlib.crc32(b" " * 16) and one.n_bytes == 0
    a, b = (r for r in got if r.doc_id == 5)
    assert a == b
    assert audio.write_features(audio.write_audio(docs.limit(0))).count() == 0


def test_stored_tensors_have_a_fixed_shape_and_all_frames(spark):
    table = pa.ipc.open_stream(audio.pack_tensors(np.zeros((70, audio.BANDS), np.float32))).read_all()
    assert isinstance(table.schema.field("frames").type, pa.FixedShapeTensorType) and table.schema.field("frames").type.shape == [audio.SPAN_FRAMES, audio.BANDS] and len(table) == 3
    text = "some words of a text " * 900
    row = audio.write_features(audio.write_audio(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    frames, spans = audio.unpack_tensors(bytes(row.tensors))
    want, found, seconds = audio.features(audio.wav(audio.payload(text)[1]))
    assert np.array_equal(frames, want) and frames.dtype == np.float32 and [(s.start, s.end) for s in row.spans] == found and row.seconds == seconds
    assert spans[0][0] == 0 and abs(spans[-1][1] - seconds) < 0.03 and all(b > a for a, b in spans)


def test_half_floats_on_demand_stay_within_the_stated_error(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    error = 0.0
    for text in texts:
        want = audio.features(audio.wav(audio.payload(text)[1]))[0]
        frames = audio.unpack_tensors(audio.pack_tensors(want, "float16"))[0]
        assert frames.dtype == np.float16 and frames.shape == want.shape
        error = max(error, float(np.abs(frames.astype(np.float32) - want).max()))
    assert 0 < error <= 0.004


def test_log_mel_against_a_direct_transform():
    """Every step by its definition: convolution with the filter's phases, a sum of sines, triangles over mel."""
    x = (np.frombuffer(audio.payload("Direct sums are slow, but right. " * 20)[1], np.uint8).astype(np.float64) - 128) / 128
    up, down = 2, 3
    taps = audio._filter(up, down).astype(np.float64)
    size = taps.shape[1]
    padded = np.concatenate([np.full(size // 2, x[0]), x, np.full(size + down, x[-1])])
    direct = [sum(padded[n * down // up + i] * taps[n * down % up][size - 1 - i] for i in range(size)) for n in range(-(-len(x) * up // down))]
    got = audio.resample(x.astype(np.float32), up, down)
    assert np.abs(got - direct).max() < 1e-5
    bands, energy = audio.log_mel(got)
    for k in (0, len(bands) // 2, len(bands) - 1):
        frame = got[k * audio.HOP : k * audio.HOP + audio.FRAME].astype(np.float64) * np.hanning(audio.FRAME)
        n = np.arange(audio.FRAME)
        power = np.array([abs((frame * np.exp(-2j * np.pi * f * n / audio.FFT)).sum()) ** 2 for f in range(audio.FFT // 2 + 1)])
        mel = np.linspace(2595 * np.log10(1 + 60 / 700), 2595 * np.log10(1 + audio.TARGET_RATE / 2 / 700), audio.BANDS + 2)
        hz = 700 * (10 ** (mel / 2595) - 1)
        weights = [[max(0.0, min((f - a) / (b - a), (c - f) / (c - b))) for f in np.arange(audio.FFT // 2 + 1) * audio.TARGET_RATE / audio.FFT] for a, b, c in zip(hz, hz[1:], hz[2:], strict=False)]
        assert np.abs(bands[k] - np.log(np.array(weights) @ power + 1e-6)).max() < 1e-3
        assert abs(energy[k] - 10 * np.log10((frame**2).mean() + 1e-9)) < 1e-3


def test_query_against_its_parts(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in audio.op8_audio_features(spark, sf).collect():
        n, payload = audio.payload(texts[r.doc_id])
        data = audio.wav(payload)
        frames, found, _ = audio.features(data)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r.media_bytes, r.media_sha256) == (len(data), hashlib.sha256(data).hexdigest())
        count, _, digest = r.feature.split(":")
        assert int(count) == len(found) and digest == hashlib.sha256(frames.astype("<f2").tobytes()).hexdigest()
