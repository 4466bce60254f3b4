"""Golden values of text measures, hashes and signal functions."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.functions import dsp, numeric, text
from corvane.functions.hashing import canonical, seeded, split, threshold
from corvane.sources import audio


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_normalize(spark):
    assert one(spark, text.normalize(F.col("t"), F.lit("tr")), t="I İ ı i; ISPARTA İZMİR") == "ı i ı i ısparta izmir"
    assert one(spark, text.normalize(F.col("t"), F.lit("en")), t="ＡＢＣ café") == "abc café"
    assert one(spark, text.turkish_reference(F.col("t")), t=" IŞIK, İSTANBUL'da 2026! ") == "ışık istanbulda 2026"


@pytest.mark.parametrize(
    ("language", "r", "h", "cer", "wer"),
    [
        ("tr", "İYİ BİR IŞIK", "iyi bir ışık", 0.0, 0.0),
        ("zh", "你好世界", "你好世", 0.25, None),
        ("ja", "こんにちは", "こんちは", 0.2, None),
        ("en", "one two", "one three four", None, 1.0),
    ],
)
def test_agreement(spark, language, r, h, cer, wer):
    rows = spark.createDataFrame([(r, h)], "r string, h string").select(*[text.normalize(F.col(c), F.lit(language)).alias(c) for c in "rh"])
    found = rows.select(text.agreement(F.col("r"), F.col("h"), F.lit(language)).alias("a")).first()["a"]
    assert cer is None or found["reference_cer"] == cer
    assert found["reference_wer"] == wer


def test_word_errors_against_brute_force(spark):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    rng = np.random.default_rng(1)
    pairs = [tuple(" ".join(rng.choice(list("abcdefg"), rng.integers(1, 9))) for _ in range(2)) for _ in range(60)]
    found = spark.createDataFrame(pairs, "r string, h string").select("r", "h", text.wer(F.col("r"), F.col("h")).alias("w")).collect()
    assert all(math.isclose(x["w"], edits(x["r"].split(), x["h"].split()) / len(x["r"].split())) for x in found)


def test_hashes(spark):
    assert one(spark, seeded("7", F.col("k")), k="a") == hashlib.sha256(b"7\0a").hexdigest()
    for share in (0.7, 0.85, 0.9, 0.9 + 0.05, 1.0):
        n = int(threshold(share), 16)
        assert n / 2**256 >= share > (n - 1) / 2**256
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(3000)]
    got = [r["s"] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(split(F.col("k")).alias("s")).collect()]
    ratio = [int(k, 16) / 2**256 for k in keys]
    assert got == ["train" if r < 0.9 else "validation" if r < 0.9 + 0.05 else "test" for r in ratio]
    assert canonical({"b": 1, "a": "é"}) == '{"a": "é", "b": 1}'
    with pytest.raises(ValueError):
        canonical(float("nan"))


def test_finite_and_calibration(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r["f"] for r in rows.select(numeric.finite(F.col("v")).alias("f")).collect()] == [1.0, None, None, None]
    got = [one(spark, numeric.polynomial(F.col("v").cast("double"), c), v=str(v)) for v, c in zip((3, 4, 5), numeric.CALIBRATION.values(), strict=True)]
    assert np.allclose(got, (2.91200747, 3.93387302, 3.931778), atol=1e-7)


def test_signals_and_windows():
    silent = dsp.signals(np.zeros(100, np.float32))
    assert silent["rms_dbfs"] == -240.0 and silent["silent"]
    assert len(dsp.score_windows(np.ones(160_000))) == 1
    scores = dsp.perceptual_scores(np.ones(16_000), lambda w: (3, 4, 5))
    assert np.allclose(list(scores.values()), (2.91200747, 3.93387302, 3.931778))
    assert [len(dsp.speaker_windows(np.ones(s * 16_000))) for s in (6, 2, 1)] == [2, 2, 1]
    with pytest.raises(ValueError):
        dsp.checked(np.array([np.nan], np.float32))


def test_ctc_is_optimal():
    assert dsp.ctc_viterbi(np.zeros((3, 2)), [1, 1]) == [0, -1, 1]
    assert dsp.ctc_viterbi(np.zeros((2, 2)), [1, 1]) is None
    assert dsp.ctc_viterbi(np.zeros((3, 2)), []) is None
    for scores, tokens in ((np.full((3, 2), np.nan), [1]), (np.zeros((3, 2)), [0]), (np.zeros((3, 2)), [2])):
        with pytest.raises(ValueError):
            dsp.ctc_viterbi(scores, tokens)
    rng = np.random.default_rng(0)
    for tokens in ([1], [1, 2], [1, 2, 1, 2, 1], [2, 2, 1], [1, 1], [2, 1]):
        scores = dsp.log_softmax(rng.normal(size=(5, 3)))

        def fits(path, tokens=tokens):
            return [k for k, _ in itertools.groupby(path) if k] == tokens

        best = max(sum(scores[t, k] for t, k in enumerate(p)) for p in itertools.product(range(3), repeat=5) if fits(p))
        path = dsp.ctc_viterbi(scores, tokens)
        assert math.isclose(sum(scores[t, tokens[k] if k >= 0 else 0] for t, k in enumerate(path)), best)


def test_word_spans_and_alignment():
    path = [-1, 0, -1, -1, -1, 2, 2]
    spans = dsp.word_spans(path, ["a", "b"], [1, 1], 320)
    assert [(s["start"], s["end"]) for s in spans] == [(0.02, 0.04), (0.1, 0.14)]
    units = [{"text": "a", "start": 0.5, "end": 0.5}, {"text": "b", "start": 0.5, "end": 1.0}]
    found = dsp.aligned(2, units, 1.0)
    assert found["alignment_status"] == "review" and found["alignment_coverage"] == 0.5


def test_fbank_shape_and_floor():
    features = dsp.fbank(np.sin(np.arange(16_000) * 0.1))
    assert features.shape == (101, 80) and features.min() >= features.max() - 80
    assert np.allclose(dsp.mean_normalize(features).mean(axis=0), 0)


def test_word_errors_around_the_surrogates(spark, monkeypatch):
    monkeypatch.setattr(text, "_FIRST", 0xD7F0)
    many = " ".join(f"w{i}" for i in range(60))
    row = spark.createDataFrame([(many, many + " more")], "r string, h string")
    assert row.select(text.wer(F.col("r"), F.col("h"))).first()[0] == 1 / 60


@pytest.mark.parametrize("rate", [44_100, 48_000])
def test_resampling_keeps_low_tones_and_stops_high_ones(tmp_path, rate):
    seconds = 21
    for hz, level in ((1000, 0.5), (15_000, 0.0)):
        path = str(tmp_path / f"{hz}.wav")
        audio.write_wav(path, 0.5 * np.sin(2 * np.pi * hz * np.arange(seconds * rate) / rate), rate)
        blocks = list(audio.stream(path, block=160_000))
        assert [len(b) for b in blocks] == [160_000, 160_000, 16_000]
        whole = np.concatenate(blocks)
        want = level * np.sin(2 * np.pi * hz * np.arange(len(whole)) / 16_000)
        assert np.abs(whole - want)[200:-200].max() < 0.01
        clip, own, _ = audio.cut(path, 2.0, 3.0)
        assert own == rate and abs(np.abs(clip).max() - 0.5) < 0.01
    assert audio._resample(np.zeros(0), 48_000).size == 0
