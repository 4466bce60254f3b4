"""The commands end to end on generated tones, with stub models."""

import json
import wave

import numpy as np
import pandas as pd
import pytest

from corvane.functions import dsp
from corvane.plans import commands
from corvane.sources import audio, manifest


def tone(path, hz, seconds, rate=16_000):
    audio.write_wav(str(path), 0.25 * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate), rate)


def asr():
    return lambda clip, row: {"text": row["reference_text"] or "spoken", "avg_logprob": -0.1, "compression_ratio": 1.0}


def quality():
    def run(clip, row):
        if row["id"] == "fails":
            raise ValueError("no score")
        return dsp.perceptual_scores(clip, lambda w: (3.0, 4.0, 5.0))

    return run


def stages():
    return [commands.Stage("asr", asr, identity={"model": 1}), commands.Stage("quality", quality)]


def aligner():
    return lambda clip, row: {"alignment_status": "ok", "alignment_coverage": 1.0}


@pytest.fixture
def corpus(tmp_path):
    for name, hz in (("a", 440), ("b", 330), ("c", 440)):
        tone(tmp_path / f"{name}.wav", hz, 0.5)
    audio.write_wav(str(tmp_path / "quiet.wav"), np.zeros(8000), 16_000)
    rows = [
        {"id": "one", "audio": "a.wav", "language": "en", "kind": "synthetic", "reference_text": "hello there", "speaker_id": "s"},
        {"id": "fails", "audio": "b.wav", "language": "en", "kind": "synthetic", "reference_text": "hello", "speaker_id": "s", "extra": [1]},
        {"id": "copy", "audio": "c.wav", "language": "en", "kind": "synthetic", "reference_text": "hello there"},
        {"id": "gone", "audio": "missing.wav", "language": "en"},
        {"id": "quiet", "audio": "quiet.wav", "language": "tr"},
    ]
    path = tmp_path / "manifest.jsonl"
    path.write_text("\n\n".join(json.dumps(r) for r in rows) + "\n")
    return tmp_path, str(path)


def test_score_select_export(spark, corpus):
    folder, path = corpus
    out = str(folder / "scored")
    first = commands.score(spark, path, out, stages())
    assert first == {"scored": 5, "resumed": 0, "errors": 2}
    assert commands.score(spark, path, out, stages()) == {"scored": 0, "resumed": 5, "errors": 2}
    more = [*stages(), commands.Stage("alignment_qwen", aligner, languages=("en", "zh", "ja"))]
    assert commands.score(spark, path, out, more)["scored"] == 3
    assert commands.score(spark, path, out, more, retry_errors=True)["scored"] == 2
    rows = {r["id"]: r for r in commands.records(spark, out).collect()}
    assert rows["one"]["reference_cer"] == 0 and rows["one"]["text"] == "hello there" and rows["quiet"]["text"] == ""
    assert "no score" in rows["fails"]["error"] and rows["gone"]["error"]
    with pytest.raises(ValueError):
        commands.score(spark, path, out, [commands.Stage("asr", asr, identity={"model": 2})])
    bounds = {"reference_cer": {"max": 0.1}}
    rules = {"profiles": {"asr": {"languages": {"en": {"synthetic": bounds}}}}}
    counts = commands.select(spark, out, rules, str(folder / "selected"), "asr")
    assert counts == {"accept": 1, "reject": 2, "review": 0, "error": 2}
    with pytest.raises(Exception, match="already exists|EXISTS"):
        commands.select(spark, out, rules, str(folder / "selected"), "asr")
    done = commands.export(spark, str(folder / "selected"), str(folder / "clips"), 8000)
    assert sum(done["splits"].values()) == 1 and done["conversions"] == [{"source_sample_rate": 16000, "sample_rate": 8000, "n": 1}]
    assert commands.export(spark, str(folder / "selected"), str(folder / "clips"), 8000) == done
    (clip,) = (folder / "clips").rglob("*.wav")
    before = clip.read_bytes()
    for spoil in (clip.unlink, lambda: clip.write_bytes(b"cut off")):
        spoil()
        assert commands.export(spark, str(folder / "selected"), str(folder / "clips"), 8000) == done
        assert clip.read_bytes() == before
    labels = folder / "labels.jsonl"
    keep = {k: rows["one"][k] for k in ("id", "source_sha256", "pcm_sha256", "input")}
    labels.write_text(json.dumps(keep | {"human_label": "accept"}))
    report = commands.calibrate(spark, out, str(folder / "review"), 2, "0", str(labels), rules, "asr")
    assert report[0]["accepted"] == 1 and report[0]["accept_precision"] == 1.0
    labels.write_text(json.dumps(keep | {"pcm_sha256": "old", "human_label": "accept"}))
    with pytest.raises(ValueError):
        commands.calibrate(spark, out, str(folder / "review2"), 2, "0", str(labels), rules, "asr")


def test_clips_keep_rate_and_channels(tmp_path):
    t = np.arange(48_000) / 48_000
    sound = np.stack([0.25 * np.sin(2 * np.pi * 12_000 * t), 0.1 * np.sin(2 * np.pi * 440 * t)], axis=1)
    path = str(tmp_path / "wide.wav")
    with wave.open(path, "wb") as file:
        file.setparams((2, 2, 48_000, 0, "NONE", ""))
        file.writeframes((sound * 32768).round().astype("<i2").tobytes())
    row = {"id": "w", "audio": path, "source_sha256": audio.file_hash(path), "source_sample_rate": 48_000, "start": 0.25, "end": 0.75}
    for rate in (None, 24_000):
        (done,) = commands._write_clips(str(tmp_path), rate)(iter([pd.DataFrame([row | {"path": f"train/{rate}.wav"}])]))
        assert done[["sample_rate", "frames", "channels"]].values.tolist() == [[rate or 48_000, (rate or 48_000) // 2, 2]]
        with wave.open(str(tmp_path / f"train/{rate}.wav")) as file:
            assert file.getparams()[:4] == (2, 2, rate or 48_000, (rate or 48_000) // 2)
            raw = np.frombuffer(file.readframes(48_000), "<i2").reshape(-1, 2)
        assert rate or np.array_equal(raw, (sound[12_000:36_000] * 32768).round())


def loud():
    return lambda w: float(np.abs(w).mean() > 0.1)


def two_speakers():
    """Speaker 0 all the time, speaker 1 in the first half of each block; a probability of 0.5 is silence."""

    def run(blocks):
        at = 0
        for block in blocks:
            frames = np.full((len(block) // 160, 8), 0.5, np.float32)
            frames[:, 0] = 0.9
            frames[: len(frames) // 2, 1] = 0.8
            yield at, frames
            at += len(block)

    return run


def test_prepare(spark, tmp_path):
    clip = np.concatenate([np.zeros(16_000), np.full(16_000, 0.5), np.zeros(16_000)])
    audio.write_wav(str(tmp_path / "e.wav"), clip, 16_000)
    path, out = str(tmp_path / "m.jsonl"), str(tmp_path / "segments")
    rows = [{"id": "e", "audio": "e.wav", "language": "en", "show": {"n": 1}}, {"id": "late", "audio": "e.wav", "language": "en", "start": 0.5, "end": 2.5, "source_id": "s"}]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, rows)))
    models = {"vad": {"model": 1}, "diarization": {"model": 2}}
    assert commands.prepare(spark, path, out, loud, two_speakers, models) == 2
    first, late = (json.loads(r["value"]) for r in spark.read.text(out).collect())
    assert first["boundary_cut"] is False and abs(first["start"] - 1) < 0.05 and abs(first["end"] - 2) < 0.1
    assert first["show"] == {"n": 1} and first["source_id"] == "e" and late["source_id"] == "s" and first["source_sha256"] == audio.file_hash(str(tmp_path / "e.wav"))
    # The bounds of the row shift windows, not what they hold.
    assert abs(late["start_sample"] - first["start_sample"]) <= 512 and late["id"] == f"late:{late['start_sample']}:{late['end_sample']}"
    told = first["prepared_diarization"]
    assert told["diar_speakers"] == 2 and [t["speaker"] for t in told["speaker_turns"]] == ["speaker_0", "speaker_1"] and 0 < told["overlap_ratio"] < 1
    assert first["diarization_identity"] == {"model": 2} and not told["speaker_capacity_reached"]
    assert commands.prepare(spark, path, out, None, two_speakers, models) == 2  # nothing is read again
    with pytest.raises(ValueError):
        commands.prepare(spark, path, out, loud, two_speakers, {"vad": {"model": 3}})
    (tmp_path / "m.jsonl").write_text(json.dumps(rows[0]))
    with pytest.raises(ValueError, match="differs"):
        commands.prepare(spark, path, out, loud, two_speakers, models)
    # Scoring takes what was prepared, turns and all.
    scored, seen = str(tmp_path / "scored"), [commands.Stage("asr", asr), commands.Stage("diarization", None, identity={"model": 2})]
    lines = tmp_path / "segments.jsonl"
    lines.write_text("\n".join(r["value"] for r in spark.read.text(out).collect()))
    assert commands.score(spark, str(lines), scored, seen)["errors"] == 0
    row = commands.records(spark, scored).orderBy("seq").first()
    assert json.loads(row["speaker_turns"]) == told["speaker_turns"] and row["overlap_ratio"] == told["overlap_ratio"]
    audio.write_wav(str(tmp_path / "e.wav"), clip / 2, 16_000)
    assert commands.score(spark, str(lines), scored, [*seen, commands.Stage("quality", quality)])["errors"] == 2
    with pytest.raises(ValueError, match="changed"):
        commands.prepare(spark, path, str(tmp_path / "segments"), loud, two_speakers, models)


def test_prepare_without_speakers(spark, tmp_path):
    tone(tmp_path / "t.wav", 440, 1.0)
    (tmp_path / "m.jsonl").write_text(json.dumps({"id": "t", "audio": "t.wav", "language": "en"}))
    assert commands.prepare(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "none"), lambda: lambda w: 0.0) == 0
    assert commands.prepare(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "some"), loud) == 1
    assert "prepared_diarization" not in spark.read.json(str(tmp_path / "some")).columns


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        ({"id": ""}, "id must be"), ({"language": "xx"}, "unknown language"), ({"kind": "radio"}, "unknown kind"), ({"kind": "synthetic"}, "need reference_text"),
        ({"boundary_cut": 1}, "boundary_cut"), ({"start": True}, "start must be"), ({"start_sample": 1}, "come together"), ({"source_id": 3}, "source_id"),
        ({"start_sample": 1.5, "end_sample": 3, "timebase_hz": 1}, "integers"), ({"start_sample": 5, "end_sample": 3, "timebase_hz": 1}, "0 <= start"),
        ({"start_sample": 16000, "end_sample": 32000, "timebase_hz": 16000, "start": 1.1}, "differs"),
    ],
)
def test_manifest_problems(spark, tmp_path, change, problem):
    good = {"id": "x", "audio": "x.wav", "language": "en"}
    path = tmp_path / "m.jsonl"
    path.write_text(json.dumps(good) + "\n\n" + json.dumps(good | {"id": "y"} | change) + "\n")
    with pytest.raises(ValueError, match=problem) as caught:
        manifest.read(spark, str(path))
    assert ":3:" in str(caught.value)
    path.write_text(json.dumps(good) + "\n" + json.dumps(good) + "\n")
    with pytest.raises(ValueError, match="occurs 2 times"):
        manifest.read(spark, str(path))
