"""Readers, writers, audio and streaming on files of their own."""

import json
import random
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions import audio, udfs
from lectern.operators.rules import Rule
from lectern.sources import readers as R, writers as W
from lectern.streaming import incremental as I


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_metadata_dialects(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'w1.wav|"Hello" he said\n\nw2.wav|a|b\nw3.wav\nw1.wav|again\n')
    raw = [(r.row_num, r.wav, r.text) for r in R.raw_metadata(spark, path).orderBy("row_num").collect()]
    assert raw == [(1, "w1.wav", '"Hello" he said'), (3, "w2.wav", "a|b"), (4, "w3.wav", None), (5, "w1.wav", "again")]
    quoted = [(r.row_num, r.wav, r.text, r.issue) for r in R.quoted_metadata(spark, path).orderBy("row_num").collect()]
    assert quoted == [(1, "w1.wav", "Hello he said", None), (2, "", "", "empty_row"), (3, "w2.wav", "a", None), (4, "w3.wav", "", "missing_text"), (5, "w1.wav", "again", None)]
    assert {r.wav: r.text for r in R.metadata_map(spark, path).collect()} == {"w1.wav": "again", "w2.wav": "a|b"}
    assert R.normalised_metadata(spark, path).count() == 3
    odd = write(tmp_path / "odd.csv", 'a.wav|"open\nb.wav|text\n')
    assert [r.fields for r in R.quoted_records(spark, odd).collect()] == [["a.wav", "open\nb.wav|text\n"]]
    three = write(tmp_path / "s.csv", "a.wav|sp|x|last\n")
    assert [(r.wav, r.speaker, r.text) for r in R.speaker_metadata(spark, three).collect()] == [("a.wav", "sp", "last")]
    with pytest.raises(Exception, match="fewer than 3"):
        R.speaker_metadata(spark, path).collect()


def test_json_readers(spark, tmp_path):
    lines = [{"audio_path": "a", "text": "x", "meta": "m"}, {"audio_path": "b"}]
    path = write(tmp_path / "m.jsonl", "\n".join([json.dumps(lines[0]), "broken{", "[1]", "", json.dumps(lines[1])]) + "\n")
    assert [(r.line, r.audio_path, r.text) for r in R.manifest(spark, path).collect()] == [(1, "a", "x")]
    rows = {r.line: r.valid for r in R.jsonl(spark, path, R.MANIFEST).collect()}
    assert rows == {1: True, 2: False, 3: False, 5: True}
    with pytest.raises(Exception, match="broken JSON in line 2"):
        R.jsonl(spark, path, R.MANIFEST, strict=True).select("valid").collect()
    align = write(tmp_path / "a.json", json.dumps([{"audio_path": "a", "sentences": ["old"]}, {"audio_path": "a", "sentences": ["x", " ", "y"]}]))
    assert [(r.audio_path, r.sentences) for r in R.to_align(spark, align).collect()] == [("a", ["x", "y"])]
    config = write(tmp_path / "c.json", W.voice_config("low", 16000, {"a": [1]}))
    got = R.voice_config(spark, config).first()
    assert (got.sample_rate, got.hop_length, got.phoneme_id_map, got.noise_w) == (16000, 256, {"a": [1]}, 0.8)
    bare = write(tmp_path / "bare.json", '{"audio": {"sample_rate": 8000}}')
    assert R.voice_config(spark, bare).first().noise_scale == 0.667
    verdicts = write(tmp_path / "v.tsv", "idx\twav\tverdict\n1\ta\tok\n2\ta\tbad\n")
    assert [(r.wav, r.verdict) for r in R.verdict_file(spark, verdicts).collect()] == [("a", "bad")]
    with pytest.raises(ValueError):
        R.verdict_file(spark, verdicts, ("wav", "nothing"))


def test_writers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "b.wav", 'say "hi"'), (1, "a.wav", "tab\there")], "row int, wav string, text string")
    W.pipe_metadata(df, str(tmp_path / "m"), "row")
    got = [(r.wav, r.text) for r in R.raw_metadata(spark, str(tmp_path / "m")).orderBy("row_num").collect()]
    assert got == [("a.wav", "tab\there"), ("b.wav", 'say "hi"')]
    with pytest.raises(Exception, match="(?i)exist"):
        W.pipe_metadata(df, str(tmp_path / "m"), "row")
    W.jsonl(df.withColumn("_hidden", F.lit(1)).withColumn("raw", F.when(F.col("row") == 1, "not json")), str(tmp_path / "j"), "row", raw="raw")
    assert [r.value for r in spark.read.text(str(tmp_path / "j")).collect()] == ["not json", '{"row":2,"wav":"b.wav","text":"say \\"hi\\""}']
    W.tsv(df, str(tmp_path / "t"), ["row"], ["row", "text"])
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["row\ttext", "1\ttab here", '2\tsay "hi"']
    assert json.loads(W.json_array(df.select("row"), "row")) == [{"row": 1}, {"row": 2}]


def test_audio_headers_and_listing(spark, tmp_path):
    folder = tmp_path / "wavs"
    folder.mkdir()
    for name, channels, n in (("a.wav", 1, 22050), ("b.WAV", 2, 11025)):
        with wave.open(str(folder / name), "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(2)
            w.setframerate(22050)
            w.writeframes(b"\0" * 2 * channels * n)
    (folder / "c.wav").write_bytes(b"nothing")
    (folder / "d.txt").write_text("x")
    got = {r.wav: (r.frames, r.channels, r.duration, r.error) for r in R.audio_info(spark, str(folder)).collect()}
    assert got == {"a.wav": (22050, 1, 1.0, None), "b.WAV": (11025, 2, 0.5, None), "c.wav": (None, None, None, "invalid_audio")}
    assert [r.wav for r in R.file_listing(spark, str(folder)).collect()] == ["a.wav", "b.WAV", "c.wav"]
    rows = R.with_audio_info(spark.createDataFrame([("a.wav",), ("x.wav",)], "wav string"), R.audio_info(spark, str(folder)))
    assert {r.wav: r.error for r in rows.collect()} == {"a.wav": None, "x.wav": "missing_wav"}
    assert len(R.wav_dirs(spark, [str(tmp_path)]).collect()) == 1


def test_audio_functions():
    x = np.arange(-100, 100, dtype="<i2")
    assert (audio.wav_samples(audio.wav_bytes(x, 8000)) == x).all()
    both = audio.join_wavs([audio.wav_bytes(x, 8000), audio.wav_bytes(x, 16000)])
    assert audio.wav_header(both)[:2] == (300, 8000)
    tone = np.sin(2 * np.pi * 8 * np.arange(256) / 64)
    m = audio.stft_magnitude(tone, 64, 16)
    assert (m.argmax(axis=1)[2:-2] == 8).all()
    assert audio.mel_filters(16000, 64, 10, 0.0, 8000.0).shape == (10, 33)


def test_phonemize_blocks_and_similarity(spark):
    g2p = {"Old ships. They": [list("AB."), list("C")], "slowly.": [list("D.")], "On": [list("E")]}.__getitem__
    said = lambda text: ["".join(s) for s in udfs.phonemize(text, g2p)]
    assert said("Old ships. They [[ seɪl ]] slowly.") == ["AB.", "C seɪl D."]
    assert said("[[ wˈɪnd ]]") == ["wˈɪnd"] and said("On[[x]]") == ["Ex"] and said("[[x]] [[y]]") == ["x  y"]
    assert said("On") == ["E"] and said("") == [] and said("[[ ]]") == []
    df = spark.createDataFrame([("", ""), ("abcd", "bcde"), ("tide", "diet"), ("diet", "tide")], "a string, b string")
    assert [r[0] for r in df.select(udfs.similarity("a", "b")).collect()] == [1.0, 0.75, 0.25, 0.5]


def plainly_split(text, most):
    """The rule restated: the best kind of mark in the last 30 % of a part and one more character, else a space there, else ``most``."""
    text = text.strip()
    if len(text) <= most:
        return [text] if text else []
    spots = range(int(most * 0.7), most + 1)
    options = [max((p + (kind != " ") for p in spots if text[p] == kind), default=None) for kind in ";:,— "]
    cut = next((o for o in options if o is not None), most)
    return [p for p in (text[:cut].strip(), *plainly_split(text[cut:], most)) if p]


def test_long_split():
    text = "a" * 80 + "; " + "b" * 85 + ", " + "c" * 100
    assert udfs.split_long(text, 230, 0.7) == ["a" * 80 + "; " + "b" * 85 + ",", "c" * 100]
    assert udfs.split_long("x" * 500, 230) == ["x" * 230, "x" * 230, "x" * 40]
    assert udfs.split_long("word " * 100, 230)[0] == ("word " * 46).strip() and udfs.split_long("  ") == []
    # A space before the floor is not taken, and a mark just after a full part still is.
    assert [len(p) for p in udfs.split_long("a " + "b" * 300, 230)] == [230, 72]
    assert udfs.split_long("x" * 230 + ";" + "y" * 9, 230) == ["x" * 230 + ";", "y" * 9]
    rng = random.Random(7)
    for _ in range(1500):
        text = "".join(rng.choices(["a", "b", " ", "  ", ";", ":", ",", "—", "\t"], weights=[40, 40, 6, 1, 1, 1, rng.choice([0, 2]), 1, 1], k=rng.randrange(0, 400)))
        assert udfs.split_long(text, 50) == plainly_split(text, 50)


def test_streams_equal_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "1.txt", "  One. Two!\n\nThree\n")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    rows = I.sentence_stream(I.line_source(spark, str(source)))
    kept = I.cascade_stream(rows, [Rule("short", F.length("text") < 5)])
    I.run_available(kept, out, check).awaitTermination()
    write(source / "2.txt", "Four four.\n")
    I.run_available(kept, out, check).awaitTermination()
    got = sorted((r.text, r.reason) for r in spark.read.parquet(out).collect())
    assert got == [("Four four.", None), ("One.", "short"), ("Three", None), ("Two!", "short")]


def test_stream_ordinals_and_first_seen(spark, tmp_path):
    schema = "k string, line int, ts timestamp"
    source = str(tmp_path / "rows")
    batch = [("a", 1), ("a", 2), ("b", 1)]
    make = lambda rows: spark.createDataFrame([(k, n) for k, n in rows], "k string, line int").withColumn("ts", F.timestamp_seconds(F.lit(1_000_000) + F.col("line"))).coalesce(1)
    make(batch).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    for more in (None, [("a", 3)]):
        if more:
            make(more).write.mode("append").parquet(source)
        I.run_available(I.ordinals(stream(), "k", "line"), str(tmp_path / "o"), str(tmp_path / "oc")).awaitTermination()
        I.run_available(I.first_seen(stream(), ["k"], "ts", "1 hour"), str(tmp_path / "f"), str(tmp_path / "fc")).awaitTermination()
    assert sorted((r.k, r.line, r.ordinal) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 1, 0)]
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "f")).collect()) == ["a", "b"]
