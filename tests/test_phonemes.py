"""Clauses, groups and diacritics on hand-made values."""

from pyspark.sql import functions as F

from lectern.functions import phonemes as P
from lectern.sources import readers as R


def test_clauses_make_sentences(spark):
    df = spark.createDataFrame([([("a", ","), ("b", "."), ("c", "?"), ("d", None)],)], "c array<struct<text: string, mark: string>>")
    assert df.select(P.clause_sentences("c")).first()[0] == ["a, b.", "c?", "d"]


def test_groups(spark):
    df = spark.createDataFrame([([1, 1, 0, 5, 0, 7, 8, 9],)], "c array<int>")
    assert df.select(P.symbol_groups("c")).first()[0] == [2, 1, 3]


def test_diacritics_round_trip(spark):
    text = "مَرْحَبًا 5"
    df = spark.createDataFrame([(text,)], "t string").select(P.split_diacritics("t").alias("s"))
    row = df.select("s", P.annotate(F.col("s.char"), F.col("s.marks")).alias("t")).first()
    assert row.t == text.replace("5", "#") and row.s[0].char == "م" and row.s[0].marks == "َ"


def test_segment_starts_fit(spark):
    df = spark.range(50).select("id", P.segment_start(F.col("id").cast("int") + 5, 10, 3, "id").alias("s"))
    assert all(r.s == 0 if r.id + 5 <= 10 else 0 <= r.s <= r.id - 5 for r in df.collect())


def test_catalogues(spark, tmp_path):
    (tmp_path / "v.json").write_text('{"b": {}, "a": {}}')
    assert [r.voice for r in R.voice_catalogue(spark, str(tmp_path / "v.json")).collect()] == ["a", "b"]
    for root, names in (("one", ["x.onnx", "x.onnx.json", "y.onnx"]), ("two", ["x.onnx", "x.onnx.json", "z.onnx", "z.onnx.json"])):
        (tmp_path / root).mkdir()
        for n in names:
            (tmp_path / root / n).write_text("{}")
    got = {r.name: r.path.rsplit("/", 2)[1] for r in R.model_catalogue(spark, [str(tmp_path / "one"), str(tmp_path / "two")]).collect()}
    assert got == {"x": "one", "z": "two"}
    (tmp_path / "c.json").write_text('{"audio": {"sample_rate": 8000}}')
    (tmp_path / "bad.json").write_text("no")
    assert R.dataset_config(spark, str(tmp_path / "c.json")).first().sample_rate == 8000
    assert R.dataset_config(spark, str(tmp_path / "bad.json")).first().sample_rate is None
    ports = spark.createDataFrame([([(80, 1), (22, 2), (22, 3)],)], "p array<struct<privatePort: int, publicPort: int>>")
    assert ports.select(R.private_ports("p")).first()[0].publicPort == 2


def test_phonemize_reads_whole_texts(spark, sf_dir):
    from lectern.plans.registry import QUERIES

    letters = lambda s: sum(c.isalpha() for c in s)
    got = {r.item_id: sum(letters(s) for s in r.sentences for s in s) for r in QUERIES["phonemize"](spark, sf_dir).collect()}
    texts = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    assert got == {i: letters(t) + letters("tˈɛst") for i, t in texts.items()}
