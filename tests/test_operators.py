"""Operators on small hand-made tables, folds against plain Python."""

import random

from pyspark.sql import functions as F

from lectern.functions import arrays as A
from lectern.operators import aggregates, joins as J, sequence as S
from lectern.operators.build import build_rows, sync_texts, validate
from lectern.operators.rules import Rule, cascade, filter_rules, multilabel, text_rules
from lectern.sources.readers import CUTLIST


def test_gap_fill(spark):
    rows = [("a", 1, None, 5.0), ("a", 2, None, None), ("a", 3, None, None), ("a", 4, 30.0, 40.0), ("a", 5, None, None), ("b", 1, None, None), ("c", 1, None, 4.0), ("c", 2, 20.0, None)]
    out = S.gap_fill(spark.createDataFrame(rows, "src string, line int, start double, end double"), ["src"], "line")
    got = {(r.src, r.line): (r.filled_start, r.filled_end) for r in out.collect()}
    assert got == {("a", 1): (0.0, 5.0), ("a", 2): (5.0, 30.0), ("a", 3): (5.0, 30.0), ("a", 4): (30.0, 40.0), ("a", 5): (40.0, 50.0), ("b", 1): (None, None), ("c", 1): (0.0, 4.0), ("c", 2): (20.0, 30.0)}


def test_contiguous_runs(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "line int, src string")
    assert [r.run for r in S.contiguous_runs(df, "src", "line").orderBy("line").collect()] == [0, 0, 1, 2]


def merged(rows, hard=15.0, tiny=1.6, chars=10, least=2.5):
    small = lambda c: c[2] < tiny or len(c[3]) < chars
    chunks, closed = [], True
    for seg, d, t, b in rows:
        if not closed and chunks[-1][2] + d <= hard:
            c = chunks[-1]
            chunks[-1] = [c[0], seg, c[2] + d, c[3] + " " + t, c[4] + 1]
        else:
            chunks.append([seg, seg, d, t, 1])
        closed = not small(chunks[-1]) and chunks[-1][2] >= least and b
    if len(chunks) > 1 and small(chunks[-1]):
        last, prior = chunks.pop(), chunks.pop()
        chunks.append([prior[0], last[1], prior[2] + last[2], prior[3] + " " + last[3], prior[4] + last[4]])
    return [(c[0], c[1], c[4], round(c[2], 6), c[3]) for c in chunks]


def test_greedy_merge_equals_fold(spark):
    rng, rows = random.Random(2), []
    for key in range(40):
        for seg in range(rng.randrange(1, 12)):
            rows.append((key, seg, rng.choice([0.5, 1.0, 2.0, 4.0, 14.0, 16.0]), "w" * rng.choice([2, 12]), rng.random() < 0.5))
    out = S.greedy_merge(spark.createDataFrame(rows, "k int, s int, d double, t string, b boolean"), "k", "s", "d", "t", "b")
    got = {}
    for r in out.orderBy("k", "chunk").collect():
        got.setdefault(r.k, []).append((r.first, r.last, r.n, round(r.duration, 6), r.text))
    for key in range(40):
        assert got[key] == merged([r[1:] for r in rows if r[0] == key])


def test_greedy_merge_stores_texts(spark):
    rows = [(1, 0, 3.0, " one|two\nthree. ", True), (1, 1, 3.0, " | ", False), (1, 2, 14.0, "a last long one.", True)]
    out = S.greedy_merge(spark.createDataFrame(rows, "k int, s int, d double, t string, b boolean"), "k", "s", "d", "t", "b")
    assert [(r.chunk, r.first, r.last, r.text) for r in out.orderBy("chunk").collect()] == [(0, 0, 0, "one two three."), (1, 2, 2, "a last long one.")]


def packed(parts, target=160, orphan=35, slack=50):
    out = []
    for p in parts:
        if out and len(out[-1]) + 1 + len(p) <= target:
            out[-1] += " " + p
        else:
            out.append(p)
    if len(out) > 1 and len(out[-1]) < orphan and len(out[-2]) + 1 + len(out[-1]) <= target + slack:
        last = out.pop()
        out[-1] += " " + last
    return out


def test_greedy_pack_equals_fold(spark):
    rng = random.Random(4)
    rows = [(i, ["x" * rng.choice([5, 34, 35, 80, 125, 160, 161, 200]) for _ in range(rng.randrange(0, 9))]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, p array<string>").select("i", S.greedy_pack(F.col("p")).alias("o"))
    assert {r.i: r.o for r in df.collect()} == {i: packed(p) for i, p in rows}


def test_after_first_keeps_first_and_blank(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, "a"), (4, ""), (5, "b")], "row int, norm string")
    assert sorted(r.row for r in S.after_first(df, "norm", "row").filter("duplicate").collect()) == [3]


def test_cascade_first_reason_and_bounds(spark):
    rows = [(1, "a.wav", "x" * 6, 2.0), (2, "a.wav", "x" * 400, 15.0), (3, "", "x", 1.0), (4, "a", "x", 1.9), (5, "a", "x" * 5, 3.0), (6, "a", "x" * 401, 3.0), (7, "a", "...!!!", 3.0), (8, "a", "x" * 9, None), (9, "a", "xxxxxxx", 15.1), (10, "a", "Привет, мир", 3.0)]
    df = spark.createDataFrame(rows, "row int, wav string, text string, duration double").withColumn("reason", cascade(filter_rules("wav", "text", "duration")))
    want = {1: None, 2: None, 3: "empty_wav", 4: "too_short", 5: "text_too_short", 6: "text_too_long", 7: "text_regex", 8: "invalid_wav", 9: "too_long", 10: None}
    assert {r.row: r.reason for r in df.collect()} == want


def test_text_rules_two_modes_without_letters(spark):
    df = spark.createDataFrame([(1, "12345"), (2, "привет"), (3, "hello"), (4, "a\x07")], "row int, text string")
    issues = lambda strict: sorted((r.row, r.issue) for r in multilabel(df, text_rules("text", strict=strict), ["row"]).collect())
    lenient = [(3, "low_script_share"), (4, "low_script_share"), (4, "non_printable"), (4, "too_short_text")]
    assert issues(False) == lenient
    assert issues(True) == sorted([(1, "low_script_share"), *lenient])


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.1,), (-1.0,)], "v double")
    got = [(r.bin, r["count"], r.bar) for r in aggregates.histogram(df, "v", [0.0, 1.0, 2.0], 4).orderBy("bin").collect()]
    assert got == [(0, 1, "##"), (1, 2, "####")]


def test_describe_no_rows(spark):
    r = spark.createDataFrame([], "v double").agg(*aggregates.describe("v")).first()
    assert (r["count"], r["min"], r["p50"]) == (0, None, None)


def test_ordinal_join_short_and_missing_lists(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "src string, line int")
    lists = spark.createDataFrame([("a", ["x", "y"])], "src string, s array<string>")
    got = sorted((r.src, r.line, r.ordinal, r.item) for r in J.ordinal_join(rows, lists, "src", "line", "s").collect())
    assert got == [("a", 1, 0, "x"), ("a", 2, 1, "y"), ("a", 3, 2, None), ("b", 1, 0, None)]


def test_build_sync_validate(spark):
    none = None
    rows = [(1, "a", 0.0, 2.0, "one", none, none, none, none), (2, "a", 2.0, 3.0, "two", none, none, none, ("bad", none, none, none)), (3, "a", 3.0, 4.0, "three", none, none, none, none), (4, "b", none, none, "four", none, none, none, none)]
    cut = spark.createDataFrame(rows, "line int, " + CUTLIST)
    lists = spark.createDataFrame([("a", ["One.", "Two.", "Three."])], "audio_path string, sentences array<string>")
    got = {r.cutlist_line: (r.outcome, r.out_wav, r.text, r.text_source) for r in build_rows(cut, lists).collect()}
    assert got == {1: ("kept", "00000000.wav", "One.", "to_align"), 2: ("skipped", None, "Two.", "to_align"), 3: ("kept", "00000001.wav", "Three.", "to_align"), 4: ("failed", None, "four", "cutlist")}
    synced = {r.line: (r.sync, r.text, r.text_orig) for r in sync_texts(cut, lists).collect()}
    assert synced[3] == ("updated", "Three.", "three") and synced[4] == ("missing", "four", None)
    meta = spark.createDataFrame([(1, "x.wav", "привет", none), (2, "x.wav", "привет", none), (3, "y.wav", "", "missing_text"), (4, "gone.wav", "да-да", none), (5, "lost.wav", "x", none)], "row_num int, wav string, text string, issue string")
    info = spark.createDataFrame([("x.wav", 22050, 1, "PCM_16", 1.0, none), ("y.wav", 8000, 2, "PCM_16", 0.1, none)], "wav string, samplerate int, channels int, subtype string, duration double, error string")
    issues = sorted((r.row, r.wav, r.issue) for r in validate(meta, info, 22050).collect())
    assert issues == [("-", "y.wav", "extra_wav"), ("2", "x.wav", "duplicate_wav"), ("3", "y.wav", "missing_text"), ("4", "gone.wav", "missing_wav"), ("5", "lost.wav", "missing_wav")]


def test_global_numbers_equal_one_sort(spark):
    rng = random.Random(5)
    rows = rng.sample(range(-400_000, 400_000), 300) + [None]
    df = spark.createDataFrame([(r,) for r in rows], "row bigint").repartition(3)
    got = {r.row: r.name for r in S.numbered_names(df, "row", "%d.wav").collect()}
    assert got == {r: f"{i}.wav" for i, r in enumerate(sorted(rows, key=lambda r: (r is not None, r or 0)))}
    hashed = F.xxhash64("row")
    ranked = S.global_rank(df, F.shiftright(hashed, 60), [hashed], "n").withColumn("h", hashed).collect()
    assert [r.n for r in sorted(ranked, key=lambda r: r.h)] == list(range(1, 302))
    assert S.numbered_names(df.limit(0), "row", "%d.wav").collect() == []


def test_split_sizes(spark):
    got = {r.part: r["count"] for r in S.split_sizes(spark.range(87), "id").groupBy("part").count().collect()}
    assert got == {"val": 8, "test": 5, "train": 74}


def test_symbol_ids_golden(spark):
    ids = {"t": 32, "ˈ": 120, "ɛ": 61, "s": 31, " ": 3, "w": 35, "ʌ": 102, "n": 26, ".": 10}
    m = F.create_map(*[x for k, v in ids.items() for x in (F.lit(k), F.array(F.lit(v)))])
    df = spark.createDataFrame([(list("tˈɛst wˈʌn."),)], "s array<string>")
    assert df.select(A.symbol_ids("s", m)).first()[0] == [1, 0, 32, 0, 120, 0, 61, 0, 31, 0, 32, 0, 3, 0, 35, 0, 120, 0, 102, 0, 26, 0, 10, 0, 2]


def test_alignment_sums_groups(spark):
    rng = random.Random(11)
    groups = [rng.randrange(1, 4) for _ in range(13)]
    samples = [256 * rng.randrange(1, 7) for _ in range(sum(groups))]
    want, rest = [], list(samples)
    for g in groups:
        want.append(sum(rest[:g]))
        rest = rest[g:]
    df = spark.createDataFrame([(list(range(len(samples))), samples, groups)], "i array<int>, n array<bigint>, g array<int>")
    assert df.select(A.aligned_samples(F.col("i"), F.col("n"), F.col("g"))).first()[0] == want
    assert df.select(A.aligned_samples(F.col("i"), F.slice("n", 1, len(samples) - 1), F.col("g"))).first()[0] is None


def test_int16_truncates(spark):
    df = spark.createDataFrame([([0.5, -0.5, 2.0, -2.0, 0.0],)], "a array<float>")
    assert df.select(A.to_int16("a")).first()[0] == [16383, -16383, 32767, -32767, 0]
    assert df.select(A.peak_normalize(F.array(F.lit(0.0)))).first()[0] == [0.0]


def test_rule_details_are_optional(spark):
    df = spark.createDataFrame([(1,)], "row int")
    assert [(r.issue, r.details) for r in multilabel(df, [Rule("a", F.col("row") > 0), Rule("b", F.col("row") > 5)], ["row"]).collect()] == [("a", "")]
