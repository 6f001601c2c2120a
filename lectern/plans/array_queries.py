"""Symbol ids, audio arrays, maps and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lectern.functions import arrays as A, maps as M
from lectern.plans.inputs import read
from lectern.plans.registry import query

#: Ids of the letters a-z and of the space, from 3 on.
LETTERS = "abcdefghijklmnopqrstuvwxyz "
LETTERS_SQL = f"string_split('{LETTERS}', '')"


def letter_map() -> Column:
    return F.map_from_entries(F.transform(F.array(*[F.lit(c) for c in LETTERS]), lambda c, i: F.struct(c, F.array(i + 3))))


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select("item_id", F.split(F.lower("text"), "").alias("s"))


SYMBOLS_SQL = "SELECT item_id, string_split(lower(text), '') AS s FROM benchmark"


@query(f"SELECT item_id, list_concat(list_concat([1, 0], flatten(list_transform(list_filter(s, lambda c: list_position({LETTERS_SQL}, c) > 0), lambda c: [CAST(list_position({LETTERS_SQL}, c) + 2 AS INTEGER), 0]))), [2]) AS ids FROM ({SYMBOLS_SQL})")
def phoneme_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbols(spark, sf_dir).select("item_id", A.symbol_ids("s", letter_map()).alias("ids"))


@query(f"SELECT item_id, list_transform(s, lambda c: CASE WHEN list_position({LETTERS_SQL}, c) > 0 THEN CAST(list_position({LETTERS_SQL}, c) + 2 AS INTEGER) ELSE 0 END) AS ids, list_filter(s, lambda c: NOT list_contains({LETTERS_SQL}, c)) AS unknown FROM ({SYMBOLS_SQL})")
def plain_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbols(spark, sf_dir).select("item_id", A.plain_ids("s", letter_map()).alias("ids"), A.unknown_symbols("s", letter_map()).alias("unknown"))


AUDIO_SQL = "SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a FROM embeddings"


@query(f"SELECT vec_id, list_transform(a, lambda x: CAST(trunc(greatest(least(x * 32767, 32767), -32767)) AS SMALLINT)) AS pcm FROM ({AUDIO_SQL})")
def pcm_int16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", A.to_int16("embedding").alias("pcm"))


@query(f"SELECT vec_id, list_transform(a, lambda x: CAST(trunc(greatest(least(x * (32767 / greatest(CAST(0.01 AS DOUBLE), m)), 32767), -32767)) AS SMALLINT)) AS pcm FROM (SELECT vec_id, a, list_max(list_transform(a, lambda x: abs(x))) AS m FROM ({AUDIO_SQL}))")
def peak_int16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", A.peak_int16("embedding").alias("pcm"))


@query(f"SELECT vec_id, round(m, 6) AS peak, list_transform(a, lambda x: round(greatest(least(x / m * CAST(0.8 AS DOUBLE), 1), -1), 6)) AS audio FROM (SELECT vec_id, a, list_max(list_transform(a, lambda x: abs(x))) AS m FROM ({AUDIO_SQL}))")
def peak_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.round(A.peak("embedding").cast("double"), 6).alias("peak"), A.peak_normalize("embedding", 0.8).alias("a"))
    return rows.select("vec_id", "peak", F.transform("a", lambda x: A.rounded(x, 6)).alias("audio"))


@query("SELECT conv_id, turn, list_concat(l, list_transform(range(m - len(l)), lambda i: 0)) AS padded, list_transform(range(m), lambda i: CASE WHEN i < len(l) THEN 1 ELSE 0 END) AS mask FROM (SELECT conv_id, turn, l, max(len(l)) OVER (PARTITION BY conv_id) AS m FROM (SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS l FROM conversations))")
def pad_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths of a conversation's turns, padded to the longest one."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.transform(F.split("text", " "), lambda w: F.length(w)).alias("l"))
    most = rows.groupBy("conv_id").agg(F.max(F.size("l")).alias("m"))
    return rows.join(most, "conv_id").select("conv_id", "turn", A.pad_to("l", F.col("m"), F.lit(0)).alias("padded"), A.mask(F.size("l"), F.col("m")).alias("mask"))


@query("SELECT conv_id // 20 AS batch, row_number() OVER (PARTITION BY conv_id // 20 ORDER BY length(text) DESC NULLS LAST, conv_id, turn) - 1 AS place, conv_id, turn FROM conversations")
def sort_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch of twenty conversations, longest text first; a batch's size is bounded, so its sort is."""
    rows = read(spark, sf_dir, "conversations").select(F.expr("conv_id div 20").alias("batch"), "conv_id", "turn", F.length("text").alias("n"))
    order = Window.partitionBy("batch").orderBy(F.col("n").desc_nulls_last(), "conv_id", "turn")
    return rows.select("batch", (F.row_number().over(order) - 1).cast("bigint").alias("place"), "conv_id", "turn")


@query(f"SELECT vec_id, CAST(i AS INTEGER) AS frame, round(list_sum(list_transform(a[i * 20 + 1 : i * 20 + 20], lambda x: x * x)) / 20, 9) AS energy FROM ({AUDIO_SQL}), (SELECT unnest(range(3)) AS i)")
def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(A.frames("embedding", 20)).alias("frame", "f"))
    return rows.select("vec_id", "frame", F.round(A.mean_square(F.col("f")), 9).alias("energy"))


SPAN_SQL = f"""SELECT vec_id, CASE WHEN len(h) < 2 THEN 0 ELSE 0 END AS start, CASE WHEN len(h) < 2 THEN 64 ELSE least((h[-1] + 1) * 8 + 4, 64) END AS "end", CASE WHEN len(h) < 2 THEN 0 ELSE greatest(h[1] * 8 - 4, 0) END AS trimmed_start
FROM (SELECT vec_id, list_filter(range(8), lambda i: list_sum(list_transform(a[i * 8 + 1 : i * 8 + 8], lambda x: x * x)) / 8 >= 0.02) AS h FROM ({AUDIO_SQL}))"""


@query(f"SELECT vec_id, CAST(start AS INTEGER) AS start, CAST(\"end\" AS INTEGER) AS \"end\", CAST(trimmed_start AS INTEGER) AS trimmed_start FROM ({SPAN_SQL})")
def speech_span_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy stands in for the probability of speech."""
    p = F.transform(A.frames("embedding", 8), A.mean_square)
    rows = read(spark, sf_dir, "embeddings").select("vec_id", p.alias("p"), F.size("embedding").alias("n"))
    rows = rows.select("vec_id", A.speech_span("p", 0.02, 8, F.col("n"), 4).alias("s"), A.speech_span("p", 0.02, 8, F.col("n"), 4, trim_start=True).alias("t"))
    return rows.select("vec_id", "s.start", "s.end", F.col("t.start").alias("trimmed_start"))


DURATIONS_SQL = "SELECT item_id, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS d FROM benchmark"


@query(f"SELECT item_id, flatten(list_transform(range(len(d)), lambda i: list_transform(range(d[i + 1]), lambda j: CAST(i AS INTEGER)))) AS path, list_transform(range(len(d)), lambda i: CAST(list_sum(d[1 : i + 1]) AS BIGINT)) AS ends FROM ({DURATIONS_SQL})")
def duration_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "benchmark").select("item_id", F.transform(F.split("text", " "), lambda w: F.length(w)).alias("d"))
    return rows.select("item_id", A.expand_durations("d").alias("path"), A.running_sum("d").alias("ends"))


@query(f"SELECT item_id, list_transform(d, lambda w: CAST(ceil(w / 3) * 256 AS BIGINT)) AS samples, list_prepend(0, flatten(list_transform(d, lambda w: [w, 0]))) AS spread FROM ({DURATIONS_SQL})")
def samples_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "benchmark").select("item_id", F.transform(F.split("text", " "), lambda w: F.length(w)).alias("d"))
    return rows.select("item_id", A.samples_per_id(F.transform("d", lambda w: w / 3)).alias("samples"), A.intersperse("d", F.lit(0)).alias("spread"))


@query(f"SELECT item_id, list_transform(range(len(d)), lambda i: CAST(list_sum(list_transform(range(CAST(list_sum(d[1 : i]) AS BIGINT), CAST(list_sum(d[1 : i + 1]) AS BIGINT)), lambda j: 256 * (j % 3 + 1))) AS BIGINT)) AS num_samples FROM (SELECT item_id, list_transform(d, lambda x: x + 1) AS d FROM ({DURATIONS_SQL}))".replace("list_sum(d[1 : i])", "coalesce(list_sum(d[1 : i]), 0)"))
def alignment_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of made-up ids, summed by groups of a word's length plus one."""
    rows = read(spark, sf_dir, "benchmark").select("item_id", F.transform(F.split("text", " "), lambda w: F.length(w) + 1).alias("d"))
    total = F.aggregate("d", F.lit(0), lambda acc, x: acc + x)
    rows = rows.withColumn("ids", F.sequence(F.lit(0), total - 1)).withColumn("n", F.transform("ids", lambda i: (256 * (i % 3 + 1)).cast("bigint")))
    return rows.select("item_id", A.aligned_samples(F.col("ids"), F.col("n"), F.col("d")).alias("num_samples"))


@query(f"SELECT vec_id, list_transform(CASE WHEN vec_id % 2 = 0 THEN a[9:32] ELSE a[9:64] END, lambda x: round(x, 6)) AS clip, 64 / 32.0::DOUBLE AS seconds FROM ({AUDIO_SQL})")
def clip_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of a second on, to one second or past the end, at 32 samples a second."""
    end = F.when(F.col("vec_id") % 2 == 0, 1.0).otherwise(5.0)
    rows = read(spark, sf_dir, "embeddings")
    clip = A.clip_range("embedding", F.lit(0.25), end, 32)
    return rows.select("vec_id", F.transform(clip, lambda x: A.rounded(x, 6)).alias("clip"), (F.size("embedding") / 32).alias("seconds"))


@query("SELECT event_id, CAST(len(list_filter([0.0::DOUBLE, 10, 20, 40, 80], lambda b: value >= b)) - 1 AS INTEGER) AS bin FROM events")
def search_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = F.array(*[F.lit(float(b)) for b in (0, 10, 20, 40, 80)])
    return read(spark, sf_dir, "events").select("event_id", A.count_not_above(bins, F.col("value")).alias("bin"))


@query(f"SELECT vec_id, list_transform(range(32), lambda i: round(a[i + 33] - a[i + 1] - 0.5 + 0.5 * (exp(2 * a[i + 1]) + (a[i + 1] - a[i + 33]) * (a[i + 1] - a[i + 33])) * exp(-2 * a[i + 33]), 6)) AS kl FROM ({AUDIO_SQL})")
def gaussian_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = lambda s: F.transform(F.slice("embedding", s, 32), lambda x: x.cast("double"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", half(1).alias("p"), half(33).alias("q"))
    return rows.select("vec_id", F.transform(A.gaussian_kl(F.col("p"), F.col("p"), F.col("q"), F.col("q")), lambda x: F.round(x, 6)).alias("kl"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.note'), 'none') AS note FROM events WHERE json_valid(props)")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.sources.readers import parsed_json

    rows = parsed_json(read(spark, sf_dir, "events"), "props", "k bigint, note string")
    return rows.filter("valid").select("event_id", "parsed.k", F.coalesce("parsed.note", F.lit("none")).alias("note"))


@query("SELECT event_id, list_sort([event_type, 'user']) AS names, event_type AS first_kept, event_id AS id_of_type FROM events")
def map_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that start with an underscore go; keys sort; a map turns round."""
    m = F.create_map(F.lit("_line"), F.lit("0"), F.col("event_type"), F.col("event_id").cast("string"), F.lit("user"), F.col("user_id").cast("string"))
    rows = read(spark, sf_dir, "events").select("event_id", "event_type", M.public_entries(m).alias("m"))
    back = M.inverted(F.map_filter("m", lambda k, v: k == F.col("event_type")))
    return rows.select("event_id", M.sorted_keys("m").alias("names"), F.try_element_at(back, F.col("event_id").cast("string")).alias("first_kept"), F.try_element_at("m", F.col("event_type")).cast("bigint").alias("id_of_type"))


@query("SELECT item_id, w.word AS word, w.\"end\" - w.start AS seconds FROM (SELECT item_id, unnest(list_transform(string_split(text, ' '), lambda x: {'word': x, 'start': 0.5::DOUBLE, 'end': 0.5::DOUBLE + length(x)})) AS w FROM benchmark)")
def word_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of two recogniser segments a text, as one list."""
    from lectern.functions.phonemes import words_of_segments

    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("word"), F.lit(0.5).alias("start"), (F.lit(0.5) + F.length(w)).alias("end")))
    rows = read(spark, sf_dir, "benchmark").select("item_id", words.alias("w"))
    segments = F.array(F.struct(F.slice("w", 1, 2).alias("words")), F.struct(F.expr("slice(w, 3, size(w))").alias("words")))
    return rows.select("item_id", F.explode(words_of_segments(segments)).alias("w")).select("item_id", "w.word", (F.col("w.end") - F.col("w.start")).alias("seconds"))


@query("SELECT item_id, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS sizes FROM benchmark")
def symbol_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as groups of code points with zeros between them."""
    from lectern.functions.phonemes import symbol_groups as groups

    points = F.transform(F.split("text", ""), lambda c: F.when(c == " ", F.lit(0)).otherwise(F.ascii(c)))
    # A last space starts a group that has nothing in it.
    return read(spark, sf_dir, "benchmark").select("item_id", groups(F.when(F.endswith(F.col("text"), F.lit(" ")), F.concat(points, F.array(F.lit(0)))).otherwise(points)).alias("sizes"))
