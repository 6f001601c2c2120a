"""Quality rules: text statistics, two fixed rules and a robust outlier test.

Everything here is DataFrame and SQL functions; no Python code runs on a row.

``text_statistics`` counts, per whole text, words, symbols, repeated lines and
words inside repeated 8-word windows. ``mcd_estimates`` takes the logarithms of
those counts as a vector and finds, for each language and source, the mean and
covariance of the ``support`` share of rows whose covariance has the least
determinant (minimum covariance determinant):

1. Rows are counted in cells of a grid, with the sums and products of their
   vectors, so all that follows works on cells, of which there are no more
   however many rows there are, and no hot group reaches one task.
2. Four starts: medians with quartile spreads, the covariance of tanh-shrunk
   vectors, that of directions alone, and that of the half nearest the medians.
3. Concentration steps from each start: the share of rows with the smallest
   Mahalanobis distances gives the next mean and covariance, until determinants
   stand still. The start that ends with the least determinant is kept.

To each variance a least variance (``FEATURES``) is added, as most rows of many
groups have no symbol or repeated line at all, which has no inverse. A row is
rejected when its squared distance to its group's estimate is over ``cutoff``;
30 is the 0.999995 quantile of chi-square with four degrees of freedom.

Defined results: null text counts as empty; null language or source is a group
of its own; an empty text fails the base rules and has no distance; rows of a
group with fewer than ``min_group`` usable rows are judged by the estimate over
all rows of their language, and where that has fewer too, over all rows, however
few; each input row gives one row, whatever its id, and repeated rows are
counted as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import WORD, checkpoint

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: The statistic vector and the least standard deviation taken for each part.
FEATURES = {"f_word": 0.05, "f_symbol": 0.5, "f_line": 1.0, "f_repeat": 1.0}
#: Groups up to which tables of one row for each group are broadcast, at some 300 bytes a row.
FEW = 20_000
#: Copies of each estimate beyond that.
SALTS = 64
#: Median of the chi-square distribution with four degrees of freedom.
CHI2_MEDIAN_4 = 3.3567


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: the id, ``keep``, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col), *keep, text.alias("_text"))
    rows = rows.withColumn("_words", F.filter(F.split("_text", SPACE), lambda w: w != ""))
    rows = rows.withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_hash")
    # The size is read beside each lambda, which keeps the optimizer from moving an array into the lambda.
    rows = rows.withColumn(
        "_win",
        F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_hash", i, WINDOW)))),
    )
    repeated = F.size(F.array_distinct("_win")) < F.size("_win")
    # A window's place goes into the low bits of its hash, as many as the text needs, so that longs are sorted.
    rows = rows.withColumn("_bits", F.length(F.bin(F.size("_win").cast("long"))))
    shift = lambda x, name: F.call_function(name, x, F.col("_bits"))
    packed = F.sort_array(F.transform("_win", lambda h, i: shift(h, "shiftleft").bitwiseOR(i.cast("long"))))
    rows = rows.withColumn("_packed", F.when(F.col("_win").isNotNull() & repeated, packed))
    at = lambda x: x.bitwiseAND(shift(F.lit(1).cast("long"), "shiftleft") - 1).cast("int")
    whole = lambda x: F.get("_win", at(x))
    p = F.col("_packed")
    marked = F.transform(
        F.filter(p, lambda x, i: ((i > 0) & (whole(x) == whole(F.get(p, i - 1)))) | ((i < F.size(p) - 1) & (whole(x) == whole(F.get(p, i + 1))))),
        at,
    )
    # Where the bits that are left of two different hashes are equal, whole hashes are sorted.
    mixed = F.exists(F.transform(p, lambda x, i: (i > 0) & (shift(x, "shiftright") == shift(F.get(p, i - 1), "shiftright")) & (whole(x) != whole(F.get(p, i - 1)))), lambda x: x)
    rows = rows.withColumn("_whole", F.when(mixed, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    q = F.col("_whole")
    slowly = F.transform(F.filter(q, lambda x, i: ((i > 0) & (x.h == F.get(q, i - 1).h)) | ((i < F.size(q) - 1) & (x.h == F.get(q, i + 1).h))), lambda x: x.i)
    rows = rows.withColumn("_starts", F.when(p.isNotNull(), F.sort_array(F.when(q.isNotNull(), slowly).otherwise(marked))))
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda acc, s: F.struct((acc.total + WINDOW - F.greatest(F.lit(0), acc.end - s)).alias("total"), (s + WINDOW).alias("end")),
        lambda acc: acc.total,
    )
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
    return rows.select(
        id_col,
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def _features() -> list[Column]:
    share = lambda a, b: F.log1p(F.lit(100.0) * F.col(a) / F.col(b))
    return [
        F.log(F.col("word_chars") / F.col("n_words")).alias("f_word"),
        share("n_symbols", "word_chars").alias("f_symbol"),
        share("n_dup_lines", "n_lines").alias("f_line"),
        share("n_repeat_words", "n_words").alias("f_repeat"),
    ]


def _quantile(rows: DataFrame, keys: list[str], value: str, at: list[float], width: float) -> DataFrame:
    """Upper edges of the bins in which the quantiles of ``value`` fall, per key, each row counted ``_n`` times."""
    bins = rows.groupBy(*keys, F.floor(F.col(value) / width).alias("_bin")).agg(F.sum("_n").alias("_n"))
    up = Window.partitionBy(*keys).orderBy("_bin")
    bins = bins.withColumn("_upto", F.sum("_n").over(up)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    edge = (F.col("_bin") + 1) * width
    return bins.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") >= F.lit(q) * F.col("_all"), edge)).alias(f"_q{k}") for k, q in enumerate(at)])


def _beside(rows: DataFrame, few: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """``rows`` with the row of ``few`` that has their keys; ``small`` says that ``few`` was counted and may be sent out."""
    return rows.join(F.broadcast(few) if small else few, keys)


def _squared(x: list[Column]) -> Column:
    """The squared Mahalanobis distance of a vector, by forward substitution in the Cholesky factor _l of the estimate."""
    z: list[Column] = []
    for i in range(len(x)):
        part = x[i] - F.col(f"_m{i}")
        for j in range(i):
            part = part - F.col(f"_l{i}{j}") * z[j]
        z.append(part / F.col(f"_l{i}{i}"))
    total = z[0] * z[0]
    for part in z[1:]:
        total = total + part * part
    return total


def _factor(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Means ``_m``, the Cholesky factor ``_l`` of the covariances ``_c`` with the least variances, and the logarithm of its determinant."""
    names, n, out = list(FEATURES), len(FEATURES), moments
    for i in range(n):
        for j in range(i + 1):
            c = F.col(f"_c{i}{j}")
            for k in range(j):
                c = c - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            c = F.sqrt(F.greatest(c, F.lit(0.0)) + FEATURES[names[i]] ** 2) if i == j else c / F.col(f"_l{j}{j}")
            out = out.withColumn(f"_l{i}{j}", c)
    det = sum((F.log(f"_l{i}{i}") for i in range(1, n)), F.log("_l00"))
    return out.select(*keys, *[f"_m{i}" for i in range(n)], *[f"_l{i}{j}" for i in range(n) for j in range(i + 1)], (2 * det).alias("_det"))


def _pooled(cells: DataFrame, keys: list[str], min_group: int) -> tuple[DataFrame, DataFrame, bool]:
    """Cells of the pools that judge a group, the pool of each group, and whether groups are few.

    A pool is a prefix of the keys, with "" for the others, and ``_level``, the prefix's length. Each group is judged by
    the longest prefix with ``min_group`` rows, or by all rows.
    """
    groups = checkpoint(cells.groupBy(*keys).agg(F.sum("_n").alias("_n")))
    small = groups.count() <= FEW
    levels, out = range(len(keys), 0, -1), groups
    for k in levels:
        out = _beside(out, groups.groupBy(*keys[:k]).agg(F.sum("_n").alias(f"_n{k}")), keys[:k], small)
    level = F.coalesce(*[F.when(F.col(f"_n{k}") >= min_group, F.lit(k)) for k in levels], F.lit(0))
    out = out.withColumn("_own", level)
    pool = lambda k: [F.lit(k).alias("_level"), *[(F.col(x) if i < k else F.lit("")).alias(f"_p{i}") for i, x in enumerate(keys)]]
    owned = F.coalesce(*[F.when(F.col("_own") == k, F.struct(*pool(k))) for k in [*levels, 0]])
    group = checkpoint(out.select(*keys, owned.alias("_pool")).select(*keys, "_pool.*"))
    names = ["_level", *[f"_p{i}" for i in range(len(keys))]]
    wanted = group.select(*names).distinct()
    # All rows under a pool count in it, also those of groups that have an estimate of their own.
    under = cells.select("*", F.explode(F.array(*[F.struct(*pool(k)) for k in [*levels, 0]])).alias("_pool")).select(*cells.columns, "_pool.*").drop(*keys)
    sums = [c for c in cells.columns if c not in keys and not c.startswith("_b")]
    bins = [c for c in cells.columns if c.startswith("_b")]
    merged = _beside(under, wanted, names, small).groupBy(*names, *bins).agg(*[F.sum(c).alias(c) for c in sums])
    return merged.select(*names, *sums), group, small


def mcd_estimates(rows: DataFrame, keys: list[str], support: float = 0.75, steps: int = 12, min_group: int = 50) -> tuple[DataFrame, bool]:
    """Per group of ``keys`` (strings without nulls) the estimate that judges its rows, and whether groups are few.

    ``rows`` has the keys and the vector. Steps end when no logarithm of a determinant moves by 0.001, or after ``steps``.
    """
    names, n = list(FEATURES), len(FEATURES)
    pairs = [(i, j) for i in range(n) for j in range(i + 1)]
    grid = [F.floor(F.col(x) / (FEATURES[x] / 5)).alias(f"_b{i}") for i, x in enumerate(names)]
    sums = [F.sum(x).alias(f"_s{i}") for i, x in enumerate(names)] + [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"_s{i}{j}") for i, j in pairs]
    cells, group, small = _pooled(checkpoint(rows.groupBy(*keys, *grid).agg(F.count("*").alias("_n"), *sums)), keys, min_group)
    cells = checkpoint(cells.select("*", *[(F.col(f"_s{i}") / F.col("_n")).alias(f"_x{i}") for i in range(n)]))
    pool = ["_level", *[f"_p{i}" for i in range(len(keys))]]
    x = [F.col(f"_x{i}") for i in range(n)]

    # Medians and spreads of each part.
    long = cells.select(*pool, "_n", F.posexplode(F.array(*x)).alias("_i", "_x"))
    spread = _quantile(long, [*pool, "_i"], "_x", [0.25, 0.5, 0.75], 0.01)
    part = lambda i, c: F.max(F.when(F.col("_i") == i, c))
    start = spread.groupBy(*pool).agg(
        *[part(i, F.col("_q1")).alias(f"_m{i}") for i in range(n)],
        *[part(i, F.sqrt(((F.col("_q2") - F.col("_q0")) / 1.349) ** 2 + FEATURES[name] ** 2)).alias(f"_u{i}") for i, name in enumerate(names)],
    )
    start = checkpoint(start)
    centred = _beside(cells, start, pool, small)
    z = [(x[i] - F.col(f"_m{i}")) / F.col(f"_u{i}") for i in range(n)]
    norm = F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0]))
    near = _quantile(centred.select(*pool, "_n", norm.alias("_norm")), pool, "_norm", [0.5], 1 / 64).withColumnRenamed("_q0", "_half")
    shapes = {
        1: [F.tanh(v) for v in z],
        2: [v / F.greatest(norm, F.lit(1e-9)) for v in z],
        3: [F.when(norm <= F.col("_half"), v).otherwise(0.0) for v in z],
    }
    moment = lambda v, i, j: F.sum(F.col("_n") * v[i] * v[j]) / F.sum("_n") * F.first(F.col(f"_u{i}")) * F.first(F.col(f"_u{j}"))
    shaped = _beside(centred, near, pool, small).groupBy(*pool).agg(
        *[F.first(f"_m{i}").alias(f"_m{i}") for i in range(n)],
        *[moment(v, i, j).alias(f"_v{k}{i}{j}") for k, v in shapes.items() for i, j in pairs],
        *[F.first(f"_u{i}").alias(f"_u{i}") for i in range(n)],
    )
    scatter = lambda k, i, j: (F.col(f"_u{i}") ** 2 if i == j else F.lit(0.0)) if k == 0 else F.col(f"_v{k}{i}{j}")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("_start"), *[scatter(k, i, j).alias(f"_c{i}{j}") for i, j in pairs]) for k in range(4)]))
    means = [f"_m{i}" for i in range(n)]
    run = [*pool, "_start"]
    estimate = checkpoint(_factor(shaped.select(*pool, *means, each.alias("_e")).select(*pool, *means, "_e.*"), run))

    for step in range(steps):
        far = _beside(cells, estimate, pool, small).withColumn("_ln", F.log(_squared(x) + 1e-9)).select(*run, "_n", "_ln", *[c for c in cells.columns if c.startswith("_s")])
        edge = _quantile(far, run, "_ln", [support], 1 / 64)
        held = _beside(far, edge, run, small).filter(F.col("_ln") < F.col("_q0")).groupBy(*run).agg(*[(F.sum(c) / F.sum("_n")).alias(c) for c in far.columns if c.startswith("_s") and c != "_start"])
        held = held.select(*run, *[F.col(f"_s{i}").alias(f"_m{i}") for i in range(n)], *[(F.col(f"_s{i}{j}") - F.col(f"_s{i}") * F.col(f"_s{j}")).alias(f"_c{i}{j}") for i, j in pairs])
        new = checkpoint(_factor(held, run))
        moved = estimate.select(*run, F.col("_det").alias("_was")).join(new.select(*run, "_det"), run).agg(F.max(F.abs(F.col("_det") - F.col("_was")))).first()[0]
        estimate = new
        if step and (moved is None or moved < 1e-3):
            break
    best = estimate.groupBy(*pool).agg(F.min_by(F.struct(*[c for c in estimate.columns if c not in pool]), F.struct("_det", "_start")).alias("_e")).select(*pool, "_e.*")
    # The median distance fixes the scale that the concentrated part is too small by.
    final = _beside(cells, best, pool, small).select(*pool, "_n", F.log(_squared(x) + 1e-9).alias("_ln"))
    scale = _quantile(final, pool, "_ln", [0.5], 1 / 64).select(*pool, F.greatest(F.lit(1.0), F.exp("_q0") / CHI2_MEDIAN_4).alias("_scale"))
    judged = _beside(group, _beside(best, scale, pool, small), pool, small).drop(*pool, "_start")
    return checkpoint(judged), small


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"), cutoff: float = 30.0, min_group: int = 50, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row with its statistics, ``base_failed``, ``distance``, ``outlier``, ``kept`` and the columns ``carry``."""
    keys = [f"_g{i}" for i, _ in enumerate(group_cols)]
    carried = [f"_carry{i}" for i, _ in enumerate(carry)]
    # Null is a group beside all values.
    named = df.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_source_text"), *[F.col(c).alias(k) for c, k in zip(carry, carried)],
        *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias(k) for c, k in zip(group_cols, keys)],
    )
    stats = text_statistics(named, "_id", "_source_text", (*keys, *carried)).withColumn("base_failed", base_failed())
    stats = checkpoint(stats.select("*", *[F.when(F.col("n_words") > 0, f).alias(name) for name, f in zip(FEATURES, _features())]))
    found, small = mcd_estimates(stats.filter("n_words > 0").select(*keys, *FEATURES), keys, min_group=min_group)
    if small:
        judged = stats.join(F.broadcast(found), keys, "left")
    else:  # a hot group's rows meet copies of its estimate in several tasks
        salt = F.pmod(F.xxhash64("n_words", "word_chars", "n_repeat_words"), F.lit(SALTS)).cast("int")
        copies = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        judged = stats.withColumn("_salt", salt).join(copies, [*keys, "_salt"], "left")
    distance = _squared([F.col(x) for x in FEATURES]) / F.col("_scale")
    judged = judged.withColumn("distance", distance).withColumn("outlier", F.coalesce(F.col("distance") > cutoff, F.lit(False)))
    return judged.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "outlier", (~F.col("base_failed") & ~F.col("outlier")).alias("kept"),
        *[F.col(k).alias(c) for c, k in zip(carry, carried)],
    )
