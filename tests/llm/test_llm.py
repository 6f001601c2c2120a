"""The training-data operators against brute force, round trips and held-out labels, with nulls, ties and empty tables."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


def docs_of(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], schema)


@pytest.fixture(scope="module")
def tricky():
    rng = random.Random(9)
    texts = [None, "", " \n\t ", "a", "one two three", prose(rng, 30), prose(rng, 3000)]
    base = prose(rng, 120).split()
    texts += [" ".join(base)] * 4  # copies
    for _ in range(12):  # near copies at all distances
        w = list(base)
        for _ in range(rng.randrange(1, 7)):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        texts.append(" ".join(w))
    shared = prose(rng, 60)
    texts += [prose(rng, rng.randrange(5, 60)) + "\n" + shared + "\n" + prose(rng, rng.randrange(5, 60)) for _ in range(8)]
    texts += [" ".join(base[: k]) for k in range(3, 14)]  # small sets
    return texts


# --- near duplicates -------------------------------------------------------------------------


def brute_components(texts, k, percent):
    sets = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a = len(sets[i] & sets[j])
            if a and 100 * a >= percent * (len(sets[i]) + len(sets[j]) - a):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


SMALL = {"short": 3, "list_bits": 2, "cores": 1, "block": 8, "side": 4}


@pytest.mark.parametrize("k,percent,limits", [(5, 80, {}), (4, 85, SMALL), (4, 85, SMALL | {"list_bits": 9})])
def test_components_equal_brute_force(spark, tricky, k, percent, limits):
    from lectern.llm import jaccard_join as J

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs_of(spark, tricky), k=k, percent=percent, limits=J.Limits(**limits)).collect()}
    assert got == brute_components(tricky, k, percent)


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_links_equal_brute_force(spark, tricky, limits):
    from lectern.llm import jaccard_join as J

    links, members = J.jaccard_links(docs_of(spark, tricky), limits=J.Limits(**limits))
    sets = {}
    for i, t in enumerate(tricky):
        w = (t or "").lower().split()
        own = frozenset(tuple(w[j : j + 4]) for j in range(len(w) - 3)) or (frozenset([tuple(w)]) if w else None)
        if own:
            sets.setdefault(own, []).append(i)
    assert {r.doc_id: r.class_id for r in members.collect()} == {i: min(m) for m in sets.values() for i in m}
    want = {(min(x[0], y[0]), max(x[0], y[0])) for a, x in sets.items() for b, y in sets.items() if x[0] < y[0] and 100 * len(a & b) >= 85 * len(a | b)}
    assert {(r.a, r.b) for r in links.collect()} == want and want


def test_family_below_the_threshold_is_met_block_by_block(spark):
    """Near copies that do not link: no task holds more than two blocks, and none is linked."""
    from lectern.llm import jaccard_join as J

    rng = random.Random(4)
    base, texts = prose(rng, 120).split(), []
    for i in range(400):
        w = list(base)
        for at in rng.sample(range(0, 120, 6), 4):
            w[at] = f"y{i}x{at}"
        texts.append(" ".join(w))
    texts += [texts[7] + " more", texts[300] + " more"]
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(spark, texts), limits=J.Limits(side=64)).collect()}
    assert got == {i: c for i, (_, c) in brute_components(texts, 4, 85).items()} and len(set(got.values())) > 300


def test_rows_without_an_id_and_repeated_rows(spark):
    from lectern.llm.jaccard_join import jaccard_components

    t, other = "one two three four five six seven", "a text of its own with words"
    rows = [(None, t), (None, other), (None, None), (3, t), (3, t), (4, t)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([(None, 4, 3), (None, 4, None), (None, 0, None), (3, 4, 3), (3, 4, 3), (4, 4, 3)])


@pytest.mark.parametrize("boundary", [1000])
def test_components_with_either_branch(spark, tricky, monkeypatch, boundary):
    from lectern.llm import jaccard_join as J

    monkeypatch.setattr(J, "_boundary", lambda sized: boundary)
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs_of(spark, tricky)).collect()}
    assert got == {i: c for i, (_, c) in brute_components(tricky, 4, 85).items()}


def test_connected_components_chain_and_star(spark):
    from lectern.llm.components import connected_components

    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    for few in (0, 10, 1000):
        got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), few).collect()}
        assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(20)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated strings ------------------------------------------------------------------------


def test_suffix_array_and_prefixes():
    from lectern.llm.suffix_array import permuted_prefixes, suffix_array

    rng = random.Random(1)
    for trial in range(300):
        s = bytes(rng.randrange(rng.choice([1, 2, 4, 256])) for _ in range(rng.randrange(0, 50))) * rng.choice([1, 1, 3])
        t = np.frombuffer(s, dtype=np.uint8)
        sa = suffix_array(t)
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert sa.tolist() == want
        if len(s) > 1:
            before, common = permuted_prefixes(t, sa)
            for a, b in zip(want, want[1:]):
                n = 0
                while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                    n += 1
                assert before[b] == a and common[b] == n


def test_both_induced_sorts_agree_and_recursion_goes_deep(monkeypatch):
    from lectern.llm import suffix_array as A

    rng, depth, deepest = random.Random(12), [0], [0]
    inner = A.suffix_array

    def counted(t, alphabet=256):
        depth[0] += 1
        deepest[0] = max(deepest[0], depth[0])
        try:
            return inner(t, alphabet)
        finally:
            depth[0] -= 1

    monkeypatch.setattr(A, "suffix_array", counted)
    for trial in range(60):
        if trial % 2:  # a Fibonacci word, whose numbers repeat on every level
            a, b = b"b", b"a"
            for _ in range(12 + trial % 5):
                a, b = b, b + a
            s = b
        else:
            words = [bytes(rng.randrange(97, 100) for _ in range(rng.randrange(1, 6))) for _ in range(40)]
            s = b" ".join(rng.choice(words) for _ in range(400)) * 2
        want = sorted(range(len(s)), key=lambda i: s[i:])
        t = np.frombuffer(s, dtype=np.uint8)
        for limit in (512, 0):
            monkeypatch.setattr(A, "ALPHABET", limit)
            assert counted(t).tolist() == want
    assert deepest[0] >= 3
    wide = np.array([rng.randrange(5000) for _ in range(3000)] * 2)
    assert inner(wide, 5000).tolist() == sorted(range(6000), key=lambda i: wide[i:].tolist())
    assert inner(np.zeros(5000, dtype=np.uint8)).tolist() == list(range(4999, -1, -1))


def brute_removed(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = {}
    for k, r in enumerate(raws):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[k] = (len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_strings_equal_brute_force(spark, tricky):
    from lectern.llm import suffix_dedup as S

    texts = [*tricky, "ab" * 300, "é" * 250, "x" * 199, "x" * 199, "y" * 200, "y" * 200, "q" * 150 + "z" * 100, "q" * 150 + "z" * 100 + "w"]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.dedup(docs_of(spark, texts))).collect()}
    assert got == brute_removed(texts, 200)


def test_a_common_passage_is_dealt_to_several_shards(spark):
    """Many different contexts of one passage: the same result whether its contents share a shard or not."""
    from lectern.llm import suffix_dedup as S

    rng = random.Random(13)
    passage = prose(rng, 60)
    texts = [prose(rng, 12) + " " + passage + " " + prose(rng, 12) for _ in range(60)]
    texts += [t[:40] + texts[0][40:] for t in texts[:10]]
    want = brute_removed(texts, 200)
    assert sum(x[1] > 0 for x in want.values()) > 50
    for split in (4, 4096):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.dedup(docs_of(spark, texts), split=split)).collect()}
        assert got == want


def test_copies_of_a_text_are_listed_once(spark, monkeypatch):
    """What is stored on the way does not grow with the copies of a text, and what others share with it is found."""
    from lectern.llm import suffix_dedup as S

    rng, stored = random.Random(17), []
    monkeypatch.setattr(S, "checkpoint", lambda df, real=S.checkpoint: (out := real(df), stored.append(out.count()))[0])
    text, other = prose(rng, 400), prose(rng, 200)
    single = [prose(rng, 50) + text[300:700] + prose(rng, 50), other, text[:250]]
    sizes = []
    for copies in (2, 22):
        texts = [text] * copies + single
        stored.clear()
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.dedup(docs_of(spark, texts))).collect()}
        assert got == brute_removed(texts, 200)
        sizes.append(sum(stored))
    assert sizes[1] <= sizes[0] + 20  # a row for each further copy


def test_repeated_strings_without_ids_and_with_repeated_ones(spark):
    from lectern.llm import suffix_dedup as S

    rng = random.Random(15)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(None, a), (1, a), (2, b), (2, c), (3, c[:300]), (None, None)]
    got = Counter((r.doc_id, r.n_removed) for r in S.digest(S.dedup(spark.createDataFrame(rows, "doc_id long, text string"))).collect())
    assert got == Counter([(None, len(a)), (1, len(a)), (2, 0), (2, 300), (3, 300), (None, 0)])


def test_judged_lists_do_not_hang_on_batches():
    import pyarrow as pa

    from lectern.llm.suffix_dedup import _judged

    rng = random.Random(16)
    rows = sorted((rng.randrange(6), rng.randrange(4), rng.randrange(1, 3), rng.randrange(9), rng.randrange(9)) for _ in range(60))
    names = ["anchor", "content", "times", "id", "start"]
    whole = pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))

    def result(size):
        out = [b.to_pylist() for b in _judged(iter([whole.slice(k, size) for k in range(0, 60, size)]), 2)]
        return {(r["anchor"], r["content"]): r for part in out for r in part}

    want = result(60)
    for size in (1, 2, 7, 25):
        got = result(size)
        for key, r in want.items():  # what needs comparing may grow, never shrink
            assert got[key]["whole"] == r["whole"] and got[key]["open"] >= r["open"] and got[key]["block"] == r["block"]


def test_repeated_strings_of_long_texts_in_parts(spark, monkeypatch):
    from lectern.llm import suffix_dedup as S

    rng = random.Random(3)
    text = prose(rng, 400)
    monkeypatch.setattr(S, "PART", 500)
    whole = S.stretches(text.encode())
    assert (np.diff(whole[1]) == whole[2][:-1]).all() and whole[2].sum() == len(text) - 199
    texts = [text, prose(rng, 50) + text[700:1500] + prose(rng, 50)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.dedup(docs_of(spark, texts))).collect()}
    assert got == brute_removed(texts, 200)


# --- quality rules ---------------------------------------------------------------------------


def brute_statistics(t):
    w = [x.decode() for x in (t or "").encode().split()]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside))


def test_statistics_equal_brute_force(spark, tricky):
    from lectern.llm.quality_rules import quality_rules

    rng = random.Random(8)
    texts = [*tricky, "a b c d e f g h " * 5, "w " * 40, "x | y # z\nx | y # z\n\n \nx | y # z", " ".join(rng.choice("abc") for _ in range(400)), "é\x0bü\x0cß\r\nü"]
    df = docs_of(spark, texts)
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    for i, t in enumerate(texts):
        want = brute_statistics(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def brute_mcd(vectors, floors, support=0.75, steps=12):
    """The same estimator on one group's rows in numpy; cells and bins as documented."""
    floors = np.array(floors)
    cells = {}
    for v in vectors:
        cells.setdefault(tuple(np.floor(v / (floors / 5)).astype(int)), []).append(v)
    n = np.array([len(c) for c in cells.values()], dtype=float)
    x = np.array([np.mean(c, axis=0) for c in cells.values()])
    s1 = np.array([np.sum(c, axis=0) for c in cells.values()])
    s2 = np.array([sum(np.outer(v, v) for v in c) for c in cells.values()])

    def quantile(values, q, width):
        order = np.argsort(np.floor(values / width), kind="stable")
        upto = np.cumsum(n[order])
        return (np.floor(values[order][np.searchsorted(upto, q * n.sum())] / width) + 1) * width

    def far(m, c):
        lower = np.linalg.cholesky(c + np.diag(floors**2))
        z = np.linalg.solve(lower, (x - m).T)
        return (z**2).sum(axis=0), 2 * np.log(np.diag(lower)).sum()

    m = np.array([quantile(x[:, i], 0.5, 0.01) for i in range(4)])
    u = np.array([np.sqrt(((quantile(x[:, i], 0.75, 0.01) - quantile(x[:, i], 0.25, 0.01)) / 1.349) ** 2 + floors[i] ** 2) for i in range(4)])
    z = (x - m) / u
    norm = np.sqrt((z**2).sum(axis=1))
    half = quantile(norm, 0.5, 1 / 64)
    shape = lambda v: (v * n[:, None]).T @ v / n.sum() * np.outer(u, u)
    starts = [np.diag(u**2), shape(np.tanh(z)), shape(z / np.maximum(norm, 1e-9)[:, None]), shape(np.where(norm[:, None] <= half, z, 0.0))]
    best = None
    for c in starts:
        mean, det = m, far(m, c)[1]
        for step in range(steps):
            d, _ = far(mean, c)
            ln = np.log(d + 1e-9)
            own = ln < quantile(ln, support, 1 / 64)
            mean = s1[own].sum(axis=0) / n[own].sum()
            c = s2[own].sum(axis=0) / n[own].sum() - np.outer(mean, mean)
            was, det = det, far(mean, c)[1]
            if step and abs(det - was) < 1e-3:
                break
        if best is None or det < best[0]:
            best = (det, mean, c)
    d, _ = far(best[1], best[2])
    scale = max(1.0, np.exp(quantile(np.log(d + 1e-9), 0.5, 1 / 64)) / 3.3567)
    lower = np.linalg.cholesky(best[2] + np.diag(floors**2))
    return lambda v: (np.linalg.solve(lower, np.asarray(v) - best[1]) ** 2).sum() / scale


def test_distances_equal_numpy(spark):
    from pyspark.sql import functions as F

    from lectern.llm import quality_rules as Q

    rng = np.random.default_rng(5)
    made = {("=a", "=s"): rng.normal([1.6, 0.5, 0.4, 0.3], [0.1, 0.6, 0.5, 0.8], (400, 4)), ("=b", "=s"): rng.normal([1.2, 2.5, 0.1, 1.3], [0.3, 0.2, 0.9, 0.5], (300, 4))}
    made["=a", "=s"][:60] += [2.0, 3.0, 0.0, 3.0]
    rows = [(*k, *map(float, v)) for k, vs in made.items() for v in vs]
    names = list(Q.FEATURES)
    df = spark.createDataFrame(rows, "_g0 string, _g1 string, " + ", ".join(f"{x} double" for x in names))
    found, small = Q.mcd_estimates(df, ["_g0", "_g1"])
    assert small
    got = df.join(found, ["_g0", "_g1"]).select("_g0", "_g1", *names, (Q._squared([F.col(x) for x in names]) / F.col("_scale")).alias("d")).collect()
    assert len(got) == len(rows)
    judge = {k: brute_mcd(v, list(Q.FEATURES.values())) for k, v in made.items()}
    for r in got:
        want = judge[r._g0, r._g1]([r[x] for x in names])
        assert abs(r.d - want) < 0.05 * want + 0.05, (r, want)
    far = [r.d for r in got if r._g0 == "=a" and r.f_word > 3]
    assert len(far) > 40 and min(far) > 30


def test_rows_are_judged_one_by_one_whatever_their_ids(spark):
    from lectern.llm.quality_rules import quality_rules

    rng = random.Random(17)
    rows = [(i % 50 if i < 150 else None, prose(rng, 100) if i % 3 else "too short", "en", "s", i) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _g0 int")
    got = quality_rules(df, carry=("_g0", "text")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got) == sorted((r[0] is None, r[0] or 0, r[1]) for r in rows)
    assert all(r.kept == (r.text != "too short") and r.distance is not None for r in got)


def test_outliers_go_and_clean_rows_stay(spark):
    from lectern.llm.quality_rules import quality_rules

    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(60, 400)), rng.choice(["en", None]), "s") for i in range(400)]
    rows += [(400 + i, " ".join(w + "***" for w in prose(rng, 200).split()), "en", "s") for i in range(20)]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(400)) and not any(got[400 + i] for i in range(20))


def test_small_groups_are_judged_by_a_pool(spark):
    from lectern.llm.quality_rules import quality_rules

    rng = random.Random(11)
    spam = lambda: " ".join(w + "***" for w in prose(rng, 200).split())
    rows = [(i, prose(rng, rng.randrange(60, 400)), "en", "s") for i in range(200)]
    # A small source of a large language, and small languages; each with one row of symbols.
    rows += [(200 + i, prose(rng, rng.randrange(60, 400)), *[("en", "t"), ("de", "s"), (None, None)][i % 3]) for i in range(30)]
    rows += [(300 + i, spam(), lang, source) for i, (lang, source) in enumerate([("en", "t"), ("de", "s"), (None, None), ("xx", "y")])]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len(got) == len(rows) and all(r.distance is not None for r in got.values())
    assert all(got[i].kept == (i < 300) for i in got)


# --- language, quality, toxicity -------------------------------------------------------------


def test_language_mixtures(spark):
    from pyspark.sql import functions as F

    from lectern.llm import language_id as L

    rng = random.Random(4)
    words = {"aa": "kala mata suli pora neva".split(), "bb": "stromb grint flosk druhn werft".split()}
    say = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    rows = [(i, say("ab"[i % 2] * 2, 40), "ab"[i % 2] * 2) for i in range(60)] + [(60, None, "aa"), (61, "12 34 !!", "aa"), (62, say("aa", 60) + " " + say("bb", 60), None), (63, "kala", None), (64, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.identify(df, L.train(df, "text", "lang", F.lit(True))).collect()}
    assert all(got[i].lang_pred == "ab"[i % 2] * 2 and got[i].score > 0.9 for i in range(60))
    assert {got[i].lang_pred for i in (60, 61, 64)} == {"und"} and got[60].score == 0.0
    assert got[62].languages == ["aa", "bb"] and min(got[62].proportions) > 0.3
    assert got[63].lang_pred == "aa"
    empty = L.train(df.filter("false"), "text", "lang", F.lit(True))
    assert {r.lang_pred for r in L.identify(df, empty).collect()} == {"und"}


def test_pairwise_quality_orders_held_out_rows(spark, sf_dir):
    from lectern.llm.queries import op5_pairwise_quality

    got = op5_pairwise_quality(spark, sf_dir)
    assert got.count() == 200
    rows = got.filter("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.8
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_pairwise_quality_without_labels():
    from lectern.llm.pairwise_quality import features, fit_bradley_terry, score_matrix

    x = np.array([features(t) for t in ("", "a b", "z" * 5000)])
    for labels in (np.array([1, 1, 1]), np.array([], dtype=int)):
        model = fit_bradley_terry(x[: len(labels)], labels)
        assert np.allclose(score_matrix(x, model), 0.7)


def test_toxicity_chain(spark, sf_dir):
    from lectern.llm import toxicity
    from lectern.llm.queries import TOXICITY

    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        words = prose(rng, 80).split()
        if bad:
            words[10:10] = ["grobnik", "flumox"]
        rows.append((i, " ".join(words)))
        labels.append((i, i % 3 and 1, int(bad)))
    rows += [(300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(999, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, marks, TOXICITY)
    got = {r.doc_id: r for r in toxicity.judge(df, model).collect()}
    assert all(got[i].is_toxic == (i % 4 == 0) for i in range(300))
    assert not got[300].is_toxic and not got[301].is_toxic
    none = toxicity.train(df, marks.filter("false"), TOXICITY)
    assert not any(r.is_toxic for r in toxicity.judge(df, none).collect())


def test_language_id_of_long_texts_and_repeated_ones(spark):
    from pyspark.sql import functions as F

    from lectern.llm import language_id as L

    rng = random.Random(18)
    words = {"aa": "kala mata suli pora neva".split(), "bb": "stromb grint flosk druhn werft".split()}
    text = " ".join(rng.choice(words["aa"]) for _ in range(3000))
    whole = L.gram_counts(text)
    window, L.WINDOW = L.WINDOW, 1000
    try:
        parts = L.gram_counts(text)
    finally:
        L.WINDOW = window
    assert all((a == b).all() for a, b in zip(whole, parts))
    rows = [(i, "kala mata", "aa") for i in range(500)] + [(500 + i, " ".join(rng.choice(words[k]) for _ in range(30)), k) for i, k in enumerate(["aa", "bb"] * 20)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "text", "lang", F.lit(True))
    again = L.train(spark.createDataFrame(rows[499:], "doc_id long, text string, lang string"), "text", "lang", F.lit(True))
    assert (model["dense"] == again["dense"]).all()  # a repeated text is learnt from once


def test_language_of_held_out_documents(spark, sf_dir):
    from lectern.llm.queries import op1_language_id

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = [(r.lang_pred, lang[r.doc_id]) for r in op1_language_id(spark, sf_dir).collect() if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    assert len(out) > 20 and sum(a == b for a, b in out) > 0.9 * len(out)


def test_later_models_use_earlier_probabilities_and_copies_share_a_fold():
    from lectern.llm import toxicity as T

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3)).astype(np.float32)
    first = (x[:, 0] > 0.8).astype(np.float32)
    both = np.stack([first, np.maximum(first, (x[:, 1] > 1.2).astype(np.float32))], axis=1)
    model = T.fit_chain(x, both, np.arange(400))
    verdict = T.run_chain(x, model)[:, 1] >= model["cuts"][1]
    assert (verdict == (both[:, 1] == 1)).mean() > 0.9
    cut = {"weights": [model["weights"][0], model["weights"][1].copy()], "cuts": model["cuts"]}
    cut["weights"][1][3] = 0.0  # the weight of the first category's probability
    assert ((T.run_chain(x, cut)[:, 1] >= model["cuts"][1]) != verdict).any()
    # Labels by chance: with copies in one fold, nothing is known of a row's label out of fold.
    noise = rng.normal(size=(60, 40)).astype(np.float32)
    marks = rng.integers(0, 2, 60).astype(np.float32)
    copies, labels, keys = np.repeat(noise, 5, axis=0), np.repeat(marks, 5)[:, None], np.repeat(np.arange(60), 5)
    apart = T.fit_chain(copies, labels, np.arange(300))["cuts"][0]
    together = T.fit_chain(copies, labels, keys)["cuts"][0]
    assert together < apart


def test_bradley_terry_reaches_the_least_loss():
    from lectern.llm import pairwise_quality as P

    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4))
    y = (x @ [1.0, -2.0, 0.5, 0.0] + rng.logistic(size=300) > 0).astype(int)
    model = P.fit_bradley_terry(x, y, pairs=4000)
    z, draw = P._expand(x, model), np.random.default_rng(7)
    d = z[draw.choice(np.flatnonzero(y == 1), 4000)] - z[draw.choice(np.flatnonzero(y == 0), 4000)]
    loss = lambda w: np.log1p(np.exp(-d @ w)).sum() + 0.5 * w @ w
    w = np.zeros(8)
    for _ in range(4000):  # plain gradient descent
        w -= 0.0005 * (d.T @ (1 / (1 + np.exp(-(d @ w))) - 1) + w)
    assert abs(loss(w) - loss(model["w"])) < 1e-3 * loss(w) and np.abs(w - model["w"]).max() < 0.05
    words = [rng.choice(["a", "b", "c"]) for _ in range(200)]
    assert P.distinct_triples(words) == len(set(zip(words, words[1:], words[2:]))) and P.distinct_triples(["a", "b"]) == 0


# --- secrets ---------------------------------------------------------------------------------


def test_base_spans():
    from lectern.llm.secret_scan import scan_text

    text = "Token: abcdef password=short api-key='Zz9+/_.=-x' AKIA" + "A1" * 8 + " " + "0a" * 12 + " token=token:abcdefgh"
    got = [(k, text[s:e]) for k, s, e in scan_text(text).base]
    assert got == [("assign", "Token: abcdef"), ("access", "AKIA" + "A1" * 8), ("hex", "0a" * 12)]
    assert scan_text("pasſword=abcdefgh").base == []


@pytest.mark.parametrize("layers", [["b64"], ["url"], ["unicode"], ["gzip", "b64"], ["url", "b64"], ["b64", "url", "b64"], ["zlib", "b64", "unicode"]])
def test_nested_layers_map_to_the_encoded_part(layers):
    from lectern.llm.secret_scan import scan_text

    data = b"secret = hunter22222 and more words to make this long enough"
    for layer in layers:
        if layer == "b64":
            data = base64.b64encode(data)
        elif layer == "url":
            data = "".join(f"%{b:02X}" for b in data).encode()
        elif layer == "unicode":
            data = "".join(f"\\u{b:04x}" for b in data).encode()
        else:
            data = gzip.compress(data) if layer == "gzip" else zlib.compress(data)
    inner = data.decode()
    text = "prefix é: " + inner + " suffix"
    found = scan_text(text)
    spans = [s for s in found.spans if s not in found.base]
    assert spans and all(k == "assign" and 10 <= s < e <= 10 + len(inner) for k, s, e in spans)


def test_wrapped_and_unaligned_base64_is_read():
    from lectern.llm.secret_scan import scan_text

    rng = random.Random(12)
    plain = lambda n: (prose(rng, n) + "\npassword=hunter22222 " + prose(rng, n)).encode()
    for width, end in ((76, "\n"), (64, "\r\n"), (11, "\n  "), (48, " \n\t")):
        for n in range(4, 16):
            for data in (plain(n), gzip.compress(plain(n)), b"\x00\xff" * n + zlib.compress(plain(n))):
                token = base64.b64encode(data).decode()
                lines = end.join(token[i : i + width] for i in range(0, len(token), width))
                for head, tail in (("é: ", " ."), ("-----BEGIN X-----\n", "\n-----END X-----"), ("a word\n", "\nand more")):
                    got = scan_text(head + lines + tail)
                    spans = [s for s in got.spans if s not in got.base]
                    assert any(k == "assign" for k, _, _ in spans), (width, n, head)
                    # Neighbours may decode to some characters more, never to less than the secret's lines.
                    assert any(s < len(head) + len(lines) and e > len(head) for k, s, e in spans if k == "assign")
    token = base64.b64encode(plain(20)).decode()
    lines = "\n".join(token[i : i + 76] for i in range(0, len(token), 76))
    (_, start, end), = [s for s in scan_text(lines).spans if s[0] == "assign"]
    inside = base64.b64decode(lines[start:end])
    assert b"password=hunter22222" in inside and len(inside) <= 2 * 57
    for head in ("https://h.example/a/", "https://h.example/ab-c/", "https://h.example/abc_", "id-1/"):
        for raw in (b"password=hunter22222", gzip.compress(b"password=hunter22222")):
            text = head + base64.b64encode(raw).decode().rstrip("=") + " ."
            got = scan_text(text).spans
            assert any(k == "assign" and s < e <= len(text) - 2 and s >= 10 for k, s, e in got) or head == "id-1/" and got, head


def test_percent_runs_are_read_around_other_bytes():
    from lectern.llm.secret_scan import scan_text

    run = "".join(f"%{b:02X}" for b in b"\xff\xe9secret=hunter22\xfe\xc3")
    (_, start, end), = scan_text("é " + run).spans
    assert bytes.fromhex(("é " + run)[start:end].replace("%", "")) == b"secret=hunter22"
    assert [s[0] for s in scan_text(base64.b64encode(b"\xfftoken=hunter22\xff\xff").decode()).spans] == ["assign"]


def test_scan_ends_and_handles_odd_input(spark):
    from lectern.llm import secret_scan as S

    texts = [None, "", "%", "\\u", "%zz%41%", "QUFB" * 2000, "\\ud83d\\ude00 \\ud83d", "z" * 200_000, "=" * 50, "%25" * 500]
    got = S.digest(S.scan(docs_of(spark, texts))).collect()
    assert len(got) == len(texts) and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    bomb = base64.b64encode(zlib.compress(b"a" * 100_000)).decode()
    assert S.scan_text(bomb, max_layer=1000).skipped == 1
    redacted = S.redact(docs_of(spark, ["x token=abcdefgh y", None, "plain"])).orderBy("doc_id").collect()
    assert [r.text for r in redacted] == ["x [SECRET] y", None, "plain"]


def test_large_layers_are_scanned_in_windows(spark):
    from lectern.llm import secret_scan as S

    rng = random.Random(13)
    wrap = lambda t: "é " + base64.b64encode(zlib.compress(t.encode())).decode() + " ."
    inner = base64.b64encode(gzip.compress(b"an inner layer has api_key = hunter22222")).decode()
    for secret in ("password : hunter22222", inner, "AKIA" + "Z9" * 8, "%70assword%3Dhunter22222", "passwd" + " " * 200 + "=" + " " * 200 + "hunter22222"):
        for n in range(0, 240, 12):
            text = wrap(prose(rng, 300 + n) + " " + secret + " " + prose(rng, 300))
            found = S.scan_text(text, max_layer=1000)
            assert {(s, e) for _, s, e in found.spans} == {(2, len(text) - 2)} and found.skipped == 0, (secret, n)
            assert found.spans == S.scan_text(text).spans and found.layers >= 1
    big = wrap("filler, " * (S.MAX_LAYER // 4) + "password=hunter22222")
    assert [k for k, _, _ in S.scan_text(big).spans] == ["assign"]
    # Without a place to cut, the whole encoded part goes.
    texts = [big, wrap("x" * S.MAX_LAYER + "y" * 10), wrap("filler, " * (S.MAX_LAYER // 4))]
    redacted = [r.text for r in S.redact(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert redacted == ["é [SECRET] ."] * 2 + texts[2:]


# --- decontamination -------------------------------------------------------------------------


def brute_distance(item, text):
    """Least edit distance of item to any part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_leaks_equal_brute_force(spark):
    from lectern.llm import decontaminate as D

    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(8, 30))) for i in range(12)] + [(12, "tiny"), (13, None), (14, ""), (15, "...")]
    texts = [None, "", prose(rng, 300), "it is tiny.", "tinyish"]
    for i, (key, item) in enumerate(items[:12]):
        chars = list(item)
        for _ in range(i % 8):
            p = rng.randrange(len(chars))
            rng.choice([lambda: chars.insert(p, "q"), lambda: chars.pop(p), lambda: chars.__setitem__(p, "z")])()
        texts += [prose(rng, 40) + " " + "".join(chars).upper() + "!! " + prose(rng, 40), item[: len(item) // 2] + prose(rng, 20), item]
    docs = docs_of(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    form = lambda t: "".join(map(chr, D.normalise(t)[0])).strip()
    for d, t in enumerate(texts):
        for key, item in items:
            if not t or not item or not form(item):
                continue
            a, b = form(item), form(t)
            if len(a) < D.Q:
                hit = f" {a} " in f" {b} "
            else:
                hit = brute_distance(a, b) <= D.budget(len(a), 0.06)
            if hit:
                want.add((d, key))
    for blocks in (1 << 22, 200):
        got = D.find_leaks(docs, bench, block_chars=blocks).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    spans = {(r.doc_id, r.item_id): texts[r.doc_id][r.start : r.end] for r in got}
    assert all(form(s) == form(dict(items)[k]) for (d, k), s in spans.items() if texts[d] == dict(items)[k])


# --- packing ---------------------------------------------------------------------------------


def test_packing_is_whole_and_tight(spark, tricky):
    from lectern.llm import packing as P
    from lectern.llm.queries import word_vocabulary
    from tokenizers import Tokenizer

    texts = [*tricky, "It's <|endoftext|> DON'T l'été 3.14—x", "İstanbul ΣΑΣ ß́ é", "a\x1cb c d", "z" * 5000]
    got = P.pack(docs_of(spark, texts), word_vocabulary(), size=256).collect()
    tokenizer = Tokenizer.from_file(word_vocabulary())
    tokenizer.encode_special_tokens = True
    want = {}
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k in range(0, len(ids), 256):
            want[i, k // 256] = (k, len(ids[k : k + 256]), zlib.crc32(ids[k : k + 256].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    rows = {}
    for r in got:
        rows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in rows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(rows) <= -(-total // 256) + 2


def test_plan_uses_complements():
    from lectern.llm.packing import plan

    rng = random.Random(7)
    for size in (10, 64, 256):
        for _ in range(40):
            counts = Counter(rng.randrange(1, size + 1) for _ in range(rng.randrange(0, 300)))
            made = Counter()
            for times, lengths in plan(dict(counts), size):
                assert times > 0 and sum(lengths) <= size
                for x in lengths:
                    made[x] += times
            assert made == counts
    assert sorted(plan({6: 2, 4: 1, 3: 1, 1: 1}, 10)) == [(1, [6, 3, 1]), (1, [6, 4])]


# --- WARC ------------------------------------------------------------------------------------


def test_warc_round_trip_and_dedup(spark, tmp_path):
    from lectern.llm import warc as W

    pages = [(i, None if i == 3 else f"http://x/{i}", h) for i, h in enumerate(["a", "b", "a", None, "", "a" * 70000, "b", "é"])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for least, revisits in ((0, {2: 0, 4: 3, 6: 1}), (1, {2: 0, 6: 1}), (2, {})):
        folder = f"{tmp_path}/{least}"
        W.write_archives(df, folder, min_dedup_bytes=least)
        files = list((tmp_path / str(least)).glob("*.warc.gz"))
        assert files and sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") for f in files) == len(pages)
        got = W.resolve(W.read_archives(W.archive_files(spark, folder))).select(W.page_key("record_id").alias("id"), "uri", "payload_bytes", "payload_digest", "record_type", W.page_key("refers_to").alias("to"), "payload", "resolved").collect()
        assert len(got) == len(pages)
        for r in got:
            data = (pages[r.id][2] or "").encode()
            assert (r.payload_bytes, r.payload_digest, r.uri, r.resolved) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), pages[r.id][1], True)
            assert (r.record_type, r.to) == (("revisit", revisits[r.id]) if r.id in revisits else ("response", None))
            assert bytes(r.payload) == (b"" if r.id in revisits else data)


def test_payloads_are_dealt_once(spark):
    """The join with the roles takes the payloads as they are dealt to archives."""
    from lectern.llm import warc

    rows = [(k % 7, f"u{k}", "a" * (k % 5)) for k in range(20)] + [(None, None, "a")]
    plan = warc.records_of(spark.createDataFrame(rows, "page_id long, url string, html string"))._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("Exchange" in line for line in plan)
    assert not any("Exchange" in a and "Exchange" in b for a, b in zip(plan, plan[1:]))


def test_warc_rows_without_an_id_and_repeated_rows(spark, tmp_path):
    from lectern.llm import warc as W

    rows = [(None, "u", "same"), (1, "u", "same"), (1, "u", "same"), (2, None, "same"), (2, "u", "other"), (None, None, None)]
    W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w")
    got = W.resolve(W.read_archives(W.archive_files(spark, f"{tmp_path}/w"))).select(W.page_key("record_id").alias("id"), "record_type", "payload_bytes", W.page_key("refers_to").alias("to")).collect()
    assert Counter(map(tuple, got)) == Counter([(None, "revisit", 4, 1), (1, "response", 4, None), (1, "response", 4, None), (2, "revisit", 4, 1), (2, "response", 5, None), (None, "response", 0, None)])


def test_warc_headers_that_lie_are_not_believed(spark):
    from lectern.llm import warc as W

    sound = W.record("response", 1, "u", b"payload")
    lie = sound.replace(W.base32_sha1(b"payload").encode(), b"A" * 32, 1)
    assert lie != sound and W.salvage(W.member(lie)) == ([], [(0, len(W.member(lie)))])
    long = W.record("response", 1, "u", b"payload").replace(b"WARC-Type", b"X-Payload-Length: 999\r\nWARC-Type")
    orphan, wrong = W.record("revisit", 2, "u", b"payload", 9), W.record("revisit", 3, "u", b"else", 1)
    content = b"".join(W.member(x) for x in (long, orphan, wrong, W.record("revisit", 4, "u", b"payload", 1)))
    df = spark.createDataFrame([("a", bytearray(content))], "archive_id string, content binary")
    got = {W_id.record_id: (W_id.payload_bytes, W_id.resolved) for W_id in W.resolve(W.read_archives(df)).collect()}
    assert got == {"urn:page:1": (7, True), "urn:page:2": (None, False), "urn:page:3": (None, False), "urn:page:4": (7, True)}
    big = W.member(W.record("response", 1, None, b"z" * (17 << 20)))
    assert big.endswith(b"\0") and len(W.salvage(big)[0]) == 1 and W.salvage(big)[1] == []


def test_warc_salvage():
    from lectern.llm import warc as W

    plain = [W.record("response", i, "u", bytes([65 + i]) * 300) for i in range(4)]
    zipped = [W.member(x) for x in plain]
    for parts in (plain, zipped):
        whole = b"".join(parts)
        records, gaps = W.salvage(whole)
        assert len(records) == 4 and gaps == []
        hurt = bytearray(whole)
        at = len(parts[0]) + len(parts[1]) // 2
        hurt[at] ^= 0xFF
        records, gaps = W.salvage(bytes(hurt))
        assert [r[2]["warc-record-id"] for r in records] == [f"<urn:page:{i}>" for i in (0, 2, 3)]
        assert gaps == [(len(parts[0]), len(parts[0]) + len(parts[1]))]
        records, gaps = W.salvage(b"junk" + whole[:-5])
        assert len(records) == 3 and gaps == [(0, 4), (4 + sum(map(len, parts[:3])), len(whole) - 1)]
    assert W.salvage(b"") == ([], []) and W.salvage(b"\x1f\x8b\x08") == ([], [(0, 3)])
    assert len(W.salvage(plain[0] + zipped[1] + plain[2])[0]) == 3


# --- all together ----------------------------------------------------------------------------


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    from pyspark.sql import functions as F

    from lectern.llm import decontaminate, language_id, packing, pairwise_quality, secret_scan, suffix_dedup, toxicity, warc
    from lectern.llm.jaccard_join import jaccard_components
    from lectern.llm.quality_rules import quality_rules
    from lectern.llm.queries import TOXICITY, word_vocabulary

    clash = DOCS + ", id long, n int, start long, score double, component_id long, words string, _t string, length int, task int"
    full = spark.createDataFrame([(i, t, None, None, 1, 5, 5, 5, 0.5, 5, "w", "t", 1, 1) for i, t in enumerate(["some words here", None, "some words here"])], clash)
    bench = spark.createDataFrame([(1, "words")], "item_id long, text string")
    for df, n in ((full.filter("false"), 0), (full, 3)):
        model = language_id.train(df, "text", "lang", F.lit(True))
        assert language_id.identify(df, model).count() == n
        assert jaccard_components(df).count() == n
        assert secret_scan.scan(df).count() == n
        assert decontaminate.find_leaks(df, bench).count() == (2 if n else 0)
        assert decontaminate.find_leaks(df, bench.filter("false")).count() == 0
        assert suffix_dedup.dedup(df).count() == n
        assert quality_rules(df).count() == n
        assert packing.pack(df, word_vocabulary()).count() == n
        warc.write_archives(df, f"{tmp_path}/{n}", id_col="doc_id", uri_col="lang", payload_col="text")
        assert warc.resolve(warc.read_archives(warc.archive_files(spark, f"{tmp_path}/{n}"))).count() == n
        marks = spark.createDataFrame([(0, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
        for of in (marks, marks.filter("false")):
            assert toxicity.judge(df, toxicity.train(df, of, TOXICITY)).count() == n
        labels = spark.createDataFrame([], "doc_id long, quality int")
        assert pairwise_quality.rank(df, pairwise_quality.train(df, labels, "doc_id", "text", "quality")).count() == n


def test_queries_equal_their_sql(spark, sf_dir):
    import duckdb

    from lectern.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    for name, sql in ORACLES.items():
        want, got = con.execute(sql), QUERIES[name](spark, sf_dir)
        names = [c[0] for c in want.description]
        assert sorted(got.columns) == sorted(names), name
        assert Counter(map(tuple, got.select(*names).collect())) == Counter(want.fetchall()), name


def test_pipeline_of_empty_tables_nulls_and_further_columns(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(19)
    schema = DOCS + ", _row long, component_id long, distance double, kept boolean, piece int"
    text, other = prose(rng, 150), prose(rng, 150)
    rows = [(1, text, None, None, 3, 1, 1, 0.5, False, 1), (2, None, None, None, None, 1, 1, 0.5, False, 1), (3, other, "en", None, 3, None, 1, 0.5, False, 1), (3, other, "en", None, 3, None, 1, 0.5, False, 1), (4, "", "en", "s", 0, 1, 1, 0.5, True, 1)]
    bench = spark.createDataFrame([(0, prose(rng, 40)), (1, None)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    full = spark.createDataFrame(rows, schema)
    for frame, want in ((full, [1, 3]), (full.filter("false"), [])):
        for name, stage in C.STAGES:
            last, frame = frame, stage(spark, frame, str(tmp_path)).cache()
            assert name == "packing" or frame.columns == full.columns
        assert sorted(r.doc_id for r in last.select("doc_id").collect()) == want
        assert sorted({r.doc_id for r in frame.select("doc_id").collect()}) == want


def test_pipeline_stages_take_effect(spark, sf_dir):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = dict(texts)
    frame = docs
    for name, stage in C.STAGES[:4]:
        frame = stage(spark, frame, sf_dir).cache()
        assert frame.columns == docs.columns
        now = {r.doc_id: r.text for r in frame.collect()}
        if name == "quality_rules":
            assert all(not (brute_statistics(kept[d])[0] < 20) for d in now) and len(now) < len(kept)
        if name == "near_duplicates":
            order = sorted(kept)
            comp = brute_components([kept[d] for d in order], 5, 80)
            assert set(now) == {d for i, d in enumerate(order) if comp[i][1] == i}
        if name == "secret_scan":
            from lectern.llm.secret_scan import find

            assert set(now) == set(kept) and not any(find(t) for t in now.values())
        kept = now
    pieces = C.run(spark, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(kept)


def test_pipeline_judges_rows_without_an_id(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(14)
    clean, copy, twin, item = (prose(rng, 120) for _ in range(4))
    rows = [(None, clean), (None, "too short"), (None, copy), (2, copy), (1, "too short"), (None, twin), (None, twin), (None, prose(rng, 60) + " " + item + " " + prose(rng, 60)), (3, prose(rng, 90))]
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    for keep in ([0, 2, 3, 5, 6, 7, 8], [0, 3, 5, 7, 8], [0, 3, 5, 8]):
        frame = C.STAGES[[7, 5, 4].index(len(keep))][1](spark, frame, str(tmp_path)).cache()
        assert Counter((r.doc_id, r.text) for r in frame.collect()) == Counter(rows[k] for k in keep)
