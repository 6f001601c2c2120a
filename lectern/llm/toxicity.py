"""Toxicity categories by a classifier chain.

The categories have an order. Each has a logistic model over word presence and
a few text statistics, and every model after the first also sees the
probabilities of the categories before it. In training these come from
out-of-fold predictions: a row's probability is given by a model that was
fitted on the other folds, so later models learn from inputs of the quality
that they meet when a new text is judged. Copies of a text share its fold, which
comes from a hash of the text. The query decides by the last category, so every
model of the chain takes part.

Fitting uses a hash sample of about ``max_labels`` labelled rows at most and the
``vocabulary`` words that are most telling on it; judging covers whole texts.

Defined results: null text counts as empty; a category without labels of both
kinds gets its constant rate; labels without a document are not used; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import arrow_map, checkpoint, share, small_batches, texts_of, tidy
from lectern.llm.pairwise_quality import FEATURES, features, sampled_labels

TOKEN = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(TOKEN.findall(text.lower()))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 120) -> np.ndarray:
    """Weights and intercept (last) by accelerated gradient steps."""
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    w = np.zeros(x.shape[1] + 1, dtype=np.float32)
    w[-1] = np.log(rate / (1.0 - rate))
    if not len(y) or y.min() == y.max():
        return w
    v, length = w.copy(), 0.0
    probe = np.random.default_rng(3).standard_normal(x.shape[1] + 1).astype(np.float32)
    for _ in range(8):  # the largest curvature, by power steps
        probe /= np.linalg.norm(probe)
        s = x @ probe[:-1] + probe[-1]
        probe = np.append(x.T @ s, s.sum())
        length = float(np.linalg.norm(probe))
    rate = 1.0 / (0.25 * length * 1.05 + ridge)
    for k in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ v[:-1] + v[-1], -30, 30)))
        g = np.append(x.T @ (p - y) + ridge * v[:-1], (p - y).sum())
        new = (v - rate * g).astype(np.float32)
        v = new + np.float32(k / (k + 3.0)) * (new - w)
        w = new
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def fit_chain(x: np.ndarray, labels: np.ndarray, keys: np.ndarray, folds: int = 5) -> dict:
    """Models in order, and for each category the threshold with the best F1 out of fold; rows of one key share a fold."""
    fold = np.asarray(keys).astype(np.int64) % folds
    weights, cuts, before = [], [], np.zeros((len(x), 0), dtype=np.float32)
    for k in range(labels.shape[1]):
        y, own = labels[:, k].astype(np.float32), np.concatenate([x, before], axis=1)
        out = np.zeros(len(x), dtype=np.float32)
        for f in range(folds):
            if (fold == f).any() and (fold != f).any():
                out[fold == f] = predict(own[fold == f], fit_logistic(own[fold != f], y[fold != f]))
        weights.append(fit_logistic(own, y))
        order = np.argsort(-out, kind="stable")
        hit = np.cumsum(y[order])
        f1 = 2 * hit / (np.arange(1, len(y) + 1) + max(1.0, float(y.sum())))
        top = int(np.argmax(f1)) if len(y) and y.sum() else -1
        after = float(out[order[top + 1]]) if 0 <= top < len(y) - 1 else 0.0
        cuts.append((float(out[order[top]]) + after) / 2 if top >= 0 else 1.1)
        before = np.concatenate([before, out[:, None]], axis=1)
    return {"weights": weights, "cuts": cuts}


def run_chain(x: np.ndarray, model: dict) -> np.ndarray:
    before = np.zeros((len(x), 0), dtype=np.float32)
    for w in model["weights"]:
        before = np.concatenate([before, predict(np.concatenate([x, before], axis=1), w)[:, None]], axis=1)
    return before


def matrix(texts: list[str], model: dict) -> np.ndarray:
    """Standardised statistics, then a column for each word of the vocabulary."""
    known, out = model["vocabulary"], np.zeros((len(texts), FEATURES + len(model["vocabulary"])), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i, :FEATURES] = np.clip((np.array(features(text)) - model["mean"]) / model["std"], -5, 5)
        for word in known.keys() & words(text):
            out[i, FEATURES + known[word]] = 1.0
    return out


def train(documents: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", max_labels: int = 10_000, vocabulary: int = 512) -> dict:
    """``categories``: names in chain order, each with an SQL condition over the columns of ``labels``."""
    small_batches(documents)
    names = list(categories)
    marks = labels.select(F.col(id_col), *[F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"_y{k}") for k, c in enumerate(categories.values())])
    chosen = sampled_labels(marks, id_col, max_labels)
    ys = [f"_y{k}" for k in range(len(names))]
    text = F.coalesce(F.col(text_col), F.lit("")).alias("_t")
    rows = checkpoint(documents.select(F.col(id_col), text).join(F.broadcast(chosen), id_col).select("_t", *ys))  # max_labels rows of a few numbers

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, hits = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), zip(*[batch.column(1 + k).to_pylist() for k in range(len(names))])):
                own = words(text)
                n.update(own)
                if any(y):
                    hits.update(own)
        yield pa.RecordBatch.from_pydict({"w": list(n), "n": list(n.values()), "h": [hits[x] for x in n]}, schema=pa.schema([("w", pa.string()), ("n", pa.int64()), ("h", pa.int64())]))

    flags = " + ".join(ys)
    total, marked = rows.agg(F.count("*"), F.coalesce(F.sum(F.expr(f"int({flags} > 0)")), F.lit(0))).first()
    rate = marked / total if total else 0.0
    counts = rows.mapInArrow(tidy(tally), "w string, n long, h long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("h").alias("h")).filter("n >= 4")
    # How far the share of marked rows among those with the word is from the share among all, in standard errors.
    far = F.abs(F.col("h") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)) + 0.25)
    telling = counts.orderBy(far.desc(), "w").limit(vocabulary).select("w").collect()
    model = {"names": names, "vocabulary": {r["w"]: i for i, r in enumerate(telling)}}
    shared = share(documents, model["vocabulary"])

    def describe(batch: pa.RecordBatch) -> dict:
        known, n = shared.value, len(shared.value)
        out: dict = {"h": [], "x": [], "w": []}
        for t in texts_of(batch, "_t"):
            has = np.zeros(n, dtype=np.uint8)
            has[[known[w] for w in known.keys() & words(t)]] = 1
            out["h"].append(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1)
            out["x"].append(np.array(features(t)).tobytes())
            out["w"].append(np.packbits(has).tobytes())
        return out | {y: batch.column(y) for y in ys}

    got = arrow_map(rows, describe, "h long, x binary, w binary, " + ", ".join(f"{y} int" for y in ys)).collect()
    got.sort(key=lambda r: (r["h"], *[r[y] for y in ys]))
    shared.destroy()
    x = np.array([np.frombuffer(r["x"]) for r in got]).reshape(len(got), FEATURES)
    model |= {"mean": x.mean(axis=0) if len(x) else np.zeros(FEATURES), "std": (x.std(axis=0) if len(x) else np.zeros(FEATURES)) + 1e-6}
    full = np.zeros((len(got), FEATURES + len(model["vocabulary"])), dtype=np.float32)
    full[:, :FEATURES] = np.clip((x - model["mean"]) / model["std"], -5, 5)
    for i, r in enumerate(got):
        full[i, FEATURES:] = np.unpackbits(np.frombuffer(r["w"], dtype=np.uint8), count=len(model["vocabulary"]))
    labelled = np.array([[r[y] for y in ys] for r in got], dtype=np.float32).reshape(len(got), len(ys))
    return model | fit_chain(full, labelled, np.array([r["h"] for r in got], dtype=np.int64))


def judge(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and, for each category in chain order, ``p_<name>`` and ``is_<name>``."""
    small_batches(df)
    shared, names = share(df, model), model["names"]

    def run(batch: pa.RecordBatch) -> dict:
        m, texts, out = shared.value, texts_of(batch, "_t"), []
        for k in range(0, len(texts), 1000):
            out.append(run_chain(matrix(texts[k : k + 1000], m), m))
        p = np.concatenate(out)
        columns: dict = {"id": batch.column(0)}
        for k, name in enumerate(names):
            columns[f"p_{name}"] = p[:, k].astype(float)
            columns[f"is_{name}"] = p[:, k] >= m["cuts"][k]
        return columns

    kind = df.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}" + "".join(f", p_{n} double, is_{n} boolean" for n in names)
    return arrow_map(df.select(F.col(id_col), F.col(text_col).alias("_t")), run, schema).withColumnRenamed("id", id_col)
