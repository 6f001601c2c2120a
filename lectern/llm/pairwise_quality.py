"""Document quality by Bradley-Terry pairwise ranking.

A document's score is ``w . x`` over text statistics ``x``. Of a pair of a
preferred and a rejected document, the preferred one wins with probability
``sigmoid(w . (x_i - x_j))``; Newton steps minimise the logistic loss over the
feature differences. The threshold is a quantile of the scores of the training
rows, the one that separates the preference labels best, and the reported score
is a sigmoid that takes the value ``cut`` there.

Fitting uses a hash sample of at most about ``max_labels`` labelled rows and
``pairs`` preference pairs; scoring covers every whole text.

Defined results: null text counts as empty and is scored like any other; without
labels of both kinds all scores are ``cut``; labels whose document is missing
are not used; several labels of one document all count.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import arrow_map, share, texts_of

_CLASSES = np.full(256, 7, dtype=np.uint8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b"#*$%&|<>", b".,;:?")):
    _CLASSES[list(_chars)] = _k
_CLASSES[128:] = 8
_CLASSES[ord("!")] = 9
FEATURES = 16


def distinct_triples(words: list[str]) -> int:
    """How many different runs of three words there are, counted by the words' numbers."""
    number: dict[str, int] = {}
    at = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n, pairs = len(number) + 1, np.unique(at[:-1] * (len(number) + 1) + at[1:], return_inverse=True)[1] if len(at) > 2 else at[:0]
    return len(np.unique(pairs[:-1] * n + at[2:])) if len(at) > 2 else 0


def features(text: str) -> list[float]:
    """Statistics of one whole text; shares lie in 0 to 1."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = text.split(), text.split("\n")
    n, size = max(1, len(words)), max(1, len(raw))
    counts = np.bincount(_CLASSES[np.frombuffer(raw, dtype=np.uint8)], minlength=10) if raw else np.zeros(10)
    upper, lower, digit, space, newline, symbol, point, other, wide, shout = (float(x) for x in counts)
    letters = max(1.0, upper + lower)
    triples = distinct_triples(words)
    return [
        np.log1p(len(words)),
        np.log1p((size - space - newline) / n),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        triples / max(1, len(words) - 2),
        1.0 - len(set(lines)) / len(lines),
        np.log1p(size / len(lines)),
        upper / letters,
        digit / size,
        symbol / n if symbol < n else 1.0 + np.log(symbol / n),
        point / n,
        shout / n if shout < n else 1.0 + np.log(shout / n),
        other / size,
        wide / size,
        space / size,
        1.0 if text else 0.0,
    ]


def _expand(x: np.ndarray, model: dict) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["std"], -8, 8)
    return np.concatenate([z, z * z], axis=1)


def fit_bradley_terry(x: np.ndarray, y: np.ndarray, pairs: int = 100_000, ridge: float = 1.0, cut: float = 0.7, seed: int = 7) -> dict:
    """Weights from pairs of a row with y = 1 and one with y = 0, and the score threshold."""
    width = x.shape[1]
    model = {"mean": x.mean(axis=0) if len(x) else np.zeros(width), "std": (x.std(axis=0) if len(x) else np.zeros(width)) + 1e-6, "cut": cut}
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(2 * width)
    if not len(good) or not len(bad):
        return model | {"w": w, "threshold": 0.0, "quantile": 0.0}
    z, draw = _expand(x, model), np.random.default_rng(seed)
    d = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    for _ in range(12):
        p = 1.0 / (1.0 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - 1.0) + ridge * w
        curve = (d * (p * (1.0 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = z @ w
    grid = np.linspace(0.0, 1.0, 401)
    edges = np.quantile(scores, grid)
    right = [float(((scores >= e) == (y == 1)).mean()) for e in edges]
    top = int(np.argmax(right))
    return model | {"w": w, "threshold": float(edges[top]), "quantile": float(grid[top])}


def score_matrix(x: np.ndarray, model: dict) -> np.ndarray:
    margin = _expand(x, model) @ model["w"] - model["threshold"]
    return 1.0 / (1.0 + np.exp(-(np.clip(margin, -30, 30) + np.log(model["cut"] / (1.0 - model["cut"])))))


def sampled_labels(labels: DataFrame, id_col: str, max_labels: int) -> DataFrame:
    """A hash sample of about ``max_labels`` rows at most."""
    total = labels.count()
    if total <= max_labels:
        return labels
    return labels.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int((1 << 20) * max_labels / total))


def with_features(df: DataFrame, id_col: str, text_col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column(0), "x": [features(t) for t in texts_of(batch, "_t")]} | {c: batch.column(c) for c in extra}

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = f"id {kinds[id_col]}, x array<double>" + "".join(f", {c} {kinds[c]}" for c in extra)
    return arrow_map(df.select(F.col(id_col), F.col(text_col).alias("_t"), *extra), run, schema)


def train(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labels: int = 20_000) -> dict:
    """Fit on documents with a label; ``labels`` has ``id_col`` and ``label_col`` of the rows that may be used."""
    chosen = sampled_labels(labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1)), id_col, max_labels)
    rows = documents.select(id_col, text_col).join(F.broadcast(chosen), id_col)  # max_labels rows of two numbers
    found = with_features(rows, id_col, text_col, ("_y",)).select("id", "x", "_y").orderBy("id").collect()
    x = np.array([r["x"] for r in found], dtype=float).reshape(len(found), FEATURES)
    return fit_bradley_terry(x, np.array([r["_y"] for r in found]))


def rank(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` of every row."""
    shared = share(df, model)

    def run(batch: pa.RecordBatch) -> dict:
        x = np.array([features(t) for t in texts_of(batch, "_t")], dtype=float)
        score = score_matrix(x, shared.value)
        return {"id": batch.column(0), "score": score, "predicted": (score >= shared.value["cut"]).astype(np.int32)}

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return arrow_map(df.select(F.col(id_col), F.col(text_col).alias("_t")), run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
