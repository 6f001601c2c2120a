"""Language identification by multilingual mixture inference.

A language is a distribution over hashed character trigrams, learned from
labelled texts. A document is a mixture of languages: its trigrams are drawn
from ``sum_l p_l P_l``. Expectation-maximisation estimates the proportions
``p`` for a set of languages; the set grows one language at a time, as long as
the penalised log-likelihood improves. The next candidate is the language with
the steepest likelihood gradient; where no gradient is positive, none can help,
as the log-likelihood is concave in ``p``.

Training counts a hash sample of about ``per_language`` different labelled texts
for each language (a bound on work, not on what is judged). What leaves the
executors is a few fixed-size tables per language. A text enters inference as
counts of its different trigrams, of which there are at most 32,768, so memory
does not grow with its length.

Defined results: null text and texts without a letter get ``und`` with score 0;
with no labelled text at all every document is ``und``; a text of one or two
letters is judged on the padded trigram; repeated rows are judged alike and learnt
from once; of languages that are equally likely the first by name is predicted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import arrow_map, share, small_batches, texts_of, tidy

N = 3
BITS = 15
#: Characters of a text that are read at a time.
WINDOW = 1 << 20
#: Tasks that count the texts of one language.
TASKS = 4
LETTER = re.compile(r"[^\W\d_]")
#: ASCII characters that are no letters count as a space.
_ASCII = np.array([c if chr(c).isalpha() else 32 for c in range(128)], dtype=np.uint32)


def gram_codes(text: str, first: bool = True, last: bool = True) -> np.ndarray:
    """Hashed trigrams of the lower-cased text, without those that hold no letter; ``first`` and ``last`` pad an end."""
    c = np.frombuffer(f"{' ' if first else ''}{text.lower()}{' ' if last else ''}".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_ = c < 128
    c = np.where(ascii_, _ASCII[np.where(ascii_, c, 0)], c)
    a, b, d = c[:-2], c[1:-1], c[2:]
    with np.errstate(over="ignore"):
        h = (a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + d * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    return (h >> np.uint32(32 - BITS))[(a != 32) | (b != 32) | (d != 32)]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The different hashed trigrams of a text and how often each occurs; long texts are read in windows."""
    if len(text) <= WINDOW:
        return np.unique(gram_codes(text), return_counts=True)
    total = np.zeros(1 << BITS, dtype=np.int64)
    for low in range(0, len(text), WINDOW):
        # Windows overlap by two characters; the space that pads each stands for the ends of the text alone.
        codes = gram_codes(text[low : low + WINDOW + 2], low == 0, low + WINDOW + 2 >= len(text))
        total += np.bincount(codes, minlength=1 << BITS)
        if low + WINDOW + 2 >= len(text):
            break
    codes = np.flatnonzero(total)
    return codes, total[codes]


def infer(codes: np.ndarray, times: np.ndarray, dense: np.ndarray, logs: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Proportions of all languages and the posterior of the best single one, for trigrams that occur ``times``.

    ``dense`` holds trigram probabilities divided by the largest of a row, ``logs`` their logarithms.
    """
    n, k = int(times.sum()), dense.shape[1]
    weight = times.astype(np.float64)
    single = weight @ logs[codes]
    best = int(single.argmax())
    posterior = 1.0 / float(np.exp(np.clip((single - single[best]) / N, -50, 0)).sum())
    p = np.zeros(k)
    p[best] = 1.0
    if k == 1:
        return p, posterior
    rows = dense[codes]
    chosen, weights, likelihood = [best], np.ones(1), single[best]
    while len(chosen) < k:
        density = rows[:, chosen] @ weights
        gain = (weight / density) @ rows / n - 1.0
        gain[chosen] = -1.0
        new = int(gain.argmax())
        if gain[new] <= 0:
            break
        trial = np.append(weights * 0.9, 0.1)
        part = np.ascontiguousarray(rows[:, [*chosen, new]])
        for _ in range(rounds):
            step = trial * ((weight / (part @ trial)) @ part) / n
            done = np.abs(step - trial).max() < 1e-3
            trial = step / step.sum()
            if done:
                break
        after = float(weight @ np.log(part @ trial))
        # Each character is in N trigrams, so the sample counts 1/N.
        if 2.0 * (after - likelihood) / N <= np.log(n + 1.0):
            break
        chosen, weights, likelihood = [*chosen, new], trial, after
    p[:] = 0.0
    p[chosen] = weights
    return p, posterior


def train(df: DataFrame, text_col: str, lang_col: str, rows: Column, per_language: int = 2000) -> dict:
    """Trigram tables of the languages that the labelled ``rows`` name."""
    small_batches(df)
    labelled = df.filter(rows & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("_t"), F.col(lang_col).alias("_l"))
    sizes = {r["_l"]: r["n"] for r in labelled.groupBy("_l").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {"languages": []}
    rate = F.create_map(*[x for name, n in sorted(sizes.items()) for x in (F.lit(name), F.lit(min(1.0, per_language / n)))])
    drawn = labelled.withColumn("_h", F.xxhash64("_t")).filter(F.pmod("_h", F.lit(1 << 20)) < F.element_at(rate, F.col("_l")) * (1 << 20))
    drawn = drawn.dropDuplicates(["_l", "_h"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = found.setdefault(name, np.zeros(1 << BITS, dtype=np.int64))
                codes, times = gram_counts(text)
                table[codes] += times
        yield pa.RecordBatch.from_pydict({"l": list(found), "c": [x.tobytes() for x in found.values()]}, schema=pa.schema([("l", pa.string()), ("c", pa.binary())]))

    counts = {name: np.zeros(1 << BITS) for name in sizes}
    for row in drawn.repartition("_l", F.pmod(F.col("_h") / (1 << 20), F.lit(TASKS)).cast("int")).select("_t", "_l").mapInArrow(tidy(count), "l string, c binary").toLocalIterator():
        counts[row["l"]] += np.frombuffer(row["c"], dtype=np.int64)
    names = sorted(x for x in counts if counts[x].sum())
    if not names:
        return {"languages": []}
    table = np.stack([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * (1 << BITS)) for x in names], axis=1)
    dense = (table / table.max(axis=1, keepdims=True)).astype(np.float32)
    return {"languages": names, "dense": dense.astype(np.float64), "logs": np.log(dense.astype(np.float64))}


def identify(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score``, ``languages`` and ``proportions`` of each row."""
    small_batches(df)
    shared = share(df, model)

    def run(batch: pa.RecordBatch) -> dict:
        m = shared.value
        names, out = m["languages"], {"id": batch.column(0), "lang_pred": [], "score": [], "languages": [], "proportions": []}
        for text in texts_of(batch, "_t"):
            codes, times = gram_counts(text) if names and LETTER.search(text) else ((), ())
            if not len(codes):
                p, top, score = None, "und", 0.0
            else:
                p, posterior = infer(codes, times, m["dense"], m["logs"])
                top = names[int(p.argmax())]
                score = min(1.0, max(0.0, float(p.max()) * posterior))
            out["lang_pred"].append(top)
            out["score"].append(score)
            out["languages"].append([] if p is None else [names[i] for i in np.flatnonzero(p)])
            out["proportions"].append([] if p is None else [float(x) for x in p[p > 0]])
        return out

    kind = df.select(id_col).schema[0].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double, languages array<string>, proportions array<double>"
    return arrow_map(df.select(F.col(id_col), F.col(text_col).alias("_t")), run, schema).withColumnRenamed("id", id_col)
