"""Benchmark decontamination by q-gram filtering and banded alignment.

Texts are compared by their letters and digits in lower case, with one space for
whatever stands between. An item of ``m`` characters that occurs in a document
with at most ``k`` edits shares at least ``m - q + 1 - k q`` q-grams with it, all
on diagonals (document position minus item position) that lie within ``k`` of
each other. So shared q-grams are counted in bands of ``2 k + 1`` diagonals, two
neighbouring bands together, and only bands that reach the bound are aligned, by
a dynamic program that fills the band alone.

``k`` is the share ``rate`` of the item's length, at most what keeps the bound at
one or more. Items shorter than ``q`` must occur exactly, as whole words.

The items are broadcast in blocks of at most ``block_chars`` characters; each
block is one pass over the documents.

Defined results: null and empty documents match nothing, null and empty items
are left out, equal items are each reported, and so is each copy of a document;
of several occurrences of an item in a document the one with the fewest edits,
then the first, is given.
"""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import arrow_map, mix, share, texts_of

Q = 12
_R = np.uint64(0x9E3779B97F4A7C15)


@cache
def _lower_table() -> np.ndarray:
    """Lower case of each letter or digit of the basic plane, 0 for all else."""
    out = np.zeros(1 << 16, dtype=np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the compared form (32 between words) and where each stands in the text."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    v = _lower_table()[np.minimum(c, 0xFFFF)]
    if len(c) and c.max() > 0xFFFF:
        v = np.where(c > 0xFFFF, c, v)
    keep = v > 0
    keep[1:] |= v[:-1] > 0
    at = np.flatnonzero(keep)
    v = v[at]
    v[v == 0] = 32
    return v, at


def slots(v: np.ndarray, bits: int) -> np.ndarray:
    """A short hash of each window of 12 code points, by doubling; it only preselects."""
    if len(v) < Q:
        return np.zeros(0, dtype=np.uint32)
    r = np.uint32(0x9E3779B1)
    with np.errstate(over="ignore"):
        r2 = r * r
        r4 = r2 * r2
        two = v[:-1] * r + v[1:]
        four = two[:-2] * r2 + two[2:]
        return (((four[:-8] * r4 + four[4:-4]) * r4 + four[8:]) * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)


def q_grams(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows of 12 code points that start at ``at``."""
    h = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(Q):
            h = h * _R + v[at + j]
    return mix(h)


def budget(m: int, rate: float) -> int:
    return max(0, min(int(rate * m), (m - Q) // Q))


def index(items: list[tuple[int, str]], rate: float, bits: int = 21) -> dict:
    """The q-grams of a block of items, sorted, with a bit filter before them."""
    kept, grams, owner, place, short = [], [], [], [], []
    flags = np.zeros(1 << bits, dtype=bool)
    for key, text in items:
        v, _ = normalise(text)
        v = v[:-1] if len(v) and v[-1] == 32 else v
        if not len(v):
            continue
        if len(v) < Q:
            short.append((key, " " + "".join(map(chr, v)) + " "))
            continue
        g = q_grams(v, np.arange(len(v) - Q + 1))
        flags[slots(v, bits)] = True
        grams.append(g)
        owner.append(np.full(len(g), len(kept)))
        place.append(np.arange(len(g)))
        kept.append((key, v))
    g = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
    order = np.argsort(g, kind="stable")
    k = np.array([budget(len(v), rate) for _, v in kept], dtype=np.int64)
    m = np.array([len(v) for _, v in kept], dtype=np.int64)
    return {
        "bits": bits,
        "flags": flags,
        "grams": g[order],
        "owner": np.concatenate(owner)[order] if owner else np.zeros(0, dtype=np.int64),
        "place": np.concatenate(place)[order] if place else np.zeros(0, dtype=np.int64),
        "items": kept,
        "short": short,
        "k": k,
        "need": m - Q + 1 - k * Q,
    }


def candidates(v: np.ndarray, ix: dict) -> list[tuple[int, int]]:
    """(item, first diagonal of a double band) where shared q-grams reach the bound."""
    if len(v) < Q or not len(ix["grams"]):
        return []
    at = np.flatnonzero(ix["flags"][slots(v, ix["bits"])])
    if len(at) < ix["need"].min():
        return []
    g = q_grams(v, at)
    low = np.searchsorted(ix["grams"], g, side="left")
    n = np.searchsorted(ix["grams"], g, side="right") - low
    at, low, n = at[n > 0], low[n > 0], n[n > 0]
    if len(at) < ix["need"].min():
        return []
    entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    owner = ix["owner"][entry]
    diagonal = np.repeat(at, n) - ix["place"][entry]
    # An item with too few shared q-grams on all diagonals has too few in any band.
    enough = np.bincount(owner, minlength=len(ix["need"])) >= ix["need"]
    owner, diagonal = owner[enough[owner]], diagonal[enough[owner]]
    if not len(owner):
        return []
    band = diagonal // (2 * ix["k"][owner] + 1)
    base = int(band.min())
    pairs, counts = np.unique((owner << 32) | (band - base), return_counts=True)
    found: dict[tuple[int, int], int] = {}
    for key, c in zip(pairs.tolist(), counts.tolist()):
        i, b = key >> 32, (key & 0xFFFFFFFF) + base
        for start in (b - 1, b):
            found[i, start] = found.get((i, start), 0) + c
    return [(i, b * int(2 * ix["k"][i] + 1)) for (i, b), c in found.items() if c >= ix["need"][i]]


def banded_distance(item: np.ndarray, text: np.ndarray, first: int, width: int) -> tuple[int, int, int]:
    """Least edits of ``item`` against a part of ``text``, over diagonals ``first`` to ``first + width - 1``.

    Returns the edits and the part's start and end. Row i of the program holds text position i + diagonal.
    """
    far = 1 << 20
    offsets = np.arange(width)
    position = first + offsets  # text positions before row 0
    cost = np.where((position >= 0) & (position <= len(text)), 0, far)
    origin = position.copy()
    for i, c in enumerate(item):
        position = first + offsets + i  # the text character that the diagonal step reads
        inside = (position >= 0) & (position < len(text))
        differs = np.ones(width, dtype=np.int64)
        differs[inside] = text[position[inside]] != c
        step = np.where(inside, cost + differs, far)
        start = origin.copy()
        # Leaving the item's character out moves one diagonal down.
        skip = np.append(cost[1:] + 1, far)
        better = skip < step
        step[better], start[better] = skip[better], np.append(origin[1:], 0)[better]
        step[(position + 1 < 0) | (position + 1 > len(text))] = far
        # Extra text characters move along the row.
        slope = step - offsets
        least = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == least, offsets, 0))
        cost, origin = least + offsets, start[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), first + end + len(item)


def _exact(item: np.ndarray, text: np.ndarray) -> int:
    """Where the item stands in the text without an edit, -1 for nowhere; spares the alignment of plain copies."""
    raw, wanted, at = text.tobytes(), item.tobytes(), -1
    while True:
        at = raw.find(wanted, at + 1)
        if at < 0 or at % 4 == 0:
            return at // 4 if at >= 0 else -1


def matches(text: str, ix: dict) -> list[tuple[int, int, int, int]]:
    """Item id, start and end in the text, and edits of each item that occurs."""
    v, at = normalise(text)
    best: dict[int, tuple[int, int, int]] = {}
    for i, diagonal in candidates(v, ix):
        item, k = ix["items"][i][1], int(ix["k"][i])
        first, width = diagonal - k, 2 * (2 * k + 1) + 2 * k
        low = max(0, first)
        found = _exact(item, v[low : max(0, first + width + len(item))])
        if found >= 0:
            edits, start, end = 0, low + found, low + found + len(item)
        elif i in best and best[i][0] == 0:
            continue
        else:
            edits, start, end = banded_distance(item, v, first, width)
        if edits <= k and end > start and (i not in best or (edits, start, end) < best[i]):
            best[i] = (edits, start, end)
    out = [(ix["items"][i][0], int(at[s]), int(at[e - 1]) + 1, d) for i, (d, s, e) in best.items()]
    if ix["short"] and len(v):
        plain = " " + "".join(map(chr, v.tolist())) + " "
        for key, word in ix["short"]:
            if (s := plain.find(word)) >= 0:
                out.append((key, int(at[s]), int(at[s + len(word) - 3]) + 1, 0))
    return sorted(out)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_chars`` characters at most."""
    rows = benchmark.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).filter(F.length("_t") > 0)
    total = rows.agg(F.coalesce(F.sum(F.length("_t")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_chars))
    return [rows.filter(F.pmod(F.xxhash64("_id", "_t"), F.lit(n)) == b) for b in range(n)] if n > 1 else [rows]


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", rate: float = 0.06, block_chars: int = 1 << 22) -> DataFrame:
    """A row (id, item, start, end, edits) for each benchmark item that a document holds."""
    kind = df.select(id_col).schema[0].dataType.simpleString()
    other = benchmark.select(item_col).schema[0].dataType.simpleString()
    rows, out = df.select(F.col(id_col), F.col(text_col).alias("_t")), []
    for block in item_blocks(benchmark, item_col, item_text, block_chars):
        shared = share(df, index([(r["_id"], r["_t"]) for r in block.collect()], rate))

        def run(batch: pa.RecordBatch, shared=shared) -> dict:
            ids, found = batch.column(0).to_pylist(), []
            for key, text in zip(ids, texts_of(batch, "_t")):
                found += [(key, *m) for m in matches(text, shared.value)] if text else []
            return dict(zip(("id", "item", "start", "end", "edits"), map(list, zip(*found)))) if found else {"id": [], "item": [], "start": [], "end": [], "edits": []}

        out.append(arrow_map(rows, run, f"id {kind}, item {other}, start long, end long, edits int"))
    return reduce(DataFrame.unionByName, out).withColumnsRenamed({"id": id_col, "item": item_col})
