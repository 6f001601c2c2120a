"""Functions that need Python: Arrow-batched, with models loaded once per worker.

Speech recognition, grapheme-to-phoneme and acoustic models are plugged in as a
factory of a plain function; the defaults here are deterministic stand-ins and
say nothing about what a model would give.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

SAMPLE_RATE = 22050
RAW_BLOCK = re.compile(r"(\[\[.*?\]\])")


@F.pandas_udf(T.DoubleType())
def similarity(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two normalised texts, in this order; 1 for two empty ones.

    The standard library's treatment of frequent characters in long strings is part of the measure.
    """
    return pd.Series([None if a is None or b is None else 1.0 if not a and not b else difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(reference, hypothesis)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.StringType()))
def nfd_symbols(text: pd.Series) -> pd.Series:
    """Code points of the canonical decomposition."""
    return text.map(lambda t: None if t is None else list(unicodedata.normalize("NFD", t)))


#: Marks at which a long sentence is cut, best first (fixed values).
CUT_MARKS = (";", ":", ",", "—")


def split_long(text: str, most: int = 230, least_share: float = 0.7) -> list[str]:
    """Parts of about ``most`` characters; a mark that follows a full part still joins it.

    Cut after the last mark of the best kind that stands at ``least_share`` of a
    part or later, else before the last space that does, else at ``most``.
    """
    at, end = len(text) - len(text.lstrip()), len(text.rstrip())
    places = {kind: [i for i, c in enumerate(text) if c == kind] for kind in (*CUT_MARKS, " ")}
    parts = []
    while at < end:
        cut = end if end - at <= most else at + most
        for kind, found in places.items() if cut < end else ():
            last = found[k - 1] if (k := bisect_right(found, at + most)) else -1
            if last >= at + int(most * least_share):
                cut = last + (kind != " ")
                break
        parts.append(text[at:cut].strip())
        at = end - len(text[cut:end].lstrip()) if cut < end else end
    return [p for p in parts if p]


def long_parts(most: int = 230) -> Callable[..., Column]:
    """``split_long`` as a column function."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else split_long(t, most))

    return run


def all_long_parts(most: int) -> Callable[..., Column]:
    """An array of sentences with the overlong ones cut."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(sentences: pd.Series) -> pd.Series:
        return sentences.map(lambda many: None if many is None else [p for s in many if s is not None for p in split_long(s, most)])

    return run


def text_symbols(text: str) -> list[list[str]]:
    """The default grapheme-to-phoneme function: one sentence of decomposed code points."""
    return [list(unicodedata.normalize("NFD", text))]


def phonemize(text: str, g2p: Callable[[str], list[list[str]]] = text_symbols) -> list[list[str]]:
    """Sentences of symbols; ``[[ ... ]]`` blocks are symbols already and join the current sentence.

    A block keeps one space to its neighbour where the text touches it with white space.
    """
    # Symbols in order, with None where the function ended a sentence; blocks bring no ends.
    stream: list[str | None] = []
    at = 0
    for block in [*RAW_BLOCK.finditer(text), None]:
        spoken = text[at : block.start()] if block else text[at:]
        if spoken.strip():
            for k, sentence in enumerate(g2p(spoken if spoken == text else spoken.strip())):
                stream += [None] * (k > 0) + list(sentence)
        if block:
            around = text[max(block.start() - 1, 0) : block.start()].isspace(), text[block.end() : block.end() + 1].isspace()
            stream += [" "] * around[0] + list(block[0][2:-2].strip()) + [" "] * around[1]
            at = block.end()
    ends = [i for i, s in enumerate(stream) if s is None]
    sentences = [_outer(stream[a:b]) for a, b in zip([0, *(i + 1 for i in ends)], [*ends, len(stream)])]
    while sentences and not "".join(sentences[-1]).strip():
        sentences.pop()
    return sentences


def _outer(symbols: list[str]) -> list[str]:
    low, high = 0, len(symbols)
    while low < high and symbols[low] == " ":
        low += 1
    while high > low and symbols[high - 1] == " ":
        high -= 1
    return symbols[low:high]


def phonemizer(factory: Callable[[], Callable[[str], list[list[str]]]] = lambda: text_symbols) -> Callable[..., Column]:
    """A column function; ``factory`` runs once per worker task, not per row."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        g2p = factory()
        for batch in batches:
            yield batch.map(lambda t: None if t is None else phonemize(t, g2p))

    return run


def silent_model() -> Callable[[list[int]], np.ndarray]:
    """A stand-in for an acoustic model: one second of silence."""
    return lambda ids: np.zeros(SAMPLE_RATE, dtype=np.float32)


def synthesizer(factory: Callable[[], Callable[[list[int]], np.ndarray]] = silent_model) -> Callable[..., Column]:
    """Symbol ids to audio by a model that is loaded once per task."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for batch in batches:
            yield batch.map(lambda ids: None if ids is None else model(list(ids)).astype(np.float32).tolist())

    return run


RECOGNISED = T.StructType([T.StructField("hyp", T.StringType()), T.StructField("error", T.StringType())])


def recogniser(factory: Callable[[], Callable[[bytes], str]]) -> Callable[..., Column]:
    """Audio bytes to (hyp, error); a failure is a row's error, not the job's."""

    @F.pandas_udf(RECOGNISED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = factory()
        for batch in batches:
            rows = []
            for data in batch:
                try:
                    rows.append((model(data), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((None, f"whisper_error:{e}"))
            yield pd.DataFrame(rows, columns=["hyp", "error"])

    return run


def speech_scorer(factory: Callable[[], Callable[[np.ndarray], float]]) -> Callable[..., Column]:
    """Probability of speech per chunk of an array of chunks."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for batch in batches:
            yield batch.map(lambda chunks: None if chunks is None else [float(model(np.asarray(c, dtype=np.float32))) for c in chunks])

    return run


def monotonic(scores: np.ndarray) -> np.ndarray:
    """The symbol of each frame on the path of the greatest sum.

    It starts at the first symbol, ends at the last one and never skips or goes
    back; of equal paths, that which stays longer at later symbols. Empty where
    there are fewer frames than symbols.
    """
    frames, symbols = scores.shape
    if frames < symbols or not symbols:
        return np.zeros(0, dtype=np.int32)
    best = np.full(symbols, -np.inf)
    best[0], moved = scores[0, 0], np.zeros((frames, symbols), dtype=bool)
    for t in range(1, frames):
        before = np.concatenate(([-np.inf], best[:-1]))
        moved[t] = before > best
        best = np.maximum(best, before) + scores[t]
    path = np.empty(frames, dtype=np.int32)
    at = symbols - 1
    for t in range(frames - 1, -1, -1):
        path[t] = at
        at -= int(moved[t, at])
    return path


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def best_monotonic(scores: pd.Series) -> pd.Series:
    return scores.map(lambda s: None if s is None else monotonic(np.array([list(row) for row in s], dtype=float).reshape(len(s), -1)).tolist())
