"""Sequence packing by exact-complement hashing and best fit.

Documents become token ids and an end id; only documents longer than a sequence
are cut. How many pieces there are of each length is all that the packing plan
needs, and there are at most ``size`` lengths, so the plan is made on counts.

The plan takes the longest remaining length and looks its gap up among single
lengths, then among sums of two, then of three, consuming a combination as often
as the counts allow; the sequences it makes are exactly full. What no
combination fills is packed by best fit decreasing, many equal pieces at a time.

Pieces get their place without gathering a length anywhere: each input task
numbers its own pieces of a length, running totals over the tasks' counts make
these numbers global, and a binary search in the plan gives sequence and offset.

Defined results: null text counts as empty and is one piece with the end id
alone; an empty table gives an empty result; repeated ids are packed apart.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window, functions as F

from lectern.llm.common import MANY, arrow_map, checkpoint, share, small_batches, task_id, tidy

SIZE = 2048
#: Texts that are encoded as a whole: white space for str.split() that is none for the tokenizer, and letters whose
#: lower case hangs on neighbours or on the version of Unicode.
ODD = re.compile("[\x1c-\x1f\u0130\u03a3\u1c80-\u1cff\ua640-\ua7ff\U00010000-\U0001efff]")
#: The parts that the tokenizer's own pattern makes of a word in lower case (fixed pattern), and the same for ASCII.
PART = regex.compile(r"'(?:[stmd]|re|ve|ll)|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
ASCII_PART = re.compile(r"'(?:[stmd]|re|ve|ll)|[a-z]+|[0-9]|[^\sa-z0-9]+")
MARKS = frozenset(".,;:!?")
#: What a tokenizer file says if words can be encoded one by one (fixed values).
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMAL = ["NFC", "Replace", "Lowercase"]
#: Parts that are encoded in one call, and characters whose words are told apart at a time.
CALL, CHUNK = 4000, 8 << 20
SPACE = re.compile(r"\s")
_CODERS: dict[str, Coder] = {}


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of all elements of the runs that begin at ``start``."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


class Coder:
    """Token ids of texts; a word's ids don't depend on its neighbours, so different words are encoded once a chunk.

    Holds for tokenizers that lower-case, split at white space first and mark the
    ends of words; with any other file each text is encoded as a whole. Words are
    cut into the tokenizer's own parts, and many parts are encoded as one text.
    Nothing is kept from chunk to chunk.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(self.tokenizer.to_str())
        steps = [spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}]
        kinds = [x.get("type") for x in steps[0].get("normalizers", [])]
        cuts = [x.get("pattern", {}).get("Regex") for x in steps[1].get("pretokenizers", [])]
        mark = spec["model"].get("end_of_word_suffix")
        self.by_word = kinds == NORMAL and cuts[:1] == [SPLIT] and bool(mark)
        if self.by_word:
            self.plain = Tokenizer.from_file(path)
            self.plain.encode_special_tokens = True
            self.plain.normalizer = normalizers.Sequence([])
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.last[[i for token, i in spec["model"]["vocab"].items() if token.endswith(mark)]] = True

    def many(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        chunk: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            if not self.by_word or ODD.search(text):
                out[i].append(np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes())
                continue
            low = 0
            while low < len(text):
                # A long text is cut at white space.
                found = SPACE.search(text, low + CHUNK) if len(text) > low + CHUNK else None
                high = found.start() if found else len(text)
                chunk.append((i, text[low:high]))
                size += high - low
                low = high
                if size >= CHUNK:
                    self._chunk(chunk, out)
                    chunk, size = [], 0
        self._chunk(chunk, out)
        return [b"".join(x) for x in out]

    def _chunk(self, chunk: list[tuple[int, str]], out: list[list[bytes]]) -> None:
        if not chunk:
            return
        words = pc.utf8_split_whitespace(pa.array([(t if t.isascii() else unicodedata.normalize("NFC", t)).lower() for _, t in chunk], pa.string()))
        coded = words.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        ids, start, length = self._words(coded.dictionary.to_pylist())
        sizes = length[at]
        data = memoryview(ids[_ragged(start[at], sizes)].tobytes())
        bounds = (np.append(0, np.cumsum(sizes))[words.offsets.to_numpy()] * 4).tolist()
        for (i, _), low, high in zip(chunk, bounds, bounds[1:]):
            out[i].append(bytes(data[low:high]))

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and each word's first place and number of ids in them."""
        # A word of letters alone is one part; most others are one with a mark behind it.
        plain = [w.isalpha() for w in words]
        number = {w: k for k, w in enumerate(compress(words, plain))}
        start, length = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        alone, others = np.flatnonzero(plain), np.flatnonzero(~np.array(plain, dtype=bool)).tolist()
        of, counts = [], []
        for j in others:
            w = words[j]
            own = (w[:-1], w[-1]) if w[-1:] in MARKS and w[:-1].isalpha() else (ASCII_PART if w.isascii() else PART).findall(w)
            counts.append(len(own))
            for p in own:
                of.append(number.setdefault(p, len(number)))
        parts, first, ids = list(number), [np.zeros(1, dtype=np.int64)], []
        base = 0
        for low in range(0, len(parts), CALL):
            some = parts[low : low + CALL]
            made = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.last[made]) + 1
            assert len(ends) == len(some)
            first.append(ends + base)
            ids.append(made)
            base += len(made)
        edges = np.concatenate(first)
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")
        start[alone], length[alone] = edges[: len(alone)], np.diff(edges)[: len(alone)]
        if others:
            pieces_of = np.array(of, dtype=np.int64)
            sizes = np.diff(edges)[pieces_of]
            total = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
            start[others], length[others] = total[:-1] + len(flat), np.diff(total)
            flat = np.concatenate([flat, flat[_ragged(edges[pieces_of], sizes)]])
        return flat, start, length


def coder(path: str) -> Coder:
    """One per worker process and file."""
    if path not in _CODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = 0) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and its task and number among that task's pieces of its length."""
    small_batches(df)
    kind = df.select(id_col).schema[0].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seen = coder(path), task_id(), np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            ids, out, owners = batch.column(0), [], []
            for i, data in enumerate(tokens.many(["" if t is None else t for t in batch.column(1).to_pylist()])):
                data += end
                for k in range(0, len(data), 4 * size):
                    part_of = data[k : k + 4 * size]
                    n = len(part_of) // 4
                    out.append((k // (4 * size), k // 4, n, zlib.crc32(part_of), int(seen[n])))
                    owners.append(i)
                    seen[n] += 1
            if out:
                a = np.array(out, dtype=np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"id": ids.take(pa.array(owners)), "piece": a[:, 0].astype(np.int32), "start": a[:, 1], "length": a[:, 2], "ids_crc32": a[:, 3], "task": np.full(len(a), part, dtype=np.int32), "number": a[:, 4]}
                )

    made = df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run, MANY), f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, number long")
    return made.withColumnRenamed("id", id_col)


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """Patterns (how often, lengths) that hold every piece once."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, list[int]]] = []

    def take(lengths: list[int]) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(left[x]) // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= times * k
        out.append((times, lengths))

    if left[size]:
        take([size])
    for top in range(size - 1, 0, -1):
        if not left[top]:
            continue
        gap = size - top
        # Single complements.
        if left[gap] and (gap != top or left[top] > 1):
            take([top, gap])
        # Sums of two, then of three.
        for complement in (_pair, _triple):
            while left[top]:
                spare = left.copy()
                spare[top] -= 1
                found = complement(spare, top, gap)
                if found is None:
                    break
                take([top, *found])
    return out + _best_fit(left, size)


def _pair(spare: np.ndarray, most: int, gap: int) -> tuple[int, int] | None:
    """Two available lengths with the sum ``gap``, the larger one as large as can be and at most ``most``."""
    a = np.arange(min(most, gap - 1), (gap + 1) // 2 - 1, -1)
    b = gap - a
    fits = np.flatnonzero((spare[a] > (a == b)) & (spare[b] > 0))
    return (int(a[fits[0]]), int(b[fits[0]])) if len(fits) else None


def _triple(spare: np.ndarray, top: int, gap: int) -> tuple[int, int, int] | None:
    """Three available lengths with the sum ``gap``; sums of two are indexed to skip hopeless first lengths."""
    have = (spare[: gap + 1] > 0).astype(np.float64)
    if gap < 3 or not have.any():
        return None
    width = 1 << (2 * gap + 1).bit_length()
    sums = np.fft.irfft(np.fft.rfft(have, width) ** 2, width)[: gap + 1] > 0.5
    a = np.arange(min(top, gap - 2), (gap + 2) // 3 - 1, -1)
    for x in a[(spare[a] > 0) & sums[gap - a]]:
        spare[x] -= 1
        found = _pair(spare, int(x), gap - int(x))
        spare[x] += 1
        if found is not None:
            return (int(x), *found)
    return None


def _best_fit(left: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Best fit decreasing on counts: open sequences of one pattern are kept together."""
    rooms: dict[int, list[tuple[int, list[int]]]] = {}  # remaining room -> patterns
    free = np.zeros(size + 1, dtype=np.int64)
    for length in range(size, 0, -1):
        while left[length]:
            fitting = np.flatnonzero(free[length:])
            if not len(fitting):
                fill = size // length
                n = int(left[length])
                whole, rest = divmod(n, fill)
                for times, k in ((whole, fill), (1, rest)):
                    if times and k:
                        room = size - k * length
                        rooms.setdefault(room, []).append((times, [length] * k))
                        free[room] += times
                left[length] = 0
                break
            room = length + int(fitting[0])
            times, pattern = rooms[room].pop()
            used = min(times, int(left[length]))
            if used < times:
                rooms[room].append((times - used, pattern))
            free[room] -= used
            rooms.setdefault(room - length, []).append((used, [*pattern, length]))
            free[room - length] += used
            left[length] -= used
    return [x for patterns in rooms.values() for x in patterns]


def places(patterns: list[tuple[int, list[int]]], size: int = SIZE) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first numbers of its slots in order, and each slot's first sequence and offset."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    upto: dict[int, int] = {}
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for x in lengths:
            slots.setdefault(x, []).append((upto.get(x, 0), sequence, offset))
            upto[x] = upto.get(x, 0) + times
            offset += x
        sequence += times
    return {x: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for x, rows in slots.items()}  # type: ignore[misc]


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = 0) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``."""
    # The numbers of a task's pieces must not change between the two uses, so they are written once.
    cut = checkpoint(pieces(df, path, id_col, text_col, size, end_id))
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = counts.select("length", "task", before.alias("first"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    shared = share(df, places(plan(total, size), size))
    kind = df.select(id_col).schema[0].dataType.simpleString()

    def place(batch: pa.RecordBatch) -> dict:
        length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
        number = number + batch.column("first").to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for x in np.unique(length):
            starts, sequences, offsets = shared.value[int(x)]
            mine = np.flatnonzero(length == x)
            at = np.searchsorted(starts, number[mine], side="right") - 1
            sequence[mine] = sequences[at] + number[mine] - starts[at]
            offset[mine] = offsets[at]
        return {c: batch.column(c) for c in (id_col, "piece", "start", "length", "ids_crc32")} | {"sequence_id": sequence, "offset": offset}

    return arrow_map(cut.join(first, ["length", "task"]), place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
