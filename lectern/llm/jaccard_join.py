"""Size-aware heavy-light similarity join of documents on word shingles.

Two documents link when the Jaccard similarity of their shingle sets reaches
``percent`` / 100. The join is exact up to 64-bit hashes of shingles, of which the last
comparison reads 48 bits.

1. Documents with equal sets form a class, and one member stands for it.
2. A fixed-size count sketch over all shingles gives a global order, rare ones
   first. Two linked sets of sizes ``n`` share ``c`` shingles or more among the
   first ``n - ceil(t n) + c`` of each.
3. Small sets enumerate all ``c``-subsets (c = 2) of this prefix as signatures.
   Large sets, and small ones that can link with a large one, enter the inverted
   lists of their prefix with c = 1. The boundary between small and large is the
   size at which the summed cost, subsets below and estimated list lengths
   above, is least.
4. Lists give candidate pairs, filtered by size and by what the positions in the
   order still allow. Short lists give all pairs. In a long list each member is
   paired with the one closest to the list's core and with its neighbour in
   size; a list that the sketch knows to be very long is dealt in parts, whose
   first rows also meet. Where the links found so far leave a long list in
   several components, the pairs across components follow in a second round,
   a pair of blocks of the list at a time.
5. A bit for each set and hash cell, odd or even, rules out most candidates that
   differ in too much. The others are verified on whole sets, and components of
   the links reported.

No list is expanded into all pairs once its members are connected, sets of hot
documents are dealt to many tasks, and nothing but the sketch and bit filters of
fixed size is gathered. The sketch decides cost alone, never the result.

Defined results: null text, or one without words, has an empty set, links with
nothing and is its own component; a text with fewer words than a shingle is one
shingle; ids must be integers, and repeated ids count as one document whose rows
are all returned; a row without an id takes the component of an equal set, and
null where there is none; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lectern.llm.common import MANY, arrow_map, bitmap, bits_for, checkpoint, in_bitmap, mix, runs, share, small_batches, tidy
from lectern.llm.components import connected_components

#: Bits of the sketch's cells: eight cells a document, within these bounds.
SKETCH_BITS = (16, 22)
#: Pieces in which sketches are merged.
PIECES = 64
#: Pairs up to which their documents are known by a bit filter.
FILTERED = 1 << 21
#: Bytes kept of a shingle's hash when sets are compared.
WIDTH = 6
_K = np.uint64(0x9FB21C651E98DF25)


class Limits(NamedTuple):
    """Where lists and documents are dealt to several tasks; they decide cost alone."""

    #: Lists up to this length give all their pairs at once.
    short: int = 64
    #: Logarithm of the rows of a list above which it is dealt in parts.
    list_bits: int = 16
    #: Rows of each part that meet those of the other parts first.
    cores: int = 8
    #: Partners of one document that go to one task.
    block: int = 2048
    #: Rows of a long list on either side of a block of pairs.
    side: int = 4096


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of all k-word shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(k, len(w))
    with np.errstate(over="ignore"):
        s = w[: len(w) - n + 1] + np.uint64(n)
        for j in range(1, n):
            s = mix(s) * _K + w[j : len(w) - n + 1 + j]
    return np.unique(mix(s))


def _sums(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and fingerprint; at the end this task's part of the sketch, in pieces."""
    counts, waiting, pending = np.zeros(1 << bits, dtype=np.uint32), [], 0
    schema = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("fp", pa.binary()), ("piece", pa.int32())])

    def add() -> None:
        nonlocal waiting, pending, counts
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=1 << bits).astype(np.uint32)
        waiting, pending = [], 0

    for batch in batches:
        n, fp = [], []
        for text in batch.column(1).to_pylist():
            s = shingles(text, k)
            n.append(len(s))
            fp.append(xxhash.xxh3_128_digest(s))
            waiting.append((s >> np.uint64(64 - bits)).astype(np.int64))
            pending += len(s)
            if pending > 1 << 20:
                add()
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int32()), pa.array(fp, pa.binary()), pa.nulls(len(n), pa.int32())], schema=schema)
    add()
    for piece, cells in enumerate(counts.reshape(PIECES, -1)):
        if cells.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([_pack(cells)], pa.binary()), pa.array([piece], pa.int32())], schema=schema)


def _pack(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return zlib.compress(np.concatenate([np.diff(at, prepend=0).astype(np.uint64), counts[at].astype(np.uint64)]).tobytes(), 1)


def _unpack(data: bytes, cells: int) -> np.ndarray:
    both = np.frombuffer(zlib.decompress(data), dtype=np.uint64).astype(np.int64)
    out = np.zeros(cells, dtype=np.int64)
    out[np.cumsum(both[: len(both) // 2])] = both[len(both) // 2 :]
    return out


def _levels(rows: DataFrame, bits: int) -> np.ndarray:
    """Logarithmic excess of each sketch cell over the mean, 0 for what may be chance."""
    cells = (1 << bits) // PIECES

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[piece] = total.get(piece, 0) + _unpack(data, cells)
        if total:
            yield pa.RecordBatch.from_pydict({"piece": pa.array(list(total), pa.int32()), "fp": [_pack(x) for x in total.values()]})

    total = np.zeros((PIECES, cells), dtype=np.int64)
    for row in rows.filter("piece is not null").select("piece", "fp").repartition(PIECES, "piece").mapInArrow(tidy(merge), "piece int, fp binary").toLocalIterator():
        total[row.piece] = _unpack(row.fp, cells)
    total = total.ravel()
    mean = total.mean()
    excess = total - mean
    return np.where(excess > max(4.0, 3.0 * np.sqrt(mean)), 1 + np.log2(np.maximum(excess, 1.0)), 0).astype(np.uint8)


def _level_of(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return levels[(s >> np.uint64(65 - len(levels).bit_length())).astype(np.int64)]


def _prefix(s: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The first ``n - ceil(t n) + 2`` shingles in the global order, rare ones first."""
    level = _level_of(s, levels)
    most = len(s) + (-percent * len(s)) // 100 + 2
    return s[np.argsort(level, kind="stable")[:most]]


def _parity(s: np.ndarray) -> bytes:
    """A bit per cell: is the number of shingles that fall into it odd? As many cells as shingles, up to a power of two.

    Where two sets' bits differ, so do the sets, in one shingle for each bit at least.
    """
    cells = max(64, 1 << max(0, len(s) - 1).bit_length())
    odd = np.bincount((s >> np.uint64(8)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _half(bits: np.ndarray) -> np.ndarray:
    """Parities over half as many cells, along the last axis."""
    n = bits.shape[-1] // 2
    return bits[..., :n] ^ bits[..., n:]


def _differences(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Bits in which ``one`` differs from each of ``many``, in cells of the smaller kind."""
    while one.shape[-1] > many.shape[-1]:
        one = _half(one)
    while many.shape[-1] > one.shape[-1]:
        many = _half(many)
    return np.bitwise_count(one ^ many).sum(axis=-1, dtype=np.int64)


def _most_differences(n, m, percent: int):
    """The largest symmetric difference of linked sets of sizes n and m."""
    return n + m - 2 * (-(-percent * (n + m) // (100 + percent)))


def _boundary(sized: DataFrame) -> int:
    """The largest set size for which subsets are enumerated, by least total cost."""
    bucket = F.floor(F.log2("n") * 8)
    rows = sized.groupBy(bucket.alias("bucket")).agg(F.max("n").alias("n"), F.sum("subsets").alias("small"), F.sum("lists").alias("large")).orderBy("bucket").collect()
    best, at, cost = sum(r["large"] for r in rows), 0, sum(r["large"] for r in rows)
    for r in rows:
        cost += r["small"] - r["large"]
        if cost <= best:
            best, at = cost, r["n"]
    return at


def _listed(sig: np.ndarray, level: np.ndarray, i: int, list_bits: int) -> np.ndarray:
    """Signatures with their low bits given to the part of the list that row ``i`` goes to, for lists that may be very long."""
    parts = np.left_shift(1, np.clip(level.astype(np.int64) - 1 - list_bits, 0, 15))
    part = int(mix(np.array([i], dtype=np.int64).view(np.uint64))[0] >> np.uint64(48)) % parts
    return (sig & ~np.uint64(0xFFFF)) | np.where(parts > 1, 0x8000 | part, 0).astype(np.uint64)


def _signatures(batch: pa.RecordBatch, boundary: int, percent: int, levels: np.ndarray, list_bits: int) -> dict:
    sig, key, size, pos = [], [], [], []
    for i, n, data in zip(batch.column("id").to_pylist(), batch.column("n").to_pylist(), batch.column("prefix").to_pylist()):
        t = np.frombuffer(data, dtype=np.uint64)
        level = _level_of(t, levels)
        if n <= boundary:
            a, b = np.triu_indices(len(t), 1)
            with np.errstate(over="ignore"):
                low, high = np.minimum(t[a], t[b]), np.maximum(t[a], t[b])
                sig.append(_listed(mix(mix(low) * _K + high), np.minimum(level[a], level[b]), i, list_bits))
            pos.append(np.full(len(a), -1))
            key.append(np.full(len(a), i))
            size.append(np.full(len(a), n))
        if 100 * n >= percent * (boundary + 1):
            sig.append(_listed(t[:-1], level[:-1], i, list_bits))
            pos.append(np.arange(len(t) - 1))
            key.append(np.full(len(t) - 1, i))
            size.append(np.full(len(t) - 1, n))
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, dtype=kind)
    place = (join(size, np.int64) << 32) | (join(pos, np.int64) + 1)
    return {"sig": join(sig, np.uint64).view(np.int64), "id": join(key, np.int64), "place": place}


def _allowed(n: np.ndarray, p: np.ndarray, m, q, percent: int) -> np.ndarray:
    """Whether sets of sizes n and m that first meet at positions p and q can link; position -1 is unknown."""
    most = np.minimum(n - np.maximum(p, 0), m - np.maximum(q, 0))
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * most >= percent * (n + m))


def _pairs_of_lists(batches: Iterator[pa.RecordBatch], percent: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b), and the rows (sig, id, place) of long lists and of parts of lists, ``core`` for a part's first ones."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sig", pa.int64()), ("place", pa.int64()), ("core", pa.bool_())])
    for sig, key, place in runs(batches, 3):
        starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        sizes = np.diff(np.append(starts, len(sig)))
        n, p = place >> 32, (place & 0xFFFFFFFF) - 1
        left, right = [], []
        # Within a list rows are sorted by size: partners are the next ones, at growing distance.
        part = sig[starts] & 0x8000 != 0
        short = np.repeat((sizes <= limits.short) & (sizes > 1) & ~part, sizes)
        end = np.repeat(starts + sizes, sizes)
        row = np.flatnonzero(short)
        step = 1
        while len(row):
            row = row[row + step < end[row]]
            row = row[100 * n[row] >= percent * n[row + step]]
            ok = _allowed(n[row], p[row], n[row + step], p[row + step], percent)
            left.append(key[row[ok]])
            right.append(key[row[ok] + step])
            step += 1
        hot_sig, hot_key, hot_place, hot_core = [], [], [], []
        for s, size in zip(starts[(sizes > limits.short) | part], sizes[(sizes > limits.short) | part]):
            k, nn, pp = key[s : s + size], n[s : s + size], p[s : s + size]
            order = np.lexsort((k, pp))
            core = int(order[0])
            ok = _allowed(nn, pp, nn[core], pp[core], percent)
            left += [k[ok], k[:-1]]
            right += [np.full(int(ok.sum()), k[core]), k[1:]]
            hot_sig.append(sig[s : s + size] & ~0xFFFF)
            hot_key.append(k)
            hot_place.append(place[s : s + size])
            first = np.zeros(size, dtype=bool)
            first[order[: limits.cores]] = bool(sig[s] & 0x8000)
            hot_core.append(first)
        if left and sum(map(len, left)):
            a, b = np.concatenate(left), np.concatenate(right)
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b], axis=0)
            none = pa.nulls(len(both), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, none, pa.nulls(len(both), pa.bool_())], schema=schema)
        if hot_sig:
            rows = np.concatenate(hot_key)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.nulls(len(rows), pa.int64()), *[pa.array(np.concatenate(x)) for x in (hot_sig, hot_place, hot_core)]], schema=schema)


def _distinct(pairs: list[np.ndarray]) -> pa.RecordBatch:
    both = np.unique(np.concatenate(pairs), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _pairs_of_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a left and a right row of a block in different components; a block holds (block, id, place, component, side, parity)."""
    for block, key, place, component, side, parity in runs(batches, 6):
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        for s, e in zip(starts, np.append(starts[1:], len(block))):
            k, n, p, c, left = key[s:e], place[s:e] >> 32, (place[s:e] & 0xFFFFFFFF) - 1, component[s:e], np.flatnonzero(side[s:e] == 0)
            bits = [np.frombuffer(x, dtype=np.uint8) for x in parity[s:e]]
            width = np.array([len(x) for x in bits])
            right = np.flatnonzero(side[s:e] != 0)
            if not len(right):  # a block with itself
                right = left
            own = {w: (np.flatnonzero(width[right] == w), np.stack([bits[i] for i in right if len(bits[i]) == w])) for w in np.unique(width[right]).tolist()}
            found, many = [], 0
            for i in left:
                if many > 1 << 18:
                    yield _distinct(found)
                    found, many = [], 0
                ok = (c[right] != c[i]) & _allowed(n[right], p[right], n[i], p[i], percent)
                if right is left:
                    ok &= k[right] < k[i]
                for at, table in own.values():
                    some = np.flatnonzero(ok[at])
                    some = some[_differences(bits[i], table[some]) <= _most_differences(n[right[at[some]]], n[i], percent)] if len(some) else some
                    if len(some):
                        other = k[right[at[some]]]
                        found.append(np.stack([np.minimum(other, k[i]), np.maximum(other, k[i])], axis=1))
                        many += len(some)
            if found:
                yield _distinct(found)


def _narrow(s: np.ndarray) -> bytes:
    return np.ascontiguousarray((s >> np.uint64(64 - 8 * WIDTH)).view(np.uint8).reshape(-1, 8)[:, :WIDTH]).tobytes()


def _wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), dtype=np.uint8)
    out[:, :WIDTH] = np.frombuffer(data, dtype=np.uint8).reshape(-1, WIDTH)
    return out.view(np.uint64).ravel()


def _verify(docs: DataFrame, pairs: DataFrame, k: int, percent: int, block_rows: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. ``pairs`` must be distinct and written."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    # A filter of bounded size keeps most texts out of the shuffle; beyond it a join does.
    few = pairs.count() <= FILTERED
    shared = share(docs, bitmap(ends, "id")) if few else None

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).cast(pa.int64())
            own = pa.array(np.flatnonzero(in_bitmap(shared.value, key.to_numpy(zero_copy_only=False))) if shared else np.arange(len(key)))
            data = [_narrow(shingles(t, k)) for t in batch.column(1).take(own).to_pylist()]
            yield pa.RecordBatch.from_arrays([key.take(own), pa.array(data, pa.binary())], names=["id", "data"])

    rows = docs.filter("id is not null")
    own = checkpoint((rows if few else rows.join(ends.distinct(), "id", "left_semi")).mapInArrow(tidy(sets), "id long, data binary"))
    if shared:
        shared.unpersist()
    # A document with very many partners is sent to several tasks, with a block of them each.
    busy = pairs.groupBy("a").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int")
    partners = pairs.join(busy, "a").select("a", block.alias("block"), F.col("b").alias("id")).join(own, "id").select("a", "block", F.col("id").alias("b"), "data")
    centres = busy.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(own.withColumnRenamed("id", "a"), "a").select("a", "block", F.lit(None).cast("long").alias("b"), "data")
    rows = partners.unionByName(centres).repartition("a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, whole, n = None, np.zeros(0, dtype=np.uint64), 0
        for batch in batches:
            a_out, b_out = [], []
            for a, b, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if b is None:
                    centre, whole = a, _wide(data)
                    n = len(whole)
                    continue
                assert a == centre
                other = _wide(data)
                at = np.searchsorted(whole, other)
                common = int((whole[np.minimum(at, n - 1)] == other).sum())
                if (100 + percent) * common >= percent * (n + len(other)):
                    a_out.append(a)
                    b_out.append(b)
            if a_out:
                yield pa.RecordBatch.from_pydict({"a": a_out, "b": b_out}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return checkpoint(rows.mapInArrow(tidy(compare), "a long, b long"))


def _candidates(df: DataFrame, id_col: str, text_col: str, k: int, percent: int, limits: Limits) -> dict[str, DataFrame]:
    """``docs`` (id, text), ``documents`` (id, n, fp), ``stands`` (class_id, n, fp), ``parities`` (id, n, parity), ``pairs`` (a, b) and the rows of ``hot`` lists (sig, id, place)."""
    small_batches(df)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bits = bits_for(df.count(), *SKETCH_BITS)
    sums = checkpoint(docs.mapInArrow(tidy(lambda it: _sums(it, k, bits)), "id long, n int, fp binary, piece int"))
    documents = sums.filter("piece is null").select("id", "n", "fp")
    classes = documents.filter("n > 0").groupBy("fp").agg(F.min("id").alias("class_id"), F.first("n").alias("n"))
    levels = share(df, _levels(sums, bits))
    stands = checkpoint(classes.select("class_id", "n", "fp"))
    # A set that is so small that one different shingle unlinks it needs no signature.
    least = next(n for n in range(1, 101) if 100 * n >= percent * (n + 1) or n == 100)

    def prefixes(batch: pa.RecordBatch) -> dict:
        out = {"id": batch.column(0).cast(pa.int64()), "prefix": [], "parity": [], "subsets": [], "lists": []}
        for text in batch.column(1).to_pylist():
            s = shingles(text, k)
            t = _prefix(s, levels.value, percent) if len(s) >= least else s[:0]
            own = _level_of(t[:-1], levels.value)
            out["prefix"].append(t.tobytes())
            out["parity"].append(_parity(s))
            out["subsets"].append(len(t) * (len(t) - 1) / 2.0)
            # A member of a short list meets half of it, one of a long list a fixed number.
            length = np.exp2(np.maximum(own.astype(float) - 1, 0))
            out["lists"].append(float(np.where(length > limits.short, 3.0, np.maximum(length / 2, 1.0)).sum()))
        return out

    made = arrow_map(docs.filter("id is not null"), prefixes, "id long, prefix binary, parity binary, subsets double, lists double")
    sized = checkpoint(made.join(stands.select(F.col("class_id").alias("id"), "n").filter(F.col("n") >= least), "id").dropDuplicates(["id"]))
    boundary = _boundary(sized)
    signed = arrow_map(sized.select("id", "n", "prefix"), lambda b: _signatures(b, boundary, percent, levels.value, limits.list_bits), "sig long, id long, place long")
    of_lists = lambda rows: rows.repartition("sig").sortWithinPartitions("sig", "place", "id").mapInArrow(tidy(lambda it: _pairs_of_lists(it, percent, limits), MANY), "a long, b long, sig long, place long, core boolean")
    found = checkpoint(of_lists(signed))
    levels.destroy()
    parities = sized.select("id", "n", "parity")
    across_parts = of_lists(found.filter("core").select("sig", F.col("a").alias("id"), "place"))
    pairs = found.filter("sig is null").select("a", "b").union(across_parts.filter("sig is null").select("a", "b"))
    pairs = checkpoint(_near(pairs.distinct(), parities, percent))
    hot = found.filter("sig is not null").select("sig", F.col("a").alias("id"), "place")
    return {"docs": docs, "documents": documents, "stands": stands, "parities": parities, "pairs": pairs, "hot": hot}


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85, limits: Limits = Limits()) -> DataFrame:
    """``id_col``, ``n_shingles``, ``class_id`` (least id with an equal set) and ``component_id`` per document."""
    c = _candidates(df, id_col, text_col, k, percent, limits)
    links = _verify(c["docs"], c["pairs"], k, percent, limits.block)
    labels = connected_components(links)
    across = _across(c["hot"], labels, c["parities"], percent, limits.side)
    if not across.isEmpty():
        more = checkpoint(across.join(c["pairs"], ["a", "b"], "left_anti"))
        if not more.isEmpty():
            labels = connected_components(links.union(_verify(c["docs"], more, k, percent, limits.block)))
    of_class = c["stands"].join(labels.withColumnRenamed("id", "class_id"), "class_id", "left").select("fp", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    out = c["documents"].join(of_class, "fp", "left")
    alone = lambda x: F.when(F.col("n") > 0, F.col(x)).otherwise(F.col("id")).alias(x)
    kind = df.select(id_col).schema[0].dataType
    return out.select(F.col("id").cast(kind).alias(id_col), F.col("n").cast("long").alias("n_shingles"), alone("class_id"), alone("component_id"))


def jaccard_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """All links (a, b) between class representatives, and the membership (``id_col``, class_id) of documents with a set.

    Costs more than components: all pairs of a long list that sizes, positions and parity bits allow are verified.
    """
    c = _candidates(df, id_col, text_col, k, percent, limits)
    every = c["pairs"].union(_across(c["hot"], None, c["parities"], percent, limits.side)).distinct()
    kind = df.select(id_col).schema[0].dataType
    members = c["documents"].join(c["stands"].select("fp", "class_id"), "fp").select(F.col("id").cast(kind).alias(id_col), "class_id")
    return _verify(c["docs"], checkpoint(every), k, percent, limits.block), members


def _near(pairs: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parity bits don't rule a link out."""
    a, b = parities.toDF("a", "n", "x"), parities.toDF("b", "m", "y")

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "m"))
            most = _most_differences(n, m, percent)
            x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
            near = [int(_differences(np.frombuffer(i, dtype=np.uint8), np.frombuffer(j, dtype=np.uint8))) <= k for i, j, k in zip(x, y, most.tolist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(tidy(filtered), "a long, b long")


def _across(hot: DataFrame, labels: DataFrame | None, parities: DataFrame, percent: int, side_rows: int) -> DataFrame:
    """Distinct pairs of the long lists, without those inside a component of ``labels``.

    A list's members are dealt to blocks, and each pair of blocks is a key of its own, so that a task holds two
    blocks. Members of the largest component need not meet each other.
    """
    rows = hot.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")) if labels else hot.withColumn("component", F.col("id"))
    counts = rows.groupBy("sig", "component").agg(F.count("*").alias("n"))
    lists = counts.groupBy("sig").agg(F.count("*").alias("components"), F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"))
    number = lambda c: F.ceil(c / side_rows).cast("int")
    lists = lists.filter("components > 1").select("sig", F.col("top.component").alias("largest"), number(F.col("top.n")).alias("cores"), number(F.col("n") - F.col("top.n")).alias("rests"))
    rows = rows.join(lists, "sig").join(parities.select("id", "parity"), "id")
    core = F.col("component") == F.col("largest")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.when(core, F.col("cores")).otherwise(F.col("rests"))).cast("int"))
    key = lambda kind, i, j, side: F.struct(F.xxhash64("sig", F.lit(kind), i, j).alias("block"), F.lit(side).alias("side"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    # Core blocks on the left of every other block; other blocks with each other, the lower number on the left.
    of_core = F.transform(upto("rests"), lambda j: key(0, F.col("own"), j, 0))
    of_rest = F.concat(
        F.transform(upto("cores"), lambda i: key(0, i, F.col("own"), 1)),
        F.transform(F.sequence(F.col("own"), F.col("rests") - 1), lambda j: key(1, F.col("own"), j, 0)),
        F.when(F.col("own") > 0, F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: key(1, i, F.col("own"), 1))).otherwise(F.array().cast("array<struct<block: bigint, side: int>>")),
    )
    met = F.explode(F.when(core, of_core).otherwise(of_rest)).alias("met")
    dealt = rows.select("id", "place", "component", "parity", met).select("met.block", "id", "place", "component", "met.side", "parity")
    dealt = dealt.repartition("block").sortWithinPartitions("block", "id")
    return checkpoint(dealt.mapInArrow(tidy(lambda it: _pairs_of_blocks(it, percent)), "a long, b long").distinct())
