"""Array functions for symbol ids, audio samples and padding, by higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Ids of the marks around and between symbols (fixed values).
PAD, BOS, EOS = 0, 1, 2
FULL_SCALE = 32767


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(x: Column, places: int) -> Column:
    """``x`` as C's ``round(x * 10**places) / 10**places``: halves away from zero, and a small negative value gives -0.0.

    Spark's own ``round`` goes through decimals, which have no negative zero.
    """
    x, scale = x.cast("double"), F.lit(10.0**places)
    whole = F.round(x * scale)
    out = F.when(whole == 0, F.signum(x) * 0.0).otherwise(whole / scale)
    # What overflows is round already.
    return F.when(F.abs(out) < float("inf"), out).otherwise(x)


def symbol_ids(symbols: Column | str, ids: Column, bos: int = BOS, eos: int = EOS, pad: int = PAD) -> Column:
    """``BOS PAD (id PAD)* EOS``; ``ids`` maps a symbol to an array of ids, others are left out."""
    inner = F.flatten(F.transform(_col(symbols), lambda s: F.coalesce(F.transform(F.try_element_at(ids, s), lambda i: F.array(i, F.lit(pad))), F.array()).cast("array<array<int>>")))
    return F.concat(F.array(F.lit(bos), F.lit(pad)), F.flatten(inner), F.array(F.lit(eos)))


def plain_ids(symbols: Column | str, ids: Column, unknown: int = 0) -> Column:
    """One id per symbol, ``unknown`` for those without."""
    return F.transform(_col(symbols), lambda s: F.coalesce(F.get(F.try_element_at(ids, s), F.lit(0)), F.lit(unknown)))


def unknown_symbols(symbols: Column | str, ids: Column) -> Column:
    return F.filter(_col(symbols), lambda s: ~F.map_contains_key(ids, s))


def to_int16(audio: Column | str) -> Column:
    """Full-scale integers, clipped and truncated towards zero."""
    return F.transform(_col(audio), lambda x: F.greatest(F.least(x.cast("double") * FULL_SCALE, F.lit(float(FULL_SCALE))), F.lit(-float(FULL_SCALE))).cast("smallint"))


def peak(audio: Column | str) -> Column:
    return F.array_max(F.transform(_col(audio), lambda x: F.abs(x)))


def peak_int16(audio: Column | str, least: float = 0.01) -> Column:
    """Integers scaled so that the peak is full scale."""
    a = _col(audio)
    scale = F.lit(float(FULL_SCALE)) / F.greatest(F.lit(least), peak(a).cast("double"))
    return F.transform(a, lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(FULL_SCALE))), F.lit(-float(FULL_SCALE))).cast("smallint"))


def peak_normalize(audio: Column | str, volume: float = 1.0, silent: float = 1e-8) -> Column:
    """Samples over the peak times ``volume`` in [-1, 1]; zeros for a silent clip."""
    a = _col(audio)
    top = peak(a).cast("double")
    return F.transform(a, lambda x: F.when(top < silent, F.lit(0.0)).otherwise(F.greatest(F.least(x.cast("double") / top * volume, F.lit(1.0)), F.lit(-1.0))))


def silence(rate: int, seconds: float) -> Column:
    """Zero bytes of a pause, as an array; an odd number can occur."""
    return F.array_repeat(F.lit(0), int(rate * seconds * 2))


def intersperse(a: Column | str, item: Column) -> Column:
    """``item`` before, between and after all elements."""
    return F.concat(F.array(item), F.flatten(F.transform(_col(a), lambda x: F.array(x, item))))


def pad_to(a: Column | str, size: Column, item: Column) -> Column:
    c = _col(a)
    return F.concat(c, F.array_repeat(item, F.greatest(size - F.size(c), F.lit(0)).cast("int")))


def mask(lengths: Column, size: Column) -> Column:
    """1 for each of the first ``lengths`` of ``size`` places, then 0."""
    return F.transform(F.sequence(F.lit(0), size.cast("int") - 1), lambda i: F.when(i < lengths, F.lit(1)).otherwise(F.lit(0)))


def expand_durations(durations: Column | str) -> Column:
    """The index of each element as often as its duration says."""
    return F.flatten(F.transform(_col(durations), lambda d, i: F.array_repeat(i, d.cast("int"))))


def running_sum(a: Column | str) -> Column:
    start = F.array().cast("array<bigint>")
    return F.aggregate(_col(a), start, lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("bigint")) + x.cast("bigint"))))


def frames(audio: Column | str, size: int) -> Column:
    """Whole chunks of ``size`` samples; a partial tail is dropped."""
    a = _col(audio)
    n = F.floor(F.size(a) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(a, i * size + 1, size))).otherwise(F.array().cast("array<array<float>>"))


def clip_range(audio: Column | str, start: Column, end: Column, rate: int) -> Column:
    """Samples from ``start`` to ``end`` seconds, null if there are none."""
    a = _col(audio)
    low = F.greatest((start * rate).cast("int"), F.lit(0))
    high = F.least((end * rate).cast("int"), F.size(a))
    return F.when(high > low, F.slice(a, low + 1, high - low))


def mean_square(frame: Column) -> Column:
    return F.aggregate(frame, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")) / F.size(frame)


def speech_span(probabilities: Column | str, threshold: float, chunk: int, total: Column, pad: int = 0, trim_start: bool = False, least: int = 2) -> Column:
    """Struct of first and end sample from the first to the last chunk over the threshold.

    With fewer than ``least`` such chunks the whole clip is kept, and without
    ``trim_start`` so is its beginning.
    """
    hits = F.filter(F.transform(_col(probabilities), lambda p, i: F.when(p >= threshold, i)), lambda i: i.isNotNull())
    first, last = F.element_at(hits, 1), F.element_at(hits, -1)
    start = F.greatest(first * chunk - pad, F.lit(0)) if trim_start else F.lit(0)
    end = F.least((last + 1) * chunk + pad, total)
    whole = F.size(hits) < least
    return F.struct(F.when(whole, F.lit(0)).otherwise(start).alias("start"), F.when(whole, total).otherwise(end).alias("end"))


def count_not_above(bins: Column, x: Column) -> Column:
    """Index of the last bin edge that is not above ``x``, -1 below all."""
    return F.size(F.filter(bins, lambda b: x >= b)) - 1


def samples_per_id(weights: Column | str, hop: int = 256) -> Column:
    return F.transform(_col(weights), lambda w: (F.ceil(w) * hop).cast("bigint"))


def gaussian_kl(mean_p: Column, logs_p: Column, mean_q: Column, logs_q: Column) -> Column:
    """Element-wise divergence of two diagonal Gaussians given as arrays."""
    pairs = F.arrays_zip(mean_p.alias("mp"), logs_p.alias("lp"), mean_q.alias("mq"), logs_q.alias("lq"))
    return F.transform(pairs, lambda z: z["lq"] - z["lp"] - 0.5 + 0.5 * (F.exp(2.0 * z["lp"]) + F.pow(z["mp"] - z["mq"], F.lit(2.0))) * F.exp(-2.0 * z["lq"]))


def aligned_samples(ids: Column, samples: Column, group_sizes: Column) -> Column:
    """Samples per symbol: each symbol's ids with the pads after them, the first and last mark alone.

    ``group_sizes`` holds the number of ids of each group; null if they don't add up.
    """
    ends = running_sum(group_sizes)
    sums = F.transform(ends, lambda e, i: F.aggregate(F.slice(samples, (e - F.get(group_sizes, i)).cast("int") + 1, F.get(group_sizes, i).cast("int")), F.lit(0).cast("bigint"), lambda acc, x: acc + x))
    fits = (F.size(ids) == F.size(samples)) & (F.element_at(ends, -1) == F.size(ids))
    return F.when(fits, sums)


def mono(channels: Column) -> Column:
    """The mean of an array of channels of equal length, sample by sample."""
    total = F.aggregate(F.slice(channels, 2, F.size(channels)), F.get(channels, F.lit(0)), lambda acc, c: F.zip_with(acc, c, lambda a, b: a + b))
    return F.transform(total, lambda x: x / F.size(channels))


def masked_mean(values: Column, mask: Column) -> Column:
    """The mean of values whose mask is 1; null where none is."""
    zero = F.lit(0.0)
    total = F.aggregate(F.zip_with(values, mask, lambda v, m: v * m), zero, lambda acc, x: acc + x)
    return F.try_divide(total, F.aggregate(mask, zero, lambda acc, x: acc + x))
