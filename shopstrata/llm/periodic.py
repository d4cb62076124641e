"""Runs of periodically repeated words, found on a Re-Pair grammar of the texts.

Each batch of texts is turned into word numbers and compressed by rounds of Re-Pair: in a round
every pair of symbols that is more frequent than the pairs it overlaps becomes a nonterminal,
until few pairs recur; what is left is paired off in balance, so that each text ends as one
symbol. Pairs never reach over the end of a text. A run lies inside the smallest nonterminal
that derives it and crosses the boundary between that nonterminal's two halves. So the runs
that cross the boundary are computed once for each nonterminal, on any of its occurrences, then
moved to all positions where the nonterminal is derived. What other nonterminals see is a part
of the same run; the merge keeps the maximal intervals of each period.

A text needs no other text, so there is no shuffle, and a lost executor repeats its tasks only.
Memory follows the batch (``words.BATCH_BYTES`` of text, one text at least), time is
O(n log^2 n) in words.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import documents
from shopstrata.llm.words import Words, hash_windows, mix, runs, text_slices, words_of

MIN_WORDS = 24  # least length of a run
MIN_POWER = 3  # least number of whole periods
FEWEST = 0.05  # share of symbols a round must replace for another round of Re-Pair
PAIRS = 1 << 21  # (nonterminal, period) pairs examined at a time
PRIMES = (2147483647, 2147483629)  # moduli of the fingerprints


class Runs(NamedTuple):
    """Runs of all texts of a batch, by text, start and period; starts count words of the text."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class Level(NamedTuple):
    """What one round made: occurrences of nonterminals as word positions [start, end) cut at middle."""

    symbol: np.ndarray
    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray


def word_numbers(words: Words) -> tuple[pa.Array, np.ndarray]:
    """The words, and numbers that are equal where words are identical."""
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.starts] = 1
    inside[words.ends] -= 1
    letters = words.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = np.zeros(len(words.starts) + 1, np.int64)
    np.cumsum(words.ends - words.starts, out=offsets[1:])
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return array, array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _peaks(score: np.ndarray) -> np.ndarray:
    """Places to replace: scores above both neighbours; of equal neighbours every other one."""
    new = np.ones(len(score), bool)
    new[1:] = score[1:] != score[:-1]
    first = np.flatnonzero(new)
    level = score[first]
    top = level > 0
    top[1:] &= level[1:] > level[:-1]
    top[:-1] &= level[:-1] > level[1:]
    group = np.cumsum(new) - 1
    return np.flatnonzero(top[group] & ((np.arange(len(score)) - first[group]) % 2 == 0))


def grammar(numbers: np.ndarray, texts: np.ndarray, least: int) -> Iterator[Level]:
    """Levels of a grammar of all texts, bottom up; nonterminals shorter than ``least`` words are left out."""
    symbol, text = numbers, texts
    start = np.arange(len(numbers) + 1)  # the last entry is the end of the batch
    fresh = int(numbers.max(initial=0)) + 1
    frequent = True
    while len(symbol) and text[0] != text[-1] or len(symbol) > 1:
        same = text[1:] == text[:-1]
        if not same.any():
            return
        pair = np.where(same, symbol[:-1] * fresh + symbol[1:], -1)
        if frequent:
            kinds, kind, count = np.unique(pair, return_inverse=True, return_counts=True)
            count[(count < 2) | (kinds < 0)] = 0
            spread = mix(kinds.view(np.uint64)) >> np.uint64(32)
            score = np.where(count > 0, count.astype(np.uint64) << np.uint64(32) | spread, np.uint64(0))
            at = _peaks(score[kind])
            frequent = len(at) >= FEWEST * len(symbol)
        if not frequent:
            begin = np.flatnonzero(np.r_[True, ~same])
            inner = np.arange(len(symbol)) - np.repeat(begin, np.diff(np.r_[begin, len(symbol)]))
            at = np.flatnonzero(same & (inner[:-1] % 2 == 0))
        _, made = np.unique(pair[at], return_inverse=True)
        made += fresh
        fresh += len(at)
        end = start[at + 2]
        long = end - start[at] >= least
        yield Level(made[long], start[at][long], start[at + 1][long], end[long])
        symbol = symbol.copy()
        symbol[at] = made
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, text, start = symbol[keep], text[keep], start[np.r_[keep, True]]


class Fingerprints:
    """Equality of any two stretches of one word sequence, by polynomials modulo two primes."""

    def __init__(self, numbers: np.ndarray):
        self.parts = []
        for seed, prime in enumerate(PRIMES, 1):
            p = np.uint64(prime)
            values = mix((numbers + seed * 1_000_003).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % p
            base, powers = 1_000_000_007 + seed, np.ones(len(numbers) + 1, np.uint64)
            size = 1
            while size < len(powers):
                step = np.uint64(pow(base, size, prime))
                powers[size:2 * size] = powers[:len(powers[size:2 * size])] * step % p
                size *= 2
            sums = np.zeros(len(numbers) + 1, np.uint64)
            np.cumsum(values * powers[:-1] % p, out=sums[1:])
            self.parts.append((p, powers, sums % p))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether [a, a + length) equals [b, b + length); a <= b."""
        out = np.ones(len(a), bool)
        for p, powers, sums in self.parts:
            left = (sums[a + length] + p - sums[a]) % p * powers[b - a] % p
            out &= left == (sums[b + length] + p - sums[b]) % p
        return out

    def extension(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """How far the words from a and from b agree, forward (step 1) or backward (step -1)."""
        low, high = np.zeros_like(limit), limit.copy()
        for _ in range(int(limit.max(initial=0)).bit_length()):
            half = (low + high + 1) // 2
            back = half if step < 0 else 0
            agree = self.equal(a - back, b - back, half)
            low, high = np.where(agree, half, low), np.where(agree, high, half - 1)
        return low


def crossing_runs(level: Level, numbers: np.ndarray, eights: np.ndarray, prints: Callable[[], Fingerprints],
                  least: int, power: int):
    """(nonterminal, start, end, period) of runs over the boundary of each distinct nonterminal.

    Starts and ends count from the nonterminal's first word. A run of period q that crosses
    the boundary m has m and m + q, or m - q and m, inside, and agrees with itself q words on
    for 8 words at least on one side of m; hashes of 8 words sort out almost all other periods.
    """
    n = len(numbers)
    kinds, first = np.unique(level.symbol, return_index=True)
    start, middle, end = (a[first] for a in level[1:])
    tries = (end - start) // power
    found = []
    low, done = 0, np.cumsum(tries)
    while low < len(kinds):
        high = max(low + 1, int(np.searchsorted(done, (done[low - 1] if low else 0) + PAIRS, "right")))
        which = np.repeat(np.arange(low, high), tries[low:high])
        period = runs(np.ones(high - low, np.int64), tries[low:high])
        for ahead in (True, False):
            m, lo, hi = middle[which], start[which], end[which]
            a, b = (m, m + period) if ahead else (m - period, m)
            fits = (b < hi) if ahead else (a >= lo)
            w, q, m, lo, hi, a, b = (x[fits] for x in (which, period, m, lo, hi, a, b))
            cross = numbers[a - 1] == numbers[b - 1] if ahead else numbers[a] == numbers[b]
            w, q, m, lo, hi, a, b = (x[cross] for x in (w, q, m, lo, hi, a, b))
            after = eights[a] == eights[b]
            before = (a - 8 >= lo) & (eights[np.maximum(a - 8, 0)] == eights[np.maximum(b - 8, 0)])
            likely = after & (b + 8 <= n) | before
            if not likely.any():
                continue
            w, q, lo, hi, a, b = (x[likely] for x in (w, q, lo, hi, a, b))
            left = prints().extension(a, b, a - lo, -1)
            right = prints().extension(a, b, hi - b, 1)
            s, e = a - left, b + right
            good = (e - s >= np.maximum(least, power * q)) & ((left if ahead else right) > 0)
            found.append(np.stack([w, s - lo, e - lo, q])[:, good])
        low = high
    if not found:
        return kinds, np.zeros((4, 0), np.int64)
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    if rows.shape[1]:  # of one interval the smallest period stays
        rows = rows[:, np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]]
    return kinds, rows


def maximal(text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which intervals lie in no other one of the same text and period; of equal ones the first."""
    order = np.lexsort((-end, start, period, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    if not len(text):
        return order
    group = np.cumsum(np.r_[False, (text[1:] != text[:-1]) | (period[1:] != period[:-1])])
    reach = np.maximum.accumulate(group * (end.max() + 1) + end)
    return order[np.r_[True, (group[1:] != group[:-1]) | (reach[1:] > reach[:-1])]]


def find_runs(numbers: np.ndarray, docs: np.ndarray, least: int = MIN_WORDS, power: int = MIN_POWER) -> Runs:
    """All maximal runs of the texts ``docs[i]:docs[i + 1]`` of one sequence of word numbers."""
    if least < 24 or power < 3:  # shorter runs need not agree over 8 words beside a boundary
        raise ValueError("runs have 24 words and three periods at least")
    texts = np.repeat(np.arange(len(docs) - 1), np.diff(docs))
    eights = np.zeros(len(numbers), np.uint64)
    hashes = hash_windows(mix((numbers + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), 8)
    eights[:len(hashes)] = hashes
    made: list[Fingerprints] = []

    def prints() -> Fingerprints:
        if not made:
            made.append(Fingerprints(numbers))
        return made[0]

    parts = []
    for level in grammar(numbers, texts, least):
        if not len(level.symbol):
            continue
        kinds, rows = crossing_runs(level, numbers, eights, prints, least, power)
        if not rows.shape[1]:
            continue
        order = np.argsort(level.symbol, kind="stable")
        begin = np.searchsorted(level.symbol[order], kinds)
        times = np.diff(np.r_[begin, len(order)])[rows[0]]
        at = level.start[order[runs(begin[rows[0]], times)]]
        s, e, q = (np.repeat(x, times) for x in rows[1:])
        parts.append(np.stack([at + s, at + e, q]))
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none)
    s, e, q = np.concatenate(parts, axis=1)
    text = texts[s]
    keep = maximal(text, s, e, q)
    keep = keep[np.lexsort((q[keep], s[keep], text[keep]))]
    text, s, e, q = text[keep], s[keep], e[keep], q[keep]
    return Runs(text, s - docs[text], e - s, q)


def _batch(ids: pa.Array, texts: pa.Array, least: int, power: int, rearranged) -> pa.RecordBatch:
    words = words_of(texts)
    letters, numbers = word_numbers(words)
    if rearranged is not None:
        order = rearranged(ids, words.docs)
        letters, numbers = letters.take(pa.array(order)), numbers[order]
    found = find_runs(numbers, words.docs, least, power)
    gone = np.zeros(len(numbers) + 1, np.int64)
    s = words.docs[found.text] + found.start
    np.add.at(gone, s + found.period, 1)
    np.subtract.at(gone, s + found.length, 1)
    keep = np.cumsum(gone[:-1]) == 0
    left = np.r_[0, np.cumsum(keep)][words.docs]
    kept = pc.binary_join(
        pa.LargeListArray.from_arrays(pa.array(left), letters.filter(pa.array(keep)).cast(pa.large_string())),
        pa.scalar(" ", pa.large_string()))
    run = pa.StructArray.from_arrays(
        [pa.array(x) for x in (found.start, found.length, found.period)], ["start", "length", "period"])
    cuts = np.searchsorted(found.text, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(words.lengths()), pa.ListArray.from_arrays(pa.array(cuts), run), kept.cast(pa.string())],
        ["id", "n_words", "runs", "kept"])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS,
                  power: int = MIN_POWER, rearranged: Callable[[pa.Array, np.ndarray], np.ndarray] | None = None,
                  ) -> DataFrame:
    """(id, n_words, runs, kept) for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest
    period q, of at least ``max(least, power * q)`` words, that no neighbouring word extends;
    runs are ordered by start and period. ``kept`` is the text's words joined by one space,
    without those that any run contains after its first q words. Null and empty texts and
    texts without words have no runs and an empty ``kept``; repeated rows, equal and null ids
    are treated as rows of their own; other columns are not looked at; an empty table gives an
    empty result. ``rearranged`` may replace words before runs are looked for: given a
    batch's ids and the word offsets of its texts it returns, for each word, the number of the
    word that stands there.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in text_slices(batch.column(1)):
                part = batch.slice(low, high - low)
                yield _batch(part.column(0), part.column(1), least, power, rearranged)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        work, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string")


def strongest(found: Column) -> Column:
    """The run of greatest length / period, compared exactly; the first of equals in the given order."""
    def better(a: Column, b: Column) -> Column:
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    return F.aggregate(found, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def repeats_by_id(ids: pa.Array, docs: np.ndarray) -> np.ndarray:
    """Word order in which a tenth of the texts, by a checksum of the id, end in repeats of some of their words."""
    order = np.arange(docs[-1])
    for i, key in enumerate(ids.to_pylist()):
        n = int(docs[i + 1] - docs[i])
        check = 1 if key is None else zlib.crc32(str(key).encode())
        if check % 10 or not n:
            continue
        g = check // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        order[docs[i] + a:docs[i + 1]] = docs[i] + a + np.arange(n - a) % p
    return order


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(documents(spark, sf_dir), rearranged=repeats_by_id).withColumn("best", strongest(F.col("runs")))
    line = lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"))
