"""Removal of passages that repeat, exactly, by anchored phrases of the whole corpus.

The corpus is its own reference. Every text is cut into phrases at anchors, the smallest
hashed run of ``ANCHOR`` words in each window of ``WINDOW`` words: equal windows have equal
anchors wherever they stand, so a phrase (the windows that share an anchor) needs to be
compared only with phrases of the same anchor. The phrases of all texts, dealt out by
anchor, are the index.

A phrase that occurs again as a whole, by its digest, is a duplicate span with all its windows.
Where phrases of one anchor differ, at the ends of a repeated passage, every window of one copy
of each is looked up by a 128-bit digest. So a repeated passage is found as a row of whole
phrases and the windows at both its ends; no window is left out. This takes the place of a
greedy Lempel-Ziv parse of each text against every block of the corpus: the spans are the same,
but no text is read against a block that holds no match, and no factor is carried from phrase to
phrase. The result is exact up to the chance that two different digests meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch, documents
from shopstrata.llm.words import Words, hash_windows, hash_words, mix, runs, signed, text_slices, words_of

WINDOW = 35
ANCHOR = 8


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the first smallest of the next ``width`` values is."""
    at, size = np.arange(len(values)), 1
    while 2 * size <= width:
        left, right = at[:len(at) - size], at[size:]
        at, size = np.where(values[left] <= values[right], left, right), 2 * size
    shift = width - size
    if shift:
        left, right = at[:len(at) - shift], at[shift:]
        at = np.where(values[left] <= values[right], left, right)
    return at


def window_starts(words: Words, window: int) -> np.ndarray:
    """Places of all windows that lie inside one text."""
    return runs(words.docs[:-1], np.maximum(words.lengths() - window + 1, 0))


def phrases(words: Words, window: int = WINDOW):
    """(text, first window, windows, anchor, digest) of every phrase."""
    starts = window_starts(words, window)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = hash_words(words)
    grams = hash_windows(hashes, ANCHOR)
    anchor = first_smallest(grams, window - ANCHOR + 1)[starts]
    whole = hash_windows(hashes, window, seed=2)
    text = words.owner()[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    head, tail = whole[starts[first]], whole[starts[first + count - 1]]
    # the first and the last window overlap, so together with the count they fix every word
    digest = mix(head * np.uint64(0x9E3779B97F4A7C15) + mix(tail + count.astype(np.uint64)))
    text = text[first]
    return text, starts[first] - words.docs[text], count, grams[anchor[first]], digest


def _phrase_table(docs: DataFrame, window: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            texts = batch.column("_text")
            for low, high in text_slices(texts):
                text, pos, count, anchor, digest = phrases(words_of(texts.slice(low, high - low)), window)
                rows = pa.array(text + low)
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").take(rows), batch.column("_mark").take(rows), pa.array(pos.astype(np.int32)),
                    pa.array(count.astype(np.int32)), signed(anchor), signed(digest)],
                    ["_id", "_mark", "pos", "n", "anchor", "digest"])

    return docs.mapInArrow(work, f"_id {dict(docs.dtypes)['_id']}, _mark int, pos int, n int, anchor bigint, digest bigint")


def _spans(column: pa.Array):
    """(row, pos, n) of a column of lists of (pos, n); null lists have none."""
    sizes = np.array([0 if v is None else v for v in pa.compute.list_value_length(column).to_pylist()], np.int64)
    flat = column.flatten()
    return (np.repeat(np.arange(len(column)), sizes), flat.field("pos").to_numpy(zero_copy_only=False).astype(np.int64),
            flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64))


def _window_table(docs: DataFrame, window: int) -> DataFrame:
    """128-bit digests of the windows listed in ``spans``."""

    def work(batches):
        for batch in batches:
            texts, spans = batch.column("_text"), batch.column("spans")
            for low, high in text_slices(texts):
                words = words_of(texts.slice(low, high - low))
                row, pos, n = _spans(spans.slice(low, high - low))
                at = runs(words.docs[row] + pos, n)
                owner = np.repeat(row, n)
                one = hash_windows(hash_words(words, 1), window, seed=3)[at]
                two = hash_windows(hash_words(words, 4), window, seed=4)[at]
                rows = pa.array(owner + low)
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").take(rows), batch.column("_mark").take(rows),
                    pa.array((at - words.docs[owner]).astype(np.int32)), signed(one), signed(two)],
                    ["_id", "_mark", "pos", "one", "two"])

    return docs.mapInArrow(work, f"_id {dict(docs.dtypes)['_id']}, _mark int, pos int, one bigint, two bigint")


def kept_texts(words: Words, removed: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of each text that stay, joined by one space, and how many go."""
    n = len(words.docs) - 1
    stay = np.flatnonzero(~removed)
    sizes = words.ends[stay] - words.starts[stay] + 1
    data = np.append(words.data, np.uint8(32))
    out = data[runs(words.starts[stay], sizes)]
    stops = np.cumsum(sizes)
    out[stops - 1] = 32
    owner = words.owner()
    per_text = np.bincount(owner[stay], minlength=n)
    edges = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(per_text)])]
    # drop the space after the last word of each text
    keep = np.ones(len(out), bool)
    some = per_text > 0
    keep[edges[1:][some] - 1] = False
    offsets = edges - np.concatenate([[0], np.cumsum(some)])
    joined = pa.LargeStringArray.from_buffers(
        n, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out[keep].tobytes()))
    return joined.cast(pa.string()), words.lengths() - per_text


def _result(docs: DataFrame, window: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            texts, spans = batch.column("_text"), batch.column("spans")
            for low, high in text_slices(texts):
                words = words_of(texts.slice(low, high - low))
                row, pos, n = _spans(spans.slice(low, high - low))
                cover = np.zeros(len(words.starts) + 1, np.int64)
                begin = words.docs[row] + pos
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + n - 1 + window, -1)
                kept, gone = kept_texts(words, np.cumsum(cover[:-1]) > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(low, high - low), pa.array(words.lengths()), pa.array(gone), kept],
                    ["id", "n_words", "n_removed", "kept"])

    return docs.mapInArrow(work, f"id {dict(docs.dtypes)['_id']}, n_words bigint, n_removed bigint, kept string")


def remove_repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept) for every row; ``kept`` is the text without repeated passages.

    Every word goes that lies in a window of ``window`` words which starts anywhere else too, in
    the same text or another. Null and empty texts have no words; texts shorter than a window
    stay whole. Rows that repeat are occurrences of their own, so both lose all windows they
    share. Rows are told apart by id and a hash of the text; a null id is an id.
    """
    if window < ANCHOR + 1:
        raise ValueError(f"a window has more than {ANCHOR} words")
    given = docs.select(
        F.col(id_col).alias("_id"), (F.xxhash64(text_col) % (1 << 31)).cast("int").alias("_mark"),
        F.col(text_col).alias("_text"))

    table = scratch.table(_phrase_table(given, window), "phrases")
    again = scratch.table(table.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    shared = scratch.table(table.join(again, "anchor", "left_semi"), "shared")
    scratch.drop("phrases")
    known = scratch.table(
        shared.groupBy("anchor", "digest").agg(
            F.count("*").alias("times"), F.min(F.struct("_id", "_mark", "pos", "n")).alias("first")), "known")

    # phrases that occur again as a whole
    whole = shared.join(known.where("times > 1").select("anchor", "digest"), ["anchor", "digest"], "left_semi")
    # ends of passages: one of each phrase whose anchor has several
    several = scratch.table(known.groupBy("anchor").count().where("count > 1").select("anchor"), "several")
    ends = known.join(several, "anchor", "left_semi").select("first.*")
    windows = scratch.table(_window_table(_with_spans(given, ends, "inner"), window), "windows")
    met = scratch.table(windows.groupBy("one", "two").count().where("count > 1").select("one", "two"), "met")
    partly = windows.join(met, ["one", "two"], "left_semi")
    spans = whole.select("_id", "_mark", "pos", "n").unionByName(
        partly.select("_id", "_mark", "pos", F.lit(1).alias("n")))
    return _result(_with_spans(given, spans, "left"), window)


def _with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Texts with all their spans, each once; a text has at most as many as words.

    Rows that repeat share an entry, so their spans do not add up.
    """
    listed = spans.groupBy(F.col("_id").alias("_i"), F.col("_mark").alias("_m")).agg(
        F.collect_set(F.struct("pos", "n")).alias("spans"))
    same = docs["_id"].eqNullSafe(listed["_i"]) & docs["_mark"].eqNullSafe(listed["_m"])
    return docs.join(listed, same, how).select("_id", "_mark", "_text", "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), Scratch(spark, "substring")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
