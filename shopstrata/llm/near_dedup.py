"""Near-duplicates by bottom-k sketches from one hash function.

The hashes of a set's shingles, sorted, begin with its sketch: the ``SKETCH`` smallest. Sets of
similarity s agree on most of the union's smallest hashes, so in a similar pair some ``RUN``
consecutive hashes of one sketch are consecutive in the other too. Such runs are the keys of
inverted lists: they hold similar sets, but seldom two sets that just share a passage. Below a
threshold of 0.85 runs are one shorter. (For sets that fit into their sketch a common run is
certain; for longer ones, at similarity 0.85 exactly, the chance to have none is about 6e-9, and
at 0.8 with runs of three about 1e-10. Together with the chance of an estimate below its floor, at
most 1.5e-9, such a pair is missed with a chance below 8e-9.)

Sets that are equal form one class and are compared once. Lists give overlaps, estimates from
the sketch of the union drop those far below the threshold, and what is left forms clusters;
there links are confirmed on full sets. A list, a cluster or a group of copies may be large:
members of a cluster meet in blocks of bounded size, first with a common head, and only those
that are still apart are compared with all blocks. Links leave a task as a spanning forest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.functions.columns import named
from shopstrata.llm.components import components
from shopstrata.llm.scratch import Scratch, documents, gives_back, unused
from shopstrata.llm.words import Words, hash_windows, hash_words, mix, text_slices, words_of

SHINGLE = 3
PERCENT = 85
SKETCH = 64
RUN = 4
SLACK = 7  # standard errors below the threshold at which an estimate is dropped
LIST = 1024  # longer lists are joined whole, without estimates; clusters settle them exactly
BLOCK = 256  # members of a cluster that meet in one task
HEAD = 32  # members of a large cluster that every block meets first
NONE = np.uint32(0xFFFFFFFF)


# ---- sets and sketches ------------------------------------------------------------


def shingle_sets(words: Words, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle make one."""
    hashes, counts = hash_words(words), words.lengths()
    whole = hash_windows(hashes, width)
    out = []
    for start, n in zip(words.docs[:-1].tolist(), counts.tolist()):
        if n >= width:
            out.append(np.unique(whole[start:start + n - width + 1]))
        elif n:
            out.append(mix(hash_windows(hashes[start:start + n], n) ^ np.uint64(n)))
        else:
            out.append(hashes[:0])
    return out


def sketch(values: np.ndarray, size: int = SKETCH) -> np.ndarray:
    """The smallest hashes, cut to 32 bits; their order is kept."""
    return (values[:size] >> np.uint64(32)).astype(np.uint32)


@cache
def run_lengths(set_size: int, percent: int) -> list[int]:
    """Lengths of the runs that are keys of a set of so many shingles.

    ``common`` shingles among ``other`` ones in the union have a run of common / (other + 1), rounded
    up, at least. Small sets get all such lengths that a pair at the threshold may need.
    """
    longest = RUN if percent >= 85 else RUN - 1
    found = {longest}
    if set_size <= SKETCH:
        for common in range(1, set_size + 1):
            most = common * (100 - percent) // percent  # others in the union
            found.update(min(longest, -(-common // (other + 1))) for other in range(max(1, set_size - common), most + 1))
    return sorted(found, reverse=True)


def list_keys(sketched: np.ndarray, set_size: int, percent: int = PERCENT) -> np.ndarray:
    """Keys of the inverted lists: runs of hashes, in small sets also shorter ones."""
    wide = mix(sketched.astype(np.uint64) + np.uint64(1))
    keys = [hash_windows(wide, n, seed=6 + 2 * (RUN - n)) for n in run_lengths(min(set_size, SKETCH + 1), percent)]
    return np.unique(np.concatenate(keys)) if len(keys) > 1 else keys[0]


def padded(sketches: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sketches as rows filled up with NONE, and their lengths."""
    lengths = np.array([min(len(s) // 4, size) for s in sketches], np.int64)
    table = np.full((len(sketches), size), NONE)
    for row, s in enumerate(sketches):
        table[row, :lengths[row]] = np.frombuffer(s, np.uint32, lengths[row])
    return table, lengths


def estimate(one: np.ndarray, two: np.ndarray, size: int, rows: int = 2048) -> np.ndarray:
    """Similarity of pairs of padded rows by the bottom ``size`` of their union, some rows at a time."""
    if len(one) > rows:
        return np.concatenate([estimate(one[n:n + rows], two[n:n + rows], size, rows) for n in range(0, len(one), rows)])
    both = np.sort(np.concatenate([one, two], 1), 1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != NONE)
    real = both != NONE
    rank = np.cumsum(real & ~again, 1)  # in the union, from 1
    low = rank <= size
    union = np.maximum((real & ~again & low).sum(1), 1)
    return (again & low).sum(1) / union


def least_estimate(percent: int, size: int) -> float:
    share = percent / 100
    return share - SLACK * (share * (1 - share) / size) ** 0.5


class Forest:
    """Union-find over the members of one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if percent * max(len(one), len(two)) > 100 * min(len(one), len(two)):
        return False
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    common = int((two[at] == one).sum())
    return 100 * common >= percent * (len(one) + len(two) - common)


def linked(probes: list[int], sets: list[np.ndarray], forest: Forest, percent: int) -> list[tuple[int, int]]:
    """Spanning links between the probes and all sets, joined in ``forest``.

    A probe is compared on full sets with every set of fitting size that is not yet in its tree.
    """
    sizes = np.array([len(s) for s in sets])
    found, trees = [], None
    for p in probes:
        if trees is None:
            trees = np.array([forest.root(i) for i in range(len(sets))])
        apart = np.flatnonzero(
            (trees != trees[p]) & (100 * np.minimum(sizes, sizes[p]) >= percent * np.maximum(sizes, sizes[p])))
        for other in apart.tolist():
            if forest.root(p) != forest.root(other) and similar(sets[p], sets[other], percent):
                forest.join(p, other)
                found.append((p, other))
                trees = None
    return found


# ---- groups of consecutive rows in sorted partitions ------------------------------


def consecutive(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows of one key are never parted; input is sorted by the keys."""
    held: list[pa.RecordBatch] = []

    def joined(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        cut = batch.num_rows
        change = _changes(batch, keys)
        first_differs = bool(held) and any(
            held[-1].column(k)[held[-1].num_rows - 1] != batch.column(k)[0] for k in keys)
        if first_differs:
            yield joined(held)
            held = []
        if len(change) > 1:
            cut = int(change[-1])
            yield joined([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield joined(held)


def _changes(batch: pa.RecordBatch, keys) -> np.ndarray:
    """Where the groups of a sorted batch begin."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        values = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


# ---- the steps --------------------------------------------------------------------


def sketches(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(_id, _mark, n, digest, sketch) of every (_id, _mark, _text); digest is null for empty sets."""

    def work(batches):
        for batch in batches:
            texts = batch.column("_text")
            for low, high in text_slices(texts):
                sets = shingle_sets(words_of(texts.slice(low, high - low), lower=True), width)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([
                    part.column("_id"), part.column("_mark"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()), pa.array([sketch(s).tobytes() for s in sets], pa.binary())],
                    ["_id", "_mark", "n", "digest", "sketch"])

    return docs.mapInArrow(
        gives_back(work), f"_id {dict(docs.dtypes)['_id']}, _mark int, n bigint, digest binary, sketch binary")


def listings(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, cls): every class under each of its keys."""

    def work(batches):
        for batch in batches:
            keys = [
                list_keys(np.frombuffer(s, np.uint32), n, percent)
                for s, n in zip(batch.column("sketch").to_pylist(), batch.column("n").to_pylist())]
            if keys:
                owner = np.repeat(batch.column("cls").to_numpy(), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(owner)], ["key", "cls"])

    return classes.select("cls", "n", "sketch").mapInArrow(gives_back(work), "key bigint, cls bigint")


def overlaps(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs within a list whose estimate may reach the threshold, as a forest in longer lists."""
    floor = least_estimate(percent, SKETCH)

    def work(batches):
        for batch in consecutive(batches, "key"):
            starts = _changes(batch, ("key",))
            sizes = np.diff(np.append(starts, batch.num_rows))
            cls = batch.column("cls").to_numpy()
            table, _ = padded(batch.column("sketch").to_pylist(), SKETCH)
            one, two = [], []
            for size in np.unique(sizes[sizes <= 8]).tolist():
                at = starts[sizes == size]
                i, j = np.triu_indices(size, 1)
                x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
                near = estimate(table[x], table[y], SKETCH) >= floor
                one.append(x[near])
                two.append(y[near])
            for at, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist()):
                apart, queue = np.arange(at, at + size), []
                while len(apart) or queue:  # breadth first; each member probes those not reached yet
                    if not queue:
                        queue, apart = [int(apart[0])], apart[1:]
                    probe = queue.pop()
                    near = estimate(np.repeat(table[probe][None], len(apart), 0), table[apart], SKETCH) >= floor
                    one.append(np.full(near.sum(), probe))
                    two.append(apart[near])
                    queue += apart[near].tolist()
                    apart = apart[~near]
            if one:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[np.concatenate(one)]), pa.array(cls[np.concatenate(two)])], ["a", "b"])

    return members.mapInArrow(gives_back(work), "a bigint, b bigint")


def confirm(members: DataFrame, percent: int, keys: list[str], width: int = SHINGLE) -> DataFrame:
    """(a, b): spanning forest of the exact links within each group of ``keys``.

    Rows are (keys, cls, tree, probe, _text); classes of one ``tree`` are known to be linked and
    only rows marked as probes are compared with the others.
    """

    def work(batches):
        for batch in consecutive(batches, *keys):
            starts = _changes(batch, keys).tolist()
            for low, high in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(low, high - low)
                classes, probe, tree = (part.column(c).to_pylist() for c in ("cls", "probe", "tree"))
                first: dict[int, int] = {}
                for i, c in enumerate(classes):
                    if c not in first or probe[i]:
                        first[c] = i
                picked = sorted(first.values())
                if len(picked) < 2:
                    continue
                sets = []
                texts = part.column("_text").take(pa.array(picked))
                for a, b in text_slices(texts):
                    sets += shingle_sets(words_of(texts.slice(a, b - a), lower=True), width)
                forest, seen = Forest(len(picked)), {}
                for i, row in enumerate(picked):
                    if tree[row] is not None:
                        forest.join(seen.setdefault(tree[row], i), i)
                links = linked([i for i, row in enumerate(picked) if probe[row]], sets, forest, percent)
                if links:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([classes[picked[i]] for i, _ in links], pa.int64()),
                        pa.array([classes[picked[j]] for _, j in links], pa.int64())], ["a", "b"])

    return members.mapInArrow(gives_back(work), "a bigint, b bigint")


def text_mark(text: Column) -> Column:
    """Tells rows that share an id apart."""
    return (F.xxhash64(text) % (1 << 31)).cast("int")


def drop_near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: the smallest id of each group.

    Rows that repeat this id in their group all stay (``exact_dedup.drop_copies`` leaves one of
    those with one text).
    """
    key, mark, gone_id, gone_mark = unused(docs, "_id", "_mark", "_gone_id", "_gone_mark")
    found = near_duplicates(docs, scratch, id_col, text_col, percent, width)
    gone = scratch.table(found.where("NOT kept").select(
        F.col("id").alias(gone_id), F.col("mark").alias(gone_mark)).distinct(), "gone")
    marked = docs.withColumns({key: named(id_col), mark: text_mark(named(text_col))})
    same = F.col(key).eqNullSafe(F.col(gone_id)) & F.col(mark).eqNullSafe(F.col(gone_mark))
    return marked.join(gone, same, "left_anti").select(*map(named, docs.columns))


def near_duplicates(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """(id, mark, n_shingles, component_id, kept) for every row; ``mark`` is a hash of the text.

    Two texts are linked when 100 * common shingles >= percent * all shingles of both, on distinct
    shingles of ``width`` words of the lower-cased text (A-Z). ``component_id`` is the smallest id reachable
    by links. Null and empty texts have no shingles and are linked with nothing. Rows with equal
    sets, repeated rows included, are linked. A null id is passed over as the smallest.
    """
    given = docs.select(
        F.col(id_col).alias("_id"), text_mark(F.col(text_col)).alias("_mark"),
        F.col(text_col).alias("_text"))
    sketched = scratch.table(sketches(given, width), "sketches")
    classes = scratch.table(
        sketched.where("n > 0").groupBy("digest").agg(
            F.min("_id").alias("least"), F.min(F.struct("_id", "_mark", "n", "sketch")).alias("r"))
        .select(F.monotonically_increasing_id().alias("cls"), "digest", "least", "r.*"), "classes")

    listed = listings(classes, percent)
    shared = scratch.table(listed.groupBy("key").agg(F.count("*").alias("size"), F.min("cls").alias("first"))
                           .where("size > 1"), "keys")
    members = scratch.table(listed.join(shared, "key"), "members")
    short = members.where(F.col("size") <= LIST).select("key", "cls").join(
        classes.select("cls", "sketch"), "cls")
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    near = overlaps(short.repartition(tasks, "key").sortWithinPartitions("key"), percent)
    long = members.where(F.col("size") > LIST).select(F.col("cls").alias("a"), F.col("first").alias("b"))
    cluster = scratch.table(components(near.unionByName(long), scratch, "candidates"), "clusters")
    scratch.drop("members")

    sizes = cluster.groupBy("component").agg(F.count("*").alias("size"))
    placed = cluster.join(sizes, "component").select(
        F.col("component").alias("cluster"), F.col("node").alias("cls"), "size",
        F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")).withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    ours = classes.select("cls", "_id", "_mark").join(placed, "cls")
    texts = scratch.table(given.join(
        ours, given["_id"].eqNullSafe(ours["_id"]) & given["_mark"].eqNullSafe(ours["_mark"])
    ).groupBy("cluster", "cls", "size", "blocks", "block").agg(F.min("_text").alias("_text")), "texts")  # repeated rows once
    head = (F.col("size") > BLOCK) & (F.pmod(F.xxhash64("cls", F.lit(1)), F.col("size")) < HEAD)
    meet = F.when(head, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = texts.select(
        "cluster", F.explode(meet).alias("at"), "cls", F.lit(None).cast("bigint").alias("tree"), F.lit(True).alias("probe"), "_text")
    keys = ["cluster", "at"]
    links = scratch.table(
        confirm(first.repartition(tasks, *keys).sortWithinPartitions(*keys), percent, keys, width), "links")

    # in clusters of several blocks: those outside the largest tree meet everyone
    parts = scratch.table(components(links, scratch, "first"), "trees")
    large = texts.where("blocks > 1")
    if not large.isEmpty():
        treed = large.join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
            "tree", F.coalesce("component", "cls"))
        by_tree = treed.groupBy("cluster", "tree").agg(F.countDistinct("cls").alias("m"))
        largest = by_tree.groupBy("cluster").agg(F.max(F.struct("m", "tree"))["tree"].alias("main"), F.sum("m").alias("whole"), F.max("m").alias("m"))
        treed = treed.join(largest.where("m < whole"), "cluster").withColumn(
            "chunks", F.ceil((F.col("whole") - F.col("m")) / (BLOCK // 2)).cast("int"))
        every = F.sequence(F.lit(0), F.col("chunks") - 1)
        others = treed.select("cluster", F.explode(every).alias("chunk"), F.col("block").alias("at"), "cls", "tree",
                              F.lit(False).alias("probe"), "_text")
        probes = treed.where("tree <> main").select(
            "cluster", F.pmod(F.xxhash64("cls", F.lit(2)), "chunks").cast("int").alias("chunk"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"), "cls", "tree",
            F.lit(True).alias("probe"), "_text")
        keys = ["cluster", "chunk", "at"]
        more = scratch.table(confirm(
            others.unionByName(probes).repartition(tasks, *keys).sortWithinPartitions(*keys), percent, keys, width), "more")
        known = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        parts = components(known.unionByName(more), scratch, "all")
    scratch.drop("texts")

    rooted = classes.select("digest", "cls", "least").join(parts.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "cls"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.table(rooted.join(least, "root").select("digest", "component_id"), "named")
    component = F.when(F.col("digest").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return sketched.select("_id", "_mark", "n", "digest").join(named, "digest", "left").select(
        F.col("_id").alias("id"), F.col("_mark").alias("mark"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), Scratch(spark, "near-dedup")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
