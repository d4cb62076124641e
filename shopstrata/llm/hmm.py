"""A hidden Markov language model trained by Baum-Welch over all training documents.

Tokens are lower-cased words and one end per document. The ``OWN`` most frequent tokens are
symbols of their own; every other token has one of ``SHAPES`` symbols by a hash of its first
three bytes, and within a symbol its probability is (c + 0.5) / (C + 0.5 * (V + 1)) from
exact corpus counts, with one share of 0.5 for tokens never seen. States emit symbols, so the
model is a table of bounded size while counts of all tokens stay in a distributed table.

Counts, expectations and scores cover every document in full. Training starts from the
unigram distribution, perturbed alike in every run; each of its rounds reads all training
documents, and it ends when a round has gained little.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch, documents, short_batches
from shopstrata.llm.toxicity import remainder
from shopstrata.llm.words import hash_words, text_slices, words_of

STATES = 8
OWN = 8192
SHAPES = 2048
SYMBOLS = 1 + OWN + SHAPES  # 0 is the end
FREQUENT = 65_536  # most tokens whose counts are broadcast; the others are joined
ROUNDS = 14  # of Baum-Welch over all training documents, at most
GAIN = 1e-3  # of log-likelihood a token and round; below it training ends
GROUP_TOKENS = 1_200_000  # worked on together
FOLDS, HELD = 5, 1
END = 0x0E4D


# ---- the chain itself, on arrays -------------------------------------------------


class Chain:
    """Start, transition and emission probabilities of a number of states."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (K,), (K, K), (symbols, K)


class Columns:
    """Sequences laid out by position, longest first, so each step is one slice."""

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray):
        lengths = np.diff(offsets)
        self.order = np.argsort(-lengths, kind="stable")
        sizes = lengths[self.order]
        self.active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")
        self.base = np.concatenate([[0], np.cumsum(self.active)])
        rank = np.repeat(np.arange(len(sizes)), sizes)
        step = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.symbols = np.empty(len(rank), symbols.dtype)
        self.symbols[self.base[step] + rank] = symbols[np.repeat(offsets[:-1][self.order], sizes) + step]

    def steps(self):
        return zip(self.base[:-1].tolist(), self.base[1:].tolist(), self.active.tolist())


def forward(columns: Columns, chain: Chain, keep: bool = False):
    """Natural log-likelihood of each sequence, by the scaled forward recursion.

    With ``keep`` also scaled forward vectors, emissions (a row for each state) and scales by position.
    """
    emitted = np.stack([of_state[columns.symbols] for of_state in chain.emit.T.copy()])
    vectors = emitted.copy() if keep else emitted
    total = np.zeros(len(columns.order))
    scales = np.empty(emitted.shape[1], emitted.dtype)
    onward, a = chain.move.T.copy(), None
    for low, high, m in columns.steps():
        now = vectors[:, low:high]
        now *= chain.start[:, None] if a is None else onward @ a[:, :m]
        scale = now.sum(0, out=scales[low:high])
        now /= scale
        a = now
    if len(scales):
        logs = np.log(scales.astype(np.float64))
        rank = np.arange(len(scales)) - np.repeat(columns.base[:-1], columns.active)
        total = np.bincount(rank, logs, len(columns.order))
    out = np.empty_like(total)
    out[columns.order] = total
    return (out, vectors, emitted, scales) if keep else out


def expectations(columns: Columns, chain: Chain):
    """Expected start, transition and emission counts of the sequences, and their log-likelihood."""
    logs, gamma, emitted, scales = forward(columns, chain, keep=True)
    emitted /= scales
    k = len(chain.start)
    moved = np.zeros((k, k))
    beta = np.ones((k, len(columns.order)), gamma.dtype)
    steps = list(columns.steps())
    for t in range(len(steps) - 1, -1, -1):
        low, high, m = steps[t]
        if t + 1 < len(steps):
            after, until, n = steps[t + 1]
            b = emitted[:, after:until]
            b *= beta[:, :n]
            moved += gamma[:, low:low + n] @ b.T
            beta[:, :n] = chain.move @ b
        gamma[:, low:high] *= beta[:, :m]
    first = gamma[:, :len(columns.order)].sum(1)
    counts = np.stack([np.bincount(columns.symbols, of_state, SYMBOLS) for of_state in gamma], 1)
    return first.astype(float), moved * chain.move, counts, logs.sum()


def maximise(first, moved, counts, unigram) -> Chain:
    """Probabilities from expected counts, smoothed by small shares of the unigram distribution."""
    start = first + 1.0
    move = moved + 1.0
    emit = counts + 20.0 * unigram[:, None]
    return Chain(
        (start / start.sum()).astype(np.float32), (move / move.sum(1, keepdims=True)).astype(np.float32),
        (emit / emit.sum(0)).astype(np.float32))


def groups(symbols: list[np.ndarray]):
    """(numbers of the sequences, columns) of sequences of like length, about GROUP_TOKENS together."""
    lengths = np.array([len(s) for s in symbols])
    order = np.argsort(lengths, kind="stable")
    filled = np.cumsum(lengths[order]) // GROUP_TOKENS
    for part in np.split(order, np.flatnonzero(np.diff(filled)) + 1):
        if len(part):
            offsets = np.concatenate([[0], np.cumsum(lengths[part])])
            yield part, Columns(np.concatenate([symbols[i] for i in part]), offsets)


def beginning(unigram: np.ndarray) -> Chain:
    """The chain before training: sticky states that emit differently perturbed unigrams."""
    rng = np.random.default_rng(7)
    emit = unigram[:, None] * rng.gamma(1.0, 1.0, (SYMBOLS, STATES)) + 1e-9
    move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
    return maximise(np.ones(STATES), 50.0 * move, emit / emit.sum(0) * 100.0, unigram)


# ---- over tables ------------------------------------------------------------------


def token_hashes(texts: pa.Array):
    """(words, hash of each word, shape of each word)."""
    words = words_of(texts, lower=True)
    starts = words._replace(ends=np.minimum(words.ends, words.starts + 3))
    shape = (hash_words(starts, seed=5) >> np.uint64(64 - 11)).astype(np.int64) % SHAPES
    return words, hash_words(words).view(np.int64), shape


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, where one of each is, and how many there are."""
    order = np.argsort(values)
    in_order = values[order]
    first = np.flatnonzero(np.r_[len(values) > 0, in_order[1:] != in_order[:-1]])
    return in_order[first], order[first], np.diff(np.append(first, len(values)))


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, shape, n): exact counts of all tokens; ends are the token ``END`` with shape -1."""

    def work(batches):
        for batch in batches:
            texts = batch.column("_text")
            for low, high in text_slices(texts, 16 << 20):
                _, hashes, shape = token_hashes(texts.slice(low, high - low))
                tokens, first, n = counted(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(tokens, END)), pa.array(np.append(shape[first], -1).astype(np.int32)),
                     pa.array(np.append(n, high - low))], ["token", "shape", "n"])

    parts = docs.select(F.col(text_col).alias("_text")).mapInArrow(work, "token bigint, shape int, n bigint")
    return parts.groupBy("token", "shape").agg(F.sum("n").alias("n"))


def smallest(rows: DataFrame, key: Column, most: int, bins: int = 4096, few: int = 10_000) -> tuple[int, int] | None:
    """(value, rest): rows with a smaller key and ``rest`` of those with this value are ``most``.

    ``key`` is an integer column. Each step counts the rows of at most ``bins`` ranges and goes on
    inside the one where the sum passes ``most``, until it holds ``few`` rows or one value.
    None if there are not more rows than ``most``.
    """
    keyed = rows.select(key.cast("decimal(20,0)").alias("k"))
    low, high, count = keyed.agg(F.min("k"), F.max("k"), F.count("*")).first()
    if count <= most:
        return None
    low, high, rest = int(low), int(high), most
    while low < high and count > few:
        width = (high - low) // bins + 1
        place = F.expr(f"(k - {low}BD) div {width}BD").alias("place")
        sizes = keyed.where(F.col("k").between(low, high)).groupBy(place).count().collect()
        for number, count in sorted(map(tuple, sizes)):
            if count > rest:
                break
            rest -= count
        low = low + number * width
        high = min(high, low + width - 1)
    if low == high:
        return low, rest
    left = sorted(int(r.k) for r in keyed.where(F.col("k").between(low, high)).collect())
    return left[rest], rest - left.index(left[rest])


def frequent(counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The ``most`` most frequent tokens, all if there are not more; of equal counts the smaller tokens.

    A histogram of at most 512 bins finds the counts among which the last ones are, and only
    inside that bin the least count, then the last token that has it, are looked for.
    """
    place = F.floor(F.log2("n") * 8).cast("int").alias("place")
    bins = counts.groupBy(place).agg(F.count("*"), F.min("n"), F.max("n")).collect()
    rest = most
    for _, size, low, high in sorted(map(tuple, bins), reverse=True):
        if size > rest:
            break
        rest -= size
    else:
        return counts
    least = low
    if low < high:
        edge, rest = smallest(counts.where(F.col("n").between(low, high)), -F.col("n"), rest)
        least = -edge
    last = smallest(counts.where(F.col("n") == least), F.col("token"), rest)
    first = F.lit(True) if last is None else F.col("token") < last[0]
    return counts.where((F.col("n") > least) | ((F.col("n") == least) & first))


class Lexicon:
    """What every task needs to know of the vocabulary; its size does not depend on the corpus."""

    def __init__(self, counts: DataFrame):
        whole = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"),
            F.coalesce(F.sum(F.when(F.col("shape") < 0, F.col("n"))), F.lit(0)).alias("ends")).first()
        top = frequent(counts.where("shape >= 0")).toPandas()
        top = top.sort_values(["n", "token"], ascending=[False, True], ignore_index=True)
        self.total, self.distinct, self.ends = int(whole.n), int(whole.v), int(whole.ends)
        symbol = np.where(np.arange(len(top)) < OWN, 1 + np.arange(len(top)), 1 + OWN + top["shape"].to_numpy())
        order = np.argsort(top["token"].to_numpy(), kind="stable")
        self.tokens = top["token"].to_numpy(np.int64)[order]
        self.counts = top["n"].to_numpy(np.float64)[order]
        self.symbols = symbol.astype(np.uint16)[order]
        # totals of the shapes without the tokens that are symbols of their own
        sums = counts.where("shape >= 0").groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
        size, kinds = np.zeros(SHAPES), np.zeros(SHAPES)
        size[sums["shape"]], kinds[sums["shape"]] = sums["n"], sums["v"]
        own = top[:OWN]
        size -= np.bincount(own["shape"], own["n"], SHAPES)
        kinds -= np.bincount(own["shape"], minlength=SHAPES)
        self.share = np.ones(SYMBOLS)  # divisor inside a symbol
        self.share[1 + OWN:] = size + 0.5 * (kinds + 1)
        unigram = np.zeros(SYMBOLS)
        unigram[0], unigram[1 + OWN:] = self.ends, size
        unigram[1:1 + len(own)] = own["n"]
        self.unigram = (unigram + 0.5) / (unigram + 0.5).sum()

    @property
    def divisor(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)


def encode(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Symbols, rare tokens and the sums over frequent tokens of each (id, held_out, _text, _row)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # about 1.5 MB at any size
    kept = ["_row", "id", "held_out"]

    def work(batches):
        lex = shared.value
        for batch in batches:
            texts = batch.column("_text")
            for low, high in text_slices(texts):
                words, hashes, shape = token_hashes(texts.slice(low, high - low))
                symbols, logs = (1 + OWN + shape).astype(np.uint16), np.zeros(len(hashes))
                rare = np.ones(len(hashes), bool)
                if len(lex.tokens):
                    at = np.minimum(np.searchsorted(lex.tokens, hashes), len(lex.tokens) - 1)
                    rare = lex.tokens[at] != hashes
                    symbols = np.where(rare, symbols, lex.symbols[at])
                    logs = np.where(rare, 0.0, np.log10(lex.counts[at] + 0.5))
                n, owner = high - low, words.owner()
                apart = (symbols <= OWN)  # a symbol of its own needs no count within it
                sums = np.bincount(owner, logs, n)
                inner = np.bincount(owner[~apart], logs[~apart], n)
                everything = np.insert(symbols, words.docs[1:], 0)
                cuts = words.docs + np.arange(n + 1)
                rest = batch.slice(low, n)
                per_doc = np.concatenate([[0], np.cumsum(np.bincount(owner[rare], minlength=n))])
                yield pa.RecordBatch.from_arrays([
                    *[rest.column(c) for c in kept], pa.array(np.diff(words.docs) + 1),
                    pa.array(np.bincount(owner[~rare], minlength=n) + (1 if lex.ends else 0)),
                    pa.array(sums + np.log10(lex.ends + 0.5)), pa.array(inner.astype(float)),
                    pa.array([everything[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(per_doc.astype(np.int32)), pa.array(hashes[rare])),
                ], [*kept, "n_tokens", "n_known", "base_log", "inner_log", "symbols", "rare"])

    return docs.mapInArrow(work, (
        f"_row bigint, id {dict(docs.dtypes)['id']}, held_out boolean, n_tokens bigint, n_known bigint, base_log double, inner_log double, "
        "symbols binary, rare array<bigint>"))


def _symbols(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(s, np.uint16) for s in batch.column("symbols").to_pylist()]


def baum_welch(encoded: DataFrame, chain: Chain, unigram: np.ndarray) -> tuple[Chain, float]:
    """One round over every training document, summed over all partitions.

    The chain of the expected counts, and the log-likelihood under the chain given.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(chain)
    names = [f"s{i}" for i in range(STATES)]

    def work(batches):
        first, moved, counts = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((SYMBOLS, STATES))
        logs = np.zeros(STATES)
        for batch in batches:
            for _, columns in groups(_symbols(batch)):
                found = expectations(columns, shared.value)
                first, moved, counts = first + found[0], moved + found[1], counts + found[2]
                logs[0] += found[3]
        used = np.flatnonzero(counts.any(1))
        rows = np.concatenate([logs[None], first[None], moved, counts[used]])
        ids = np.concatenate([np.arange(-2 - STATES, 0), used])
        yield pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(rows[:, i]) for i in range(STATES)]], ["id", *names])

    parts = encoded.select("symbols").mapInArrow(work, "id bigint, " + ", ".join(f"{n} double" for n in names))
    summed = parts.groupBy("id").agg(*[F.sum(n).alias(n) for n in names]).toPandas()  # SYMBOLS rows at most
    shared.unpersist()
    table = np.zeros((2 + STATES + SYMBOLS, STATES))
    table[summed["id"].to_numpy() + 2 + STATES] = summed[names].to_numpy()
    return maximise(table[1], table[2:2 + STATES], table[2 + STATES:], unigram), float(table[0, 0])


def trained(encoded: DataFrame, lexicon: Lexicon) -> Chain:
    """Rounds of Baum-Welch until one gains less than ``GAIN`` a token, ``ROUNDS`` at most."""
    chain, before = beginning(lexicon.unigram), -np.inf
    for _ in range(ROUNDS):
        chain, found = baum_welch(encoded, chain, lexicon.unigram)
        if found - before < GAIN * lexicon.total:
            break
        before = found
    return chain


def likelihoods(encoded: DataFrame, chain: Chain, lexicon: Lexicon) -> DataFrame:
    """(_row, path_log): log10 of the exact probability of each symbol sequence, inner divisors included."""
    exact = Chain(*[x.astype(np.float64) for x in (chain.start, chain.move, chain.emit / lexicon.share[:, None])])
    shared = encoded.sparkSession.sparkContext.broadcast(exact)

    def work(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for part, columns in groups(_symbols(batch)):
                out[part] = forward(columns, shared.value) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out)], ["_row", "path_log"])

    return encoded.select("_row", "symbols").mapInArrow(work, "_row bigint, path_log double")


def score(docs: DataFrame, held_out, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Null and empty texts are one end. Without training rows every token has the share of an
    unseen one. Rows that repeat are documents of their own.
    """
    given = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("_text"))
    short_batches(docs.sparkSession, 10_000)  # sequences of like length are worked on together
    counts = scratch.table(count_tokens(given.where("NOT held_out"), "_text"), "counts")
    lexicon = Lexicon(counts)
    encoded = scratch.table(encode(given.withColumn("_row", F.monotonically_increasing_id()), lexicon), "encoded")
    chain = trained(encoded.where("NOT held_out"), lexicon)

    paths = likelihoods(encoded, chain, lexicon)
    rare = encoded.select("_row", F.explode("rare").alias("token")).join(
        counts.where("shape >= 0").select("token", "n"), "token", "left")
    rare = rare.groupBy("_row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_log"), F.count("n").alias("rare_known"))
    whole = encoded.drop("symbols", "rare").join(paths, "_row").join(rare, "_row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return whole.select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("base_log") + rare_log - F.col("n_tokens") * float(np.log10(lexicon.divisor))).alias("base_score"),
        (F.col("path_log") + F.col("inner_log") + rare_log).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = remainder(F.col("doc_id"), FOLDS) == HELD
    return score(documents(spark, sf_dir), held, Scratch(spark, "hmm")).withColumnRenamed("id", "doc_id")
