"""Spelling variants: words one edit apart, grouped under their more frequent forms.

Words are counted over all texts. Near words are then found by search schemes on an FM-index of
the vocabulary, in which every word stands between delimiters: of two words one edit apart, one
half is the same in both. So the first half of a word is matched exactly from its opening
delimiter on and extended to the right with one error allowed, and the second half is matched
exactly from its closing delimiter back and extended to the left with one error. Each direction
has its index; a search holds intervals of suffix ranks only, all searches of a block of words
step together.

A search that starts with an exact half can only meet words with the same first two letters (or
last three), so vocabulary and searches are dealt out by these letters, in groups of about
``BLOCK`` words, each with an index of its own. Letters that more words share than that are cut
into blocks of words and blocks of searches, and every pair of blocks is worked on, so that no
group outgrows a task. Each pair of near words is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import Scratch, documents
from shopstrata.llm.words import runs

LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2  # a form is at least so many times as frequent
FIRST, LAST = 2, 3  # letters that both words of a search share: least lengths of the halves of a word
BLOCK = 1 << 15  # words of an index
SEARCHES = 1 << 13  # words searched for at a time
COUNTED = 200_000  # distinct words a task holds before it hands on their counts

#: Letters a-z and U+00C0 to U+00FF, in UTF-8.
LETTERS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")


def word_counts(docs: DataFrame, id_col: str, text_col: str, least: int,
                altered: Callable[[str, dict[bytes, int]], dict[bytes, int]] | None) -> DataFrame:
    """(word, n) of the words with at least ``least`` letters, partial counts summed over all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            named = [(w.decode(), n) for w, n in total.items()]
            named = [(w, n) for w, n in named if len(w) >= least]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in named], pa.string()), pa.array([n for _, n in named], pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                if text.is_valid:
                    found = Counter(LETTERS.findall(text.as_py().lower()))
                    total.update(found if altered is None else altered(key.as_py() or "", found))
                if len(total) > COUNTED:
                    yield flush()
        yield flush()

    parts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return parts.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """FM-index of a set of distinct words, read in one direction.

    Every word is a circle of a delimiter (symbol 0) and its letters. Row r stands for the r-th
    of all places, ordered by what precedes them, read backwards; ``follows[r]`` is the symbol
    at that place. The rows whose places come after a given string are an interval; appending a
    symbol to the string maps the interval by counting that symbol in ``follows``.
    """

    def __init__(self, letters: np.ndarray, lengths: np.ndarray):
        sizes = lengths + 1
        start = np.cumsum(sizes) - sizes
        n = self.size = int(sizes.sum())
        self.words = len(lengths)
        symbols = np.zeros(n, np.int64)
        inner = np.ones(n, bool)
        inner[start] = False
        symbols[inner] = letters
        back = np.arange(n) - 1
        back[start] = start + lengths
        rank, kinds = symbols[back], 0
        while kinds < n:  # by twice as many preceding symbols each time, until no two places are equal
            kind, rank = np.unique(rank * (n + 1) + rank[back], return_inverse=True)
            kinds, back = len(kind), back[back]
        place = np.empty(n, np.int64)
        place[rank] = np.arange(n)
        self.follows = symbols[place]
        order = np.argsort(self.follows, kind="stable")
        self.counted = self.follows[order] * n + order
        self.word = np.searchsorted(start, place[:self.words], "right") - 1

    def append(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the strings of [low, high) with one more symbol each."""
        at = symbol * self.size
        return np.searchsorted(self.counted, at + low), np.searchsorted(self.counted, at + high)

    def following(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol) of every symbol that follows each interval's string."""
        owner = np.repeat(np.arange(len(low)), high - low)
        width = int(self.follows.max()) + 1
        kinds = np.unique(owner * width + self.follows[runs(low, high - low)])
        return kinds // width, kinds % width


def one_error(index: Index, letters: np.ndarray, begin: np.ndarray, lengths: np.ndarray,
              exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(search, word) for every indexed word one edit apart, or none, after ``exact`` equal letters.

    Search i is for ``letters[begin[i]:begin[i] + lengths[i]]``.
    """
    def wanted(search: np.ndarray, at: np.ndarray) -> np.ndarray:
        inside = at < lengths[search]
        return np.where(inside, letters[np.where(inside, begin[search] + at, 0)], 0)

    found_search, found_word = [], []

    def finish(search, at, low, high):
        """No error is left: the rest and the closing delimiter must match."""
        while len(search):
            ended = at == lengths[search]
            low, high = index.append(wanted(search, at), low, high)
            live = low < high
            hit = live & ended
            found_search.append(search[hit])
            found_word.append(index.word[low[hit]])
            live &= ~ended
            search, at, low, high = search[live], at[live] + 1, low[live], high[live]

    search = np.arange(len(lengths))
    low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), index.words)
    for step in range(int(exact.max(initial=0))):
        some = np.flatnonzero(exact > step)
        low[some], high[some] = index.append(letters[begin[some] + step], low[some], high[some])
    at = exact.copy()
    live = low < high
    search, at, low, high = search[live], at[live], low[live], high[live]
    while len(search):
        spans, span = np.unique(low * (index.size + 1) + high, return_inverse=True)
        span_low, span_high = spans // (index.size + 1), spans % (index.size + 1)
        owner, symbol = index.following(span_low, span_high)
        next_low, next_high = index.append(symbol, span_low[owner], span_high[owner])
        first = np.searchsorted(owner, np.arange(len(spans) + 1))
        many = np.diff(first)[span]
        state, child = np.repeat(np.arange(len(search)), many), runs(first[span], many)
        s, a, c = search[state], at[state], symbol[child]
        letter, inside = c > 0, a < lengths[s]
        same = inside & (c == wanted(s, a))
        shorter = at < lengths[search]
        replaced = letter & inside & ~same
        finish(  # a letter replaced, inserted, deleted
            np.r_[s[replaced], s[letter], search[shorter]], np.r_[a[replaced] + 1, a[letter], at[shorter] + 1],
            np.r_[next_low[child[replaced]], next_low[child[letter]], low[shorter]],
            np.r_[next_high[child[replaced]], next_high[child[letter]], high[shorter]])
        search, at, low, high = s[same], a[same] + 1, next_low[child[same]], next_high[child[same]]
    return np.concatenate(found_search or [search]), np.concatenate(found_word or [search])


def _letters(words: list[str], from_end: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words in reading direction, where each word begins, lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(lengths) - lengths
    if from_end:
        flat = flat[np.repeat(2 * begin + lengths - 1, lengths) - np.arange(len(flat))]
    return flat, begin, lengths


def near_words(rows: pa.Table) -> pa.Table:
    """(word, near, near_n) of a group: its searches against the index of its words."""
    held = rows.filter(rows["held"])
    sought = rows.filter(rows["sought"])["word"].to_pylist()
    texts, counts = held["word"].to_pylist(), held["n"].to_pylist()
    from_end = bool(rows["from_end"][0].as_py())
    out: list[tuple[str, str, int]] = []
    if texts and sought:
        letters, _, lengths = _letters(texts, from_end)
        alphabet = np.unique(letters)
        index = Index(np.searchsorted(alphabet, letters) + 1, lengths)
        for low in range(0, len(sought), SEARCHES):
            words = sought[low:low + SEARCHES]
            letters, begin, lengths = _letters(words, from_end)
            at = np.minimum(np.searchsorted(alphabet, letters), len(alphabet) - 1)
            known = np.where(alphabet[at] == letters, at + 1, len(alphabet) + 1)
            half = lengths // 2
            hits = one_error(index, known, begin, lengths, lengths - half if from_end else half)
            for i, k in sorted(set(zip(*(h.tolist() for h in hits)))):
                word, other = words[i], texts[k]
                # what the other direction finds as well is left to it
                if word != other and not (from_end and other.startswith(word[:len(word) // 2])):
                    out.append((word, other, counts[k]))
    names, others, numbers = zip(*out) if out else ((), (), ())
    return pa.table([pa.array(names, pa.string()), pa.array(others, pa.string()), pa.array(numbers, pa.int64())],
                    ["word", "near", "near_n"])


def near_pairs(words: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) for both directions of each pair of words one edit apart.

    ``words`` has distinct (word, n), words of at least ``FIRST + LAST`` letters.
    """
    total = words.count()
    sides = F.explode(F.array(
        F.struct(F.lit(False).alias("from_end"), F.substring("word", 1, FIRST).alias("shared")),
        F.struct(F.lit(True).alias("from_end"), F.expr(f"right(word, {LAST})").alias("shared"))))
    dealt = words.select("word", "n", sides.alias("s")).select("word", "n", "s.*")
    large = scratch.table(
        dealt.groupBy("from_end", "shared").agg(F.count("*").alias("rows")).where(F.col("rows") > block)
        .select("from_end", "shared", F.ceil(F.col("rows") / block).cast("int").alias("parts")), "large")
    parted = dealt.join(large, ["from_end", "shared"], "left")
    yes, every = F.lit(True), F.sequence(F.lit(0), F.col("parts") - 1)
    small = parted.where("parts is null").select(
        "word", "n", "from_end", yes.alias("held"), yes.alias("sought"),
        F.pmod(F.xxhash64("from_end", "shared"), F.lit(1 + 2 * total // block)).cast("string").alias("group"))
    mine = F.pmod(F.xxhash64("word"), F.col("parts"))
    place = lambda i, j: F.concat_ws(" ", "shared", i, j)
    cut = parted.where("parts is not null").select("*", mine.alias("mine"), F.explode(every).alias("other"))
    cut = cut.select("word", "n", "from_end", F.explode(F.array(
        F.struct(yes.alias("held"), F.lit(False).alias("sought"), place("mine", "other").alias("group")),
        F.struct(F.lit(False).alias("held"), yes.alias("sought"), place("other", "mine").alias("group")))).alias("p")
    ).select("word", "n", "from_end", "p.*")
    return small.unionByName(cut).groupBy("from_end", "group").applyInArrow(
        near_words, "word string, near string, near_n long")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): the last of the forms that follow each other. Counts grow, so none recurs.

    Each step doubles the distance that a word looks ahead.
    """
    now, step = scratch.table(forms.select("word", F.col("form").alias("root")), "root-0"), 0
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step += 1
        moved = scratch.table(moved, f"root-{step}")
        now = moved.select("word", "root")
        scratch.drop(f"root-{step - 1}")
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
             least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO, block: int = BLOCK,
             altered: Callable[[str, dict[bytes, int]], dict[bytes, int]] | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least
    ``least_letters`` code points and ``least_count`` occurrences ``n`` in all texts. Words are
    near if one inserted, deleted or replaced code point makes one the other. A word's form is
    its near word of largest n (of equals the first in code-point order) if that n is at least
    ``ratio`` times its own, else null; its root is where the forms lead in the end, itself if
    it has none. Null and empty texts have no words, an empty table gives an empty result, repeated
    rows count as often as they stand there, other columns are not looked at. ``altered`` may
    change the words of a document: given its id as text (null: empty) and the counts of its
    words in UTF-8, it returns other counts.
    """
    if least_letters < FIRST + LAST or ratio < 2:
        raise ValueError("words have five letters at least, forms twice the count")
    counted = word_counts(docs, id_col, text_col, least_letters, altered)
    words = scratch.table(counted.where(F.col("n") >= least_count), "words")
    best = scratch.table(near_pairs(words, scratch, block).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")), "best")
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    judged = scratch.table(judged.select(
        "word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")), "judged")
    ends = roots(judged.where("form is not null"), scratch)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def slips_by_id(key: str, found: dict[bytes, int]) -> dict[bytes, int]:
    """One word in 97 of a document, by a checksum of id and word, loses a letter."""
    lead, out = zlib.crc32(key.encode() + b":"), Counter()
    for word, n in found.items():
        check = zlib.crc32(word, lead)
        if check % 97 == 0:
            text = word.decode()
            at = check % len(text)
            word = (text[:at] + text[at + 1:]).encode()
        out[word] += n
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir), Scratch(spark, "spelling"), altered=slips_by_id)
