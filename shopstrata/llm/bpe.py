"""Byte-pair encoding by a deterministic automaton, and decoding by its arc labels.

Merges are read as gadgets in the order of their ranks. The gadget of (u, v) -> w takes away
the arc v after u and adds the arc w wherever u could be followed by v; w is then followed by
what may follow v. Whether an arc survives all later gadgets is found by undoing them, newest
first (``Merges.follows``). A text has one path of surviving arcs, its encoding.

``Automaton`` turns that into transitions on bytes: a state holds, for each place where a token
could still begin, the place in the token trie and the arc that ends there. States are compiled
when they are first met and kept in a table; from then on a byte is one table lookup. Each state
is labelled with the last arc of the prefix read so far, so the path is read off backwards.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.scratch import documents, gives_back, short_batches
from shopstrata.llm.words import text_slices

VOCABULARY = "byte_bpe_50k.json"
#: Fixed value: how byte-level vocabularies of this family split text.
SPLIT = regex.compile(public_tokenizers.PATTERN)
MARKS = set(".,;:!?")  # end a word of their own after letters
STATES = 200_000  # states kept by a worker before its table starts anew
WORDS = 100_000  # words, and chunks, in each of the two generations of a worker's caches


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Merges:
    """Tokens with the merge that made them, and which tokens may stand side by side."""

    def __init__(self, vocabulary: str):
        given = json.loads(vocabulary)
        model, to_byte = given["model"], byte_characters()
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        ids = model["vocab"]
        self.texts: dict[int, bytes] = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()}
        self.texts |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.born = {i: -1 for i in self.texts}
        self.halves: dict[int, tuple[int, int]] = {}
        for n, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (ids[left], ids[right]), ids[left + right]
            if made in self.halves:
                raise ValueError(f"two merges make {left + right!r}")
            self.rank[pair], self.born[made], self.halves[made] = n, n, pair
        self.tokens = [i for i in ids.values() if i not in self.special.values()]

    def follows(self, left: int, right: int) -> bool:
        """Whether no merge would join something across the seam of two tokens."""
        bound = len(self.rank)
        while True:
            if self.rank.get((left, right), bound) < bound:
                return False
            a, b = self.born[left], self.born[right]
            if a > b:
                bound, left = a, self.halves[left][1]
            elif b >= 0:  # of equal merges the one further left, across the seam, comes first
                bound, right = b + 1, self.halves[right][0]
            else:
                return True

    def reached(self, token: int) -> bool:
        """Whether the token's own text is encoded as this token."""
        if token not in self.halves:
            return len(self.texts[token]) == 1
        left, right = self.halves[token]
        rank = self.rank.pop((left, right))
        try:
            return self.follows(left, right)
        finally:
            self.rank[left, right] = rank


class Automaton:
    def __init__(self, merges: Merges):
        self.merges = merges
        self.trie: dict[int, int] = {}  # (node, byte) to node
        self.inner = bytearray(1)  # whether a node has nodes below
        self.token_at: dict[int, int] = {}
        for token in merges.tokens:
            if not merges.reached(token):
                continue
            node = 0
            for byte in merges.texts[token]:
                self.inner[node] = 1
                node = self.trie.setdefault(node << 8 | byte, len(self.inner))
                if node == len(self.inner):
                    self.inner.append(0)
            self.token_at[node] = token
        self.arcs = {t: (t.to_bytes(4, "little"), len(merges.texts[t])) for t in merges.tokens}
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None
        self.words = _Cache(lambda word: self.path(word.encode()))
        self.chunks = _Cache(self._chunk)
        self.restart()

    def restart(self) -> None:
        # a state's places, each node << 32 | token before it + 1, as packed integers
        self.states = [_pack([0])]
        self.numbers = {self.states[0]: 0}
        self.labels = [(b"", 0)]
        self.table = _Transitions(self)
        self.words.clear()
        self.chunks.clear()

    def compile(self, state: int, byte: int) -> int:
        label, places = None, []
        for place in memoryview(self.states[state]).cast("q"):
            node, before = self.trie.get(place >> 32 << 8 | byte), (place & 0xFFFFFFFF) - 1
            if node is None:
                continue
            token = self.token_at.get(node)
            if label is None and token is not None and (before < 0 or self.merges.follows(before, token)):
                label = token
            if self.inner[node]:
                places.append(node << 32 | before + 1)
        if label is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        key = _pack([*places, label + 1])
        number = self.numbers.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
            self.labels.append(self.arcs[label])
        return number

    def path(self, word: bytes) -> bytes:
        """Ids of one pre-split word, as little-endian 32-bit integers."""
        table, labels, state, passed = self.table, self.labels, 0, []
        for byte in word:
            state = table[state << 8 | byte]
            passed.append(state)
        ids, at = [], len(word)
        while at:
            token, length = labels[passed[at - 1]]
            ids.append(token)
            at -= length
        ids.reverse()
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.states) > STATES:
            self.restart()
        self.words.age()
        self.chunks.age()
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += [self._plain(text[at:found.start()]), self.merges.special[found[0]].to_bytes(4, "little")]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        """A single space between two words starts the second, so most texts split at spaces and
        need the pattern for unseen chunks only; any other white space at a seam needs it for the whole text."""
        first, *others = text.split(" ")
        try:
            if first[-1:].isspace():
                raise _Seam
            head = [self.words[w] for w in SPLIT.findall(first)]
            chunks = self.chunks
            return b"".join([*head, *[chunks[c] for c in others]])
        except _Seam:
            words = self.words
            return b"".join([words[w] for w in SPLIT.findall(text)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():  # letters alone: one word, kept as this chunk
            return self.path(b" " + chunk.encode())
        if chunk[-1:] in MARKS and chunk[:-1].isalpha():
            return self.chunks[chunk[:-1]] + self.words[chunk[-1]]
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Seam
        words = self.words
        return b"".join([words[w] for w in SPLIT.findall(" " + chunk)])


class Labels:
    """Texts of the tokens, for decoding: the concatenated arc labels of a path."""

    def __init__(self, merges: Merges):
        self.texts = [merges.texts.get(i, b"") for i in range(max(merges.texts) + 1)]

    def decode(self, ids: bytes) -> str:
        """Bytes that are no UTF-8 come out as U+FFFD."""
        return b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _pack(places: list[int]) -> bytes:
    return array("q", places).tobytes()


class _Transitions(dict):
    """(state, byte) to state; those not met before are compiled."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, key: int) -> int:
        self[key] = made = self.automaton.compile(key >> 8, key & 255)
        return made


class _Seam(Exception):
    """White space next to a space: the text can't be split there."""


class _Cache(dict):
    """Results by string in two generations; long strings are not kept."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) < 64:
            self[key] = found
        return found

    def clear(self) -> None:
        super().clear()
        self.old = {}

    def age(self) -> None:
        if len(self) > WORDS:
            self.old = dict(self)
            super().clear()


@lru_cache(2)
def _automaton(vocabulary: str) -> Automaton:
    return Automaton(Merges(vocabulary))


@lru_cache(2)
def _labels(vocabulary: str) -> Labels:
    return Labels(Merges(vocabulary))


def _batches(batches, column: str, made: str, kind: pa.DataType, work):
    for batch in batches:
        values = batch.column(column)
        rest = batch.drop_columns([column])
        for low, high in text_slices(values):
            part = rest.slice(low, high - low)
            out = pa.array([work(v.as_py()) for v in values.slice(low, high - low)], kind)
            yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, made])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) with the ids of each whole text as little-endian 32-bit integers.

    Null and empty texts give no ids. Special tokens of the vocabulary are recognised inside
    texts; none are added. Other columns are left out; repeated rows stay.
    """
    short_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(path).read_text())  # a fixed file of about 1 MB

    def work(batches):
        automaton = _automaton(vocabulary.value)
        try:
            yield from _batches(batches, "_text", "ids", pa.binary(), lambda t: automaton.encode(t or ""))
        finally:  # the worker may go on to other work
            automaton.restart()

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    return given.mapInArrow(gives_back(work), f"id {dict(docs.dtypes)[id_col]}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, ids, text) from (id, ids); null ids give an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Path(path).read_text())

    def work(batches):
        labels = _labels(vocabulary.value)
        yield from _batches(batches, "_ids", "text", pa.string(), lambda ids: labels.decode(ids or b""))

    given = encoded.select("id", "ids", F.col("ids").alias("_ids"))
    return given.mapInArrow(gives_back(work), f"id {dict(encoded.dtypes)['id']}, ids binary, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, text): what ``decode`` makes of ``encode``, in one pass and one worker for each task."""
    short_batches(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(path).read_text())

    def work(batches):
        automaton, labels = _automaton(vocabulary.value), _labels(vocabulary.value)
        try:
            for encoded in _batches(batches, "_text", "ids", pa.binary(), lambda t: automaton.encode(t or "")):
                texts = [labels.decode(ids) for ids in encoded.column("ids").to_pylist()]
                yield encoded.append_column("text", pa.array(texts, pa.string()))
        finally:  # the worker may go on to other work
            automaton.restart()

    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    return given.mapInArrow(gives_back(work), f"id {dict(docs.dtypes)[id_col]}, ids binary, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    read = round_trip(docs, path)
    return read.select(
        F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
