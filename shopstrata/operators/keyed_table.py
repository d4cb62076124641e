"""A table with upsert by key and a row-level change feed, on plain parquet.

Layout below ``path``:

* ``changes/_commit_version=<n>/``  what upsert ``n`` did, row by row. Appended only.
* ``snapshots/v=<n>-b<buckets>/``   all rows as of commit ``n``, bucketed by key.

The table is the newest snapshot plus the commits after it. An upsert writes only
the rows it touches; the snapshot is rewritten once the commits after it have grown
past a share of it, so the total written stays proportional to the data received.

The snapshot is a Spark bucketed table: finding the old rows of a batch and folding
commits into the snapshot shuffle the small side only, never the table. Files carry Bloom
filters on the key columns and short pages, so that a batch of few keys, or of keys from few
ranges, reads few rows.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BooleanType, DateType, IntegralType, NumericType, StructType, TimestampType

from shopstrata import storage
from shopstrata.functions.columns import named
from shopstrata.operators.commit_log import CODEC, CommitLog
from shopstrata.operators.latest import any_null, latest_per_key, precedence
from shopstrata.operators.names import NamedView, columns_sql, quoted
from shopstrata.operators.snapshots import with_columns_of
from shopstrata.operators.zorder import z_order
from shopstrata.session import shuffles_freed

CHANGE, VERSION, STAMP = "_change_type", "_commit_version", "_commit_timestamp"
FEED_COLUMNS = (CHANGE, VERSION, STAMP)
INSERT, BEFORE, AFTER = "insert", "update_preimage", "update_postimage"

MAX_BUCKETS = 100_000  # Spark's own default ceiling
HASH_BUILD_BYTES = 64 << 20  # most bytes of a batch's keys per bucket, as rows in memory, for a hash join
HELD = 3  # how often a task that folds a bucket holds its rows: both sides of a join, and the sort for the writer
FEW_KEYS = 200  # most values of a key column that are handed to the scan as a list
RANGES = 64  # most ranges of the first key that are handed to the scan
SLICES = 4  # most slices of the keys in which a batch is compared with commits
SLICE_BYTES = 32 << 20  # stored bytes of batch and commits per slice; smaller ones are not cut further
PAGE_ROWS = 1000  # most rows of a page, the least that a filter skips

MATCH, LAYOUT = "_match", "_layout"  # stored in snapshots beside the columns of the table

KEEP_RULES = ("incoming", "greatest", "existing")


@dataclass(frozen=True)
class Snapshot:
    version: int
    buckets: int
    path: str


class KeyedTable:
    """``keep`` says who wins when a key is already in the table.

    ``incoming`` (a plain merge), ``greatest`` (the greater of both by ``order_by``,
    so the result does not depend on arrival order) or ``existing`` (first arrival
    stays). Rows with a null in their key match nothing and are all kept, unless
    ``match_null_keys``: then nulls are equal, and rows are matched and bucketed by a text in
    which a null key is written out. Several rows of one key in one batch are reduced to the
    greatest by ``order_by`` first. ``sort_by`` orders rows inside each bucket file,
    so filters on those columns skip row groups and pages; ``cluster_by`` orders them by the
    interleaved bits of several columns instead, so filters on any of these skip. A snapshot
    is due when the commits after the last one exceed both ``settle_bytes`` and
    ``settle_share`` of its size; the first one waits for a second commit, unless ``settle_bytes`` is 0. A snapshot has buckets enough that a task that folds one of them holds
    about ``bucket_bytes`` at most, counted as rows in memory: columns that compress well are small on disk only.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        keep: str = "incoming",
        match_null_keys: bool = False,
        sort_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        bucket_bytes: int = 256 << 20,
        settle_share: float = 0.25,
        settle_bytes: int = 64 << 20,
    ):
        if keep not in KEEP_RULES:
            raise ValueError(f"keep must be one of {KEEP_RULES}, not {keep!r}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.order_by = tuple(order_by)
        self.keep = keep
        self.match_null_keys = match_null_keys
        self.sort_by = tuple(sort_by) or self.keys
        self.cluster_by = tuple(cluster_by)
        self.matched_by = (MATCH,) if match_null_keys else self.keys
        self.bucket_bytes = bucket_bytes
        self.settle_share = settle_share
        self.settle_bytes = settle_bytes
        self.log = CommitLog(spark, f"{self.path}/changes", VERSION)

    # ---- reading -----------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.log.numbers())

    def schema(self) -> StructType:
        return StructType([f for f in self.log.schema() if f.name not in FEED_COLUMNS])

    def read(self) -> DataFrame:
        """The current rows."""
        commits = self.log.numbers()
        if not commits:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._rows_as_of(commits[-1])

    def changes(self) -> DataFrame:
        """All changes ever made, with their type, version and time."""
        return self.log.read()

    def newest(self, column: str):
        """The greatest value of a column among the current rows.

        For dates and whole numbers the footers of all files give an upper bound: no rows are read
        for it. It also covers images that were replaced later; so the rows that hold it are looked
        for, and only if there are none the column is read.
        """
        rows = self.read()
        plain = all(isinstance(f.dataType, AtomicType) for f in rows.schema)
        if plain and isinstance(rows.schema[column].dataType, (DateType, IntegralType)):
            bound = self.greatest_in_files(column).first()[0]
            if bound is None or not rows.filter(named(column) == F.lit(bound)).isEmpty():
                return bound
        return rows.agg(F.max(named(column))).first()[0]

    def greatest_in_files(self, column: str) -> DataFrame:
        """A maximum that Spark takes from the statistics in the footers of all files of the table.

        Spark finds the column by its place in the schema, so each folder is read with its own.
        """
        commits = self.log.numbers()
        snapshot = self._snapshot(commits[-1])
        paths = [self.log.folder(n) for n in self._after(snapshot, commits) if column in self._schema_at(n).names]
        if snapshot and column in self._schema_at(snapshot.version).names:
            paths += [p for p in (f"{snapshot.path}/rows", f"{snapshot.path}/keyless") if storage.exists(self.spark, p)]
        session = self.spark.newSession()  # the settings concern this one plan
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        parts = [session.read.parquet(path).agg(F.max(named(column)).alias(column)) for path in paths]
        return reduce(DataFrame.unionByName, parts).agg(F.max(named(column)).alias(column))

    def stream_changes(self, max_files: int | None = None) -> DataFrame:
        return self.log.stream(max_files)

    # ---- writing -----------------------------------------------------------

    def upsert(
        self,
        df: DataFrame,
        source: str = "batch",
        batch: int | None = None,
        one_row_per_key: bool = False,
    ) -> int:
        """Merge ``df`` by key and return the commit version.

        A batch of a source that is already committed is left alone.
        ``one_row_per_key`` skips the reduction when the caller has done it.
        """
        if batch is not None:
            done = self.log.find(source, batch)
            if done is not None:
                return done
        commits = self.log.numbers()
        rows = df if one_row_per_key else latest_per_key(
            df, self.keys, self.order_by, "group" if self.match_null_keys else "each"
        )
        if not commits:
            return self.log.append(self._as_inserts(rows), source, batch, self._lookup_options())

        # The batch is used more than once below. Written out, it is computed once,
        # its size is known, and a lost executor costs a re-read, not a re-run.
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        with shuffles_freed(rows.sparkSession):
            rows.write.mode("overwrite").option("compression", CODEC).parquet(staged)
        incoming = with_columns_of(self.spark.read.schema(rows.schema).parquet(staged), self.schema())
        self._settle_if_due(commits)
        version = self.log.append(
            self._compare(incoming, commits, self._key_bytes(incoming), self._slices(staged, commits)),
            source, batch, self._lookup_options(),
        )
        storage.remove(self.spark, staged)
        return version

    def _as_inserts(self, rows: DataFrame, stamp: Column | None = None) -> DataFrame:
        now = F.current_timestamp() if stamp is None else stamp
        return rows.select("*", F.lit(INSERT).alias(CHANGE), now.alias(STAMP))

    def _lookup_options(self) -> dict[str, str]:
        """Writer options that let scans pass over what a list or a range of keys can't be in."""
        blooms = {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.keys}
        return {
            **blooms, "parquet.bloom.filter.adaptive.enabled": "true", "parquet.page.row.count.limit": str(PAGE_ROWS)}

    def _with_match(self, rows: DataFrame) -> DataFrame:
        """Rows plus what they are matched by: themselves, or the text of a key that may hold nulls."""
        if not self.match_null_keys:
            return rows
        written = F.to_json(F.struct(*map(named, self.keys)), {"ignoreNullFields": "false"})
        return rows.withColumn(MATCH, written)

    def _key_bytes(self, incoming: DataFrame) -> int:
        """About what the keys of a staged batch take in memory; its rows are counted in the files' footers."""
        return incoming.count() * row_bytes(self._with_match(incoming).select(*map(named, self.matched_by)).schema)

    def _slices(self, staged: str, commits: list[int]) -> int:
        """In how many slices of the keys a batch is compared.

        Joining a batch with commits moves both, and what is moved takes several times their place on disk: a slice
        at a time, it takes a share of that. Each slice reads all files again, hence few slices. A snapshot is
        not moved, and would be read as often.
        """
        if self._snapshot(commits[-1]):
            return 1
        moved = storage.size_bytes(self.spark, staged, *[self.log.folder(n) for n in commits])
        return max(1, min(SLICES, moved // SLICE_BYTES))

    def _compare(
        self, incoming: DataFrame, commits: list[int], batch_bytes: int, slices: int = 1
    ) -> list[DataFrame]:
        """The changes that merging ``incoming`` makes, those of each slice of the keys."""
        stamp = F.timestamp_micros(F.lit(time.time_ns() // 1000))  # one time for all slices
        keyed = incoming if self.match_null_keys else incoming.filter(~any_null(self.keys))
        near = self._near(keyed.select(*map(named, self.keys)))
        parts = []
        for n in range(slices):
            within = F.pmod(F.xxhash64(*map(named, self.keys)), F.lit(slices)) == n if slices > 1 else F.lit(True)
            parts.append(self._compare_slice(incoming.filter(within), commits, batch_bytes, near & within, stamp))
        return parts

    def _compare_slice(
        self, incoming: DataFrame, commits: list[int], batch_bytes: int, near: Column, stamp: Column
    ) -> DataFrame:
        columns = incoming.columns
        keyed = self._with_match(incoming if self.match_null_keys else incoming.filter(~any_null(self.keys)))
        old = self._old_rows(keyed.select(*map(named, {*self.keys, *self.matched_by})), commits, batch_bytes, near)
        old = self._with_match(with_columns_of(old, incoming.schema))

        pairs = keyed.select(*map(named, self.matched_by), F.struct(*map(named, columns)).alias("new")).join(
            old.select(*map(named, self.matched_by), F.struct(*map(named, columns)).alias("old")),
            list(self.matched_by), "left",
        )
        if self.keep == "existing":
            pairs = pairs.filter(F.col("old").isNull())
        elif self.keep == "greatest":
            ranked = precedence(columns, self.keys, self.order_by)
            new, held = (F.struct(*[F.col(s).getField(c) for c in ranked]) for s in ("new", "old"))
            pairs = pairs.filter(F.col("old").isNull() | (new > held))

        def entry(kind: str, side: str) -> Column:
            return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

        merged = pairs.select(
            F.explode(
                F.when(F.col("old").isNull(), F.array(entry(INSERT, "new")))
                .otherwise(F.array(entry(BEFORE, "old"), entry(AFTER, "new")))
            ).alias("e")
        ).select(
            *[F.col("e.row").getField(c).alias(c) for c in columns],
            F.col("e.kind").alias(CHANGE),
            stamp.alias(STAMP),
        )
        if self.match_null_keys:
            return merged
        return merged.unionByName(self._as_inserts(incoming.filter(any_null(self.keys)), stamp))

    def _old_rows(
        self, wanted: DataFrame, commits: list[int], batch_bytes: int, near: Column | None = None
    ) -> DataFrame:
        """Current rows of the wanted keys: the newest of snapshot and later commits.

        Both are read where the staged batch's keys can be only: scans skip row groups and pages.
        """
        snapshot = self._snapshot(commits[-1])
        later = self._after(snapshot, commits)
        near = self._near(wanted) if near is None else near
        side, by = wanted.select(*map(named, self.matched_by)), list(self.matched_by)
        found = []
        if snapshot:
            held = self._bucketed(snapshot).filter(near)
            # hinted, the join streams the table: no shuffle and no sort of it
            small = side.hint("shuffle_hash") if batch_bytes / snapshot.buckets <= HASH_BUILD_BYTES else side
            found.append(
                held.join(small, by, "left_semi").select(*map(named, self.schema().names))
                .withColumn(VERSION, F.lit(snapshot.version).cast("long"))
            )
        if later:
            images = self._with_match(self._images(later).filter(near))
            found.append(images.join(side, by, "left_semi").select(*map(named, self.schema().names), VERSION))
        if len(found) == 1 and len(later) <= 1:
            return found[0].drop(VERSION)
        old = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        return latest_per_key(old, self.keys, [VERSION]).drop(VERSION)

    def _near(self, wanted: DataFrame) -> Column:
        """What holds for all rows with the wanted keys, in terms that a parquet scan understands.

        A key column with few values becomes a list, which Bloom filters and page statistics are
        asked for; else the first key becomes ranges around the values there are.
        """
        counts = wanted.agg(*[F.approx_count_distinct(named(k)).alias(k) for k in self.keys]).first()
        holds = F.lit(True)
        for key in self.keys:
            if counts[key] > 2 * FEW_KEYS:
                continue
            values = [row[0] for row in wanted.select(named(key)).distinct().limit(FEW_KEYS + 1).collect()]
            if len(values) <= FEW_KEYS:
                given = named(key).isin([v for v in values if v is not None])
                holds &= given | named(key).isNull() if None in values else given
        first = self.keys[0]
        if counts[first] > FEW_KEYS:
            ranges = key_ranges(wanted.select(named(first)))
            inside = [named(first).between(F.lit(low), F.lit(high)) for low, high in ranges]
            inside += [named(first).isNull()] if self.match_null_keys else []
            holds &= reduce(lambda one, two: one | two, inside)
        return holds

    def register(self, schema: str, name: str) -> str:
        """Give the current rows a lasting name in the catalog: a view over snapshot and later commits.

        To be called again when there are new commits; the files it reads are kept by ``vacuum``
        until the snapshot after the next.
        """
        view = NamedView(self.spark, schema, name)
        commits, columns = self.log.numbers(), self.schema().names
        snapshot = self._snapshot(commits[-1])
        held = ", ".join(map(quoted, columns))
        keys = ", ".join(map(quoted, self.keys))
        feed = view.external(self.log.path, self.log.numbered_schema(), VERSION)
        images = (f"SELECT * FROM {feed} WHERE {VERSION} > {snapshot.version if snapshot else -1} "
                  f"AND {CHANGE} IN ('{INSERT}', '{AFTER}')")
        lone = " OR ".join(f"{quoted(k)} IS NULL" for k in self.keys)
        matched = images if self.match_null_keys else f"{images} AND NOT ({lone})"
        rest = ", ".join(quoted(c) if c in self.keys else f"top.{quoted(c)}" for c in columns)
        parts = [f"SELECT {rest} FROM (SELECT {keys}, max_by(struct({held}), {VERSION}) AS top FROM ({matched}) GROUP BY {keys})"]
        if not self.match_null_keys:
            parts.append(f"SELECT {held} FROM ({images}) WHERE {lone}")
        if snapshot:
            then = self._schema_at(snapshot.version)
            filled = ", ".join(
                quoted(f.name) if f.name in then.names else f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
                for f in self.schema())
            rows = view.external(f"{snapshot.path}/rows", then)
            same = " AND ".join(f"r.{quoted(k)} {'<=>' if self.match_null_keys else '='} i.{quoted(k)}" for k in self.keys)
            parts.append(f"SELECT {filled} FROM {rows} r LEFT ANTI JOIN ({matched}) i ON {same}")
            if not self.match_null_keys:
                parts.append(f"SELECT {filled} FROM {view.external(f'{snapshot.path}/keyless', then)}")
        return view.replace(" UNION ALL ".join(parts))

    # ---- snapshots ---------------------------------------------------------

    def snapshots(self) -> list[Snapshot]:
        found = []
        for name in storage.child_names(self.spark, f"{self.path}/snapshots"):
            match = re.fullmatch(r"v=(\d+)-b(\d+)" + ("-m" if self.match_null_keys else ""), name)
            if match:
                version, buckets = map(int, match.groups())
                found.append(Snapshot(version, buckets, f"{self.path}/snapshots/{name}"))
        return sorted(found, key=lambda s: s.version)

    def _snapshot(self, newest: int) -> Snapshot | None:
        usable = [s for s in self.snapshots() if s.version <= newest]
        return usable[-1] if usable else None

    @staticmethod
    def _after(snapshot: Snapshot | None, commits: list[int]) -> list[int]:
        return [n for n in commits if snapshot is None or n > snapshot.version]

    def _images(self, commits: list[int]) -> DataFrame:
        """New images of rows in the given commits, rows that can be matched only."""
        images = self.log.read(commits).filter(F.col(CHANGE).isin(INSERT, AFTER)).drop(CHANGE, STAMP)
        return images if self.match_null_keys else images.filter(~any_null(self.keys))

    def _unmatchable(self, snapshot: Snapshot | None, commits: list[int]) -> DataFrame | None:
        """Rows with a null in their key, which no upsert ever replaces."""
        if self.match_null_keys:
            return None
        parts = []
        if commits:
            lone = self.log.read(commits).filter(any_null(self.keys))
            parts.append(lone.drop(*FEED_COLUMNS))
        if snapshot:
            parts.append(self.spark.read.schema(self.schema()).parquet(f"{snapshot.path}/keyless"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _newest_images(self, commits: list[int]) -> DataFrame:
        """The newest image of each key.

        One commit holds one row per key already. Those of the newest commit need not move, and of the commit before it
        those columns move that the reader asks for.
        """
        newest = self._images(commits[-1:]).drop(VERSION)
        if len(commits) == 1:
            return newest
        older = self._images(commits[:-1])
        if len(commits) > 2:
            older = latest_per_key(older, self.keys, [VERSION])
        replaced = self._with_match(newest).select(*map(named, self.matched_by))
        kept = self._with_match(older).join(replaced, list(self.matched_by), "left_anti")
        return kept.select(*map(named, newest.columns)).unionByName(newest)

    def _rows_as_of(self, newest: int, keyless: bool = True) -> DataFrame:
        snapshot = self._snapshot(newest)
        later = self._after(snapshot, [n for n in self.log.numbers() if n <= newest])
        parts = []
        if snapshot:
            kept = self._bucketed(snapshot)
            if later:
                replaced = self._with_match(self._images(later)).select(*map(named, self.matched_by))
                kept = kept.join(replaced, list(self.matched_by), "left_anti")
            parts.append(kept.select(*map(named, self.schema().names)))
        if later:
            parts.append(self._newest_images(later))
        lone = self._unmatchable(snapshot, later) if keyless else None
        if lone is not None:
            parts.append(lone)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def _bytes(self, snapshot: Snapshot | None, later: list[int]) -> tuple[int, int]:
        held = storage.size_bytes(self.spark, snapshot.path) if snapshot else 0
        return held, storage.size_bytes(self.spark, *[self.log.folder(n) for n in later])

    def _rows_held(self, snapshot: Snapshot | None, later: list[int]) -> int:
        """Rows of the snapshot and the new images after it, counted in the files' footers."""
        held = self.spark.read.schema(self.schema()).parquet(f"{snapshot.path}/rows").count() if snapshot else 0
        return held + self._images(later).count()

    def _settle_if_due(self, commits: list[int]) -> None:
        snapshot = self._snapshot(commits[-1])
        later = self._after(snapshot, commits)
        held, pending = self._bytes(snapshot, later)
        # keys looked up in a lone commit move it once, which costs less than writing a snapshot for them first
        worth = snapshot is not None or len(later) > 1 or not self.settle_bytes
        due = worth and pending > max(self.settle_bytes, self.settle_share * held)
        if later and due:
            self.settle()

    def settle(self) -> None:
        """Fold all commits into a new snapshot."""
        commits = self.log.numbers()
        snapshot = self._snapshot(commits[-1])
        later = self._after(snapshot, commits)
        if not later:
            return
        newest = commits[-1]
        buckets = self._bucket_count(HELD * self._rows_held(snapshot, later) * row_bytes(self.schema()))
        if snapshot and snapshot.buckets == buckets:
            rows = self._folded(snapshot, later)
        else:
            rows = self._with_match(self._rows_as_of(newest, keyless=False)).repartition(
                buckets, *map(named, self.matched_by))
        if self.cluster_by:
            given = [self._images(later)] + ([self._bucketed(snapshot)] if snapshot else [])
            rows = rows.withColumn(LAYOUT, z_order(given, self.cluster_by))
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        name = f"shopstrata_staging_{uuid.uuid4().hex}"
        with shuffles_freed(rows.sparkSession):
            (
                rows.write.format("parquet").option("compression", CODEC).options(**self._lookup_options())
                .bucketBy(buckets, *self.matched_by).sortBy(*([LAYOUT] if self.cluster_by else self.sort_by))
                .option("path", f"{staged}/rows").saveAsTable(name)
            )
        self.spark.sql(f"DROP TABLE {name}")  # the name only: the files are external
        lone = self._unmatchable(snapshot, later)
        if lone is not None:
            lone.write.option("compression", CODEC).parquet(f"{staged}/keyless")
        kind = "-m" if self.match_null_keys else ""
        storage.publish(self.spark, staged, f"{self.path}/snapshots/v={newest}-b{buckets}{kind}")

    def _folded(self, snapshot: Snapshot, later: list[int]) -> DataFrame:
        """Snapshot and later commits, joined bucket by bucket without moving the snapshot."""
        columns = [*self.schema().names, *({*self.matched_by} - {*self.keys})]
        values = [c for c in columns if c not in self.matched_by]
        new = self._with_match(self._newest_images(later)).select(
            *map(named, self.matched_by), F.struct(F.lit(1).alias("_new"), *map(named, values)).alias("_n")
        )
        both = self._bucketed(snapshot).join(new, list(self.matched_by), "full_outer")
        return both.select(*[
            named(c) if c in self.matched_by
            else F.when(F.col("_n").isNotNull(), F.col("_n").getField(c)).otherwise(named(c)).alias(c)
            for c in columns
        ])

    def _bucket_count(self, size: int) -> int:
        """A power of two near ``size / bucket_bytes``, so it changes when the table has doubled."""
        floor = min(8, self.spark.sparkContext.defaultParallelism)
        wanted = max(floor, -(-size // self.bucket_bytes))
        return min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())

    def _bucketed(self, snapshot: Snapshot) -> DataFrame:
        """The snapshot's rows, and what they are matched by, as a bucketed table; columns added later are null.

        Spark takes bucketing from the catalog only, hence the external table.
        """
        name = self._catalog_name(snapshot)
        if not self.spark.catalog.tableExists(name):
            held = self._schema_at(snapshot.version)
            held = held.add(MATCH, "string") if self.match_null_keys else held
            columns, keys = columns_sql(held), ", ".join(map(quoted, self.matched_by))
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) INTO {snapshot.buckets} BUCKETS "
                f"LOCATION '{snapshot.path}/rows'"
            )
        return with_columns_of(self.spark.table(name), self.schema())

    def _schema_at(self, version: int) -> StructType:
        note = StructType.fromJson(self.log.note(version)["schema"])
        return StructType([f for f in note if f.name not in FEED_COLUMNS])

    @staticmethod
    def _catalog_name(snapshot: Snapshot) -> str:
        return f"shopstrata_{hashlib.md5(snapshot.path.encode()).hexdigest()}"

    def vacuum(self, keep: int = 2) -> None:
        """Drop snapshots older than the newest ``keep`` and leftovers of failed writes.

        Called by the writer, between writes. The change feed is never shortened.
        """
        for path in (self.path, self.log.path):
            storage.remove(self.spark, f"{path}/_staging")
        for snapshot in self.snapshots()[:-keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(snapshot)}")
            storage.remove(self.spark, snapshot.path)


def row_bytes(schema: StructType) -> int:
    """About what a row takes in memory: a word for each column, more for one of variable length, a header and a pointer."""
    fixed = (NumericType, DateType, TimestampType, BooleanType)
    return 32 + sum(8 if isinstance(f.dataType, fixed) else 32 for f in schema)


def part_of(value: Column, cuts: Sequence) -> Column:
    """How many of the sorted ``cuts`` a value lies beyond, found by halving."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(cuts[middle]), within(middle + 1, high)).otherwise(within(low, middle))

    return within(0, len(cuts))


def key_ranges(keys: DataFrame) -> list[tuple]:
    """At most ``RANGES`` ranges that hold all values of the one column.

    Quantiles cut the values into parts, and the least and greatest value of each part is taken.
    One range is returned where the parts leave little out, or where there are no quantiles.
    """
    field = keys.schema[0]
    value = named(field.name)
    whole = keys.agg(F.min(value), F.max(value)).first()
    if not isinstance(field.dataType, (NumericType, DateType, TimestampType)):
        return [tuple(whole)]
    shares = [n / RANGES for n in range(1, RANGES)]
    cuts = sorted(set(keys.agg(F.percentile_approx(value, shares, 1000)).first()[0]))
    found = keys.filter(value.isNotNull()).groupBy(part_of(value, cuts).alias("part")).agg(F.min(value), F.max(value)).collect()
    ranges = sorted((low, high) for _, low, high in found)
    covered, reach = sum(((high - low) for low, high in ranges), whole[0] - whole[0]), whole[1] - whole[0]
    return ranges if covered * 2 < reach else [tuple(whole)]


def feed_images(feed: DataFrame) -> DataFrame:
    """Rows as they are after each change, batch or stream: inserts and new images."""
    return feed.filter(F.col(CHANGE).isin(INSERT, AFTER))


def newest_images(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest image per key of a feed; several commits may touch one key."""
    images = feed_images(feed).drop(CHANGE, STAMP)
    return latest_per_key(images, keys, [VERSION], null_keys="each").drop(VERSION)
