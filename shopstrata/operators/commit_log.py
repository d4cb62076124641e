"""An append-only parquet table in which every append is one committed folder.

``<path>/<column>=<n>/`` holds append ``n``. Rows are written to a hidden staging
folder and renamed into place, so readers, batch or stream, see whole appends
only. Each carries the name of its source and that source's batch number; handing
the same batch in again changes nothing, which makes stream replays harmless.
One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructType

from shopstrata import storage
from shopstrata.operators.names import NamedView
from shopstrata.session import shuffles_freed

NOTE = "_commit.json"
CODEC = "zstd"  # of stored rows; a quarter less disk than the default


class CommitLog:
    def __init__(self, spark: SparkSession, path: str, column: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.column = column

    def folder(self, number: int) -> str:
        return f"{self.path}/{self.column}={number}"

    def numbers(self) -> list[int]:
        lead = f"{self.column}="
        names = storage.child_names(self.spark, self.path)
        return sorted(int(n[len(lead):]) for n in names if n.startswith(lead))

    def note(self, number: int) -> dict:
        return json.loads(storage.read_text(self.spark, f"{self.folder(number)}/{NOTE}"))

    def _entry(self, source: str, batch: int) -> str:
        return f"{self.path}/_batches/{hashlib.md5(source.encode()).hexdigest()}/{batch}"

    def _enter(self, number: int) -> dict:
        """Note in the index of batches which append holds a batch; does nothing if it is there."""
        note = self.note(number)
        if note["batch"] is not None:
            entry = self._entry(note["source"], note["batch"])
            if not storage.exists(self.spark, entry):
                storage.write_text(self.spark, entry, str(number))
        return note

    def find(self, source: str, batch: int) -> int | None:
        """The append that holds this batch, if it was committed before.

        A look into the index of batches, whatever the age of the log. An append is entered there
        after its commit, at the latest before the next one; so if the writer was lost in
        between, it is the newest append that is missing, and that one's note is read.
        """
        numbers = self.numbers()
        if not numbers:
            return None
        if not storage.exists(self.spark, f"{self.path}/_batches"):  # written before there was an index
            for number in numbers:
                self._enter(number)
        else:
            self._enter(numbers[-1])
        entry = self._entry(source, batch)
        return int(storage.read_text(self.spark, entry)) if storage.exists(self.spark, entry) else None

    def schema(self) -> StructType:
        """Schema of the newest append, which later ones only ever add columns to."""
        return StructType.fromJson(self.note(self.numbers()[-1])["schema"])

    def append(
        self, df: DataFrame | Sequence[DataFrame], source: str = "batch", batch: int | None = None,
        options: dict[str, str] | None = None,
    ) -> int:
        """Commit the rows as one append. Several parts of them are written one after the other."""
        parts = [df] if isinstance(df, DataFrame) else list(df)
        if batch is not None:
            done = self.find(source, batch)
            if done is not None:
                return done
        number = max(self.numbers(), default=-1) + 1
        if number:
            self._enter(number - 1)
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        for part in parts:
            with shuffles_freed(part.sparkSession):
                part.write.mode("append").option("compression", CODEC).options(**(options or {})).parquet(staged)
        note = {"source": source, "batch": batch, "schema": json.loads(parts[0].schema.json())}
        storage.write_text(self.spark, f"{staged}/{NOTE}", json.dumps(note))
        storage.publish(self.spark, staged, self.folder(number))
        self._enter(number)
        return number

    def read(self, numbers: list[int] | None = None) -> DataFrame:
        """Rows of the given appends (all by default) plus the append number."""
        wanted = self.numbers() if numbers is None else numbers
        schema = self.numbered_schema()
        if not wanted:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[self.folder(n) for n in wanted])

    def stream(self, max_files: int | None = None) -> DataFrame:
        # by default files a week older than the newest would be passed over
        reader = self.spark.readStream.schema(self.numbered_schema()).option("maxFileAge", "36500d")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path)

    def numbered_schema(self) -> StructType:
        return StructType(self.schema().fields).add(self.column, LongType())

    def register(self, schema: str, name: str) -> str:
        """Give the rows of all appends so far a lasting name in the catalog."""
        view = NamedView(self.spark, schema, name)
        return view.replace(f"SELECT * FROM {view.external(self.path, self.numbered_schema(), self.column)}")
