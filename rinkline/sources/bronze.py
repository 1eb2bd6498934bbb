"""The table of raw documents, with a generated key, that only grows.

An append is named.  It is staged, numbered by counts per range, given the next
keys by a reservation, and written under its name; it counts once it is whole.
A run that is repeated under its name, after any failure, adds nothing twice.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkline.operators import ingest
from rinkline.operators.ordering import row_numbers
from rinkline.sources.storage import create, delete, empty, exists, folders

#: The table's columns; event_id is generated.
SCHEMA = "event_id long, ingestion_timestamp timestamp, source string, raw_json string"


class Bronze:
    """Raw documents under a root folder: documents/run=<name>, and one small file per reservation of keys."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _whole(self) -> list[str]:
        return [x for x in folders(self.spark, f"{self.root}/documents") if exists(self.spark, f"{self.root}/documents/{x}/_SUCCESS")]

    def read(self) -> DataFrame:
        """The documents of all appends that are whole."""
        paths = [f"{self.root}/documents/{x}" for x in self._whole()]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else empty(self.spark, SCHEMA)

    def runs(self) -> DataFrame:
        """(run, first, rows): the keys that each append has reserved, whole or not."""
        schema = "run string, first long, rows long"
        path = f"{self.root}/keys"
        return self.spark.read.schema(schema).json(path) if folders(self.spark, path) else empty(self.spark, schema)

    def reserve(self, run: str, rows: int) -> int:
        """The first of so many keys for a run, the same whenever it asks for as many.

        Reservations are numbered files that only one writer can create, so runs
        at the same time get keys of their own; keys of a run that never ends stay unused.
        """
        while True:
            taken = self.runs().collect()
            mine = [r.first for r in taken if (r.run, r.rows) == (run, rows)]
            if mine:
                return mine[0]
            first = max((r.first + r.rows for r in taken), default=1)
            line = json.dumps({"run": run, "first": first, "rows": rows})
            if create(self.spark, f"{self.root}/keys/{len(taken) + 1:010d}.json", line):
                return first

    def append(self, documents: DataFrame, run: str) -> int:
        """Adds documents (ingestion_timestamp, source, raw_json) whose source is not stored yet under a run's name; returns how many this call wrote.

        Keys rise with (ingestion_timestamp, source).  A run that is whole already
        adds nothing.  Of documents with one source in the same append all are
        kept, the newest counts when they are loaded; null sources are always new.
        An append without new documents leaves an empty run.

        Spark: sources are joined without texts; documents are sorted into ranges
        once, numbered by the counts of the ranges before, and written.
        """
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError(f"not a name for a run: {run!r}")
        path = f"{self.root}/documents/run={run}"
        if exists(self.spark, f"{path}/_SUCCESS"):
            return 0
        new = ingest.new_documents(documents.select("ingestion_timestamp", "source", "raw_json"), self.read())
        numbered = row_numbers(new, [F.col("ingestion_timestamp").asc_nulls_first(), F.col("source").asc_nulls_first()])
        rows = numbered.count()
        first = self.reserve(run, rows)
        out = numbered.select((F.col("row_number") - 1 + first).alias("event_id"), "ingestion_timestamp", "source", "raw_json")
        delete(self.spark, path)
        out.write.parquet(path)
        return rows
