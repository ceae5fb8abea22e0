"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas: an
insert adds a document and its tokens, a delete takes them away, a revision
adds the difference of its counts. A batch is summed per key and written to a
folder of its own attempt; it is committed by one manifest, which names all
live folders and all batches so far by the number of its generation. The manifest is written
aside and renamed to the next generation's name, which only one writer can
do; who comes second reads the new generation and tries again on top of it.
So a batch that is committed changes nothing when it is sent again, one that
failed before its manifest leaves nothing but an unused folder, half-written
manifests are never read, and ``compact``, which folds the folders of the
generation it has read into one, never meets with a folder that another has
folded. Old folders stay until ``vacuum``.

Null sources and languages are keys like others; null texts and counts have no
tokens. Rows of unknown kind are an error. An empty batch commits no sums.
Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.llm.tokens import default_path, word_tokens

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def version(path: str) -> str:
    """Name and checksum of a vocabulary file: another file is another version."""
    with open(path, "rb") as f:
        return f"{os.path.basename(path).split('.')[0]}-{zlib.crc32(f.read()):08x}"


def count_tokens(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens`` of whole texts."""
    path = tokenizer or default_path()
    name = version(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            for at, _, bounds in tokens.encode(batch.column(3)):
                n = np.diff(bounds)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, len(n)) for i in range(3)), pa.array([name] * len(n)), pa.array(n)], ["doc_id", "source", "lang", "tokenizer", "tokens"])

    cast = docs.select(F.col("doc_id").cast("long"), *(F.col(c).cast("string") for c in ("source", "lang", "text")))
    return cast.mapInArrow(count, "doc_id long, source string, lang string, tokenizer string, tokens long")


def changes(counted: DataFrame, kind: str, new: Column | None = None, old: Column | None = None) -> DataFrame:
    """Rows of ``count_tokens`` as changes of one kind, with their new and old counts."""
    none = F.lit(None).cast("long")
    return counted.select(F.lit(kind).alias("kind"), *KEYS, (none if new is None else new).alias("tokens"), (none if old is None else old).alias("old_tokens"))


class Rollup:
    """Totals under ``root``, a folder that driver and executors share.

    A rename onto a file that is there has to fail, as it does in HDFS and
    local folders; on object stores take a committer with such a rename.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):  # noqa: ANN202
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))]

    def _state(self) -> dict:
        """The latest manifest: ``generation``, ``live`` folders and committed ``batches``."""
        numbers = [int(n) for n in self._names("generations") if n.isdigit()]
        if not numbers:
            return {"generation": 0, "live": [], "batches": []}
        raw = self.spark.read.text(f"{self.root}/generations/{max(numbers):012d}", wholetext=True).first()[0]
        return json.loads(raw)

    def _commit(self, state: dict) -> bool:
        """Makes ``state`` the next generation; False if another writer made it first."""
        aside = self._path(f"aside/{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(json.dumps(state).encode())
        out.close()
        target = self._path(f"generations/{state['generation']:012d}")
        self._fs.mkdirs(self._path("generations"))
        won = not self._fs.exists(target) and self._linked(aside, target)
        self._fs.delete(aside, False)
        return won

    def _linked(self, aside, target) -> bool:  # noqa: ANN001
        """Renames without replacing: the local file system would replace, so it links there."""
        if self._fs.getUri().getScheme() == "file":
            try:
                os.link(aside.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return bool(self._fs.rename(aside, target))

    def committed(self, batch_id: str) -> bool:
        return batch_id in self._state()["batches"]

    def _write(self, sums: DataFrame) -> str:
        name = f"deltas/{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.root}/{name}")
        return name

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commits ``changes(kind, source, lang, tokenizer, tokens, old_tokens)``; False if it was before.

        ``kind``: insert (tokens), delete (old_tokens) or revise (both).
        """
        state = self._state()
        if batch_id in state["batches"]:
            return False
        kind, new, old = F.col("kind"), F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
        wrong = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
        docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(wrong.cast("int"))
        tokens = F.when(kind == "insert", new).when(kind == "delete", -old).otherwise(new - old)
        name = self._write(changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("n_docs"), F.sum(tokens).cast("long").alias("n_tokens")))
        while batch_id not in state["batches"]:
            if self._commit({"generation": state["generation"] + 1, "live": [*state["live"], name], "batches": [*state["batches"], batch_id]}):
                return True
            state = self._state()
        return False

    def _totals(self, live: list[str]) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], TOTALS)
        deltas = self.spark.read.schema(TOTALS).parquet(*(f"{self.root}/{n}" for n in live))
        return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of what is committed; keys without documents and tokens are left out."""
        return self._totals(self._state()["live"])

    def compact(self) -> bool:
        """Folds the live folders into one; False if there was nothing to fold or others folded them first."""
        state = self._state()
        old = state["live"]
        if len(old) < 2:
            return False
        name = self._write(self._totals(old).coalesce(1))  # a row per key
        while set(old) <= set(state["live"]):  # batches that came meanwhile stay beside the new folder
            live = [name, *(n for n in state["live"] if n not in old)]
            if self._commit({"generation": state["generation"] + 1, "live": live, "batches": state["batches"]}):
                return True
            state = self._state()
        return False

    def vacuum(self) -> int:
        """Deletes folders that no manifest will name again; run it when no writer or reader is at work."""
        live = set(self._state()["live"])
        gone = [f"deltas/{n}" for n in self._names("deltas") if f"deltas/{n}" not in live]
        for n in gone:
            self._fs.delete(self._path(n), True)
        return len(gone)
