"""Token counts kept up to date by signed deltas."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabletransfer.llm.shared import keep, plain
from tabletransfer.llm.tokens import VOCABULARY, token_ids

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
WORDS = "words-1"
DELTAS = "source string, lang string, tokenizer string, documents long, tokens long"


def counted_forms(docs: DataFrame, forms: dict[str, Column], vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, lang, form, tokenizer, tokens``: counts of each document in several forms of its text, by two
    tokenizer versions, the given vocabulary and ``words-1``, runs without white space. A null text has 0 tokens.

    Texts are read once and not handed on; a form that equals the first one is not encoded again.
    """
    names = list(forms)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [batch[f"text_{i}"] for i in range(len(names))]
            sizes = []
            for i, column in enumerate(texts):
                new = column if not i else pc.if_else(pc.fill_null(pc.equal(column, texts[0]), False), pa.scalar("", column.type), column)
                own = np.fromiter((len(ids) for ids in token_ids(new, vocabulary)), np.int64, len(new))
                same = pc.fill_null(pc.equal(column, texts[0]), False).to_numpy(zero_copy_only=False)
                sizes.append(own if not i else np.where(same, sizes[0], own))
            kept = [c for c in batch.schema.names if not c.startswith("text_")]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], *map(pa.array, sizes)], names=[*kept, *[f"ids_{i}" for i in range(len(names))]])

    known = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string")]
    texts = [forms[name].alias(f"text_{i}") for i, name in enumerate(names)]
    words = [F.coalesce(F.regexp_count(f"text_{i}", F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long").alias(f"words_{i}")
             for i in range(len(names))]
    rows = plain(docs, "doc_id", "source", "lang", "text").select(*known, *texts).select("*", *words)
    rows = rows.mapInArrow(counts, "doc_id long, source string, lang string, " + ", ".join(
        f"{kind}_{i} long" for kind in ("words", "ids") for i in range(len(names))))
    each = [F.struct(F.lit(name).alias("form"), F.lit(kind).alias("tokenizer"), F.col(f"{column}_{i}").alias("tokens"))
            for i, name in enumerate(names) for kind, column in ((WORDS, "words"), (vocabulary, "ids"))]
    return rows.select("doc_id", "source", "lang", F.inline(F.array(*each)))


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens``: as ``counted_forms``, of the text as it is."""
    return counted_forms(docs, {"text": F.col("text").cast("string")}, vocabulary).drop("form")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts that replace others: the old ones leave, the new ones enter, also under another source or language."""
    return deletes(old).union(inserts(new))


class Rollup:
    """Totals by source, language and tokenizer version below ``path``.

    A batch is a folder of summed deltas, named by its id, with versions inside. A commit writes a new version, which
    counts in place of an older one once it is complete; so a repeated, restarted or failed commit never counts twice and never
    takes away what is there. What a batch holds follows from its id. Totals are sums over the folders; as deltas are signed
    sums, batches may come in any order. ``compact`` folds batches into one base and remembers their ids. Any number of
    sessions may commit and read at once, and one may compact.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _complete(self, pattern: str) -> list[str]:
        """Folders below ``path`` that match and are complete, in order."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}/_SUCCESS")
        found = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(root)
        return sorted(f.getPath().getParent().toString() for f in found or [])

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _base(self) -> tuple[int, DataFrame | None]:
        """The newest complete base and its number; a base is complete when its list of ids is."""
        numbers = [int(p.rpartition("=")[2]) for p in self._complete("bases/base=*")]
        if not numbers:
            return 0, None
        return max(numbers), self.spark.read.parquet(f"{self.path}/totals-{max(numbers)}")

    def _folded(self, base: int) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/bases/base={base}") if base else None

    @staticmethod
    def _summed(deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])

    def commit(self, batch_id: int, deltas: DataFrame) -> bool:
        """Add one batch of deltas (``source, lang, tokenizer, documents, tokens``); False if it is folded already."""
        folded = self._folded(self._base()[0])
        if folded is not None and not folded.where(F.col("batch_id") == batch_id).isEmpty():
            return False
        before = self._complete(f"deltas/batch_id={batch_id}/*")
        newest = int(before[-1].rpartition("/")[2].split("-")[1]) if before else 0
        version = f"version-{newest + 1:09d}-{uuid.uuid4().hex}"
        self._summed(plain(deltas, *KEYS, *SUMS)).write.parquet(f"{self.path}/deltas/batch_id={batch_id}/{version}")
        for path in before:
            self._delete(path)
        return True

    def _batches(self, base: int) -> dict[int, str]:
        """The batches that are in no base, and the folder of each one's newest version."""
        found = {int(p.split("/")[-2].removeprefix("batch_id=")): p for p in self._complete("deltas/batch_id=*/*")}
        folded = self._folded(base)
        if folded is not None and found:
            for row in folded.where(F.col("batch_id").isin(list(found))).collect():
                del found[row.batch_id]
        return found

    def _sum(self, base: DataFrame | None, batches: dict[int, str]) -> DataFrame:
        parts = [base] if base is not None else []
        if batches:
            parts.append(self.spark.read.schema(DELTAS).parquet(*batches.values()))
        if not parts:
            return self.spark.createDataFrame([], DELTAS)
        rows = [p.select(*KEYS, *SUMS) for p in parts]
        return self._summed(rows[0] if len(rows) == 1 else rows[0].union(rows[1])).where("documents != 0 or tokens != 0")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` of all commits; groups without documents left are not listed."""
        number, base = self._base()
        return self._sum(base, self._batches(number))

    def compact(self) -> None:
        """Fold the batches that are there now into a new base. Totals stay the same at every moment, also while
        others commit: sums and ids are of one list of folders. What the base before this one had folded is deleted."""
        number, base = self._base()
        batches = self._batches(number)
        if not batches:
            return
        folded = self._folded(number)
        self._sum(base, batches).write.mode("overwrite").parquet(f"{self.path}/totals-{number + 1}")
        ids = self.spark.createDataFrame([(i,) for i in batches], "batch_id long")
        ids = ids if folded is None else ids.union(folded.select("batch_id"))
        ids.write.mode("overwrite").parquet(f"{self.path}/bases/base={number + 1}")
        if folded is not None:
            # A reader that began before this compaction may still need what it folded, but nothing older.
            there = {int(p.split("/")[-2].removeprefix("batch_id=")): p for p in self._complete("deltas/batch_id=*/*")}
            if there:
                for row in folded.where(F.col("batch_id").isin(list(there))).collect():
                    self._delete(there[row.batch_id].rpartition("/")[0])
        if number > 1:
            self._delete(f"{self.path}/bases/base={number - 1}")
            self._delete(f"{self.path}/totals-{number - 1}")


def tidy(text: Column) -> Column:
    """The revision that the registered query makes: runs of white space become one space."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))


def maintained(docs: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """Totals after four commits: all documents enter; toxic ones leave; those of low quality are
    revised by ``tidy``; and the second commit is repeated, which changes nothing.

    A document counts once per row; ids without a label stay as they are, and one that is both toxic and of low
    quality only leaves. Null sources and languages are groups of their own. An empty table has no totals.
    """
    rollup = Rollup(docs.sparkSession, path)
    text = F.col("text").cast("string")
    counts = counted_forms(docs, {"text": text, "tidy": tidy(text)})
    marks = plain(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    # Null ids have no label; they are spread over all tasks.
    counts = counts.withColumn("key", F.coalesce(F.col("doc_id"), F.xxhash64("source", "lang", "tokens", F.spark_partition_id())))
    marks = marks.withColumn("known", F.lit(True)).withColumnRenamed("doc_id", "key")
    counts = keep(counts.withColumn("known", F.col("doc_id").isNotNull()).join(marks, ["key", "known"], "left"), "counts")
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    low = ~toxic & F.coalesce(F.col("quality") == 0, F.lit(False))
    text, tidied = (counts.where(F.col("form") == form) for form in ("text", "tidy"))
    rollup.commit(1, inserts(text))
    rollup.commit(2, deletes(text.where(toxic)))
    rollup.compact()
    rollup.commit(3, revisions(text.where(low), tidied.where(low)))
    rollup.commit(2, deletes(text.where(toxic)))
    rollup.commit(3, revisions(text.where(low), tidied.where(low)))
    return rollup.totals()
