"""Benchmark decontamination with DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tabletransfer.llm.shared import keep, plain

#: Words of a window.
WINDOW = 10
#: A window is looked up by a hash of its first words, so many of them as it has.
KEY_SIZES = (1, 2, 4)
#: The set of benchmark windows is broadcast up to this size; beyond it the windows meet in a shuffled join.
BROADCAST_BYTES = 64 << 20

#: What separates words, before A-Z are made lower case, and what words consist of.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _words() -> Column:
    """The words, with an empty one before or after them where the text has separators there."""
    return F.split("text", SEPARATORS, -1)


def _places(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows with ``words`` to one row per place: ``at`` (0-based) and the hash of the ``size`` words from there on.

    Hashes of two and four words are made of those of their halves, each array in a step of its own, so
    that none is computed twice (an outer explode has no filter that would repeat them). At the end of a text fewer words are hashed; such places match
    nothing when words are compared.
    """
    names = rows.columns
    hashed = rows.withColumn("_1", F.transform("words", lambda w: F.xxhash64(F.lower(w))))
    for half in range(1, max(sizes)):
        if 2 * half in KEY_SIZES and 2 * half <= max(sizes):
            ahead = F.slice(f"_{half}", half + 1, F.greatest(F.size(f"_{half}") - half, F.lit(0)))
            hashed = hashed.withColumn(f"_{2 * half}", F.zip_with(f"_{half}", ahead, lambda a, b: F.xxhash64(a, b)))
    if len(sizes) == 1:
        return hashed.select(*names, F.lit(sizes[0]).alias("size"), F.posexplode_outer(f"_{sizes[0]}").alias("at", "hash"))
    each = F.explode_outer(F.array(*[F.struct(F.lit(n).alias("size"), F.col(f"_{n}").alias("hashes")) for n in sizes]))
    return (hashed.select(*names, each.alias("_key"))
            .select(*names, F.col("_key.size").alias("size"), F.posexplode_outer("_key.hashes").alias("at", "hash")))


def _gram(length: Column) -> Column:
    return _lower(F.array_join(F.slice("words", F.col("at") + 1, length), " "))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """``size, hash, gram, length, item_ids``: each distinct window of ``length`` words with the items that hold it.

    ``hash`` is that of its first ``size`` words: one, two or four.
    """
    rows = plain(items, "item_id", "text").where("item_id is not null").select(
        "item_id", F.filter(F.split("text", SEPARATORS, -1), lambda w: w != "").alias("words"))
    size = F.greatest(*[F.when(F.col("length") >= k, k) for k in KEY_SIZES])
    rows = (rows.where("size(words) > 0").withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
            .withColumn("key", size))
    return (_places(rows, list(KEY_SIZES)).where("size = key and at + length <= size(words)")
            .select("item_id", "size", "hash", "length", _gram(F.col("length")).alias("gram")).distinct()
            .groupBy("size", "hash", "length", "gram").agg(F.collect_set("item_id").alias("item_ids")))


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, at, length, item_ids``: every place where a window of an item occurs.

    The windows are found by a hash of their first words; then all their words are compared.
    """
    grams = keep(benchmark_windows(items), "grams")
    known = grams.agg(
        F.collect_set("size").alias("sizes"),
        F.sum(F.octet_length("gram") + 8 * F.size("item_ids") + 64).alias("bytes")).head()
    if known["bytes"] is not None and known["bytes"] <= BROADCAST_BYTES:
        grams = F.broadcast(grams)
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words().alias("words"))
    places = _places(words, sorted(known["sizes"]) or [max(KEY_SIZES)])
    return (places.join(grams, ["size", "hash"]).where(F.col("gram") == _gram(F.col("length")))
            .select("doc_id", "text_hash", (F.col("at") - (F.element_at("words", 1) == "").cast("int")).alias("at"),
                    "length", "item_ids"))


def _spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document that has any: the numbers of the words that are hit, and the items."""
    return hits(docs, items).groupBy("doc_id", "text_hash").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.col("length") - 1)))).alias("hit"),
        F.array_distinct(F.flatten(F.collect_set("item_ids"))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    A window is ten consecutive words of an item, or all words of a shorter one. Words of
    a document that any occurrence of a window covers are hit. Texts without words, null ones
    too, have no hit; items without words or id have no window. Repeated rows each get their
    row. Further columns are not read.
    """
    docs = plain(docs, "doc_id", "text")
    edges = (F.element_at("all", 1) == "").cast("long") + (F.element_at("all", -1) == "").cast("long")
    counts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words().alias("all")).select(
        "doc_id", "text_hash", F.greatest(F.coalesce(F.size("all") - edges, F.lit(0)), F.lit(0)).cast("long").alias("n_words"))
    spans = _spans(docs, items).withColumnsRenamed({"doc_id": "span_id", "text_hash": "span_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("text_hash") == F.col("span_hash"))
    return counts.join(spans, same, "left").select(
        "doc_id", "n_words",
        F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform(
            F.coalesce("items", F.array().cast("array<long>")), lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"))


def remove_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, without those that are hit."""
    found = hits(plain(docs, "doc_id", "text"), items).select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col("hit_id"))
                     & (F.xxhash64(docs["text"]) == F.col("hit_hash")), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, without the words that are hit and what follows each up to the next word."""
    names = docs.columns
    spans = _spans(plain(docs, "doc_id", "text"), items).select(
        F.col("doc_id").alias("_span_id"), F.col("text_hash").alias("_span_hash"), F.col("hit").alias("_hit"))
    lead = F.regexp_extract("text", "^" + SEPARATORS[:-1] + "*", 0)
    pieces = F.regexp_extract_all("text", F.lit(f"{WORD}{SEPARATORS[:-1]}*"), F.lit(0))
    left = F.filter(F.transform(pieces, lambda p, i: F.when(~F.array_contains("_hit", i), p)), lambda p: p.isNotNull())
    return (docs.join(spans, docs["doc_id"].eqNullSafe(F.col("_span_id"))
                      & (F.xxhash64(docs["text"]) == F.col("_span_hash")), "left")
            .withColumn("text", F.when(F.col("_hit").isNull(), F.col("text"))
                        .otherwise(F.concat(lead, F.array_join(left, "")))).select(*names))
