"""How far the term use of sources diverges: a k-squared tree over the matrix of groups and terms.

A group is a source of a language. Rows of the matrix are groups, columns are the terms that the language keeps. It is
cut into stripes of columns and blocks of rows; one task call joins the rows of two blocks over one stripe, so what it holds
is bounded by ``COLUMNS`` and ``ROWS``, however many groups, terms and documents there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tabletransfer.llm.shared import keep, plain

#: Each quadrant of a tree has FANOUT x FANOUT children; a stripe has about COLUMNS terms, a block ROWS groups.
FANOUT, COLUMNS, ROWS = 4, 1024, 256
#: Quadrants that are split together, which bounds the arrays of a step.
STEP = 1 << 13
#: Bytes of UTF-8: A-Z in lower case, letters and all beyond ASCII as they are, the others a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text that are searched at once, sums that a task holds, rows of a batch that it hands on.
SLICE, HELD, OUT_ROWS = 1 << 20, 1 << 19, 1 << 16
LEAST_DOCUMENTS, BEST = 10, 10
ONE = 1_000_000_000


def price(count: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(10**9 * (count + 2) / (total + 2 * terms)); exact, as decimals hold the product."""
    wide = (count.cast("decimal(20,0)") + 2) * F.lit(ONE)
    divisor = total.cast("decimal(20,0)") + F.lit(2) * terms
    return F.call_function("div", wide, divisor) + F.lit(1).cast("long")


def gap(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / (p + q)); the square is below 2**63 as p and q are at most 10**9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


# --- counts -----------------------------------------------------------------------


def _found(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice of about ``SLICE`` bytes at a time."""
    text, start = text.translate(LETTERS), 0
    while start < len(text):
        end = text.find(b" ", start + SLICE) if len(text) - start > SLICE else len(text)
        end = end if end >= 0 else len(text)
        yield text[start:end].split()
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term and documents that hold it, from whole texts.

    A task adds its rows up and hands its sums on whenever it holds ``HELD`` of them.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def sums() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                for at in range(0, len(n), OUT_ROWS):
                    terms = list(islice(n, at, at + OUT_ROWS)) if len(n) > OUT_ROWS else list(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                         pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()),
                         pa.array([docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in (batch["lang"], batch["source"], batch["text"].cast(pa.binary())))):
                n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                distinct: set[bytes] = set()
                for terms in _found(text):
                    n.update(terms)
                    distinct.update(terms)
                docs.update(distinct)
            if sum(len(n) for n, _ in groups.values()) > HELD:
                yield from sums()
        yield from sums()

    rows = docs.select("lang", "source", "text").mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n``: the counts of terms that ``least`` documents of the language hold.

    The window groups rows by term, at most one for each source.
    """
    by_term = Window.partitionBy("lang", "term")
    summed = counts.select("*", F.sum("docs").over(by_term).alias("lang_docs"), F.sum("n").over(by_term).alias("lang_n"))
    return summed.where(F.col("lang_docs") >= least).select("lang", "source", "term", "n", "lang_n")


# --- the tree ---------------------------------------------------------------------


@dataclass
class Tree:
    """The quadrants of a matrix that are not all zero, level by level; the last level is the cells."""

    rows: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    depth: int

    def __post_init__(self):
        self.side = FANOUT ** self.depth
        self.levels = [np.unique((self.rows // s) * self.side + self.columns // s)
                       for s in (FANOUT ** k for k in range(self.depth, 0, -1))]
        key = self.rows * self.side + self.columns
        order = np.argsort(key)
        self.levels.append(key[order])
        self.values = self.values[order]

    def find(self, level: int, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The place of each quadrant in its level; -1 for one that is all zero."""
        keys = self.levels[level]
        if not len(keys):
            return np.full(len(row), -1)
        key = row * self.side + column
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at, -1)


def depth_for(n: int) -> int:
    """Levels of a tree whose side holds ``n``."""
    depth = 1
    while FANOUT ** depth < n:
        depth += 1
    return depth


def joint_gaps(left: Tree, right: Tree, left_zero: np.ndarray, right_zero: np.ndarray, width: int, same: bool) -> np.ndarray:
    """The sums of gaps of all pairs of a row on the left and one on the right, over ``width`` columns.

    ``*_zero`` are the prices of a count of zero, by row. Both trees are walked together from the root: where the
    quadrants of both sides are all zero, the walk ends and the quadrant's columns are priced at once by
    the gap of the rows' zero prices; a cell with a count on either side is priced by itself. ``same`` visits
    pairs with left < right only.
    """
    n, m, depth = len(left_zero), len(right_zero), left.depth
    total = np.zeros((n, m), np.int64)
    empty_columns = [np.zeros((-(-n // FANOUT ** (depth - k)), -(-m // FANOUT ** (depth - k))), np.int64) for k in range(depth + 1)]
    child = np.stack(np.meshgrid(*[np.arange(FANOUT)] * 3, indexing="ij"), -1).reshape(-1, 3)
    todo = [(0, np.zeros((1, 3), np.int64))]
    while todo:
        level, nodes = todo.pop()
        if len(nodes) > STEP:
            todo.append((level, nodes[STEP:]))
            nodes = nodes[:STEP]
        level += 1
        side = FANOUT ** (depth - level)
        nodes = (nodes[:, None, :] * FANOUT + child).reshape(-1, 3)
        inside = (nodes[:, 0] * side < n) & (nodes[:, 1] * side < m) & (nodes[:, 2] * side < width)
        if same:
            inside &= nodes[:, 0] <= nodes[:, 1]
        nodes = nodes[inside]
        a, b, c = nodes.T
        in_left, in_right = left.find(level, a, c), right.find(level, b, c)
        empty = (in_left < 0) & (in_right < 0)
        spans = np.minimum((c[empty] + 1) * side, width) - c[empty] * side
        shape = empty_columns[level].shape
        empty_columns[level] += np.bincount(a[empty] * shape[1] + b[empty], spans, shape[0] * shape[1]).astype(np.int64).reshape(shape)
        if side > 1:
            if not empty.all():
                todo.append((level, nodes[~empty]))
            continue
        a, b, at, bt = a[~empty], b[~empty], in_left[~empty], in_right[~empty]
        p = np.where(at >= 0, left.values[at] if len(left.values) else 0, left_zero[a])
        q = np.where(bt >= 0, right.values[bt] if len(right.values) else 0, right_zero[b])
        # Sums of a step are below 2**53, so the weights of bincount are exact.
        total += np.bincount(a * m + b, (p - q) ** 2 // (p + q), n * m).astype(np.int64).reshape(n, m)
    zeros = np.zeros((n, m), np.int64)
    for level, columns in enumerate(empty_columns):
        side = FANOUT ** (depth - level)
        zeros += columns[np.arange(n)[:, None] // side, np.arange(m)[None, :] // side]
    p, q = left_zero[:, None], right_zero[None, :]
    return total + zeros * ((p - q) ** 2 // (p + q))


def _pairs(table: pa.Table) -> pa.Table:
    """One stripe of two blocks: cells (row, term, p) and a row without a term for each group (row, p of zero)."""
    lang, left, right = (table[c][0].as_py() for c in ("lang", "left", "right"))
    block, row, p = (table[c].to_numpy() for c in ("block", "row", "p"))
    term = table["term"].combine_chunks().dictionary_encode()
    head = term.indices.is_null().to_numpy(zero_copy_only=False)
    column = term.indices.fill_null(0).to_numpy()
    width = len(term.dictionary)
    # Columns that the same groups use lie side by side, which makes zero quadrants large.
    cell_row = block[~head] * ROWS + row[~head]
    least, uses = np.full(width, np.iinfo(np.int64).max), np.bincount(column[~head], minlength=width)
    np.minimum.at(least, column[~head], cell_row)
    place = np.empty(width, np.int64)
    place[np.lexsort((uses, least))] = np.arange(width)
    depth = max(depth_for(max(width, 1)), depth_for(ROWS))

    def side(number: int) -> tuple[Tree, np.ndarray]:
        zero = np.zeros(int((head & (block == number)).sum()), np.int64)
        zero[row[head & (block == number)]] = p[head & (block == number)]
        own = ~head & (block == number)
        return Tree(row[own], place[column[own]], p[own], depth), zero

    (a, a_zero), (b, b_zero) = side(left), side(right)
    sums = joint_gaps(a, b, a_zero, b_zero, width, left == right)
    one, two = np.nonzero(np.triu(np.ones_like(sums), 1) if left == right else np.ones_like(sums))
    return pa.table({
        "lang": pa.array([lang] * len(one), pa.string()), "one": left * ROWS + one, "two": right * ROWS + two,
        "value": sums[one, two]}, schema=_PAIR_SCHEMA)


_PAIR_SCHEMA = pa.schema([("lang", pa.string()), ("one", pa.int64()), ("two", pa.int64()), ("value", pa.int64())])


# --- the audit --------------------------------------------------------------------


@dataclass
class Audit:
    """Results of ``audit``. ``terms``: ``lang, source, term, value``, the gap of a group to its language for
    each kept term that it uses more. ``pairs``: ``lang, source, other, value``, the sum of gaps of two groups over all
    kept terms, both ways. ``groups``: ``lang, source, number, total, terms``."""

    terms: DataFrame
    pairs: DataFrame
    groups: DataFrame


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> Audit:
    """Compare the term use of all sources of each language.

    Null text, lang and source count as ''. A document is a row; repeated rows count each. A language without
    kept terms has groups and pairs of value 0. Only lang, source and text are read. One number
    for each group is drawn by sorting the groups of a language, which needs their names only. The pairs are
    as many as the result has; a pair's sum is added up from partial sums of its stripes.
    """
    docs = plain(docs, "lang", "source", "text").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = keep(kept_terms(term_counts(docs), least), "kept_terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select("lang", "source", number.cast("long").alias("number"), *[
        F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
    groups = groups.withColumn("blocks", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / F.lit(ROWS)))
    groups = keep(groups.withColumn("stripes", F.greatest(F.ceil(F.col("terms") / F.lit(COLUMNS)), F.lit(1).cast("long"))), "groups")
    cells = kept.join(groups, ["lang", "source"]).withColumn("p", price(F.col("n"), F.col("total"), F.col("terms")))
    q = price(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = cells.withColumn("q", q).where("p > q").select("lang", "source", "term", gap(F.col("p"), F.col("q")).alias("value"))
    return Audit(terms, _pair_sums(cells, groups), groups.select("lang", "source", "number", "total", "terms"))


def _pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    place = ["lang", "block", "row", "blocks", "number"]
    block = groups.select("*", F.floor(F.col("number") / ROWS).alias("block"), (F.col("number") % ROWS).alias("row"))
    heads = block.where("terms >= 0").withColumn("p", F.when(F.col("terms") > 0, price(
        F.lit(0), F.col("total"), F.greatest(F.col("terms"), F.lit(1)))).otherwise(1)).select(
        *place, "p", F.lit(None).cast("string").alias("term"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)).alias("stripe"))
    rows = cells.select("*", F.floor(F.col("number") / ROWS).alias("block"), (F.col("number") % ROWS).alias("row"),
                        F.pmod(F.xxhash64("term"), F.col("stripes")).alias("stripe")).select(*place, "p", "term", "stripe")
    # A block of rows meets each other block, and itself, once in each stripe.
    both = rows.unionByName(heads).withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang", "stripe", F.least("block", "met").alias("left"), F.greatest("block", "met").alias("right"), "block", "row", "p", "term")
    parts = both.groupBy("lang", "stripe", "left", "right").applyInArrow(_pairs, "lang string, one long, two long, value long")
    sums = parts.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    both_ways = sums.select("lang", "value", F.inline(F.array(
        F.struct(F.col("one").alias("number"), F.col("two").alias("partner")), F.struct(F.col("two").alias("number"), F.col("one").alias("partner")))))
    names = groups.select("lang", "source", "number")
    partners = groups.select("lang", F.col("source").alias("other"), F.col("number").alias("partner"))
    return both_ways.join(names, ["lang", "number"]).join(partners, ["lang", "partner"]).select("lang", "source", "other", "value")


def divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group all other sources of its language (part ``pair``) and
    the ten terms that set it apart most from its language (part ``term``), greatest value first, equal ones by item."""
    found = audit(docs)
    shared = lambda df, part, item: df.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = shared(found.pairs, "pair", "other").withColumn("rank", F.row_number().over(order))
    terms = shared(found.terms, "term", "term").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    return pairs.unionByName(terms)


#: The same over ``documents`` in DuckDB's SQL.
DIVERGENCE_SQL = r"""
WITH words AS MATERIALIZED (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents),
each AS MATERIALIZED (SELECT doc, lang, source, unnest(found) AS term FROM words),
langs AS MATERIALIZED (
    SELECT lang, term, count(*) AS n FROM each GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
lang_sums AS (SELECT lang, count(*) AS v, sum(n) AS total FROM langs GROUP BY lang),
cells AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM each JOIN langs USING (lang, term) GROUP BY lang, source, term),
groups AS MATERIALIZED (
    SELECT lang, source, coalesce(own, 0) AS own, coalesce(v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM words) LEFT JOIN (SELECT lang, source, sum(n) AS own FROM cells GROUP BY lang, source)
    USING (lang, source) LEFT JOIN lang_sums USING (lang)),
prices AS MATERIALIZED (
    SELECT g.lang, source, term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 2)) // (own + 2 * v)::HUGEINT AS p
    FROM groups g JOIN langs l USING (lang) LEFT JOIN cells c USING (lang, source, term)),
lang_prices AS (
    SELECT lang, term, 1 + (1000000000 * (n::HUGEINT + 2)) // (total + 2 * v)::HUGEINT AS q FROM langs JOIN lang_sums USING (lang)),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
    FROM prices JOIN lang_prices USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10"""
