"""Nearest neighbours by multi-index hashing.

Vectors become binary codes by a learned rotation (principal axes, turned so that signs
lose least). A code is split into substrings of eight bits, and each substring is indexed. If two codes differ
in at most R bits, then by the pigeonhole principle some of the m substrings differs in at
most R // m bits, so probing each substring's buckets within that radius retrieves every code
within R. Those are ranked again by their floats.

Every query has a radius of its own: the distance of its k-th nearest code, and a slack for the order
of codes being only roughly that of vectors. Who has too few codes within the first radius is searched
again with a larger one, until there are enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabletransfer.llm.shared import keep, plain

#: Longest code, and bits of a substring. A shard holds 16 neighbouring buckets of one substring.
MOST_BITS, SUBSTRING = 64, 8
#: Most vectors that the rotation is fitted on, chosen by hash of the id.
SAMPLE = 4000
#: The slack is the one that holds this share of the true neighbours of so many queries, and the first
#: radius is enough for this share of them.
RADIUS_QUERIES, RADIUS_SHARE, FIRST_SHARE = 64, 0.98, 0.9
#: Most rows and queries on average that meet in one group.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096


@dataclass
class Rotation:
    centre: np.ndarray
    axes: np.ndarray

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    @property
    def substrings(self) -> int:
        return -(-self.bits // SUBSTRING)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        signs = ((vectors - self.centre) @ self.axes) > 0
        padded = np.zeros((len(vectors), MOST_BITS), np.uint8)
        padded[:, :self.bits] = signs
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64).ravel()


def fit_rotation(sample: np.ndarray, rounds: int = 40) -> Rotation:
    centre = sample.mean(axis=0)
    moved = sample - centre
    bits = min(MOST_BITS, sample.shape[1])
    _, axes = np.linalg.eigh(moved.T @ moved)
    axes = axes[:, ::-1][:, :bits]
    flat = moved @ axes
    turn, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(10)).standard_normal((bits, bits)))
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (left @ right).T
    return Rotation(centre, axes @ turn)


def _vectors(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _substring(codes: np.ndarray, j: int) -> np.ndarray:
    return ((codes >> np.uint64(SUBSTRING * j)) & np.uint64(255)).astype(np.uint8)


def _nearest(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least distances, equal ones by id."""
    if len(distance) > k:
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((ids[near], distance[near]))[:k]]


def _distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(axis=1))


def valid_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, embedding`` of vectors that take part: with an id, not null, not zero, no null or
    non-finite component, and of the length that most vectors have (of equally common ones the longest)."""
    rows = plain(rows, id_col, vector_col).toDF("vec_id", "embedding").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", finite)
                      & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head()
    return rows.where(F.size("embedding") == (sizes["size"] if sizes else 0))


def search(rows: DataFrame, is_query, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` (a condition on ``vec_id``) selects its
    k nearest others by Euclidean distance, among all codes within the query's radius.

    See ``valid_vectors`` for what takes part. Equal distances go by smaller id; rows that repeat an id are
    queries and candidates each, and only the query's own row is not its neighbour. A query has fewer than k rows only where there are
    fewer candidates. An empty table gives an empty result. Further columns are not read.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = keep(valid_vectors(rows).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], schema)
    rotation = spark.sparkContext.broadcast(fit_rotation(_vectors(sample["embedding"])))
    queries = keep(rows.where(is_query).withColumn("query", F.col("row")), "queries")
    sampled = _sampled(rows, queries, rotation, k)
    slack = _slack(sampled)
    first = min(_radius(sampled, slack), rotation.value.bits)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = rotation.value.codes(_vectors(batch.column(1)))
            for j in range(rotation.value.substrings):
                shard = j * 16 + (_substring(codes, j) >> 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(codes.view(np.int64)), pa.array(shard, pa.int32())],
                    names=["vec_id", "embedding", "row", "code", "shard"])

    bits, substrings = rotation.value.bits, rotation.value.substrings

    def probing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every shard that has a bucket within the substring's radius."""
        values = np.arange(256, dtype=np.uint8)
        for batch in batches:
            codes = rotation.value.codes(_vectors(batch.column(1)))
            within = batch.column(3).to_numpy() // substrings
            for j in range(substrings):
                near = np.bitwise_count(_substring(codes, j)[:, None] ^ values) <= within[:, None]
                at, group = np.nonzero(near.reshape(len(codes), 16, 16).any(axis=2))
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(codes[at].view(np.int64)), pa.array(j * 16 + group, pa.int32())],
                    names=["vec_id", "embedding", "query", "radius", "code", "shard"])

    def met(data: pa.Table, queries: pa.Table) -> pa.Table:
        """The k nearest of each query in the group, and in rows without a score the k least distances of codes."""
        out: list[tuple] = []
        if data.num_rows and queries.num_rows:
            j = data["shard"][0].as_py() // 16
            ids, vectors, numbers = data["vec_id"].to_numpy(), _vectors(data["embedding"]), data["row"].to_numpy()
            codes = data["code"].to_numpy().view(np.uint64)
            own = _substring(codes, j)
            buckets = {v: np.flatnonzero(own == v) for v in np.unique(own)}
            query_ids, query_codes = queries["vec_id"].to_numpy(), queries["code"].to_numpy().view(np.uint64)
            values = np.array(list(buckets), np.uint8)
            radii = queries["radius"].to_numpy()
            for number, q, radius, code, vector in zip(
                    queries["query"].to_pylist(), query_ids, radii, query_codes, _vectors(queries["embedding"])):
                within = radius // substrings
                probed = values[np.bitwise_count(values ^ _substring(np.array([code]), j)) <= within]
                if not len(probed):
                    continue
                at = np.concatenate([buckets[v] for v in probed])
                differ = codes[at] ^ code
                apart = np.bitwise_count(differ)
                good = (apart <= radius) & (numbers[at] != number)
                for earlier in range(j):  # a pair is ranked where it is found first
                    good &= np.bitwise_count(_substring(differ, earlier)) > within
                at, apart = at[good], apart[good]
                if len(at):
                    distance = _distances(vector, vectors[at])
                    best = _nearest(distance, ids[at], k)
                    out.extend(zip([number] * len(best), [q] * len(best), ids[at[best]].tolist(), distance[best].tolist(),
                                   [None] * len(best)))
                    least = np.sort(apart)[:k].tolist()
                    out.extend((number, q, None, None, b) for b in least)
        columns = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(
            columns, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()))],
            names=["query", "query_id", "vec_id", "score", "bits"])

    index = rows.mapInArrow(indexed, "vec_id long, embedding array<double>, row long, code long, shard int")
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    # At most 128 shards, whatever the number of rows.
    sizes = keep(index.groupBy("shard").agg(F.count("*").alias("n")), "sizes").select(
        "shard", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    counted = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    index = (index.join(F.broadcast(sizes), "shard")
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
             .withColumn("queries", counted(F.lit(query_blocks))).drop("blocks"))
    key = ["shard", "block", "queries"]

    def searched(queries: DataFrame) -> DataFrame:
        probes = (queries.select("vec_id", "embedding", "query", "radius")
                  .mapInArrow(probing, "vec_id long, embedding array<double>, query long, radius int, code long, shard int")
                  .join(F.broadcast(sizes), "shard").withColumn("block", counted(F.col("blocks")))
                  .withColumn("queries", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).drop("blocks"))
        return keep(index.groupBy(*key).cogroup(probes.groupBy(*key)).applyInArrow(
            met, "query long, query_id long, vec_id long, score double, bits int"), "found")

    nearest = Window.partitionBy("query").orderBy("score", "vec_id")
    upwards = Window.partitionBy("query").orderBy("bits").rowsBetween(Window.unboundedPreceding, 0)
    todo = queries.select("query", "vec_id", "embedding", F.lit(first).alias("radius"),
                          F.lit(min(k, rows.count() - 1)).cast("long").alias("need"))
    parts = []
    while True:
        todo = keep(todo, "todo")
        found = searched(todo)
        reached = (found.where("score is null").groupBy("query", "bits").agg(F.count("*").alias("n"))
                   .withColumn("n", F.sum("n").over(upwards)).join(todo.select("query", "need"), "query").where("n >= need")
                   .groupBy("query").agg(F.min("bits").alias("reached")))
        # Who has too few is probed one bit of each substring further.
        radius = F.least(F.lit(bits), F.coalesce(F.col("reached") + slack, F.col("radius") + substrings))
        again = keep(todo.where(F.col("radius") < bits).where("need > 0").join(reached, "query", "left")
                     .withColumn("wider", radius.cast("int")).where("wider > radius")
                     .select("query", "vec_id", "embedding", F.col("wider").alias("radius"), "need"), "again")
        best = found.where("score is not null").join(again.select("query"), "query", "left_anti")
        parts.append(best.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
                     .select("query", "query_id", "vec_id", "score"))
        if again.isEmpty():
            break
        todo = again
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _sampled(rows: DataFrame, queries: DataFrame, rotation, k: int) -> list[tuple[int, list[int]]]:
    """For some queries the distance of the k-th nearest code, and those of the codes of the true neighbours,
    found by one exact pass."""
    probes = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(RADIUS_QUERIES).toArrow()
    if not probes.num_rows:
        return []
    ids = probes["row"].to_numpy()
    sent = rows.sparkSession.sparkContext.broadcast((ids, _vectors(probes["embedding"])))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, vectors = sent.value
        codes = rotation.value.codes(vectors)
        for batch in batches:
            own, data = batch.column(2).to_numpy(), _vectors(batch.column(1))
            near = np.bitwise_count(rotation.value.codes(data)[:, None] ^ codes)
            for n, q in enumerate(queries):
                distance = np.where(own == q, np.inf, _distances(vectors[n], data))
                best = _nearest(distance, own, k)
                best = best[np.isfinite(distance[best])]
                least = np.sort(near[own != q, n])[:k].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n] * (len(best) + len(least)), pa.int32()),
                     pa.array(own[best].tolist() + [None] * len(least), pa.int64()),
                     pa.array(distance[best].tolist() + [None] * len(least), pa.float64()),
                     pa.array(np.concatenate((near[best, n].astype(np.int32), least)))],
                    names=["number", "vec_id", "distance", "bits"])

    found = rows.mapInArrow(exact, "number int, vec_id long, distance double, bits int").withColumn(
        "code", F.col("distance").isNull())
    order = Window.partitionBy("number", "code").orderBy("distance", "bits", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).collect()
    kth, true = {}, {}
    for r in best:
        if r["code"]:
            kth[r["number"]] = max(kth.get(r["number"], 0), r["bits"])
        else:
            true.setdefault(r["number"], []).append(r["bits"])
    return [(kth[n], true[n]) for n in sorted(true)]


def _quantile(values: list[int], share: float) -> int:
    return int(np.sort(values)[int(np.ceil(share * len(values))) - 1]) if len(values) else 0


def _slack(sampled: list[tuple[int, list[int]]]) -> int:
    """How far beyond the k-th nearest code most true neighbours' codes lie at most."""
    return max(0, _quantile([b - kth for kth, true in sampled for b in true], RADIUS_SHARE))


def _radius(sampled: list[tuple[int, list[int]]], slack: int) -> int:
    """The radius that all queries are searched with first; it is enough for most."""
    return _quantile([kth + slack for kth, _ in sampled], FIRST_SHARE)
