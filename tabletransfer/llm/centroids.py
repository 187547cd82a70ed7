"""Clustering by centroids in whole numbers, with Spark's own expressions only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from tabletransfer.llm.shared import keep, plain

#: Components beyond this, times the scale, would give squared distances beyond a long.
LARGEST = 1 << 27

Centroids = list[list[int]]


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64,
                  scale: int = 256) -> DataFrame:
    """``vec_id, x``: vectors with ``size`` components, none null or non-finite, as floor(scale * component).

    Others are left out, as are those with a component of ``LARGEST`` or more after scaling, whose squares
    no long holds.
    """
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v * F.lit(float(scale)))
    inside = F.forall("scaled", lambda v: F.coalesce((v >= -float(LARGEST)) & (v < float(LARGEST)), F.lit(False)))
    rows = plain(rows, id_col, vector_col).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("scaled"))
    return rows.where(F.size("scaled") == size).where(inside).select(
        "vec_id", F.transform("scaled", lambda v: F.floor(v)).alias("x"))


def first_centroids(vectors: DataFrame, k: int, prefix: str = "2:") -> Centroids:
    """The ``k`` vectors with the smallest hash of their id; null ids come last, equal ids in order of their vectors."""
    chosen = vectors.select(F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256).alias("hash"), "x")
    return [list(r.x) for r in chosen.orderBy(F.asc_nulls_last("hash"), "x").limit(k).collect()]


def nearest(centroids: Centroids) -> Column:
    """``distance, cluster`` of the nearest centroid of ``x``; of equally near ones the smaller number.

    A distance is |x|^2 + |c|^2 - 2xc; |x|^2 is added to the least only, and |c|^2 and -2c are literals.
    """
    total = lambda array, first: F.aggregate(array, first, lambda sum_, v: sum_ + v)
    literal = F.expr("array(" + ",".join(
        f"named_struct('cluster', {number}, 'norm', {sum(v * v for v in c)}L, 'c', array({','.join(f'{-2 * v}L' for v in c)}))"
        for number, c in enumerate(centroids)) + ")")
    least = F.array_min(F.transform(literal, lambda c: F.struct(
        total(F.zip_with("x", c["c"], lambda a, b: a * b), c["norm"]).alias("distance"), c["cluster"].alias("cluster"))))
    norm = total(F.transform("x", lambda v: v * v), F.lit(0).cast("long"))
    return F.transform(F.array(least), lambda n: F.struct((n["distance"] + norm).alias("distance"), n["cluster"].alias("cluster")))[0]


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid becomes the floor of the mean of its vectors; one without vectors stays.

    Sums are added up in each task, so a row for each centroid and task is shuffled, however many vectors
    a centroid has.
    """
    sums = [F.sum(F.col("x")[j]).alias(f"s{j}") for j in range(len(centroids[0]))]
    rows = (vectors.select(nearest(centroids)["cluster"].alias("cluster"), "x").groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("n"), *sums).collect())
    after = list(centroids)
    for r in rows:
        after[r.cluster] = [s // r.n for s in r[2:]]
    return after


def cluster(rows: DataFrame, k: int = 40, rounds: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            size: int = 64, scale: int = 256, prefix: str = "2:") -> tuple[DataFrame, Centroids]:
    """(``vec_id, cluster, distance`` of every kept vector, the final centroids).

    Each of ``rounds`` rounds assigns all vectors to their nearest centroid and moves the centroids; then all
    are assigned once more. Distances are squared and exact. With fewer than ``k`` vectors each one
    starts a centroid; without any there are none. The driver holds the centroids only, ``k`` times ``size``
    numbers. Rows with one id are assigned one by one; further columns are not read.
    """
    vectors = keep(whole_vectors(rows, id_col, vector_col, size, scale), "whole_vectors")
    centroids = first_centroids(vectors, k, prefix)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    assigned = vectors.select("vec_id", nearest(centroids).alias("near"))
    return keep(assigned.select("vec_id", "near.cluster", "near.distance"), "assigned"), centroids


def clusters(rows: DataFrame, **options) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector; for the options
    see ``cluster``. A sum of distances beyond a long is null. A table without such vectors gives no rows."""
    assigned, centroids = cluster(rows, **options)
    total = lambda column: F.sum(F.col(column).cast("decimal(38,0)"))
    inertia = assigned.groupBy("cluster").agg(total("distance").alias("part"))
    parts = {r.cluster: r.part for r in inertia.collect()}
    whole = sum(parts.values())
    inside = lambda value: int(value) if value < 1 << 63 else None
    facts = [(number, inside(parts.get(number, 0)), inside(whole), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for number, c in enumerate(centroids)]
    known = rows.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """The same over ``embeddings`` in DuckDB's SQL, for the values that the registered query uses."""
    steps = [f"""c0 AS MATERIALIZED (
        SELECT pos, j, v AS c FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS pos, x FROM kept)
        CROSS JOIN LATERAL (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS j) WHERE pos < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
        SELECT row, min(d)[1] AS distance, min(d)[2] AS cluster FROM (
            SELECT row, [sum((v - c) * (v - c))::BIGINT, pos] AS d FROM long_rows JOIN c{r} USING (j) GROUP BY row, pos)
        GROUP BY row)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
        SELECT pos, j, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
            SELECT cluster AS pos, j, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS m
            FROM a{r} JOIN long_rows USING (row) GROUP BY cluster, j) USING (pos, j))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64),
long_rows AS MATERIALIZED (SELECT row, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM kept),
{", ".join(steps)},
hashes AS (SELECT pos, sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY pos)
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN hashes ON pos = cluster"""
