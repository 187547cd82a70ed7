import hashlib
import math

import pytest

from tabletransfer.llm.centroids import LARGEST, cluster, clusters

SCHEMA = "vec_id long, embedding array<float>, label int, x int, cluster string, distance string"


def by_hand(rows, k=40, rounds=5, size=64):
    """The contract in plain Python: (vec_id, cluster, distance) and the centroids."""
    kept = [(i, [math.floor(256 * float(v)) for v in e]) for i, e in rows
            if e is not None and len(e) == size and all(v is not None and math.isfinite(v) for v in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[:k]]

    def assign():
        out = []
        for i, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        now = assign()
        for number in range(len(centroids)):
            own = [x for (_, x), (_, at, _) in zip(kept, now) if at == number]
            if own:
                centroids[number] = [sum(column) // len(own) for column in zip(*own)]
    return assign(), centroids


def vectors(n, seed):
    import random

    r = random.Random(seed)
    centers = [[r.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    return [(i, [c + r.gauss(0, 0.4) for c in centers[r.randrange(6)]]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 0, 1, "a", "b") for i, e in rows], SCHEMA)


def odd_rows():
    rows = vectors(70, 3)
    one = rows[0][1]
    rows += [rows[1]] * 3 + [(None, one), (None, rows[2][1]), (5, rows[6][1]), (900, one), (901, one), (902, [0.0] * 64),
             (903, [-0.001] * 64)]
    rows += [(910, None), (911, []), (912, one[:63]), (913, one + [0.0]), (914, [None] + one[1:]),
             (915, [math.nan] + one[1:]), (916, [math.inf] + one[1:])]
    # What a float column holds.
    import struct
    single = lambda v: v if v is None else struct.unpack("f", struct.pack("f", v))[0]
    return [(i, None if e is None else [single(v) for v in e]) for i, e in rows]


def test_like_by_hand(spark):
    rows = odd_rows()
    want, centroids = by_hand(rows)
    got = clusters(frame(spark, rows)).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted((tuple(r)[:3] for r in got), key=order) == sorted(want, key=order)
    assert {r.inertia for r in got} == {sum(d for _, _, d in want)}
    for r in got:
        assert r.cluster_inertia == sum(d for _, at, d in want if at == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_fewer_vectors_than_centroids_and_copies(spark):
    rows = vectors(3, 1) + [(7, [1.0] * 64)] * 5
    want, _ = by_hand([(i, e) for i, e in rows], k=40)
    got = clusters(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(want)
    assert len({r.cluster for r in got if r.vec_id == 7}) == 1


@pytest.mark.parametrize("k, rounds, size, scale", [(2, 0, 3, 1), (3, 4, 3, 10)])
def test_other_sizes(spark, k, rounds, size, scale):
    rows = [(i, [float((i * j) % 11 - 5) for j in range(1, 4)]) for i in range(30)]
    assigned, centroids = cluster(spark.createDataFrame(rows, "id long, v array<double>"), k, rounds, "id", "v", size, scale)
    want, known = by_hand([(i, [v * scale / 256 for v in e]) for i, e in rows], k, rounds, size)
    assert centroids == known and sorted(map(tuple, assigned.collect())) == sorted(want)


def test_nothing_to_cluster(spark):
    assert clusters(frame(spark, [])).collect() == []
    assert clusters(frame(spark, [(1, None), (2, [1.0])])).collect() == []
    with pytest.raises(ValueError, match="missing columns"):
        clusters(spark.createDataFrame([(1,)], "vec_id long"))


def test_components_beyond_a_long(spark):
    """A vector whose squares no long holds is left out; the largest that fit are exact."""
    most = float(LARGEST - 1) / 256
    rows = [(1, [most] * 64), (2, [-float(LARGEST) / 256] * 64), (3, [1e30] + [0.0] * 63), (4, [0.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in clusters(df, k=1, rounds=0).collect()}
    assert set(got) == {1, 2, 4}
    want, _ = by_hand([r for r in rows if r[0] != 3], 1, 0)
    assert sorted((i, r.distance) for i, r in got.items()) == sorted((i, d) for i, _, d in want)
