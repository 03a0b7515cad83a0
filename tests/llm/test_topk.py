import math

import pytest
from pyspark.sql import functions as F

from mortar.llm.topk import blocks_of, build_index, cells_of, pairs_of, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in clean if i % every == 0}):
        best = {}
        for i, v in clean:
            if i == q:
                continue
            for j, w in clean:
                if j == q:
                    score = sum(a * b for a, b in zip(v, w))
                    best.setdefault((j, i), []).append(score)
        ranked = sorted((-s, i) for (_, i), scores in best.items() for s in scores)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return out


def vectors(n, dim, seed):
    import numpy as np

    random = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in random.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("seed,slab,block", [(0, 16, 4), (1, 1000, 256), (2, 7, 1)])
def test_against_brute_force(spark, seed, slab, block):
    rows = vectors(230, 6, seed)
    rows += [(300 + i, rows[0][1]) for i in range(60)]  # a very common vector: ties
    rows += [(400, None), (450, [0.1, None, 0.2]), (500, [math.nan] * 6), (550, [math.inf] * 6), (600, [0.0] * 6), (650, [0.5, -0.5]), (700, []), (None, [1.0] * 6), (-50, [0.3] * 6), (651, [100.0] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in top_k(df, slab=slab, query_block=block).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, 5, 50)


def test_few_vectors_and_clashing_columns(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (50, [0.5, 0.5], 1), (3, [-1.0, 0.0], 1)], SCHEMA)
    for name in ("id", "v", "pivot", "slab", "score", "rank"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted(tuple(r) for r in top_k(df).collect())
    assert got == [(0, 1, 50, 32768), (0, 2, 3, -65536), (50, 1, 0, 32768), (50, 2, 3, -32768)]


def test_no_usable_vectors(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert top_k(spark.createDataFrame([(0, None, 1), (50, [math.nan], 1)], SCHEMA)).count() == 0
    assert top_k(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)).count() == 0


def clusters(n, dim, seed):
    """Vectors of about one length around 12 far centres."""
    import numpy as np

    random = np.random.default_rng(seed)
    centres = 8 * random.normal(size=(12, dim))
    found = centres[random.integers(0, 12, n)] + 0.05 * random.normal(size=(n, dim))
    return [(i, [float(np.float32(x)) for x in v / np.linalg.norm(v) * 4]) for i, v in enumerate(found)]


def test_clusters_against_brute_force(spark):
    rows = clusters(400, 5, 3)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in top_k(df, every=20, slab=9, query_block=3).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, 5, 20)


def test_blocks_go_only_to_cells_they_reach(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in clusters(3000, 5, 4)], SCHEMA).repartition(4)
    slabs, pivots, dim, longest = build_index(df, "vec_id", "embedding", 16, 20)
    placed, cells = cells_of(slabs)
    # as many as the root of the vectors, beside one for each pivot and partition
    assert 3000**0.5 <= len(cells["cell"]) <= slabs.count()
    blocks = blocks_of(slabs, cells, pivots, dim, longest, 5, 50, 4).toPandas()
    of = {(c, p): (a, b) for c, p, a, b in zip(*(cells[n] for n in ("cell", "pivot", "d_min", "d_max")))}
    assert all(r.q_min <= of[r.cell, r.pivot][1] and r.q_max >= of[r.cell, r.pivot][0] for r in blocks.itertuples())
    n_blocks = blocks["q_ids"].nunique()
    assert len(blocks) < 0.5 * n_blocks * len(cells["cell"])
    # and every slab that a block reaches is met
    listed = slabs.select("slab", "pivot", "d_min", "d_max").collect()
    near = {(r.q_ids, s.slab) for r in blocks.itertuples() for s in listed if s.pivot == r.pivot and r.q_min <= s.d_max and r.q_max >= s.d_min}
    pairs = pairs_of(blocks_of(slabs, cells, pivots, dim, longest, 5, 50, 4), placed).select("q_ids", "slab").collect()
    assert len(pairs) == len(set(map(tuple, pairs))) == len(near)


def test_cells_grow_with_the_table(spark):
    n = []
    for rows in (500, 8000):
        df = spark.createDataFrame([(i, v, 0) for i, v in clusters(rows, 3, 5)], SCHEMA).repartition(2)
        slabs, *_ = build_index(df, "vec_id", "embedding", 4, 4)
        n.append(len(cells_of(slabs)[1]["cell"]))
    assert n[1] >= 2.5 * n[0]
