"""Product codes against plain Lloyd rounds; posting lists against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.llm import ann, lists, queries, topk, vector_codes
from foliomill.session import cut

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=8, k=16, rounds=6, scale=4096):
    """(vec_id, label, code, error) of each row that takes part, and the codebooks, by loops over whole numbers."""
    kept = [(i, [int(np.floor(float(np.float32(x)) * scale)) for x in v], label) for i, v, label in rows if v is not None and len(v) and None not in v and np.isfinite(v).all()]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[r[1][p * w : (p + 1) * w] for p in range(parts)] for r in kept]
    books = [[cut[j][p] for j in range(min(k, len(kept)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(p, x[p])[1] for x in cut]
            for j in range(len(books[p])):
                mine = [x[p] for x, o in zip(cut, of, strict=True) if o == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for (i, _, label), x in zip(kept, cut, strict=True):
        found = [nearest(p, x[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    return out, books


def vectors(n=160, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim)) / 3
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + rng.normal(size=dim) / 9], i % 4) for i in range(n)]
    rows += [(n + i, rows[3][1], None) for i in range(60)]  # a hot vector
    rows += [(n + 70, [0.0] * dim, None), (n + 71, None, 1), (n + 72, [1.0] * (dim - 1) + [None], 1), (n + 73, [float("nan")] * dim, 1), (n + 74, [float("inf")] * dim, 2), (n + 75, [], 2)]
    return [*rows, (7, rows[9][1], 3), (7, rows[9][1], 3), (None, rows[11][1], 3)]


def test_codes_query_against_loops(spark, tmp_path):
    rows = vectors()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, books = plain_codes(rows)
    labels = {}
    for _, label, _, error in want:
        labels[label] = labels.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    got = [(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in queries.op12_vector_codes(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(i, code, error, labels[label], digest) for i, label, code, error in want], key=str)


@pytest.mark.parametrize("values", [2, 3, 50])
def test_codes_with_ties(spark, values):
    """Components of few values: many parts are equally near to several entries."""
    rng = np.random.default_rng(values)
    rows = [(i, (rng.integers(0, values, 16) / 4096).tolist(), 0) for i in range(120)]
    want, books = plain_codes(rows)
    codes = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert codes.books.tolist() == books
    assert sorted((r.vec_id, r.label, r.code, r.error) for r in codes.rows.collect()) == sorted(want)


def test_bounds_spare_distances(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 8))
    rows = [(i, (centres[i % 16] + rng.normal(size=8) / 50).tolist(), 0) for i in range(4000)]
    codes = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=1)
    assert codes.scanned[0] == 4000 * 16
    assert sum(codes.scanned[1:]) < 0.5 * 5 * 4000 * 16


def test_codes_of_large_components_are_exact(spark):
    rows = [(i, [float((i * 7919) % 1000), float(-i * 31.0)], 0) for i in range(50)] + [(99, [1e30, 0.0], 0)]
    want, books = plain_codes(rows[:-1], parts=2, k=4)
    codes = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=4)
    assert codes.books.tolist() == books
    assert sorted((r.vec_id, r.label, r.code, r.error) for r in codes.rows.collect()) == sorted(want)  # 99 takes no part


def test_codes_odd_tables(spark):
    odd = spark.createDataFrame([(1, [0.5, 0.25, 1.0], 3, 4, 5), (2, [0.5, 0.25], 6, 7, 8), (3, [0.5, 0.5, 1.0], 9, 9, 9)], "vec_id long, embedding array<double>, `a.b` int, `c``d` int, Code int")
    codes = vector_codes.compress(odd, parts=2)
    assert codes.rows.columns == ["vec_id", "a.b", "c`d", "code", "error"]
    assert sorted(map(tuple, codes.rows.collect())) == [(1, 3, 4, "0000", 0), (3, 9, 9, "0100", 0)]  # filled up with zeros; the usual length is 3
    none = vector_codes.compress(odd.where("vec_id > 5"))
    assert none.rows.columns == codes.rows.columns and none.rows.count() == 0 and none.scanned == []


def brute(rows, k, every=20):
    """Each query's k best (score, id), by all inner products."""
    kept = [(i, np.float32(v).astype(float)) for i, v, *_ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    asked = {}
    for i, v in kept:
        if i % every == 0:
            asked[i] = min(asked.get(i, v.tolist()), v.tolist())
    return {q: sorted((-float(np.dot(v, x)), i) for i, x in kept if i != q)[:k] for q, v in asked.items()}


def recall(got, want, k):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert found.keys() == {q for q, best in want.items() if best}
    shares = []
    for q, best in want.items():
        rows = sorted(found.get(q, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, min(k, len(best)) + 1))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        shares.append(np.mean([r.score >= -best[-1][0] - 1e-9 for r in rows]) if rows else 1.0)
    return float(np.mean(shares))


def test_posting_lists_query(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).tolist(), 0) for i in range(1500)]
    hot = rng.normal(size=24)
    rows += [(1500 + i, (hot + rng.normal(size=24) / 100).tolist(), 1) for i in range(700)]  # a third of all
    rows += [(2300, [0.0] * 24, 0), (2320, None, 0), (2340, [1.0, None], 0), (2360, [float("inf")] * 24, 0), (2380, [1.0, 2.0], 0), (None, rows[0][1], 0), (40, rows[41][1], 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_posting_lists(spark, str(tmp_path)).collect()
    assert recall(got, brute([r for r in rows if r[0] != 2380], 20), 20) >= 0.95
    exact = {i: np.float32(v).astype(float) for i, v, _ in rows if i is not None and i != 40 and v is not None and None not in v}
    assert all(abs(r.score - float(np.dot(exact[r.query_id], exact[r.vec_id]))) < 1e-12 for r in got if 40 not in (r.query_id, r.vec_id))


def test_vectors_of_many_lengths_and_ties(spark):
    """Norms differ: the largest product isn't the least angle.  Equal vectors are ranked by id."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=12) * rng.uniform(0.2, 3)).tolist()) for i in range(900)] + [(2000 + i, [2.0] * 12) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), k=10, ask=1.3, per_list=32).collect()
    want = brute([(i, v, 0) for i, v in rows], 10)
    # brute() rounds to float; scores of doubles differ by as much
    assert recall([r for r in got], {q: [(s + 1e-5, i) for s, i in best] for q, best in want.items()}, 10) >= 0.9
    tied = {}
    for r in got:
        if r.query_id >= 2000 and r.score == 48.0:
            tied.setdefault(r.query_id, []).append(r.vec_id)
    assert len(tied) == 15 and all(ids == sorted(ids) and ids[0] in (2000, 2001) for ids in tied.values())


def test_a_query_that_is_a_centroid_finds_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), per_list=2).groupBy("query_id").count().collect()
    assert len(got) == 150 and all(r["count"] == 20 for r in got)


def test_search_of_odd_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 3), (1, [0.5, 0.5], 4)], "vec_id long, embedding array<double>, `a.b` int")
    asked = df.where("vec_id = 0")
    assert [tuple(r) for r in ann.nearest(df, asked).collect()] == [(0, 1, 1, 0.5)]
    assert ann.nearest(df.where("vec_id > 5"), asked).collect() == [] == ann.nearest(asked, asked).collect()
    huge = spark.createDataFrame([(0, [1e300, 0.0]), (1, [1e-300, 1.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in ann.nearest(huge, huge.where("vec_id = 0")).collect()] == [(2, 3e300), (1, 1.0)]


def test_graph_finds_what_scans_find():
    rng = np.random.default_rng(3)
    centroids = lists.balanced_centroids(rng.normal(size=(6000, 10)), 500)
    points = rng.normal(size=(300, 10))
    ids, dist = lists.walk(points, centroids, *lists.graph(centroids), 1.1, 16)
    scan = lists.squares(points, centroids)
    assert (ids[:, 0] == scan.argmin(axis=1)).mean() > 0.97
    assert np.allclose(dist, np.sqrt(np.take_along_axis(scan, ids.astype(int), axis=1)))


def test_copies_of_queries_for_each_block_are_not_broadcast(spark):
    vectors = cut(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)], "vec_id long, embedding array<double>"), "vectors")
    blocks = topk._blocks(topk.quantise(vectors, "vec_id", "embedding"), 8)
    grid = topk._grid(blocks, blocks.withColumn("block", F.monotonically_increasing_id()), 3)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_topk_of_components_of_any_bytes(spark):
    rng = np.random.default_rng(3)
    for largest in (1, 127, 129, 65534, 65540, 2.0**40):
        v = rng.uniform(-largest, largest, (60, 3))
        v[0, 0] = -largest
        df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
        whole = [[int(y) for y in x] for x in np.floor(256 * v)]
        score = lambda a, b, w=whole: sum(x * y for x, y in zip(w[a], w[b], strict=True))
        want = [(q, r + 1, c, min(topk.MOST, score(q, c))) for q in range(0, 60, 7) for r, c in enumerate(sorted((c for c in range(60) if c != q), key=lambda c, q=q: (-max(-topk.MOST, min(topk.MOST, score(q, c))), c))[:3])]
        got = topk.top_k(df, df.where("vec_id % 7 = 0"), k=3, block=16, query_block=4).orderBy("query_id", "rank").collect()
        assert [tuple(r) for r in got] == want, largest


def test_a_query_goes_once_to_each_block_of_lists(spark, monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(600, 8))
    df = spark.createDataFrame([(i, [float(y) for y in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "BLOCK", 100, raising=False)
    monkeypatch.setattr(ann, "ASKING", 16, raising=False)
    sizes = {}

    def counted(rows, name, **more):
        out = cut(rows, name, **more)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(ann, "cut", counted)
    got = ann.nearest(df, df.where("vec_id % 10 = 0"), k=5, ask=100.0, per_list=8).collect()
    scores = v @ v.T
    want = {(q, r + 1, c) for q in range(0, 600, 10) for r, c in enumerate(sorted((c for c in range(600) if c != q), key=lambda c, q=q: -scores[q, c])[:5])}
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == want
    assert sizes["ann-asks"] <= 60 * -(-sizes["ann-postings"] // 100)  # not queries times lists
