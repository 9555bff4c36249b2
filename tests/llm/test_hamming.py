import numpy as np
import pytest

from lagloom.llm import hamming
from lagloom.llm.hamming import masks, segments, top_k
from lagloom.llm.queries import ORACLES, op2_exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed, dims=40, count=300):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, dims))
    found = centres[random.integers(0, 12, count)] + 0.6 * random.normal(size=(count, dims))
    found[: count // 3] = found[0]  # one common vector
    order = random.permutation(count)
    return [(int(i), [float(x) for x in found[k]], 0) for i, k in enumerate(order)]


def brute(rows, dims, k):
    codes = {i: np.array([x is not None and x >= 0 for x in v]) for i, v, _ in rows if v and len(v) == dims and i is not None}
    found = []
    for q in codes:
        if q % 100 == 0:
            near = sorted((int((codes[q] != c).sum()), i) for i, c in codes.items())[:k]
            found += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(near)]
    return sorted(found)


@pytest.mark.parametrize("k, part", [(10, 50_000), (3, 20)])
def test_neighbours_are_those_of_brute_force(spark, monkeypatch, k, part):
    monkeypatch.setattr(hamming, "PART_CODES", part)
    monkeypatch.setattr(hamming, "COMPARE", 7)
    rows = vectors(k)
    rows += [(1000, None, 1), (1100, [], 1), (1200, [1.0], 1), (1300, [None] * 40, 1), (None, [1.0] * 40, 1), rows[5]]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as code", "2 as id")
    found = top_k(frame, frame.where("vec_id % 100 = 0"), k).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 40, k)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, -1.0], 0), (1, [-1.0, -1.0], 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in top_k(frame, frame.where("vec_id = 0")).collect()) == [(0, 1, 0, 0), (0, 2, 1, 1)]
    assert top_k(frame.limit(0), frame).count() == 0
    assert top_k(frame, frame.limit(0)).count() == 0


def test_masks_and_segments():
    assert sorted(masks(4, 2).tolist()) == [3, 5, 6, 9, 10, 12]
    assert masks(3, 0).tolist() == [0] and not len(masks(2, 3)) and not len(masks(2, -1))
    cut = segments(64, 50_000)
    assert cut[0][0] == 0 and cut[-1][1] == 64 and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))


def test_query_against_its_sql(spark, agrees):
    agrees("op2_exact_top_k", op2_exact_top_k, ORACLES)
