import numpy as np
import pytest

from levyflow.llm.caps import CapCode, cap_components, codes_for, _unit
from tests.llm.tables import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.95):
    able = [r for r in rows if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [_unit(np.array([r[1]], dtype=np.float64))[0] for r in able]
    links = [[j for j in range(len(able)) if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
             for i in range(len(able))]
    out = []
    for i in range(len(able)):
        seen, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        least = min(able[j][0] for j in seen)
        out.append((able[i][0], len(links[i]), least, able[i][0] == least))
    rest = [r for r in rows if not any(r is a for a in able)]
    return sorted(out + [(r[0], 0, r[0], True) for r in rest], key=repr)


def vectors(seed=5, groups=12, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(dim)
        for i in range(rng.integers(1, 9)):
            noise = rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.25])
            rows.append((g * 100 + i, (centre + noise).astype(np.float32).tolist(), g))
    rows += [(r[0] + 5000, r[1], 0) for r in rows[:6]]  # copies
    rows += [(9000, [0.0] * dim, 1), (9001, None, 1), (9002, [], 1), (9003, [1.0, None] + [0.0] * (dim - 2), None),
             (9004, [float("nan")] * dim, 1), (9005, [float("inf")] * dim, 1), (None, rows[0][1], 1),
             (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1), (9006, [1.0, 2.0], 1), (9008, [3.0], 1), (9009, [1e-30] * dim, 1)]
    return rows


@pytest.mark.parametrize("chunk", [1024, 3])
def test_same_links_as_all_pairs(spark, chunk):
    rows = vectors()
    df = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = [tuple(r) for r in cap_components(df, chunk=chunk).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_doubles_and_no_rows(spark):
    pair = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [1.0, 1e-12, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[1:3] for r in cap_components(pair).collect()] == [(1, 1), (1, 1)]
    assert cap_components(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("rows", [10_000, 1_000_000])
def test_pairs_at_the_limit_share_a_filter(rows):
    code, rng, n = CapCode(64, codes_for(rows), 20), np.random.default_rng(3), 1500
    x, r = _unit(rng.standard_normal((n, 64))), rng.standard_normal((n, 64))
    r = _unit(r - (r * x).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * r
    missed = sum(not len(np.intersect1d(a, b)) for a, b in zip(code.decode(x), code.decode(y)))
    assert missed <= 0.004 * n
    assert all(len(f) >= 20 for f in code.decode(x))


@pytest.mark.parametrize("cosine", [0.9501, 0.96])
def test_planted_pairs_are_found(spark, cosine):
    rng, n = np.random.default_rng(int(cosine * 1e4)), 10_000
    x, r = _unit(rng.standard_normal((n, 64))), rng.standard_normal((n, 64))
    r = _unit(r - (r * x).sum(axis=1, keepdims=True) * x)
    y = cosine * x + np.sqrt(1 - cosine**2) * r
    rows = [(2 * i + j, v.tolist()) for i, pair in enumerate(zip(x, y)) for j, v in enumerate(pair)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8).cache()
    found = {turns: cap_components(df, turns=turns).where("n_links > 0 and vec_id % 2 = 1 and component_id = vec_id - 1").count()
             for turns in (1, 2)}
    df.unpersist()
    assert found[1] >= 0.999 * n and found[2] == n


@pytest.mark.parametrize("turns", [2, 3])
def test_turns_change_no_link(spark, turns):
    rows = vectors(seed=turns)
    got = [tuple(r) for r in cap_components(spark.createDataFrame(rows, SCHEMA), turns=turns).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_decoded_lists_are_all_filters_above_the_edge():
    code, rng = CapCode(32, 64, 10), np.random.default_rng(4)
    x = _unit(rng.standard_normal((50, 32)))
    first, second = code._scores(x)
    for f, a, b in zip(code.decode(x), first, second):
        sums = (a[:, None] + b[None, :]).ravel()
        assert set(np.flatnonzero(sums >= code.edge)) <= set(f.tolist())
        assert sums[f].min() >= min(code.edge, np.sort(sums)[-10]) - 1e-9
