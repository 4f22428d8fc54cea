"""Hard negatives, mixing and whitening against brute force, on hot groups and on odd tables."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from drawdown.llm import hard_negatives, mixing, oracles, whitening
from drawdown.llm import queries as llm

VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, score INT, key STRING, x LONG"
DOCS = "doc_id LONG, text STRING, source STRING, src LONG, size STRING, key INT"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "k", 1) for i, v, label in rows], VECTORS)


def odd_vectors():
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], rng.randint(0, 9)) for i in range(120)]
    rows += [(i, [0.5] * 6, i % 3) for i in range(120, 160)]  # ties
    rows += [(200, None, 1), (201, [1.0] * 6, None), (202, [None] + [1.0] * 5, 2), (203, [float("nan")] * 6, 2)]
    rows += [(204, [float("-inf")] + [0.0] * 5, 2), (205, [1.0], 2), (206, [], 2), (None, [0.1] * 6, 2), (None, None, None)]
    return rows


def mined(rows):
    """Every anchor against every row, one row for each id."""
    usable = defaultdict(list)
    for i, v, label in rows:
        if None not in (i, v, label) and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v):
            q = [math.floor(256 * float(np.float32(c))) for c in v]
            usable[i].append(((label + 1) % 10 if i % 7 == 0 else label, q))
    one = {i: min(x) for i, x in usable.items()}
    out = []
    for a, (label, q) in one.items():
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, own) for i, (own, p) in one.items() if i != a)
        for s, i, own in [x for x in scored if x[2] == label][:5]:
            fit = [(-n, j) for n, j, other in scored if other != label and 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(a, i, k + 1, j, -s, n) for k, (n, j) in enumerate(fit)]
    return sorted(out)


def test_hard_negatives_on_odd_rows(spark):
    rows = odd_vectors()
    repeated = rows + rows[:30] + [(50, [0.25] * 6, 3), (50, [0.25] * 6, 2), (3, [0.9] * 6, 1)]
    for given in (rows, repeated):
        got = sorted(map(tuple, hard_negatives.mine(frame(spark, given)).collect()))
        assert got == mined(given) and got
    assert hard_negatives.mine(frame(spark, rows).limit(0)).count() == 0
    assert hard_negatives.mine(frame(spark, [(1, [0.5] * 6, 1)])).count() == 0


def test_hard_negatives_in_blocks_of_anchors(spark, sf_dir, monkeypatch):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = sorted(map(tuple, hard_negatives.mine(table).collect()))
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "CELLS", 700)
    assert sorted(map(tuple, hard_negatives.mine(table).collect())) == whole and whole


def test_zero_windows_take_zero_negatives(spark):
    rows = [(0, [0.0] * 6, 1), (9, [0.5] * 6, 2), (2, [0.5] * 6, 1), (3, [0.25] * 6, 3)]
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, rows)).collect())) == mined(rows) == [
        (0, 9, 1, 2, 0, 0), (0, 9, 2, 3, 0, 0)]


def test_packed_keys_sort_as_pairs():
    rng = np.random.default_rng(2)
    anchor, score, ids = (rng.integers(-3, 3, 300) * 10**k for k in (1, 17, 3))
    keys = hard_negatives.pack(anchor, score, 1, ids)
    want = sorted(zip(anchor.tolist(), (-score).tolist(), ids.tolist()))
    import pyarrow as pa

    a, s, kind, i = hard_negatives.unpack(pa.array(sorted(keys), pa.binary()))
    assert list(zip(a, [-x for x in s], i)) == want and set(kind) == {1}


def test_products_are_exact_beyond_doubles():
    a = np.array([[2.0**30 + 1, 3.0]])
    assert hard_negatives.products(a, a).tolist() == [[(2**30 + 1) ** 2 + 9]]


def oracle(sf_dir, name):
    base = duckdb.connect()
    for table in ("documents", "embeddings"):
        base.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return base.execute(oracles.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_mixing"])
def test_registered_query_equals_its_sql(spark, sf_dir, name):
    found = llm.queries()[name](spark, sf_dir)
    want = oracle(sf_dir, name)
    assert found.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want.fetchall(), key=str)


def mixture(spark, rows, again=False):
    """Rows of the mix after the checks that hold for every table."""
    documents = spark.createDataFrame([(i, t, s, 5, "z", 2) for i, t, s in rows], DOCS)
    got = mixing.mix(documents).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), len((t or "").split())) for i, t, _ in rows)
    assert all(0 <= r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0) for r in got)
    if again:
        assert sorted(map(tuple, mixing.mix(documents.repartition(5)).collect()), key=str) == sorted(map(tuple, got), key=str)
    return got


def test_mix_meets_targets_with_a_hot_and_a_short_source(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 300), "a") for i in range(900)]
    rows += [(2000 + i, "w " * rng.randint(1, 300), "b") for i in range(600)]
    rows += [(4000 + i, "w " * rng.randint(1, 40), "ü") for i in range(300)] + [(5000, "w " * 20000, None), (5001, None, None)]
    got = mixture(spark, rows, again=True)
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    weight = {"a": 1, "b": 2, "ü": 3, None: 1}
    low, high = 0.0, float(sum(size.values()))
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * size[s], weight[s] * level) for s in size) < sum(size.values()) else (low, level)
    source = {i: s for i, _, s in rows}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert r.source_size == size[source[r.doc_id]]
    for s in size:
        assert target[s] == pytest.approx(min(3 * size[s], weight[s] * high), rel=1e-6)
        assert abs(taken[s] - target[s]) <= (40 if s else 10000)
    assert taken["ü"] == 3 * size["ü"]


def test_more_documents_than_candidates_are_searched_by_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CANDIDATES", 20)
    monkeypatch.setattr(mixing, "BITS", 4)
    monkeypatch.setattr(mixing, "LEVELS", 13)
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(1, 30), "ab"[i % 3 == 0]) for i in range(3000)]
    got, source = mixture(spark, rows), {i: s for i, _, s in rows}
    for s in "ab":
        own = [r for r in got if source[r.doc_id] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 15


def test_mix_of_odd_and_empty_tables(spark):
    rows = [(1, None, None), (1, "", "x"), (None, "a b", "x"), (None, "a b", "x"), (7, "a\x0bb c", None), (7, "a\x0bb c", None)]
    got = mixture(spark, rows)
    assert sum(r["size"] for r in got) == 10
    assert mixture(spark, [(1, None, "x"), (2, " \n", "y")])[0].target == 0
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_rates_are_the_entropy_optimum(spark):
    """No other rates of the same words are nearer to 1 in relative entropy (checked along feasible directions)."""
    sizes = [3, 5, 8, 13, 21, 34]
    cells = spark.createDataFrame([(1, s, 1) for s in sizes], "src LONG, size LONG, n LONG")
    source = spark.createDataFrame([(1, sum(sizes), 6, False, 40.0)], "src LONG, source_size LONG, n_docs LONG, full BOOLEAN, target DOUBLE")
    state = mixing.balance(cells, source, 1)
    w = [r.w for r in cells.join(state, "src").select("size", mixing.rate(*[cells["size"], state["lam"], state["mean"], state["full"]]).alias("w")).orderBy("size").collect()]
    assert sum(a * b for a, b in zip(w, sizes)) == pytest.approx(40, rel=1e-8)
    cost = lambda v: sum(x * math.log(x) - x + 1 for x in v)
    for i in range(5):
        for step in (1e-4, -1e-4):
            other = list(w)
            other[i] += step / sizes[i]
            other[i + 1] -= step / sizes[i + 1]
            assert cost(other) > cost(w)


def whitened(rows, keep=8):
    """x, centred rows and the eigenvalues of their covariance, by numpy on one machine."""
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in r] for r in rows], dtype=np.int64)
    n, sums = len(x), x.sum(0)
    a = (n * x - sums) / n
    e, v = np.linalg.eigh(a.T @ a / n)
    return [sum(int(q) ** 2 for q in n * r - sums) for r in x], a, e[::-1], v[:, ::-1]


def test_whitening_equals_numpy(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = llm.queries()["op13_whitening"](spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    deviation, a, e, v = whitened(table.toPandas().sort_values("vec_id").embedding.tolist())
    w = got.whitened.to_numpy().reshape(len(a), 8)
    want = a @ v[:, :8] / np.sqrt(e[:8])
    assert np.abs(w - want * np.sign((w * want).sum(0))).max() < 1e-9
    assert got.deviation.tolist() == [d for d in deviation for _ in range(8)] and set(got.n) == {len(a)}
    assert np.abs(got.explained.to_numpy()[:8] - e[:8] / e.sum()).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_ill_conditioned_and_short_rank_rows(spark):
    rng = np.random.default_rng(0)
    for rows in (rng.normal(size=(200, 6)) * [4000.0, 100.0, 1.0, 1.0, 0.02, 0.01],
                 np.floor(rng.normal(size=(60, 2)) * 40) @ np.floor(rng.normal(size=(2, 6)) * 5) / 1024):
        spark_rows = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], "vec_id LONG, embedding ARRAY<DOUBLE>")
        got = whitening.whiten(spark_rows.repartition(7)).toPandas()
        _, _, e, _ = whitened(rows)
        rank = int((e > 1e-15 * e[0]).sum())
        assert got.component.max() == min(8, rank) and len(got) == len(rows) * rank
        assert got.identity_error.iloc[0] < 1e-6
        assert got.sort_values(["vec_id", "component"]).explained.to_numpy()[:rank] == pytest.approx(e[:rank] / e.sum(), rel=1e-4)


def test_whitening_of_odd_and_empty_tables(spark):
    rows = odd_vectors()
    got = whitening.whiten(frame(spark, rows + rows[:5])).toPandas()
    usable = sum(v is not None and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v) for _, v, _ in rows)
    assert len(got) == 6 * (usable + 5) and set(got.n) == {usable + 5} and got.vec_id.isna().sum() == 6
    assert whitening.whiten(frame(spark, rows).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, [0.5] * 6, 1)] * 3)).count() == 0
    far = whitening.whiten(frame(spark, [(1, [1e12] * 6, 1), (2, [-1e12] * 6, 1)])).collect()
    assert [r.deviation for r in far] == [None, None] and {round(abs(r.whitened), 9) for r in far} == {1.0}
