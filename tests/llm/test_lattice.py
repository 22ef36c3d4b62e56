"""Links and components against all pairs."""
import numpy as np

from tidemark.llm.lattice import cells, near_vectors, nearest

from .conftest import SF

VECTORS = "vec_id bigint, embedding array<float>, label int"


def by_hand(rows, least=0.93):
    unit = []
    for _, v, label in rows:
        x = None if v is None or label is None or any(c is None for c in v) else np.array(v, np.float32).astype(float)
        unit.append(None if x is None or not len(x) or not np.isfinite(x).all() or not (n := np.linalg.norm(x)) else x / n)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((r[0], links[i], c, r[0] == c if r[0] is not None else c is None))
    return out


def collected(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_generated_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in df.collect()]
    assert collected(near_vectors(df)) == sorted(by_hand(rows), key=str)


def test_recall_at_the_limit():
    rnd = np.random.default_rng(3)
    for size, cosine in ((64, 0.93), (64, 0.95), (16, 0.93), (300, 0.93)):
        x = rnd.standard_normal((3000, size))
        x /= np.linalg.norm(x, axis=1)[:, None]
        y = rnd.standard_normal((3000, size))
        y -= (x * y).sum(1)[:, None] * x
        y = cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1)[:, None]
        label, met = np.zeros(3000), np.zeros(3000, bool)
        for table in range(6):
            a, b = cells(x, label, table), cells(y, label, table)
            met |= (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)
        assert met.mean() > 0.985


def test_nearest_lattice_points():
    """Against all points of E8 in a box around the origin."""
    rnd = np.random.default_rng(1)
    grid = np.stack(np.meshgrid(*[[-1, 0, 1]] * 8, indexing="ij"), -1).reshape(-1, 8).astype(float)
    half = np.stack(np.meshgrid(*[[-0.5, 0.5]] * 8, indexing="ij"), -1).reshape(-1, 8)
    points = np.concatenate([g[g.sum(1) % 2 == 0] for g in (grid, half)])
    x = rnd.uniform(-0.5, 0.5, (200, 8))
    far = ((x[:, None, :] - points[None]) ** 2).sum(2)
    near = nearest(x, 3)
    assert (near % 2 == near[:, :, :1] % 2).all() and (near.sum(2) % 4 == 0).all()
    mine = ((x[:, None, :] - near / 2) ** 2).sum(2)
    assert np.allclose(mine[:, 0], far.min(1)) and (np.diff(mine, axis=1) >= -1e-12).all()


def test_odd_rows(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    base = rnd.standard_normal((4, 16))
    rows = [(i, (base[i % 4] + 0.12 * rnd.standard_normal(16)).astype(np.float32).tolist(), i % 2) for i in range(60)]
    rows += [(100, None, 1), (101, [0.0] * 16, 1), (102, [1.0, None] + [0.0] * 14, 1), (103, [float("nan")] * 16, 1), (104, [float("inf")] * 16, 1),
             (105, rows[0][1], None), (106, [], 1), (107, rows[0][1][:8], 0), (None, rows[0][1], 0), (None, None, None),
             (108, rows[3][1], 1), (108, rows[3][1], 1), (-5, [2 * x for x in rows[3][1]], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    assert collected(near_vectors(df)) == sorted(by_hand(rows), key=str)
    monkeypatch.setattr("tidemark.llm.lattice.CELL", 3)  # every cell in chunks
    assert collected(near_vectors(df)) == sorted(by_hand(rows), key=str)
    assert near_vectors(df.limit(0)).collect() == []
