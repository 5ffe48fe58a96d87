"""The vector operators against plain versions, on the given tables and on
planted groups, odd rows and empty tables."""

import hashlib
import math

import numpy as np
import pytest

import __spark_entry__ as E
from footlink.llm import multi_index, vector_codes

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, node long, dim string, weight string, cell int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", "y", 1) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def planted(spark):
    """Groups of near copies (one of 150, two sizes of noise), exact copies,
    the same vectors under other labels, and unrelated vectors."""
    rng = np.random.default_rng(3)
    rows, i = [], 0

    def add(v, label):
        nonlocal i
        rows.append((i * 7 % 3001, [float(np.float32(x)) for x in v], label))
        i += 1

    for label in (0, 1):
        for _ in range(300):
            add(rng.standard_normal(64), label)
        for size, noise in ((150, 0.08), (40, 0.12), (2, 0.1), (3, 0.14)):
            c = rng.standard_normal(64)
            for _ in range(size):
                add(3 * (c + noise * rng.standard_normal(64)), label)
            add(c, label)
            add(c, 1 - label)
            for _ in range(5):
                add(c, label)
    return rows


def plain_links(rows, cosine=0.98):
    """Per row position: partners; smallest id reachable."""
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    hit = (x @ x.T >= cosine) & (label[:, None] == label)
    np.fill_diagonal(hit, False)
    low = np.array([r[0] for r in rows])
    while True:
        new = np.minimum(low, np.where(hit, low[None, :], 1 << 40).min(1))
        if (new == low).all():
            return hit.sum(1), low
        low = new


@pytest.mark.parametrize("block", [1024, 16])
def test_multi_index_finds_the_links(spark, planted, block, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "PER_CELL", 20)
    n, low = plain_links(planted)
    got = {r.vec_id: r for r in multi_index.near_duplicates(frame(spark, planted)).collect()}
    want = {r[0]: (int(a), int(b)) for r, a, b in zip(planted, n, low, strict=True)}
    found = sum(r.n_links for r in got.values()) / n.sum()
    assert found >= 0.995 and all(got[i].n_links <= want[i][0] for i in want)
    assert np.mean([got[i].component_id == want[i][1] for i in want]) >= 0.99
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_grid_visits_are_the_cells_within_the_bound():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 10))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = multi_index.Grid(x, 6, 0.9, 0.99)
    home, row, cell = grid.visits(x)
    (own1, m1), (own2, m2) = grid.margins(x)
    want = {(r, i * grid.k + j) for r in range(len(x)) for i in range(grid.k) for j in range(grid.k)
            if m1[r, i] + m2[r, j] <= grid.bound and i * grid.k + j > home[r]}
    assert set(zip(row.tolist(), cell.tolist(), strict=True)) == want and len(want) == len(row)
    assert (home == own1 * grid.k + own2).all()
    for (own, m), h, book in zip(grid.margins(x), grid.halves(x), grid.books, strict=True):
        d = ((h[:, None] - book) ** 2).sum(2)
        assert (own == d.argmin(1)).all() and (m[np.arange(len(x)), own] == 0).all()


def test_stars_follow_components():
    linked = np.zeros((7, 7), bool)
    for a, b in ((0, 3), (3, 5), (1, 6)):
        linked[a, b] = linked[b, a] = True
    assert multi_index.stars(linked).tolist() == [0, 1, 2, 0, 4, 0, 1]


def test_multi_index_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0),
            (8, [NAN, 1.0, 1.0], 0), (9, [INF, 1.0, 1.0], 0), (10, [None, 1.0, 1.0], 0), (None, v, 0), (None, [3.0, -1.0, 0.0], 1),
            (11, [1.0, 2.0, 3.0, 0.0], 0), (12, v, 0), (12, v, 0), (13, [1e-38, 0.0, 0.0], 2), (14, [3e38, 0.0, 0.0], 2)]
    got = {}
    for r in multi_index.near_duplicates(frame(spark, rows)).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(4, 1, True)] and got[2] == [(4, 1, False)] and got[12] == [(4, 1, False)] * 2
    assert all(got[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert sorted(got[None], key=str) == [(0, None, True), (4, 1, False)]
    assert got[13] == [(1, 13, True)] and got[14] == [(1, 13, False)]
    assert multi_index.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def plain_codes(x, parts=8, entries=16, rounds=6):
    """Lloyd rounds in plain integers; x: kept vectors in order of vec_id."""
    x = x.reshape(len(x), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assign():
        return np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(2).argmin(1) for p in range(parts)], 1)

    for _ in range(rounds):
        code = assign()
        for p in range(parts):
            for j in range(books.shape[1]):
                if (code[:, p] == j).any():
                    books[p, j] = x[code[:, p] == j, p].sum(0) // (code[:, p] == j).sum()
    code = assign()
    error = sum(((x[:, p] - books[p][code[:, p]]) ** 2).sum(1) for p in range(parts))
    return code, error, hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def test_vector_codes_equal_plain_rounds(spark):
    rows = sorted(spark.read.parquet(f"{SF}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    code, error, sha = plain_codes(np.floor(4096 * np.array([r.embedding for r in rows], float)).astype(int))
    got = {r.vec_id: r for r in E.queries()["op12_vector_codes"](spark, SF).collect()}
    total: dict = {}
    for r, e in zip(rows, error.tolist(), strict=True):
        total[r.label] = total.get(r.label, 0) + e
    assert len(got) == len(rows)
    for r, c, e in zip(rows, code.tolist(), error.tolist(), strict=True):
        assert (got[r.vec_id].code, got[r.vec_id].error, got[r.vec_id].label_error, got[r.vec_id].codebooks_sha256) == (
            "".join(f"{v:02x}" for v in c), e, total[r.label], sha)


@pytest.mark.parametrize("b", [0, 1, 2, 4, 9, 15])
def test_bounds_never_change_a_result(b):
    """Moving entries, many ties: the settled state equals a full scan."""
    rng = np.random.default_rng(b)
    x = rng.integers(-6, 7, (4000, 3))
    entries = rng.integers(-6, 7, (16, 3))
    state, saved = vector_codes.scan(x, entries, b), 0
    for step in range(6):
        new = entries + rng.integers(-2, 3, entries.shape) * (rng.random((16, 1)) < 0.5) // (step + 1)
        drift = np.sqrt(((new - entries) ** 2).sum(1).astype(float)) * (1 + 1e-12)
        entries, width = new, max(b - step // 2, 0)
        state = vector_codes.moved(state, drift, width)
        need = vector_codes.settle(x, entries, state)
        saved += (need <= width).sum()
        d = vector_codes.distances(x, entries)
        assert (state.code == d.argmin(1)).all()
        far = np.sqrt(d)
        rows = np.arange(len(x))
        assert (state.upper >= far[rows, state.code]).all()
        assert (state.lower <= far[rows[:, None], state.near]).all()
        rest = np.ones(d.shape, bool)
        rest[rows, state.code] = False
        rest[rows[:, None], state.near] = False
        assert (np.where(rest, far, np.inf).min(1) >= state.outer).all()
    assert saved > len(x)


def test_width_follows_need():
    need = np.zeros(17, int)
    need[[0, 2, 5]] = 900, 95, 5
    assert vector_codes.next_width(need, 4, 16) == 2
    need[[2, 3]] = 0, 95
    assert vector_codes.next_width(need, 4, 16) == 3
    need[[3, 5]] = 0, 100
    assert vector_codes.next_width(need, 4, 16) == 4


def test_vector_codes_odd_rows(spark):
    rng = np.random.default_rng(9)
    good = [(i, [float(np.float32(x)) for x in rng.standard_normal(16)], None if i % 3 else 1) for i in range(60)]
    bad = [(-5, None, 0), (-4, [], 0), (-3, [NAN] * 16, 0), (-2, [INF] * 16, 0), (-1, [None] * 16, 0), (-9, [1.0] * 15, 0),
           (100, [1.0] * 8, 0)]
    rows = [*good, (59, good[59][1], None), (None, [3e38] * 16, 1)]
    codes, model = vector_codes.encode(frame(spark, bad + rows))
    out = vector_codes.with_label_error(codes).collect()
    x = np.array([r[1] for r in rows])
    code, error, sha = plain_codes(np.clip(np.floor(4096 * x), -(1 << 27), 1 << 27).astype(np.int64))
    want = sorted((-1 if r[0] is None else r[0], "".join(f"{v:02x}" for v in c), int(e))
                  for r, c, e in zip(rows, code.tolist(), error, strict=True))
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.code, r.error) for r in out) == want
    assert model.sha256 == sha
    assert {r.label: r.label_error for r in out} == {
        k: sum(int(e) for r, e in zip(rows, error, strict=True) if r[2] == k) for k in (None, 1)}
    few, small = vector_codes.encode(frame(spark, good[:3]))
    assert small.books.shape == (8, 3, 2) and [r.error for r in few.collect()] == [0, 0, 0]
    assert np.allclose(small.decode(few.orderBy("vec_id").first().code), np.floor(4096 * np.array(good[0][1])) / 4096)
    empty, none = vector_codes.encode(frame(spark, bad[:5]))
    assert none is None and vector_codes.with_label_error(empty).count() == 0


def test_hot_label_is_whole(spark):
    codes = spark.createDataFrame([(i, 7 if i < 700 else i, "00", i) for i in range(1000)],
                                  "vec_id long, label int, code string, error long")
    got = {r.vec_id: r.label_error for r in vector_codes.with_label_error(codes).collect()}
    assert got == {i: 699 * 350 if i < 700 else i for i in range(1000)} and math.isfinite(len(got))
