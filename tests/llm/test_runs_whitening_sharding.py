"""Periodic runs, whitening and sharding against plain Python."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from citeloom.llm import queries, runs, sharding, whitening
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def written(df, tmp_path, name):
    df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture(params=["tricky", "repeated", "none", "small"])
def docs(request):
    return request.getfixturevalue(request.param)


# --- periodic runs ---------------------------------------------------------------------


def test_periodic_runs(spark, docs, tmp_path):
    out = queries.op11_periodic_runs(spark, written(docs, tmp_path, "documents"))
    assert out.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in out.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert want(out.collect()) == want(brute.periodic_runs(d, t) for d, t in pairs(docs))


def random_words(rng):
    letters = "ab" if rng.random() < 0.5 else "abcd"
    words = []
    while len(words) < rng.randint(0, 90):
        piece = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        words += piece * rng.choice([1, 1, 2, 4, 5, 9])
        if rng.random() < 0.3:
            words += piece[: rng.randint(0, len(piece))]
    return words


def test_runs_of_many_small_alphabets():
    rng = random.Random(3)
    texts = [random_words(rng) for _ in range(1500)] + [["a"] * n for n in range(12)] + [["a", "b"] * n for n in range(9)]
    found, _, _ = runs.periodic_runs(pa.array([" ".join(t) for t in texts], pa.string()))
    by_text = {k: [] for k in range(len(texts))}
    for k, *run in found.tolist():
        by_text[k].append(tuple(run))
    for k, words in enumerate(texts):
        assert by_text[k] == brute.runs(words), words


@pytest.mark.parametrize("exponent", [5, 7])
def test_runs_of_more_periods(exponent):
    rng = random.Random(8)
    texts = [random_words(rng) for _ in range(200)]
    found, _, _ = runs.periodic_runs(pa.array([" ".join(t) for t in texts], pa.string()), exponent, 9)
    assert sorted(map(tuple, found.tolist())) == sorted((k, *r) for k, t in enumerate(texts) for r in brute.runs(t, exponent, 9))


def test_a_run_over_a_very_long_text():
    words = [f"w{k % 777}" for k in range(300_000)]
    words[150_001] = "other"
    found, flat, sizes = runs.periodic_runs(pa.array([" ".join(words), "x y"], pa.string()))
    assert found.tolist() == [[0, 0, 150_001, 777], [0, 150_002, 149_998, 777]]
    assert len(runs._collapsed(found, flat, sizes)[0].as_py().split()) == 777 + 1 + 777


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for size, bits in ((1, 1), (70, 5), (1000, 10)):
        values = rng.integers(0, 1 << bits, size)
        matrix = runs.WaveletMatrix(values, bits)
        begin = rng.integers(0, size, 200)
        end = np.array([rng.integers(b, size + 1) for b in begin])
        least = rng.integers(0, (1 << bits) + 1, 200)
        assert matrix.below(begin, end, least).tolist() == [int((values[b:e] < v).sum()) for b, e, v in zip(begin, end, least)]
        most = least + rng.integers(0, 1 << bits, 200)
        hit, value = matrix.successor(begin, end, least, most)
        expected = [(k, min(x for x in values[b:e] if lo <= x <= hi)) for k, (b, e, lo, hi) in enumerate(zip(begin, end, least, most)) if any(lo <= x <= hi for x in values[b:e])]
        assert list(zip(hit.tolist(), value.tolist())) == expected


def test_suffixes_are_sorted_and_blocks_have_their_ranges():
    rng = random.Random(2)
    texts = [[rng.randrange(3) for _ in range(rng.randint(1, 40))] for _ in range(30)]
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    words = np.concatenate([np.array(t) + 3 * k for k, t in enumerate(texts)])
    order, found = runs._blocks(words, starts, sizes)
    for k, at, begin, end in found:
        for a, b, e in zip(at.tolist(), begin.tolist(), end.tolist()):
            same = {i for i in range(len(words)) if words[i : i + 2**k].tolist() == words[a : a + 2**k].tolist()}
            assert set(order[b:e].tolist()) == same


# --- whitening -----------------------------------------------------------------------------


def vectors_df(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, component string, n string")


def check_whitening(df, components=8):
    out = whitening.whiten(df, components).collect()
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in df.collect()]
    exact, whitened, explained = brute.whitening(rows, components)
    count = 0 if whitened is None else whitened.shape[1]
    assert len(out) == len(exact) * count
    assert want((r.vec_id, r.n, r.deviation) for r in out if r.component == 1) == want(exact)
    if not exact:
        return out
    ids = [e[0] for e in exact]
    if len(set(ids)) == len(ids):
        got = np.zeros_like(whitened)
        place = {i: k for k, i in enumerate(ids)}
        for r in out:
            got[place[r.vec_id], r.component - 1] = r.whitened
            assert abs(r.explained - explained[r.component - 1]) <= 1e-9 * explained[r.component - 1]
        for k in range(count):
            sign = np.sign(got[:, k] @ whitened[:, k])
            assert np.abs(sign * got[:, k] - whitened[:, k]).max() < 1e-6
    assert len({r.identity_error for r in out}) == 1 and 0 <= out[0].identity_error < 1e-8
    return out


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whitening_of_given_vectors(spark, sf):
    out = queries.op12_whitening(spark, f"/root/testdata/{sf}")
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check_whitening(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet"))


def test_whitening_leaves_out_what_is_no_vector(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, s) for s in (3, 2, 1)], 1, "x", "y") for k in range(60)]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0]]
    rows += [(100 + k, v, 1, "x", "y") for k, v in enumerate(bad)] + [rows[0], rows[0], (None, rows[1][1], 1, "x", "y")]
    out = check_whitening(vectors_df(spark, rows).repartition(7))
    assert {r.component for r in out} == {1, 2, 3} and {r.n for r in out} == {63}


def test_whitening_of_nothing_and_of_one_vector(spark):
    assert whitening.whiten(vectors_df(spark, [])).count() == 0
    assert whitening.whiten(vectors_df(spark, [(1, None, 1, "", "")])).count() == 0
    out = whitening.whiten(vectors_df(spark, [(1, [0.5, 0.25], 1, "", "")] * 3)).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in out} == {(3, 0, None, None, 0.0)}
    flat = whitening.whiten(vectors_df(spark, [(k, [k / 4, 2.0], 1, "", "") for k in range(8)])).collect()
    assert {r.whitened is None for r in flat if r.component == 2} == {True}
    assert {round(r.explained, 9) for r in flat if r.component == 1} == {1.0} and flat[0].identity_error < 1e-9


def test_deviations_are_exact_at_every_size():
    rng = random.Random(6)
    for scale, n in ((1 << 10, 50), (1 << 30, 1 << 12), (1 << 30, 1 << 19), (1 << 51, 1 << 20)):
        x = np.array([[rng.randrange(-scale, scale) for _ in range(5)] for _ in range(20)], float)
        sums = [rng.randrange(-scale * n, scale * n) for _ in range(5)]
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        assert whitening._deviations(x, n, sums) == [e if e < 1 << 63 else None for e in exact]


@pytest.mark.parametrize("kind", ["random", "equal", "near", "low rank", "diagonal"])
def test_leading_components(kind):
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 8, 40):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        spectrum = {
            "random": rng.random(n) * 50,
            "equal": np.where(np.arange(n) < 4, 7.0, 2.0),
            "near": 5 + np.arange(n) * 1e-9,
            "low rank": np.where(np.arange(n) < 2, 3.0 + np.arange(n), 0.0),
            "diagonal": np.arange(n, dtype=float),
        }[kind]
        matrix = np.diag(spectrum) if kind == "diagonal" else (q * spectrum) @ q.T
        matrix = (matrix + matrix.T) / 2
        values, vectors = whitening.leading_components(matrix, 8)
        assert np.allclose(values, np.sort(spectrum)[::-1][:8], rtol=0, atol=1e-12 * max(1, spectrum.max()))
        assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-9
        assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-11 * max(1, spectrum.max())


# --- sharding --------------------------------------------------------------------------------


def group_hash(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def check_shards(df, shards, out):
    rows = out.collect()
    texts = pairs(df)
    expected = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts]
    assert want((r.doc_id, r.size, r.text_crc32) for r in rows) == want(expected)
    by_shard, by_group = {}, {}
    for r in rows:
        assert 0 <= r.shard < shards
        by_shard.setdefault(r.shard, []).append(r)
        by_group.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(len(s) == 1 for s in by_group.values())
    sizes = {}
    for d, t in texts:
        sizes[group_hash(t)] = sizes.get(group_hash(t), 0) + len((t or "").encode()) + 16
    if texts:
        largest = max(sum(r.size for r in own) for own in by_shard.values())
        assert largest <= brute.smallest_capacity([sizes[k] for k in sorted(sizes)], shards)
    return by_shard


def test_shards(docs):
    check_shards(docs, 7, sharding.assign_shards(docs, 7))


def test_one_shard_and_more_shards_than_groups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, None), (3, ""), (4, "bc")], "doc_id bigint, text string")
    for shards in (1, 40):
        check_shards(df, shards, sharding.assign_shards(df, shards))


@pytest.mark.parametrize("bits", [(1, 1), (3, 2), (14, 6)])
def test_shards_do_not_depend_on_the_first_cells(spark, monkeypatch, bits):
    monkeypatch.setattr(sharding, "CELL_BITS", bits[0])
    monkeypatch.setattr(sharding, "ZOOM_BITS", bits[1])
    rng = random.Random(4)
    rows = [(k, "x" * rng.randint(0, 400) + str(rng.randint(0, 150))) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_shards(df, 7, sharding.assign_shards(df, 7))


def test_shards_beside_a_text_that_a_third_of_the_rows_share(spark):
    rows = [(k, "the same text " * 9 if k % 3 == 0 else f"text {k} " * (k % 13 + 3)) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    by_shard = check_shards(df, 40, sharding.assign_shards(df, 40))
    sizes = sorted(sum(r.size for r in own) for own in by_shard.values())
    assert len(sizes) == 40 and sizes[-2] < 1.2 * sizes[0] and sizes[-1] > 10 * sizes[0]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
def test_shards_of_given_documents_are_nearly_equal(spark):
    out = queries.op13_sharding(spark, "/root/testdata/sf0.01")
    assert out.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    sums = [r.n for r in out.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sums) == 40 and max(sums) - min(sums) <= out.agg(F.max("size")).first()[0]


def test_sharding_runs_no_python(tricky):
    plan = sharding.assign_shards(tricky)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
