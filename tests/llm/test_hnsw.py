import numpy as np

from weftline.llm import hnsw


def brute(vectors, cosine=0.95):
    """Links and component of each (id, vector)."""
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in vectors]
    root = list(range(len(vectors)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(vectors)
    unit = [np.array(v, dtype=np.float32).astype(np.float64) / np.linalg.norm(np.array(v, dtype=np.float32).astype(np.float64)) if g else None for (_, v), g in zip(vectors, good)]
    for i in range(len(vectors)):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(vectors):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, links[i], least[find(i)]) for i, (k, _) in enumerate(vectors))


def sample(seed, n, dim=24):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(n)]
    chain = rng.normal(size=dim)
    for _ in range(12):
        chain = chain / np.linalg.norm(chain) + 0.05 * rng.normal(size=dim)
        rows.append(chain)
    centre = rng.normal(size=dim)
    rows += [centre + 0.02 * rng.normal(size=dim) for _ in range(60)]
    rows += [rows[3], rows[3], 2 * rows[4], rows[5] * -1]
    ids = rng.permutation(10 * len(rows))[: len(rows)].tolist()
    return [(i, [float(np.float32(x)) for x in v]) for i, v in zip(ids, rows)]


def test_equal_to_brute_force(spark):
    data = sample(1, 300) + [(90001, None), (90002, [0.0] * 24), (90003, [1.0, None] * 12), (90004, [float("nan")] * 24), (90005, []), (90006, [1.0, 0.0]), (90007, [1.0, 0.01]), (90008, [float("inf")] * 24)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumnRenamed("x", "y")
    got = sorted((r.id, r.n_links, r.component_id) for r in hnsw.near_duplicates(frame, shards=3).collect())
    assert got == brute(data)


def test_nulls_repeats_and_empty(spark):
    schema = "vec_id long, embedding array<float>, id string"
    frame = spark.createDataFrame([(None, [1.0, 0.0], "a"), (4, [1.0, 0.0], "b"), (4, [1.0, 0.0], "b"), (2, [0.0, 1.0], None)], schema)
    got = sorted((r.id if r.id is not None else -1, r.n_links, r.component_id) for r in hnsw.near_duplicates(frame).collect())
    assert got == [(-1, 0, None), (2, 0, 2), (4, 1, 4), (4, 1, 4)]
    assert hnsw.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_recall_and_repeatable_graphs():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(300, 32))
    vectors = (np.repeat(centres, 8, axis=0) + 0.1 * rng.normal(size=(2400, 32))).astype(np.float32)
    ids = rng.permutation(2400)
    graph = hnsw.Graph(ids, vectors)
    again = hnsw.Graph(ids[::-1], vectors[::-1])
    assert all((a == b).all() for a, b in zip(graph.layers, again.layers))
    (q, node), recall, ef = graph.audited(graph.unit, graph.ids, 0.95)
    true = graph.unit @ graph.unit.T >= 0.95
    hits = np.zeros_like(true)
    hits[q, node] = True
    assert recall >= hnsw.RECALL
    assert (hits & true).sum() >= 0.98 * true.sum()


def test_beams_widen_past_a_large_group():
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.normal(size=16) + 0.01 * rng.normal(size=(400, 16)), rng.normal(size=(400, 16))]).astype(np.float32)
    graph = hnsw.Graph(np.arange(800), vectors)
    q, _ = graph.within(graph.unit, 0.95, 16)
    assert np.bincount(q, minlength=800)[:400].min() >= 396


def test_audit_does_not_count_own_ids():
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(1500, 24))
    vectors[1400:] = vectors[:100] + 0.02 * rng.normal(size=(100, 24))
    graph = hnsw.Graph(np.arange(1500), vectors.astype(np.float32))
    whole = graph.within

    def blind(queries, cosine, ef, most=0):  # finds nothing but the query itself, until the beam is wide
        return whole(queries, cosine, ef) if hnsw.WIDE * ef >= 1500 else (np.arange(len(queries)), (queries @ graph.unit.T).argmax(axis=1))

    graph.within = blind
    (q, node), _, _ = graph.audited(graph.unit, graph.ids, 0.95)
    hits = np.zeros((1500, 1500), dtype=bool)
    hits[q, node] = True
    assert hits[np.arange(100), 1400 + np.arange(100)].all()


def test_the_graph_answers_where_links_are_few():
    """Two shards of 6,000 vectors with 40 links: the audit has planted queries, no beam ends in comparing with all."""
    rng = np.random.default_rng(10)
    a, b = rng.normal(size=(6000, 64)), rng.normal(size=(6000, 64))
    b[:40] = a[:40] + 0.15 * rng.normal(size=(40, 64))
    one, two = hnsw.Graph(np.arange(6000), a.astype(np.float32)), hnsw.Graph(np.arange(6000, 12000), b.astype(np.float32))
    for x, y in ((one, two), (two, one)):
        _, recall, ef = y.audited(x.unit, x.ids, 0.95)
        assert recall >= hnsw.RECALL and hnsw.WIDE * ef < 6000, (recall, ef)
    keys, _ = hnsw._pairs(one, two, 0.95)
    true = {(int(p), int(q)) for p, q in zip(*np.nonzero(one.unit @ two.unit.T >= 0.95))}
    got = {(int(k) // 6000, int(k) % 6000) for k in keys}
    assert 30 <= len(true) and got <= true and len(got) >= 0.97 * len(true)


def clusters(seed, n, dim=16, spread=0.075):
    """Vectors about centres, many of whose cosines lie about 0.95, with ids in no order and vectors of another length."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    rows = [list(map(float, np.float32(c / np.linalg.norm(c) + spread * rng.normal(size=dim)))) for c in np.repeat(centres, 6, axis=0)]
    rows += [[1.0, float(k)] for k in range(3)]
    return list(zip(rng.permutation(len(rows)).tolist(), rows))


def test_links_count_at_both_ends_over_shards(spark):
    data = clusters(3, 1800)
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    rows = hnsw.near_duplicates(frame, shards=4).collect()
    want = brute(data)
    got = sorted((r.id, r.n_links, r.component_id) for r in rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found % 2 == 0 and 0.98 * true <= found <= true
    assert min(r.audit_recall for r in rows) >= hnsw.RECALL
    small = [r for r in clusters(4, 300)]
    frame = spark.createDataFrame(small, "vec_id long, embedding array<float>")
    assert sorted((r.id, r.n_links, r.component_id) for r in hnsw.near_duplicates(frame, shards=3).collect()) == brute(small)


def test_shards_of_very_many_links_are_compared_by_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    raw = (rng.normal(size=12) + 0.02 * rng.normal(size=(500, 12))).astype(np.float32)
    a, b = hnsw.Graph(np.arange(0, 500, 2), raw[::2]), hnsw.Graph(np.arange(1, 500, 2), raw[1::2])
    for one, two in ((a, b), (a, a)):
        keys, recall = hnsw._pairs(one, two, 0.95)
        many = np.sort(np.concatenate([p * len(two.ids) + q for p, q in hnsw._blocks(one, two, 0.95)]))
        assert (keys == many).all() and len(keys) > 20000
    monkeypatch.setattr(hnsw.Graph, "audited", lambda *_: (None, 1.0, 0))
    assert hnsw._pairs(a, b, 0.95)[0] is None


def test_islands_are_all_reached():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8))
    raw = (np.repeat(centres, 60, axis=0) + 1e-3 * rng.normal(size=(2400, 8))).astype(np.float32)
    graph = hnsw.Graph(np.arange(2400), raw)
    reached, frontier = np.zeros(2400, dtype=bool), np.array([graph.entry])
    while len(frontier):
        reached[frontier] = True
        around = np.unique(graph.layers[0][frontier])
        around = around[around >= 0]
        frontier = around[~reached[around]]
    assert reached.all()
