"""SimHash, components and embedding links against brute force."""

import collections
import random

import numpy as np
import xxhash

from factkeeper.llm import components, embed_ego, simhash_trie


def roots(n, pairs):
    par = list(range(n))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    pairs += [(k, k + 1) for k in range(400, 600)] + [(1000, k) for k in range(1001, 1400)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    want = roots(1400, pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprint():
    rnd = random.Random(2)
    for text in ["", None, "  \n", "One", "one TWO three", "ÀÉ a b c"] + [" ".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 90))) for _ in range(40)]:
        w = (text or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[k:k + 4]), seed=42) for k in range(max(1, len(w) - 3))] if w else []
        want = sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0
        assert simhash_trie.fingerprint(text) == want


def documents(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(400):
        w = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([0, 2, 4, 150, 900]))]
        rows.append((k, " ".join(w)))
        for c in range(rnd.choice([0, 0, 0, 3])):
            v = list(w)
            if v:
                v[rnd.randrange(len(v))] = "changed"
            rows.append((1000 + 10 * k + c, " ".join(v)))
    rows += [(5, rows[0][1]), (None, rows[3][1]), (None, "nobody else says this at all"), (7000, None)]
    return rows, spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, fp int, component_id string")


def brute_simhash(rows, budget=4):
    fp = np.array([simhash_trie.fingerprint(t) for _, t in rows], dtype=np.uint64)
    pairs = [(i, int(j)) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp[i] ^ fp) <= budget)]
    comp = roots(len(rows), pairs)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[comp[k]] = min(low.get(comp[k], i), i)
    return sorted((str(i), f"{int(f):016x}", str(low.get(c))) for (i, _), f, c in zip(rows, fp, comp))


def test_simhash(spark):
    rows, docs = documents(spark)
    out = simhash_trie.simhash_dedup(docs)
    got = sorted((str(r.doc_id), r.f, str(r.component_id)) for r in out.withColumn("f", simhash_trie.hex16(out.fp)).collect())
    want = brute_simhash(rows)
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) - 50
    assert simhash_trie.simhash_dedup(docs.limit(0)).collect() == []


def test_tries_of_every_shape(spark, monkeypatch):
    """Parts and dealt depths don't change what is found."""
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = {int(x) for x in centre}
    for _ in range(900):
        x = int(rng.choice(centre))
        for b in rng.integers(0, 64, rng.integers(1, 5)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    u = np.array(fps, dtype=np.uint64)
    pairs = [(i, int(j)) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u[i] ^ u) <= 3)]
    want = collections.Counter(collections.Counter(roots(len(u), pairs)).values())
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    for part, blocks in ((4096, 4), (64, 4), (64, 5), (100, 7)):
        monkeypatch.setattr(simhash_trie, "PART_ROWS", part)
        monkeypatch.setattr(simhash_trie, "choose_blocks", lambda n, budget, b=blocks: b)
        comp = components.components(simhash_trie.similar_fingerprints(frame, 3)).groupBy("component").count().collect()
        sizes = collections.Counter(r["count"] for r in comp)
        sizes[1] += len(u) - sum(r["count"] for r in comp)
        assert +sizes == want


def test_choice_of_blocks_keeps_every_link():
    rng = np.random.default_rng(5)
    for budget in (0, 1, 4):
        for n in (10, 10**8, 10**11, 10**15):
            blocks = simhash_trie.choose_blocks(n, budget)
            assert budget < blocks <= 2 * budget + 1
            cuts = simhash_trie._cuts(blocks)
            assert sum(w for _, w in cuts) == 64
            for _ in range(200):
                bits = rng.choice(64, budget, replace=False)
                assert sum(not any(s <= b < s + w for b in bits) for s, w in cuts) >= blocks - budget


def test_near_dedup_stage(spark):
    rows, docs = documents(spark)
    kept = simhash_trie.near_dedup_stage(docs).collect()
    want = sorted({c for i, _, c in brute_simhash(rows) if i != "None" and i == c}, key=int)
    assert sorted((str(r.doc_id) for r in kept if r.doc_id is not None), key=int) == want
    assert sum(r.doc_id is None for r in kept) == 2
    assert kept[0].asDict().keys() == set(docs.columns)


def brute_vectors(rows, cosine=0.93):
    groups = collections.defaultdict(list)
    for k, (_, label, e) in enumerate(rows):
        if label is not None and e and None not in e and np.isfinite(e).all() and np.any(e):
            groups[label, len(e)].append(k)
    links, pairs = [0] * len(rows), []
    for ks in groups.values():
        m = np.array([rows[k][2] for k in ks], dtype=float)
        m = m / np.abs(m).max(axis=1, keepdims=True)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(m @ m.T >= cosine)):
            if a != b:
                links[ks[a]] += 1
                pairs.append((ks[a], ks[b]))
    comp, low = roots(len(rows), pairs), {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[comp[k]] = min(low.get(comp[k], i), i)
    return sorted((str(r[0]), links[k], str(low.get(comp[k])), r[0] is not None and low.get(comp[k]) == r[0]) for k, r in enumerate(rows))


def vectors():
    rnd = np.random.default_rng(6)
    base = rnd.normal(size=(6, 5))
    rows = [(k, int(rnd.integers(3)), (base[rnd.integers(6)] + rnd.normal(size=5) * rnd.choice([0, 0.15, 0.3])).tolist()) for k in range(300)]
    return rows + [(300, None, [1.0] * 5), (301, 1, None), (302, 1, [0.0] * 5), (303, 1, [1.0, None, 2.0, 0.0, 0.0]),
                   (304, 1, [float("nan")] * 5), (305, 1, [1.0, 2.0]), (306, 1, [2.0, 4.0]), (None, 1, [1.0, 2.0]), (None, 2, [5.0, 1.0]),
                   (307, 2, []), (5, rows[5][1], rows[5][2]), (308, 0, [1e300] * 5), (309, 0, [1e-300] * 5), (310, 0, [-0.0, 1.0]),
                   (311, 0, [0.0, 1.0]), (312, 0, [float("inf"), 1.0])]


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embed_ego, "BLOCK_BYTES", 2048)
    monkeypatch.setattr(embed_ego, "LEAF_ROWS", 8)
    rows = vectors()
    e = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, node string, n int")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embed_ego.near_vectors(e).collect())
    assert got == brute_vectors(rows)
    assert embed_ego.near_vectors(e.limit(0)).collect() == []


def test_long_vectors(spark):
    """1,536 components: blocks of bounded bytes, and axes from fewer vectors than a block's."""
    rng = np.random.default_rng(21)
    base = rng.normal(size=(40, 1536))
    v = np.concatenate([base, base[:12] + rng.normal(size=(12, 1536)) * 0.2])
    rows = [(k, x.tolist(), 1) for k, x in enumerate(v)]
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= 0.93
    comp = roots(len(v), [(a, b) for a, b in zip(*np.nonzero(near))])
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_ego.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {k: (int(near[k].sum()) - 1, comp[k]) for k in range(len(v))} and near.sum() > len(v)
    assert embed_ego.block_rows(1536) * 1536 * 8 <= embed_ego.BLOCK_BYTES
