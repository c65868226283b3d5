import numpy as np
import pytest
import xxhash

from gatewright.llm import simhash


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius=2):
    """Smallest id reachable, by comparing all pairs."""
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints(texts):
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_components_equal_all_pairs(documents, texts):
    rows = simhash.near_duplicates(documents(texts)).collect()
    want = classes({i: plain_fingerprint(t) for i, t in enumerate(texts)})
    assert {r.doc_id: r.component_id for r in rows} == want and len(rows) == len(texts)


def clustered(rng, n):
    """Fingerprints in clouds of a few bits, and some far from all."""
    out = set()
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            fp = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                fp ^= 1 << bit
            out.add(fp)
    return sorted(out)


@pytest.mark.parametrize("large", [0, 5, 512])
@pytest.mark.parametrize("parts", [
    [(range(0, 21), 0), (range(21, 42), 0), (range(42, 64), 0)],
    [(range(0, 32), 1), (range(32, 64), 0)],
    [(range(64), 2)],
])
def test_links_find_every_class(spark, rng, parts, large):
    prints = clustered(rng, 250)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(df, [(list(g), e) for g, e in parts], large=large)
    got = {r.node: r.root for r in simhash.components(found).collect()}
    want = classes(dict(zip(signed, prints)))
    assert {s: got.get(s, s) for s in signed} == want


def test_thresholds_are_dealt_where_they_cost_least():
    cheap, dear = [0, 1, 2, 3], [0, 100, 200, 300]
    assert simhash.allocate([dear, cheap], 2) == (3, [-1, 2])
    assert simhash.allocate([cheap, cheap, cheap], 2)[1] in ([0, 0, 0], [1, 0, -1], [-1, 0, 1], [2, -1, -1], [-1, -1, 2],
                                                            [-1, 2, -1], [1, -1, 0], [0, 1, -1], [0, -1, 1], [-1, 1, 0])
    for m in range(1, 5):
        assert sum(simhash.allocate([cheap] * m, 2)[1]) == 2 - m + 1


def test_correlated_bits_share_a_partition():
    tied = np.eye(64)
    for i in range(0, 64, 2):
        tied[i, i + 1] = tied[i + 1, i] = 0.9
    for parts in (2, 4):
        groups = simhash.group_bits(tied, parts)
        assert sorted(sum(groups, [])) == list(range(64))
        assert all(b ^ 1 in g for g in groups for b in g)


def test_one_of_each_group_stays(spark, documents):
    same = "alpha beta gamma delta " * 5
    docs = documents([same, same, same.upper(), "other words here", None, "", same], ids=[5, 3, 3, 9, 8, 7, None])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    assert got == [(False, 3), (False, 7), (False, 9), (True, None)]
    repeated = documents([same, same, "x"], ids=[1, 1, 1])
    assert sorted(r.text for r in simhash.keep_one(repeated).collect()) == [same, "x"]
    assert simhash.keep_one(docs.where("false")).count() == 0
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5000, 5000), (None, 3)]
    got = simhash.components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == (
        {i: 0 for i in range(201)} | {1000 + k: 1000 for k in range(300)} | {5000: 5000})


@pytest.mark.parametrize("radius,parts", [(1, [(range(0, 32), 0), (range(32, 64), 0)]),
                                          (3, [(range(0, 32), 1), (range(32, 64), 1)])])
def test_large_buckets_at_other_radii(spark, rng, radius, parts):
    prints = clustered(rng, 120)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(df, [(list(g), e) for g, e in parts], radius, large=3)
    got = {r.node: r.root for r in simhash.components(found).collect()}
    assert {s: got.get(s, s) for s in signed} == classes(dict(zip(signed, prints)), radius)
