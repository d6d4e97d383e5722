import random

import numpy as np
import xxhash

from candlewick.llm import simhash
from candlewick.llm.components import components
from candlewick.llm.queries import QUERIES


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=2):
    """Least id reachable, by union-find over all pairs."""
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in (np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= max_bits) + i + 1).tolist():
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: ids[root(k)] for k, i in enumerate(ids)}


def test_linked_fingerprints_meet_at_an_anchor():
    rng = random.Random(3)
    for max_bits in (0, 1, 2, 3):
        code = simhash.Code(1 + (max_bits + 1) // 2)
        for _ in range(40):
            x = rng.getrandbits(64)
            y = x
            for bit in rng.sample(range(64), rng.randint(0, max_bits)):
                y ^= 1 << bit
            sets = [set(code.anchors(np.array([v], np.uint64))[1].tolist()) for v in (x, y)]
            assert sets[0] & sets[1]


def test_anchors_are_code_words_within_the_radius():
    code = simhash.Code(2)
    x = np.random.default_rng(1).integers(0, 2**63, 50, np.uint64)
    rows, anchors = code.anchors(x)
    assert (code.syndrome(anchors) == 0).all()
    assert (np.bitwise_count(anchors ^ x[rows]) <= 2).all()
    assert np.bincount(rows).max() <= 33


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    wanted = {x: root(x) for x in parent}
    found = components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()
    assert {r.node: r.component for r in found} == wanted and len(found) == len(wanted)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes_against_all_pairs(documents):
    rng = random.Random(11)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(120)) for _ in range(12)]
    rows = []
    for i in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i * 3 + 1, " ".join(words)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "x " * 50_000)]
    found = {r.doc_id: r for r in simhash.near_duplicates(documents(rows)).collect()}
    prints = {i: brute_print(t) for i, t in rows}
    assert {i: np.uint64(np.int64(r.fp)) for i, r in found.items()} == {i: np.uint64(p) for i, p in prints.items()}
    assert {i: r.component_id for i, r in found.items()} == brute_components(prints)
    assert found[502].component_id == 500 and found[504].component_id == 503


def test_a_large_group_of_near_copies(spark):
    """Thousands of fingerprints around one centre are linked as over all pairs."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = {}
    for i in range(3000):
        x = centre
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << bit
        prints[i] = x
    nodes = {}
    for i, x in prints.items():
        nodes.setdefault(x, i)
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)), i) for x, i in nodes.items()], "fp long, node long")
    edges = simhash.links_at_anchors(simhash.replicas(frame)).distinct()
    found = {r.node: r.component for r in components(edges).collect()}
    wanted = brute_components({i: x for x, i in nodes.items()})
    assert {i: found.get(i, i) for i in wanted} == wanted


def test_one_document_of_each_class_stays(documents):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "something else here"), (3, "something else here"), (None, "a b c d"), (None, None), (9, "")]
    left = simhash.representatives(documents(rows))
    assert left.columns == documents(rows).columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted([(1, "a b c d"), (3, "something else here"), (9, ""), (None, "a b c d"), (None, None)], key=repr)
    assert simhash.representatives(documents([])).count() == 0


def test_query_on_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: r for r in QUERIES["op4_simhash"](spark, sf_dir).collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in found.items()} == brute_components(prints)


def test_a_fingerprint_of_null_ids_only_links_others(documents):
    """Three prints two bits apart in a chain; the middle one has no id."""
    prints = [0b0, 0b11, 0b1111]
    spark = documents([]).sparkSession
    table = spark.createDataFrame([(7, prints[0]), (None, prints[1]), (9, prints[2]), (None, 0xFFFF << 40)], "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash.classes(table).collect()}
    assert found == {0: 7, 3: 7, 15: 7, 0xFFFF << 40: None}


def test_no_class_loses_its_representative_to_a_shared_id(documents):
    a, b = "one two three four five six seven", "completely different words stand in this other text"
    rows = [(1, a), (5, a), (5, b), (9, b), (5, b), (None, a)]
    kept = sorted(((r.doc_id, r.text) for r in simhash.representatives(documents(rows)).collect()), key=repr)
    assert kept == sorted([(1, a), (5, b), (None, a)], key=repr)
