import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from candlewick.llm import prefix_trie
from candlewick.llm.prefix_trie import SlotTable, trie

SCHEMA = "text string, conv_id bigint, role string, n_convs int, turn bigint, start string"


@pytest.fixture(scope="module")
def conversations(spark):
    def make(rows, partitions=3):
        full = [(text, conv, role, k, turn, None if k % 2 else "s") for k, (conv, turn, role, text) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)

    return make


def digest_of(role, text):
    role, text = role.encode(), text.encode()
    return hashlib.blake2b(b"%d %s%s" % (len(role), role, text), digest_size=16).digest()


def brute(rows):
    """Nodes by their whole sequences of turns, subtrees by looking at all nodes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest_of(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        lent = zlib.crc32(str(c).encode()) % 4
        first = c - int(np.fmod(c, 20))
        whole[c] = tuple(own.get(first, [])[:lent] + turns[lent:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in members)]
        children = sum(len(p) == len(path) + 1 for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode().split()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path))
        above = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), above, len(convs), children, len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_conversations(seed, convs, turns, texts):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        conv = rng.choice([rng.randint(0, 90), rng.randint(-50, 0)])
        rows += [(conv, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(texts)) for t in range(rng.randint(1, turns))]
    return rows


def test_tries_of_random_conversations(conversations, rows_of):
    texts = ["", None, "a b", "c", "c d\te", "x " * 5]
    for seed, convs, turns, block, shard in ((1, 40, 4, 2, 7), (2, 25, 9, 3, 1), (3, 60, 3, 256, 1 << 17)):
        rows = some_conversations(seed, convs, turns, texts)
        assert rows_of(trie(conversations(rows, seed), block_turns=block, shard_nodes=shard)) == brute(rows)


def test_copies_and_long_conversations(conversations, rows_of):
    """A conversation of many blocks over several ranges, a copy of most of it, and one that many share."""
    long = [(60, t, "user", f"turn {t % 7}") for t in range(90)] + [(60, 5, "user", "turn 5")] * 4
    copy = [(77, t, "user", f"turn {t % 7}") for t in range(60)]
    common = [(c, t, "bot", f"same words {t}") for c in range(100, 140) for t in range(3)]
    rows = long + copy + common + [(None, 0, "user", "nobody's"), (141, 1, "bot", "same words 0")]
    assert rows_of(trie(conversations(rows, 5), block_turns=4, shard_nodes=10)) == brute(rows)


def test_no_conversations(conversations, rows_of):
    assert rows_of(trie(conversations([]))) == []
    assert rows_of(trie(conversations([(None, 1, "user", "text")]))) == []


def test_a_conversation_may_be_left_without_turns(conversations, rows_of):
    # 1 takes turns of the absent conversation 0 in place of its own.
    lent = zlib.crc32(b"1") % 4
    rows = [(1, t, "user", "word") for t in range(lent)]
    (root,) = rows_of(trie(conversations(rows)))
    assert root == (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())


def test_a_very_long_text_counts_whole(conversations, rows_of):
    rows = [(c, t, "user", "word " * 300_000) for c in (20, 40) for t in range(4)]
    assert rows_of(trie(conversations(rows))) == brute(rows)


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(5)
    digests = np.unique(rng.integers(0, 2**64, (5000, 2), np.uint64), axis=0)
    table = SlotTable(digests)
    assert sorted(table[digests].tolist()) == list(range(len(digests)))
    with pytest.raises(KeyError):
        table[digests + np.uint64(1)]
    assert len(SlotTable(digests[:0])) == 0
    with pytest.raises(ValueError):
        SlotTable(np.repeat(digests[:1], 2, axis=0))


def test_chains_go_on_from_block_to_block():
    keys = b"".join(hashlib.blake2b(bytes([i]), digest_size=16).digest() for i in range(9))
    whole = prefix_trie.chain(prefix_trie.ROOT, keys)
    part = prefix_trie.chain(prefix_trie.ROOT, keys[: 4 * 16])
    assert whole == part + prefix_trie.chain(part[-1], keys[4 * 16 :])
    tail = prefix_trie.chain(0, keys[4 * 16 :])[-1]
    assert whole[-1] == (part[-1] * pow(prefix_trie.BASE, 5, prefix_trie.PRIME) + tail) % prefix_trie.PRIME
