import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from candlewick.llm import katz, katz_orders
from candlewick.llm.queries import QUERIES
from candlewick.llm.texts import id_fold


def trains(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2


def brute(rows):
    """Scores by dictionaries; also the sum of a few histories' distributions."""
    texts = [(i, (t or "").encode().lower().split()) for i, t in rows]
    words, pairs, occurs = Counter(), Counter(), Counter()
    for i, own in texts:
        if trains(i):
            sequence, history = [*own, b""], [b"", *own]
            words.update(sequence)
            pairs.update(zip(history, sequence, strict=True))
            occurs.update(history)
    total, kinds = sum(words.values()), len(words)

    def factors(counts):
        return katz.discounts([sum(v == r for v in counts.values()) for r in range(1, 7)])

    word_factors, pair_factors = factors(words), factors(pairs)
    discounted = lambda f, c: c * (f[c - 1] if c <= 5 else 1.0)
    whole = total + (not any(c <= 5 for c in words.values()))
    p = {w: discounted(word_factors, c) / whole for w, c in words.items()}
    unknown = 1 - sum(p.values())
    followers = defaultdict(dict)
    for (h, w), c in pairs.items():
        followers[h][w] = c
    size, weight, sums = {}, {}, []
    for h, seen in followers.items():
        size[h] = occurs[h] + all(c > 5 for c in seen.values())
        weight[h] = (1 - sum(discounted(pair_factors, c) for c in seen.values()) / size[h]) / (1 - sum(p[w] for w in seen))
        if len(sums) < 50:
            backed = unknown + sum(x for w, x in p.items() if w not in seen)
            sums.append(sum(discounted(pair_factors, c) for c in seen.values()) / size[h] + weight[h] * backed)
    out = []
    for i, own in texts:
        score = base = 0.0
        for h, w in zip([b"", *own], [*own, b""], strict=True):
            c = pairs.get((h, w), 0)
            score += math.log10(discounted(pair_factors, c) / size[h] if c else weight.get(h, 1.0) * p.get(w, unknown))
            base += math.log10((words.get(w, 0) + 1) / (total + kinds + 1))
        out.append((i, not trains(i), len(own) + 1, sum(w in words for w in [*own, b""]), total, base, score))
    return out, sums


def assert_same(found, rows):
    wanted, sums = brute(rows)
    assert all(abs(s - 1) < 1e-9 for s in sums)
    found = sorted(map(tuple, found), key=repr)
    wanted.sort(key=repr)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for a, b in zip(sorted(found, key=lambda r: (str(r[0]), r[6])), sorted(wanted, key=lambda r: (str(r[0]), r[6])), strict=True):
        assert a[5:] == pytest.approx(b[5:], abs=1e-6)


def test_discounts_are_factors():
    for counts in ([0] * 6, [10, 5, 3, 2, 1, 1], [1, 50, 0, 3, 9, 100], [100, 40, 20, 11, 7, 5]):
        assert all(0 < f < 1 for f in katz.discounts(counts))


@pytest.mark.parametrize(("frequent", "history_pairs", "bucket_pairs", "top_words"), [(1 << 19, 250_000, 600_000, 512), (1 << 19, 100, 20_000, 30), (150, 40, 20_000, 400), (0, 10, 50_000, 1)])
def test_whole_table_against_dictionaries(spark, sf_dir, frequent, history_pairs, bucket_pairs, top_words):
    """Dealing histories out, counting top words apart and joining the others changes nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert_same(katz.scores(docs, id_fold(7) != 2, frequent=frequent, history_pairs=history_pairs, bucket_pairs=bucket_pairs, top_words=top_words).collect(), rows)


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, "a a a b"), (3, "a a a b"), (None, "A b c"), (4, "the " * 20_000), (5, "seen nowhere else é"), (6, "b a \n c")]
    assert_same(katz.scores(documents(rows), id_fold(7) != 2).collect(), rows)
    assert katz.scores(documents([]), id_fold(7) != 2).count() == 0


def test_a_dealt_history_without_a_discounted_pair(documents):
    """One pair of two hot words, a text that has another after the first, and one that has never seen either."""
    rows = [(i, "hot pair " * 9) for i in range(30)] + [(900, "hot stone"), (901, "pair pair cold")]
    for top_words in (0, 1, 8):
        assert_same(katz.scores(documents(rows), id_fold(7) != 2, history_pairs=20, bucket_pairs=50, top_words=top_words).collect(), rows)


def test_counts_are_kept_by_kind(documents, spark, monkeypatch):
    folders = []
    real = katz.new_folder
    monkeypatch.setattr(katz, "new_folder", lambda session, name: folders.append(real(session, name)) or folders[-1])
    train = [i for i in range(20) if trains(i)][:3]
    katz.scores(documents([(train[0], "a b a b"), (train[1], "a b"), (train[2], "c")]), id_fold(7) != 2).count()
    counts = spark.read.parquet(folders[0]).where("kind = 'count'").selectExpr("explode(c1) AS n")
    # start-a twice, a-b three times, b-a, b-end twice, start-c, c-end
    assert sorted(r.n for r in counts.collect()) == [1, 1, 1, 2, 2, 3]


def test_what_buckets_tell_takes_one_file_a_task_in_small_groups_by_kind(documents, spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "a", "of", *[f"word{k}" for k in range(900)]], k=100))) for i in range(600)]
    monkeypatch.setattr(katz, "new_folder", lambda session, name: str(tmp_path / name))
    monkeypatch.setattr(katz, "ROW_GROUP", 1 << 16, raising=False)
    assert_same(katz.scores(documents(rows), id_fold(7) != 2, frequent=400, history_pairs=200, bucket_pairs=10_000, top_words=2).collect(), rows)
    files = list((tmp_path / "pairs").rglob("*.parquet"))
    tasks = {re.search(r"part-(\d+)", f.name)[1] for f in files}
    assert len(files) == len(tasks)
    of_kind = Counter()
    for file in files:
        kinds = pq.read_table(file, columns=["kind"])["kind"].to_pylist()
        assert kinds == sorted(kinds)
        of_kind.update(set(kinds))
        assert pq.ParquetFile(file).metadata.num_row_groups > 1
    assert len(of_kind) == 12


def test_without_training_text(documents):
    held = next(i for i in range(100) if not trains(i))
    (row,) = katz.scores(documents([(held, "a b")]), id_fold(7) != 2).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_query(spark, sf_dir):
    result = QUERIES["op5_katz_scores"](spark, sf_dir)
    assert result.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    held = result.where("held_out").agg({"base_score": "sum", "score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def brute_of_order(rows, order):
    """Any order by dictionaries and plain recursion; also the sums of a few histories' distributions."""
    texts = [(i, (t or "").encode().lower().split()) for i, t in rows]
    counts = [Counter() for _ in range(order + 1)]
    for i, own in texts:
        if trains(i):
            padded = [b""] * (order - 1) + own + [b""]
            for at in range(order - 1, len(padded)):
                for m in range(1, order + 1):
                    counts[m][tuple(padded[at - m + 1 : at + 1])] += 1
    factors = [None] + [katz.discounts([sum(v == r for v in counts[m].values()) for r in range(1, 7)]) for m in range(1, order + 1)]
    followers = defaultdict(dict)
    for m in range(1, order + 1):
        for gram, n in counts[m].items():
            followers[m, gram[:-1]][gram[-1]] = n
    known = {g[0] for g in counts[1]}

    def seen(m, h):
        own = followers.get((m, h), {})
        whole = sum(own.values()) + all(n > 5 for n in own.values())
        return {w: n * (factors[m][n - 1] if n <= 5 else 1.0) / whole for w, n in own.items()}

    unknown = 1 - sum(seen(1, ()).values())
    memo = {}

    def state(m, h):
        if (m, h) not in memo:
            own = seen(m, h)
            memo[m, h] = own, (1 - sum(own.values())) / (1 - sum(p(m - 1, h[1:], w) for w in own)) if m > 1 and own else 1.0
        return memo[m, h]

    def p(m, h, w):
        own, weight = state(m, h)
        if w in own:
            return own[w]
        return weight * p(m - 1, h[1:], w) if m > 1 else unknown

    out = []
    for i, own in texts:
        padded = [b""] * (order - 1) + own + [b""]
        score = sum(math.log10(p(order, tuple(padded[at - order + 1 : at]), padded[at])) for at in range(order - 1, len(padded)))
        out.append((str(i), len(own) + 1, sum(w in known for w in [*own, b""]), score))
    histories = [h for m, h in followers if m == order][:25]
    sums = [sum(p(order, h, w) for w in known) + p(order, h, b"no word of any text") for h in histories]
    return sorted(out), sums


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_any_order_against_dictionaries(documents, order):
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choices(["the", "a", "cat", "dog", "saw", "of", "and", f"rare{i}"], k=rng.randint(0, 40)))) for i in range(60)]
    rows += [(3, rows[3][1]), (None, "The cat"), (70, None), (71, "words that nobody has seen"), (72, "the " * 3000)]
    found = katz_orders.scores(documents(rows), id_fold(7) != 2, order).collect()
    wanted, sums = brute_of_order(rows, order)
    assert all(abs(s - 1) < 1e-9 for s in sums)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.score) for r in found)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in wanted], abs=1e-6)


def test_both_modules_agree_on_pairs(documents):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices("a b c d e f g h".split(), k=rng.randint(0, 30)))) for i in range(80)]
    packed = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.scores(documents(rows), id_fold(7) != 2).collect())
    joined = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz_orders.scores(documents(rows), id_fold(7) != 2, 2).collect())
    assert [p[:5] for p in packed] == [j[:5] for j in joined]
    assert [x for p in packed for x in p[5:]] == pytest.approx([x for j in joined for x in j[5:]], abs=1e-5)


def test_no_rows_of_any_order(documents):
    assert katz_orders.scores(documents([]), id_fold(7) != 2).count() == 0
    held = next(i for i in range(100) if not trains(i))
    (row,) = katz_orders.scores(documents([(held, "a b")]), id_fold(7) != 2).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)
