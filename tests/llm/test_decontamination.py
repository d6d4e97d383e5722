import random

import pytest

from candlewick.llm import decontamination as d
from candlewick.llm.queries import QUERIES


def distance_to_substring(item, text):
    """Least edit distance of the item to any substring, and where the first such substring ends: dynamic programming."""
    row = list(range(len(item) + 1))
    best, end = row[-1], 0
    for j, letter in enumerate(text, 1):
        new = [0]
        for i, wanted in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (wanted != letter)))
        row = new
        if row[-1] < best:
            best, end = row[-1], j
    return best, end


def _edited(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        match rng.randrange(3):
            case 0:
                letters[at] = "#"
            case 1:
                letters.insert(at, "#")
            case _:
                del letters[at]
    return "".join(letters)


@pytest.mark.parametrize("seed", range(5))
def test_bit_parallel_distance(seed):
    rng = random.Random(seed)
    for _ in range(40):
        item = "".join(rng.choices("abc ", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc ", k=rng.randint(0, 150)))
        assert d.Pattern(item).best(text) == distance_to_substring(item, text)


def test_everything_within_the_budget_is_found():
    rng = random.Random(9)
    items = [(i, d.normalised("".join(rng.choices("abcdefgh ", k=rng.randint(40, 200))))) for i in range(12)]
    search = d.Block(items, d.EDIT_RATE).search
    for _ in range(150):
        i, item = rng.choice(items)
        edits = rng.randint(0, 2 * d.budget(item))
        text = "xyz " * rng.randint(0, 9) + _edited(rng, item, edits) + " zyx" * rng.randint(0, 9)
        found = {m["item_id"] for m in search(text)}
        wanted = {j for j, other in items if distance_to_substring(other, text)[0] <= d.budget(other)}
        assert found == wanted


def test_passages_repeated_thousands_of_times():
    item = d.normalised("the quick brown fox jumps over the lazy dog while seven wizards juggle glass beads")
    near = item.replace("fox", "fux")
    search = d.Block([(1, item), (2, "ab" * 30)], d.EDIT_RATE).search
    found = search(" ".join([near] * 3000))
    assert [(m["start"], m["stop"], m["distance"]) for m in found] == [(j * (len(near) + 1), j * (len(near) + 1) + len(near), 1) for j in range(3000)]
    assert len(search(" ".join([item] * 3000))) == 3000
    assert len(search("ab" * 30_000)) == 1000


def least_distance(item, part):
    """Least edit distance of the item to a whole substring of the part, by dynamic programming."""
    return distance_to_substring(item, part)[0]


def test_no_match_is_lost_beside_others():
    """Exact and near copies side by side: what is reported is right and apart, and what lies between holds no further match."""
    rng = random.Random(6)
    for _ in range(120):
        item = d.normalised("".join(rng.choices("abcd ", k=rng.randint(30, 70))))
        k, parts = d.budget(item), []
        for _ in range(rng.randint(1, 5)):
            part = rng.choice([item, item[rng.randint(0, 3) :], item[: len(item) - rng.randint(0, 3)], _edited(rng, item, rng.randint(1, k + 1)), "zz yy"])
            parts.append(part + rng.choice(["", "", " ", " q"]))
        text = "".join(parts)
        found = [(m["start"], m["stop"], m["distance"]) for m in d.Block([(1, item)], d.EDIT_RATE).search(text)]
        at = 0
        for start, stop, distance in found:
            assert at <= start and distance <= k and least_distance(item, text[start:stop]) == distance
            assert least_distance(item, text[at:start]) > k
            at = stop
        assert least_distance(item, text[at:]) > k
        assert sum(x[2] == 0 for x in found) == text.count(item)


def test_a_cut_copy_after_an_exact_one():
    item = "the quick brown fox jumps over the lazy dog again and again"
    found = d.Block([(1, item)], d.EDIT_RATE).search(item + item[3:])
    assert [(m["start"], m["stop"], m["distance"]) for m in found] == [(0, len(item), 0), (len(item), 2 * len(item) - 3, 3)]


def test_short_items_match_as_whole_words():
    search = d.Block([(1, "42"), (2, "new york"), (3, "x")], d.EDIT_RATE).search
    found = search("42 or 421, new york; new yorker, 142 and (42) in new york")
    assert [(m["item_id"], m["start"]) for m in found] == [(1, 0), (2, 11), (1, 42), (2, 49)]


def test_matches_and_their_places():
    item = "the quick brown fox jumps over the lazy dog again and again"
    search = d.Block([(7, item)], d.EDIT_RATE).search
    text = f"{item} -- {item.replace('quick', 'quack')} -- {item}"
    found = search(text)
    assert [m["distance"] for m in found] == [0, 1, 0]
    assert [text[m["start"] : m["stop"]] for m in found] == text.split(" -- ")


def test_pieces_cover_the_item():
    for n in (1, 5, 30):
        for edits in (0, 1, 4, 40):
            parts = d.split_item("x" * n, edits)
            assert "".join(p for _, p in parts) == "x" * n and all(p for _, p in parts)


def test_frames(documents, spark):
    item = "an item of a benchmark that nobody should train upon"
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "short"), (None, item.upper() + "!")], "item_id long, text string")
    rows = [(1, None), (2, ""), (5, "Short of it"), (6, "shorter"), (3, "x " * 20_000 + item.replace(" ", " \n ").title()), (None, item), (3, "clean text here")]
    for chars in (10, 1_000_000):
        found = d.with_matches(documents(rows).withColumnRenamed("lang", "matches_0"), items, "matches", block_chars=chars)
        assert [c for c in found.columns if c != "matches"] == ["doc_id", "text", "matches_0", "source", "n_chars"]
        got = sorted(((r.doc_id, sorted(str(m.item_id) for m in r.matches)) for r in found.collect()), key=repr)
        assert got == sorted([(1, []), (2, []), (3, ["1", "1", "None"]), (None, ["1", "1", "None"]), (3, []), (5, ["4"]), (6, [])], key=repr)
    assert d.find_items(documents(rows), items.where("false")).where("size(matches) > 0").count() == 0
    assert d.find_items(documents([]), items).count() == 0


def test_query_finds_every_verbatim_item_of_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: d.normalised(r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: d.normalised(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op6_decontamination"](spark, sf_dir).collect()}
    assert set(found) == set(texts)
    exact = {i: {j for j, x in items.items() if x in t} for i, t in texts.items()}
    assert any(exact.values())
    for i, r in found.items():
        assert exact[i] <= set(r.item_ids)
        for j in set(r.item_ids) - exact[i]:
            assert distance_to_substring(items[j], texts[i])[0] <= d.budget(items[j])
