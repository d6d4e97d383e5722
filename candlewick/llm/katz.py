"""Language-model scores: a bigram model with Katz backoff and Good-Turing discounts.

P(w | h) is the discounted relative frequency of the pair where training text has it,
else the history's backoff weight times P(w); P(w) in turn is the discounted relative
frequency of the word, else the mass that the discounts leave for unknown words. Backoff
weights are what a history's discounts leave, over what its unseen words have in P, so all
distributions sum to one.

Pairs are grouped by history in buckets. A task packs the pairs of the texts it reads by
bucket, sorted, so the one shuffle of all pairs moves a few bytes for each. A bucket then
has everything about its histories, and looks its pairs up where they are: counts of
pairs, counts of counts, discount classes per document, mass per history and unseen pairs go to a table
sorted by kind, and the totals turn them into scores. Buckets are small. A frequent history is dealt over several
by the following word, and what it has in each is summed; its total is known from the words, so documents keep how often they use it
and divide by it at the end. Pairs of two of the very most frequent words, which can be too many for any
one bucket, never go to one: a document keeps how often it has each, tasks combine their counts, and the table of
these counts, bounded by the number of such words, is broadcast. (Module ``katz_orders`` has higher orders, by joins.)

Words are known by their 64-bit hashes (XXH64). The most frequent ones (``FREQUENT`` at most)
are broadcast with their counts; what concerns others is joined.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.texts import Numbers, column, frugal, give_back, list_array, octets, pieces
from candlewick.workspace import new_folder, written

DISCOUNTED = 5
"""Counts up to this one are discounted."""
FREQUENT = 1 << 19
PAIRS_IN_BUCKET = 600_000
PAIRS_OF_HISTORY = 250_000
"""Occurrences of a history from which on it is dealt over several buckets."""
TOP_WORDS = 512
"""Words, the most frequent ones, of which pairs are counted apart from all others."""
PIECE = 8 << 20
ROW_GROUP = 4 << 20
"""Bytes in a row group of what the buckets tell: a reader skips the groups of other kinds, and holds little at a time."""

SMALL = 1 << 32
EDGE = int(np.uint64(xxhash.xxh64_intdigest(b"")).view(np.int64))
"""The end of a text as a word, and its start as a history (code 0); words are never empty."""


def words(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def discounts(counts: list[int]) -> list[float]:
    """Katz's Good-Turing factors for counts 1 to k, from the numbers of types with counts 1 to k + 1.

    Where these give no factor between 0 and 1, half an occurrence is taken off.
    """
    k = len(counts) - 1
    common = (k + 1) * counts[k] / counts[0] if counts[0] else 1.0
    out = []
    for r in range(1, k + 1):
        factor = ((r + 1) * counts[r] / (r * counts[r - 1]) - common) / (1 - common) if counts[r - 1] and common != 1 else -1.0
        out.append(factor if 0 < factor < 1 else (r - 0.5) / r)
    return out


@dataclass
class Unigrams:
    """P(w) as a function of the count of w, and the frequent words' counts."""

    total: int
    kinds: int
    texts: int
    factors: list[float]
    unknown: float
    hashes: np.ndarray  # ascending
    counts: np.ndarray
    low: int  # kinds of words that the discounts leave mass of
    history_pairs: int = PAIRS_OF_HISTORY
    dealt: np.ndarray | None = None  # codes of the histories that are dealt out, ascending
    top: np.ndarray | None = None  # those of them whose pairs are counted apart, ascending

    def deal(self, history_pairs: int, top_words: int) -> None:
        """Choose the histories that occur more often than ``history_pairs``; no rarer word than the known ones can."""
        self.history_pairs = history_pairs
        counts = np.r_[self.texts, self.counts]
        self.dealt = np.flatnonzero(counts > history_pairs)
        self.top = np.sort(self.dealt[np.argsort(-counts[self.dealt], kind="stable")[:top_words]])

    @property
    def whole(self) -> int:
        """What counts are divided by; where nothing is discounted, one occurrence is left for unknown words."""
        return max(self.total + (self.low == 0), 1)

    def log_p(self, counts: np.ndarray) -> np.ndarray:
        """log10 P of words with these counts; 0 is an unknown word."""
        factor = np.r_[1.0, self.factors, 1.0][np.minimum(counts, DISCOUNTED + 1)]
        return np.log10(np.where(counts > 0, factor * counts / self.whole, self.unknown))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Small numbers for the edge and the frequent words, which pack well; other words keep their hashes."""
        out = hashes.copy()
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == hashes, at + 1, out)
        return np.where(hashes == EDGE, 0, out)

    def count_of(self, codes: np.ndarray) -> np.ndarray:
        """Counts of words by code; -1 where a word is not among the frequent ones."""
        small = (codes >= 0) & (codes < SMALL)
        return np.where(small, np.r_[self.texts, self.counts][np.where(small, codes, 0)], -1)


def _number(codes: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Places of codes in an ascending list; -1 for others."""
    if not len(among):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(among, codes), len(among) - 1)
    return np.where(among[at] == codes, at, -1)


def count_words(docs: DataFrame) -> DataFrame:
    """``w``, ``n`` of the training texts (``train``); the end of a text is a word too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[bytes] = Counter()
        for batch in batches:
            for piece in pieces(batch):
                for text, train in zip(octets(piece), column(piece, "train").to_pylist(), strict=True):
                    if train:
                        tally.update(words(text))
                        tally[b""] += 1
                if len(tally) > 500_000:
                    yield _tallied(tally)
                    tally = Counter()
        yield _tallied(tally)

    return docs.mapInArrow(frugal(run), "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def _hashed(strings) -> np.ndarray:
    """Hashes of words; none is among the small numbers that serve as codes."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64).view(np.int64)
    return np.where((h >= 0) & (h < SMALL), ~h, h)


def _tallied(tally: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(_hashed(tally)), pa.array(list(tally.values()), pa.int64())], ["w", "n"])


def unigrams(table: DataFrame, frequent: int = FREQUENT) -> Unigrams:
    """From the word counts: totals, discounts, and the words above the count that keeps them below ``frequent``."""
    few = [F.sum((F.col("n") == r).cast("bigint")) for r in range(1, DISCOUNTED + 2)]
    total, kinds, texts, *few = table.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("w") == EDGE, F.col("n"))), *few).first()
    few = [x or 0 for x in few]
    factors, total = discounts(few), total or 0
    low = sum(few[:DISCOUNTED])
    left = sum(few[r - 1] * r * (1 - factors[r - 1]) for r in range(1, DISCOUNTED + 1))
    unknown = left / total if low else 1 / (total + 1)
    size = F.floor(F.log2("n") * 16)
    steps = sorted(table.groupBy(size.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("least")).collect(), key=lambda r: -r["s"])
    least, taken = None, 0
    for step in steps:
        taken += step["k"]
        if taken > frequent:
            break
        least = step["least"]
    found = table.where(F.col("n") >= least).toPandas() if least is not None else None
    hashes = np.array([] if found is None else found["w"], np.int64)
    counts = np.array([] if found is None else found["n"], np.int64)
    order = np.argsort(hashes)
    return Unigrams(total, kinds, texts or 0, factors, unknown, hashes[order], counts[order], low)


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return y ^ (y >> np.uint64(31))


def _packed(arrays: list[np.ndarray], squeeze: zstandard.ZstdCompressor) -> bytes:
    """Columns of equal length, their bytes transposed, compressed."""
    return squeeze.compress(b"".join(a.view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays))


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(3, 8, -1)
    return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(np.int64)[:, :, 0]


# What a task tells of a batch of texts, and what a bucket tells of its pairs, by kind:
#  text     per text of a batch: id, held out (c1), tokens (c2), known frequent tokens (known), their base sum (x)
#  pairs    packed pairs of a batch for a bucket
#  seen     per text: pairs seen 1 to 5 times (c1 to c5), sum of all other logarithms (x)
#  base     per text: known tokens and base sum of words that aren't frequent
#  count    a history's seen pairs: following words (id) and counts (c1)
#  types    numbers of pairs that occur 1 to 6 times (c1)
#  history  seen kinds by count (c1), [occurrences seen more often, all] (id), mass in P of its frequent seen words (x); batch 1 if dealt
#  uses     texts' dealt histories (idx, id) and how often they have them (c1)
#  top_uses the same for pairs of top words; they are in no other kind but
#  top      training counts (c1) of such pairs (id)
#  follower seen words of a history that aren't frequent (id)
#  unseen   texts with pairs of a history that training text has not, one entry per pair (batch, idx)
#  word     the words of such pairs that aren't frequent (batch, idx, id)
_FIELDS = {"kind": "string", "h": "bigint", "batch": "bigint", "idx": "array<int>", "id": "array<bigint>", "x": "array<double>", "known": "array<int>"} | {
    f"c{r}": "array<int>" for r in range(1, DISCOUNTED + 1)
}
_SCHEMA = ", ".join(f"{k} {v}" for k, v in _FIELDS.items())
_TYPES = {"string": pa.string(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}


def _told(kind: str, rows: int, **columns) -> pa.Table:
    """Rows of one kind; a column is an Arrow array, a list of rows, or one value for all."""
    arrays = []
    for name, sql in _FIELDS.items():
        value = kind if name == "kind" else columns.get(name)
        if isinstance(value, pa.Array):
            arrays.append(value.cast(_TYPES[sql]))
        elif isinstance(value, list):
            arrays.append(pa.array(value, _TYPES[sql]))
        else:
            arrays.append(pa.array([value] * rows, _TYPES[sql]))
    return pa.Table.from_arrays(arrays, names=list(_FIELDS))


def pack_pairs(docs: DataFrame, model: Unigrams, buckets: int) -> DataFrame:
    """``bucket``, ``payload`` (packed pairs) and the columns of a ``text`` row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        squeeze, number = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, limit=PIECE):
                yield _pairs_of(piece, sent.value, buckets, number, squeeze)
                give_back()
                number += 1

    return docs.mapInArrow(frugal(run), f"bucket int, payload binary, {_SCHEMA}")


def _pairs_of(piece: pa.RecordBatch, model: Unigrams, buckets: int, batch: int, squeeze: zstandard.ZstdCompressor) -> pa.RecordBatch:
    texts = octets(piece)
    train = column(piece, "train").to_numpy(zero_copy_only=False).astype(bool)
    ids = column(piece, "doc_id")
    numbers = Numbers()
    numbers[b""] = 0
    spots = [np.fromiter(map(numbers.__getitem__, own), np.int64, len(own)) for own in map(words, texts)]
    codes = model.codes(_hashed(numbers))
    counts = model.count_of(codes)
    lengths = np.array([len(s) for s in spots])
    owner = np.repeat(np.arange(len(texts)), lengths)
    flat = np.concatenate(spots) if spots else np.zeros(0, np.int64)
    frequent = counts >= 0
    value = np.where(frequent, np.log10(np.maximum(counts, 0) + 1.0), 0.0)
    base = np.bincount(owner, value[flat], len(texts)) + math.log10(model.texts + 1)
    known = np.bincount(owner, frequent[flat], len(texts)).astype(np.int64) + (model.texts > 0)

    history = np.zeros(len(flat) + len(texts), np.int64)
    following = np.zeros(len(flat) + len(texts), np.int64)
    ends = np.cumsum(lengths + 1)
    inner = np.ones(len(history), bool)
    inner[ends - 1] = False
    following[inner] = flat
    history[1:][inner[:-1]] = flat
    text = np.repeat(np.arange(len(texts)), lengths + 1)
    dealt, top = _number(codes, model.dealt)[history], _number(codes, model.top)
    of_top = (top[history] >= 0) & (top[following] >= 0)
    top_pair = top[history] * len(model.top) + top[following]
    apart = [
        _uses("uses", text[dealt >= 0], dealt[dealt >= 0], max(len(model.dealt), 1), len(texts), batch),
        _uses("top_uses", text[of_top], top_pair[of_top], max(len(model.top) ** 2, 1), len(texts), batch),
        _told("top", 1, **dict(zip(("id", "c1"), ([x.tolist()] for x in np.unique(top_pair[of_top & train[text]], return_counts=True)), strict=True))),
    ]
    history, following, text = history[~of_top], following[~of_top], text[~of_top]
    shares = np.maximum(1, -(-np.maximum(counts, 0) // model.history_pairs))
    mix = _mixed(codes)
    salt = mix[following] % shares[history].astype(np.uint64)
    bucket = ((mix[history] + salt * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(17)) % np.uint64(buckets)
    rank = np.empty(len(codes), np.int64)
    rank[np.argsort(codes)] = np.arange(len(codes))
    order = np.lexsort((text, rank[following], rank[history], bucket))
    bucket = bucket[order].astype(np.int64)
    signed = np.where(train[text[order]], text[order], -1 - text[order])
    h, w = codes[history[order]], codes[following[order]]
    cuts = np.r_[0, np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket)]
    slices = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if len(bucket) else []
    payloads = [_packed([h[a:b], w[a:b], signed[a:b]], squeeze) for a, b in slices]
    table = pa.concat_tables([
        _told("text", 1, batch=batch, idx=[list(range(len(texts)))], id=[ids.to_pylist()], c1=[(~train).astype(int).tolist()], c2=[(lengths + 1).tolist()], known=[known.tolist()], x=[base.tolist()]),
        _told("pairs", len(payloads), batch=batch),
        *apart,
    ])
    table = table.add_column(0, "payload", pa.array([None, *payloads, *[None] * len(apart)], pa.binary()))
    table = table.add_column(0, "bucket", pa.array([batch % buckets, *[int(bucket[a]) for a, _ in slices], *[batch % buckets] * len(apart)], pa.int32()))
    return table.combine_chunks().to_batches()[0]


def _uses(kind: str, text: np.ndarray, what: np.ndarray, kinds: int, texts: int, batch: int) -> pa.Table:
    """How often each text of a batch has what, as one row."""
    keys, times = np.unique(text * kinds + what, return_counts=True)
    return _told(kind, 1, batch=batch, idx=[(keys // kinds).tolist()], id=[(keys % kinds).tolist()], c1=[times.tolist()])


def _bucket(table: pa.Table, model: Unigrams) -> pa.Table:
    """What a bucket tells; rows that aren't packed pairs pass through."""
    is_packed = pa.compute.equal(table["kind"], "pairs")
    out = [table.filter(pa.compute.invert(is_packed)).select(list(_FIELDS))]
    packed = table.filter(is_packed)
    if packed.num_rows:
        blocks = [_unpacked(x) for x in packed["payload"].to_pylist()]
        h, w, signed = np.concatenate(blocks, axis=1)
        batches = packed["batch"].to_numpy()
        batch = np.repeat(np.arange(len(batches)), [b.shape[1] for b in blocks])
        del blocks
        out += _looked_up(h, w, signed, batch, batches, model)
        del h, w, signed, batch
    give_back()
    return pa.concat_tables(out)


def _whole(occurs: np.ndarray, low: np.ndarray) -> np.ndarray:
    """What a history's counts are divided by: how often it occurs, and once more where no pair of it is discounted, to leave something for unseen words."""
    return occurs + ((low == 0) & (occurs > 0))


def _sums_by_text(place: np.ndarray, columns: dict[str, np.ndarray], keys: np.ndarray, batches: np.ndarray, kind: str) -> pa.Table:
    """Sums by text (batch number * 2**32 + text), as one row of lists for each batch."""
    texts, inverse = np.unique(place, return_inverse=True)
    sums = {n: np.bincount(inverse, v, len(texts)) for n, v in columns.items()}
    return _by_batch(texts, sums, batches, kind)


def _by_batch(texts: np.ndarray, values: dict[str, np.ndarray], batches: np.ndarray, kind: str) -> pa.Table:
    """Rows of lists, from values sorted by text."""
    owner = texts >> 32
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(texts) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[cuts, len(texts)])
    lists = {n: list_array(v.astype(float) if n == "x" else v.astype(np.int64), sizes, pa.float64() if n == "x" else pa.int64()) for n, v in values.items()}
    return _told(kind, len(cuts), batch=pa.array(batches[owner[cuts]]), idx=list_array(texts & 0xFFFFFFFF, sizes, pa.int64()), **lists)


def _looked_up(h: np.ndarray, w: np.ndarray, signed: np.ndarray, batch: np.ndarray, batches: np.ndarray, model: Unigrams) -> list[pa.Table]:
    order = np.lexsort((w, h))
    h, w, signed, batch = h[order], w[order], signed[order], batch[order]
    train = signed >= 0
    place = (batch << 32) | np.where(train, signed, -1 - signed)
    new_h = np.r_[True, h[1:] != h[:-1]]
    new_pair = new_h | np.r_[True, w[1:] != w[:-1]]
    pair_of, history_of = np.cumsum(new_pair) - 1, np.cumsum(new_h) - 1
    count = np.bincount(pair_of, train).astype(np.int64)
    pair_h, pair_w, pair_history = h[new_pair], w[new_pair], history_of[new_pair]
    n_histories = int(history_of[-1]) + 1
    first_h = h[new_h]

    # histories: how often each occurs, and which seen words it has
    low = np.stack([np.bincount(pair_history, count == r, n_histories) for r in range(1, DISCOUNTED + 1)], axis=1).astype(np.int64)
    high = np.bincount(pair_history, np.where(count > DISCOUNTED, count, 0), n_histories).astype(np.int64)
    here = np.bincount(history_of, train, n_histories).astype(np.int64)
    told = model.count_of(first_h)
    occurs = np.where(told >= 0, told, here)
    dealt = told > model.history_pairs
    # A dealt history's pairs here are not all it has; texts divide by its total at the end.
    whole = np.where(dealt, 1, np.maximum(_whole(occurs, low.sum(axis=1)), 1))
    word_count = model.count_of(pair_w)
    word_log = model.log_p(np.maximum(word_count, 0))
    mass = np.bincount(pair_history, np.where((count > 0) & (word_count >= 0), 10.0**word_log, 0.0), n_histories)

    # pairs in texts
    c = count[pair_of]
    seen = c > 0
    backs_off = ~seen & (occurs[history_of] > 0)
    frequent = word_count[pair_of] >= 0
    x = np.where(seen, np.log10(np.where(c > DISCOUNTED, c, 1)) - np.log10(whole[history_of]), np.where(frequent, word_log[pair_of], 0.0))
    out = [
        _sums_by_text(place, {f"c{r}": c == r for r in range(1, DISCOUNTED + 1)} | {"x": x}, h, batches, "seen"),
        _told("types", 1, c1=[[int((count == r).sum()) for r in range(1, DISCOUNTED + 2)]]),
    ]
    kept = count > 0
    if kept.any():
        sizes = np.bincount(pair_history[kept], minlength=n_histories)
        out.append(_told("count", int((sizes > 0).sum()), h=pa.array(first_h[sizes > 0]), id=list_array(pair_w[kept], sizes[sizes > 0], pa.int64()), c1=list_array(count[kept], sizes[sizes > 0], pa.int64())))
    rare = told[history_of] < 0
    if rare.any():
        own = here[history_of[rare]]
        out.append(_sums_by_text(place[rare], {"known": own > 0, "x": np.log10(own + 1.0)}, h, batches, "base"))
    needed = np.zeros(n_histories, bool)
    needed[history_of[backs_off]] = True
    needed |= dealt  # another bucket may need its part
    at = np.flatnonzero(needed)
    if len(at):
        out.append(_told("history", len(at), h=pa.array(first_h[at]), batch=pa.array(dealt[at].astype(np.int64)), c1=list_array(low[at].ravel(), np.full(len(at), DISCOUNTED), pa.int64()),
                         id=list_array(np.stack([high[at], occurs[at]], axis=1).ravel(), np.full(len(at), 2), pa.int64()), x=list_array(mass[at], np.ones(len(at), int), pa.float64())))
        follows = needed[pair_history] & (count > 0) & (word_count < 0)
        if follows.any():
            sizes = np.bincount(pair_history[follows], minlength=n_histories)
            out.append(_told("follower", int((sizes > 0).sum()), h=pa.array(first_h[sizes > 0]), id=list_array(pair_w[follows], sizes[sizes > 0], pa.int64())))
    if backs_off.any():
        by = np.lexsort((place[backs_off], history_of[backs_off]))
        texts, histories = place[backs_off][by], history_of[backs_off][by]
        cuts = np.flatnonzero(np.r_[True, (histories[1:] != histories[:-1]) | (texts[1:] >> 32 != texts[:-1] >> 32)])
        sizes = np.diff(np.r_[cuts, len(texts)])
        out.append(_told("unseen", len(cuts), h=pa.array(first_h[histories[cuts]]), batch=pa.array(batches[texts[cuts] >> 32]), idx=list_array(texts & 0xFFFFFFFF, sizes, pa.int64())))
    loose = ~seen & ~frequent
    if loose.any():
        by = np.argsort(place[loose], kind="stable")
        out.append(_by_batch(place[loose][by], {"id": w[loose][by]}, batches, "word"))
    return out


def scores(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT,
    history_pairs: int = PAIRS_OF_HISTORY, bucket_pairs: int = PAIRS_IN_BUCKET, top_words: int = TOP_WORDS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, one row per input row.

    The model learns from the rows for which ``training`` (over ``doc_id``) holds. Scores
    are log10 probabilities of whole texts; ``base_score`` is that of the unigram model with
    one occurrence added to every word. A null or empty text is its end alone. Repeated rows
    count as often as they come. Without training text every word is unknown and all scores are 0.
    ``docs`` should be a stored table: batches of it are read twice and must come alike.
    """
    narrow = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    narrow = narrow.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("train"))
    table = written(count_words(narrow), "unigrams")
    model = unigrams(table, frequent)
    model.deal(history_pairs, top_words)
    buckets = max(8, math.ceil(model.total * 1.5 / bucket_pairs))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    packed = pack_pairs(narrow, model, buckets)
    looked_up = packed.groupBy("bucket").applyInArrow(lambda group: _bucket(group, sent.value), _SCHEMA)
    return _totals(_stored(looked_up), table, model)


def _stored(told: DataFrame) -> DataFrame:
    """What the buckets tell as a table, one file a task, sorted by kind.

    Files by kind would be a dozen a task. Without Hadoop's native library, creating one on a local file system starts
    processes, each of which may count with the executor's whole memory until it has its own.
    Rows may be long, so the size of a row group is looked at every 100 rows.
    """
    folder = new_folder(told.sparkSession, "pairs")
    options = {"parquet.block.size": ROW_GROUP, "parquet.page.size.row.check.max": 100}
    told.sortWithinPartitions("kind").write.options(**options).parquet(folder)
    return told.sparkSession.read.schema(_SCHEMA).parquet(folder)


def _totals(told: DataFrame, table: DataFrame, model: Unigrams) -> DataFrame:
    """Scores from what the buckets told."""
    kind = lambda name: told.where(F.col("kind") == name)
    types = kind("types").agg(*[F.sum(F.col("c1")[r]) for r in range(DISCOUNTED + 1)]).first()
    top = _top_counts(kind("top"), len(model.top))
    factors = discounts([(x or 0) + int((top == r).sum()) for r, x in enumerate(types, 1)])
    probability = _probability(model)

    # backoff weights
    words_of = kind("follower").select("h", F.explode("id").alias("w")).join(table, "w").groupBy("h").agg(F.sum(probability).alias("more"))
    kept = sum((F.sum(F.col("c1")[r] * float((r + 1) * factors[r])) for r in range(DISCOUNTED)), F.sum(F.col("id")[0]).cast("double"))
    occurs, low = F.max(F.col("id")[1]), sum((F.sum(F.col("c1")[r]) for r in range(DISCOUNTED)), F.lit(0))
    whole = occurs + F.when((low == 0) & (occurs > 0), 1).otherwise(0)
    parts = kind("history").unionByName(_top_histories(told.sparkSession, model, top))
    histories = parts.groupBy("h").agg(kept.alias("kept"), whole.alias("whole"), F.sum(F.col("x")[0]).alias("mass"), F.max("batch").alias("dealt"))
    weight = F.log10((1 - F.col("kept") / F.col("whole")) / (1 - F.col("mass") - F.coalesce("more", F.lit(0.0))))
    # Texts divide by the total of a dealt history for every use of it, so also for those that back off.
    log_whole = F.log10(F.col("whole").cast("double"))
    weights = histories.join(words_of, "h", "left").select("h", (weight + F.when(F.col("dealt") == 1, log_whole).otherwise(0.0)).alias("log_weight"), log_whole.alias("log_whole"), "dealt")
    weights = written(weights, "backoff-weights")
    of_dealt, of_top = _dealt_values(weights, model, top, factors)
    backed_off = kind("unseen").select("h", "batch", "idx").join(weights, "h").select("batch", F.explode("idx").alias("i"), F.col("log_weight").alias("v"))
    loose = kind("word").select("batch", F.explode(F.arrays_zip("idx", "id")).alias("p")).select("batch", F.col("p.idx").alias("i"), F.col("p.id").alias("w"))
    log_word = F.log10(F.coalesce(probability, F.lit(float(model.unknown))))
    unknown = loose.join(table, "w", "left").select("batch", "i", log_word.alias("v"))
    more = backed_off.union(unknown).groupBy("batch", "i").agg(F.sum("v").alias("v"))
    extra = more.groupBy("batch").agg(F.collect_list("i").alias("idx"), F.collect_list("v").alias("x"))
    rows = told.where(F.col("kind").isin("text", "seen", "base", "uses", "top_uses"))
    rows = rows.drop("h").unionByName(extra.withColumn("kind", F.lit("extra")), allowMissingColumns=True)
    logs = [math.log10((r + 1) * factors[r]) for r in range(DISCOUNTED)]
    per_token = math.log10(model.total + model.kinds + 1)
    total = model.total
    sent = told.sparkSession.sparkContext.broadcast((of_dealt, of_top))

    def added(group: pa.Table) -> pa.Table:
        text = group.filter(pa.compute.equal(group["kind"], "text")).to_pylist()[0]
        n = len(text["idx"])
        score, base, known = np.zeros(n), np.array(text["x"]), np.array(text["known"], np.int64)
        for name in ("seen", "base", "extra", "uses", "top_uses"):
            part = group.filter(pa.compute.equal(group["kind"], name))
            if not part.num_rows:
                continue
            take = lambda c: pa.compute.list_flatten(part[c].combine_chunks()).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            idx = take("idx")
            if name in ("uses", "top_uses"):
                value = -sent.value[0] if name == "uses" else sent.value[1]
                score += np.bincount(idx, take("c1") * value[take("id")], n)
            elif name == "base":
                base = base + np.bincount(idx, take("x"), n)
                known = known + np.bincount(idx, take("known"), n).astype(np.int64)
            else:
                value = take("x")
                if name == "seen":
                    value = value + sum(take(f"c{r + 1}") * logs[r] for r in range(DISCOUNTED))
                score += np.bincount(idx, value, n)
        give_back()
        tokens = np.array(text["c2"], np.int64)
        columns = [pa.array(text["id"], pa.int64()), pa.array(np.array(text["c1"]) == 1), pa.array(tokens), pa.array(known), pa.array([total] * n, pa.int64()), pa.array(base - tokens * per_token), pa.array(score)]
        return pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.groupBy("batch").applyInArrow(added, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def _top_counts(rows: DataFrame, words: int) -> np.ndarray:
    """Training counts of all pairs of top words, as a matrix; its size is bounded by their number."""
    pairs = rows.select(F.explode(F.arrays_zip("id", "c1")).alias("p")).groupBy(F.col("p.id").alias("pair")).agg(F.sum("p.c1").alias("n"))
    counts = np.zeros(words * words, np.int64)
    for r in pairs.collect():
        counts[r["pair"]] = r["n"]
    return counts.reshape(words, words)


def _top_histories(spark: SparkSession, model: Unigrams, top: np.ndarray) -> DataFrame:
    """What pairs of top words add to the ``history`` rows of their histories."""
    p = 10.0 ** model.log_p(model.count_of(model.top))
    rows = []
    for i, (code, counts) in enumerate(zip(model.top.tolist(), top, strict=True)):
        low = [int((counts == r).sum()) for r in range(1, DISCOUNTED + 1)]
        high, occurs = int(counts[counts > DISCOUNTED].sum()), int(model.count_of(model.top[i : i + 1])[0])
        rows.append(("history", code, 1, None, [high, occurs], [float(p[counts > 0].sum())], None, low, None, None, None, None))
    return spark.createDataFrame(rows, _SCHEMA)


def _dealt_values(weights: DataFrame, model: Unigrams, top: np.ndarray, factors: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the totals of the dealt histories, and log10 P, times the total, of all pairs of top words."""
    log_whole, log_weight = np.zeros(len(model.dealt)), np.zeros(len(model.dealt))
    for r in weights.where("dealt = 1").collect():
        at = int(np.searchsorted(model.dealt, r["h"]))
        log_whole[at], log_weight[at] = r["log_whole"], r["log_weight"] if r["log_weight"] is not None else 0.0
    factor = np.r_[1.0, factors, 1.0][np.minimum(top, DISCOUNTED + 1)]
    seen = np.log10(np.maximum(factor * top, 1e-300))
    unseen = log_weight[np.searchsorted(model.dealt, model.top)][:, None] + model.log_p(model.count_of(model.top))[None, :]
    return log_whole, np.where(top > 0, seen, unseen).ravel()


def _probability(model: Unigrams) -> Column:
    """P of a word of the count table, as :meth:`Unigrams.log_p` has it."""
    cases = [(F.col("n") == r + 1, F.lit(model.factors[r])) for r in range(DISCOUNTED)]
    return reduce(lambda otherwise, case: F.when(case[0], case[1]).otherwise(otherwise), cases, F.lit(1.0)) * F.col("n") / F.lit(float(model.whole))
