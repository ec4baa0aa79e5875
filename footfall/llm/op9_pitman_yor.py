"""Operator 9: hierarchical Pitman-Yor language model over words.

Restaurants form three levels. The root seats words without context. Below it are restaurants of
classes of the word before (its last two bytes, dealt into ``CLASSES``; one class is the start of a
text); below those, one restaurant for every word before that is seen in training. A table of a
restaurant is a customer of its parent, and restaurants share their parents.

Texts are dealt into chunks. A chunk sends each distinct pair of restaurant and word once, with
its count in training texts, to the bucket of the word, where all restaurants that serve the word
meet: one word has at most one row per restaurant. Buckets run Gibbs sweeps that seat all customers
anew, level by level, given the parent's current predictive probability (the first 64 customers of
a dish one by one, later ones in blocks of an eighth of those seated). Restaurants' totals are
summed over all buckets after each round and held during the next: those of the root and the classes
on the driver, those of words in a table, from which each bucket gets the words it seats for. A word
before has as many customers as its count, and a table less for each customer that joined another;
so only dishes of two customers or more are summed, once per word before and bucket.

The seatings at the end of the last ``SAMPLES`` rounds are the samples. Their seeds are fixed, so
the last pass seats them again, and now the totals of just these seatings are known: each sample
gives proper probabilities, which sum to one over all words, the end and the unknown. Averaged over
the samples are the classes' predictive probabilities, and of words before the discounted customers
and the tables; a word's restaurant then adds what its customers and its class's average say, which
sums to one as well. The averages go back to the chunks, and the chunks score their texts.
Discounts are estimated from counts of counts, the strength is a parameter.

Defined results: null, empty and blank texts hold the end token only. A null id counts as the
empty text and is trained on. Repeated rows count again. Unknown words share one base probability.
Without training texts all counts are 0. An empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import zlib
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import discard, in_chunks, n_chunks, stored, words_of

CHUNK_BYTES = 8 << 20
CLASSES = 256
STRENGTH = 5.0
#: Rounds, seatings of a round, and rounds whose last seating is a sample.
ROUNDS, SWEEPS, SAMPLES = 3, 2, 2
END = np.uint64(0xE2D0F0A1B2C3D4E5)
_DATA = "bucket long, chunk long, data binary"


class Tokens(NamedTuple):
    """Tokens of all texts, an end after each: word hash, word before (0 at the start), its class,
    row, first token of each row, and whether the row is trained on."""

    hash: np.ndarray
    before: np.ndarray
    group: np.ndarray
    row: np.ndarray
    first: np.ndarray
    trained: np.ndarray


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tokens_of(table) -> Tokens:
    words = words_of(table.column("text"), fold=True)
    n_rows = len(words.first) - 1
    row = words.rows()
    first = words.first + np.arange(n_rows + 1)
    at = np.arange(len(row)) + row
    hashes = np.full(len(row) + n_rows, END, np.uint64)
    hashes[at] = words.hash
    classes = np.zeros(len(hashes), np.int64)  # of the token itself
    if len(row):
        low = np.arange(256)
        low[65:91] += 32
        last = low[words.data[words.end - 1]]
        second = np.where(words.end - words.start > 1, low[words.data[np.maximum(words.end - 2, 0)]], 0)
        classes[at] = (last * 31 + second * 7) % (CLASSES - 1) + 1
    before, group = np.zeros(len(hashes), np.uint64), np.zeros(len(hashes), np.int64)
    before[1:], group[1:] = hashes[:-1], classes[:-1]
    before[first[:-1]], group[first[:-1]] = 0, 0
    trained = np.array([not is_held_out(i) for i in table.column("doc_id").to_pylist()], bool)
    return Tokens(hashes, before, group, np.repeat(np.arange(n_rows), np.diff(first)), first, trained)


class Contexts(NamedTuple):
    """Restaurants of words before, numbered from ``CLASSES`` on, with their classes."""

    words: np.ndarray  # sorted hashes
    parent: np.ndarray


#: A pair is a word's number and, in the low bits, its restaurant's.
_LOW = 32


def distinct_pairs(t: Tokens):
    """Sorted distinct words; the contexts; per distinct (word, restaurant) its word, restaurant
    and training count; and the pair of each token. Only the start has a class for a restaurant."""
    words, inverse = np.unique(t.hash, return_inverse=True)
    before, at, own = np.unique(t.before, return_index=True, return_inverse=True)
    start = int(len(before) > 0 and before[0] == 0)
    contexts = Contexts(before[start:], t.group[at][start:])
    context = np.where(t.before == 0, 0, CLASSES + own - start)
    pairs, index = np.unique(inverse << _LOW | context, return_inverse=True)
    count = np.bincount(index, weights=t.trained[t.row], minlength=len(pairs)).astype(np.int64)
    return words, contexts, pairs >> _LOW, pairs & ((1 << _LOW) - 1), count, index


def _cuts(words: np.ndarray, bits: int):
    cuts = np.searchsorted(words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.append(cuts, len(words))
    return [(int(b), cuts[b], cuts[b + 1]) for b in np.flatnonzero(np.diff(cuts))]


def _planes(part: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, so that leading zeros take no room once compressed."""
    part = np.ascontiguousarray(part)
    if part.dtype.kind == "f":
        return part.tobytes()
    return part.view(np.uint8).reshape(-1, part.itemsize).T.tobytes()


def _arrays(*parts) -> bytes:
    """Arrays of any kinds in one compressed value."""
    head = np.array([len(parts)] + [p.nbytes for p in parts], np.int64).tobytes()
    data = head + b"".join(map(_planes, parts))
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _read(data, *kinds) -> list[np.ndarray]:
    size = int.from_bytes(bytes(data[:8]), "little")
    data = pa.decompress(pa.py_buffer(data)[8:], decompressed_size=size, codec="zstd")
    n = len(kinds)
    sizes = np.frombuffer(data, np.int64, n + 1)[1:]
    at, out = 8 * (n + 1), []
    for size, kind in zip(sizes, map(np.dtype, kinds)):
        part = np.frombuffer(data, np.uint8, int(size), at)
        if kind.kind != "f":
            part = np.ascontiguousarray(part.reshape(kind.itemsize, -1).T).ravel()
        out.append(part.view(kind))
        at += int(size)
    return out


def _steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ascending runs of ``sizes``: the first of each run as it is, others less the one before."""
    step = np.diff(values, prepend=values[:1])
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    step[starts] = values[starts]
    return step


def _from_steps(step: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.cumsum(step, dtype=step.dtype)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    return sums - np.repeat(sums[starts] - step[starts], sizes[sizes > 0])


def _one(values: np.ndarray) -> np.ndarray:
    """The size of an array that is one run."""
    return np.array([len(values)], np.int64)


def _ask(bits: int):
    def run(table: pa.Table) -> pa.Table:
        words, contexts, of_word, context, count, _ = distinct_pairs(tokens_of(table))
        begin = np.searchsorted(of_word, np.arange(len(words) + 1))
        buckets, data = [], []
        for b, lo, hi in _cuts(words, bits):
            p = slice(begin[lo], begin[hi])
            n = np.diff(begin[lo : hi + 1]).astype(np.uint32)
            used = np.unique(context[p])
            used = used[used >= CLASSES]
            own = np.where(context[p] < CLASSES, context[p], CLASSES + np.searchsorted(used, context[p]))
            own, before = own.astype(np.uint32), contexts.words[used - CLASSES]
            buckets.append(b)
            data.append(_arrays(
                _steps(words[lo:hi], _one(words[lo:hi])), n, _steps(own, n), count[p].astype(np.uint32),
                _steps(before, _one(before)), contexts.parent[used - CLASSES].astype(np.uint8)))
        chunk = table["chunk"][0].as_py()
        return pa.table([pa.array(buckets, pa.int64()), pa.array([chunk] * len(data), pa.int64()), pa.array(data, pa.binary())],
                        ["bucket", "chunk", "data"])

    return run


def _asked(data) -> list[np.ndarray]:
    """What ``_ask`` sent: words, pairs of each, their restaurants and counts; contexts, their classes."""
    words, n, own, count, before, classes = _read(data, np.uint64, np.uint32, np.uint32, np.uint32, np.uint64, np.uint8)
    return [_from_steps(words, _one(words)), n, _from_steps(own, n), count, _from_steps(before, _one(before)), classes]


_MERGED_KINDS = (np.uint64, np.uint32, np.uint32, np.int64, np.int64, np.int64, np.uint32)


_MERGED = "bucket long, data binary, contexts binary"


def _merge(table: pa.Table) -> pa.Table:
    """One row per bucket: its words, its pairs with their counts, and which pairs a chunk asked."""
    rows = sorted(zip(table["chunk"].to_pylist(), table["data"].to_pylist()))
    parts = [_asked(d) for _, d in rows]
    words = np.unique(np.concatenate([p[0] for p in parts]))
    before, at = np.unique(np.concatenate([p[4] for p in parts]), return_index=True)
    classes = np.concatenate([p[5] for p in parts])[at]
    key = []
    for p in parts:
        restaurant = np.concatenate([np.arange(CLASSES), CLASSES + np.searchsorted(before, p[4])])[p[2]]
        key.append(np.repeat(np.searchsorted(words, p[0]), p[1]).astype(np.int64) << _LOW | restaurant)
    pairs, asked = np.unique(np.concatenate(key), return_inverse=True)
    count = np.bincount(asked, weights=np.concatenate([p[3] for p in parts]), minlength=len(pairs))
    sizes = np.array([len(p[2]) for p in parts], np.int64)
    per_word = np.bincount(pairs >> _LOW, minlength=len(words)).astype(np.uint32)
    restaurants = (pairs & ((1 << _LOW) - 1)).astype(np.uint32)
    data = _arrays(
        _steps(words, _one(words)), per_word, _steps(restaurants, per_word), count.astype(np.int64),
        np.array([c for c, _ in rows], np.int64), sizes, _steps(asked.astype(np.uint32), sizes),
    )
    values = [data, _arrays(_steps(before, _one(before)), classes)]
    return pa.table([pa.array([table["bucket"][0].as_py()], pa.int64()), *(pa.array([v], pa.binary()) for v in values)],
                    ["bucket", "data", "contexts"])


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables that ``customers`` of one dish take, if a new table has the weight ``fresh``."""
    out = np.minimum(customers, 1).astype(np.float64)
    many = np.flatnonzero(customers > 1)  # one customer has one table
    order = many[np.argsort(-customers[many], kind="stable")]
    c, a = customers[order], fresh[order]
    t = np.ones(len(order))
    n = 1
    up = -c  # ascending, for counting how many have more than n
    while k := int(np.searchsorted(up, -n, "left")):
        step = 1 if n < 64 else n // 8
        p = a[:k] / (n - discount * t[:k] + a[:k])
        if step == 1:
            t[:k] += rng.random(k) < p
        else:
            t[:k] += rng.binomial(np.minimum(step, c[:k] - n), np.clip(p, 0, 1))
        n += step
    out[order] = t
    return out


class Totals(NamedTuple):
    """Customers and tables of each restaurant of a class, of a bucket's contexts, and of the root."""

    customers: np.ndarray
    tables: np.ndarray
    root_customers: float
    root_tables: float
    vocabulary: int
    tokens: int
    discounts: tuple  # root, class, word


class Bucket:
    """Words of one bucket with all restaurants that serve them."""

    def __init__(self, data, contexts: Contexts):
        words, per_word, steps, self.count, self.chunks, self.sizes, asked = _read(data, *_MERGED_KINDS)
        self.words = _from_steps(words, _one(words))
        self.word_of = np.repeat(np.arange(len(self.words)), per_word)
        self.asked = _from_steps(asked, self.sizes)
        self.context = _from_steps(steps, per_word).astype(np.int64)
        self.leaf = self.context >= CLASSES
        parent = self.context.copy()
        parent[self.leaf] = contexts.parent[self.context[self.leaf] - CLASSES]
        # (word, class) pairs, also those that only frequent words use
        self.classes, self.class_of = np.unique(self.word_of << 8 | parent, return_inverse=True)
        self.class_word, self.class_id = self.classes >> 8, self.classes & 255
        self.leaf_at = np.flatnonzero(self.leaf)
        self.leaf_class, self.leaf_count = self.class_of[self.leaf_at], self.count[self.leaf_at]
        self.leaf_one = np.minimum(self.leaf_count, 1).astype(float)
        self.many = np.flatnonzero(self.leaf_count > 1)  # the only dishes that are seated by chance
        self.many_class, self.many_count = self.leaf_class[self.many], self.leaf_count[self.many]
        self.many_context = self.context[self.leaf_at][self.many]
        self.direct = np.bincount(self.class_of[~self.leaf], self.count[~self.leaf], len(self.classes))
        one = np.where(self.leaf_count > 1, 0, self.leaf_one)
        self.direct = self.direct + np.bincount(self.leaf_class, one, len(self.classes))
        self.total = np.bincount(self.word_of, self.count, len(self.words))
        self.open()

    def open(self):
        """One table per dish, the state that every round begins with."""
        self.leaf_tables = self.leaf_one.copy()
        self.gather()
        self.class_tables = np.minimum(self.class_customers, 1)
        self.root_customers = np.bincount(self.class_word, self.class_tables, len(self.words))
        self.root_tables = np.minimum(self.root_customers, 1)

    def gather(self):
        """Customers of classes; ``direct`` are those that no seating changes."""
        self.class_customers = self.direct + np.bincount(self.many_class, self.leaf_tables[self.many], len(self.classes))

    def above(self, s: Totals):
        """Predictive probabilities of words and (word, class) pairs."""
        d0, d1, _ = s.discounts
        uniform = 1 / (s.vocabulary + 1)
        p0 = (self.root_customers - d0 * self.root_tables + (STRENGTH + d0 * s.root_tables) * uniform) / (STRENGTH + s.root_customers)
        k = self.class_id
        p1 = (self.class_customers - d1 * self.class_tables + (STRENGTH + d1 * s.tables[k]) * p0[self.class_word]) / (STRENGTH + s.customers[k])
        return p0, p1

    def predict(self, s: Totals):
        """Predictive probabilities of words, (word, class) pairs and all pairs."""
        d2 = s.discounts[2]
        p0, p1 = self.above(s)
        p = p1[self.class_of]
        at, u = self.leaf_at, self.context[self.leaf_at]
        p[at] = (self.count[at] - d2 * self.leaf_tables + (STRENGTH + d2 * s.tables[u]) * p[at]) / (STRENGTH + s.customers[u])
        return p0, p1, p

    def sweep(self, s: Totals, rng):
        """Seat all customers anew, from the leaves to the root."""
        d0, d1, d2 = s.discounts
        p0, p1 = self.above(s)
        fresh = (STRENGTH + d2 * s.tables[self.many_context]) * p1[self.many_class]
        self.leaf_tables[self.many] = seat(self.many_count, fresh, d2, rng)
        self.gather()
        self.class_tables = seat(
            self.class_customers.astype(np.int64), (STRENGTH + d1 * s.tables[self.class_id]) * p0[self.class_word], d1, rng
        )
        self.root_customers = np.bincount(self.class_word, self.class_tables, len(self.words))
        fresh = np.full(len(self.words), (STRENGTH + d0 * s.root_tables) / (s.vocabulary + 1))
        self.root_tables = seat(self.root_customers.astype(np.int64), fresh, d0, rng)

    def totals(self):
        """(class or a negative key, customers, tables) of this bucket."""
        customers = np.bincount(self.class_id, self.class_customers, CLASSES)
        tables = np.bincount(self.class_id, self.class_tables, CLASSES)
        at = np.flatnonzero(customers)
        singles = lambda c: (float((c == 1).sum()), float((c == 2).sum()))
        extra = [(self.root_customers.sum(), self.root_tables.sum()), (float((self.total > 0).sum()), self.total.sum()),
                 singles(self.root_customers), singles(self.class_customers), singles(self.leaf_count)]
        keys = np.append(at, -1 - np.arange(len(extra)))
        return keys, np.append(customers[at], [e[0] for e in extra]), np.append(tables[at], [e[1] for e in extra])

    def word_totals(self, contexts: Contexts):
        """(word before, customers, customers without a table of their own) that this bucket knows.

        The bucket that a word itself is in knows its customers: each of its tokens has a next one.
        Words without a dish of two customers lack no table, so only words seen twice count.
        """
        many, tables = self.many_context - CLASSES, self.leaf_tables[self.many]
        lacking = np.bincount(many, self.many_count - tables, len(contexts.words))
        seats = np.flatnonzero(np.bincount(many, minlength=len(contexts.words)))
        own = self.total > 1
        words, at = np.unique(np.concatenate([contexts.words[seats], self.words[own]]), return_inverse=True)
        customers, lack = np.zeros(len(words)), np.zeros(len(words))
        lack[at[: len(seats)]] = lacking[seats]
        customers[at[len(seats) :]] = self.total[own]
        return words, customers, lack


_STATS = "word boolean, bucket long, k long, customers double, tables double"


def _stats(b: int, bucket: Bucket, contexts: Contexts, later: bool = False) -> pa.Table:
    """Totals of a bucket. Customers of words before never change, so rows of ``later`` rounds
    stand only for words before with customers that lack a table of their own."""
    words = bucket.word_totals(contexts)
    if later:
        lacks = words[2] != 0
        words = tuple(x[lacks] for x in words)
    parts = [bucket.totals(), words]
    n = [len(p[0]) for p in parts]
    k, customers, tables = (np.concatenate([p[c].view(np.int64) if c == 0 else p[c] for p in parts]) for c in range(3))
    columns = [pa.array(np.repeat([False, True], n)), pa.array(np.full(sum(n), b)), *map(pa.array, (k, customers, tables))]
    return pa.table(columns, ["word", "bucket", "k", "customers", "tables"])


def _contexts(row) -> Contexts:
    before, classes = _read(row["contexts"], np.uint64, np.uint8)
    return Contexts(_from_steps(before, _one(before)), classes)


def _first(batches):
    for batch in batches:
        for r in batch.to_pylist():
            contexts = _contexts(r)
            yield from _stats(r["bucket"], Bucket(r["data"], contexts), contexts).to_batches()


class Known:
    """Totals of words before, after one or more rounds, as a bucket gets them.

    Contexts that the bucket seats nobody anew for are left at zero, for nothing depends on them.
    """

    def __init__(self, table: pa.Table):
        k = table["k"].to_numpy().view(np.uint64)
        order = np.argsort(k)
        self.k, self.customers = k[order], table["customers"].to_numpy()[order]
        lists = table["lacking"].combine_chunks()
        self.lacking = lists.flatten().to_numpy().reshape(table.num_rows, -1)[order] if table.num_rows else None

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``words`` are known, and whether they are."""
        if not len(self.k):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        i = np.minimum(np.searchsorted(self.k, words), len(self.k) - 1)
        return i, self.k[i] == words

    def lack(self, found: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
        """Customers without a table of their own after the k-th of the rounds, where ``find`` has found."""
        i, known = found
        return np.where(known, self.lacking[i, k], 0) if len(self.k) else np.zeros(len(i))

    def held(self, totals: Totals, found: tuple[np.ndarray, np.ndarray], k: int) -> Totals:
        """The totals of classes after the k-th of the rounds, and those of the bucket's contexts."""
        i, known = found
        of = np.where(known, self.customers[i], 0) if len(self.k) else np.zeros(len(i))
        tables = of - self.lack(found, k)
        return totals._replace(customers=np.append(totals.customers, of), tables=np.append(totals.tables, tables))


def _seated(bucket: Bucket, held: Totals, b: int, number: int) -> None:
    """Seat a bucket's customers as round ``number`` does."""
    rng = np.random.default_rng([b, number])
    bucket.open()
    for _ in range(SWEEPS):
        bucket.sweep(held, rng)


def _round(totals: Totals, number: int):
    def run(merged: pa.Table, known: pa.Table) -> pa.Table:
        r = merged.to_pylist()[0]
        contexts = _contexts(r)
        bucket = Bucket(r["data"], contexts)
        of = Known(known)
        _seated(bucket, of.held(totals, of.find(contexts.words), 0), r["bucket"], number)
        return _stats(r["bucket"], bucket, contexts, later=True)

    return run


def _answer(totals: list[Totals], last: int):
    """Per chunk and bucket: counts and missing tables of its words, discounted customers of its
    pairs, and the probabilities of the (word, class) pairs behind them.

    ``totals`` are those after the round before the first sample and after each sample's round,
    of which ``last`` is the number of the last one; so is what is known of words before.
    """

    def run(merged: pa.Table, known: pa.Table) -> pa.Table:
        r = merged.to_pylist()[0]
        b, contexts, of = r["bucket"], _contexts(r), Known(known)
        bucket = Bucket(r["data"], contexts)
        samples = len(totals) - 1
        found = of.find(contexts.words)
        seated, parent = np.zeros(len(bucket.context)), np.zeros(len(bucket.classes))
        for k in range(samples):
            _seated(bucket, of.held(totals[k], found, k), b, last - samples + 1 + k)
            own = of.held(totals[k + 1], found, k + 1)
            discounted = bucket.leaf_count - totals[0].discounts[2] * bucket.leaf_tables
            seated[bucket.leaf_at] += discounted / samples
            parent += bucket.above(own)[1] / samples
        seated, parent = seated.astype(np.float32), parent.astype(np.float32)
        ends = np.cumsum(bucket.sizes)
        words_found = of.find(bucket.words)
        lacking = sum(of.lack(words_found, k + 1) for k in range(samples)) / samples
        marked = np.zeros(len(bucket.classes), bool)
        out = []
        for begin, end in zip(ends - bucket.sizes, ends):
            asked = bucket.asked[begin:end]
            words = bucket.word_of[asked]  # ascending
            words = words[np.diff(words, prepend=-1) > 0]
            own = bucket.class_of[asked]
            lo, hi = own.min(), own.max() + 1
            marked[own] = True
            classes = lo + np.flatnonzero(marked[lo:hi])
            marked[own] = False
            out.append(_arrays(bucket.total[words].astype(np.int64), lacking[words], seated[asked], parent[classes]))
        return pa.table([pa.array([b] * len(out), pa.int64()), pa.array(bucket.chunks), pa.array(out, pa.binary())],
                        ["bucket", "chunk", "data"])

    return run


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def token_values(t: Tokens, answers: pa.Table, totals: Totals, bits: int):
    """Training count of each token's word, and the log10 of its averaged predictive probability."""
    words, contexts, of_word, context, _, index = distinct_pairs(t)
    begin = np.searchsorted(of_word, np.arange(len(words) + 1))
    leaf = context >= CLASSES
    parent_class = context.copy()
    parent_class[leaf] = contexts.parent[context[leaf] - CLASSES]
    classes, class_of = np.unique(of_word << 8 | parent_class, return_inverse=True)
    class_begin = np.searchsorted(classes >> 8, np.arange(len(words) + 1))
    said = dict(zip(answers["bucket"].to_pylist(), answers["data"]))
    count, lack = np.zeros(len(words), np.int64), np.zeros(len(words))
    seated, parent = np.zeros(len(of_word)), np.zeros(len(classes))
    for b, lo, hi in _cuts(words, bits):
        p, q = slice(begin[lo], begin[hi]), slice(class_begin[lo], class_begin[hi])
        count[lo:hi], lack[lo:hi], seated[p], parent[q] = _read(
            said[b].as_buffer(), np.int64, np.float64, np.float32, np.float32
        )
    at = np.flatnonzero(leaf)
    u = np.searchsorted(words, contexts.words)[context[at] - CLASSES]  # a word before is a word of the chunk
    probability = parent[class_of]
    fresh = STRENGTH + totals.discounts[2] * (count[u] - lack[u])
    probability[at] = (seated[at] + fresh * probability[at]) / (STRENGTH + count[u])
    return count[of_word[index]], np.log10(probability)[index]


def _score(totals: Totals, bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _OUT.empty_table()
        t = tokens_of(docs)
        known, value = token_values(t, answers, totals, bits)
        base = np.log10((known + 1) / (totals.tokens + 1 * (totals.vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, t.first[:-1])
        n = docs.num_rows
        columns = [docs["doc_id"].combine_chunks(), ~t.trained, np.diff(t.first), add((known > 0).astype(np.int64)),
                   np.full(n, totals.tokens), add(base), add(value)]
        return pa.table([pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(columns, _OUT)], schema=_OUT)

    return run


def _sum(stats: DataFrame) -> Totals:
    """Totals over all buckets but those of words; one row per class comes to the driver."""
    rows = stats.where("not word").groupBy("k").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t")).collect()
    customers, tables, extra = np.zeros(CLASSES), np.zeros(CLASSES), {}
    for r in rows:
        if r["k"] >= 0:
            customers[r["k"]], tables[r["k"]] = r["c"], r["t"]
        else:
            extra[-1 - r["k"]] = (r["c"], r["t"])
    get = lambda k: extra.get(k, (0.0, 0.0))
    discount = lambda once, twice: min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    return Totals(customers, tables, *get(0), int(get(1)[0]), int(get(1)[1]), tuple(discount(*get(k)) for k in (2, 3, 4)))


def _wanted(start: DataFrame) -> DataFrame:
    """(bucket, k, customers, seats) of the words that buckets know of; customers never change.

    Of ``start``, the totals before any round. A bucket seats customers anew for the words with
    ``seats``; of the others it is asked how many lack a table in the end.
    """
    words = start.where("word")
    customers = words.groupBy("k").agg(F.sum("customers").alias("customers"))
    return words.select("bucket", "k", (F.col("tables") > 0).alias("seats")).join(customers, "k")


def _by_word(wanted: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(bucket, k, customers, lacking after each of ``rounds``) of ``wanted`` words."""
    n = len(rounds)
    lists = [
        stats.where("word and tables != 0").select("k", *(F.col("tables") if j == i else F.lit(0.0) for j in range(n)))
        for i, stats in enumerate(rounds)
    ]
    names = [f"lacking{j}" for j in range(n)]
    summed = reduce(DataFrame.union, lists).toDF("k", *names).groupBy("k").agg(*(F.sum(c).alias(c) for c in names))
    lacking = F.array(*(F.coalesce(c, F.lit(0.0)) for c in names)).alias("lacking")
    return wanted.join(summed, "k", "left").select("bucket", "k", "customers", lacking)


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of all ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = n_chunks(docs, "text", 1)
    bits = max(3, (total // 6_000_000).bit_length())

    dealt = in_chunks(docs, ["doc_id", "text"], max(1, -(-total // CHUNK_BYTES)))
    asked = dealt.groupBy("chunk").applyInArrow(_ask(bits), _DATA)
    merged = stored(asked.groupBy("bucket").applyInArrow(_merge, _MERGED), "restaurants")
    rounds = [stored(merged.mapInArrow(_first, _STATS), "totals")]
    totals = [_sum(rounds[0])]
    wanted = stored(_wanted(rounds[0]), "words-before")

    def meet(run, ddl: str, known: DataFrame) -> DataFrame:
        """The model meets the totals of its contexts bucket by bucket."""
        return merged.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(run, ddl)

    for number in range(1, 1 + ROUNDS):
        rounds.append(stored(meet(_round(totals[-1], number), _STATS, _by_word(wanted.where("seats"), rounds[-1:])), "totals"))
        totals.append(_sum(rounds[-1]))
    kept = 1 + SAMPLES
    answers = stored(meet(_answer(totals[-kept:], ROUNDS), _DATA, _by_word(wanted, rounds[-kept:])), "answers")
    discard(merged, wanted, *rounds)  # only the answers are read from here on
    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(totals[-1], bits), ddl)
