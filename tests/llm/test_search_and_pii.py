"""Personal data, ranked lexical search and hard negatives against plain versions."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import op11_pii as op11
from footfall.llm import op12_lexical as op12
from footfall.llm import op13_negatives as op13
from footfall.llm.common import ship

# ---------------------------------------------------------------------------------------------
# personal data
# ---------------------------------------------------------------------------------------------

PLAIN = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def plain_spans(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if op11.passes(k, m.group()))


@pytest.fixture(scope="module")
def labelled(spark):
    return [tuple(r) for r in op11.labelled_table(ship(spark)).collect()]


@pytest.fixture(scope="module")
def field(labelled):
    return op11.train(labelled)


def test_base_spans_like_the_patterns():
    rng = random.Random(7)
    for letters in ("a@.1 92+-()5%b..00 ", "0123456789 -+.", "ab@.-"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
            assert op11.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "@" * 100_000, "1 " * 50_000])
def test_long_texts_take_linear_time(text):
    op11.base_spans(text)
    op11.sequences(text)


def random_field(rng):
    f = op11.Field({name: k for k, name in enumerate(("bias", "short=9", "short=a@a", "before=none", "digits=4"))})
    f.weights[:-1] = rng.normal(size=f.weights[:-1].shape)
    f.steps[:] = rng.normal(size=f.steps.shape)
    return f


def path_score(f, tokens, path):
    n, here = len(op11.TAGS), f.scores(tokens)
    steps = sum(f.steps[a, b] for a, b in zip(path, path[1:]))
    return sum(here[t, y] for t, y in enumerate(path)) + f.steps[n, path[0]] + f.steps[n + 1, path[-1]] + steps


def test_viterbi_and_likelihood_by_enumeration():
    f = random_field(np.random.default_rng(3))
    seqs = [["1234", "a@a", "9"], ["a@a"], ["9", "9"], ["1234", "5678"]]
    ways = [list(itertools.product(range(len(op11.TAGS)), repeat=len(s))) for s in seqs]
    best = [max(w, key=lambda p, s=s: path_score(f, s, p)) for s, w in zip(seqs, ways)]
    assert [tuple(p) for p in f.paths(seqs)] == best
    tags = [np.arange(len(s)) for s in seqs]
    padded = lambda w: ([f.names.get(x, 5) for x in op11.features(*w)] + [5] * 99)[:30]
    rows = [np.array([padded(w) for w in op11._windows(s)]) for s in seqs]
    want = sum(
        path_score(f, s, tuple(t)) - np.log(sum(math.exp(path_score(f, s, p)) for p in w))
        for s, t, w in zip(seqs, tags, ways)
    )
    total, to_weights, to_steps = op11.likelihood(f, rows, tags)
    assert total == pytest.approx(want)
    for x, slope, at in ((f.weights, to_weights, (1, 2)), (f.steps, to_steps, (0, 1)), (f.steps, to_steps, (9, 1))):
        x[at] += 1e-6
        assert (op11.likelihood(f, rows, tags)[0] - total) / 1e-6 == pytest.approx(slope[at], abs=1e-3)
        x[at] -= 1e-6


def decoded(field, text, base=()):
    seqs = op11.sequences(text)
    paths = field.paths([[text[lo:hi] for lo, hi in s] for s in seqs])
    return sorted(x for s, p in zip(seqs, paths) for x in op11.added_spans(text, s, p, base))


def test_field_learns_its_table_and_more(field, labelled):
    for text, spans in labelled:
        assert op11.written(decoded(field, text)) == spans, text
    held_out = [
        ("Pour +1 (917) 555-0163 181.17.3.204 est", [(5, 3, 22), (23, 1, 35)]),
        ("x 5425233430109903 4539578763621486 y", [(2, 2, 18), (19, 2, 35)]),
        ("x 5425233430109904 4539578763621486 y", [(19, 2, 35)]),  # the first fails its check
        ("call (650) 555-0114 now", [(5, 3, 19)]),
        ("in 1871 and 1914 GPL 2.0 of 17", []),
    ]
    for text, want in held_out:
        assert decoded(field, text) == want, text


def test_personal_data_rows(spark, labelled):
    texts = [
        (1, "Des +1 (826) 555-4081 190.137.223.204 du k.l@mail.example.com, ñ"),
        (1, "Des +1 (826) 555-4081 190.137.223.204 du k.l@mail.example.com, ñ"),
        (2, None),
        (3, ""),
        (None, "ñé 10.0.0.1"),
        (4, "w" * 300_000 + " 4539578763621486 " + "12 " * 50_000),
        (5, "nothing at all"),
    ]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, spans int, kind string")
    got = sorted(op11.find_personal_data(docs).collect(), key=str)
    assert len(got) == len(texts)
    by_id = {r.doc_id: r for r in got}
    one = by_id[1]
    assert [x for x in got if x.doc_id == 1] == [one, one]
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 0, 0)
    assert one.spans == "phone:4:21,ip:22:37,email:41:61"
    assert by_id[None].spans == "ip:3:11" and by_id[4].spans == "card:300001:300017"
    for i in (2, 3, 5):
        assert by_id[i].spans == "" and by_id[i].base_sha256.startswith("e3b0c442")
    assert op11.find_personal_data(docs.limit(0)).count() == 0
    none = spark.createDataFrame([], "text string, spans string")
    nulls = spark.createDataFrame([(None, None), ("12", None)], "text string, spans string")
    for table in (none, nulls):
        spans = {r.doc_id: r.spans for r in op11.find_personal_data(docs, table).collect()}
        assert spans[1] == "ip:22:37,email:41:61"


# ---------------------------------------------------------------------------------------------
# lexical search
# ---------------------------------------------------------------------------------------------


def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, k):
    counted = [(i, Counter(t)) for i, t in ((i, plain_terms(text)) for i, text in docs) if t]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for row, (i, c) in enumerate(counted):
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(plain_terms(text))
                if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, row, i))
        out += [(item, r + 1, s[4], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_terms_in_slices_of_bytes():
    import pyarrow as pa

    texts = ["", "One two-THREE", None, "ñé ÑA", "x", "...", "y" * 50, "a_b"]
    words, first = op12.terms_of(pa.array(texts))
    words = words.to_pylist()
    assert [words[a:b] for a, b in zip(first, first[1:])] == [plain_terms(t) for t in texts]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["the"] * 30 + [f"w{k}" for k in range(40)] + ["Ñandú", "É", "x9"]
    docs = [(rng.randint(0, 150), " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for _ in range(200)]
    docs += [(7, docs[3][1])] * 5 + [(None, docs[3][1]), (8, None), (9, ""), (10, " ,;! "), (11, "the " * 30_000)]
    items = [(1, "The W1, w2 w3 ñandú"), (1, "w5 w5 w6"), (2, None), (3, "absent"), (None, "the x9"), (4, "the"), (4, "the")]
    return docs, items


@pytest.mark.parametrize("shard,sent", [(500_000, 500_000), (300, 500_000), (300, 0)])
def test_search_like_plain(spark, corpus, monkeypatch, shard, sent):
    monkeypatch.setattr(op12, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(op12, "SENT_TERMS", sent)
    monkeypatch.setattr(op12, "ITEMS", 3)
    docs, items = corpus
    left = ship(spark).createDataFrame([(i, t, 1, "q") for i, t in docs], "doc_id long, text string, n int, terms string")
    right = spark.createDataFrame([(i, t, 2, 0) for i, t in items], "item_id long, text string, row int, doc_id int")
    got = sorted((tuple(r) for r in op12.search(left, right, k=6).collect()), key=str)
    assert got == plain_search(docs, items, 6)


def test_search_empty_tables(spark, corpus):
    docs = ship(spark).createDataFrame(corpus[0], "doc_id long, text string")
    items = spark.createDataFrame(corpus[1], "item_id long, text string")
    assert op12.search(docs.limit(0), items).count() == 0
    assert op12.search(docs, items.limit(0)).count() == 0
    assert op12.search(docs.where("text = ''"), items).count() == 0


def test_nra_stops_early_and_right():
    rng = np.random.default_rng(2)
    for case in range(60):
        n = 3000
        lists = []
        for _ in range(3):
            docs = rng.permutation(n)[: rng.integers(1, n)]
            scores = np.sort(rng.integers(1, 40 if case % 2 else 10**6, len(docs)))[::-1].astype(np.int64)
            if case % 3 == 0:
                scores[: len(scores) // 50 + 1] += 10**7  # some documents stand out in every list
                docs = np.concatenate([np.arange(len(scores)) if len(scores) == n else docs])
            lists.append((docs, scores))
        ids = rng.permutation(n)
        total = np.zeros(n, np.int64)
        for docs, scores in lists:
            total[docs] += scores
        want = np.lexsort((ids, -total))[:10]
        best, scores, read = op12.nra(lists, ids, 10)
        want = want[total[want] > 0]
        assert best.tolist() == want.tolist() and scores.tolist() == total[want].tolist()
    heads = np.arange(n)
    steep = (10**9 // (heads + 1)).astype(np.int64)
    assert op12.nra([(heads, steep), (heads, steep)], heads, 10)[2] < n


# ---------------------------------------------------------------------------------------------
# hard negatives
# ---------------------------------------------------------------------------------------------


def plain_negatives(rows, is_anchor, scale, positives=5, negatives=10, low=30, high=90):
    whole = [
        (i, label, tuple(math.floor(scale * x) for x in v))
        for i, label, v in {(i, label, None if v is None else tuple(v)) for i, label, v in rows}
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    limit = 2**63 - 1
    score = lambda a, b: max(-limit, min(limit, sum(x * y for x, y in zip(a, b))))
    out = []
    for a, label, v in whole:
        if not is_anchor(a):
            continue
        scored = sorted((-score(v, c), i, own) for i, own, c in whole if len(c) == len(v))
        for s, p, own in [x for x in scored if x[2] == label and x[1] != a][:positives]:
            own = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(own)]
    return sorted(out)


def vectors_of(seed, n=300, dim=4):
    rng = random.Random(seed)
    rows = [(k, rng.randint(0, 2), [rng.choice([-1.0, 0.0, 0.25, 0.5, 2.0]) + rng.random() * (k % 2) for _ in range(dim)]) for k in range(n)]
    rows += [rows[20]] * 4 + [(20, 1, [0.5] * dim), (20, 0, [0.5] * dim), (21, 1, [0.5] * (dim + 1)), (40, 2, [1.0] * (dim + 1))]
    rows += [(900, 0, None), (901, None, [1.0] * dim), (None, 1, [1.0] * dim), (902, 1, []), (903, 1, [1.0, None] * 2)]
    rows += [(904, 1, [float("nan")] * dim), (905, 2, [float("inf")] * dim), (60, 1, [0.0] * dim)]
    return rows


@pytest.mark.parametrize("block,anchors", [(4096, 512), (40, 3)])
def test_negatives_like_plain(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(op13, "BLOCK", block)
    monkeypatch.setattr(op13, "ANCHORS", anchors)
    rows = vectors_of(1)
    df = ship(spark).createDataFrame(
        [(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<float>, score int, a_block string"
    )
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    got = op13.hard_negatives(df, df.where("vec_id % 20 = 0"))
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i % 20 == 0, 256)
    assert op13.hard_negatives(df.limit(0), df.limit(0)).count() == 0
    assert op13.hard_negatives(df, df.limit(0)).count() == 0


def test_negatives_of_large_values(spark):
    rng = random.Random(4)
    rows = [(k, k % 3, [rng.choice([3e5, -1e12, 1e30, 2.0, 1e9]) * rng.random() for _ in range(3)]) for k in range(60)]
    df = ship(spark).createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = op13.hard_negatives(df, df.where("vec_id % 10 = 0"))
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, lambda i: i % 10 == 0, 256)


def test_threshold_stops_early_and_matters():
    rng = np.random.default_rng(6)
    n = 4000
    values = rng.integers(-100, 100, (n, 3))
    lists = np.argsort(values, axis=0, kind="stable").T.astype(np.uint16)
    ids = rng.permutation(n)
    read = []
    for _ in range(40):
        anchor = rng.integers(-50, 50, 3)
        scores = values @ anchor
        top = int(scores.max())
        windows = [op13.Best(5, -(2**63) + 1, 2**63 - 1), op13.Best(5, top // 2, top * 9 // 10), op13.Best(5, top + 1, top + 9)]
        read.append(op13.threshold_scan(anchor, values, lists, ids, np.ones(n, bool), windows))
        for w in windows:
            inside = np.flatnonzero((scores >= w.low) & (scores <= w.high))
            want = inside[np.lexsort((ids[inside], -scores[inside]))][:5]
            assert w.ids.tolist() == ids[want].tolist()
    assert np.mean(read) < 0.6 * n


def test_negatives_deterministic(spark):
    df = ship(spark).createDataFrame(vectors_of(2), "vec_id long, label int, embedding array<double>")
    runs = [op13.hard_negatives(x, x.where("vec_id % 20 = 0")).collect() for x in (df, df.repartition(7, F.rand(1)))]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))
