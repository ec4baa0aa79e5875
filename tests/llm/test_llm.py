"""Operators for training data against plain versions, and their behaviour on odd rows."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

import corpus_pipeline
from checks.compare import connect, rows_of
from footfall.llm import op1_packing as op1
from footfall.llm import op2_decontamination as op2
from footfall.llm import op3_substring as op3
from footfall.llm import op4_topk as op4
from footfall.llm import op5_warc as op5
from footfall.llm import op6_near_dup as op6
from footfall.llm import op7_url_filter as op7
from footfall.llm import op8_html as op8
from footfall.llm import op9_pitman_yor as op9
from footfall.llm import op10_quality as op10
from footfall.llm import common
from footfall.llm.common import components, ship
from footfall.llm.queries import ORACLE, QUERIES, vocabulary

SMALL = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"w{k}" for k in range(60))
DOCS = [
    (1, f"alpha {PASSAGE} beta gamma"),
    (2, f"other words {PASSAGE} at the end"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "Short one."),
    (7, "short ONE."),
    (7, "short ONE."),
    (8, " ".join(f"x{k % 7}" for k in range(80))),
    (9, "l" * 30_000 + " long " + "ab " * 9_000),
    (None, f"nothing {PASSAGE}"),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    schema = "doc_id long, text string, chunk int, n_words string, block int"  # clashing names
    return spark.createDataFrame([(i, t, 1, "a", 2) for i, t in DOCS], schema)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def split(text, fold=False):
    text = text or ""
    if fold:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    result = connect(SMALL).execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    want = Counter()
    for i, t in texts:
        want[i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], np.uint32).tobytes()] += 1
    for (i, data), n in want.items():
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i and r.doc_tokens == len(data) // 4)
        assert sum(p[1] for p in pieces) == n * len(data) // 4
        assert all(zlib.crc32(data[4 * s : 4 * (s + k)]) == c for s, k, c in pieces)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [k for _, k in own])[:-1])
        assert sum(k for _, k in own) <= 4096
    return bins


def test_packing(docs, empty):
    check_packing(op1.pack(docs, vocabulary()).collect(), DOCS)
    assert op1.pack(empty, vocabulary()).count() == 0


def test_packing_limits():
    limits = op1.Limits(tokens=100, segments=5, loss=40)
    packer = op1.Packer(limits)
    rng = np.random.default_rng(1)
    for k in range(300):
        n = int(rng.integers(1, 250))
        packer.add(op1.Piece(k, 0, n, int(rng.integers(0, n + 1))))
    last = packer.finish()
    for own in packer.bins:
        assert sum(p.length for p in own) <= 100 and len(own) <= 5 and sum(p.loss() for p in own) <= 40
    assert sum(p.length for own in [*packer.bins, last] for p in own) == sum(
        n for n in _lengths(np.random.default_rng(1), 300)
    )


def _lengths(rng, count):
    for _ in range(count):
        n = int(rng.integers(1, 250))
        rng.integers(0, n + 1)
        yield n


def test_decontamination_catches_reordered_passages(spark, docs, empty):
    sentence = [f"s{k}a s{k}b s{k}c s{k}d s{k}e s{k}f" for k in range(6)]
    items = spark.createDataFrame([(1, " ".join(sentence)), (2, "tiny item"), (3, None), (4, "")], "item_id long, text string")
    texts = spark.createDataFrame(
        [(1, "x " + " ".join(sentence).upper() + " y"), (2, " z ".join(reversed(sentence))), (3, sentence[0]), (4, "a tiny item"), (5, None)],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r.coverage for r in op2.contaminated(texts, items).collect()}
    assert got == {(1, 1): 1.0, (2, 1): 1.0, (4, 2): 1.0}
    assert op2.contaminated(docs, items).count() == 0 == op2.contaminated(empty, items).count()
    assert op2.contaminated(docs, items.limit(0)).count() == 0


def test_tiles_do_not_overlap():
    # two maximal matches of 5 and 4 words, the second on item words of the first
    assert op2.tile(np.array([5, 4]), np.array([0, 10]), np.array([0, 1]), 3, 8) == (5, 1)
    # what is left of a match that is partly taken is marked if it is long enough
    assert op2.tile(np.array([5, 4]), np.array([0, 10]), np.array([0, 4]), 3, 8) == (8, 2)
    assert op2.tile(np.array([5, 4]), np.array([0, 10]), np.array([0, 4]), 4, 8) == (5, 1)


def plain_tiling(doc, item, width):
    """(item words under tiles, tiles): the longest common run of free words, again and again."""
    width = min(width, len(item))
    used_p, used_q, tiles = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while (
                    a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n]
                    and a + n not in used_p and b + n not in used_q
                ):
                    n += 1
                best = min(best, (-n, a, b))
        n, a, b = -best[0], *best[1:]
        if n < max(width, 1):
            return len(used_q), tiles
        used_p.update(range(a, a + n))
        used_q.update(range(b, b + n))
        tiles += 1


def test_tiling_like_plain(spark, monkeypatch):
    monkeypatch.setattr(op2, "_MATCHES", 50)
    rng = np.random.default_rng(11)
    text = lambda n, k: " ".join(f"w{x}" for x in rng.integers(0, k, n))
    rows = [(i, text(rng.integers(0, 40), k)) for i, k in enumerate([1, 1, 2, 2, 2, 3, 3, 3, 3])] + [(3, "w0 " * 30), (None, "W1 w0 " * 9)]
    tests = [(i, text(n, k)) for i, (n, k) in enumerate([(1, 1), (3, 2), (12, 1), (20, 2), (20, 2), (25, 3), (25, 3), (0, 1)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(tests, "item_id long, text string")
    want = Counter()
    for i, t in rows:
        for j, u in tests:
            covered, tiles = plain_tiling(split(t, True), split(u, True), 4)
            if covered and covered >= 0.3 * len(split(u)):
                want[i, j, len(split(u)), covered, tiles] += 1
    got = op2.contaminated(docs, items, threshold=0.3, min_match=4)
    assert Counter(map(tuple, got.drop("coverage").collect())) == want and len(want) > 20


def test_tiling_of_one_repeated_word():
    """Matches grow with the sum of the lengths, not with their product."""
    seeds = op2.Seeds([1, 2], ["same " * 100, "same " * 20_000], 5)
    side, words = seeds.by_width[5], common.words_of(pa.array(["same " * 20_000] * 3))
    place, *ranges = side.beginnings(*common.windows(words, 5), op2._before(words))
    assert sum((b - a).sum() for a, b in ranges) < 3 * 100_000
    started = time.perf_counter()
    got = sorted(seeds.matches(pa.array(["same " * 20_000] * 40), 0.5))
    assert got == sorted((r, i, n, 1, n) for r in range(40) for i, n in ((0, 100), (1, 20_000)))
    assert time.perf_counter() - started < 60


@pytest.mark.parametrize("window", [20, 5])
def test_substring_dedup(spark, docs, empty, window, monkeypatch):
    monkeypatch.setattr(op3, "CHUNK_BYTES", 4000)
    first, want = {}, Counter()
    ordered = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0))
    for i, t in ordered:
        w = split(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), (i, k))
    for i, t in ordered:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] != (i, k):
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = op3.remove_repeats(docs, window).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want
    plain = docs.select("doc_id", "text")
    texts = {r.doc_id: r.text for r in op3.remove_repeats(plain, window, with_text=True).collect()}
    assert texts[2].startswith("other words") and "w5 " not in texts[2]
    assert op3.remove_repeats(empty, window).count() == 0


def test_top_k_on_odd_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(300)] + [
        (300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [math.nan] * 6), (303, [math.inf] * 6), (304, []), (305, [1.0])
    ]
    vectors += [(400 + k, vectors[7][1]) for k in range(30)]
    df = ship(spark).createDataFrame(vectors, "vec_id long, embedding array<double>")
    ints = {i: np.floor(64 * np.array(v, float)).astype(int) for i, v in vectors if v and len(v) == 6 and i not in (301, 302, 303)}
    want = set()
    for q in (i for i in ints if i % 20 == 0):
        best = sorted(((-int(ints[q] @ v), i) for i, v in ints.items() if i != q))[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in op4.top_k(df, df.where("vec_id % 20 = 0")).collect()} == want
    assert op4.top_k(df.limit(0), df).count() == 0


def test_top_k_of_large_components(spark):
    """Finite components of any size take part; scores beyond long saturate."""
    rng = np.random.default_rng(8)
    vectors = [(k, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(0, 8)]) for k in range(300)]
    vectors += [(300, [300000.0, 1.0, 2.0, 3.0]), (301, [1e15, 0.0, 0.0, 0.0]), (302, [1e300, -1e300, 0.0, 0.0])]
    df = ship(spark).createDataFrame(vectors, "vec_id long, embedding array<double>")
    clamp = lambda x, top, low: max(low, min(top, x))
    whole = lambda x: int(clamp(math.floor(64 * x), 1 << 61, -(1 << 61)))
    ints = [(i, [whole(x) for x in v]) for i, v in vectors]
    want = set()
    for q, own in ints[::20] + ints[-2:]:
        scores = [(clamp(sum(map(int.__mul__, own, v)), (1 << 63) - 1, -(1 << 63)), i) for i, v in ints if i != q]
        best = sorted(scores, key=lambda x: (-x[0], x[1]))[:20]
        want |= {(q, k + 1, i, score) for k, (score, i) in enumerate(best)}
    asked = df.where("vec_id % 20 = 0 OR vec_id > 300")
    assert {tuple(r) for r in op4.top_k(df, asked).collect()} == want


def test_cells_bound_the_products():
    rng = np.random.default_rng(9)
    v = rng.integers(-60, 60, (500, 16))
    group = pa.table({"dim": pa.array([16] * 500, pa.int32()), "block": [0] * 500, "id": range(500), "v": v.tolist()})
    row = op4._pack(group).to_pylist()[0]
    cells = np.frombuffer(row["cells"], np.uint8).reshape(-1, 16)
    edges = np.frombuffer(row["edges"], np.int64).reshape(-1, 16)
    middle, width = op4.bounds(v[:50], cells, edges)
    assert (np.abs(v[:50] @ v.T - middle) <= width[:, None]).all() and width.min() > 0
    floors, places, upper = op4.scan_cells(np.arange(50), v[:50], np.arange(500), cells, edges, 5)
    assert sum(map(len, places)) < 50 * 499  # the cells alone rule rows out


def test_top_k_with_repeated_query_ids(spark):
    rng = np.random.default_rng(4)
    vectors = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(200)]
    vectors += [(20, [9.0] * 6)] * 30 + [(40, [9.0 + k] * 6) for k in range(2)] + [(7, vectors[7][1])] * 3
    df = ship(spark).createDataFrame(vectors, "vec_id long, embedding array<double>")
    ints = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors]
    asked = df.where("vec_id in (0, 20, 40)").dropDuplicates(["vec_id", "embedding"])
    want = Counter()
    for q in (0, 20, 40):
        own = {tuple(v) for i, v in ints if i == q}
        best = sorted((-int(np.array(o) @ v), i) for o in own for i, v in ints if i != q)[:20]
        want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(best))
    got = Counter(map(tuple, op4.top_k(df, asked).collect()))
    assert got == want


def test_top_k_of_many_blocks_sends_none_through_the_driver(spark, monkeypatch):
    """Every block of queries goes to every part of the candidates: by shuffles, never by a broadcast of all copies."""
    for name, n in {"BLOCK": 16, "QUERY_BLOCK": 8, "TOGETHER": 2, "SPREAD": 3}.items():
        monkeypatch.setattr(op4, name, n, raising=False)
    plans, write = [], op4.stored
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(op4, "stored", lambda df, label: plans.append(plan(df)) or write(df, label))
    rng = np.random.default_rng(6)
    vectors = [(k, [float(x) for x in rng.normal(size=5 + k % 2) * 10.0 ** (k % 3)]) for k in range(400)]
    df = ship(spark).createDataFrame(vectors, "vec_id long, embedding array<double>")
    ints = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors]
    want = set()
    for q, own in ints[::7]:
        best = sorted((-int(own @ v), i) for i, v in ints if i != q and len(v) == len(own))[:20]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    got = op4.top_k(df, df.where("vec_id % 7 = 0"))
    assert {tuple(r) for r in got.collect()} == want
    assert not any("Broadcast" in x or "CartesianProduct" in x for x in [*plans, plan(got)])


def test_top_k_ties_beyond_the_limits_of_long(spark):
    """Products that saturate tie, whatever they were; the smaller ids count."""
    vectors = [(k, [(k + 1) * 2.0**50]) for k in range(10)] + [(10 + k, [(k - 10) * 2.0**50]) for k in range(10)]
    df = ship(spark).createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = op4.top_k(df, df.where("vec_id in (8, 18)"), k=4).collect()
    top = (1 << 63) - 1
    assert {tuple(r) for r in got} == {
        (q, rank + 1, i, top) for q, ids in ((8, range(4)), (18, range(10, 14))) for rank, i in enumerate(ids)
    }
    below = op4.top_k(df.where("vec_id in (9, 10, 11, 12)"), df.where("vec_id = 9"), k=2).collect()
    assert {tuple(r) for r in below} == {(9, 1, 10, -(1 << 63)), (9, 2, 11, -(1 << 63))}


def test_packing_encodes_no_kept_word_again(monkeypatch):
    from tokenizers import Tokenizer

    encoded, load = [], Tokenizer.from_file

    class Counting:
        def __init__(self, path):
            self.inner = load(path)

        def encode_batch_fast(self, words, **options):
            encoded.extend(words)
            return self.inner.encode_batch_fast(words, **options)

    monkeypatch.setattr("tokenizers.Tokenizer", type("T", (), {"from_file": staticmethod(Counting)}))
    monkeypatch.setattr(op1, "WORDS_KEPT", 4)
    op1._CACHE.clear()
    texts = pa.array(["Alpha beta. Gamma, delta epsilon zeta", None, "alpha, <|X|> ÉTÉ. 1."])
    first = [x.tolist() for x in op1.token_ids(texts, vocabulary())]
    encoded.clear()
    again = [x.tolist() for x in op1.token_ids(texts, vocabulary())]
    op1._CACHE.clear()
    plain = load(vocabulary())
    ids = [plain.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert first == again == [sum(ids, []), np.cumsum([0, *map(len, ids)]).tolist()]
    assert set(encoded) == {"epsilon", "zeta", "", "<|X|>", "ÉtÉ", "1."} and len(encoded) == 6


def test_warc_round_trip(spark):
    page = "<p>é\r\n\r\nx</p>" * 200
    rows = [(1, "http://a/\r\nb", page), (2, None, page), (3, "u", page), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", page)]
    df = ship(spark).createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in op5.round_trip(df, with_payload=True).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None),
        6: ("response", None), None: ("revisit", 3),
    }
    assert got[3].payload == page and got[1].payload is None and got[6].payload == ""
    assert all(r.payload_digest == hashlib.sha1((h or "").encode()).hexdigest() for (i, _, h) in rows for r in [got[i]])
    assert op5.round_trip(df.limit(0)).count() == 0
    assert op5.coalesce_ranges([(0, 5), (5, 5), (100, 1)], gap=10) == [(0, 10, 0, 2), (100, 101, 2, 3)]


def test_warc_round_trip_reads_by_the_same_plan_at_every_size(spark):
    df = spark.createDataFrame([(k, None, "x" * k) for k in range(5)], "page_id long, url string, html string")
    plan = op5.round_trip(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_duplicates_on_odd_rows(docs, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op6.near_duplicates(docs, 2).collect()}
    assert {(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (7, 1, 6, False)} <= got
    assert any(r[0] is None and r[2] is None and r[3] for r in got)
    assert op6.near_duplicates(empty, 2).count() == 0


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    texts = []
    for family in range(12):
        base = [f"t{family}_{x}" for x in rng.integers(0, 60, 40)]
        for _ in range(12):
            own = list(base)
            for at in rng.integers(0, 40, rng.integers(0, 5)):
                own[at] = f"n{rng.integers(0, 999)}"
            texts.append(" ".join(own))
    sets = [set(zip(w, w[1:])) for w in map(split, texts)]
    parent = list(range(len(texts)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    df = ship(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op6.near_duplicates(df, 2).collect()}
    assert got == {k: top(k) for k in range(len(texts))}


def test_near_duplicates_behind_half_alike_texts(spark):
    """Near copies whose shared bands all hold smaller ids unlike them."""
    rng = np.random.default_rng(9)
    texts = [rng.choice(700, 391, replace=False) for _ in range(4000)]
    planted = {}
    for _ in range(40):
        base = rng.choice(700, 391, replace=False)
        other = np.concatenate([base[40:], rng.choice(np.setdiff1d(np.arange(700), base), 40, replace=False)])
        planted[len(texts) + 1] = len(texts)
        texts += [base, other]
    rows = [(k, " ".join(f"w{x}" for x in t)) for k, t in enumerate(texts)]
    df = ship(spark).createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in op6.near_duplicates(df, 1).collect()}
    assert got == {k: planted.get(k, k) for k in range(len(texts))}


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 200), (200, 150)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 200: 100, 150: 100}


@pytest.mark.parametrize("edges_of_task,fan_in", [(1 << 20, 16), (200, 4)])
def test_components_of_a_large_group_over_many_tasks(spark, monkeypatch, edges_of_task, fan_in):
    """One group of 20,000 copies that 200 tasks have seen in part, chains, and pairs."""
    monkeypatch.setattr(common, "_EDGES", edges_of_task)
    monkeypatch.setattr(common, "_FAN_IN", fan_in)
    n = 20_000 if fan_in == 16 else 2_000
    rng = np.random.default_rng(5)
    group = [(int(b), int(a)) for a, b in rng.integers(0, n, (2 * n, 2)) if a != b] + [(k + 1, k) for k in range(n - 1)]
    chains = [(10**6 + 50 * c + k, 10**6 + 50 * c + k + 1) for c in range(20) for k in range(30)]
    pairs = [(10**7 + 2 * k + 1, 10**7 + 2 * k) for k in range(500)]
    edges = ship(spark).createDataFrame(group + chains + pairs, "a long, b long").repartition(200 if fan_in == 16 else 24)
    got = dict(components(edges).collect())
    want = {k: 0 for k in range(n)}
    want |= {i: 10**6 + 50 * c for c in range(20) for i in range(10**6 + 50 * c, 10**6 + 50 * c + 31)}
    want |= {10**7 + k: 10**7 + k // 2 * 2 for k in range(1000)}
    assert got == want


def test_url_rules(spark):
    urls = ["http://WWW.Example.com/en/x", "http://example.com/en", "https://a.net/es/?q", "net/es/", None, "x://a.netx/es/", "x://net/fr/#t", "x://com"]
    df = ship(spark).createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in op7.judge_urls(df).collect()}
    assert got == {
        0: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 1: ("example.com", "/en", "com/", "allow"),
        2: ("a.net", "/es/", "net/es/", "block"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("a.netx", "/es/", None, "allow"), 6: ("net", "/fr/", "net/fr/", "block"), 7: ("com", "", None, "allow"),
    }
    assert op7.judge_urls(df.limit(0)).count() == 0


def test_cascade_is_exact_over_the_universe(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    listed = keys.where("key LIKE '%7'")
    levels = op7.cascade(listed, keys)
    wrong = keys.where(op7.contains(levels, keys["key"]) != keys["key"].like("%7"))
    assert wrong.count() == 0


def test_main_text():
    page = (
        '<html><head><title>t</title><script>var a="</p>"</script></head><body><nav><a>menu</a></nav><div class="ad">buy'
        '</div><article><h1>Head</h1><p>One <b>two</b>&amp;<br>three<div class="comments"><p>me too</p></div><p>a</p>'
        "</article><footer>f</footer>"
    )
    assert op8.main_text(page) == "Head One two& three a"
    assert op8.main_text(None) == op8.main_text("") == op8.main_text("<nav>x</nav>") == ""
    assert op8.main_text("<div>" + "word " * 3000 + "</div><aside>no</aside>") == ("word " * 3000).strip()


def test_language_model(docs, empty, monkeypatch):
    monkeypatch.setattr(op9, "CHUNK_BYTES", 20_000)
    count = Counter()
    for i, t in DOCS:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            count.update(split(t, True) + ["</s>"])
    total, vocabulary_size = sum(count.values()), len(count)
    got = op9.score_texts(docs).collect()
    texts = dict(DOCS)
    assert len(got) == len(DOCS) and {r.train_tokens for r in got} == {total}
    for r in got:
        words = split(texts[r.doc_id], True) + ["</s>"]
        base = sum(math.log10((count[w] + 1) / (total + vocabulary_size + 1)) for w in words)
        assert r.n_tokens == len(words) and r.n_known == sum(count[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert op9.score_texts(empty).count() == 0


def test_rare_words_before_are_contexts(spark):
    """Pairs of rare words: only a context of its own tells which of the words comes next."""
    rng = np.random.default_rng(6)
    pairs = [(f"k{k}aa", f"v{k}bb") for k in range(3000)]
    rows = [(i, " ".join(w for k in rng.integers(0, 3000, 40) for w in pairs[k])) for i in range(1200)]
    df = ship(spark).createDataFrame(rows, "doc_id long, text string")
    held = [r for r in op9.score_texts(df).collect() if r.held_out]
    assert len(held) > 50
    # the second word of a pair is nearly sure, the first is one of 3,000
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -2.5
    assert sum(r.base_score for r in held) / sum(r.n_tokens for r in held) < -3.5


def test_predictive_probabilities_sum_to_one():
    contexts = op9.Contexts(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(1, 2**62, 50, dtype=np.uint64))
    pairs = np.array([w << 17 | c for w in range(50) for c in (1, 2)])
    two = np.full(50, 2, np.uint32)
    data = op9._arrays(
        op9._steps(words, np.array([50])), two, op9._steps((pairs & 3).astype(np.uint32), two),
        rng.integers(1, 30, 100).astype(np.int64), *[np.zeros(0, np.int64)] * 2, np.zeros(0, np.uint32))
    bucket = op9.Bucket(data, contexts)

    def totals(discounts=(0.3, 0.4, 0.5)):
        k, c, t = bucket.totals()
        customers, tables = np.zeros(256), np.zeros(256)
        customers[k[k >= 0]], tables[k[k >= 0]] = c[k >= 0], t[k >= 0]
        return op9.Totals(customers, tables, c[k == -1][0], t[k == -1][0], 50, int(c[k == -2][0]), discounts)

    for _ in range(3):
        bucket.sweep(totals(), rng)
        s = totals()
        p0, p1, p = bucket.predict(s)
        unknown = (op9.STRENGTH + s.discounts[0] * s.root_tables) / 51 / (op9.STRENGTH + s.root_customers)
        assert p0.sum() + unknown == pytest.approx(1)
        for c in (1, 2):
            rest = (op9.STRENGTH + s.discounts[1] * s.tables[c]) * unknown / (op9.STRENGTH + s.customers[c])
            assert p[bucket.context == c].sum() + rest == pytest.approx(1)


@pytest.mark.parametrize("kind", [np.uint32, np.uint64])
def test_arrays_and_steps_round_trip(kind):
    rng = np.random.default_rng(3)
    sizes = np.array([0, 3, 1, 0, 40, 0], np.uint32)
    top = np.iinfo(kind).max
    values = np.concatenate([np.sort(rng.integers(0, top, n, kind, endpoint=True)) for n in sizes])
    values[-1] = top
    floats = rng.random(7).astype(np.float32)
    packed = op9._arrays(op9._steps(values, sizes), sizes, floats, np.zeros(0, kind), np.arange(3, dtype=np.uint8))
    steps, n, f, none, small = op9._read(packed, kind, np.uint32, np.float32, kind, np.uint8)
    assert np.array_equal(op9._from_steps(steps, n), values) and np.array_equal(f, floats)
    assert not len(none) and not len(op9._from_steps(none, op9._one(none))) and list(small) == [0, 1, 2]


def test_discard_deletes_written_tables_only(spark):
    kept, gone = (common.stored(spark.range(3), "discard") for _ in range(2))
    common.discard(gone)
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST|FileNotFound"):
        gone.count()
    with pytest.raises(KeyError):
        common.discard(spark.range(3))


def test_scored_probabilities_sum_to_one():
    """On the path that scores: over all words, the end and an unknown word, after any word."""
    rng = np.random.default_rng(8)
    words = [f"w{k}{'ab'[k % 2]}" for k in range(25)]
    held = [i for i in range(20_000) if op9.is_held_out(i)]
    used = [i for i in range(400) if not op9.is_held_out(i)][:120]
    train = [(i, " ".join(rng.choice(words, 12, p=np.arange(25, 0, -1) / 325))) for i in used]
    texts = [""] + [w for w in [*words, "unseen"]] + [f"{u} {w}" for u in [*words, "other"] for w in [*words, "unseen"]]
    rows = train + list(zip(held, texts))
    table = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "chunk": [0] * len(rows)})
    bits = 2
    asked = op9._ask(bits)(table)
    merged = [op9._merge(asked.filter(pc.equal(asked["bucket"], b))) for b in sorted(set(asked["bucket"].to_pylist()))]

    def totals(stats):
        class Rows:  # what the driver gets of the classes
            def where(self, _):
                return self

            groupBy = agg = lambda self, *_: self

            def collect(self):
                sums = {}
                for s in stats:
                    for r in s.to_pylist():
                        if not r["word"]:
                            c, t = sums.get(r["k"], (0, 0))
                            sums[r["k"]] = (c + r["customers"], t + r["tables"])
                return [{"k": k, "c": c, "t": t} for k, (c, t) in sums.items()]

        return op9._sum(Rows())

    def known(rounds, bucket):
        customers, lacking = Counter(), defaultdict(lambda: [0.0] * len(rounds))
        for s in start:
            for r in s.to_pylist():
                if r["word"]:
                    customers[r["k"]] += r["customers"]
        for n, stats in enumerate(rounds):
            for s in stats:
                for r in s.to_pylist():
                    if r["word"]:
                        lacking[r["k"]][n] += r["tables"]
        own = sorted({r["k"] for s in start for r in s.to_pylist() if r["word"] and r["bucket"] == bucket})
        return pa.table({"k": pa.array(own, pa.int64()), "customers": [customers[k] for k in own],
                         "lacking": pa.array([lacking[k] for k in own], pa.list_(pa.float64()))})

    start = [pa.Table.from_batches(op9._first(m.to_batches())) for m in merged]
    rounds = [start]
    sums = [totals(rounds[0])]
    number = lambda m: m["bucket"][0].as_py()
    for n in range(1, 1 + op9.ROUNDS):
        rounds.append([op9._round(sums[-1], n)(m, known(rounds[-1:], number(m))) for m in merged])
        sums.append(totals(rounds[-1]))
    kept = 1 + op9.SAMPLES
    answer = op9._answer(sums[-kept:], op9.ROUNDS)
    answers = pa.concat_tables([answer(m, known(rounds[-kept:], number(m))) for m in merged])
    t = op9.tokens_of(table)
    _, value = op9.token_values(t, answers, sums[-1], bits)
    own = {}
    for r, (_, text) in enumerate(rows[len(train) :], start=len(train)):
        own[text] = 10 ** value[t.first[r] : t.first[r + 1]]
    every = [*words, "unseen"]
    assert own[""][0] + sum(own[w][0] for w in every) == pytest.approx(1, abs=1e-5)
    for u in words:
        assert own[u][1] + sum(own[f"{u} {w}"][1] for w in every) == pytest.approx(1, abs=1e-5)
    # an unseen word before passes all on to its class
    assert sum(own[f"other {w}"][1] for w in every) < 1


def test_quality_on_held_out_labels(spark, docs, empty):
    folder = "/root/testdata/sf0.01"
    table = lambda n: ship(spark).read.parquet(f"{folder}/{n}.parquet")
    labels = table("labels")
    got = {r.doc_id: r for r in op10.judge(table("documents"), labels.where("doc_id % 2 = 0")).collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    right = [(got[r.doc_id].junk >= 0.5) == (r.quality == 0) for r in held]
    assert sum(right) >= 0.98 * len(right)
    assert all(got[r.doc_id].kept for r in held if r.quality == 1 and r.toxic == 0)
    odd = op10.judge(docs, labels.limit(0)).collect()
    assert len(odd) == len(DOCS) and not any(r.kept for r in odd if r.doc_id in (3, 4, 5))
    assert op10.judge(empty, labels).count() == 0


def test_quality_sample_has_the_labelled_rows(spark):
    """Few labels among many documents: all are drawn; copies count once; the draw is the same again."""
    rows = [(k, f"text number {k}") for k in range(3000)] + [(7, "text number 7")] * 500 + [(None, "none")] * 500
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(0, 60, 3)] + [(9000, 0, 1)], "doc_id long, quality int, toxic int")
    drawn = [tuple(r) for r in op10._sampled(docs, labels, 300).collect()]
    assert len(drawn) == len(set(drawn)) and 40 < len(drawn) < 300
    assert {r[0] for r in drawn if r[2] or r[3]} == set(range(0, 60, 3))
    assert set(drawn) == {tuple(r) for r in op10._sampled(docs.repartition(7), labels, 300).collect()}


def test_quality_keeps_all_columns(spark):
    rows = [(1, "A plain text about the weather of the day.", "x", 1), (None, "$$$ ### @@@ !!! ||| %%% $$$ ###", "y", 2), (3, None, "z", 3)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, junk string, sample_key int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in op10.keep_good(docs, labels).collect()] == rows[:1]


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.3
    cast = np.stack([np.where(rng.random(4000) < a, np.where(truth, 1, -1), np.where(truth, -1, 1)) for a in (0.9, 0.8, 0.7, 0.85)], 1)
    cast[:, -1] = 0
    patterns, n = np.unique(cast, axis=0, return_counts=True)
    model = op10.fit_em(patterns, n.astype(float))
    assert abs(model["prior"] - 0.3) < 0.06
    assert abs(model["table"][1, 0, 2] - 0.9) < 0.06


def test_pages_of_any_markup():
    """No markup breaks the parser, and stray end tags take linear time."""
    rng = np.random.default_rng(4)
    parts = ["<![foo[ x ]]>", "<![CDATA[ a", "]]>", "<!DOCTYPE [ <!ENTITY", "<!--", "-->", "<p>", "</div>", "<article>", "</article>",
             "text ", "<a b='", "<li", "&#xZ;", "</", "<?x", "<![if y]>", "<![endif]-->", "<script>", "</script>", "\x00", "<section id=q>"]
    for _ in range(3000):
        op8.main_text("".join(rng.choice(parts, rng.integers(1, 12))))
    assert op8.main_text("<article><p>one</p><![foo[ x ]]><p>two</p></article>") == "one two"
    started = time.time()
    op8.main_text("<div>" * 60_000 + "</li>" * 60_000 + "end")
    assert time.time() - started < 20


PLAIN_PAGE = (
    '<body><div><a href="/a">one</a> <a href="/b">two</a> <a href="/c">three</a></div>'
    "<div><h2>Short head</h2><p>{0}</p><p>Brief.</p><p>{0}</p></div>"
    '<div><a href="/d">four</a> <a href="/e">five</a></div></body>'
)


def test_clustering_chooses_the_regions(monkeypatch):
    """Without a mark for the article the text's region stands, whole; nothing does without the clustering."""
    body = "A sentence of some length that tells a story to its readers. " * 4
    want = f"Short head {body}Brief. {body}".strip()
    page = PLAIN_PAGE.format(body)
    assert op8.main_text(page) == want
    marked = page.replace("<div><h2>", "<article><h2>").replace(f"{body}</p></div>", f"{body}</p></article>")
    assert "<article>" in marked and op8.main_text(marked) == want
    for answer in (True, False):
        monkeypatch.setattr(op8, "content_lines", lambda ratio, answer=answer: np.full(len(ratio), answer))
        assert op8.main_text(page) != want and op8.main_text(marked) != want


def test_odd_pages_on_spark(spark):
    """Repeated rows, null ids and html, no rows, clashing columns, a page of a million characters."""
    long = "<article>" + "<p>Some words of a very long page.</p>" * 28_000 + "</article>"
    rows = [(1, "u", "<p>one</p>"), (1, "u", "<p>one</p>"), (None, None, None), (2, "v", ""), (3, "w", long)]
    schema = "page_id long, url string, html string, text int, n_chars string"
    df = ship(spark).createDataFrame([(*r, 5, "x") for r in rows], schema)
    got = Counter(map(tuple, op8.extract_main_text(df).collect()))
    body = " ".join(["Some words of a very long page."] * 28_000)
    assert got == Counter([(1, "u", "one", 3)] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, "w", body, len(body))])
    assert op8.extract_main_text(df.limit(0)).count() == 0


def test_plain_words_do_not_exclude_a_section():
    page = '<article><section id="share-price"><p>It rose by a tenth in a day of calm trade.</p></section>{}</article>'
    text = "It rose by a tenth in a day of calm trade."
    for name in ("share-buttons", "share", "related-posts", "sidebar-share-price", "notice"):
        assert op8.main_text(page.format(f'<div class="{name}">not this</div>')) == text, name


def test_pipeline_judges_rows_without_an_id_of_their_own(spark):
    """Repeated and null ids, equal rows, clashing columns, empty and very long texts."""
    words = lambda seed, n: " ".join(f"v{k}" for k in np.random.default_rng(seed).integers(0, 5000, n))
    long, other = words(1, 400), words(2, 60)
    item = ship(spark).read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(5, long), (5, long), (3, long + " w"), (None, long), (None, other), (None, other), (8, other + " x"), (9, words(3, 30_000)),
            (9, words(4, 80)), (None, "so " + item), (12, item + " end"), (13, ""), (14, None)]
    schema = "doc_id long, text string, lang string, row string, block int, component_id long"
    docs = spark.createDataFrame([(i, t, "en", "r", 1, 2) for i, t in rows], schema)
    near = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert near.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in near.collect()), key=str)
    gone = [(5, long), (5, long), (None, long), (None, other), (None, other)]
    want = [r for r in rows if r not in gone]
    # the items differ by one word before and one after: the texts may or may not be similar
    assert [r for r in kept if item not in (r[1] or "")] == sorted((r for r in want if item not in (r[1] or "")), key=str)
    clean = corpus_pipeline.decontamination(spark, docs, SMALL)
    assert clean.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    assert found == sorted((r for r in rows if item not in (r[1] or "")), key=str)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_pipeline(spark):
    docs = ship(spark).read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        assert after <= before
        before = after
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in rows} == before
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
