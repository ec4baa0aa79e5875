"""Operator 10: quality classifier from weak labels.

Heuristic labellers vote on each document for two targets, ``junk`` and ``toxic``; each may
abstain, and they overlap. Given labels take part as one more labeller that abstains elsewhere.
Expectation-maximisation (one latent class, votes independent given it, abstentions counted as an
outcome) estimates the labellers' accuracies from the counts of vote patterns over all documents;
a pattern is one of a bounded number, so only those counts reach the driver. The posteriors of a
bounded sample (about ``SAMPLE_ROWS``, half of them labelled rows, or all there are if fewer, and the
rest others, each part drawn on its own by a hash of id and text) then train one hashed linear scorer per target on
presence of words, word beginnings and marks. So the labelled rows in it stay as many when the
documents grow and the labels don't. The scorer judges every
whole document, also those on which all labellers abstain; where a heuristic has voted, the larger
of posterior and score counts. Given labels serve to fit, not to judge. A document is kept if both targets stay below one half.

Defined results: null, empty and blank texts have no words and are junk by definition (score 1,
not kept). Repeated rows are judged alike and enter the sample once, a null id by its text alone. Ids labelled more than once
count by their largest label. Without documents the result is empty, without labels the heuristics
decide alone. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import Words, text_bytes, tidy, words_of

SAMPLE_ROWS = 12_000
BITS = 20
EPOCHS = 6
#: Common English words of abuse.
ABUSE = (
    "idiot", "moron", "scum", "clown", "pathetic", "stupid", "worthless", "loser", "trash", "disgusting",
    "imbecile", "dumb", "filth", "vermin", "freak",
)
JUNK, TOXIC = 0, 1
LABELLERS = (
    ("symbols", "marks", "repeats", "capitals", "few_words", "prose", "given"),
    ("abuse", "much_abuse", "learned", "no_abuse", "given"),
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^~<>{}[]\\_+=|"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def _abuse_hashes() -> np.ndarray:
    return np.sort(words_of(pa.array(list(ABUSE))).hash)


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the rows that start at ``first``."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def measure(texts) -> tuple[Words, dict[str, np.ndarray]]:
    """Words of the texts and what the labellers look at, per text."""
    words = words_of(texts, fold=True, trim=True, prefix=5)
    data, offsets = text_bytes(texts)
    n = np.maximum(1, np.diff(words.first))
    size = np.maximum(1, per_row(words.end - words.start, words.first))
    same = np.zeros(len(words.hash), bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    same[words.first[:-1][words.first[:-1] < len(same)]] = False
    letters = per_row(_LETTER[data], offsets)
    latin = per_row(_UPPER[data], offsets)
    abuse = np.isin(words.hash, _abuse_hashes())
    return words, {
        "words": np.diff(words.first),
        "symbols": per_row(_SYMBOL[data], offsets) / size,
        "marks": (per_row(data == ord("!"), offsets) + per_row(data == ord("|"), offsets)) / n,
        "repeats": per_row(same, words.first) / n,
        "capitals": latin / np.maximum(1, letters),
        "letters": letters / size,
        "abuse": per_row(abuse, words.first),
    }


def votes(m: dict, given: tuple, learned: np.ndarray) -> list[np.ndarray]:
    """Votes of all labellers for both targets: 1 for, -1 against, 0 abstains; rows by labellers."""
    vote = lambda yes, no=False: np.where(yes, 1, np.where(no, -1, 0))
    junk = [
        vote(m["symbols"] > 0.12),
        vote(m["marks"] > 0.25),
        vote(m["repeats"] > 0.3),
        vote((m["capitals"] > 0.5) & (m["words"] >= 5)),
        vote(m["words"] == 0),
        vote(False, (m["symbols"] < 0.05) & (m["marks"] < 0.1) & (m["repeats"] < 0.15) & (m["capitals"] < 0.3)),
        given[JUNK],
    ]
    toxic = [
        vote(m["abuse"] >= 1),
        vote(m["abuse"] >= 3),
        vote(learned >= 1),
        vote(False, (m["abuse"] == 0) & (learned == 0)),
        given[TOXIC],
    ]
    return [np.stack(junk, 1).astype(np.int8), np.stack(toxic, 1).astype(np.int8)]


def fit_em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> dict:
    """Class prior and outcome probabilities of each labeller, from counted vote patterns.

    The start is the share of votes for the class; the last labeller is the given one.
    """
    outcome = patterns + 1
    one_hot = np.eye(3)[outcome]  # patterns, labellers, outcomes
    given = patterns[:, -1]
    yes, no = (patterns == 1).sum(1), (patterns == -1).sum(1)
    p = np.where(given != 0, (given > 0) * 0.98 + 0.01, (yes + 0.1) / (yes + no + 0.5))
    for _ in range(rounds):
        w1, w0 = counts * p, counts * (1 - p)
        prior = (w1.sum() + 1) / (counts.sum() + 10)
        table = [
            (np.einsum("p,pko->ko", w, one_hot) + 0.01) / (w.sum() + 0.03) for w in (w0, w1)
        ]
        model = {"prior": float(prior), "table": np.stack(table)}
        p = posterior(model, patterns)
    return model


def posterior(model: dict, patterns: np.ndarray) -> np.ndarray:
    """Probability of the class given votes."""
    at = np.arange(patterns.shape[1])
    log = np.log(model["table"])
    fit = [log[c][at, patterns + 1].sum(1) for c in (0, 1)]
    z = np.log(1 - model["prior"]) + fit[0] - np.log(model["prior"]) - fit[1]
    return 1 / (1 + np.exp(np.clip(z, -30, 30)))


def features(words: Words, m: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of every row (flat, with row starts): words, beginnings, marks."""
    row = words.rows()
    cut = np.uint64(64 - BITS)
    levels = [(m[k] * 20).clip(0, 20).astype(np.uint64) for k in ("symbols", "marks", "repeats", "capitals")]
    n = len(m["words"])
    marks = np.concatenate([(np.uint64(k * 64) + x) for k, x in enumerate(levels)])
    ids = np.concatenate(
        [words.hash >> cut, (words.prefix * np.uint64(0x9E3779B97F4A7C15)) >> cut, marks]
    ).astype(np.int64)
    rows = np.concatenate([row, row, np.tile(np.arange(n), len(levels))])
    key = np.unique(rows << BITS | ids)
    return key & ((1 << BITS) - 1), np.searchsorted(key >> BITS, np.arange(n + 1))


def train(flat: np.ndarray, first: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression on presence features by AdaGrad in a fixed order; last weight is the bias."""
    w = np.zeros((1 << BITS) + 1, np.float64)
    g = np.full(len(w), 1e-2)
    order = np.random.default_rng(7).permutation(np.flatnonzero(weight > 0))
    for _ in range(EPOCHS):
        for i in order:
            at = np.append(flat[first[i] : first[i + 1]], len(w) - 1)
            p = 1 / (1 + np.exp(-np.clip(w[at].sum(), -30, 30)))
            step = weight[i] * (p - target[i]) + 1e-7 * w[at]
            g[at] += step * step
            w[at] -= 0.15 * step / np.sqrt(g[at])
    return w.astype(np.float32)


def score(flat: np.ndarray, first: np.ndarray, w: np.ndarray) -> np.ndarray:
    z = per_row(w[flat], first) + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _given(labels: DataFrame) -> DataFrame:
    """Votes of the given labels, one row per id."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled_id")).agg(
        F.max(F.when(F.col("quality") == 0, 1).when(F.col("quality") == 1, -1)).alias("given_junk"),
        F.max(F.when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, -1)).alias("given_toxic"),
    )


def _with_given(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with their given votes, 0 where there is none."""
    joined = rows.join(_given(labels), rows["doc_id"] == F.col("labelled_id"), "left").drop("labelled_id")
    return joined.fillna(0, ["given_junk", "given_toxic"])


def _slices(batches, given: bool = False, n: int = 500):
    """Small parts of batches with their given votes, none unless ``given``."""
    for batch in batches:
        for lo in range(0, batch.num_rows, n):
            part = batch.slice(lo, n)
            none = (np.zeros(part.num_rows, np.int8),) * 2
            columns = ("given_junk", "given_toxic")
            yield part, tuple(part.column(c).to_numpy().astype(np.int8) for c in columns) if given else none


def _learned_count(words: Words, known: np.ndarray) -> np.ndarray:
    return per_row(np.isin(words.prefix, known), words.first)


def _sample(batches):
    """Features of sampled documents, with their prefixes and votes but for the learned labeller."""
    for part, given in _slices(batches, True):
        words, m = measure(part.column("text"))
        flat, first = features(words, m)
        own = votes(m, given, np.zeros(len(first) - 1))
        key = [np.unique(words.prefix[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
        pack = lambda x: pa.array([v.tobytes() for v in x], pa.binary())
        yield pa.record_batch(
            [
                pack([flat[a:b].astype(np.int32) for a, b in zip(first[:-1], first[1:])]),
                pack(key), pack(own[0]), pack(own[1]),
            ],
            ["features", "prefixes", "junk", "toxic"],
        )


def learn_prefixes(rows: list, least: int = 4) -> np.ndarray:
    """Word beginnings that only documents given as toxic have, at least ``least`` of them."""
    toxic = [np.frombuffer(r["prefixes"], np.uint64) for r in rows if np.frombuffer(r["toxic"], np.int8)[-1] > 0]
    clean = [np.frombuffer(r["prefixes"], np.uint64) for r in rows if np.frombuffer(r["toxic"], np.int8)[-1] < 0]
    if not toxic or not clean:
        return np.zeros(0, np.uint64)
    found, n = np.unique(np.concatenate(toxic), return_counts=True)
    return np.setdiff1d(found[n >= least], np.unique(np.concatenate(clean)))


def _vote(known):
    def run(batches):
        for part, none in _slices(batches):
            words, m = measure(part.column("text"))
            cast = votes(m, none, _learned_count(words, known.value))
            packed = [pa.array([r.tobytes() for r in v], pa.binary()) for v in cast]
            yield pa.record_batch([part.column("doc_id"), *packed], ["doc_id", "junk", "toxic"])

    return run


def verdicts(part, none, known, models, weights) -> tuple[list, np.ndarray]:
    """Words, and weak score, linear score and both together per target; whether to keep a text."""
    words, m = measure(part.column("text"))
    flat, first = features(words, m)
    columns = [m["words"]]
    worst = np.zeros(part.num_rows)
    for t, v in enumerate(votes(m, none, _learned_count(words, known))):
        weak, linear = posterior(models[t], v), score(flat, first, weights[t])
        p = np.where((v != 0).any(1), np.maximum(weak, linear), linear)
        p[m["words"] == 0] = float(t == JUNK)
        worst = np.maximum(worst, p)
        columns += [weak, linear, p]
    return columns, worst < 0.5


def _judge(sent):
    def run(batches):
        for part, none in _slices(batches):
            columns, kept = verdicts(part, none, *sent.value)
            yield pa.record_batch([part.column("doc_id"), *map(pa.array, columns), pa.array(kept)], names=_NAMES)

    return run


def _filter(sent):
    def run(batches):
        for part, none in _slices(batches):
            yield part.filter(pa.array(verdicts(part, none, *sent.value)[1]))

    return run


_NAMES = [
    "doc_id", "n_words", "junk_weak", "junk_linear", "junk", "toxic_weak", "toxic_linear", "toxic", "kept",
]
_DDL = ("doc_id long, n_words long, junk_weak double, junk_linear double, junk double, "
        "toxic_weak double, toxic_linear double, toxic double, kept boolean")  # fmt: skip


def _sampled(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """Distinct rows with their given votes: half of ``sample_rows`` labelled, or all if fewer, the rest not."""
    labelled = (F.col("given_junk") != 0) | (F.col("given_toxic") != 0)
    counted = _with_given(docs.select("doc_id"), labels).agg(F.count(F.when(labelled, 1)), F.count("*")).first()
    n_labelled, n_other = counted[0], counted[1] - counted[0]
    wanted = min(n_labelled, sample_rows // 2)
    parts = ((wanted, n_labelled), (sample_rows - wanted, n_other))
    cuts = [int(min(1.0, wanted / max(1, n)) * (1 << 30)) for wanted, n in parts]
    place = F.pmod("sample_key", F.lit(1 << 30))
    keyed = docs.withColumn("sample_key", F.xxhash64(F.lit("sample"), "doc_id", "text")).where(place < max(cuts))
    drawn = _with_given(keyed, labels).where(place < F.when(labelled, cuts[0]).otherwise(cuts[1]))
    return drawn.dropDuplicates(["sample_key"]).drop("sample_key")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """(learned word beginnings, label models, scorers) from the votes of all documents.

    Texts are mapped where they are read; only votes, and the bounded sample, meet the labels.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = (
        _sampled(docs, labels, sample_rows)
        .mapInArrow(_sample, "features binary, prefixes binary, junk binary, toxic binary")
        .collect()
    )
    rows.sort(key=lambda r: tuple(r))  # the order of training must not depend on that of arrival
    known = spark.sparkContext.broadcast(learn_prefixes(rows))
    cast = docs.mapInArrow(tidy(_vote(known)), "doc_id long, junk binary, toxic binary")
    counted = _with_given(cast, labels).groupBy("junk", "toxic", "given_junk", "given_toxic").count().collect()
    counted.sort(key=lambda r: tuple(r))
    models, weights = [], []
    empty = np.zeros(0, np.int64)
    flat = np.concatenate([np.frombuffer(r["features"], np.int32) for r in rows] or [empty]).astype(np.int64)
    first = np.concatenate([[0], np.cumsum([len(r["features"]) // 4 for r in rows], dtype=np.int64)])
    for t, name in enumerate(("junk", "toxic")):
        k = len(LABELLERS[t])
        v = np.array([np.frombuffer(r[name], np.int8) for r in counted], np.int8).reshape(-1, k).copy()
        if len(v):
            v[:, -1] = [r[f"given_{name}"] for r in counted]
        models.append(fit_em(v, np.array([r["count"] for r in counted], float)))
        cast = np.array([np.frombuffer(r[name], np.int8) for r in rows], np.int8).reshape(-1, k).copy()
        if t == TOXIC and len(rows):
            hit = np.array([np.isin(np.frombuffer(r["prefixes"], np.uint64), known.value).sum() for r in rows])
            cast[:, 2] = hit >= 1
            cast[:, 3] = np.where((cast[:, 0] == 0) & (hit == 0), -1, 0)
        p = posterior(models[t], cast)
        weights.append(train(flat, first, p, (cast != 0).any(1) * np.maximum(p, 1 - p)))
    return known.value, models, weights


def judge(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Scores of all documents: doc_id, n_words, weak and linear scores per target, kept."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample_rows))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(tidy(_judge(sent)), _DDL)


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample_rows))
    return docs.mapInArrow(tidy(_filter(sent)), docs.schema)
