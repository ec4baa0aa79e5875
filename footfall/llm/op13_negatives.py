"""Operator 13: hard negatives by Fagin's threshold algorithm.

Rows are dealt by a hash of their content into index blocks of bounded size. A block holds, beside
its rows, one list per dimension of the rows in ascending order of that component; it is written
once and read by both passes. For an anchor the lists are read from the end that its component's
sign makes best (sorted access), in steps; every row met is scored exactly in integers (random
access). What the lists show at the depth reached gives the threshold: no row still unmet can score
more. A block is left as soon as the threshold lies strictly below the k-th score of every window
asked for, or below the window itself, so ties are never cut. A task walks several blocks one after
another for a block of anchors and carries the best found from block to block; the best of all
tasks are merged per window.

The first pass asks one window per anchor, rows of its own label without bounds: its positives.
The second asks one window per positive, rows of other labels between two shares of its score.

Defined results: a row takes no part whose id, label or vector is null, whose vector is empty or
holds a null or non-finite component. Labels are whole numbers. Vectors meet those of equal length
only. Rows that are equal in id, label and vector count once; rows that share only the id are rows
of their own, except that no row with the anchor's id is its positive. Ties go to the smaller id. A
score beyond 64 bits counts as the largest or smallest long. A window of a negative score is empty,
that of a score of 0 holds the score 0. Anchors without positives, or positives without negatives,
give no rows. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

#: Rows of an index block, blocks that a task walks with one running result, anchors of a block.
BLOCK, RUN, ANCHORS = 4096, 4, 512
#: Depth of the first step of sorted access; each step is twice as long as the one before.
FIRST = 32
_LONG = 2**63 - 1
_KEY = ["dim", "a_block"]


def _rows(df: DataFrame, id_column: str, label: str, vector: str) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.col(id_column).isNotNull() & F.col(label).isNotNull() & (F.size(vector) > 0)
    return (
        df.where(whole & F.forall(vector, finite))
        .select(
            F.col(id_column).cast("long").alias("id"),
            F.col(label).cast("long").alias("label"),
            F.size(vector).alias("dim"),
            F.transform(vector, lambda x: x.cast("double")).alias("v"),
        )
        .distinct()
    )


def _dealt(rows: DataFrame, n: int) -> Column:
    return F.pmod(F.xxhash64("id", "label", "v"), F.lit(n))


def _components(group: pa.Table) -> np.ndarray:
    return group["v"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)


def _index(group: pa.Table) -> pa.Table:
    """One row: ids, labels, vectors, and per dimension the rows in ascending order."""
    v = _components(group)
    # a block has BLOCK rows on average, far below what 16 bits can number
    lists = np.argsort(v, axis=0, kind="stable").T.astype(np.uint16)
    row = {
        "dim": pa.array([v.shape[1]], pa.int32()),
        "block": pa.array([group["block"][0].as_py()], pa.int64()),
        "lists": pa.array([lists.tobytes()], pa.binary()),
    }
    return pa.table(row | _packed(group, v))


def _packed(group: pa.Table, v: np.ndarray) -> dict:
    parts = {"ids": group["id"].to_numpy(), "labels": group["label"].to_numpy(), "vectors": v}
    return {k: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for k, x in parts.items()}


def _asked(group: pa.Table) -> pa.Table:
    """One row of a block of anchors: ids, labels, vectors."""
    v = _components(group)
    row = {
        "dim": pa.array([v.shape[1]], pa.int32()),
        "a_block": pa.array([group["a_block"][0].as_py()], pa.int64()),
    }
    return pa.table(row | _packed(group, v))


def scaled(v: np.ndarray, scale: float, bits: int = 62) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python's where inner products might not fit."""
    with np.errstate(over="ignore"):
        whole = np.floor(v * scale)
    top = np.abs(whole).max(initial=0)
    if top < 2.0 ** ((bits - math.log2(max(1, v.shape[-1]))) / 2):
        return whole.astype(np.int64)
    exact = [math.floor(Fraction(float(x)) * Fraction(scale)) for x in v.ravel()]
    out = np.empty(len(exact), object)
    out[:] = exact
    return out.reshape(v.shape)


def _scores(values: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    if values.dtype != object and anchor.dtype != object:
        return values @ anchor
    return np.array([max(-_LONG, min(_LONG, int(x))) for x in values.astype(object) @ anchor.astype(object)], np.int64)


class Best:
    """The k best (score, id) of a window of scores, smaller ids first among equals."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.low) & (scores <= self.high)
        if len(self.scores) == self.k:
            inside &= scores >= self.scores[-1]
        if not inside.any():
            return
        scores = np.concatenate([self.scores, scores[inside]])
        ids = np.concatenate([self.ids, ids[inside]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    def certain(self, threshold: int) -> bool:
        """True if no row scoring at most ``threshold`` can change the window."""
        full = len(self.scores) == self.k
        return self.low > self.high or threshold < self.low or (full and threshold < self.scores[-1])


def threshold_scan(anchor, values, lists, ids, usable, windows: list[Best]) -> int:
    """Adds a block's rows to the windows by the threshold algorithm; returns how many it scored."""
    live = np.flatnonzero(anchor != 0)
    if not len(live):
        live = np.zeros(1, np.int64)
    n = len(ids)
    lists = lists[live]
    best_first = np.where((anchor[live] > 0)[:, None], lists[:, ::-1], lists)
    weights = anchor[live]

    def threshold(depth: int) -> int:
        return int((weights * values[best_first[:, depth - 1], live]).sum())

    pending = usable.copy()
    depth, step, scored = 0, FIRST, 0
    bound = threshold(1)
    while depth < n and not all(w.certain(bound) for w in windows):
        met = np.zeros(n, bool)
        met[best_first[:, depth : depth + step]] = True
        met &= pending
        pending ^= met
        rows = np.flatnonzero(met)
        scores = _scores(values[rows], anchor)
        scored += len(rows)
        for w in windows:
            w.add(scores, ids[rows])
        depth, step = min(n, depth + step), step * 2
        bound = threshold(depth)
    return scored


def _unpacked(row: dict, scale: float):
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), scaled(vectors, scale)


def _search(k: int, scale: float, same_label: bool):
    """A task of one block of anchors and a run of index blocks: the k best of each window."""

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("dim", "a_block", "a", "w", "anchor_id", "id", "score")}
        if index.num_rows and asked.num_rows:
            q = asked.slice(0, 1).to_pylist()[0]
            a_ids, a_labels, a_values = _unpacked(q, scale)
            if same_label:
                windows = {a: [Best(k, -_LONG, _LONG)] for a in range(len(a_ids))}
            else:
                windows = {}
                for w in sorted(q["windows"], key=lambda w: (w["a"], w["w"])):
                    windows.setdefault(w["a"], []).append(Best(k, w["low"], w["high"]))
            for batch in index.to_batches(max_chunksize=1):
                ids, labels, values = _unpacked(block := batch.to_pylist()[0], scale)
                lists = np.frombuffer(block["lists"], np.uint16).reshape(q["dim"], -1)
                for a, own in windows.items():
                    alike = labels == a_labels[a]
                    usable = alike & (ids != a_ids[a]) if same_label else ~alike
                    threshold_scan(a_values[a], values, lists, ids, usable, own)
            for a, own in windows.items():
                for w, best in enumerate(own):
                    n = len(best.ids)
                    row = (q["dim"], q["a_block"], a, w, a_ids[a], None, None)
                    for name, x in zip(out, row):
                        out[name].append(np.full(n, x) if x is not None else getattr(best, name + "s"))
        flat = {name: np.concatenate(x) if x else np.zeros(0) for name, x in out.items()}
        kinds = dict.fromkeys(flat, pa.int64()) | {"dim": pa.int32(), "a": pa.int32(), "w": pa.int32()}
        return pa.table({name: pa.array(x.astype(np.int64), pa.int64()).cast(kinds[name]) for name, x in flat.items()})

    return run


def _best_rows(index: DataFrame, runs: int, asked: DataFrame, blocks: int, k: int, scale: float, same_label: bool):
    """The k best rows of each window over all index blocks, ranked."""
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    key = [*_KEY, "run"]
    left = index.withColumn("run", F.pmod("block", F.lit(runs))).withColumn("a_block", every(blocks))
    found = left.groupBy(*key).cogroup(asked.withColumn("run", every(runs)).groupBy(*key)).applyInArrow(
        _search(k, scale, same_label),
        "dim int, a_block long, a int, w int, anchor_id long, id long, score long",
    )
    best = Window.partitionBy(*_KEY, "a", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: float = 256.0,
    id_column: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` has the columns of ``vectors``. For each anchor and each of its best ``positives``
    rows of the same label, the best ``negatives`` rows of other labels whose score lies between
    the two percentages of the positive's score.
    """
    blocks = max(1, -(-anchors.count() // ANCHORS))
    n = max(1, -(-vectors.count() // BLOCK))
    runs = -(-n // RUN)
    packed = "ids binary, labels binary, vectors binary"
    rows = _rows(vectors, id_column, label, vector)
    index = stored(
        rows.withColumn("block", _dealt(rows, n)).groupBy("dim", "block").applyInArrow(
            _index, f"dim int, block long, lists binary, {packed}"
        ),
        "negatives-index",
    )
    own = _rows(anchors, id_column, label, vector)
    asked = stored(
        own.withColumn("a_block", _dealt(own, blocks)).groupBy(*_KEY).applyInArrow(
            _asked, f"dim int, a_block long, {packed}"
        ),
        "negatives-anchors",
    )
    first = stored(
        _best_rows(index, runs, asked, blocks, positives, scale, True), "negatives-positives"
    )
    share = lambda p: F.col("score").cast("decimal(38,0)") * p / 100
    window = F.struct(
        "a",
        (F.col("rank") - 1).alias("w"),
        F.ceil(share(low_percent)).cast("long").alias("low"),
        F.floor(share(high_percent)).cast("long").alias("high"),
    )
    windows = first.groupBy(*_KEY).agg(F.collect_list(window).alias("windows"))
    second = _best_rows(index, runs, asked.join(windows, _KEY), blocks, negatives, scale, False)
    known = first.select(
        *_KEY, "a", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return second.join(known, [*_KEY, "a", "w"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
