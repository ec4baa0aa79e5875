"""Operator 4: exact top-k search by a vector-approximation file.

Vectors are dealt into blocks of bounded size, which are written once. A block holds its exact
integer vectors and, as the approximation, one cell number of a few bits per component, with the
cells' edges. First the cells alone are scanned: every block of queries meets the cells of every
block of candidates (the stated query set against all rows, in blocks). One product with the cells'
middles and the widest half cell give a lower and an upper bound of each inner product. The k-th
highest of a query's lower bounds over all blocks is its floor. Then the cells are scanned against
the floors, and exact vectors are read, in the order of their bound, best first, only for rows whose
upper bound reaches the floor, until the k-th result found is certain, i.e. better than the bound of
the next. The k best of each task are merged per query.

Several blocks of candidates meet several blocks of queries in a task, so that a block is sent to few
of them, and the scan hands on some bounds per query and task, never rows. Blocks meet in shuffles
only: as a block goes to many tasks, a broadcast would send each of its copies through the driver.

Defined results: a vector that is null, empty or holds a null or non-finite component, or whose id
is null, takes no part; vectors meet those of equal length only. Ties go to the smaller id. Repeated
ids are candidates each on its own, except the query's own id; of equal rows no more than k can
count, so no more are held. Components after ``scale`` saturate at 2**61, scores at the limits of
long. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored, tidy, tidy_group

BLOCK = 4096
QUERY_BLOCK = 2048
#: Blocks that meet in a task: of candidates, and of queries, at most so many and so many numbers of each.
TOGETHER = 32
NUMBERS = 1 << 23
#: Parts that the blocks of candidates make at least, if there are as many.
SPREAD = 24
#: Rows of a block that are scanned at a time, to bound the size of the matrix.
ROWS = 512
#: Queries that gather rows above their floors at a time, and rows after which these are read.
QUERIES = 1024
GATHERED = 1 << 21
CELL_BITS = 5
LARGEST = 1 << 61
LONG = 2.0**63
_BLOCK_SCHEMA = "dim int, block long, ids binary, exact binary, cells binary, edges binary"
_LOWER_SCHEMA = "dim int, q_block long, lower binary"
_ASKED_SCHEMA = "dim int, q_block long, q_ids binary, q_exact binary, floors binary"
_BEST_SCHEMA = "query_id long, vec_id long, score long"


def _usable(vector: str) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def _pack(group: pa.Table) -> pa.Table:
    """One row of a block: ids, exact vectors, cell numbers, and the cells' edges per component."""
    dim = group["dim"][0].as_py()
    ids = group["id"].combine_chunks().to_numpy()
    flat = group["v"].combine_chunks().flatten().to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    exact = flat.reshape(-1, dim)[order]
    n = 1 << CELL_BITS
    ends = list(zip(exact.min(0).tolist(), exact.max(0).tolist()))
    # cell c of a component: edges[c] up to edges[c + 1] - 1
    edges = np.array([[low + c * (high - low + 1) // n for low, high in ends] for c in range(n + 1)], np.int64)
    cells = np.empty(exact.shape, np.uint8)
    for d in range(dim):
        cells[:, d] = np.searchsorted(edges[1:-1, d], exact[:, d], "right")
    exact = exact.astype(next(f"i{n}" for n in (1, 2, 4, 8) if np.abs(exact).max() < 1 << 8 * n - 1))
    row = {"dim": dim, "block": group["block"][0].as_py(), "ids": ids[order].astype(np.int64).tobytes()}
    row |= {"exact": exact.tobytes(), "cells": cells.tobytes(), "edges": edges.tobytes()}
    return _table([row], _BLOCK_SCHEMA)


def _vectors(packed: bytes, n: int, dim: int) -> np.ndarray:
    """The exact vectors of a block, in the width they were packed in."""
    return np.frombuffer(packed, f"i{len(packed) // (n * dim)}").reshape(n, dim)


def _blocks(vectors: DataFrame, size: int, k: int, label: str) -> tuple[DataFrame, int]:
    """``vectors`` (id, dim, v) in written blocks of about ``size``, one row each; how many numbers there are."""
    n = max(1, -(-vectors.count() // size))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k))))
    held = vectors.groupBy("id", "dim", "v").agg(F.count("*").alias("copies")).withColumn("copy", copies)
    # dealt by content, so that a task that runs again deals alike
    held = held.withColumn("block", F.pmod(F.xxhash64("id", "v", "copy"), F.lit(n)))
    held = held.select("dim", "block", "id", "v").groupBy("dim", "block").applyInArrow(tidy_group(_pack), _BLOCK_SCHEMA)
    return stored(held, label), n


def bounds(q: np.ndarray, cells: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(middle, width): each product of a query and a row lies within its middle plus or minus the query's width."""
    size, far = np.abs(q.astype(float)), np.abs(edges.astype(float)).max(0)
    half = ((edges[1:] - edges[:-1]).max(0) - 1) / 2
    # single precision where nothing can overflow in it; the widths hold what either loses
    kind, unit = (np.float32, 2.0**-22) if size.max() * far.max() * q.shape[1] < 2.0**100 else (np.float64, 2.0**-51)
    middles = ((edges[:-1].astype(float) + (edges[1:] - 1).astype(float)) / 2).astype(kind)
    rows = middles[cells, np.arange(q.shape[1])]
    return q.astype(kind) @ rows.T, size @ half + (q.shape[1] + 4) * unit * (size @ far)


def _scanned(q_ids, q, ids, cells, edges):
    """(first row, middles, widths) of some rows of a block at a time; a query's own rows never count."""
    for lo in range(0, len(ids), ROWS):
        some = ids[lo : lo + ROWS]
        middle, width = bounds(q, cells[lo : lo + ROWS], edges)
        for j in np.flatnonzero(np.isin(q_ids, some)):
            middle[j, some == q_ids[j]] = -np.inf
        yield lo, middle, width


def _places(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true; many times faster than ``nonzero`` on the matrix."""
    return np.divmod(np.flatnonzero(found), found.shape[1])


def highest_lower(q_ids, q, blocks, k: int) -> np.ndarray:
    """Per query: the k highest lower bounds of rows in ``blocks`` (ids, cells, edges), the least of them first."""
    top = np.full((len(q_ids), k), -np.inf)
    for block in blocks:
        for _, lower, width in _scanned(q_ids, q, *block):
            lower -= width[:, None]
            at, place = _places(lower > top[:, :1].astype(lower.dtype))
            counts = np.bincount(at, minlength=len(top))
            both = np.full((len(top), k + counts.max()), -np.inf)
            both[:, :k] = top
            both[at, k + np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)] = lower[at, place]
            top = np.partition(both, counts.max(), axis=1)[:, counts.max() :]
    return top


def scan_cells(q_ids, q, ids, cells, edges, k: int, floors=None) -> tuple[np.ndarray, list, list]:
    """Per query: the floor; places in the block, and upper bounds, of the rows that reach it.

    Without ``floors`` it is the block's k-th lower bound. Beyond the limits of long all scores tie.
    """
    if floors is None:
        floors = highest_lower(q_ids, q, [(ids, cells, edges)], k)[:, 0]
    found = []
    for lo, middle, width in _scanned(q_ids, q, ids, cells, edges):
        least = np.where(floors > -LONG, np.minimum(floors, LONG) - width, np.finfo(middle.dtype).min)
        at, place = _places(middle >= least[:, None].astype(middle.dtype))
        upper = np.maximum(middle[at, place] + width[at], -LONG)
        found.append((at.astype(np.int32), (place + lo).astype(np.int32), upper))
    at, places, upper = map(np.concatenate, zip(*found))
    order, ends = np.argsort(at, kind="stable"), np.cumsum(np.bincount(at, minlength=len(q_ids)))[:-1]
    return floors, np.split(places[order], ends), np.split(upper[order], ends)


def _products(exact: np.ndarray, q: np.ndarray) -> np.ndarray:
    if float(np.abs(exact).max()) * float(np.abs(q).max()) * len(q) < 2.0**62:
        return exact.astype(np.int64) @ q.astype(np.int64)
    wide = exact.astype(object) @ q.astype(object)
    return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in wide], np.int64)


def refine(q, ids, exact, places, upper, floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows above ``floor``, reading exact vectors by bound."""
    order = np.argsort(-upper, kind="stable")
    order = order[upper[order] >= min(floor, LONG)]
    places, upper = places[order], upper[order]
    best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, step = 0, 2 * k
    while at < len(places) and (len(best) < k or upper[at] >= best[-1]):
        take = places[at : at + step]
        best_id, best = np.concatenate([best_id, ids[take]]), np.concatenate([best, _products(exact[take], q)])
        order = np.lexsort((best_id, ~best))[:k]  # ~x falls as x grows, also at the limits of long
        best_id, best = best_id[order], best[order]
        at, step = at + step, step * 2
    above = best >= min(floor, LONG)
    return best_id[above], best[above]


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.Table.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))


def _queries(asked: pa.Table):
    """Rows of ``asked``, one at a time, with their ids and exact vectors."""
    for i in range(asked.num_rows):
        r = asked.slice(i, 1).to_pylist()[0]
        ids = np.frombuffer(r["q_ids"], np.int64)
        yield r, ids, _vectors(r["q_exact"], len(ids), r["dim"])


def _cells(held: list[dict]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, cells, edges) of each block."""
    arrays = lambda h: (np.frombuffer(h["cells"], np.uint8), np.frombuffer(h["edges"], np.int64))
    return [(np.frombuffer(h["ids"], np.int64), *(x.reshape(-1, h["dim"]) for x in arrays(h))) for h in held]


def _lower(k: int):
    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        blocks, out = _cells(held.to_pylist()), []
        for r, q_ids, q in _queries(asked if blocks else asked.slice(0, 0)):
            top = np.sort(highest_lower(q_ids, q, blocks, k), axis=1)
            # a few times a part's share of k: the floor is valid whatever is left out, and hardly lower
            out.append(r | {"lower": top[:, -min(k, -(-4 * k // r["parts"])) :].tobytes()})
        return _table(out, _LOWER_SCHEMA)

    return run


def _floors(k: int):
    def run(asked: pa.Table, lower: pa.Table) -> pa.Table:
        out = []
        for r, q_ids, _ in _queries(asked):  # one row
            parts = [np.frombuffer(x, float).reshape(len(q_ids), -1) for x in lower["lower"].to_pylist()]
            every = np.concatenate([np.full((len(q_ids), k), -np.inf), *parts], axis=1)
            out.append(r | {"floors": np.partition(every, every.shape[1] - k, axis=1)[:, every.shape[1] - k].tobytes()})
        return _table(out, _ASKED_SCHEMA)

    return run


def _gathered(q_ids, q, blocks, k: int, floors):
    """Places in all blocks, and upper bounds, of the rows that reach ``floors``, per query; some blocks at a time.

    Floors may be raised meanwhile.
    """
    found, first, n = [], 0, 0
    for block in blocks:
        _, places, upper = scan_cells(q_ids, q, *block, k, floors)
        found.append(([x + first for x in places], upper))
        first, n = first + len(block[0]), n + sum(map(len, places))
        if n >= GATHERED or block is blocks[-1]:
            yield ([np.concatenate([x[i][j] for x in found]) for i in (0, 1)] for j in range(len(q_ids)))
            found, n = [], 0


def _refine(k: int):
    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[list] = [[np.zeros(0, np.int64)] for _ in range(3)]
        rows = held.to_pylist()
        blocks = _cells(rows)
        if blocks:
            ids = np.concatenate([x[0] for x in blocks])
            exact = np.concatenate([_vectors(h["exact"], len(x[0]), h["dim"]) for h, x in zip(rows, blocks)])
        for r, all_ids, all_q in _queries(asked if blocks else asked.slice(0, 0)):
            for some in (slice(lo, lo + QUERIES) for lo in range(0, len(all_ids), QUERIES)):
                q_ids, q, floors = all_ids[some], all_q[some], np.frombuffer(r["floors"], float)[some].copy()
                for found in _gathered(q_ids, q, blocks, k, floors):
                    for j, (places, upper) in enumerate(found):
                        best_id, best = refine(q[j], ids, exact, places, upper, floors[j], k)
                        if len(best) == k:
                            floors[j] = max(floors[j], best[-1])
                        out[0].append(np.full(len(best), q_ids[j]))
                        out[1].append(best_id)
                        out[2].append(best)
        return pa.table([pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"])

    return run


def _parts(block: str, n: int, size: int, spread: int = 1) -> tuple[Column, Column]:
    """(the part that a block is in, how many parts there are) of ``n`` blocks, by the vectors' length."""
    most = F.floor(F.lit(NUMBERS / size) / F.col("dim"))
    width = F.greatest(F.lit(1), F.least(F.lit(max(1, min(TOGETHER, n // spread))), most))
    return F.floor(F.col(block) / width), F.ceil(F.lit(n) / width)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each row of ``queries``."""
    floor = lambda x: F.floor(x.cast("double") * scale)
    whole = F.transform(vector, lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), floor(x))))

    def usable(df: DataFrame) -> DataFrame:
        return df.where(_usable(vector) & F.col(id_column).isNotNull()).select(
            F.col(id_column).cast("long").alias("id"), F.size(vector).alias("dim"), whole.alias("v")
        )

    asked, n_asked = _blocks(usable(queries), QUERY_BLOCK, k, "top_k_queries")
    held, n_held = _blocks(usable(vectors), BLOCK, k, "top_k_blocks")
    part, parts = _parts("block", n_held, BLOCK, SPREAD)
    q_part, q_parts = _parts("q_block", n_asked, QUERY_BLOCK)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asked = asked.withColumnsRenamed({"block": "q_block", "ids": "q_ids", "exact": "q_exact"})
    asked = asked.select("dim", "q_block", "q_ids", "q_exact")
    held = held.withColumn("part", part).withColumn("q_part", each(q_parts))
    keys = ["dim", "part", "q_part"]

    def meet(held: DataFrame, asked: DataFrame, run, schema: str) -> DataFrame:
        asked = asked.withColumns({"q_part": q_part, "parts": parts}).withColumn("part", each(F.col("parts")))
        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(tidy_group(run), schema)

    lower = meet(held.drop("block", "exact"), asked, _lower(k), _LOWER_SCHEMA)
    block = ["dim", "q_block"]
    floors = asked.groupBy(*block).cogroup(lower.groupBy(*block)).applyInArrow(tidy_group(_floors(k)), _ASKED_SCHEMA)
    result = meet(held.drop("block"), stored(floors, "top_k_floors"), _refine(k), _BEST_SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        result.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
