"""Operator 12: ranked lexical search by the no-random-access algorithm (NRA).

One pass over the documents counts each document's terms and keeps those that an item asks for,
one row a document. Its sums give the number of documents, their mean length and each term's
document frequency. Documents are then dealt into shards of a bounded number of postings; every
shard meets every block of items (the stated query set against all rows, in blocks). There the
postings of a term lie in descending order of impact. An item reads its terms' lists only
sequentially, all to the same depth, in steps, and keeps an interval per document: the lower score
sums what was read of it, the upper adds, for each list it was not met in, the impact at which
that list stands. Reading ends when the best documents' intervals are points, no other document's
upper score reaches the last of them (or only ties with it at a larger id), and no document still
unmet can; else when all lists are read. The best of all shards are merged per item.

A term is a maximal run of letters and digits (ASCII) and of characters beyond ASCII; only A-Z are
lower-cased. Terms are compared as text.

The terms asked for are sent to the tasks while they are at most ``SENT_TERMS`` and ``SENT_BYTES``;
beyond, documents keep all their terms and the blocks of items look theirs up: the same rows.

Defined results: a null text has no terms; documents without terms count nowhere, items without
give no rows. Each row is a document of its own, also with a repeated or a null id; null ids come
last among equal scores. Items equal in id and text count once; a null item id is an id. Other
columns are ignored. Empty tables give none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored, text_bytes

#: Most distinct terms, and bytes of them, that are sent to every task.
SENT_TERMS, SENT_BYTES = 500_000, 8 << 20
#: Postings of a shard, items of a block, depth of the first step.
SHARD_POSTINGS, ITEMS, FIRST = 500_000, 512, 16
#: Bytes of text taken apart at a time.
SLICE_BYTES = 16 << 20
_LONG = 2**63 - 1

_TERM = np.zeros(256, bool)
_TERM[0x80:] = True
for _low, _high in ("09", "AZ", "az"):
    _TERM[ord(_low) : ord(_high) + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def terms_of(texts) -> tuple[pa.Array, np.ndarray]:
    """All terms of a string column one after another, and the first term of each row."""
    data, offsets = text_bytes(texts)
    keep = _TERM[data]
    start = keep.copy()
    start[1:] &= ~keep[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    start[heads] = keep[heads]  # a term does not reach over the end of a text
    at = np.flatnonzero(start)
    kept = _LOWER[data[keep]]
    ends = np.append(np.flatnonzero(start[keep]), len(kept)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return words, np.searchsorted(at, offsets)


def _counted(asked: pa.Array | None):
    """Tasks that count each text's terms, or those of them in ``asked``."""

    def count(ids: pa.Array, texts: pa.Array, base: int) -> pa.RecordBatch:
        words, first = terms_of(texts)
        n = np.diff(first)
        if asked is None:
            encoded = words.dictionary_encode()
            codes, names = encoded.indices.to_numpy(), encoded.dictionary
            hit = np.arange(len(codes))
        else:
            codes, names = pc.fill_null(pc.index_in(words, value_set=asked), -1).to_numpy(), asked
            hit = np.flatnonzero(codes >= 0)
            codes = codes[hit]
        row = np.searchsorted(first, hit, "right") - 1
        pair, tf = np.unique(row * max(1, len(names)) + codes, return_counts=True)
        row, code = np.divmod(pair, max(1, len(names)))
        cuts = pa.array(np.searchsorted(row, np.arange(len(n) + 1)), pa.int32())
        out = {
            "doc_id": ids.cast(pa.int64()),
            "row": pa.array(base + np.arange(len(n)), pa.int64()),
            "n": pa.array(n, pa.int64()),
            "terms": pa.ListArray.from_arrays(cuts, names.take(pa.array(code)).cast(pa.string())),
            "tfs": pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int64())),
        }
        return pa.RecordBatch.from_pydict(out).filter(pa.array(n > 0))

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
            for lo in (cuts := np.flatnonzero(np.diff(part, prepend=-1))):
                hi = cuts[cuts > lo].min(initial=len(part))
                piece = batch.slice(lo, hi - lo)
                yield count(piece.column(0), piece.column(1), base)
                base += len(piece)

    return run


def _counts(df: DataFrame, id_column: str, text: str, asked: pa.Array | None, label: str) -> DataFrame:
    """(doc_id, row, n, terms, tfs) of every row with terms, written; ``row`` numbers them uniquely."""
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = "doc_id long, row long, n long, terms array<string>, tfs array<long>"
    return stored(rows.mapInArrow(_counted(asked), kind), label)


def _asked_terms(items: DataFrame) -> pa.Array | None:
    """The distinct terms of all items, if they are few enough to be sent to every task."""
    terms = items.select(F.explode("terms").alias("term")).distinct()
    size = terms.agg(F.count("*"), F.sum(F.octet_length("term"))).first()
    if size[0] > SENT_TERMS or (size[1] or 0) > SENT_BYTES:
        return None
    return pa.array(sorted(r.term for r in terms.collect()), pa.large_string())


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 8 * m) with m = 10 + (90 * n * docs) div total."""
    if 90 * int(n.max(initial=0)) * docs > _LONG:
        n = n.astype(object)
    m = 10 + (90 * n * docs) // total
    return (1_000_000_000 * tf // (1000 * tf + 8 * m)).astype(np.int64)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, first: int = FIRST):
    """The k best documents (numbers, scores, best first) of lists of (documents, descending score).

    ``ids`` orders equal scores. Also returns how many postings were read.
    """
    n, depth, step, read = len(ids), 0, first, 0
    longest = max((len(docs) for docs, _ in lists), default=0)
    lower = np.zeros(n, np.int64)
    met: list[tuple[int, np.ndarray]] = []
    while True:
        for t, (docs, scores) in enumerate(lists):
            docs = docs[depth : depth + step]
            if len(docs):
                lower[docs] += scores[depth : depth + step]
                met.append((t, docs))
                read += len(docs)
        depth, step = depth + step, step * 2
        seen = np.flatnonzero(lower > 0)
        best = seen
        if len(seen) > k:
            last = np.partition(lower[seen], len(seen) - k)[len(seen) - k]
            best = seen[lower[seen] >= last]
        best = best[np.lexsort((ids[best], -lower[best]))][:k]
        if depth >= longest:
            return best, lower[best], read
        if len(best) < k:
            continue
        ahead = np.array([scores[depth] if depth < len(scores) else 0 for _, scores in lists], np.int64)
        unmet = int(ahead.sum())
        last, last_id = lower[best[-1]], ids[best[-1]]
        if unmet >= last:
            continue
        # sums below 2**53 are exact as doubles
        known = np.zeros(n, np.int64)
        for t, docs in met:  # a list holds a document once
            known[docs] += ahead[t]
        upper = lower + unmet - known
        if (upper[best] != lower[best]).any():
            continue
        others = np.ones(n, bool)
        others[best] = False
        others &= lower > 0
        if not (others & ((upper > last) | ((upper == last) & (ids < last_id)))).any():
            return best, lower[best], read


def _search(k: int, docs: int, total: int):
    """A task of one shard and one block of items: each item's k best of the shard."""

    def run(shard: pa.Table, items: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        if shard.num_rows and items.num_rows:
            wanted = items["terms"].combine_chunks()
            words = wanted.flatten().dictionary_encode()
            weights = items["weights"].combine_chunks().flatten().to_numpy()
            own = np.append(0, np.cumsum(pc.list_value_length(wanted).to_numpy()))
            terms = shard["terms"].combine_chunks()
            code = pc.fill_null(pc.index_in(terms.flatten(), value_set=words.dictionary), -1).to_numpy()
            doc = np.repeat(np.arange(shard.num_rows), pc.list_value_length(terms).to_numpy())
            tf = shard["tfs"].combine_chunks().flatten().to_numpy()
            n = shard["n"].to_numpy()
            keep = code >= 0
            code, doc = code[keep], doc[keep]
            impact = impacts(tf[keep], n[doc], docs, total)
            order = np.lexsort((doc, -impact, code))  # a list per term, best impact first
            doc, impact = doc[order], impact[order]
            cuts = np.searchsorted(code[order], np.arange(len(words.dictionary) + 1))
            ids = pc.fill_null(shard["doc_id"], _LONG).to_numpy()
            codes = words.indices.to_numpy()
            for i in range(items.num_rows):
                lists = [
                    (doc[cuts[c] : cuts[c + 1]], w * impact[cuts[c] : cuts[c + 1]])
                    for c, w in zip(codes[own[i] : own[i + 1]], weights[own[i] : own[i + 1]])
                    if w > 0 and cuts[c + 1] > cuts[c]
                ]
                best, scores, _ = nra(lists, ids, k)
                for x, y in zip(found, (np.full(len(best), i), best, scores)):
                    x.append(y)
        i, best, scores = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        out = {
            "item_id": items["item_id"].take(pa.array(i)),
            "item_row": items["row"].take(pa.array(i)),
            "doc_id": shard["doc_id"].take(pa.array(best)),
            "row": shard["row"].take(pa.array(best)),
            "score": pa.array(scores, pa.int64()),
        }
        return pa.table(out)

    return run


def _weight(df: Column, docs: int) -> Column:
    return F.floor(1000 * F.log(F.lit(2.0 * docs + 2.0) / (2.0 * df + 1.0))).cast("long")


def search(
    documents: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents of the highest score above 0."""
    asked = _counts(items.select(item_id, text).distinct(), item_id, text, None, "lexical-items")
    counts = _counts(documents, doc_id, text, _asked_terms(asked), "lexical-documents")
    docs, total, postings = counts.agg(F.count("*"), F.sum("n"), F.sum(F.size("terms"))).first()
    shards = max(1, -(-(postings or 0) // SHARD_POSTINGS))
    blocks = max(1, -(-asked.count() // ITEMS))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    weights = (
        counts.select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
        .select("term", _weight(F.col("df"), docs).alias("w"))
    )
    lists = (
        asked.select("row", F.col("doc_id").alias("item_id"), F.explode("terms").alias("term"))
        .join(weights, "term")
        .groupBy("row", "item_id")
        .agg(F.collect_list(F.struct("term", "w")).alias("own"))
        .select("row", "item_id", F.col("own.term").alias("terms"), F.col("own.w").alias("weights"))
    )
    key = ["shard", "block"]
    left = counts.where(F.size("terms") > 0).withColumn("shard", dealt(shards)).withColumn("block", every(blocks))
    right = lists.withColumn("block", dealt(blocks)).withColumn("shard", every(shards))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _search(k, docs, total or 1), "item_id long, item_row long, doc_id long, row long, score long"
    )
    best = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
