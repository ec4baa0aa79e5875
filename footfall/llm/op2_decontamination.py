"""Operator 2: benchmark decontamination by greedy string tiling.

Benchmark items are cut into overlapping seeds of ``min_match`` words (A-Z lower-cased); their
rolling Karp-Rabin hashes are joined with those of all words of all documents. Of the pairs of
equal seeds only those at which a maximal match begins are formed, where the words before differ or
a text begins; running Karp-Rabin sums give its length. So a long text of one repeated word makes as
many pairs as it and the item have words, not their product. For each document and item whose matches
together reach the threshold, the longest match whose words are free in both texts is marked again
and again, a match that is partly taken goes back shortened. The share of an item's words under
tiles is its coverage. Tiles may lie anywhere, so a passage whose sentences were reordered is caught
as well as an intact one.

The benchmark is handled in blocks of at most ``BLOCK_WORDS`` words; one block's seeds are sent to
every task, so what is broadcast is bounded whatever the benchmark's size, which only adds passes.

Defined results: null, empty and blank texts, on either side, match nothing. An item with fewer
words than ``min_match`` is a single seed. Repeated documents and items are judged each on its own;
a null id is kept. Empty tables give no rows, extra columns are ignored. Of equally long matches the
first in the document is marked, then the first in the item. A very long text is tiled whole.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.common import mix, prefix_sums, tidy, windows, words_of

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_WORDS = 200_000
_FILTER_BITS = 20
#: Matches of several texts that are formed at a time; those of one text always are.
_MATCHES = 1 << 18


def tile(length: np.ndarray, p: np.ndarray, q: np.ndarray, width: int, n_item: int) -> tuple[int, int]:
    """(item words under tiles, tiles) by greedy tiling of maximal matches: their length, and where
    they begin in document and item. No tile is shorter than ``width``."""
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(length, p - p.min(), q)]
    heapq.heapify(heap)
    taken_q = np.zeros(n_item, bool)
    taken_p = np.zeros(int((p - p.min() + length).max()), bool)
    covered = tiles = 0
    while heap and covered < n_item:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~(taken_q[b : b + n] | taken_p[a : a + n])
        if free.all():
            taken_q[b : b + n] = taken_p[a : a + n] = True
            covered += n
            tiles += 1
            continue
        edges = np.flatnonzero(np.diff(free, prepend=False, append=False))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= width:  # what is left free goes back, if it is long enough
                heapq.heappush(heap, (lo - hi, a + lo, b + lo))
    return covered, tiles


def _before(words) -> np.ndarray:
    """Hash of the word before each word, 0 at the beginning of a text."""
    out = np.zeros(len(words.hash), np.uint64)
    out[1:] = words.hash[:-1]
    starts = words.first[:-1]
    out[starts[starts < len(out)]] = 0
    return out


class Side:
    """Seeds of one width, sorted by their hash and the word before, with a bit filter."""

    def __init__(self, hashes: np.ndarray, before: np.ndarray, at: np.ndarray):
        order = np.lexsort((before, hashes))
        self.hashes, self.at, before = hashes[order], at[order], before[order]
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        new = np.ones(len(order), bool)
        new[1:] = (self.hashes[1:] != self.hashes[:-1]) | (before[1:] != before[:-1])
        start = np.flatnonzero(new)
        key = mix(self.hashes[start] + mix(before[start]))
        by_key = np.argsort(key)
        self.key, self.start = key[by_key], start[by_key]
        self.stop = np.append(start, len(order))[1:][by_key]

    def beginnings(self, rolled: np.ndarray, whole: np.ndarray, before: np.ndarray):
        """Places with a seed of this side and the seeds at which a match begins there: place,
        and two ranges of seeds, those before and after the ones with the same word before."""
        place = np.flatnonzero(self.bits[(rolled >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & whole)
        lo = np.searchsorted(self.hashes, rolled[place], "left")
        hi = np.searchsorted(self.hashes, rolled[place], "right")
        hit = hi > lo
        place, lo, hi = place[hit], lo[hit], hi[hit]
        key = mix(rolled[place] + mix(before[place]))
        i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        same = (self.key[i] == key) & (before[place] != 0) & (self.start[i] >= lo) & (self.stop[i] <= hi)
        return place, (lo, np.where(same, self.start[i], lo)), (np.where(same, self.stop[i], lo), hi)


def _expand(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that start at ``lo`` and have ``n`` numbers."""
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Seeds:
    """Seeds of one block of benchmark items."""

    def __init__(self, ids: list, texts: list, min_match: int):
        self.words = words = words_of(pa.array(texts, pa.string()), fold=True)
        self.ids, self.size = ids, np.diff(words.first)
        self.sums = prefix_sums(words)
        self.row = words.rows()
        width = np.minimum(self.size, min_match)
        self.by_width = {}
        for n in sorted(set(width.tolist()) - {0}):
            hashes, whole = windows(words, n)
            use = np.flatnonzero(whole & (width[self.row] == n))
            self.by_width[n] = Side(hashes[use], _before(words)[use], use)

    def _lengths(self, sums, p: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that texts have in common from places ``p`` and ``q`` on, at most ``most``."""
        (own, factor), (its, its_factor) = sums, self.sums
        n = np.zeros(len(p), np.int64)
        for step in 1 << np.arange(int(most.max()).bit_length())[::-1]:
            may = np.flatnonzero(n + step <= most)
            a, b = p[may] + n[may], q[may] + n[may]
            same = (own[a + step] - own[a]) * factor[a] == (its[b + step] - its[b]) * its_factor[b]
            n[may[same]] += step
        return n

    def matches(self, texts, threshold: float):
        """(row, item index, covered words, tiles, item words) of rows and items of which matches
        cover ``threshold`` of the item, perhaps not all by tiles."""
        words = words_of(texts, fold=True)
        sums, before = None, _before(words)
        for width, side in self.by_width.items():
            place, *ranges = side.beginnings(*windows(words, width), before)
            if not len(place):
                continue
            sums = sums or prefix_sums(words)
            row = np.searchsorted(words.first, place, "right") - 1
            n = sum(hi - lo for lo, hi in ranges)
            # rows are dealt into parts by the matches before them
            per_row = np.bincount(row, n, len(words.first) - 1)
            part = ((np.cumsum(per_row) - per_row) // _MATCHES)[row]
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=part[-1] + 1))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                yield from self._tiled(
                    words, sums, width, side, place[lo:hi], [(a[lo:hi], b[lo:hi]) for a, b in ranges], threshold
                )

    def _tiled(self, words, sums, width, side, place, ranges, threshold):
        p = np.concatenate([np.repeat(place, b - a) for a, b in ranges])
        q = side.at[np.concatenate([_expand(a, b - a) for a, b in ranges])]
        if not len(p):
            return
        row, it = np.searchsorted(words.first, p, "right") - 1, self.row[q]
        most = np.minimum(words.first[row + 1] - p, self.words.first[it + 1] - q)
        length = self._lengths(sums, p, q, most)
        q = q - self.words.first[it]
        order = np.lexsort((it, row))
        p, q, row, it, length = (x[order] for x in (p, q, row, it, length))
        cut = np.flatnonzero(np.diff(row) | np.diff(it)) + 1
        for a, b in zip(np.append(0, cut), np.append(cut, len(row))):
            size = int(self.size[it[a]])
            step = np.bincount(q[a:b], minlength=size + 1) - np.bincount(q[a:b] + length[a:b], minlength=size + 1)
            if (np.cumsum(step)[:size] > 0).sum() >= threshold * size:
                covered, tiles = tile(length[a:b], p[a:b], q[a:b], width, size)
                yield int(row[a]), int(it[a]), covered, tiles, size


def _blocks(benchmark: DataFrame):
    """Benchmark items in blocks of bounded size, one after the other through the driver."""
    ids, texts, n = [], [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        text = r["text"] or ""
        size = len(text.split())
        if ids and n + size > BLOCK_WORDS:
            yield ids, texts
            ids, texts, n = [], [], 0
        ids.append(r["item_id"])
        texts.append(text)
        n += size
    if ids:
        yield ids, texts


def _match(seeds_of, threshold: float, schema: pa.Schema):
    def run(batches):
        seeds = Seeds(*seeds_of.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = [
                    (part.column("doc_id")[r].as_py(), seeds.ids[i], size, covered, tiles, covered / size)
                    for r, i, covered, tiles, size in seeds.matches(part.column("text"), threshold)
                    if covered >= threshold * size
                ]
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _clean(seeds_of, threshold: float):
    """Tasks that pass on the rows whose text holds none of the items."""

    def run(batches):
        seeds = Seeds(*seeds_of.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                keep = np.ones(part.num_rows, bool)
                for r, _, covered, _, size in seeds.matches(part.column("text"), threshold):
                    if covered >= threshold * size:
                        keep[r] = False
                yield part.filter(pa.array(keep))

    return tidy(run)


def without_items(
    docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, min_match: int = MIN_MATCH
) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no item.

    Each row is judged by its own text, also where ids are null or repeated.
    """
    sent_of = docs.sparkSession.sparkContext.broadcast
    for ids, texts in _blocks(benchmark):
        docs = docs.mapInArrow(_clean(sent_of((ids, texts, min_match)), threshold), docs.schema)
    return docs


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, min_match: int = MIN_MATCH
) -> DataFrame:
    """(doc_id, item_id, item_words, covered, tiles, coverage) of documents that hold an item."""
    spark = docs.sparkSession
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()),
         ("covered", pa.int64()), ("tiles", pa.int64()), ("coverage", pa.float64())]
    )
    ddl = "doc_id long, item_id long, item_words long, covered long, tiles long, coverage double"
    out = None
    for ids, texts in _blocks(benchmark):
        sent = spark.sparkContext.broadcast((ids, texts, min_match))
        part = docs.select("doc_id", "text").mapInArrow(_match(sent, threshold, schema), ddl)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], ddl) if out is None else out
