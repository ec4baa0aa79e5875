"""Operator 3: exact substring deduplication by fixed-block anchors.

A window is ``window`` consecutive words. Reference blocks are the non-overlapping blocks of
``window // 2`` words of every text; any window contains a whole one. Every text is probed with its
rolling blocks. A block hash found at two places, one of them a reference block, is an anchor. Only
windows that contain an anchor are extended to their full length and looked up by the hash of all
their words; the earliest place of each keeps its words, and at all others runs of such windows
form the maximal repeats whose words are removed.

Texts are dealt into chunks of bounded size by a hash of id and text, so one id or missing ids may
hold many rows. A chunk sends each distinct hash
once, packed in five bytes, to the bucket of its leading bits, however often a passage occurs, so
a passage shared by a third of all rows weighs no more than any other; buckets answer with the
anchors of each chunk, and in the second round with one bit per hash sent. No pairs are formed.

Defined results: a word is removed if a window that covers it also starts earlier in the input, at
a smaller id, or in the same document before. A null id counts as the smallest. Rows with the same
id are one place: copies under one id, at the same start, don't remove each other. Null, empty and
blank texts have no words; texts shorter than a window lose none. Extra columns are passed on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from footfall.llm.common import Words, in_chunks, n_chunks, stored, tidy_group, windows, words_of

CHUNK_BYTES = 5 << 20
#: Bits of a block hash after those of its bucket; two bits of the five bytes are flags.
REST = 38
_SENT = "bucket long, chunk long, data binary"
_NO_ID = -(2**63)


def pack5(values: np.ndarray) -> bytes:
    """Five bytes of each value below 2**40."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack5(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").ravel()


def _by_bucket(keys: np.ndarray, rest: int, n: int):
    """(bucket, slice) of sorted keys."""
    cuts = np.searchsorted(keys, np.arange(n, dtype=np.uint64) << np.uint64(rest))
    cuts = np.append(cuts, len(keys))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(cuts[b], cuts[b + 1])


def block_keys(words: Words, block: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling block hashes cut to bucket and rest bits, and whether each lies in one text."""
    rolled, whole = windows(words, block)
    return rolled >> np.uint64(64 - bits - REST), whole


def _send_blocks(block: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        words = words_of(table["text"])
        keys, whole = block_keys(words, block, bits)
        begin = np.repeat(words.first[:-1], np.diff(words.first))
        aligned = (np.arange(len(keys)) - begin) % block == 0
        use = np.flatnonzero(whole)
        order = use[np.argsort(keys[use])]
        new = np.ones(len(order), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        at = np.flatnonzero(new)
        distinct = keys[order][at]
        fixed = np.logical_or.reduceat(aligned[order], at) if len(at) else np.zeros(0, bool)
        twice = np.diff(np.append(at, len(order))) > 1
        rest = distinct & np.uint64((1 << REST) - 1)
        coded = rest << np.uint64(2) | fixed.astype(np.uint64) << np.uint64(1) | twice.astype(np.uint64)
        rows = [(b, pack5(coded[s])) for b, s in _by_bucket(distinct, REST, 1 << bits)]
        return _rows([r[0] for r in rows], table["chunk"][0].as_py(), [r[1] for r in rows])

    return run


def _rows(buckets: list, chunk: int, data: list) -> pa.Table:
    return pa.table(
        [pa.array(buckets, pa.int64()), pa.array([chunk] * len(buckets), pa.int64()), pa.array(data, pa.binary())],
        ["bucket", "chunk", "data"],
    )


def _joined(table: pa.Table, read):
    """Decoded arrays of all rows in the order of chunks, and where each row's part ends."""
    rows = sorted(zip(table["chunk"].to_pylist(), table["data"].to_pylist()))
    parts = [read(d) for _, d in rows]
    return [c for c, _ in rows], parts, np.cumsum([len(p) for p in parts])


def _find_anchors(table: pa.Table) -> pa.Table:
    """Per chunk, those of its block hashes that are a reference block and occur elsewhere."""
    chunks, parts, ends = _joined(table, unpack5)
    coded = np.concatenate(parts)
    order = np.argsort(coded >> np.uint64(2), kind="stable")
    keys = coded[order] >> np.uint64(2)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    flags = np.bitwise_or.reduceat(coded[order] & np.uint64(3), at)
    n = np.diff(np.append(at, len(keys)))
    anchor = (flags >= 2) & ((n > 1) | (flags & np.uint64(1) == 1))
    hit = np.zeros(len(coded), bool)
    hit[order] = np.repeat(anchor, n)
    out = [pack5(p[h] >> np.uint64(2)) for p, h in zip(parts, np.split(hit, ends[:-1]))]
    kept = [(c, d) for c, d in zip(chunks, out) if d]
    bucket = table["bucket"][0].as_py()
    return pa.table(
        [pa.array([bucket] * len(kept), pa.int64()), pa.array([c for c, _ in kept], pa.int64()),
         pa.array([d for _, d in kept], pa.binary())], ["bucket", "chunk", "data"])


class Candidates:
    """Windows of one chunk that contain an anchor, each distinct one with its earliest place."""

    def __init__(self, docs: pa.Table, answers: pa.Table, window: int, bits: int):
        self.words = words = words_of(docs["text"])
        ids = docs["doc_id"].combine_chunks().cast(pa.int64()).fill_null(_NO_ID).to_numpy()
        block = window // 2
        anchors = [
            unpack5(d) | np.uint64(b << REST)
            for b, k, d in zip(answers["bucket"].to_pylist(), answers["kind"].to_pylist(), answers["data"].to_pylist())
            if k == 0
        ]
        anchors = np.sort(np.concatenate(anchors)) if anchors else np.zeros(0, np.uint64)
        keys, whole = block_keys(words, block, bits)
        total = len(keys)
        found = np.zeros(total + 1, np.int64)
        if len(anchors) and total:
            at = np.minimum(np.searchsorted(anchors, keys), len(anchors) - 1)
            found[1:] = np.cumsum((anchors[at] == keys) & whole)
        hashes, whole = windows(words, window)
        last = np.minimum(np.arange(total) + window - block + 1, total)
        self.at = np.flatnonzero(whole & (found[last] > found[:total]))
        row = np.searchsorted(words.first, self.at, "right") - 1
        self.doc, self.start = ids[row], self.at - words.first[row]
        order = np.lexsort((self.start, self.doc, hashes[self.at]))
        hashes = hashes[self.at][order]
        new = np.ones(len(order), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        head = np.flatnonzero(new)
        self.distinct, self.head = hashes[head], order[head]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.later = (self.doc != self.doc[self.head][self.group]) | (self.start != self.start[self.head][self.group])

    def sent(self, bits: int):
        """(bucket, slice of the distinct windows)"""
        return _by_bucket(self.distinct, 64 - bits, 1 << bits)


_PLACE = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("start", "<i4")])


def _send_windows(window: int, bits: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return _rows([], 0, [])
        c = Candidates(docs, answers, window, bits)
        place = np.empty(len(c.distinct), _PLACE)
        place["hash"], place["doc"], place["start"] = c.distinct, c.doc[c.head], c.start[c.head]
        rows = [(b, place[s].tobytes()) for b, s in c.sent(bits)]
        return _rows([r[0] for r in rows], docs["chunk"][0].as_py(), [r[1] for r in rows])

    return run


def _find_first(table: pa.Table) -> pa.Table:
    """Per chunk, one bit for each window it sent: set if the window also starts earlier."""
    chunks, parts, ends = _joined(table, lambda d: np.frombuffer(d, _PLACE))
    place = np.concatenate(parts)
    order = np.lexsort((place["start"], place["doc"], place["hash"]))
    p = place[order]
    new = np.ones(len(p), bool)
    new[1:] = p["hash"][1:] != p["hash"][:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.zeros(len(p), bool)
    later[order] = (p["doc"] != p["doc"][head]) | (p["start"] != p["start"][head])
    bits = [np.packbits(b).tobytes() for b in np.split(later, ends[:-1])]
    return pa.table(
        [pa.array([table["bucket"][0].as_py()] * len(chunks), pa.int64()), pa.array(chunks, pa.int64()),
         pa.array(bits, pa.binary())], ["bucket", "chunk", "data"])


def removed_words(docs: pa.Table, answers: pa.Table, window: int, bits: int) -> tuple[Words, np.ndarray]:
    c = Candidates(docs, answers, window, bits)
    later = np.zeros(len(c.distinct), bool)
    said = {
        b: d
        for b, k, d in zip(answers["bucket"].to_pylist(), answers["kind"].to_pylist(), answers["data"].to_pylist())
        if k == 1
    }
    for b, s in c.sent(bits):
        later[s] = np.unpackbits(np.frombuffer(said[b], np.uint8), count=s.stop - s.start)
    repeat = c.later | later[c.group] if len(c.at) else np.zeros(0, bool)
    step = np.zeros(len(c.words.hash) + 1, np.int64)
    step[c.at[repeat]] += 1
    np.subtract.at(step, c.at[repeat] + window, 1)
    return c.words, np.cumsum(step)[:-1] > 0


def _finish(window: int, bits: int, names: list[str], with_text: bool, schema: pa.Schema):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        words, gone = removed_words(docs, answers, window, bits)
        n, lost, digest, texts = [], [], [], []
        data = words.data.tobytes()
        texts_in = docs["text"].combine_chunks()
        for r, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
            own = gone[a:b]
            keep = np.flatnonzero(~own) + a
            n.append(b - a)
            lost.append(int(own.sum()))
            text = b" ".join([data[s:e] for s, e in zip(words.start[keep].tolist(), words.end[keep].tolist())])
            digest.append(hashlib.sha256(text).hexdigest())
            if with_text:
                texts.append(_cut(data, words, own, a, b) if own.any() else texts_in[r].as_py())
        columns = [docs[c].combine_chunks() for c in names]
        if with_text:
            columns[names.index("text")] = pa.array(texts, pa.string())
        columns += [pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(digest, pa.string())]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _cut(data: bytes, words: Words, gone: np.ndarray, a: int, b: int) -> str:
    """The text without its removed words and the white space after each of them."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
    parts = []
    for lo, hi in zip(edges[::2], edges[1::2]):
        end = words.start[a + hi] if a + hi < b else words.end[a + hi - 1]
        parts.append(data[words.start[a + lo] : end])
    return b"".join(parts).decode().rstrip(" \t\n\v\f\r")


def remove_repeats(docs: DataFrame, window: int = 20, with_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, n_removed and kept_sha256 of each row.

    With ``with_text`` the text is given without the removed words.
    """
    if window < 2:
        raise ValueError("a window needs two words or more")
    names = docs.columns if with_text else ["doc_id"]
    source = docs.select(*(docs.columns if with_text else ["doc_id", "text"]))
    total = n_chunks(docs, "text", 1)
    n = max(1, -(-total // CHUNK_BYTES))
    bits = max(3, (total // 6_000_000).bit_length())  # about a million hashes in a bucket
    dealt = in_chunks(source, ["doc_id", "text"], n)
    slim = dealt.select("doc_id", "text", "chunk")
    blocks = slim.groupBy("chunk").applyInArrow(tidy_group(_send_blocks(window // 2, bits)), _SENT)
    anchors = blocks.groupBy("bucket").applyInArrow(tidy_group(_find_anchors), _SENT)
    answers = stored(anchors.withColumn("kind", F.lit(0)), "anchors")
    places = (
        slim.groupBy("chunk").cogroup(answers.groupBy("chunk"))
        .applyInArrow(tidy_group(_send_windows(window, bits)), _SENT)
    )
    first = places.groupBy("bucket").applyInArrow(tidy_group(_find_first), _SENT).withColumn("kind", F.lit(1))
    answers = answers.unionByName(stored(first, "first-places"))
    fields = [docs.schema[c] for c in names]
    fields += [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    finish = _finish(window, bits, list(names), with_text, to_arrow_schema(out))
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(tidy_group(finish), out)
