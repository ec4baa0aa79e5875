"""Operator 1: vector bin packing of tokenised examples by a dot-product heuristic.

A bin (sequence) has three limits: tokens, segments and loss-bearing tokens. Every task packs the
examples it reads. An example longer than a sequence first fills whole sequences; what remains of
it waits in a class of like demands. An open bin takes, again and again, the waiting example whose
demand vector has the largest dot product with the bin's remaining capacity (both as shares of the
limits) among those that fit; if none fits, the bin is filled up with a cut of a longer one. What
a task can't fill is sent on: last bins of many tasks are packed together in rounds, so padding
doesn't grow with the number of tasks. Each id lies in exactly one piece.

Defined results: a null or empty text gives one token, the end id. Rows are examples each on its
own, repeated or not; a null id is kept. Loss-bearing tokens are those of the whole example unless
a column counts them; then the example's last tokens bear the loss (a prompt comes first), and a
cut divides them accordingly. Sequences are numbered by task, then by bin; an empty table gives none.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import stored, tidy

END_ID = 2
#: Distinct words kept in a task's table of ids; the frequent ones come first, others are not kept.
WORDS_KEPT = 300_000
#: Tokens of waiting examples at which a task closes bins, so that memory stays bounded.
WAITING_TOKENS = 4_000_000
#: Bytes of text, and rows, tokenised at a time.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 2500
#: Tasks whose last bins are packed together in a round.
FAN_IN = 64


class Limits(NamedTuple):
    tokens: int = 4096
    segments: int = 512
    loss: int = 4096


class Piece(NamedTuple):
    """Part of an example: ``row`` tells which, ``loss_from`` where its loss-bearing part starts."""

    row: int
    start: int
    length: int
    loss_from: int

    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.loss_from))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(length=n), self._replace(start=self.start + n, length=self.length - n)


class Packer:
    """Packs pieces into bins; ``bins`` has the closed ones, each a list of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.bins: list[list[Piece]] = []
        self.waiting: dict[tuple[int, int], list[Piece]] = {}  # by (tokens, loss) class
        self.tokens = 0

    def add(self, piece: Piece) -> None:
        most = min(self.limits.tokens, self.limits.loss)
        while piece.length >= most:
            part, piece = piece.cut(most)
            self.bins.append([part])
        if piece.length:
            self.wait(piece)

    def wait(self, piece: Piece) -> None:
        # classes are exact for short pieces and about 3 % wide for long ones
        wide = lambda n: n if n < 64 else n >> (s := n.bit_length() - 6) << s
        self.waiting.setdefault((wide(piece.length), wide(piece.loss())), []).append(piece)
        self.tokens += piece.length

    def take(self, key) -> Piece:
        group = self.waiting[key]
        piece = group.pop()
        if not group:
            del self.waiting[key]
        self.tokens -= piece.length
        return piece

    def close_bins(self, leave: int) -> None:
        """Close full bins until at most ``leave`` tokens wait."""
        tokens, segments, loss = self.limits
        while self.tokens > leave:
            room = np.array(self.limits, float)
            chosen: list[Piece] = []
            keys = np.array(sorted(self.waiting), float)
            while room[0] > 0 and room[1] > 0 and len(keys):
                fits = (keys[:, 0] <= room[0]) & (keys[:, 1] <= room[2])
                demand = keys / (tokens, loss)
                score = demand @ (room[[0, 2]] / (tokens, loss)) + room[1] / segments / segments
                score[~fits] = -1
                k = int(score.argmax())
                if score[k] < 0:
                    # nothing fits: cut the longest, which leaves the fewest pieces
                    k = int(keys[:, 0].argmax())
                key = tuple(int(x) for x in keys[k])
                piece = self.take(key)
                if piece.length > room[0] or piece.loss() > room[2]:
                    n = int(min(piece.length, room[0]))
                    if piece.start + n - max(piece.start, piece.loss_from) > room[2]:
                        n = int(max(piece.start, piece.loss_from) + room[2] - piece.start)
                    if n <= 0:  # no loss-bearing token may follow
                        self.wait(piece)
                        break
                    piece, rest = piece.cut(n)
                    self.wait(rest)
                    rest_key = True
                else:
                    rest_key = False
                chosen.append(piece)
                room -= (piece.length, 1, piece.loss())
                if rest_key or key not in self.waiting:
                    keys = np.array(sorted(self.waiting), float)
            self.bins.append(chosen)

    def finish(self) -> list[Piece]:
        """Close all full bins; returns the pieces of the last, unfilled one."""
        self.close_bins(min(self.limits.tokens, self.limits.loss) - 1)
        return [p for key in sorted(self.waiting) for p in self.waiting[key]]


_CACHE: dict = {}
_MARKS = pa.array([".", ","])
#: A closing mark after a letter, which the tokenizer always cuts off.
_CLOSED = r"[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}][.,]$"


def _encode(tokenizer, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' ids one after the other, and how many each word has."""
    ids, size = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for at in range(0, len(words), 20_000):
        part = words.slice(at, 20_000).to_pylist()
        got = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        size.append(np.fromiter(map(len, got), np.int64, len(got)))
        ids.append(np.fromiter(chain.from_iterable(got), np.uint32, int(size[-1].sum())))
    return np.concatenate(ids), np.concatenate(size)


def _runs(ids: np.ndarray, size: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` that ``rows`` name, one after the other, and where each ends."""
    n = size[rows]
    ends = np.cumsum(n)
    begin = (np.cumsum(size) - size)[rows]
    return ids[np.arange(n.sum()) + np.repeat(begin - (ends - n), n)], ends


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text and row offsets, by way of the texts' distinct words.

    The tokenizer splits at white space and never looks across it, so a text's ids are its words'.
    A-Z is lower-cased first, as the tokenizer does, except next to a special token's ``<|``.
    Only stems that no earlier slice of the task has kept are handed to the tokenizer, and only
    they become Python strings.
    """
    import pyarrow.compute as pc
    from tokenizers import Tokenizer

    if _CACHE.get("path") != path:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores already
        tokenizer = Tokenizer.from_file(path)
        _CACHE.clear()
        _CACHE.update(path=path, tokenizer=tokenizer, marks=_encode(tokenizer, _MARKS))
        _CACHE["known"] = pa.array([], pa.string()), *_encode(tokenizer, pa.array([], pa.string()))
    tokenizer, (known, known_ids, known_size) = _CACHE["tokenizer"], _CACHE["known"]
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
    words = lists.flatten().dictionary_encode()
    distinct = words.dictionary
    folded = pc.if_else(pc.match_substring(distinct, "<|"), distinct, pc.ascii_lower(distinct))
    closed = pc.match_substring_regex(folded, _CLOSED)
    stems = pc.if_else(closed, pc.utf8_slice_codeunits(folded, 0, -1), folded).dictionary_encode()
    marks = pc.if_else(closed, pc.if_else(pc.ends_with(folded, "."), 0, 1), 2)

    # rows of one table: known stems, new ones, the two marks, nothing
    row = pc.index_in(stems.dictionary, value_set=known)
    new = stems.dictionary.filter(row.is_null())
    new_ids, new_size = _encode(tokenizer, new)
    rows = row.fill_null(0).to_numpy().astype(np.int64)
    rows[row.is_null().to_numpy(zero_copy_only=False)] = len(known) + np.arange(len(new))
    ids = np.concatenate([known_ids, new_ids, _CACHE["marks"][0]])
    size = np.concatenate([known_size, new_size, _CACHE["marks"][1], [0]])
    both = np.empty((len(distinct), 2), np.int64)
    both[:, 0] = rows[stems.indices.to_numpy()]
    both[:, 1] = len(known) + len(new) + marks.to_numpy()
    if keep := min(len(new), WORDS_KEPT - len(known)):
        end = len(known_ids) + int(new_size[:keep].sum())
        _CACHE["known"] = (
            pa.concat_arrays([known, new.slice(0, keep)]), ids[:end].copy(), size[: len(known) + keep].copy()
        )

    flat, ends = _runs(ids, size, both.ravel())
    flat, ends = _runs(flat, np.diff(ends[1::2], prepend=0), words.indices.to_numpy().astype(np.int64))
    last = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return flat, np.concatenate([[0], np.concatenate([[0], ends])[last]])


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss", pa.int64()),
     ("ids", pa.binary()), ("group", pa.int64())]
)
_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, loss long, ids binary, group long"
)


class _Rows:
    """Output rows; pieces of the last bin carry their ids on, the others only their checksum."""

    def __init__(self):
        self.rows: list[tuple] = []

    def bins(self, bins, ids_of, doc_of, number):
        for pieces in bins:
            offset = 0
            for p in pieces:
                data = ids_of(p)
                doc, tokens = doc_of(p)
                self.rows.append(
                    (doc, p.start, p.length, zlib.crc32(data), tokens, number(), offset, p.loss(), None, None)
                )
                offset += p.length
            number(True)

    def last(self, pieces, ids_of, doc_of, group):
        for p in pieces:
            doc, tokens = doc_of(p)
            self.rows.append(
                (doc, p.start, p.length, None, tokens, None, None, p.loss_from, ids_of(p), group)
            )

    def batch(self):
        columns = list(zip(*self.rows)) or [[]] * len(_OUT)
        self.rows = []
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _OUT)], schema=_OUT)


def _numbers(base: int):
    count = [base]

    def number(step: bool = False) -> int:
        count[0] += step
        return count[0]

    return number


def _first_round(path: str, limits: Limits, keep_ids: bool):
    def run(batches):
        partition = TaskContext.get().partitionId()
        packer, rows, number = Packer(limits), _Rows(), _numbers(partition << 32)
        docs: dict[int, tuple] = {}  # row: doc id, tokens, ids; gone when the row is placed
        count = 0

        def ids_of(p):
            return docs[p.row][2][p.start * 4 : (p.start + p.length) * 4]

        def doc_of(p):
            return docs[p.row][:2]

        def flush():
            rows.bins(packer.bins, ids_of, doc_of, number)
            packer.bins = []
            waiting = {p.row for group in packer.waiting.values() for p in group}
            for row in docs.keys() - waiting:
                del docs[row]

        for batch in batches:
            for part in _slices(batch):
                ids, offsets = token_ids(part.column("text"), path)
                doc_ids, loss = part.column("doc_id").to_pylist(), part.column("loss").to_pylist()
                for k, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    n = hi - lo + 1
                    data = ids[lo:hi].tobytes() + END_ID.to_bytes(4, "little")
                    docs[count] = (doc_ids[k], n, data)
                    borne = n if loss[k] is None else max(0, min(n, loss[k]))
                    packer.add(Piece(count, 0, n, n - borne))
                    count += 1
                if packer.tokens > WAITING_TOKENS:
                    packer.close_bins(WAITING_TOKENS // 2)
                flush()
                if rows.rows:
                    yield rows.batch()
        last = packer.finish()
        flush()
        rows.last(last, ids_of, doc_of, partition)
        yield rows.batch()
        _CACHE.clear()

    return tidy(run)


def _slices(batch: pa.RecordBatch):
    """Parts of a batch that are bounded in bytes of text and in rows; one row at least."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = int(np.searchsorted(ends, before + SLICE_BYTES, "right"))
        stop = min(max(at + 1, stop), at + SLICE_ROWS, batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


def _next_round(limits: Limits, base: int, final: bool):
    """Packs last bins of several tasks together; in the final round the last bin is closed too."""

    def run(key, batches):
        group = key[0].as_py()
        packer, rows, number = Packer(limits), _Rows(), _numbers(base + (group << 32))
        table = pa.Table.from_batches(batches) if not isinstance(batches, pa.Table) else batches
        got = sorted(
            zip(*(table[c].to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "loss", "ids"))),
            key=lambda r: (r[0] is None, r[0] or 0, r[1], r[5]),
        )
        for k, r in enumerate(got):
            packer.add(Piece(k, r[1], r[2], r[4]))
        last = packer.finish()

        def ids_of(p):
            skip = p.start - got[p.row][1]
            return got[p.row][5][skip * 4 : (skip + p.length) * 4]

        def doc_of(p):
            return got[p.row][0], got[p.row][3]

        rows.bins(packer.bins, ids_of, doc_of, number)
        if final and last:
            rows.bins([last[i : i + limits.segments] for i in range(0, len(last), limits.segments)], ids_of, doc_of, number)
        else:
            rows.last(last, ids_of, doc_of, group // FAN_IN)
        return pa.Table.from_batches([rows.batch()], _OUT)

    return run


def pack(
    docs: DataFrame, path: str, limits: Limits = Limits(), loss: str | None = None
) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and loss, the piece's loss-bearing tokens."""
    borne = F.col(loss).cast("long") if loss else F.lit(None).cast("long")
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), borne.alias("loss")
    )
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss"]
    first = stored(source.mapInArrow(_first_round(path, limits, False), _DDL), "packing")
    done = first.where("sequence_id is not null").select(*out)
    rest = first.where("sequence_id is null")
    top = rest.agg(F.max("group")).collect()[0][0]
    level = 1
    while top is not None:
        final = top < FAN_IN
        packed = rest.withColumn("group", F.floor(F.col("group") / FAN_IN).cast("long"))
        packed = packed.groupBy("group").applyInArrow(_next_round(limits, level << 58, final), _DDL)
        packed = stored(packed, "packing")
        done = done.union(packed.where("sequence_id is not null").select(*out))
        rest = packed.where("sequence_id is null")
        top = None if final else rest.agg(F.max("group")).collect()[0][0]
        level += 1
    return done
