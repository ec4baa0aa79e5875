"""Operator 6: near-duplicate documents by HyperMinHash.

A document's set holds the hashes of its distinct shingles of ``width`` words (A-Z lower-cased).
Its sketch has one register per bucket of shingle hashes: the leading-zero count of the smallest
hash in the bucket and the mantissa bits after it, 16 bits in all. Documents with equal sets form
one class, whose smallest id stands for it from then on, so exact copies cost nothing further.

Bands of registers (empty ones borrow, bucket by bucket, from another of the same sketch) deal the
representatives into groups. In each group the members are first compared with its smallest id
only. The compared pairs get a Jaccard estimate from their sketches, corrected for registers that
agree by chance. Those that may reach the threshold, with six standard errors to spare, are
confirmed on full sets and give links; those with an estimate of ``LOOSE`` or more tie families
together. Members refused by the smallest id are then compared, in blocks, with each other and with
all members of the group but those so close to the smallest id that what is similar to them is tied
to it as well; what may be a link ties families too. Within a family whose members aren't yet connected,
sketches of the members outside its largest component are compared with all others, in blocks of
bounded size. What may be a link is confirmed on full sets: in the block itself where both sets have
at most ``SMALL`` shingles, and otherwise by joins, the best of each first, until every such pair is
confirmed, refused, or connected otherwise. So a link is only lost where two similar sets share
no band: with 48 bands of 6 registers less than one in a million at the threshold itself.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; with
fewer words than a shingle has, the whole sequence is the one shingle. Rows with one id are one
node, a null id is linked with nothing, its component is null and it is kept. An empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import Words, _forest, components, mix, stored, tidy, windows, words_of

BUCKETS_LOG2 = 9
BUCKETS = 1 << BUCKETS_LOG2
MANTISSA = 10
BANDS, ROWS = 48, 6
LOOSE = 0.5
BLOCK = 256
#: Sets of at most so many shingles travel with the blocks; larger ones are fetched for their pairs.
SMALL = 512
#: Bits of the filter that keeps texts nobody asks for out of the shuffle; fixed, so bounded.
FILTER_BITS = 23
_BORROW = np.random.default_rng(11).permuted(
    np.tile(np.arange(BUCKETS, dtype=np.uint16), (BUCKETS, 1)), axis=1
)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each, and where each row starts."""
    rolled, whole = windows(words, width)
    row = words.rows()
    n = np.diff(words.first)
    rows, hashes = [row[whole]], [rolled[whole]]
    for k in range(1, width):
        short = np.flatnonzero(n == k)
        if len(short):
            rows.append(short)
            hashes.append(windows(words, k)[0][words.first[short]])
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[new], hashes[new]
    return hashes, np.searchsorted(rows, np.arange(len(n) + 1))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of each row."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def sketches(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of each set: (leading zeros + 1) and mantissa of the bucket's least hash; 0 empty."""
    g = mix(hashes ^ np.uint64(0xD6E8FEB86659FD93))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    slot = row * BUCKETS + (g >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)
    rest = (g << np.uint64(BUCKETS_LOG2)) | np.uint64(1 << (BUCKETS_LOG2 - 1))
    least = np.full((len(first) - 1) * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    used = np.zeros(len(least), bool)
    order = np.lexsort((rest, slot))
    head = np.ones(len(order), bool)
    head[1:] = slot[order][1:] != slot[order][:-1]
    at = order[head]
    least[slot[at]] = rest[at]
    used[slot[at]] = True
    top = least >> np.uint64(11)  # 53 bits are exact in a double
    zeros = (53 - np.frexp(top.astype(np.float64))[1]).astype(np.uint64)
    zeros = np.minimum(zeros, np.uint64(53))
    mantissa = (least << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    code = ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    code[~used] = 0
    return code.reshape(-1, BUCKETS)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One key per band of a sketch with at least one register in use."""
    used = np.flatnonzero(sketch)
    full = sketch
    if len(used) < BUCKETS:
        empty = np.flatnonzero(sketch[: BANDS * ROWS] == 0)
        full = sketch.copy()
        full[empty] = sketch[used[_BORROW[empty][:, used].argmin(1)]]
    codes = full[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + codes[:, k])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a, n_b, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates along the last axis, corrected for chance agreement, and their error.

    The error is that of a pair at or above the threshold, as far as it may hide one. The registers
    in use then sample, without replacement, a union of known largest size, so small sets have
    little of it.
    """
    either = ((a | b) != 0).sum(-1)
    same = ((a == b) & (a != 0)).sum(-1)
    ratio = np.maximum(n_a, n_b) / np.maximum(1, np.minimum(n_a, n_b))
    chance = 0.169919487 * 2.0 ** (BUCKETS_LOG2 - MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    chance = np.minimum(chance, either - same)
    m = np.maximum(1, either)
    union = (n_a + n_b) / (1 + threshold)
    unseen = np.clip((union - m) / np.maximum(1, union - 1), 0, 1)
    spread = max(threshold, 0.5) * (1 - max(threshold, 0.5))
    return np.maximum(0, same - chance) / m, np.sqrt(spread / m * unseen) + chance / m


_SKETCHED = "doc_id long, n_shingles long, key1 long, key2 long, sketch binary"


def _sketch(width: int):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                hashes, first = shingle_sets(words_of(part.column("text"), fold=True), width)
                keys = [row_sums(mix(hashes ^ np.uint64(c)), first).view(np.int64) for c in (3, 5)]
                regs = sketches(hashes, first)
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(np.diff(first)), *map(pa.array, keys),
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    ["doc_id", "n_shingles", "key1", "key2", "sketch"],
                )

    return run


def _bands(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            keys = [band_keys(np.frombuffer(s.as_buffer(), np.uint16)) for s in part.column("sketch")]
            ids = part.column("doc_id").to_numpy()
            if keys:
                yield pa.record_batch(
                    [pa.array(np.concatenate(keys)), pa.array(np.repeat(ids, BANDS))], ["band", "id"]
                )


def _estimates(threshold: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            read = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            sizes = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            value, error = estimate(read("sketch_a"), read("sketch_b"), *sizes, threshold)
            yield pa.record_batch(
                [batch.column("a"), batch.column("b"), pa.array(value), pa.array(error)], ["a", "b", "estimate", "error"]
            )

    return run


_PAIRS = "a long, b long, estimate double, error double"


def _with(pairs: DataFrame, side: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with the columns of both ends, as ``<column>_a`` and ``<column>_b``."""
    for end in "ab":
        named = side.select(F.col("doc_id").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = pairs.join(named, end)
    return pairs


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two sets, each of distinct hashes, reach the threshold."""
    same = len(a) + len(b) - len(np.union1d(a, b)) if len(a) and len(b) else 0
    return 100 * same >= round(100 * threshold) * (len(a) + len(b) - same) and same > 0


def _compare(threshold: float):
    """Keeps the pairs whose full sets reach the threshold."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                keep.append(similar(a, b, threshold))
            part = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if part.num_rows:
                yield part

    return run


def _full_sets(width: int, wanted):
    def run(batches):
        bits = wanted.value
        for batch in batches:
            at = mix(batch.column("doc_id").to_numpy().astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)
            batch = batch.filter(pa.array(bits[at.astype(np.int64)]))
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                hashes, first = shingle_sets(words_of(part.column("text"), fold=True), width)
                sets = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.record_batch([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "set"])

    return run


def _slots(batches):
    seen = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        at = mix(batch.column("id").to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)
        seen[at.astype(np.int64)] = True
    yield pa.record_batch([pa.array([np.packbits(seen).tobytes()], pa.binary())], ["bits"])


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame | None:
    """(doc_id, set) of at least the ``ids`` (id) asked for, None if there are none.

    A bit filter of fixed size keeps other texts from being hashed and shuffled; where it fills up
    at large scale it only saves less.
    """
    spark = docs.sparkSession
    bits = np.zeros(1 << FILTER_BITS, bool)
    for r in ids.coalesce(8).mapInArrow(_slots, "bits binary").collect():
        bits |= np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    if not bits.any():
        return None
    wanted = spark.sparkContext.broadcast(bits)
    texts = docs.where("doc_id is not null").select("doc_id", "text")
    return texts.mapInArrow(tidy(_full_sets(width, wanted)), "doc_id long, set binary")


def confirm(docs: DataFrame, pairs: DataFrame, width: int, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are similar enough; each text is read, few are shuffled."""
    sets = sets_of(docs, pairs.select("a").union(pairs.select("b")).withColumnRenamed("a", "id"), width)
    if sets is None:
        return pairs.select("a", "b").limit(0)
    both = _with(pairs.select("a", "b"), sets, ["set"])
    return both.select("a", "b", "set_a", "set_b").mapInArrow(tidy(_compare(threshold)), "a long, b long").distinct()


def _pack_block(group: pa.Table) -> pa.Table:
    ids = group["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    take = lambda c: group[c].to_numpy()[order]
    sketch = b"".join(group["sketch"].take(pa.array(order)).to_pylist())
    columns = [take("doc_id"), take("label"), take("n_shingles")]
    sets = [s or b"" for s in group["set"].take(pa.array(order)).to_pylist()]
    columns.append(np.array([len(s) // 8 for s in sets]))
    row = [[group["family"][0].as_py()], [group["block"][0].as_py()], *([c.astype(np.int64).tobytes()] for c in columns)]
    row += [[b"".join(sets)], [sketch]]
    kinds = [pa.int64(), pa.int64()] + [pa.binary()] * len(_IN_BLOCK)
    return pa.table([pa.array(x, k) for x, k in zip(row, kinds)], ["family", "block", *_IN_BLOCK])


_IN_BLOCK = {"ids": np.int64, "labels": np.int64, "sizes": np.int64, "held": np.int64, "sets": np.uint64, "sketches": np.uint16}
_BLOCKS = "family long, block long, " + ", ".join(f"{c} binary" for c in _IN_BLOCK)


def _block_pairs(threshold: float):
    """Pairs that may be links; those of two sets at hand are compared in full and ``sure``."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                a, b = ({c: np.frombuffer(r[f"{c}_{e}"], kind) for c, kind in _IN_BLOCK.items()} for e in "ab")
                left, right = a["sketches"].reshape(-1, BUCKETS), b["sketches"].reshape(-1, BUCKETS)
                sets_a, sets_b = (np.split(x["sets"], np.cumsum(x["held"])[:-1]) for x in (a, b))
                for i in range(len(left)):
                    value, error = estimate(left[i], right, a["sizes"][i], b["sizes"], threshold)
                    hit = np.flatnonzero((value + 6 * error >= threshold) & (b["labels"] != a["labels"][i]))
                    sure = (a["held"][i] > 0) & (b["held"][hit] > 0)
                    link = np.array([not s or similar(sets_a[i], sets_b[j], threshold) for j, s in zip(hit, sure)], bool)
                    hit, sure = hit[link], sure[link]
                    if len(hit):
                        yield pa.record_batch(
                            [pa.array(np.full(len(hit), a["ids"][i])), pa.array(b["ids"][hit]),
                             pa.array(value[hit]), pa.array(error[hit]), pa.array(sure)],
                            ["a", "b", "estimate", "error", "sure"])

    return run


def _unconnected(
    docs: DataFrame, sketched: DataFrame, families: DataFrame, labels: DataFrame, width: int, threshold: float
) -> DataFrame:
    """Pairs of one family in different components that are or may be links, from sketches in blocks."""
    f = families.select(F.col("id").alias("doc_id"), F.col("component").alias("family"))
    named = labels.select(F.col("id").alias("doc_id"), F.col("component").alias("label"))
    f = f.join(named, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    size = f.groupBy("family", "label").agg(F.count("*").alias("n"))
    largest = size.groupBy("family").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels"), F.sum("n").alias("members")
    )
    largest = largest.where("labels > 1")
    f = stored(f.join(largest, "family"), "open-families")
    sets = sets_of(docs, f.select(F.col("doc_id").alias("id")), width)
    if sets is None:
        sets = sketched.select("doc_id", F.lit(None).cast("binary").alias("set")).limit(0)
    sets = sets.where(F.octet_length("set") <= 8 * SMALL)
    members = stored(
        f.join(sets.dropDuplicates(["doc_id", "set"]), "doc_id", "left").join(sketched.select("doc_id", "n_shingles", "sketch"), "doc_id")
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("members") / BLOCK))),
        "families",
    )
    blocks = lambda m: m.groupBy("family", "block").applyInArrow(_pack_block, _BLOCKS)
    few, every = blocks(members.where("label != main")), blocks(members)
    ends = [
        d.select("family", *(F.col(c).alias(f"{c}_{e}") for c in _IN_BLOCK))
        for e, d in (("a", few), ("b", every))
    ]
    return (
        ends[0].join(ends[1], "family").drop("family").mapInArrow(tidy(_block_pairs(threshold)), _PAIRS + ", sure boolean")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "estimate", "error", "sure").distinct()
    )


def _is_maybe(threshold: float):
    return F.col("estimate") + 6 * F.col("error") >= threshold


_MEMBERS = "array<struct<id: long, n: long, refused: boolean, sketch: binary>>"


def _block_ties(threshold: float):
    """Stars that tie what may be a link, of the refused members of two blocks and all of the other."""

    def read(members):
        if not members.is_valid:
            return None
        m = members.values
        ids, n, refused = (m.field(c).to_numpy(zero_copy_only=False) for c in ("id", "n", "refused"))
        sketch = np.frombuffer(b"".join(m.field("sketch").to_pylist()), np.uint16).reshape(-1, BUCKETS)
        return ids, n, refused, sketch

    def ties(a, b):
        for i in np.flatnonzero(a[2]):
            value, error = estimate(a[3][i], b[3], a[1][i], b[1], threshold)
            hit = b[0][value + 6 * error >= threshold]
            hit = hit[hit != a[0][i]]
            if len(hit):
                yield pa.record_batch([pa.array(np.full(len(hit), a[0][i])), pa.array(hit)], ["a", "b"])

    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("own"), batch.column("other")):
                a, b = read(a), read(b)
                yield from _forest(ties(a, a) if b is None else ties(a, b))
                if b is not None:
                    yield from _forest(ties(b, a))

    return run


def _refused_ties(starred: DataFrame, judged: DataFrame, sketched: DataFrame, threshold: float) -> DataFrame:
    """(a, b) ties of group members (band, a, id) that their smallest id ``a`` didn't accept.

    A member that leaves is so like the smallest id that all that is similar to it is accepted there.
    """
    leaves = F.col("estimate") - 6 * F.col("error") >= LOOSE + 1 - threshold
    rows = starred.join(judged.withColumnRenamed("b", "id"), ["a", "id"])
    refused = (F.col("estimate") < LOOSE) & ~_is_maybe(threshold)
    rows = rows.select("band", "id", refused.alias("refused"), leaves.alias("leaves")).where("refused or not leaves")
    size = rows.groupBy("band").agg(F.max("refused").alias("any"), F.count("*").alias("n_members"))
    size = size.where("any and n_members > 1").drop("any")
    side = sketched.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch")
    rows = stored(rows.select("band", "id", "refused").join(size, "band"), "refused")
    rows = rows.join(side, "id").withColumn("blocks", F.ceil(F.col("n_members") / BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    blocks = rows.groupBy("band", "blocks", "block").agg(F.collect_list(F.struct("id", "n", "refused", "sketch")).alias("own"))
    blocks = stored(blocks, "refused-blocks")
    several = blocks.where("blocks > 1")
    other = several.select("band", F.col("block").alias("block_b"), F.col("own").alias("other"))
    across = several.join(other, "band").where("block < block_b").select("own", "other")
    every = blocks.select("own", F.lit(None).cast(_MEMBERS).alias("other")).union(across)
    return every.mapInArrow(tidy(_block_ties(threshold)), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = stored(docs.mapInArrow(tidy(_sketch(width)), _SKETCHED), "sketches")
    same = ["key1", "key2", "n_shingles"]
    usable = every.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("doc_id"))
    first = stored(usable.join(classes, ["doc_id", *same], "left_semi").dropDuplicates(["doc_id", *same]), "classes")

    banded = first.select("doc_id", "sketch").mapInArrow(tidy(_bands), "band long, id long")
    least = banded.groupBy("band").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    starred = stored(banded.join(least, "band").where("id != a"), "starred")
    stars = starred.select("a", F.col("id").alias("b")).distinct()
    judged = stored(
        _with(stars, first.withColumnRenamed("n_shingles", "n"), ["n", "sketch"])
        .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(tidy(_estimates(threshold)), _PAIRS),
        "judged",
    )
    pairs = judged.where((F.col("estimate") >= LOOSE) | _is_maybe(threshold))
    links = stored(confirm(docs, pairs.where(_is_maybe(threshold)), width, threshold), "links")
    labels = stored(components(links), "labels")
    ties = _refused_ties(starred, judged, first, threshold)
    families = components(pairs.select("a", "b").union(ties).union(_edges(labels)))
    order = Window.partitionBy("a").orderBy(F.desc("estimate"), "b")
    found = _unconnected(docs, first, families, labels, width, threshold).join(pairs, ["a", "b"], "left_anti")
    found = stored(found.select("a", "b", "sure", F.row_number().over(order).alias("k")), "open-pairs")
    links, open_pairs = found.where("sure").select("a", "b"), found.where("not sure").drop("sure")

    most = 4
    while True:
        if not links.isEmpty():
            labels = stored(components(links.union(_edges(labels))), "labels")
            named = labels.withColumnRenamed("id", "doc_id")
            left = _with(open_pairs, _all_labels(open_pairs, named), ["component"])
            open_pairs = stored(left.where("component_a != component_b").select("a", "b", "k"), "open-pairs")
        if open_pairs.isEmpty():
            break
        links = stored(confirm(docs, open_pairs.where(F.col("k") <= most), width, threshold), "links")
        open_pairs = open_pairs.where(F.col("k") > most)
        most *= 16

    member = classes.withColumnRenamed("doc_id", "class_id").join(
        labels.withColumnRenamed("id", "class_id"), "class_id", "left"
    )
    member = member.select(*same, F.coalesce("component", "class_id").alias("of_class"))
    # rows with one id are one node, so an id takes the least component of its sets
    out = every.drop("sketch").join(member, same, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("of_class")).otherwise(F.col("doc_id")))
    return out.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def _edges(labels: DataFrame) -> DataFrame:
    return labels.where("id != component").select(F.col("component").alias("a"), F.col("id").alias("b"))


def _all_labels(pairs: DataFrame, named: DataFrame) -> DataFrame:
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return ids.join(named, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))
