"""Operator 11: personal data by patterns and a linear-chain conditional random field.

Patterns give the base spans: email, ip, card and phone, leftmost and non-overlapping per kind. They
are searched from the places where a text has a digit or an @, so texts of any length and words of
any length take linear time. A match that fails its kind's check is dropped and not searched again,
which is how a pattern loses a phone number that runs on into an address, or two card numbers side
by side.

The field adds what patterns lose. Its tokens are the pieces of words that hold a digit or an @;
neighbours with nothing but spaces between them form a sequence, every other word is outside by
definition and bounds it. Features of a token are those of its word shape (letters and digits by
class, runs collapsed or not, number of digits, ends) and of its neighbours' shapes. The weights are
trained on the driver by gradient ascent on the likelihood (forward-backward), from a small labelled
table of at most ``MAX_LABELLED`` rows. Tasks decode all sequences of a batch at once by Viterbi. An
added span must pass its kind's check and must not touch a base span.

Defined results: a null text counts as empty and has no spans. Each row is judged on its own, also
with a repeated or null id; other columns are ignored. An empty table gives no rows. ``n_*`` and
``base_sha256`` tell of the base spans, ``spans`` lists all, by start, then kind in the order above.
Equally good paths of the field are decided by the order of the tags. Labelled rows whose text or
spans are null count as texts without spans; without labelled rows the field adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import text_bytes

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{b}-{kind}" for kind in KINDS for b in "BI"))
#: Most labelled rows that the field is trained on.
MAX_LABELLED = 5_000

# The patterns of the base spans.
LOCAL = "A-Za-z0-9._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The default labelled table, invented: <kind:text> marks a span.
LABELLED = """
Write to <email:ana.b@mail.example.com> before noon.
contact: <email:j_smith77@corp.example.org>, thanks
<email:info@shop.example.net> <email:sales@shop.example.net>
und <email:k.9@host3.example.com> <phone:+1 (212) 555-0147> bitte
The @ sign and @someone are not addresses.
server <ip:10.0.0.12> answered
from <ip:192.168.17.4> to <ip:172.16.254.1> in 12 ms
<ip:8.8.4.4> <ip:8.8.8.8>
on 203.0.113.999 or version 4.2.11 or 3.5.0.1.2 nothing
address <ip:198.51.100.77>.
card <card:4539578763621486> expires 11/27
<card:4539 5787 6362 1486> was charged 120.50
pay with <card:5425-2334-3010-9903> today
<card:4716258050958645> <card:5425233430109903>
from <card:4716258050958645> <phone:+1 (303) 555-0190> und
number <card:4716258050958645> <ip:10.12.14.200> in the log
<card:378282246310005> and <card:3782 822463 10005>
call <phone:+1 (415) 555-0132> or write
call <phone:+1 (415) 555-0132> <ip:190.17.23.204> de la
<phone:+1 (826) 555-0181> <phone:+1 (843) 555-0172> der
les <phone:+1 (843) 555-0172> <card:4716258050958645> est
<phone:+1 (487) 555-0109> <ip:17.106.147.18> <card:5425233430109903>
<ip:97.151.17.73> <phone:+1 (377) 555-0171> que
<phone:+44 20 7946 0958> is the desk
tel <phone:+49 30 901820114>, room 214
<phone:+33 1 70 18 99 00> <ip:81.2.69.142> and
phone <phone:(415) 555-0132> after 5
phone <phone:415-555-0132> after 17
phone <phone:212.555.0147> ext 12
<phone:212-555-0147> <ip:10.1.2.3> ok
<email:a.l@x.example.com> <ip:10.1.2.3> <phone:+1 (212) 555-0147> <card:4539578763621486>
Licensed under CC BY-NC 4.0. All rights
the GNU General Public License, version 3. and 2.
in 1998 and 2004 there were 1200 of 3500
on 2024-01-15 at 10:30 we met 14 people
pages 12 13 14 15 and 16
1 2 3 4 5 6 7 8 9
scores 10 20 30 40 50 60
2001 2002 2003 2004 2005
from 12.05.2021 to 14.06.2022 in room 7
order 20394857 and 99812 were late
token = 9b0b3c6a43eb78aa99cbd7049c572391524f37a8 in the file
token = 5d190bd7c06284de91015a36974748794293dd8a 2004 end
key 04dbebab91ab85687d33eeaaf9ac699e1188f962 10 x
build 20240115 of 3.11.2 took 1.5 s
ISBN 978-3-16-148410-0 in stock
sum 1.234.567 and 12.50 of 99.90
3.14159 and 2.71828 are constants
4.0 4.1 4.2
A4 B12 C3PO R2D2
mp3 h264 utf8 x86 64
10-20 30-40 pages
id 123456789 123456 7890
""".strip().splitlines()


# ---------------------------------------------------------------------------------------------
# base spans
# ---------------------------------------------------------------------------------------------


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def passes(kind: int, text: str) -> bool:
    """The check of a pattern's match."""
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))
    if kind == 2:
        d = [int(c) for c in reversed(_digits(text))]
        return 12 <= len(d) <= 19 and (sum(d[::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0
    return kind == 0 or 9 <= len(_digits(text)) <= 15


_BEFORE = re.compile(f"[^{LOCAL}]")


def _emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and not _BEFORE.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


_DIGIT, _DIGITS = re.compile("[0-9]"), re.compile("[0-9]+")


def _runs(pattern: re.Pattern, text: str):
    """Matches of a pattern that begins with digits; one that fails at a run fails within it."""
    m = _DIGIT.search(text)
    while m:
        if found := pattern.match(text, m.start()):
            yield found.span()
        end = found.end() if found else _DIGITS.match(text, m.start()).end()
        m = _DIGIT.search(text, end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    found += [(s, 1, e) for s, e in _runs(IP, text) if passes(1, text[s:e])]
    found += [(s, 2, e) for s, e in _runs(CARD, text) if passes(2, text[s:e])]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if passes(3, m.group())]
    return sorted(found)


def written(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# ---------------------------------------------------------------------------------------------
# tokens, sequences and features
# ---------------------------------------------------------------------------------------------

_HOT = re.compile("[0-9@]")
_PIECE = re.compile(r"[A-Za-z0-9._%+@()-]+")
_OUTSIDE = re.compile(r"[^A-Za-z0-9._%+@()-]")
_SHAPE = str.maketrans(
    dict.fromkeys("0123456789", "9")
    | dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a")
    | dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")
)
_LONGEST = 24  # letters of a shape that count as a feature


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens, each token as (start, end) without surrounding punctuation."""
    out: list[list[tuple[int, int]]] = []
    end = -1  # of the piece before, with its punctuation
    m = _HOT.search(text)
    while m:
        start = m.start()
        while start > max(end, 0) and not _OUTSIDE.match(text, start - 1):
            start -= 1
        stop = _PIECE.match(text, m.start()).end()
        lo, hi = start, stop
        while hi > lo and text[hi - 1] in "._%+-(":
            hi -= 1
        while lo < hi and text[lo] in "._%-)":
            lo += 1
        inner = text[lo:hi]
        if inner.endswith(")") and "(" not in inner:
            hi -= 1
        if inner.startswith("(") and ")" not in inner:
            lo += 1
        if out and end >= 0 and start - end <= 3 and hi > lo and text[end:start].strip(" \t") == "" and start > end:
            out[-1].append((lo, hi))
        elif hi > lo:
            out.append([(lo, hi)])
        end = stop if hi > lo else -1
        m = _HOT.search(text, stop)
    return out


@lru_cache(1 << 14)
def _shape(token: str) -> tuple[str, str, int]:
    shape = token[: 4 * _LONGEST].translate(_SHAPE)
    return shape[:_LONGEST], re.sub(r"(.)\1+", r"\1", shape)[:_LONGEST], min(20, shape.count("9"))


@lru_cache(1 << 15)
def features(token: str, before: str, after: str) -> tuple[str, ...]:
    """Features of a token; ``before`` and ``after`` are empty at the ends of a sequence."""
    shape, short, digits = _shape(token)
    out = ["bias", f"shape={shape}", f"short={short}", f"digits={digits}", f"head={shape[:2]}", f"tail={shape[-2:]}"]
    out += [f"has{c}={min(4, shape.count(c))}" for c in ".-@(+aA"]
    for side, other in (("before", before), ("after", after)):
        if other:
            near, brief, n = _shape(other)
            out += [f"{side}={near}", f"{side}.short={brief}", f"{side}.digits={n}"]
        else:
            out.append(f"{side}=none")
    return tuple(out)


def _windows(tokens: list[str]):
    return zip(tokens, ["", *tokens[:-1]], [*tokens[1:], ""])


# ---------------------------------------------------------------------------------------------
# the field
# ---------------------------------------------------------------------------------------------


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, names: dict[str, int]):
        n = len(TAGS)
        self.names = names
        self.weights = np.zeros((len(names) + 1, n))  # the last row stands for unknown features
        self.steps = np.zeros((n + 2, n))  # from tag to tag; then from the start; then to the end

    def scores(self, tokens: list[str]) -> np.ndarray:
        """Tag scores of each token of a sequence."""
        unknown = len(self.names)
        rows = [[self.names.get(f, unknown) for f in features(*w)] for w in _windows(tokens)]
        return np.array([self.weights[r].sum(0) for r in rows])

    def paths(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The best tags of each sequence: Viterbi, step by step over all sequences at once."""
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        longest = len(sequences[order[0]]) if order else 0
        sizes = np.array([len(sequences[i]) for i in order], np.int64)
        flat = [self.scores(sequences[i]) for i in order]
        n = len(TAGS)
        best, back = np.zeros((len(order), n)), []
        for t in range(longest):
            live = int(np.searchsorted(-sizes, -t))  # sequences with more than t tokens
            here = np.array([flat[i][t] for i in range(live)])
            if t == 0:
                best = here + self.steps[n]
            else:
                ways = best[:live, :, None] + self.steps[:n]
                back.append(ways.argmax(1))
                best = np.concatenate([ways.max(1) + here, best[live:]])
        tag = (best + self.steps[n + 1]).argmax(1) if longest else np.zeros(0, np.int64)
        out = [np.zeros(k, np.int64) for k in sizes]
        for t in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -t))
            for i in range(live):
                out[i][t] = tag[i]
            if t:
                tag[:live] = back[t - 1][np.arange(live), tag[:live]]
        return [path for _, path in sorted(zip(order, out), key=lambda x: x[0])]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def likelihood(field: Field, seqs: list[np.ndarray], tags: list[np.ndarray]):
    """Log likelihood of the tags, with its gradients in ``weights`` and ``steps``.

    ``seqs`` holds, per sequence, a matrix of feature rows (tokens x features).
    """
    n = len(TAGS)
    total, to_weights, to_steps = 0.0, np.zeros_like(field.weights), np.zeros_like(field.steps)
    by_length = groupby(sorted(range(len(seqs)), key=lambda i: len(seqs[i])), key=lambda i: len(seqs[i]))
    for length, own in by_length:
        own = list(own)
        x = np.array([seqs[i] for i in own])
        y = np.array([tags[i] for i in own])
        here = field.weights[x].sum(2)
        ahead = np.zeros((length, len(own), n))
        behind = np.zeros((length, len(own), n))
        ahead[0] = here[:, 0] + field.steps[n]
        for t in range(1, length):
            ahead[t] = here[:, t] + _log_sum(ahead[t - 1][:, :, None] + field.steps[:n], 1)
        behind[-1] = field.steps[n + 1]
        for t in range(length - 2, -1, -1):
            behind[t] = _log_sum(field.steps[:n] + (here[:, t + 1] + behind[t + 1])[:, None, :], 2)
        every = _log_sum(ahead[-1] + field.steps[n + 1], 1)
        one = np.eye(n)
        for t in range(length):
            gap = one[y[:, t]] - np.exp(ahead[t] + behind[t] - every[:, None])
            np.add.at(to_weights, x[:, t].ravel(), np.repeat(gap, x.shape[2], 0))
            if t == 0:
                to_steps[n] += gap.sum(0)
            if t == length - 1:
                to_steps[n + 1] += gap.sum(0)
            if t:
                both = ahead[t - 1][:, :, None] + field.steps[:n] + (here[:, t] + behind[t])[:, None, :]
                to_steps[:n] -= np.exp(both - every[:, None, None]).sum(0)
                np.add.at(to_steps, (y[:, t - 1], y[:, t]), 1)
        rows = np.arange(len(own))
        right = sum(here[rows, t, y[:, t]] for t in range(length)) + field.steps[n][y[:, 0]] + field.steps[n + 1][y[:, -1]]
        right = right + sum(field.steps[y[:, t - 1], y[:, t]] for t in range(1, length))
        total += float((right - every).sum())
    return total, to_weights, to_steps


def _tags(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(len(tokens), np.int64)
    for i, (lo, hi) in enumerate(tokens):
        for start, kind, end in spans:
            if start <= lo and hi <= end:
                first = i == 0 or tokens[i - 1][0] < start
                out[i] = 1 + 2 * kind + (not first)
    return out


def train(rows: list[tuple[str, str]], rounds: int = 150, rate: float = 0.3, decay: float = 0.01) -> Field:
    """The field of labelled (text, spans), spans written as in the results."""
    texts, seqs, tags = [], [], []
    for text, spans in rows:
        parsed = [s.split(":") for s in (spans or "").split(",") if s]
        own = [(int(s), KINDS.index(kind), int(e)) for kind, s, e in parsed]
        for tokens in sequences(text or ""):
            texts.append([text[lo:hi] for lo, hi in tokens])
            tags.append(_tags(tokens, own))
    found = [[features(*w) for w in _windows(tokens)] for tokens in texts]
    names = {f: k for k, f in enumerate(sorted({f for s in found for t in s for f in t}))}
    width = max((len(t) for s in found for t in s), default=0)
    unknown = len(names)
    for s in found:  # rows of equal width; the unknown feature's weight stays zero
        seqs.append(np.array([[names[f] for f in t] + [unknown] * (width - len(t)) for t in s]))
    field = Field(names)
    size = [np.zeros_like(field.weights), np.zeros_like(field.steps)]
    for _ in range(rounds if seqs else 0):
        _, *slopes = likelihood(field, seqs, tags)
        for k, (x, slope) in enumerate(zip((field.weights, field.steps), slopes)):
            slope -= decay * x
            size[k] += slope**2
            x += rate * slope / np.sqrt(size[k] + 1e-8)
        field.weights[unknown] = 0
    return field


# ---------------------------------------------------------------------------------------------
# spans of the field
# ---------------------------------------------------------------------------------------------

# An added span must look like its kind as a whole, and pass the check of the patterns.
_WHOLE = (
    re.compile(f"[{LOCAL}]+@{DOMAIN.pattern}"),
    IP,
    CARD,
    re.compile(r"\+[0-9][0-9().\x20-]*[0-9]|\(?[0-9]{2,4}\)?[\x20.-][0-9]{2,4}[\x20.-][0-9().\x20-]*[0-9]"),
)


def added_spans(text: str, tokens: list[tuple[int, int]], path, base) -> list[tuple[int, int, int]]:
    """(start, kind, end) of a decoded sequence's spans that pass and touch no base span."""
    spans: list[list[int]] = []
    for i, ((lo, hi), tag) in enumerate(zip(tokens, path)):
        if tag == 0:
            continue
        kind, inside = divmod(int(tag) - 1, 2)
        if inside and i and path[i - 1] in (tag, tag - 1):
            spans[-1][2] = hi
        else:
            spans.append([lo, kind, hi])
    out = []
    for start, kind, end in spans:
        own = text[start:end]
        free = all(e <= start or s >= end for s, _, e in base)
        if free and _WHOLE[kind].fullmatch(own) and passes(kind, own):
            out.append((start, kind, end))
    return out


def _found(field: Field):
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    hot = np.zeros(256, bool)
    hot[[ord(c) for c in "0123456789@"]] = True

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            rows = np.unique(np.searchsorted(offsets, np.flatnonzero(hot[data]), "right") - 1)
            texts = {int(i): batch.column(1)[int(i)].as_py() for i in rows}  # the others have none
            base = {i: base_spans(text) for i, text in texts.items()}
            runs = [(i, tokens) for i, text in texts.items() for tokens in sequences(text)]
            paths = field.paths([[texts[i][lo:hi] for lo, hi in tokens] for i, tokens in runs])
            spans = {i: list(own) for i, own in base.items()}
            for (i, tokens), path in zip(runs, paths):
                if path.any():
                    spans[i] += added_spans(texts[i], tokens, path, base[i])
            out: list[list] = [batch.column(0).cast(pa.int64()).to_pylist()] + [[] for _ in names[1:]]
            for i in range(batch.num_rows):
                own = base.get(i, [])
                for kind in range(len(KINDS)):
                    out[1 + kind].append(sum(k == kind for _, k, _ in own))
                out[5].append(hashlib.sha256(written(own).encode()).hexdigest())
                out[6].append(written(sorted(spans.get(i, []))))
            yield pa.record_batch([pa.array(x, k) for x, k in zip(out, kinds)], names)

    return run


_MARK = re.compile(r"<([a-z]+):([^<>]*)>")


def labelled_table(spark: SparkSession) -> DataFrame:
    """The default labelled table: (text, spans)."""
    rows = []
    for line in LABELLED:
        text, spans, at = "", [], 0
        for m in _MARK.finditer(line):
            text += line[at : m.start()]
            spans.append((len(text), KINDS.index(m[1]), len(text) + len(m[2])))
            text, at = text + m[2], m.end()
        rows.append((text + line[at:], written(spans)))
    return spark.createDataFrame(rows, "text string, spans string")


def find_personal_data(
    documents: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    labelled = labelled_table(documents.sparkSession) if labelled is None else labelled
    sample = labelled.select("text", "spans").orderBy(F.xxhash64("text", "spans"), "text", "spans").limit(MAX_LABELLED)
    field = train([(r.text, r.spans) for r in sample.collect()])
    return documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).mapInArrow(
        _found(field),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )
