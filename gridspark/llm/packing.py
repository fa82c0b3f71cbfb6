"""Mixture-controlled packing of documents into fixed windows of tokens.

Each source is a queue of tokens. Windows are filled by deficit round robin: a window gives every queue its
quantum, whole tokens are served, and the fraction that is left is the queue's deficit, carried to the next
window. Documents may be cut anywhere, so a deficit stays below one token and the service of a queue after r
windows has a closed form (differences of ``floor(r * cumulated quanta)``). So any task knows the deficits
that reach its first window: partitions are packed independently and still continue each other. A queue that
cannot fill its share of another window leaves; the others go on in their proportions. What is left of all
queues, less than a window each, fills the last windows in turn, and the very last tokens go to sequences of
power-of-two lengths, so nothing is padded.

Queues: a source with less than 1/1024 of all bytes (or no source) shares one queue with others like it, so
there are at most 1025 queues and the plan is small at any size. Positions in a queue are a running count
within each task's rows plus the sums of the tasks before.

Cases: a null or empty text is one end token. Rows that repeat a ``doc_id`` are packed each. Without rows there
are no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, read
from gridspark.llm.words import Words, ragged, slices

WINDOW = 4096
END = 2
#: A source of at least this share of the bytes has a queue of its own.
QUEUE_SHARE = 1 / 1024
_UNIT = 1 << 16  # quanta are counted in this part of a token
#: Control characters that are blanks to some and signs to others.
_TAME = frozenset(map(chr, [*range(9), *range(14, 32), 127]))
_SLICE_BYTES = 2 << 20  # of text a step: the arrays over its words take some thirty times that
_KNOWN_WORDS = 500_000  # words whose ids a worker remembers


#: Byte classes of pre-tokens: blanks, letters (and all beyond ASCII), digits (each on its own), other signs.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[32, *range(9, 14)]], _CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]], _CLASS[48:58] = 0, 1, 2


def _pretokens(texts: list[bytes]) -> Words:
    """Runs of one class in lower-case texts; every digit is a run."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    kind, edge = _CLASS[data], np.zeros(len(data) + 1, bool)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    edge[offsets] = True
    edge[1:-1] |= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    on = kind[starts] > 0
    starts, ends = starts[on], ends[on]
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


class WordIds:
    """Token ids of texts by a tokenizer that lower-cases, cuts texts to pre-tokens and encodes each on its own, the
    last token of each marked as a word's end. Pre-tokens seen before are looked up. Texts that this module
    cannot cut with certainty are cut at blanks only, and the tokenizer does the rest."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.index = {b"\n": 0}  # no word is this; it stands for the end of a document
        self.starts, self.sizes, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 1
        self.sizes[0], self.ids[0] = 1, END

    def plain(self, text: str) -> bytes | None:
        """The text in lower case, if its pre-tokens are the runs of one class: no apostrophe that may begin a
        contraction, no control sign, nothing beyond ASCII but letters, no special token."""
        if "'" in text or "Σ" in text or any(t in text for t in self.special):
            return None
        lower = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()
        signs = set(lower)
        if not _TAME.isdisjoint(signs) or not (lower.isascii() or all(c <= "\x7f" or c.isalpha() for c in signs)):
            return None
        return lower.encode()

    def learn(self, words) -> None:
        """Remember words not seen before. Many are encoded as one text."""
        new = [w for w in words if w not in self.index]
        for low in range(0, len(new), 5000):
            part = new[low : low + 5000]
            text = [w if isinstance(w, str) else w.decode() for w in part]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(text)], add_special_tokens=False)[0].ids, np.int64)
            done = self.ends[ids] if len(ids) else np.zeros(0, bool)
            if done.sum() == len(part) and done[-1] and all(isinstance(w, str) for w in part):
                sizes = np.diff(np.concatenate(([-1], np.flatnonzero(done))))
            else:  # a token's offset tells its word
                found = self.tokenizer.encode(" ".join(text), add_special_tokens=False)
                at = np.array([o[0] for o in found.offsets], np.int64)
                sizes = np.bincount(np.searchsorted(np.cumsum([len(w) + 1 for w in text]), at, "right"), minlength=len(part))
            n, k = self.used, len(self.index)
            self.used += len(ids)
            while self.used > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
            while k + len(part) > len(self.starts):
                self.starts, self.sizes = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.sizes))
            self.ids[n : self.used] = ids
            self.starts[k : k + len(part)], self.sizes[k : k + len(part)] = n + np.cumsum(sizes) - sizes, sizes
            self.index.update(zip(part, range(k, k + len(part)), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and the number of ids of each text."""
        if len(self.index) > _KNOWN_WORDS:
            self.clear()
        plain = [self.plain(t) if t else b"" for t in texts]
        fast = [i for i, t in enumerate(plain) if t is not None]
        entries = [None] * len(texts)
        # Words are told apart by 128-bit hashes; only distinct ones are looked up.
        words = _pretokens([plain[i] for i in fast])
        hashes, other = words.hashes(0), words.hashes(1)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if not np.array_equal(other[first][which], other):  # one half alone agrees by chance
            _, first, which = np.unique(np.stack((hashes, other), axis=1), axis=0, return_index=True, return_inverse=True)
        data = words.data.tobytes()
        distinct = [data[a:b].decode() for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
        self.learn(distinct)
        known = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))[which]
        for k, i in enumerate(fast):
            entries[i] = known[words.first[k] : words.first[k + 1]]
        # The other texts are cut at blanks, over which no token reaches.
        slow = {i: texts[i].encode().split() for i, t in enumerate(plain) if t is None}
        self.learn({w for found in slow.values() for w in found})
        for i, found in slow.items():
            entries[i] = np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))
        end, parts = np.zeros(1, np.int64), []
        for entry in entries:
            parts += (entry, end)
        at = np.concatenate(parts) if parts else end[:0]
        counts = np.array([len(e) + 1 for e in entries], np.int64)
        sizes = self.sizes[at]
        sums = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        return self.ids[ragged(self.starts[at], sizes)], np.diff(sums)


_LOADED: dict[int, WordIds] = {}


def _tokenize(content: str):
    def run(batches):
        coder = _LOADED.get(hash(content))
        if coder is None:
            _LOADED.clear()
            coder = _LOADED[hash(content)] = WordIds(content)
        part, served = TaskContext.get().partitionId(), {}
        for batch in batches:
            for rows in slices(batch, limit=_SLICE_BYTES):
                ids, counts = coder.encode(rows.column("text").to_pylist())
                queues, local = rows.column("queue").to_pylist(), []
                for q, n in zip(queues, counts.tolist(), strict=True):
                    local.append(served.get(q, 0))
                    served[q] = local[-1] + n
                cut = np.split(ids.astype(np.uint16), np.cumsum(counts)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array([part] * len(cut), pa.int32()), rows.column("queue"), pa.array(local, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array([c.tobytes() for c in cut], pa.binary())],
                    ["doc_id", "part", "queue", "local", "doc_tokens", "ids"],
                )

    return run


@dataclass
class Phase:
    """Windows ``first .. first + windows`` in which the same queues are served by the same quanta."""

    first: int
    windows: int
    start: dict[int, int]  # tokens of the queue that were served before
    below: dict[int, int]  # cumulated quanta of the queues before it, in units
    upto: dict[int, int]  # and with its own

    def served(self, queue: int, r):
        """Tokens of the queue after r windows of this phase."""
        return r * self.upto[queue] // _UNIT - r * self.below[queue] // _UNIT

    def offset(self, queue: int, r):
        """Where the queue's tokens begin in window r."""
        return (r + 1) * self.below[queue] // _UNIT - r * self.below[queue] // _UNIT


@dataclass
class Plan:
    phases: list[Phase] = field(default_factory=list)
    windows: int = 0  # full windows of all phases
    kept: dict[int, int] = field(default_factory=dict)  # tokens of a queue served in phases; the rest is its tail
    tail: dict[int, int] = field(default_factory=dict)  # place of the queue's tail among all tails
    tokens: int = 0  # of all tails


def _quanta(weights: dict[int, float]) -> dict[int, int]:
    """Quanta of a window in units, in the proportions of the weights, a token each at least."""
    total = sum(weights.values())
    quanta = {q: max(_UNIT, int(WINDOW * _UNIT * w / total)) for q, w in weights.items()}
    quanta[max(weights, key=weights.get)] += WINDOW * _UNIT - sum(quanta.values())
    return quanta


def plan(tokens: dict[int, int], weights: dict[int, float] | None = None) -> Plan:
    """How queues of these lengths are served; the default mixture is that of the tokens themselves."""
    out, active = Plan(kept=dict.fromkeys(tokens, 0)), sorted(q for q, n in tokens.items() if n)
    weights = weights or {q: float(n) for q, n in tokens.items()}
    while active:
        upto, below, total = {}, {}, 0
        quanta = _quanta({q: max(weights.get(q, 0.0), 1e-9) for q in active})
        for q in active:
            below[q], total = total, total + quanta[q]
            upto[q] = total
        phase = Phase(out.windows, 0, {q: out.kept[q] for q in active}, below, upto)
        left = {q: tokens[q] - out.kept[q] for q in active}
        low, high = 0, min((left[q] + 2) * _UNIT // quanta[q] for q in active) + 1
        while low < high:  # the most windows that all active queues can fill
            mid = (low + high + 1) // 2
            low, high = (mid, high) if all(phase.served(q, mid) <= left[q] for q in active) else (low, mid - 1)
        if low:
            phase.windows = low
            out.phases.append(phase)
            out.windows += low
            for q in active:
                out.kept[q] += phase.served(q, low)
        active = [q for q in active if phase.served(q, low + 1) - phase.served(q, low) <= tokens[q] - out.kept[q] and tokens[q] > out.kept[q]]
    for q in sorted(tokens):
        out.tail[q], out.tokens = out.tokens, out.tokens + tokens[q] - out.kept[q]
    return out


def _pieces(p: Plan, queue: int, start: int, length: int):
    """(start in the document, length, sequence, offset) of a document at ``start`` of its queue."""
    for phase in p.phases:
        if queue not in phase.start:
            continue
        base = phase.start[queue]
        low, high = max(start - base, 0), min(start + length - base, phase.served(queue, phase.windows))
        if low >= high:
            continue
        quantum = phase.upto[queue] - phase.below[queue]
        first = max(0, low * _UNIT // quantum - 2)
        r = np.arange(first, min(high * _UNIT // quantum + 3, phase.windows) + 1)
        bounds = phase.served(queue, r)
        begin, end = np.maximum(bounds[:-1], low), np.minimum(bounds[1:], high)
        for k in np.flatnonzero(begin < end):
            yield (int(begin[k]) + base - start, int(end[k] - begin[k]), phase.first + int(r[k]),
                   int(phase.offset(queue, int(r[k])) + begin[k] - bounds[k]))
    low = max(start, p.kept[queue])
    at, end = p.tail[queue] + low - p.kept[queue], p.tail[queue] + start + length - p.kept[queue]
    full = p.tokens // WINDOW
    while at < end:
        sequence, bound = at // WINDOW, (at // WINDOW + 1) * WINDOW
        begin = bound - WINDOW
        if sequence >= full:  # the rest, by its binary digits from the largest
            begin, rest = full * WINDOW, p.tokens - full * WINDOW
            bit = 1 << (rest.bit_length() - 1)
            while begin + bit <= at:
                begin, rest, sequence = begin + bit, rest - bit, sequence + 1
                bit = 1 << (rest.bit_length() - 1)
            bound = begin + bit
        n = min(end, bound) - at
        yield at - p.tail[queue] + p.kept[queue] - start, n, p.windows + sequence, at - begin
        at += n


def _cut(p: Plan):
    def run(batches):
        for batch in batches:
            rows = {n: batch.column(n).to_pylist() for n in ("doc_id", "queue", "at", "ids")}
            out, size = [], 0
            for doc, queue, at, ids in zip(*rows.values(), strict=True):
                ids = np.frombuffer(ids, np.uint16).astype("<u4")
                for start, n, sequence, offset in _pieces(p, queue, at, len(ids)):
                    out.append((doc, start, n, ids[start : start + n].tobytes(), len(ids), sequence, offset))
                    size += n
                if size > 1 << 20:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    return run


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)


def pack(docs: DataFrame, run: Run, tokenizer: str, *, weights: dict[str, float] | None = None) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text, source): doc_id, start, length, ids (little-endian, four bytes each),
    doc_tokens, sequence_id, offset.

    ``tokenizer`` is the file of a tokenizer whose ids fit 16 bits; ``weights`` are target proportions by source
    (others weigh nothing until these are used up). By default the mixture of the whole table holds in every window.
    """
    spark = docs.sparkSession
    with open(tokenizer) as file:  # on the driver; tasks get its content
        content = file.read()
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.col("source").cast("string"))
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
    sizes = run.write(sizes.where("source is not null"), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    named = sorted({r.source for r in sizes.where(F.col("size") >= max(1, total * QUEUE_SHARE)).collect()} | set(weights or ()))
    queue = F.coalesce(F.array_position(F.array(*map(F.lit, named)), F.col("source")), F.lit(0)) if named else F.lit(0)
    tokens = run.write(
        docs.select("doc_id", "text", queue.cast("int").alias("queue")).mapInArrow(
            _tokenize(content), "doc_id long, part int, queue int, local long, doc_tokens long, ids binary"),
        "tokens",
    )
    sums = run.write(tokens.groupBy("part", "queue").agg(F.sum("doc_tokens").alias("n")), "sums")
    lengths = {r.queue: r.n for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # 1025 at most
    shares = {named.index(s) + 1: w for s, w in weights.items()} if weights else None
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = tokens.join(offsets.hint("shuffle_hash"), ["part", "queue"])
    return placed.select("doc_id", "queue", (F.col("before") + F.col("local")).alias("at"), "ids").mapInArrow(
        _cut(plan(lengths, shares)),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): each sequence whole. A group has a window of tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    return pieces.groupBy("sequence_id").agg(whole.alias("ids"))


def with_checks(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` in sequences of 4096 tokens, every one with the table's mixture of sources."""
    from public_tokenizers import path

    return with_checks(pack(read(spark, sf_dir, "documents"), Run(spark, "op6"), path("word_bpe_49k.json")))
