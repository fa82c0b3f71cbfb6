"""Sampled segmentations over the lattice of a SentencePiece vocabulary, and lossless decoding.

Forward filtering gives every position of a text the total weight of its segmentations; backward sampling draws
one of them, piece by piece from the end, with exactly its probability. No piece of the vocabulary goes on over
a blank, so the lattice of a text is a chain of the lattices of its words (a word takes the blanks before it):
each distinct word is filtered once, and all words of a slice are sampled together in numpy. The random numbers
are a hash of the row's key, the word's place and the position, so a row gets the same pieces in any batch,
partition or run.

Text is taken as it is, without normalization or a blank in front: blanks become the vocabulary's blank sign,
and characters without a piece, a literal blank sign among them, become byte pieces. Decoding gives back the
text byte for byte.

Cases: null and empty texts have no pieces and decode to the empty text. A null key draws like key 0. Repeated
rows get equal pieces. Extra columns are carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import read
from gridspark.llm.words import mix, ragged, slices

BLANK = "▁"
_OTHER = "\ud800"  # stands for a literal blank sign; no text can hold it
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_KNOWN_WORDS = 100_000  # words whose lattice a worker remembers


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their ids and log weights, and the ids of the 256 byte pieces."""

    pieces: tuple[str, ...]
    ids: tuple[int, ...]
    weights: tuple[float, ...]
    bytes_: tuple[int, ...]

    @classmethod
    def load(cls, file: str, alpha: float = 1.0) -> Vocabulary:
        """From a model file. A model of merges has ranks instead of probabilities: its pieces weigh by Zipf's law.
        ``alpha`` below 1 flattens the distribution, above 1 sharpens it."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=file)
        numbers = range(model.get_piece_size())
        plain = [i for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        scores = [model.get_score(i) for i in plain]
        ranked = all(s == int(s) for s in scores)
        weights = [alpha * (-np.log(k + 2.0) if ranked else s) for k, s in enumerate(scores)]
        held = {model.id_to_piece(i): i for i in numbers if model.is_byte(i)}
        return cls(tuple(model.id_to_piece(i) for i in plain), tuple(plain), tuple(map(float, weights)),
                   tuple(held[f"<0x{b:02X}>"] for b in range(256)))

    def surface(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all ids, one after another, with the start and size of each id."""
        texts = {i: p.replace(BLANK, " ").encode() for i, p in zip(self.ids, self.pieces, strict=True)}
        texts |= {i: bytes([b]) for b, i in enumerate(self.bytes_)}
        every = [texts.get(i, b"") for i in range(max(texts) + 1)]
        sizes = np.array([len(x) for x in every])
        return np.frombuffer(b"".join(every), np.uint8), np.cumsum(sizes) - sizes, sizes


def _hash_step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (h ^ (c + np.uint64(1))) * _BASE ^ (h >> np.uint64(29))


class _Places:
    """Numbers by 64-bit hash, in a table with open places."""

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        bits = max(4, int(len(hashes) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.hashes, self.numbers = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -2)
        place, left = self._first(hashes), np.arange(len(hashes))
        while len(left):
            free = np.flatnonzero(self.numbers[place[left]] == -2)
            _, one = np.unique(place[left[free]], return_index=True)
            put = left[free[one]]
            self.hashes[place[put]], self.numbers[place[put]] = hashes[put], numbers[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            place[left] = (place[left] + 1) & self.mask

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _BASE) >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -2 for those that are not in the table."""
        place = self._first(hashes)
        out = self.numbers[place]
        left = np.flatnonzero((self.hashes[place] != hashes) & (out != -2))
        while len(left):
            place[left] = (place[left] + 1) & self.mask
            out[left] = self.numbers[place[left]]
            left = left[(self.hashes[place[left]] != hashes[left]) & (out[left] != -2)]
        return out


class Lattices:
    """Filtered lattices of words. The entries of position i of a word are the pieces that end there, with the
    running sum of their probabilities."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # Every beginning of a piece, by its hash, with the piece that ends there or -1: substrings are grown
        # letter by letter as long as some piece begins like them.
        lengths = np.array([len(p) for p in vocabulary.pieces])
        chars = np.zeros((len(lengths), int(lengths.max())), np.uint64)
        chars[np.arange(chars.shape[1]) < lengths[:, None]] = np.frombuffer("".join(vocabulary.pieces).encode("utf-32-le"), np.uint32)
        running, hashes, numbers = np.zeros(len(lengths), np.uint64), [], []
        for k in range(chars.shape[1]):
            running = _hash_step(running, chars[:, k])
            hashes.append(running[lengths > k])
            numbers.append(np.where(lengths == k + 1, np.arange(len(lengths)), -1)[lengths > k])
        hashes, numbers = np.concatenate(hashes), np.concatenate(numbers)
        order = np.lexsort((-numbers, hashes))
        first = order[np.concatenate(([True], np.diff(hashes[order]) != 0))]  # a piece before a mere beginning
        self.places = _Places(hashes[first], numbers[first])
        self.piece_ids, self.weights = np.array(vocabulary.ids), np.array(vocabulary.weights)
        self.byte_weight = min(vocabulary.weights) - 1.0
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.words = _Growing(np.int64, np.int64, np.int64)  # first node, length and distance of nodes of a word
        self.nodes = _Growing(np.int64)  # first entry of a position
        self.entries = _Growing(np.float64, np.int32, np.int32)  # running probability, length, piece or -1 - character

    def learn(self, words: set[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for word in words:
            if word not in self.index:
                by_length.setdefault(len(word), []).append(word)
        for length, group in by_length.items():
            step = max(1, 30_000 // length)
            for low in range(0, len(group), step):
                self._filter(group[low : low + step], length)

    def _filter(self, group: list[str], length: int) -> None:
        n = len(group)
        chars = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).astype(np.uint64)
        flat, start = chars.ravel(), np.arange(n * length)
        at, running, hits = start % length, np.zeros(n * length, np.uint64), []
        for k in range(length):
            running = _hash_step(running, flat[start + k])
            number = self.places.find(running)
            on = number > -2
            start, at, running, number = start[on], at[on], running[on], number[on]
            hit = number >= 0
            hits.append((start[hit] // length, at[hit] + k + 1, number[hit]))
            on = at + k + 1 < length
            start, at, running = start[on], at[on], running[on]
            if not len(start):
                break
        # weight and piece of the substring of each length that ends at each position; words lie next to each other
        reach = max(1, max((k + 1 for k, h in enumerate(hits) if len(h[0])), default=1))
        weight = np.full((length + 1, reach, n), -np.inf)
        piece = np.zeros((length + 1, reach, n), np.int32)
        for k, (row, end, number) in enumerate(hits[:reach]):
            weight[end, k, row], piece[end, k, row] = self.weights[number], self.piece_ids[number]
        signs = chars.T.astype(np.int64)
        bare = ~np.isfinite(weight[1:, 0])
        size = 1 + (signs > 0x7F).astype(int) + (signs > 0x7FF) + (signs > 0xFFFF)
        weight[1:, 0] = np.where(bare, size * self.byte_weight, weight[1:, 0])
        piece[1:, 0] = np.where(bare, -1 - signs, piece[1:, 0])
        total = np.zeros((length + 1, n))
        chance = np.zeros((length + 1, reach, n))
        for i in range(1, length + 1):
            k = min(i, reach)
            each = weight[i, :k] + total[i - k : i][::-1]
            top = each.max(0)
            p = np.exp(each - top)
            s = p.sum(0)
            total[i] = top + np.log(s)
            chance[i, :k] = np.cumsum(p / s, axis=0)
        by_word = lambda x: x.transpose(0, 2, 1)
        on = by_word(np.isfinite(weight))
        counts = on.sum(2)
        sizes = np.broadcast_to(np.arange(1, reach + 1, dtype=np.int32), on.shape)
        first = self.entries.add(by_word(chance)[on], sizes[on], by_word(piece)[on])
        node = self.nodes.add(first + np.cumsum(counts.ravel()) - counts.ravel())
        self.words.add(node + np.arange(n), np.full(n, length), np.full(n, n))
        self.index.update(zip(group, range(len(self.index), len(self.index) + n), strict=True))

    def sample(self, word: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A segmentation of each word drawn with its key: pieces in order, and the word each is of."""
        node0, length, step = (x[word] for x in self.words.columns)
        (first,), (chance, size, piece) = self.nodes.columns, self.entries.columns
        rows, at, found = np.arange(len(word)), length.copy(), []
        while len(rows):
            u = (mix(key[rows] + at[rows].astype(np.uint64) * _BASE) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            node = node0[rows] + at[rows] * step[rows]
            entry = first[node]
            last = entry + self._degree(node) - 1
            low = np.flatnonzero((chance[entry] <= u) & (entry < last))
            while len(low):
                entry[low] += 1
                low = low[(chance[entry[low]] <= u[low]) & (entry[low] < last[low])]
            found.append((rows, at[rows], piece[entry]))
            at[rows] -= size[entry]
            rows = rows[at[rows] > 0]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, place, pieces = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.lexsort((place, row))
        return pieces[order], row[order]

    def _degree(self, node: np.ndarray) -> np.ndarray:
        first = self.nodes.columns[0]
        following = np.where(node + 1 < self.nodes.used, first[np.minimum(node + 1, self.nodes.used - 1)], self.entries.used)
        return following - first[node]

    def encode(self, texts: list[str | None], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the number of ids of each; texts with equal keys and words get equal ids."""
        if len(self.index) > _KNOWN_WORDS:
            self.clear()
        words, counts = [], []
        for text in texts:
            found = _WORD.findall(text.replace(BLANK, _OTHER).replace(" ", BLANK)) if text else []
            words += found
            counts.append(len(found))
        self.learn(set(words))
        word = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        counts = np.array(counts)
        place = ragged(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
        pieces, of = self.sample(word, mix(np.repeat(keys, counts) + mix(place)))
        text_of = np.repeat(np.arange(len(counts)), counts)[of]
        bare = np.flatnonzero(pieces < 0)
        if len(bare):  # characters as bytes
            spelled = [list((BLANK if c == _OTHER else c).encode()) for c in (chr(-1 - p) for p in pieces[bare].tolist())]
            sizes = np.ones(len(pieces), np.int64)
            sizes[bare] = [len(s) for s in spelled]
            text_of, out = np.repeat(text_of, sizes), np.repeat(pieces, sizes)
            at = (np.cumsum(sizes) - sizes)[bare]
            out[ragged(at, sizes[bare])] = np.array(self.vocabulary.bytes_)[np.concatenate(spelled)]
            pieces = out
        return pieces, np.bincount(text_of, minlength=len(counts))


class _Growing:
    """Columns that grow at the end."""

    def __init__(self, *types):
        self.columns, self.used = [np.zeros(1 << 12, t) for t in types], 0

    def add(self, *values: np.ndarray) -> int:
        at, n = self.used, len(values[0])
        while at + n > len(self.columns[0]):
            self.columns = [np.concatenate((c, np.zeros_like(c))) for c in self.columns]
        for column, value in zip(self.columns, values, strict=True):
            column[at : at + n] = value
        self.used += n
        return at


_LOADED: dict[int, Lattices] = {}


def _encoder(vocabulary: Vocabulary, key: str, seed: int):
    def run(batches):
        name = hash(vocabulary)
        if name not in _LOADED:
            _LOADED.clear()
            _LOADED[name] = Lattices(vocabulary)
        for batch in batches:
            for part in slices(batch):
                keys = part.column(key).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                ids, counts = _LOADED[name].encode(part.column("text").to_pylist(), mix(keys + np.uint64(seed) * _BASE))
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "ids"])

    return run


def _decoder(vocabulary: Vocabulary):
    def run(batches):
        data, starts, sizes = vocabulary.surface()
        for batch in batches:
            lists = batch.column("ids")
            ids, offsets = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())))
            step, out = 64, []
            for low in range(0, len(lists), step):
                some = ids[offsets[low] : offsets[min(low + step, len(lists))]]
                ends = np.concatenate(([0], np.cumsum(sizes[some])))[offsets[low : low + step + 1] - offsets[low]]
                text = data[ragged(starts[some], sizes[some])].tobytes()
                out += [text[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary()).cast(pa.string())], [*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """``docs`` with ``ids``: a sampled segmentation of ``text``, drawn by the integer column ``key`` and ``seed``."""
    docs = docs.drop("ids")
    return docs.mapInArrow(_encoder(vocabulary, key, seed), docs.select("*", F.array().cast("array<int>").alias("ids")).schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``encoded`` with ``decoded``: the text of ``ids``."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(_decoder(vocabulary), encoded.select("*", F.lit("").alias("decoded")).schema)


def encode_checked(docs: DataFrame, vocabulary: Vocabulary, *, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """(key, ids, lossless): segmentations, each decoded again and compared with its text in the same task, so that
    ids cross to the Python workers and back once."""

    def run(batches):
        for batch in _decoder(vocabulary)(_encoder(vocabulary, key, seed)(batches)):
            same = pc.equal(batch.column("decoded"), batch.column("text").cast(pa.string()).fill_null(""))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("ids"), same], [key, "ids", "lossless"])

    docs = docs.select(F.col(key).cast("long").alias(key), "text")
    return docs.mapInArrow(run, f"`{key}` long, ids array<int>, lossless boolean")


def op2_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: sampled pieces of each text, and whether they decode to it."""
    from public_tokenizers import path

    vocabulary = Vocabulary.load(path("piece_bpe_32k.model"))
    out = encode_checked(read(spark, sf_dir, "documents"), vocabulary)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")
