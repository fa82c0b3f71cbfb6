import random
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor

from gridspark.llm import pieces
from gridspark.llm.pieces import BLANK, Lattices, Vocabulary, decode, encode

VOCABULARY = Vocabulary.load(path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, ids string, decoded string"
TINY = Vocabulary(("a", "b", "ab", "ba", BLANK, BLANK + "a"), (300, 301, 302, 303, 304, 305), (-1.0, -1.5, -0.3, -2.0, -1.0, -0.7), tuple(range(256)))


def segmentations(word, vocabulary):
    """All segmentations of a word with their weights, by plain recursion."""
    table = dict(zip(vocabulary.pieces, zip(vocabulary.ids, vocabulary.weights)))
    if not word:
        return [((), 0.0)]
    out = []
    for n in range(1, len(word) + 1):
        if word[:n] in table:
            i, w = table[word[:n]]
            out += [((i, *rest), w + x) for rest, x in segmentations(word[n:], vocabulary)]
    return out


def test_samples_follow_the_lattice_distribution():
    lattices, n = Lattices(TINY), 20_000
    ids, counts = lattices.encode([" aab abba"] * n, np.arange(n, dtype=np.uint64) * np.uint64(77))
    got = Counter(tuple(x) for x in np.split(ids, np.cumsum(counts)[:-1]))
    wanted = {}
    for first, w in segmentations(BLANK + "aab", TINY):
        for second, x in segmentations(BLANK + "abba", TINY):
            wanted[first + second] = w + x
    total = np.logaddexp.reduce(list(wanted.values()))
    assert set(got) <= set(wanted)
    for segmentation, w in wanted.items():
        p = np.exp(w - total)
        assert abs(got[segmentation] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4


def test_lossless_and_reproducible(spark):
    rng = random.Random(3)
    bits = ["a", " ", "  ", "\n", BLANK, "é", "日本", "😀", "\x00", "<s>", "<0x41>", "the", "tion", "‍", "\t", "Straße", "퟿", "￿"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 60))), "x", "y") for i in range(400)]
    rows += [(None, None, None, None), (900, "", "x", "y"), (901, " ", "x", "y"), (902, "x" * 30_000, "x", "y"), (903, "word " * 60_000, "x", "y"),
             (None, rows[7][1], "x", "y"), (7, rows[7][1], "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = decode(encode(docs, VOCABULARY), VOCABULARY)
    assert set(out.columns) == set(docs.columns)
    got = out.collect()
    assert len(got) == len(rows) and all(r.decoded == (r.text or "") for r in got)
    other = {(r.doc_id, r.text): r.ids for r in encode(docs.repartition(7), VOCABULARY).collect()}
    assert all(other[r.doc_id, r.text] == r.ids for r in got)
    seeded = {(r.doc_id, r.text): r.ids for r in encode(docs, VOCABULARY, seed=5).collect()}
    assert sum(seeded[r.doc_id, r.text] != r.ids for r in got) > 100
    long = next(r.ids for r in got if r.doc_id == 903)
    assert len({tuple(long[k : k + 1]) for k in range(len(long))}) > 1


def test_query(spark):
    got = pieces.op2_sampled_pieces(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.lossless and r.n_pieces == len(r.ids) for r in got)
    # Decoded once more, by the model's own pieces.
    model = SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    spell = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(BLANK, " ").encode()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(b"".join(map(spell, r.ids)).decode() == (texts[r.doc_id] or "") for r in got)


def test_places_find_what_they_hold():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    held, others = hashes[::2], hashes[1::2]
    places = pieces._Places(held, np.arange(len(held)) - 1)
    assert (places.find(held) == np.arange(len(held)) - 1).all() and (places.find(others) == -2).all()


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_empty(spark, rows):
    out = decode(encode(spark.createDataFrame(rows, SCHEMA), VOCABULARY), VOCABULARY).collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in out] == [(r[0], [], "") for r in rows]
