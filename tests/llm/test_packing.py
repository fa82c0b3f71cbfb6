import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from gridspark.llm import packing
from gridspark.llm.common import Run

FILE = path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, ids string, queue int"


def check(pieces, rows):
    """Each id in one piece, sequences gapless, full or powers of two."""
    tokenizer = Tokenizer.from_file(FILE)
    wanted = sorted(((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in rows), key=repr)
    sequences, docs = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert len(ids) == p.length > 0
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, tuple(ids)))
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        lengths.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    assert all(n == packing.WINDOW or n & (n - 1) == 0 for n in lengths) and max(lengths, default=0) <= packing.WINDOW
    got = []
    for (doc, n), parts in docs.items():
        ids = sum((x for _, x in sorted(parts)), ())
        copies = len(ids) // n
        if copies > 1:  # repeated rows: the pieces of each cannot be told apart, their ids can be counted
            same = [w for w in wanted if w[0] == doc and len(w[1]) == n]
            assert copies == len(same) and sorted(ids) == sorted(sum((w[1] for w in same), ()))
            got += same
        else:
            assert [s for s, _ in sorted(parts)] == list(np.cumsum([0] + [len(x) for _, x in sorted(parts)])[:-1])
            got.append((doc, ids))
    assert sorted(got, key=repr) == wanted
    return sequences


def test_pieces(spark):
    rng = random.Random(1)
    words = "the Of naïve Straße 12345 don't <|endoftext|> x<|startoftext|>y é  gap \x1c日本語 😀 it's ΟΔΟΣ".split(" ")
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 700))), rng.choice(["a", "a", "a", "b", "c", None]), "x", 1)
            for i in range(250)]
    rows += [(900, None, "a", "x", 1), (901, "", None, "x", 1), (902, "one\ttwo\r\n\x0bthree\x0c", "b", "x", 1), (None, "no id", "c", None, None),
             (3, rows[3][1], rows[3][2], None, None), (903, "long text " * 40_000, "b", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pieces = packing.pack(docs, Run(spark, "test"), FILE)
    found = pieces.collect()
    sequences = check(found, rows)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces).collect()}
    assert {s: len(i) // 4 for s, i in whole.items()} == {s: sum(n for _, n in p) for s, p in sequences.items()}


def test_ids_of_unusual_texts():
    """Letters, digits, signs and controls of all kinds, alone and in runs, against the tokenizer itself."""
    rng, tokenizer = random.Random(6), Tokenizer.from_file(FILE)
    coder = packing.WordIds(open(FILE).read())
    bits = [*map(chr, range(1, 0x250)), *"ΣσςΟİıßẞŉ²½Ⅷ٣۴漢字かな한국ँंe\u0301a\u030a\u200d\u200b\u2028\u3000\ufeff😀👩🏽", "'s", "'LL", "don't", "The", " ", " ", "\n", "<|endoftext|>", "<|end"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choice("abcÉéßñ0123 .,!?'_-$&\n") for _ in range(80)) for _ in range(2000)] + ["é", "", None, "İstanbul", "ΟΔΟΣ", "a_b", "x" * 5000]
    ids, counts = coder.encode(texts)
    got = np.split(ids, np.cumsum(counts)[:-1])
    for text, found in zip(texts, got, strict=True):
        assert list(found) == tokenizer.encode(text or "", add_special_tokens=False).ids + [2], repr(text)


def test_query_equals_direct_encoding(spark):
    tables = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(FILE)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    for p in packing.op6_packing(spark, tables).collect():
        ids = tokenizer.encode(texts[p.doc_id] or "", add_special_tokens=False).ids + [2]
        assert p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_windows_hold_the_mixture():
    tokens = {1: 3_000_000, 2: 1_000_000, 3: 50_000, 0: 777}
    p = packing.plan(tokens)
    share = {q: n / sum(tokens.values()) * packing.WINDOW for q, n in tokens.items()}
    phase = p.phases[0]
    assert phase.windows * packing.WINDOW > 0.99 * 3_000_000
    for q in (1, 2, 3):
        per_window = np.diff([phase.served(q, r) for r in range(200)])
        assert per_window.max() - per_window.min() <= 2 and abs(per_window.mean() - share[q]) < 5
    assert sum(p.kept.values()) == p.windows * packing.WINDOW and p.tokens < len(tokens) * packing.WINDOW


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_each_token_once(seed):
    rng = random.Random(seed)
    tokens = {q: rng.choice([0, 1, 5, 100, 4096, 9000, 70_000]) for q in range(rng.randrange(1, 9))}
    weights = {q: rng.random() for q in tokens} if seed % 2 else None
    p, taken = packing.plan(tokens, weights), {}
    for q, n in tokens.items():
        at = 0
        while at < n:
            size, seen = min(n - at, rng.randrange(1, 6000)), 0
            for start, length, sequence, offset in packing._pieces(p, q, at, size):
                assert start == seen
                seen += length
                for k in range(offset, offset + length):
                    assert taken.setdefault((sequence, k), q) == q
            assert seen == size
            at += size
    assert len(taken) == sum(tokens.values())
    ends = {}
    for s, k in taken:
        ends[s] = max(ends.get(s, 0), k + 1)
    assert sum(ends.values()) == len(taken) and all(n == 4096 or n & (n - 1) == 0 for n in ends.values())


@pytest.mark.parametrize("weights", [None, {"a": 1.0, "b": 3.0, "absent": 1.0}])
def test_small_tables(spark, weights):
    for rows in ([], [(1, None, None, None, None)], [(i, "some words here " * 40, "ab"[i % 2], None, None) for i in range(200)]):
        pieces = packing.pack(spark.createDataFrame(rows, SCHEMA), Run(spark, "test"), FILE, weights=weights).collect()
        check(pieces, rows)


def test_patterned_words_have_their_own_ids():
    """Two words of 1,024 letters that are complements of one pattern, and their like, next to each other."""
    with open(FILE) as file:
        coder = packing.WordIds(file.read())
    tokenizer = Tokenizer.from_file(FILE)
    for bits in (7, 10, 11, 13):
        texts = ["".join("ab"[(i.bit_count() & 1) ^ flip] for i in range(1 << bits)) for flip in (0, 1)]
        ids, counts = coder.encode(texts)
        for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert list(got) == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_agreement_of_one_half_does_no_harm(monkeypatch):
    whole = packing.Words.hashes
    monkeypatch.setattr(packing.Words, "hashes", lambda self, half=0: whole(self, half) % np.uint64(3) if half == 0 else whole(self, half))
    with open(FILE) as file:
        coder = packing.WordIds(file.read())
    tokenizer = Tokenizer.from_file(FILE)
    texts = ["the quick brown fox jumps over the lazy dog 12345", "never the same word twice"]
    ids, counts = coder.encode(texts)
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_tokens_are_made_in_small_steps(monkeypatch):
    """A step takes 2 MB of text at most, or one row: the arrays over its words are many times larger."""
    monkeypatch.setattr(packing.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    text = "one two three " * 50_000  # 700 kB
    batch = pa.RecordBatch.from_pydict({"doc_id": [*range(8)], "text": [text] * 8, "queue": pa.array([0] * 8, pa.int32())})
    with open(FILE) as file:
        steps = [*packing._tokenize(file.read())(iter([batch]))]
    assert [s.num_rows for s in steps] == [2, 2, 2, 2]
    assert [n for s in steps for n in s.column("doc_tokens").to_pylist()] == [150_001] * 8
