import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from reelforge.llm import packing
from tests.llm.helpers import documents, words

SF = "/root/testdata/sf0.01"
TEXTS = ["", " ", "a", " a", "a ", "a  b", "a\n b", "it's 12 o'clock, isn't it?", "x\t\ty", "é ü z", "<|endoftext|> here", "日本語 テキスト", "a" * 3000, "line\nline\r\nline", "\x1c a\x85b", "end\n", "don't  stop\n\n\nnow "]


def encoder():
    return packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer():
    rng, enc, ref = random.Random(2), encoder(), reference()
    alphabet = [*"ab é\n\t '12.,  s\xa0", "\x1c", "\x85", "<|endoftext|>", "<|", "|>", "日"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)] + [words(rng, 200)]
    for text in texts:
        assert np.frombuffer(enc(text), "<u4").tolist() == ref.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_tokens_have_one_id():
    assert np.frombuffer(encoder()("<|endoftext|> here"), "<u4").tolist() == [50256, 994]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_ids_of_whole_documents():
    enc, ref = encoder(), reference()
    for text in pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist():
        assert np.frombuffer(enc(text or ""), "<u4").tolist() == ref.encode(text or "", add_special_tokens=False).ids


def test_pieces_fill_sequences(spark):
    rng, ref = random.Random(4), reference()
    rows = [(i, words(rng, rng.choice([0, 5, 80, 300, 900]))) for i in range(150)]
    got = packing.pack(documents(spark, rows).repartition(3), encoder, bins=8).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, text in rows:
        ids = np.array([*ref.encode(text, add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        at = 0
        for r in parts:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 1024 for r in parts[1:])
    total = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        total += at
    assert len(by_seq) <= 1.1 * total / 1024 + 2


def test_best_fit_and_closing():
    bins = packing.OpenBins(10, 2)
    assert bins.put(6) == (0, 0, None) and bins.put(5) == (1, 0, None)
    assert bins.put(4) == (0, 6, None)  # the fullest that holds it, now full
    assert bins.put(9) == (2, 0, None)
    assert bins.put(8) == (3, 0, 2)  # the fullest closes
    assert bins.put(10)[2] is None and bins.open() == {1, 3}
