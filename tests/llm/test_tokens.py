"""Byte-level BPE against the library that defines it, and the hash of whole words."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from gevel.llm import bpe, queries
from tests.llm import messy

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_hash_is_minimal_and_perfect():
    keys = np.random.default_rng(1).integers(0, 2**64, 5000, np.uint64)
    keys = np.unique(keys)
    found = bpe.PerfectHash(keys)
    assert sorted(found(keys)) == list(range(len(keys)))
    with pytest.raises(ValueError):
        bpe.PerfectHash(np.array([7, 7], np.uint64))


def test_whole_words_are_compared_by_their_bytes(own):
    tokens = [b"the", b" the", b"a", b"zzqzzq", b""]
    ids = own.whole(tokens)
    assert ids[0] >= 0 and ids[2] >= 0 and ids[3] == -1 and ids[4] == -1


def texts():
    rng = random.Random(3)
    odd = ["", "a" * 30_000, "ab" * 4000, " \n\t ", "é", "don't WE'LL 's's  x  \r\n\r\n y", "123456789 ½ हिन्दी ไทย 日本語 👍🏽" * 30, "\u0000­", "<|endoftext|>", "x\u0cdcy \U000323b01"]
    pools = [(32, 127), (0xA0, 0x2000), (0x3000, 0xD7FF), (0x10000, 0x10500)]
    return odd + ["".join(chr(rng.randrange(*rng.choice(pools))) for _ in range(150)) for _ in range(150)]


def test_ids_equal_the_library(own, library):
    rows = texts()
    got = [np.frombuffer(ids, "<u4").tolist() for ids in own.encode([*rows, None])]
    assert got == [*[library.encode_ordinary(t) for t in rows], []]


def test_remembered_words_change_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    for text in texts()[:40]:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_query_and_round_trip(spark, tmp_path, library):
    docs = messy.frame(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op13_bpe(spark, str(tmp_path)).collect()), key=repr)

    def digest(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for doc_id, text, *_ in messy.rows():
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), digest(np.array(ids, "<u4").tobytes()), digest((text or "").encode())))
    assert got == sorted(want, key=repr)


def test_empty_table_and_foreign_ids(spark, own):
    assert bpe.decode(bpe.encode(messy.empty(spark), own), own).collect() == []
    bad = spark.createDataFrame([(1, 1, bytearray(np.array([99_999_999], "<u4").tobytes()))], "doc_id long, n_tokens long, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, own).collect()
    with pytest.raises(ValueError):
        bpe.Tokenizer({b"a": 0}, ".")
