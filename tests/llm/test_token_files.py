import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vaultline.llm import token_files
from vaultline.llm.queries import QUERIES
from vaultline.llm.text import Chunk

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(pairs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in pairs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_matches_library(spark, sample):
    got = sorted(map(tuple, QUERIES["op8_token_files"](spark, SF).collect()))
    assert got == brute(sorted(zip(sample.doc_id.tolist(), sample.text)))


def test_edges(spark, edges, nothing):
    got = sorted(map(tuple, token_files.token_files(edges, PATH).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 1, 1, 2, 3, 4, 5, 6]
    texts = sorted(r["text"] or "" for r in edges.collect())
    want = sorted(brute([(0, t)])[0][2:] for t in texts)
    assert sorted(r[2:] for r in got) == want
    assert [r[1] for r in got] == list(np.cumsum([0, *[r[2] for r in got]])[:-1])
    assert token_files.token_files(nothing, PATH).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (token_files.unpack(packed, bits, 1001) == ids).all()
    assert (token_files.unpack(packed, bits, 100, 333) == ids[333:433]).all()  # random access


def test_forgetting_changes_nothing():
    texts = [f"word{i} Word{i % 7} it's <|endoftext|> e\u0301 {i}" .encode() for i in range(300)]
    few, many = token_files.WordEncoder(PATH, 50), token_files.WordEncoder(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for part in (texts[:100], texts[100:110], texts[110:]):
        a, b = few.encode(Chunk.of(part), 2), many.encode(Chunk.of(part), 2)
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
        assert a[0].tolist() == [i for t in part for i in [*tokenizer.encode(t.decode(), add_special_tokens=False).ids, 2]]


def test_width():
    assert [token_files.width(v) for v in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_what_is_remembered_is_small():
    """Pieces are found in sorted arrays, without an object for each."""
    texts = [" ".join(f"{a}{b}{c}{d}" for c in "abcdefghij" for d in "abcdefghijklmno").encode() for a in "klmnopqrst" for b in "uvwxyzabcd"]
    encoder = token_files.WordEncoder(PATH)
    for at in range(0, len(texts), 10):
        encoder.encode(Chunk.of(texts[at: at + 10]), 2)
    held = sum(a.nbytes for a in vars(encoder).values() if isinstance(a, np.ndarray)) - encoder.ids.nbytes
    assert not any(isinstance(a, dict) and a for a in vars(encoder).values())
    assert len(encoder.sizes) == 15_000 and held <= 32 * 15_000
