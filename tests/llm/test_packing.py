import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tessera.llm import packing
from tests.llm.helpers import doc_rows, documents, got

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return t


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab 1\n\t.,'sé 　\x1c\x85!")), max_size=30), max_size=6))
def test_segments_encode_like_whole_texts(plain, texts):
    have = packing.encoder(PATH)(texts)
    assert have == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_special_strings(plain):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "of <|end oftext|>", " <|endoftext|>  <|endoftext|>\n", "a |endoftext| b"]
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    assert packing.encoder(PATH)(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_forgetting_changes_nothing(plain):
    few = packing.Encoder(PATH, remember=8)
    r = random.Random(0)
    for _ in range(60):
        texts = [" ".join(r.choice(["the", "of,", "a.\nb", "x" * 70, "café", "12"]) for _ in range(r.randrange(8))) for _ in range(4)]
        assert few(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_few_words_are_remembered():
    e = packing.Encoder(PATH)
    for i in range(16):
        e([" ".join(f"{k:x}q".translate(str.maketrans("0123456789", "ghijklmnop")) for k in range(25_000 * i, 25_000 * (i + 1)))])
        assert len(e.known) + len(e.old) <= 350_000  # two workers of an executor share what the JVM leaves


def test_cut_words_go_to_the_model_only(plain):
    texts = ["The cat's 12 caf\u00e9s,\n\n  it\u2019s (so) \t\x85 \u4e2d\u6587!! ", "x" * 70 + " " + "=" * 100, "", " \n", "\x00\x1c\x7f\xad a"]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    e = packing.Encoder(PATH)
    e.tokenizer = None  # its normaliser, pattern and offsets cost more than the merges
    assert e(texts) == want and e(texts) == want
    assert max(map(len, e.known)) <= 64


def test_every_byte_has_its_character(plain):
    texts = [a + b for a in map(chr, range(0x250)) for b in ("", " ", "a", "\n")]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.Encoder(PATH)(texts) == want


def test_curve_keys_of_written_out_windows():
    for t in (b"abcd", b"abcde", bytes(range(256)) * 3, "caf\u00e9 \u4e2d\u6587".encode()):
        counts = np.zeros(packing.HASHED)
        for i in range(len(t) - 3):
            counts[(int.from_bytes(t[i : i + 4], "little") * 2_654_435_761 % (1 << 32)) >> 23] += 1
        v = np.log1p(counts)[None, :]
        turn = np.random.default_rng(11).standard_normal((packing.HASHED, packing.DIMS))
        cuts = [packing.NormalDist().inv_cdf(i / (1 << packing.BITS)) for i in range(1, 1 << packing.BITS)]
        point = np.searchsorted(cuts, v / np.linalg.norm(v) @ turn)
        assert packing.curve_keys([t])[0] == packing.hilbert_key(point)[0]


def test_pieces_tile_documents_and_sequences(spark, plain):
    rows = doc_rows()
    out = got(packing.pack(documents(spark), PATH))
    ids = {}
    for r in rows:
        x = np.array([*plain.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        ids.setdefault(r[0], []).append(x)
    total = sum(len(x) for xs in ids.values() for x in xs)
    assert sum(p["length"] for p in out) == total
    for doc, xs in ids.items():
        pieces = [p for p in out if p["doc_id"] == doc]
        assert sum(p["length"] for p in pieces) == sum(map(len, xs))
        if len(xs) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(xs[0])
                assert p["ids_crc32"] == zlib.crc32(xs[0][at : at + p["length"]].tobytes())
                at += p["length"]
    seqs = {}
    for p in out:
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at & (at - 1) == 0 and at <= 1024  # nothing to pad


def test_neighbours_share_words():
    texts = [f"{a} {b} {c} zebra".encode() for a in ("red", "blue") for b in ("car", "bus") for c in ("x", "y", "z")]
    keys = packing.curve_keys([*texts, texts[0], b"", None])
    assert keys[0] == keys[len(texts)] and keys[-1] == keys[-2]


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).collect() == []
