import random

import numpy as np
import pyarrow as pa
import pytest

from fablens.llm import bpe, token_counts
from fablens.llm import textarrays as T

ODD = list("ab 'sdtrevlm \n\t!?.0129éß　   中文😀<|endoftext|>") + ["<|endoftext|>", "'ll", " 's", "'re", "  ", "ÿ\x85", "\u0558"]


def texts():
    r = random.Random(1)
    out = ["".join(r.choice(ODD) for _ in range(r.randrange(60))) for _ in range(1500)]
    return [*out, None, "", "x" * 200_000, "a b " * 50_000, "aaaa" * 99, "".join(r.choice("abcdefgh") for _ in range(20_000))]


@pytest.fixture(scope="module")
def library():
    return token_counts.load_tokenizer(token_counts.TOKENIZER)


def test_encoder_equals_the_library(library):
    words = bpe.vocabulary(bpe.TOKENIZER)
    known = sorted({b" the", b" and", b"The", b" a", b"a", b"\n", b"<|endoftext|>", b" 's"})
    encoder = bpe.Encoder(words, bpe.Lexicon.compile(known, *words.encode_pieces(known)))
    out = []
    for _, _, buffer, offsets in T.chunks(pa.array(texts()), 1 << 14):
        ids, firsts = encoder.encode(buffer, offsets)
        assert words.decode(ids).tobytes() == buffer.tobytes()
        out += [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])]
    assert out == [library.encode(t or "", add_special_tokens=False).ids for t in texts()]


def test_lexicon_is_minimal_and_maps(tmp_path):
    words = sorted({b"tap", b"taps", b"top", b"tops", b"a", b"stops"})
    lexicon = bpe.Lexicon.compile(words, np.arange(6), np.ones(6, int))
    (tmp_path / "l").write_bytes(lexicon.to_bytes())
    mapped = bpe.Lexicon.map(str(tmp_path / "l"))
    asked = [*words, b"ta", b"tapsy", b"", b"st"]
    data = np.frombuffer(b"".join(asked), np.uint8)
    size = np.array([len(w) for w in asked])
    assert mapped.index(data, np.cumsum(size) - size, size).tolist() == [0, 1, 2, 3, 4, 5, -1, -1, -1, -1]
    # Suffixes are shared: t(a|o)p(s) needs one p and one s state, and stops ends in the same ones.
    assert len(mapped.final) < sum(len(w) for w in words)
    empty = bpe.Lexicon.compile([], np.zeros(0, int), np.zeros(0, int))
    assert empty.index(data, np.cumsum(size) - size, size).tolist() == [-1] * 10


def test_encode_and_decode(documents, library):
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())] + [(7, "again"), (7, "again")]
    out = bpe.encode_and_decode(documents(rows), lexicon_words=200).collect()
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows)
    got = sorted((str(r["doc_id"]), np.frombuffer(bytes(r["token_ids"]), "<u4").tolist(), r["decoded"]) for r in out)
    assert got == want
    assert all(r["n_tokens"] * 4 == len(r["token_ids"]) for r in out)
    assert bpe.encode_and_decode(documents(rows).limit(0)).count() == 0


def test_frequent_words_are_counted_over_all(documents):
    rows = [(i, "one two two three three three") for i in range(40)] + [(99, "rare"), (100, None)]
    assert bpe.frequent_words(documents(rows), "text", 3) == [b" three", b" two", b"one"]
    assert bpe.frequent_words(documents(rows), "text", 1) == [b" three"]


def test_the_lexicon_is_bounded(documents):
    """A class larger than the lexicon gives a share of itself, and long pieces none, however frequent."""
    many = " ".join(f"word{i}" for i in range(4000))
    found = bpe.frequent_words(documents([(i, many) for i in range(5)]), "text", 1000)
    assert 850 < len(found) < 1150
    long = "x" * 65 + "中" * 300 + "x"
    assert bpe.frequent_words(documents([(i, long + " short") for i in range(5)]), "text", 10) == [b" short"]


def test_token_counts(documents, library):
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())]
    out = token_counts.token_counts(documents(rows)).collect()
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in out) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in out)
    assert token_counts.token_counts(documents(rows).limit(0)).count() == 0


def test_pieces_that_share_a_hash(monkeypatch, library):
    """With a broken hash every piece is encoded by itself."""
    monkeypatch.setattr(T, "mix", lambda h: h & np.uint64(3))
    column = pa.array(texts()[:200])
    counts = token_counts.PieceCounts(token_counts.TOKENIZER)
    got = np.concatenate([counts.of(b, o) for _, _, b, o in T.chunks(column)])
    assert got.tolist() == [len(library.encode(t or "", add_special_tokens=False)) for t in texts()[:200]]
