import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from fablens.llm import alignment
from fablens.llm.token_counts import tokenizer_path
from tests.llm.test_tokens import ODD

ODD_TOO = [*ODD, "▁", "<s>", "<0x0A>", "the ", " and", "\x00", "\t", "ing", "，", "ñ", "́"]


def texts():
    r = random.Random(2)
    out = ["".join(r.choice(ODD_TOO) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    words = ["alpha", "beta-gamma", "x_1", "don't", "naïve", "日本", "1234567", "\n", "  "]
    out += [" ".join(r.choice(words) for _ in range(30)) for _ in range(100)]
    return [*out, None, "", " ", "  ", "▁", "same text here", "same text here", "aaaa" * 300]


@pytest.fixture(scope="module")
def libraries():
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(alignment.TOKENIZER_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.TOKENIZER_B))


def brute(rows, libraries):
    a, b = libraries
    of = alignment.unprintable_bytes()
    made, counts = [], Counter()
    for i, t in rows:
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(of[c] for c in a.id_to_token(x)) for x in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        if not t or {b"".join(bytes_a), b"".join(bytes_b)} != {b" " + t.encode()}:
            made.append((i, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        groups, x, y = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            nx, ny = int(np.searchsorted(ends_a, end, "right")), int(np.searchsorted(ends_b, end, "right"))
            groups.append((ids_a[x:nx], ids_b[y:ny]))
            x, y = nx, ny
        links = [(p, q) for p, e in zip(ids_a, ends_a) for q, f in zip(ids_b, ends_b) if e == f]
        counts.update(links)
        made.append((i, ids_a, ids_b, groups, links))
    most = {}
    for (_, q), n in counts.items():
        most[q] = max(most.get(q, 0), n)
    out = []
    for i, ids_a, ids_b, groups, links in made:
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if ids_a else ""
        out.append((str(i), len(ids_a), len(ids_b), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out)


def run(docs, **kw):
    return sorted((str(r[0]), *r[1:]) for r in alignment.cross_alignment(docs, **kw).collect())


@pytest.mark.parametrize("common", [alignment.COMMON, 8])
def test_equals_brute_force(documents, libraries, common):
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())]
    rows += [(3, "twice"), (3, "twice"), (5, "of one id"), (5, "other text")]
    assert run(documents(rows), common=common) == brute(rows, libraries)


def test_nothing_to_align(documents):
    assert run(documents([(1, "x")]).limit(0)) == []
    assert run(documents([(1, None), (2, "▁")])) == [("1", 0, 0, 0, 0, 0, 0, ""), ("2", 0, 0, 0, 0, 0, 0, "")]


def test_parts_encode_as_the_whole(libraries):
    words = alignment.word_pieces(alignment.TOKENIZER_B)
    encoder = alignment.Encoder(words)
    for t in texts():
        data = np.frombuffer((" " + (t or "")).encode(), np.uint8)
        ids, _, whole = encoder.encode(data, np.array([0, len(data)]))
        assert bool(whole[0]) == ("▁" not in (t or ""))
        if t and whole[0]:
            assert ids.tolist() == libraries[1].encode(t)


def test_long_texts_go_through_windows(documents, libraries):
    r = random.Random(9)
    long = " ".join(r.choice(["alpha", "beta,", "naïve", "日本語", "x\ny", "1234 "]) for _ in range(30_000))
    rows = [(1, long), (2, "short"), (3, long + " ▁"), (4, "x" * 9000), (5, long[:50])]
    docs = documents(rows).select("doc_id", "text")
    want = {x[0]: x for x in brute([r for r in rows if r[0] != 1], libraries)}
    kept = {str(r["doc_id"]): r for r in alignment.align(docs, window=1 << 12).collect()}
    plain = {str(r["doc_id"]): r for r in alignment.align(docs).collect()}
    assert {k: (r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"], bytes(r["links"])) for k, r in kept.items()} == {
        k: (r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"], bytes(r["links"])) for k, r in plain.items()
    }
    assert all(kept[k]["groups_sha256"] == w[7] for k, w in want.items())
    assert kept["1"]["n_a"] > 30_000


def test_successor_doubling_labels_components():
    r = random.Random(0)
    for _ in range(200):
        end = r.randrange(1, 60)
        a = np.array(sorted({r.randrange(1, end + 1) for _ in range(20)} | {end}))
        b = np.array(sorted({r.randrange(1, end + 1) for _ in range(20)} | {end}))
        both = np.array(sorted(set(a.tolist()) & set(b.tolist())))
        group_a, group_b = alignment.group_labels(a, b)
        assert group_a.tolist() == np.searchsorted(both, a).tolist()
        assert group_b.tolist() == np.searchsorted(both, b).tolist()


def test_parts_that_share_a_hash(monkeypatch, libraries):
    monkeypatch.setattr(alignment.T, "mix", lambda h: h & np.uint64(3))
    encoder = alignment.Encoder(alignment.word_pieces(alignment.TOKENIZER_B))
    rows = [" " + t for t in texts()[:200] if t and "▁" not in t]
    data = np.frombuffer("".join(rows).encode(), np.uint8)
    ids, firsts, _ = encoder.encode(data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in rows])]))
    assert [ids[x:y].tolist() for x, y in zip(firsts[:-1], firsts[1:])] == [libraries[1].encode(t[1:]) for t in rows]
