"""Cross-tokenizer alignment: groups of tokens of two tokenizers between the byte offsets where both end a token.

Tokens of A and B overlap; a group is a component of that overlap. Every token points to its farthest-right overlapping token of the
other side (a token that reaches as far as any is terminal), and the pointers are doubled over all tokens of a chunk at once until
each holds its component's terminal token, which labels the group.

The texts are encoded by the libraries, but in parts cut where no token can span, and equal parts of a task only once.
Links (the two tokens that end a group together) are counted corpus-wide by id pair: first within tasks, then by pair. Pairs with at least
``1 / COMMON`` of all links, of which there are at most ``COMMON``, are sent to all tasks; only links of rarer pairs meet their
counts through a shuffle, so no key is hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.llm.token_counts import tokenizer_path
from fablens.sources.shared import materialize

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
COMMON = 1 << 18
KNOWN_PARTS = 1 << 20
BATCH_BYTES = 1 << 16
HELD_PAIRS = 1 << 21
WORD_JOINT = "▁"


def unprintable_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 itself, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """The bytes of every token, the encoder of a list of texts, and where a text may be cut."""

    def __init__(self, entries: list[bytes], encode: Callable[[list[str]], list], cuts: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        self.encode, self.cuts = encode, cuts
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        digits = [str(i).encode() for i in range(len(entries))]
        self.digit_sizes = np.array([len(d) for d in digits], np.int64)
        self.digit_begins = np.cumsum(self.digit_sizes) - self.digit_sizes
        self.digits = np.frombuffer(b"".join(digits), np.uint8)


@lru_cache(maxsize=2)
def byte_level(name: str) -> Vocabulary:
    """A byte-level vocabulary of the tokenizers library; special strings are plain text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path(name))
    found.no_padding()
    found.no_truncation()
    found.encode_special_tokens = True
    of = unprintable_bytes()
    entries = [bytes(of[c] for c in e) if all(c in of for c in e) else b"" for e in (found.id_to_token(i) or "" for i in range(found.get_vocab_size()))]
    return Vocabulary(entries, lambda texts: [e.ids for e in found.encode_batch_fast(texts, add_special_tokens=False)], lambda buffer, offsets: T.pieces(buffer, offsets)[0])


@lru_cache(maxsize=2)
def word_pieces(name: str) -> Vocabulary:
    """A sentencepiece BPE vocabulary, fed with the leading space that it would add itself.

    Two characters that stand side by side in no piece are never merged, so a text may be cut between them.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(tokenizer_path(name), "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("only a model that adds a space and changes nothing else can be fed in parts")
    spec.add_dummy_prefix = False
    found = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    entries, beside = [], set()
    for i in range(found.get_piece_size()):
        piece = found.id_to_piece(i)
        if found.is_byte(i):
            entries.append(bytes([int(piece[3:5], 16)]))
            continue
        text = piece.replace(WORD_JOINT, " ")
        entries.append(text.encode())
        beside.update(zip(text, text[1:]))
    pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in beside), np.int64)
    ascii_pairs = np.zeros((128, 128), bool)
    for a, b in beside:
        if a < "\x80" and b < "\x80":
            ascii_pairs[ord(a), ord(b)] = True

    def cuts(buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(buffer) + 1, bool)
        plain = buffer < 0x80
        if len(buffer) and plain.all():
            cut[1:-1] = ~ascii_pairs[buffer[:-1], buffer[1:]]
        elif len(buffer):
            code = np.frombuffer(buffer.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
            at = np.flatnonzero((buffer & 0xC0) != 0x80)
            pair = code[:-1] << 21 | code[1:]
            both = (code[:-1] < 128) & (code[1:] < 128)
            known = np.zeros(len(pair), bool)
            known[both] = ascii_pairs[code[:-1][both], code[1:][both]]
            other = pair[~both]
            known[~both] = pairs[np.minimum(np.searchsorted(pairs, other), len(pairs) - 1)] == other
            cut[at[1:][~known]] = True
        cut[offsets[:-1]] = True
        cut[-1] = False
        return np.flatnonzero(cut)

    return Vocabulary(entries, lambda texts: found.encode(texts, num_threads=1), cuts)


class Encoder:
    """Token ids of texts, encoded by parts; parts seen before in the task come from memory."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.whole = np.zeros(0, bool)
        self.ids = np.zeros(0, np.int64)

    def _library(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and number of ids of each part, and whether they give the part's bytes again."""
        sizes, data = ends - starts, buffer.tobytes()
        done, out, at = np.cumsum(sizes), [], 0
        while at < len(starts):
            end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + BATCH_BYTES, "right")))
            out += self.words.encode([data[a:b].decode() for a, b in zip(starts[at:end].tolist(), ends[at:end].tolist())])
            at = end
        counts = np.array([len(o) for o in out], np.int64)
        ids = np.fromiter((i for o in out for i in o), np.int64, int(counts.sum()))
        firsts = np.concatenate([[0], np.cumsum(counts)])
        total = T.row_sums(self.words.sizes[ids], firsts)
        whole = total == sizes
        fits = np.repeat(whole, counts)
        mine = self.words.data[T.gather(self.words.begins[ids[fits]], self.words.sizes[ids[fits]])]
        same = mine == buffer[T.gather(starts[whole], sizes[whole])]
        whole[whole] = T.row_sums(~same, np.concatenate([[0], np.cumsum(sizes[whole])])) == 0
        return ids, counts, whole

    def encode(self, buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all rows, each row's first, and whether the row's tokens give its bytes again."""
        rows = len(offsets) - 1
        if not len(buffer):
            return np.zeros(0, np.int64), np.zeros(rows + 1, np.int64), np.ones(rows, bool)
        starts = self.words.cuts(buffer, offsets)
        ends = np.append(starts[1:], len(buffer))
        firsts = np.searchsorted(starts, offsets)
        keys, checks = T.piece_hashes(buffer, starts)
        unique, first, codes = np.unique(keys, return_index=True, return_inverse=True)
        if not np.array_equal(checks[first][codes], checks):  # two parts share a hash: encode each by itself
            ids, counts, whole = self._library(buffer, starts, ends)
        else:
            place = self._places(buffer, starts, ends, unique, checks[first], first)[codes]
            counts, whole = self.counts[place], self.whole[place]
            ids = self.ids[T.gather(self.begins[place], counts)]
        firsts_ids = np.concatenate([[0], np.cumsum(counts)])[firsts]
        return ids, firsts_ids, T.row_sums(~whole, firsts) == 0

    def _places(self, buffer, starts, ends, unique, checks, first) -> np.ndarray:
        """Where the parts are held; new ones are encoded and added."""
        if len(self.keys) > KNOWN_PARTS or len(self.ids) > 4 * KNOWN_PARTS:
            self.clear()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = (self.keys[at[inside]] == unique[inside]) & (self.checks[at[inside]] == checks[inside])
        fresh = ~known
        if fresh.any():
            new = first[fresh]
            ids, counts, whole = self._library(buffer, starts[new], ends[new])
            begins = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, ids])
            for name, values in (("keys", unique[fresh]), ("checks", checks[fresh]), ("begins", begins), ("counts", counts), ("whole", whole)):
                setattr(self, name, np.insert(getattr(self, name), at[fresh], values))
            at = np.searchsorted(self.keys, unique)
            at += self.checks[at] != checks  # an older part of the same hash stands beside it
        return at


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B (by rising byte ends), the number of its group."""
    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)  # the token of B that holds A's last byte
    to_a = np.searchsorted(ends_a, ends_b)
    here = np.arange(n)
    # A token of A that ends where one of B ends is terminal.
    heads = np.where(ends_b[to_b] > ends_a, n + to_b, here)
    points = np.concatenate([heads, to_a])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    terminal = np.cumsum(points[:n] == here) - 1
    labels = terminal[points]
    return labels[:n], labels[n:]


def written_groups(a: Vocabulary, b: Vocabulary, ids_a, ids_b, group_a, group_b) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` over all groups as bytes, and where each group's text begins."""
    if not len(ids_a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    groups = int(group_a[-1]) + 1
    at_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
    at_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    total = len(ids_a) + len(ids_b)
    size, begin, mark = np.empty(total, np.int64), np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    size[at_a], size[at_b] = a.digit_sizes[ids_a], b.digit_sizes[ids_b]
    begin[at_a], begin[at_b] = a.digit_begins[ids_a], b.digit_begins[ids_b] + len(a.digits)
    last_a = np.append(np.flatnonzero(np.diff(group_a)), len(group_a) - 1)
    last_b = np.append(np.flatnonzero(np.diff(group_b)), len(group_b) - 1)
    mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
    ends = np.cumsum(size + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    digits = np.concatenate([a.digits, b.digits])
    out[T.gather(ends - size - 1, size)] = digits[T.gather(begin, size)]
    out[ends - 1] = mark
    return out, np.concatenate([[0], ends[at_b[last_b]]])[: groups + 1]


def _with_spaces(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before every text that is not empty."""
    full = np.diff(offsets) > 0
    spaced = np.insert(buffer, offsets[:-1][full], 0x20)
    return spaced, offsets + np.concatenate([[0], np.cumsum(full)])


def _windows(buffer: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A long text in parts, cut before spaces behind a visible ASCII character, where all tokens of both sides end."""
    at = 0
    while len(buffer) - at > 2 * size:
        here, end = at + size, None
        while here < len(buffer) and end is None:
            part = buffer[here : here + size]
            cut = np.flatnonzero((part[1:] == 0x20) & (part[:-1] > 0x20) & (part[:-1] < 0x7F))
            end = here + 1 + int(cut[0]) if len(cut) else None
            here += size - 1
        if end is None:
            break
        yield buffer[at:end]
        at = end
    yield buffer[at:]


class Aligner:
    """Groups of the rows of a chunk."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = Encoder(a), Encoder(b)

    def rows(self, buffer: np.ndarray, offsets: np.ndarray):
        """Per row: whether it has tokens, numbers of tokens of A and B and of groups; then group texts with their bounds, link codes, and each row's first group."""
        ids_a, first_a, whole_a = self.a.encode(buffer, offsets)
        ids_b, first_b, whole_b = self.b.encode(buffer, offsets)
        good = whole_a & whole_b & (np.diff(offsets) > 0)
        n_a, n_b = np.where(good, np.diff(first_a), 0), np.where(good, np.diff(first_b), 0)
        ids_a = ids_a[T.gather(first_a[:-1], n_a)]
        ids_b = ids_b[T.gather(first_b[:-1], n_b)]
        # Rows without tokens take no bytes, so that all ends rise through the chunk.
        ends_a, ends_b = np.cumsum(self.a.words.sizes[ids_a]), np.cumsum(self.b.words.sizes[ids_b])
        if not len(ids_a):
            none = np.zeros(len(n_a) + 1, np.int64)
            return good, n_a, n_b, np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.uint64), none
        group_a, group_b = group_labels(ends_a, ends_b)
        text, bounds = written_groups(self.a.words, self.b.words, ids_a, ids_b, group_a, group_b)
        last_a = np.append(np.flatnonzero(np.diff(group_a)), len(group_a) - 1)
        last_b = np.append(np.flatnonzero(np.diff(group_b)), len(group_b) - 1)
        links = (ids_a[last_a] * len(self.b.words.sizes) + ids_b[last_b]).astype(np.uint64)
        groups = np.append(group_a, len(last_a))[np.concatenate([[0], np.cumsum(n_a)])]
        return good, n_a, n_b, text, bounds, links, groups


def _narrow(a: Vocabulary, b: Vocabulary) -> str:
    return "<u4" if len(a.sizes) * len(b.sizes) <= 1 << 32 else "<u8"


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, window: int = T.CHUNK_BYTES) -> DataFrame:
    """``key`` (a row number), the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256`` and ``links`` of every row.

    ``links`` holds the codes (A id times size of B's vocabulary, plus B id) of the links in their order, as little-endian unsigned numbers. See
    ``cross_alignment`` for odd rows. A text longer than ``window`` bytes is worked in windows, so memory does not follow it; only
    a stretch without any space behind a visible ASCII character stays in one.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(tokenizer_a), word_pieces(tokenizer_b)
        aligner, narrow = Aligner(a, b), _narrow(a, b)
        for batch in batches:
            for begin, end, buffer, offsets in T.chunks(batch.column(2), window):
                buffer, offsets = _with_spaces(buffer, offsets)
                if end - begin == 1 and len(buffer) > 2 * window:
                    digest, n, links, good = hashlib.sha256(), np.zeros(3, np.int64), [], True
                    for part in _windows(buffer, window):
                        fine, n_a, n_b, text, bounds, found, _ = aligner.rows(part, np.array([0, len(part)]))
                        good &= bool(fine[0])
                        n += (int(n_a[0]), int(n_b[0]), len(found))
                        digest.update((b";" if links and len(found) else b"") + text[:-1].tobytes())
                        links.append(found.astype(narrow).tobytes())
                    out = [n[:1], n[1:2], n[2:], [digest.hexdigest()], [b"".join(links)]] if good else [[0], [0], [0], [""], [b""]]
                else:
                    good, n_a, n_b, text, bounds, found, groups = aligner.rows(buffer, offsets)
                    data, cut, codes = text.tobytes(), bounds[groups].tolist(), found.astype(narrow)
                    shas = [hashlib.sha256(data[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(cut[:-1], cut[1:])]
                    out = [n_a, n_b, np.diff(groups), shas, [codes[x:y].tobytes() for x, y in zip(groups[:-1], groups[1:])]]
                rows = [batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin)]
                counts = [pa.array(c, pa.int64()) for c in (out[0], out[1], out[2], out[2])]
                names = ["key", id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
                yield pa.RecordBatch.from_arrays([*rows, *counts, pa.array(out[3], pa.string()), pa.array(out[4], pa.binary())], names=names)

    numbered = docs.select(F.monotonically_increasing_id().alias("key"), id_col, text_col)
    return numbered.mapInArrow(work, f"key long, `{id_col}` {kind}, {ALIGNED}")


def pair_counts(aligned: DataFrame, size_b: int, narrow: str) -> DataFrame:
    """``code``, ``n`` and ``best`` (whether no pair with the same B id has more links) of every id pair that is linked."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for batch in batches:
            links = np.frombuffer(b"".join(batch.column(0).to_pylist()), narrow).astype(np.int64)
            new, n = np.unique(links, return_counts=True)
            all_codes, place = np.unique(np.concatenate([codes, new]), return_inverse=True)
            total = np.zeros(len(all_codes), np.int64)
            np.add.at(total, place, np.concatenate([counts, n]))
            codes, counts = all_codes, total
            if len(codes) > HELD_PAIRS:
                yield out()
                codes, counts = codes[:0], counts[:0]
        yield out()

    counted = aligned.select("links").mapInArrow(partial, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "pair-counts")
    most = materialize(counted.groupBy((F.col("code") % size_b).alias("b")).agg(F.max("n").alias("most")), "best-pairs")
    joined = counted.join(most, counted["code"] % size_b == most["b"])
    return materialize(joined.select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def cross_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, common: int = COMMON) -> DataFrame:
    """The id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row.

    A null or empty text, and one whose tokens on either side do not join to a space and the text (it holds U+2581), has no tokens:
    zeros and an empty digest. Repeated rows and null ids stay as they are, each with links of its own; an empty
    table gives no rows; other columns are not read. ``count_sum`` adds, over the row's links, how many links of
    the whole table have the same id pair; ``n_best`` counts its links whose pair is the most frequent (ties included) of its B id.
    """
    spark = docs.sparkSession
    a, b = byte_level(tokenizer_a), word_pieces(tokenizer_b)
    narrow = _narrow(a, b)
    aligned = materialize(align(docs, id_col, text_col, tokenizer_a, tokenizer_b), "aligned")
    counted = pair_counts(aligned, len(b.sizes), narrow)
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # At most ``common`` pairs can have a share of 1 / common each.
    heavy = counted.filter(F.col("n") * common >= total).toArrow().sort_by("code")
    sent = spark.sparkContext.broadcast(tuple(heavy.column(c).to_numpy() for c in ("code", "n", "best")))

    def known(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        held = sent.value[0]
        at = np.minimum(np.searchsorted(held, codes), max(len(held) - 1, 0))
        return at, held[at] == codes if len(held) else np.zeros(len(codes), bool)

    def links_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data = column.to_pylist()
        codes = np.frombuffer(b"".join(data), narrow).astype(np.int64)
        return codes, np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64) // np.dtype(narrow).itemsize

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, firsts = links_of(batch.column("links"))
            at, found = known(codes)
            n, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
            n[found], best[found] = sent.value[1][at[found]], sent.value[2][at[found]]
            kept = [batch.column(c) for c in batch.schema.names if c != "links"]
            names = [c for c in batch.schema.names if c != "links"]
            sums = [pa.array(T.row_sums(best, firsts)), pa.array(T.row_sums(n, firsts))]
            yield pa.RecordBatch.from_arrays([*kept, *sums], names=[*names, "best_common", "sum_common"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, firsts = links_of(batch.column(1))
            row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
            mine = ~known(codes)[1]
            both, times = np.unique(np.stack([row[mine], codes[mine]]), axis=1, return_counts=True)
            keys = batch.column(0).to_numpy()[both[0]]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(both[1]), pa.array(times)], names=["key", "code", "times"])

    kept = [c for c in aligned.columns if c != "links"]
    fields = ", ".join(f"`{c}` {t}" for c, t in aligned.dtypes if c != "links")
    first = aligned.mapInArrow(frequent, f"{fields}, best_common long, sum_common long")
    seldom = aligned.select("key", "links").mapInArrow(rare, "key long, code long, times long")
    sums = seldom.join(counted, "code").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_rare"), F.sum(F.col("times") * F.col("n")).alias("sum_rare")
    )
    whole = lambda kind: F.col(f"{kind}_common") + F.coalesce(f"{kind}_rare", F.lit(0).cast("long"))
    out = first.join(materialize(sums, "rare-links"), "key", "left")
    return out.select(f"`{id_col}`", "n_a", "n_b", "n_groups", "n_links", whole("best").alias("n_best"), whole("sum").alias("count_sum"), "groups_sha256")
