"""Byte-level BPE with a memory-mapped lexicon automaton, exact for every text.

The corpus' most frequent pieces (words with their leading white space) are compiled into a minimal acyclic
automaton: equal suffixes share states, and the numbers on the transitions of a piece's path add up to its index in
the table of token ids. Tasks map the file and walk all distinct pieces of a chunk at once. Pieces
that the automaton does not hold are pre-tokenized by the library and merged by rank.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fablens.llm import textarrays as T
from fablens.llm.shipping import local_path, ship_bytes
from fablens.llm.token_counts import TOKENIZER, tokenizer_path
from fablens.sources.shared import discard, materialize

#: Longer pieces stay out of the lexicon.
LEXICON_BYTES = 64
LEXICON_WORDS = 1 << 16
KNOWN_PIECES = 1 << 20
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pre_tokenizer(settings: dict):
    """The library's pre-tokenizer from a file's settings; other kinds than byte-level ones raise."""
    from tokenizers.pre_tokenizers import ByteLevel

    if settings["type"] != "ByteLevel":
        raise ValueError(f"{settings['type']} is not a byte-level pre-tokenizer")
    return ByteLevel(add_prefix_space=settings["add_prefix_space"], use_regex=settings["use_regex"])


class Vocabulary:
    """Tables of a tokenizer file: ids of bytes, merges by hashed pair, and the bytes of every id."""

    def __init__(self, name: str):
        with open(tokenizer_path(name), encoding="utf-8") as file:
            found = json.load(file)
        model, alphabet = found["model"], byte_alphabet()
        vocab = model["vocab"]
        # The library's pre-tokenizer alone: the whole tokenizer would stay in every worker's memory.
        self.split = pre_tokenizer(found["pre_tokenizer"]).pre_tokenize_str
        self.specials = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.byte_ids = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([(vocab[a] << 20) | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        # Open addressing: a quarter full, so that most pairs are settled at the first slot.
        self.bits = max(4, (4 * len(pairs) - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int64)
        self.made = np.zeros(1 << self.bits, np.int64)
        left, at = np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            free = self.slots[at] == -1
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            own = first[free[first]]
            self.slots[at[own]], self.rank[at[own]], self.made[at[own]] = pairs[left[own]], left[own], made[left[own]]
            keep = np.ones(len(left), bool)
            keep[own] = False
            left, at = left[keep], (at[keep] + 1) & ((1 << self.bits) - 1)
        size = max([*vocab.values(), *self.specials.values()]) + 1
        texts = [b""] * size
        for token, i in vocab.items():
            texts[i] = bytes(alphabet[c] for c in token)
        for token, i in self.specials.items():
            texts[i] = token.encode()
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (T.mix(pairs.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair's merge, or -1."""
        pairs = (left << 20) | right
        at = self._slot(pairs)
        out = np.full(len(pairs), -1, np.int64)
        open_ = np.arange(len(pairs))
        while len(open_):
            held = self.slots[at[open_]]
            hit = held == pairs[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (held != -1)]
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of consecutive pre-tokens of ``data``, and how many each has.

        In every step each unfinished pre-token merges all occurrences of its lowest-ranked pair, left to right.
        """
        ids, word = self.byte_ids[data], np.repeat(np.arange(len(lengths)), lengths)
        done_ids, done_words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(ids):
            inner = np.flatnonzero(word[1:] == word[:-1])
            slot = np.full(len(ids), -1, np.int64)
            slot[inner] = self.find(ids[inner], ids[inner + 1])
            rank = np.where(slot >= 0, self.rank[slot], NONE)
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            size = np.diff(np.append(begin, len(word)))
            best = np.repeat(np.minimum.reduceat(rank, begin), size)
            going = best < NONE
            done_ids.append(ids[~going])
            done_words.append(word[~going])
            chosen = going & (rank == best)
            at = np.flatnonzero(chosen)
            # Of a run of overlapping occurrences every second one, from its start, is merged.
            run = np.diff(at, prepend=-2) != 1
            starts = np.repeat(at[run], np.diff(np.append(np.flatnonzero(run), len(at))))
            at = at[(at - starts) % 2 == 0]
            ids[at] = self.made[slot[at]]
            going[at + 1] = False
            ids, word = ids[going], word[going]
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(lengths))

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of whole pieces, special strings included, and how many each has."""
        split, part_of, special, data = self.split, [], [], []
        sizes: list[int] = []
        marks = [s.encode() for s in self.specials]
        for i, piece in enumerate(pieces):
            body = piece[1:] if piece[:1] == b" " else piece
            if body.isalpha() and body.isascii():
                sizes.append(len(piece))
                part_of.append(i)
                special.append(-1)
                data.append(piece)
                continue
            rest = [(piece, -1)]
            for mark in marks:
                if mark in piece:
                    rest = [
                        part
                        for text, known in rest
                        for part in (_around(text, mark, self.specials[mark.decode()]) if known < 0 else [(text, known)])
                    ]
            for text, known in rest:
                own = [0] if known >= 0 else [len(m) for m, _ in split(text.decode())]
                sizes += own
                part_of += [i] * len(own)
                special += [known] * len(own)
                if known < 0:
                    data.append(text)
        sizes, part_of, special = np.array(sizes, np.int64), np.array(part_of, np.int64), np.array(special, np.int64)
        ids, counts = self.merge(np.frombuffer(b"".join(data), np.uint8), sizes)
        if (special >= 0).any():
            places = np.cumsum(counts) - counts
            ids = np.insert(ids, places[special >= 0], special[special >= 0])
            counts = np.where(special >= 0, 1, counts)
        return ids, np.bincount(part_of, counts, len(pieces)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of a run of ids."""
        return self.bytes[T.gather(self.begins[ids], self.lengths[ids])]


def _around(text: bytes, mark: bytes, known: int) -> list[tuple[bytes, int]]:
    out: list[tuple[bytes, int]] = []
    for i, part in enumerate(text.split(mark)):
        out += [(mark, known)] * (i > 0) + [(part, -1)] * bool(part)
    return out


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(name: str) -> Vocabulary:
    if name not in _vocabularies:
        _vocabularies[name] = Vocabulary(name)
    return _vocabularies[name]


class Lexicon:
    """The minimal automaton as flat arrays: sorted transitions, their numbers, final states, ids by index."""

    FIELDS = ("keys", "targets", "numbers", "final", "first", "ids")
    TYPES = (np.int64, np.int32, np.int32, np.int64, np.int64, np.int32)

    def __init__(self, *arrays: np.ndarray):
        for name, array in zip(self.FIELDS, arrays):
            setattr(self, name, array)

    @classmethod
    def compile(cls, words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> Lexicon:
        """Compile distinct words in byte order; ``counts[i]`` of ``ids`` belong to word i."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((byte, target), ...)), children before parents
        path: list[list] = [[False, []]]  # unfinished states along the last word

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        def close(depth: int, word: bytes) -> None:
            while len(path) > depth + 1:
                done = freeze(path.pop())
                path[-1][1].append((word[len(path) - 1], done))

        last = b""
        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            close(common, last)
            path.extend([False, []] for _ in word[common:])
            path[-1][0] = True
            last = word
        close(0, last)
        root = freeze(path[0])
        below = []  # accepted words from each state on
        for final, moves in states:
            below.append(int(final) + sum(below[t] for _, t in moves))
        # The root becomes state 0; the others keep their order after it.
        place = {root: 0} | {s: i + 1 for i, s in enumerate(s for s in range(len(states)) if s != root)}
        rows = []
        for s, (final, moves) in enumerate(states):
            number = int(final)
            for byte, target in moves:
                rows.append((place[s] << 8 | byte, place[target], number))
                number += below[target]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        final = np.zeros(len(states), np.int64)
        for s, (is_final, _) in enumerate(states):
            final[place[s]] = is_final
        first = np.concatenate([[0], np.cumsum(counts)])
        arrays = (table[:, 0], table[:, 1], table[:, 2], final, first, ids)
        return cls(*[a.astype(t) for a, t in zip(arrays, cls.TYPES)])

    def to_bytes(self) -> bytes:
        arrays = [getattr(self, f) for f in self.FIELDS]
        head = np.array([len(a) for a in arrays], np.int64)
        return b"".join([head.tobytes(), *[a.tobytes() + bytes(-a.nbytes % 8) for a in arrays]])

    @classmethod
    def map(cls, path: str) -> Lexicon:
        """Views of the memory-mapped file; all processes of a machine share its pages."""
        held = np.memmap(path, np.uint8, "r")
        sizes = held[: 8 * len(cls.FIELDS)].view(np.int64)
        at, arrays = 8 * len(cls.FIELDS), []
        for n, kind in zip(sizes, cls.TYPES):
            width = int(n) * np.dtype(kind).itemsize
            arrays.append(held[at : at + width].view(kind))
            at += width + -width % 8
        return cls(*arrays)

    def index(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Index of each byte range in the lexicon, or -1; all ranges walk side by side."""
        out = np.full(len(starts), -1, np.int64)
        state, number = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        active, depth = np.arange(len(starts)), 0
        while len(active) and len(self.keys):
            over = lengths[active] == depth
            ended = active[over]
            ended = ended[self.final[state[ended]] > 0]
            out[ended] = number[ended]
            active = active[~over]
            key = state[active] << 8 | buffer[starts[active] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            active, at = active[hit], at[hit]
            number[active] += self.numbers[at]
            state[active] = self.targets[at]
            depth += 1
        return out


class Encoder:
    """Encodes chunks; remembers a task's pieces as ranges of one id store."""

    def __init__(self, words: Vocabulary, lexicon: Lexicon):
        self.words, self.lexicon = words, lexicon
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = [np.asarray(self.lexicon.ids, np.int32)]
        self.stored = len(self.lexicon.ids)

    def _fresh(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of new pieces are in the store: the lexicon's, or merged and appended."""
        at = self.lexicon.index(buffer, starts, ends - starts)
        first = np.asarray(self.lexicon.first)
        start, length = first[np.maximum(at, 0)], np.diff(first, append=first[-1])[np.maximum(at, 0)]
        rare = np.flatnonzero(at < 0)
        if len(rare):
            data = buffer.tobytes()
            pieces = [data[a:b] for a, b in zip(starts[rare].tolist(), ends[rare].tolist())]
            ids, counts = self.words.encode_pieces(pieces)
            start[rare], length[rare] = self.stored + np.cumsum(counts) - counts, counts
            self.store.append(ids.astype(np.int32))
            self.stored += len(ids)
        return start, length

    def encode(self, buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a chunk and each row's first."""
        starts, firsts = T.pieces(buffer, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(buffer))
        keys, checks = T.piece_hashes(buffer, starts)
        unique, first, codes = np.unique(keys, return_index=True, return_inverse=True)
        if not np.array_equal(checks[first][codes], checks):  # two pieces share a hash: take each by itself
            unique, first, codes = np.arange(len(keys), dtype=np.uint64), np.arange(len(keys)), np.arange(len(keys))
            start, length = self._fresh(buffer, starts, ends)
        else:
            if len(self.keys) > KNOWN_PIECES:
                self.clear()
            at = np.searchsorted(self.keys, unique)
            known = np.zeros(len(unique), bool)
            inside = at < len(self.keys)
            known[inside] = (self.keys[at[inside]] == unique[inside]) & (self.checks[at[inside]] == checks[first[inside]])
            start, length = np.zeros(len(unique), np.int64), np.zeros(len(unique), np.int64)
            start[known], length[known] = self.start[at[known]], self.length[at[known]]
            new = ~known
            start[new], length[new] = self._fresh(buffer, starts[first[new]], ends[first[new]])
            self.keys = np.insert(self.keys, at[new], unique[new])
            self.checks = np.insert(self.checks, at[new], checks[first[new]])
            self.start = np.insert(self.start, at[new], start[new])
            self.length = np.insert(self.length, at[new], length[new])
        if len(self.store) > 1:
            self.store = [np.concatenate(self.store)]
        counts = length[codes]
        ids = self.store[0][T.gather(start[codes], counts)]
        return ids, np.concatenate([[0], np.cumsum(counts)])[firsts]


def frequent_words(docs: DataFrame, text_col: str, words: int) -> list[bytes]:
    """About ``words`` pieces that are the most frequent in all texts, in byte order.

    Counted exactly over the corpus. The cut is a count class, so that neither a sort nor a
    count of the whole vocabulary meets in one place; of the class at the cut a share is taken by hash. Pieces above
    ``LEXICON_BYTES`` bytes are neither counted nor held: the lexicon has at most about ``words`` times that size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (np.zeros(0, np.uint64), np.zeros(0, np.int64), [])

        def out(keys, counts, texts):
            return pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(counts)], names=["word", "n"])

        for batch in batches:
            for _, _, buffer, offsets in T.chunks(batch.column(0)):
                starts, _ = T.pieces(buffer, offsets)
                if not len(starts):
                    continue
                ends, data = np.append(starts[1:], len(buffer)), buffer.tobytes()
                short = ends - starts <= LEXICON_BYTES
                hashes = T.piece_hashes(buffer, starts)[0][short]
                starts, ends = starts[short], ends[short]
                unique, first, n = np.unique(hashes, return_index=True, return_counts=True)
                keys, counts, texts = held
                at = np.searchsorted(keys, unique)
                known = np.zeros(len(unique), bool)
                known[at < len(keys)] = keys[at[at < len(keys)]] == unique[at < len(keys)]
                counts[at[known]] += n[known]
                new = first[~known]
                order = np.concatenate([keys, unique[~known]]).argsort(kind="stable")
                texts = texts + [data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
                held = (
                    np.concatenate([keys, unique[~known]])[order],
                    np.concatenate([counts, n[~known]])[order],
                    [texts[i] for i in order.tolist()],
                )
                if len(held[0]) > KNOWN_PIECES:
                    yield out(*held)
                    held = (np.zeros(0, np.uint64), np.zeros(0, np.int64), [])
        yield out(*held)

    counted = materialize(
        docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts"
    )
    classes = counted.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("class")).agg(F.count("*").alias("words"))
    above, left, share = None, words, 0.0
    for row in sorted(classes.collect(), key=lambda r: -r["class"]):  # at most 16 * 63 classes
        above = row["class"]
        if row["words"] > left:
            share = left / row["words"]
            break
        left, share = left - row["words"], 1.0
    found = []
    if above is not None:
        place = F.floor(F.log2("n") * 16).cast("int")
        some = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
        frequent = counted.filter((place > above) | ((place == above) & some))
        found = sorted(bytes(r["word"]) for r in frequent.select("word").collect())
    discard(counted)
    return found


def build_lexicon(docs: DataFrame, text_col: str, tokenizer: str = TOKENIZER, words: int = LEXICON_WORDS) -> Lexicon:
    found = frequent_words(docs, text_col, words)
    ids, counts = vocabulary(tokenizer).encode_pieces(found)
    return Lexicon.compile(found, ids, counts)


def encode_and_decode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """``id``, ``n_tokens``, ``token_ids`` (little-endian unsigned 32-bit) and ``decoded`` of every row.

    The ids are those of the library without added special tokens, truncation or padding; special
    strings inside texts become their ids. ``decoded`` is the text of the ids; bytes that are not
    UTF-8 become replacement characters. A null text counts as empty. Null and repeated ids
    stay as they are; an empty table gives no rows; other columns are not read.
    A very long text is worked whole, as one chunk, in about 30 times its size of memory.
    """
    lexicon = build_lexicon(docs, text_col, tokenizer, lexicon_words)
    name = ship_bytes(docs.sparkSession, "lexicon", lexicon.to_bytes())
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer)
        encoder = Encoder(words, Lexicon.map(local_path(name)))
        for batch in batches:
            for at, end, buffer, offsets in T.chunks(batch.column(1)):
                ids, firsts = encoder.encode(buffer, offsets)
                data = ids.astype("<u4").tobytes()
                text, ends = words.decode(ids), np.concatenate([[0], np.cumsum(words.lengths[ids])])[firsts]
                encoded = [data[4 * a : 4 * b] for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
                raw = text.tobytes()
                decoded = [raw[a:b].decode(errors="replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(np.diff(firsts)), pa.array(encoded, pa.binary()), pa.array(decoded, pa.string())],
                    names=[id_col, "n_tokens", "token_ids", "decoded"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        encode, f"`{id_col}` {kind}, n_tokens long, token_ids binary, decoded string"
    )
