"""Byte-level BPE by a backtracking encoder, decoding by an offset table (operator 4).

A piece of text (what the pre-tokenizer's pattern cuts out) is encoded from the
left with the longest vocabulary token at each place, which an Aho-Corasick
automaton over all tokens finds (leftmost longest match from that place).
A token may follow another only if the pair is compatible: merging the two
tokens' bytes by the vocabulary's ranks gives just these two. If it isn't, the
next shorter token is tried, and if none is left the encoder steps back one
token; a bit for each place says that nothing fits from there, so each place is
left at most once and the time is linear in the piece's length. The result is
the sequence that merging by rank gives.

Pieces that a worker doesn't remember are encoded together, those of a slice of
texts at a time: each takes the same steps, a step of all of them being a few
array operations.

Decoding copies the bytes of all ids of a text with one gather from the
vocabulary's bytes by a table of offsets.

Ids are kept as packed little-endian unsigned 32-bit integers, four bytes a
token. Defined cases: null text encodes as empty, empty text as no ids; bytes
that aren't UTF-8 decode to U+FFFD; repeated rows encode alike; the special
token's string in a text becomes its id, as the tokenizers library does it.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from grist.llm.common import release_memory

#: The pattern of byte-level pre-tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_PIECES = 150_000          # distinct pieces, and words, that a worker remembers
CACHE_LENGTH = 64               # longer ones are encoded anew
CACHE_PAIRS = 100_000
CACHE_PAIR_BITS = 18            # of the number of judged pairs that steps of many pieces remember
FEW = 16                        # so many pieces aren't worth common steps
SLICE = 1 << 20                 # characters of texts whose pieces are encoded together; a longer text goes by itself
DOUBLE_BLANK = re.compile(r"\s\s")


def printable_bytes() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: the
    byte's own where Latin-1 prints it, else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tables for encoding and decoding, from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError(f"{path}: unsupported pre-tokenizer options")
        to_byte = printable_bytes()
        self.token = {i: bytes(to_byte[c] for c in s) for s, i in spec["model"]["vocab"].items()}
        self.id = {b: i for i, b in self.token.items()}
        self.special = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError(f"{path}: unsupported added token {t['content']!r}")
            self.special[t["content"]] = t["id"]
            self.token.setdefault(t["id"], t["content"].encode())
        # merges: (left, right) -> (rank, merged); each merged token's parts and rank
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = (self.id[bytes(to_byte[c] for c in x)] for x in (a, b))
            made = self.id[self.token[left] + self.token[right]]
            self.merge[left, right] = rank, made
            self.parts.setdefault(made, (left, right, rank))
        # a token that merging its own bytes never gives can't be chosen
        self.pairs: dict[tuple[int, int], bool] = {}
        for made, (left, right, _) in sorted(self.parts.items(), key=lambda x: x[1][2]):
            own = self.merge.pop((left, right))
            if self.token[left] not in self.id or self.token[right] not in self.id or not self._compatible(left, right):
                del self.id[self.token[made]]
            self.merge[left, right] = own
        # the longest token that is a proper prefix of each token
        self.shorter = [-1] * (max(self.token) + 1)
        self.automaton = ahocorasick.Automaton()
        for b, i in self.id.items():
            n = len(b) - 1
            while n and b[:n] not in self.id:
                n -= 1
            if n:
                self.shorter[i] = self.id[b[:n]]
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        size = max(self.token) + 1
        lengths = np.zeros(size, np.int64)
        for i, b in self.token.items():
            lengths[i] = len(b)
        self.lengths = lengths
        self.offsets = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(size)), np.uint8)
        self.sizes = lengths.tolist()
        self.window = int(lengths.max())
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        # the same tables for many pieces at once
        self.trie, self.followers = Trie(self.id), np.array(self.shorter, np.int64)
        self.ranks = Table(np.fromiter((a << 32 | b for a, b in self.merge), np.int64, len(self.merge)),
                           np.fromiter((rank for rank, _ in self.merge.values()), np.int64, len(self.merge)))
        self.undone = np.full((size, 3), -1)
        self.undone[list(self.parts)] = list(self.parts.values())
        self.judged, self.fits = np.full(1 << CACHE_PAIR_BITS, -1), np.zeros(1 << CACHE_PAIR_BITS, bool)
        self.pieces, self.words = Pieces(self), Words(self)
        self.cut = regex.compile(PATTERN)
        self.cut_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves a border between the two tokens.

        Both tokens are unmerged step by step, the one made by the later merge
        first, down to the two single bytes at the border. Just before a step was
        taken, a merge across the border was open to the merger if the tokens
        facing each other there form a pair of lower rank (leftmost first among
        equal ranks).
        """
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        found = self.pairs[left, right] = self._compatible(left, right)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        # (rank, side): the merge undone last; side 0 stands left of the border, so it came first among equals
        none = len(self.merge)
        bound = (none, 1)
        while True:
            across = self.merge.get((a, b))
            if across is not None and (across[0], 0) < bound:
                # a merge across the border would have come before those undone so far
                return False
            pa_, pb = self.parts.get(a), self.parts.get(b)
            if pa_ is None and pb is None:
                return True
            if pb is None or pa_ is not None and pa_[2] > pb[2]:
                bound, a = (pa_[2], 0), pa_[1]
            else:
                bound, b = (pb[2], 1), pb[0]

    def encode_piece(self, piece: bytes) -> bytes:
        """The packed ids of one piece."""
        n = len(piece)
        text = piece.decode("latin-1")
        longest, sizes, shorter, pairs, window = self.automaton.iter_long, self.sizes, self.shorter, self.pairs, self.window
        fits = None                     # made only if a place proves wrong
        out: list[int] = []
        at = 0
        token = next(longest(text[:window]))[1]
        while True:
            while token >= 0:
                end = at + sizes[token]
                if fits is None or fits[end]:
                    if not out:
                        break
                    ok = pairs.get((out[-1], token))
                    if ok is None:
                        ok = self.compatible(out[-1], token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at == n:
                    return b"".join([self.packed[t] for t in out])
                # single bytes are tokens, so the leftmost longest match starts right here
                token = next(longest(text[at:at + window]))[1]
            else:                       # nothing fits from here: step back
                if fits is None:
                    fits = bytearray(b"\x01") * (n + 1)
                fits[at] = 0
                back = out.pop()
                at -= sizes[back]
                token = shorter[back]

    def compatible_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`compatible` of many pairs, the latest ones remembered."""
        code = a << 32 | b
        slot = spread(code, CACHE_PAIR_BITS)
        found = self.fits[slot]
        new = np.nonzero(self.judged[slot] != code)[0]
        if len(new):
            a, b, none = a[new], b[new], len(self.merge)
            out, lane = np.zeros(len(new), bool), np.arange(len(new))
            rank, side = np.full(len(new), none), np.ones(len(new), np.int64)
            while len(lane):            # the steps of _compatible
                across = self.ranks.get(a << 32 | b)
                on = ~((across >= 0) & ((across < rank) | (across == rank) & (side > 0)))
                lane, a, b = lane[on], a[on], b[on]
                left, right = self.undone[a, 2], self.undone[b, 2]      # ranks, -1 of single bytes
                over = (left < 0) & (right < 0)
                out[lane[over]] = True
                lane, a, b, left, right = (x[~over] for x in (lane, a, b, left, right))
                first = left > right
                rank, side = np.where(first, left, right), np.where(first, 0, 1)
                a, b = np.where(first, self.undone[a, 1], a), np.where(first, b, self.undone[b, 0])
            found[new], self.judged[slot[new]], self.fits[slot[new]] = out, code[new], out
        return found

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """:meth:`encode_piece` of many pieces: all take each of its steps together."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        at = ends - sizes
        text = np.frombuffer(b"".join(pieces), np.uint8)
        longest = self.trie.longest(text, np.repeat(ends, sizes))
        fits = np.ones(len(text) + 1, bool)
        chosen = np.full(len(text), -1)             # the token that starts at each place
        before = np.full(len(text) + 1, -1)         # the place of the token that ends there
        which, token = np.arange(len(pieces)), longest[at]
        while len(which) > FEW:
            end, stop, back = at + self.lengths[token], ends[which], before[at]
            ok = (end == stop) | fits[end]
            pair = np.nonzero(ok & (back >= 0))[0]
            ok[pair] = self.compatible_pairs(chosen[back[pair]], token[pair])
            chosen[at[ok]] = token[ok]
            more = ok & (end < stop)
            before[end[more]] = at[more]
            token = np.where(more, longest[np.where(more, end, 0)], self.followers[token])
            at, on = np.where(more, end, at), ~ok | more
            which, at, token = which[on], at[on], token[on]
            while len(lost := np.nonzero(token < 0)[0]):        # nothing fits from here: step back
                place = at[lost]
                fits[place] = False
                at[lost] = before[place]
                token[lost] = self.followers[chosen[at[lost]]]
        singly = which.tolist()
        which = np.setdiff1d(np.arange(len(pieces)), which)
        at, owners, tokens = (ends - sizes)[which], [which[:0]], [which[:0]]
        while len(which):
            owners.append(which)
            tokens.append(chosen[at])
            at = at + self.lengths[tokens[-1]]
            on = at < ends[which]
            which, at = which[on], at[on]
        owner = np.concatenate(owners)
        packed = np.concatenate(tokens)[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        stops = (np.cumsum(np.bincount(owner, minlength=len(pieces))) * 4).tolist()
        out = [packed[a:b] for a, b in zip([0, *stops], stops)]
        for i in singly:
            out[i] = self.encode_piece(pieces[i])
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text (null: none)."""
        out, slice_, size = [], [], 0
        for text in texts:
            if size and size + len(text or "") > SLICE:
                out += self.encode_slice(slice_)
                slice_, size = [], 0
            slice_.append(text or "")
            size += len(text or "")
        return out + self.encode_slice(slice_)

    def encode_slice(self, texts: list[str]) -> list[bytes]:
        if sum(map(len, texts)) > SLICE:            # one long text
            return list(map(self.encode, texts))
        plain = [None if DOUBLE_BLANK.search(t) or self.cut_special is not None and self.cut_special.search(t) else t.split(" ") for t in texts]
        self.remember({w for words in plain if words for w in words[1:]})
        return [self.encode(t) if words is None else self.encode_words(words) for t, words in zip(texts, plain)]

    def remember(self, words: set[str]) -> None:
        """Encode what isn't known of ``words``, each the text between two spaces, together. It only
        saves time: what it leaves out is encoded when it is met."""
        words = self.words.make_room(words)
        whole = [w for w in words if w.isascii() and w.isalpha()]
        whole_pieces = [" " + w for w in whole]
        # cut as one text: no two blanks meet in it, so a space begins a piece and nothing else holds one
        others = [w for w in words.difference(whole) if w and not w[-1].isspace()]
        lists: list[list[str]] = []
        for piece in self.cut.findall("".join([" " + w for w in others])):
            if piece[0] == " ":
                lists.append([piece])
            else:
                lists[-1].append(piece)
        new = list(self.pieces.make_room({*whole_pieces, *(p for ps in lists for p in ps)}))
        if new:
            self.pieces.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        get = self.pieces.__getitem__
        self.words.update(zip(whole, map(get, whole_pieces)))
        self.words.update(zip(others, [b"".join(map(get, ps)) for ps in lists]))

    def encode(self, text: str) -> bytes:
        """The packed ids of a whole text."""
        if self.cut_special is not None and self.cut_special.search(text):
            out, at = [], 0
            for m in self.cut_special.finditer(text):
                out += [self.encode_ordinary(text[at:m.start()]), self.packed[self.special[m.group()]]]
                at = m.end()
            return b"".join([*out, self.encode_ordinary(text[at:])])
        return self.encode_ordinary(text)

    def encode_ordinary(self, text: str) -> bytes:
        """Packed ids of a text without special tokens. Where no two blanks meet,
        the pattern cuts at every space whatever stands around it, so what
        follows a space can be looked up whole."""
        if DOUBLE_BLANK.search(text):
            return b"".join(map(self.pieces.__getitem__, self.cut.findall(text)))
        return self.encode_words(text.split(" "))

    def encode_words(self, words: list[str]) -> bytes:
        return b"".join([*map(self.pieces.__getitem__, self.cut.findall(words[0])), *map(self.words.__getitem__, words[1:])])

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; ids outside the vocabulary give nothing."""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        ids = ids[ids < len(self.lengths)]
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)
        return self.bytes[source].tobytes().decode("utf-8", "replace")


def spread(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class Table:
    """Numbers by 64-bit keys, many at once (-1: no such key), by linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = (4 * len(keys)).bit_length()
        self.keys, self.values = np.full(1 << self.bits, -1), np.full(1 << self.bits, -1, np.int32)
        slot = spread(keys, self.bits)
        while len(keys):
            free = np.nonzero(self.keys[slot] < 0)[0]
            free = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            left = np.ones(len(keys), bool)
            left[free] = False
            keys, values, slot = keys[left], values[left], slot[left] + 1 & len(self.keys) - 1

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = spread(keys, self.bits)
        seen = self.keys[slot]
        while len(other := np.nonzero((seen != keys) & (seen >= 0))[0]):
            slot[other] = slot[other] + 1 & len(self.keys) - 1
            seen[other] = self.keys[slot[other]]
        return self.values[slot].astype(np.int64)


class Trie:
    """The automaton's way down from its root, for all places of many pieces at once."""

    def __init__(self, ids: dict[bytes, int]):
        steps: dict[int, int] = {}
        ends = {0: -1}
        for token, i in ids.items():
            node = 0
            for byte in token:
                node = steps.setdefault(node << 8 | byte, len(steps) + 1)
            ends[node] = i
        self.steps = Table(*(np.fromiter(x, np.int64, len(steps)) for x in (steps.keys(), steps.values())))
        self.token = np.full(len(steps) + 1, -1)                # that ends at the node, -1 if none does
        self.token[np.fromiter(ends.keys(), np.int64, len(ends))] = np.fromiter(ends.values(), np.int64, len(ends))

    def longest(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The longest token from each place that doesn't pass the place's end."""
        best, start, node, depth = np.full(len(text), -1), np.arange(len(text)), np.zeros(len(text), np.int64), 0
        while len(start):
            node = self.steps.get(node << 8 | text[start + depth])
            depth += 1
            on = node >= 0
            start, node = start[on], node[on]
            token = self.token[node]
            best[start[token >= 0]] = token[token >= 0]
            inside = start + depth < ends[start]
            start, node = start[inside], node[inside]
        return best


class Pieces(dict):
    """Packed ids by piece of the pre-tokenizer; made when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        return self.keep(piece, self.vocabulary.encode_piece(piece.encode()))

    def make_room(self, wanted: set[str]) -> set[str]:
        """The short ones of ``wanted`` that aren't here; if they don't fit in, all that isn't wanted now goes."""
        new = {w for w in wanted.difference(self) if len(w) <= CACHE_LENGTH}
        if len(self) + len(new) > CACHE_PIECES:
            here = {w: self[w] for w in wanted if w in self}
            self.clear()
            self.update(here)
        return new

    def keep(self, text: str, packed: bytes) -> bytes:
        if len(text) <= CACHE_LENGTH:
            if len(self) >= CACHE_PIECES:
                self.clear()
            self[text] = packed
        return packed


class Words(Pieces):
    """Packed ids of a space and the text that follows it up to the next one."""

    def __missing__(self, word: str) -> bytes:
        v = self.vocabulary
        packed = b"".join(map(v.pieces.__getitem__, v.cut.findall(" " + word)))
        return packed if "\n" in word else self.keep(word, packed)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The tables of a vocabulary file, once for each Python worker. The file
    belongs to an installed package, so every machine has it."""
    return Vocabulary(path)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out`` (replaced if it exists): the packed ids of ``text``."""
    @F.arrow_udf(BinaryType())
    def ids(texts: pa.Array) -> pa.Array:
        release_memory()
        return pa.array(vocabulary(path).encode_all(texts.to_pylist()), pa.binary())

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` (replaced if it exists): the text of packed ``ids`` (null: empty)."""
    @F.arrow_udf(StringType())
    def texts(packed: pa.Array) -> pa.Array:
        release_memory()
        v = vocabulary(path)
        return pa.array([v.decode(p) if p else "" for p in packed.to_pylist()], pa.string())

    return df.withColumn(out, texts(F.col(ids)))
