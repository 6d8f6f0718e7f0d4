"""Byte-level BPE of whole texts and back, by a public tokenizer file.

Of all encodings of a word exactly one has only neighbours that byte-pair
merging leaves apart (`Merges.apart`), so a word's encoding is told by the last
token of each of its prefixes: the one suffix token that may stand behind the
last token of what comes before it. The distinct words of a batch of texts are
put into a trie and gone through depth-first with these last tokens, so a
prefix that many words share is encoded once. Words of 64 letters or less are
remembered by their Python worker, up to CACHE; beyond that it forgets those that the batch does not hold.

Edge cases: a null or empty text has no tokens; strings of the file's added
tokens inside a text are those tokens (or plain text, special=False); words of
any length are encoded whole; repeated rows and ids are encoded alike; null ids
decode to null, nulls among them and ids outside the vocabulary are skipped and bytes that are no
UTF-8 become U+FFFD, as the library does; an empty table gives an empty result;
other columns stay, and one with the output's name is replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from voxloom.llm.common import kept_in_worker

#: Words that a Python worker remembers, and the letters of the longest one.
CACHE, CACHE_LETTERS = 400_000, 64
#: Pairs of tokens whose being apart is remembered.
CACHE_PAIRS = 500_000
NEVER = 1 << 62
#: Fixed value: how byte-level tokenizers cut texts into words.
WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]++| ?\d++| ?(?:[^\w\s]|_)++|\s+(?!\S)|\s+")
#: Characters of which Python and the library think alike (Latin, Greek, Cyrillic, punctuation, kana, common ideographs): texts of these alone are cut here, others by the library's own tables.
SETTLED = re.compile("[\0-\x1b !-±´-¸º»À-ɏΑ-ΡΣ-ϿЀ-ҁҊ-ӿ‐-‧‰-⁞₠-₵ぁ-ゖァ-ヺ一-龥]*")

#: Letters that stand for bytes in the file: printable Latin-1 for itself, other bytes by the letters from U+0100 on, in order.
_PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}


class Merges:
    """A BPE file's tokens, and which of them may stand side by side."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, pre = file["model"], file["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or file["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        if any(t[k] for t in file["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.bytes_of = {i: bytes(BYTE_OF[x] for x in t) for t, i in model["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        if any(bytes([b]) not in self.id_of for b in range(256)):
            raise ValueError(f"{path} lacks single bytes")
        self.size_of = {i: len(b) for i, b in self.bytes_of.items()}
        self.packed = {i: pack("<i", i) for i in self.bytes_of}
        self._starts = {b[:k] for b in self.id_of for k in range(1, len(b) + 1)}
        self._reads, self._state_of, self.steps, self.tokens = [b""], {}, {}, [[]]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        rank = {tuple(model["vocab"][x] for x in p): r for r, p in enumerate(pairs)}
        self.rank = rank
        made: dict[int, int] = {}  # token -> rank of the merge that makes it
        parts: dict[int, tuple[int, int]] = {}
        for (a, b), r in rank.items():
            t = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            if t not in made:
                made[t], parts[t] = r, (a, b)
            if made.get(a, -1) > r or made.get(b, -1) > r:
                raise ValueError(f"merge {r} of {path} joins tokens that later merges make")
        self.made, self.parts = made, parts
        self.known_apart: dict[int, bool] = {}
        self._edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for t, (a, b) in parts.items():
            if not self._stay(a, b, made[t]):
                raise ValueError(f"token {t} of {path} is not what its own bytes are encoded as")
        self._edges.clear()

    def edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """What stands at a token's end (side 1) or start (side 0) while it is put together: (token, rank of the merge that takes it in), in order."""
        if (out := self._edges.get((t, side))) is None:
            out, end = [], NEVER
            while True:
                out.append((t, end))
                if t not in self.parts:
                    break
                end, t = self.made[t], self.parts[t][side]
            out.reverse()
            self._edges[out[-1][0], side] = out
        return out

    def _stay(self, a: int, b: int, until: int = NEVER) -> bool:
        """Does no merge before `until` join the end of a with the start of b? Of two merges of one rank the left one comes first."""
        left, right, rank = self.edge(a, 1), self.edge(b, 0), self.rank
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            r = rank.get((x, y), NEVER)
            if r < x_ends and r <= y_ends and r < until:
                return False
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1
            if i == len(left) or j == len(right):
                return True

    def apart(self, a: int, b: int) -> bool:
        """Are token a's bytes followed by token b's encoded as a, b?"""
        k = a << 32 | b
        got = self.known_apart.get(k)
        if got is None:
            if len(self.known_apart) >= CACHE_PAIRS:
                self.known_apart.clear()
                self._edges.clear()
            self.known_apart[k] = got = self._stay(a, b)
        return got

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte: a state is the longest end of what was read that starts a token, and `tokens` has the tokens that it ends in, longest first."""
        read = self._reads[state] + bytes([byte])
        while read not in self._starts:
            read = read[1:]
        to = self._state_of.get(read)
        if to is None:
            to = self._state_of[read] = len(self._reads)
            self._reads.append(read)
            self.tokens.append([(len(read) - k, self.id_of[read[k:]]) for k in range(len(read)) if read[k:] in self.id_of])
        self.steps[state << 8 | byte] = to
        return to


def trie(words: Iterable[bytes]) -> Iterator[tuple[bytes, int]]:
    """The trie of distinct words, depth-first: each word with the length of the path that it shares with the word before. Below a shared path come new nodes."""
    before = b""
    for w in sorted(words):
        n, most = 0, min(len(before), len(w))
        if before[:most] == w[:most]:
            n = most
        else:
            while before[n] == w[n]:
                n += 1
        yield w, n
        before = w


def encoded_words(merges: Merges, words: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(word, its ids as little-endian 32-bit numbers) of distinct words: last tokens and states of the path from the root are kept, so each node of the trie is worked out once."""
    lasts, states = [-1], [0]  # of the path's nodes: last token, state
    steps, tokens, known, packed, size_of = merges.steps, merges.tokens, merges.known_apart, merges.packed, merges.size_of
    for w, shared in trie(words):
        if len(w) >= len(lasts):
            more = [0] * (len(w) + 1 - len(lasts))
            lasts += more
            states += more
        state = states[shared]
        n = shared
        for byte in w[shared:]:
            state = to if (to := steps.get(state << 8 | byte)) is not None else merges.step(state, byte)
            n += 1
            for size, t in tokens[state]:
                if size == n:  # the whole prefix is a token
                    break
                before = lasts[n - size]
                if ok if (ok := known.get(before << 32 | t)) is not None else merges.apart(before, t):
                    break
            lasts[n], states[n] = t, state
        out = []
        while n:
            t = lasts[n]
            out.append(packed[t])
            n -= size_of[t]
        out.reverse()
        yield w, b"".join(out)


class Encoder:
    """Texts to ids and back."""

    def __init__(self, path: str, special: bool = True):
        self.merges, self.find = Merges(path), WORDS.findall
        self.path, self._library = path, None
        added = sorted(self.merges.added, key=len, reverse=True) if special else []
        self.marks = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self._known: dict[str, bytes] = {}
        self.decoding = self.merges.bytes_of | {i: t.encode() for t, i in self.merges.added.items()}

    def words(self, text: str) -> list[str]:
        """The words of a text without marks."""
        if SETTLED.fullmatch(text):
            return self.find(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[i:j] for _, (i, j) in self._library.pre_tokenize_str(text)]

    def cut(self, text: str) -> list[str]:
        """The words of a text, and the marks in it."""
        if self.marks and self.marks.search(text):
            return [w for k, part in enumerate(self.marks.split(text)) for w in ([part] if k % 2 else self.words(part))]
        return self.words(text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.cut(t) if t else [] for t in texts]
        there = set().union(*cut)
        new = there.difference(self._known)
        if len(self._known) + len(new) > CACHE:  # those that are in use stay
            self._known = {w: self._known[w] for w in there.difference(new)}
        known, added = self._known, self.merges.added if self.marks else {}
        known.update((w, pack("<i", added[w])) for w in new if w in added)
        known.update((w.decode(), ids) for w, ids in encoded_words(self.merges, [w.encode() for w in new if w not in added]))
        out = [np.frombuffer(b"".join([known[w] for w in ws]), "<i4") for ws in cut]
        for w in [w for w in new if len(w) > CACHE_LETTERS]:
            del known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        try:
            data = b"".join(map(self.decoding.__getitem__, ids))
        except KeyError:
            data = b"".join(self.decoding[i] for i in ids if i in self.decoding)
        return data.decode("utf-8", "replace")


def encoder(path: str, special: bool = True) -> Encoder:
    """This worker's encoder of the file, kept with its words from task to task."""
    return kept_in_worker(f"bpe {path} {special}", lambda: Encoder(path, special))


def text_steps(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of a text column, about `most` bytes at a time; bytes that are no UTF-8 are replaced."""
    raw = column.cast(pa.large_binary())
    at = np.cumsum([0, *pc.fill_null(pc.binary_length(raw), 0).to_pylist()])
    i = 0
    while i < len(raw):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, [None if t is None else t.decode("utf-8", "replace") for t in raw.slice(i, j - i).to_pylist()]
        i = j


def encoded(docs: DataFrame, path: str, text: str = "text", out: str = "ids", special: bool = True) -> DataFrame:
    """docs without their text, with the array column `out` of its ids."""
    keep = [f for f in docs.schema.fields if f.name not in (text, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, special)
        for b in batches:
            for i, texts in text_steps(b.column(text), 1 << 22):
                ids = enc.encode(texts)
                part, ends = b.slice(i, len(ids)), np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))], names=[*(f.name for f in keep), out])

    return docs.mapInArrow(run, StructType([*keep, StructField(out, ArrayType(IntegerType(), False))]))


def decoded(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """rows with the column `out`: the text of their ids."""
    keep = [f for f in rows.schema.fields if f.name != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                lists = part.column(ids)
                numbers, lengths = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).tolist(), pc.list_value_length(lists).to_pylist()
                texts, at = [], 0
                for n in lengths:
                    texts.append(None if n is None else enc.decode(numbers[at : at + n]))
                    at += n or 0
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), pa.array(texts, pa.string())], names=[*(f.name for f in keep), out])

    return rows.mapInArrow(run, StructType([*keep, StructField(out, StringType())]))
