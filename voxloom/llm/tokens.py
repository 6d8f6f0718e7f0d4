"""Token ids of whole texts by a public word-level BPE file, through caches of words.

The file's normaliser and pre-tokeniser never join across ASCII white space,
so a text's ids are its words' ids, one after the other. A word of printable
ASCII and Latin-1 letters is lower-cased and cut here as the file's pattern
cuts it, and its parts go through the file's BPE model; any other word goes
through the whole file.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from voxloom.llm.common import kept_in_worker

#: Words, and parts of words, remembered by a Python worker before it starts over.
CACHE_WORDS, CACHE_PARTS = 200_000, 200_000
END_ID = 1
SIMPLE = re.compile(r"[!-;=?-~À-ÖØ-öø-ÿ]+")  # without < and >, so no special mark
#: Fixed value: the file's splitting pattern for lower-case simple words.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")

#: Each Latin-1 letter as the byte-level letters of its two UTF-8 bytes: printable Latin-1 stands for itself, the others follow 255 in order.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_LETTERS = {c: "".join(chr(256 + _OTHERS.index(b)) if b in _OTHERS else chr(b) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class _Words(dict):
    """word (bytes) -> its ids, worked out when first asked for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.tokenize = self.whole.model.tokenize
        self.parts: dict[str, bytes] = {}

    def part(self, p: str) -> bytes:
        got = [x.id for x in self.tokenize(p if p.isascii() else p.translate(BYTE_LETTERS))]
        self.parts[p] = x = struct.pack(f"<{len(got)}I", *got)
        return x

    def __missing__(self, word: bytes) -> bytes:
        t = word.decode("utf-8", "replace")
        if SIMPLE.fullmatch(t):
            x = b"".join([self.parts.get(p) or self.part(p) for p in PARTS.findall(t.lower())])
        else:
            got = self.whole.encode(t, add_special_tokens=False).ids
            x = struct.pack(f"<{len(got)}I", *got)
        self[word] = x
        return x


class WordEncoder:
    """encode(texts) -> little-endian unsigned 32-bit ids of each text."""

    def __init__(self, path: str):
        self.words = _Words(path)

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        words, get, out = self.words, self.words.__getitem__, []
        for t in texts:
            out.append(b"".join(map(get, t.split())) if t else b"")
            if len(words) > CACHE_WORDS:
                words.clear()
            if len(words.parts) > CACHE_PARTS:
                words.parts.clear()
        return out


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of the file, kept with its cache from task to task."""
    return kept_in_worker(f"tokens {path}", lambda: WordEncoder(path))


def encode_column(path: str, column: pa.Array, step: int = 128) -> Iterator[list[bytes]]:
    """Ids of a string column, a few texts at a time, each with END_ID appended; null counts as empty."""
    enc, end = encoder(path), np.array([END_ID], "<u4").tobytes()
    for i in range(0, len(column), step):
        yield [x + end for x in enc.encode(column.slice(i, step).cast(pa.binary()).to_pylist())]


def with_ids(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """docs without their text, with the binary column `out`, which replaces one of that name."""
    docs = docs.drop(out) if out != text else docs
    keep = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for ids in encode_column(path, b.column(text)):
                part = b.slice(done, len(ids))
                done += len(ids)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), pa.array(ids, pa.binary())], names=[*(f.name for f in keep), out])

    return docs.mapInArrow(run, StructType([*keep, StructField(out, BinaryType())]))
