"""Byte-level BPE by tree reduction.

A text is halved until the parts are short; parts are encoded by themselves. Two neighbours are
joined by encoding a window around their border anew. The window grows until it ends, on either
side, at a place that starts a new match of the splitting pattern whatever stands around it, so
the tokens outside cannot change. Where a border lies in one long run without such a place, the
window grows by tokens instead: a row of tokens is the encoding of its bytes exactly if each two
neighbours are the encoding of theirs, so it is enough that both seams hold.

Joining is associative: any tree over the parts gives the same ids.
"""

from __future__ import annotations

import base64
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from cartwheel.llm.common import free_names, map_batches

LEAF = 1024       # characters that are encoded at once
RUN = 256         # a run at least this long is joined by tokens
_OLD = unicodedata.ucd_3_2_0


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file, or of the vocabulary in a JSON tokenizer file."""
    if path.endswith(".json"):
        vocabulary = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
        special = {t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]}
        as_byte = _bytes_of_characters()
        return {bytes(as_byte[c] for c in token): rank for token, rank in vocabulary.items()
                if token not in special}
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _bytes_of_characters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and number the others from 256."""
    table, new = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            table[chr(byte)] = byte
        else:
            table[chr(new)] = byte
            new += 1
    return table


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> "Codec":
    """One per worker process."""
    return Codec(read_ranks(path), pattern)


def _kind(character: str) -> str:
    """L, N or O for characters that every Unicode version since 3.2 puts in one kind; else ?"""
    now, old = unicodedata.category(character)[0], _OLD.category(character)[0]
    if now != old or character.isspace() or now in "ZC":
        return "?"
    return now if now in "LN" else "O"


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self._library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._leaf = self._library.encode_ordinary

    # -- encoding ---------------------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return self._tree(text, 0, len(text))

    def _tree(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= LEAF:
            return self._leaf(text[low:high])
        cut = (low + high) // 2
        return self.join(text, low, cut, high, self._tree(text, low, cut), self._tree(text, cut, high))

    def join(self, text: str, low: int, cut: int, high: int,
             left: list[int], right: list[int]) -> list[int]:
        """Ids of ``text[low:high]`` from those of its parts before and after ``cut``."""
        start, end = cut, cut
        while start > low and not self._certain(text, start):
            start -= 1
        while end < high and not self._certain(text, end):
            end += 1
        if start == end:
            return left + right
        if end - start > RUN and self._one_piece(text, start, end):
            return self._join_run(left, len(text[start:cut].encode()), right, len(text[cut:end].encode()))
        keep = len(left) - len(self._leaf(text[start:cut]))
        skip = len(self._leaf(text[cut:end]))
        return left[:keep] + self._leaf(text[start:end]) + right[skip:]

    @staticmethod
    def _certain(text: str, at: int) -> bool:
        """Whether a match of the pattern starts at ``at`` in every context: a blank or line feed
        after something visible, or visible characters of different kinds. An apostrophe may
        join the letters after it."""
        if at <= 0 or at >= len(text):
            return True
        before, after = text[at - 1], text[at]
        if after in " \n":
            return not before.isspace()
        if before == "'":
            return False
        kinds = _kind(before), _kind(after)
        return "?" not in kinds and kinds[0] != kinds[1]

    @staticmethod
    def _one_piece(text: str, start: int, end: int) -> bool:
        """Whether the pattern takes ``text[start:end]`` as one match: one kind throughout,
        maybe after a blank. A leading contraction needs an apostrophe, which is refused."""
        first = start + (text[start] == " ")
        kind = _kind(text[first])
        run = text[first:end]
        return kind != "?" and "'" not in run and all(_kind(c) == kind for c in set(run)) and (
            first == 0 or text[first - 1] != "'")

    def _join_run(self, left: list[int], left_bytes: int, right: list[int],
                  right_bytes: int) -> list[int]:
        """Grow a window of tokens on both sides of the border, inside the run, until its new
        tokens fit both neighbours."""
        most_left, most_right = self._tokens_within(reversed(left), left_bytes), self._tokens_within(right, right_bytes)
        k = 8
        while True:
            a, b = min(k, most_left), min(k, most_right)
            window = b"".join(self._bytes[t] for t in left[len(left) - a:] + right[:b])
            new = self._library._encode_single_piece(window)
            fits = (a == most_left or self._fit(left[len(left) - a - 1], new[0]))
            if fits and (b == most_right or self._fit(new[-1], right[b])):
                return left[:len(left) - a] + new + right[b:]
            if a == most_left and b == most_right:
                return left[:len(left) - a] + new + right[b:]
            k *= 2

    def _tokens_within(self, tokens, size: int) -> int:
        count = 0
        for token in tokens:
            size -= len(self._bytes[token])
            if size < 0:
                break
            count += 1
        return count

    def _fit(self, one: int, other: int) -> bool:
        return self._library._encode_single_piece(self._bytes[one] + self._bytes[other]) == [one, other]

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            return self._library.decode_bytes(ids)
        cut = len(ids) // 2
        return self.decode(ids[:cut]) + self.decode(ids[cut:])


def _with_binary(docs: DataFrame, name: str) -> StructType:
    return StructType([*docs.schema.fields, StructField(name, BinaryType())])


def encode_documents(docs: DataFrame, ranks: str, pattern: str, text: str = "text",
                     keep_text: bool = False) -> DataFrame:
    """Add ``ids``: the token ids of each whole text as little-endian unsigned 32-bit integers.

    The text itself is dropped unless ``keep_text``. A null or empty text has no ids (empty
    bytes); repeated rows are encoded each for itself; an empty table gives an empty result; a
    column named ``ids`` gets ``_in`` appended. Texts never leave their row, so no text or source
    makes a hot task beyond its own length.
    """
    docs = free_names(docs, "ids")

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in rows:
            ids = [np.array(own.encode(t), dtype="<u4").tobytes() if t else b""
                   for t in batch.column(text).to_pylist()]
            columns = [*batch.columns, pa.array(ids, pa.binary())]
            names = [*batch.schema.names, "ids"]
            if not keep_text:
                at = names.index(text)
                del columns[at], names[at]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = _with_binary(docs if keep_text else docs.drop(text), "ids")
    return map_batches(docs, encode, schema)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Add ``decoded``, the bytes that ``ids`` stand for; null ids give null."""
    encoded = free_names(encoded, "decoded")

    def decode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in rows:
            texts = [None if b is None else own.decode(np.frombuffer(b, "<u4").tolist())
                     for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())],
                                             [*batch.schema.names, "decoded"])

    return map_batches(encoded, decode, _with_binary(encoded, "decoded"))


def bpe_digest(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: number of ids, checksum of the ids, checksum of the bytes decoded from them."""
    encoded = encode_documents(docs.select("doc_id", "text"), ranks, pattern)
    return decode_documents(encoded, ranks, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast(LongType()).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
