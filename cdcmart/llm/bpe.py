"""Byte-level BPE by a trie over the distinct words, and its decoding.

Every prefix of a word has one encoding, and that encoding is fixed by its last token: it is the
token ``t`` at the end of the prefix that may stand behind the last token of what precedes it.
Walking the distinct words of a batch depth first (sorted words are the depth-first order of their
trie), the last token is found once for each node, so words that share a prefix share that work.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import free_name, in_slices, map_arrow, ship_package

# The pattern that splits text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Characters whose class is the same in every Unicode version in use. Texts with others are split
# by the tokenizers library itself, whose tables may be older than those of ``regex``.
_SETTLED = regex.compile(r"[\u0000-\u052f\u2000-\u206f\u20a0-\u20bf\u3000-\u303f\u3041-\u3096\u4e00-\u9fa5\uac00-\ud7a3]*")

# Words kept with their encoding by one Python worker, and characters split at once.
_KEPT_WORDS = 400_000
_PIECE = 1 << 20

_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the rest in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = byte_letters()
        self.path = path
        self.special = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError("added tokens that look at their neighbours are not supported")
            self.special[token["content"]] = token["id"]
        self.ids: dict[bytes, int] = {}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for text, i in model["vocab"].items():
            self.bytes[i] = bytes(letters[c] for c in text)
            self.ids[self.bytes[i]] = i
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        # A pair of tokens -> rank of its merge and the merged token.
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(
                (model["vocab"][left], model["vocab"][right]), (rank, model["vocab"][left + right])
            )
        self.longest = max(map(len, self.ids))
        self._edges: dict[int, tuple[list, list] | None] = {}
        self._pairs: dict[int, bool] = {}

    def merged(self, word: bytes) -> tuple[list[int], list[tuple[int, int, int]]]:
        """Plain merging of one short word: its tokens, and the merges (rank, start, end) made."""
        parts = [self.ids[word[i : i + 1]] for i in range(len(word))]
        ends = list(range(1, len(word) + 1))
        made = []
        while len(parts) > 1:
            rank, at = min(
                ((self.merges.get(p, (_NEVER,))[0], i) for i, p in enumerate(zip(parts, parts[1:]))),
            )
            if rank == _NEVER:
                break
            parts[at : at + 2] = [self.merges[parts[at], parts[at + 1]][1]]
            del ends[at]
            made.append((rank, ends[at - 1] if at else 0, ends[at]))
        return parts, made

    def edges(self, token: int) -> tuple[list, list] | None:
        """The tokens that stood at the left and at the right edge of ``token`` while it was merged, in
        order, each with the rank of the merge that ended it; None if it is never merged whole."""
        if token in self._edges:
            return self._edges[token]
        word = self.bytes[token]
        parts, made = self.merged(word)
        found = None
        if parts == [token]:
            left, right = [self.ids[word[:1]]], [self.ids[word[-1:]]]
            left_ends, right_ends = [], []
            for rank, start, end in made:
                if start == 0:
                    left_ends.append(rank)
                    left.append(self.ids[word[:end]])
                if end == len(word):
                    right_ends.append(rank)
                    right.append(self.ids[word[start:]])
            found = (
                list(zip(left, [*left_ends, _NEVER])),
                list(zip(right, [*right_ends, _NEVER])),
            )
        self._edges[token] = found
        return found

    def may_follow(self, first: int, second: int) -> bool:
        """Whether ``first`` then ``second`` stay apart when their text is merged."""
        key = first * len(self.bytes) + second
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > 2 * _KEPT_WORDS:
                self._pairs.clear()
            known = self._pairs[key] = self._stay_apart(first, second)
        return known

    def _stay_apart(self, first: int, second: int) -> bool:
        own, other = self.edges(first), self.edges(second)
        if own is None or other is None:
            return False
        right, left = own[1], other[0]
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = right[i], left[j]
            rank = self.merges.get((a, b), (_NEVER,))[0]
            # Of equal ranks the merge further left comes first.
            if rank < a_ends and rank <= b_ends and rank != _NEVER:
                return False
            if a_ends == b_ends == _NEVER:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def encode_sorted(self, words: list[bytes]) -> Iterator[list[int]]:
        """Encodings of sorted distinct words: the depth-first walk of their trie.

        ``last[d]`` is the last token of the prefix of length ``d`` on the path to the current node.
        """
        ids, may_follow, longest = self.ids, self.may_follow, self.longest
        known, pairs, size = ids.get, self._pairs, len(self.bytes)
        last: list[int] = [-1]
        path = b""
        for word in words:
            shared = 0
            for x, y in zip(path, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = known(word[start:end])
                    if token is None:
                        continue
                    before = last[start]
                    if before < 0:
                        if self.edges(token) is not None:
                            break
                        continue
                    fits = pairs.get(before * size + token)
                    if may_follow(before, token) if fits is None else fits:
                        break
                else:
                    raise ValueError("the vocabulary lacks single bytes")
                last.append(token)
            path = word
            found, end = [], len(word)
            while end:
                found.append(last[end])
                end -= len(self.bytes[last[end]])
            found.reverse()
            yield found


class Encoder:
    """Whole texts to token ids; keeps the encodings of words seen, within a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self._split = regex.compile(SPLIT)
        self._library = Tokenizer.from_file(path).pre_tokenizer
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._words: dict[str, bytes] = {
            s: np.array([i], np.int32).tobytes() for s, i in self.vocabulary.special.items()
        }
        self._fixed = dict(self._words)

    def _pieces(self, text: str) -> Iterator[str]:
        """Slices that split as the whole does: each ends before white space that follows a letter."""
        begin = 0
        while len(text) - begin > _PIECE:
            at = begin + _PIECE
            while at < len(text) and not (text[at] == " " and not text[at - 1].isspace()):
                at += 1
            yield text[begin:at]
            begin = at
        yield text[begin:]

    def _plain(self, text: str) -> list[str]:
        if _SETTLED.fullmatch(text):
            return self._split.findall(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        """What the merges work on: words, and the added tokens as they stand."""
        parts = self._special.split(text) if self._special else [text]
        found: list[str] = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(part)
            elif part:
                for piece in self._pieces(part):
                    found += self._plain(piece)
        return found

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as the bytes of 32-bit integers; a null text is an empty one."""
        out = []
        begin = 0
        while begin < len(texts):
            if len(self._words) > _KEPT_WORDS:
                self._words = dict(self._fixed)
            kept = self._words
            split, chars, end = [], 0, begin
            while end < len(texts) and (end == begin or chars < _PIECE):
                text = texts[end] or ""
                chars += len(text)
                split.append(self.words(text))
                end += 1
            new = {w.encode() for words in split for w in words if w not in kept}
            ordered = sorted(new)
            for word, found in zip(ordered, self.vocabulary.encode_sorted(ordered)):
                kept[word.decode()] = np.array(found, np.int32).tobytes()
            out += [b"".join([kept[w] for w in words]) for words in split]
            begin = end
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    return Vocabulary(path).bytes


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int): the whole text of each row as token ids of the file at ``path``.

    Texts of any length are taken whole; a null text counts as empty, an empty text has no ids.
    Rows are kept as they are, repeated ones too; a column named like ``ids`` gives way to it (the name
    gets underscores: see ``free_name``). The file has to be readable at that path on every executor.
    """
    ship_package(df.sparkSession)
    name = free_name(df, ids)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType(), False))])

    def step(batches):
        own = encoder(path)
        for batch in in_slices(batches, text):
            column = batch.column(batch.schema.get_field_index(text))
            found = _id_lists(own.encode_batch(column.to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return map_arrow(df, step, schema)


def _id_lists(found: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))


def _texts(column: pa.ListArray, known: list[bytes]) -> pa.StringArray:
    """Texts of lists of ids; ids that the vocabulary lacks are left out."""
    values = column.values.fill_null(-1).to_numpy()
    offsets, given = column.offsets.to_numpy(), column.is_valid().to_pylist()
    texts = []
    for i, begin, end in zip(given, offsets, offsets[1:]):
        row = values[begin:end] if i else values[:0]
        row = row[(row >= 0) & (row < len(known))].tolist()
        texts.append(b"".join([known[x] for x in row]).decode("utf-8", "replace"))
    return pa.array(texts, pa.string())


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text of the token ids, added tokens included.

    Null or empty ids give an empty text; bytes that are no UTF-8 become U+FFFD. An id that the
    vocabulary lacks is left out, as is a null one.
    """
    ship_package(df.sparkSession)
    name = free_name(df, decoded)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    def step(batches):
        known = token_bytes(path)
        for batch in in_slices(batches, ids):
            texts = _texts(batch.column(batch.schema.get_field_index(ids)), known)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])

    return map_arrow(df, step, schema)


def encode_and_decode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one pass through the Python workers: adds both columns."""
    ship_package(df.sparkSession)
    names = [free_name(df, "ids"), free_name(df, "decoded")]
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(names[0], T.ArrayType(T.IntegerType(), False)),
            T.StructField(names[1], T.StringType()),
        ]
    )

    def step(batches):
        own = encoder(path)
        for batch in in_slices(batches, text):
            found = _id_lists(own.encode_batch(batch.column(batch.schema.get_field_index(text)).to_pylist()))
            back = _texts(found, own.vocabulary.bytes)
            yield pa.RecordBatch.from_arrays([*batch.columns, found, back], [*batch.schema.names, *names])

    return map_arrow(df, step, schema)


def digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row's text. Null texts count as empty; rows with a null
    doc_id and repeated rows each get their result; other columns, whatever their names, are not read."""
    return encode_and_decode(df.select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
