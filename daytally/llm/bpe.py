"""Byte-level BPE encoding and decoding, long unsplit text by tree concatenation.

A text is encoded by a public vocabulary as its own library encodes it. A long text is taken apart at special tokens,
then cut where every reading of the pattern that splits text must split (before white space that follows other
characters), and the parts are encoded in parallel. A part that holds a long run of characters of one kind (letters of any
script, digits, white space, other marks) is split into pieces by the vocabulary's own pattern. A piece longer than a leaf
is halved down to leaves, the halves are encoded apart, and at each join a window of tokens on both sides is encoded
anew and grown until its first token is the left side's and its last token the right side's. The result is then the
encoding of the whole: a sequence of tokens is an encoding exactly if every two neighbours are one, and each pair of
neighbours lies in the left part, in the window or in the right part. Halves are cut between bytes, also within a
character.

Rows and edge cases: one row comes out per row that goes in, in any order. Null text counts as empty and has no
tokens. A special token's text becomes its id, as in the library. Ids of rows may be null or repeat; rows are
independent of each other. Other columns are not read, unless asked for.
"""

import hashlib
import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from daytally.llm.shared import chunks, text_of

TOKENIZER = "byte_bpe_50k.json"
# Characters of a part of a long text, and bytes of a leaf of a long piece.
PART = 1 << 16
LEAF = 1 << 12
# Halves from this many bytes on are encoded at the same time.
PARALLEL = 1 << 20
# White space for every reading of Unicode, after what is none for any.
_CUT = re.compile(r"(?<=\S)(?=[ \t\r\n])")
# Characters of one kind, as the pattern tells them apart.
_KIND = regex.compile(r"\p{L}++|\p{N}++|\s++|[^\s\p{L}\p{N}]++")
# The pattern that splits text, with the character tables of the vocabulary's own library.
_PIECES = ByteLevel(add_prefix_space=False, use_regex=True)


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=2)
def load(path: str) -> "Bpe":
    with open(path, encoding="utf-8") as file:
        return Bpe(json.load(file))


class Bpe:
    """A vocabulary read from a tokenizer file whose ids follow the order of its merges."""

    def __init__(self, spec: dict, part: int = PART, leaf: int = LEAF):
        letter = byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letter[c] for c in token): number
                 for token, number in spec["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = special
        self._cut_special = re.compile("|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) or "(?!)")
        self.names = [str(k) for k in range(max(self.encoding.n_vocab, max(ranks.values()) + 1))]
        self.part, self.leaf = part, leaf

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.part and not self._long_run(text):
            return self._plain(text)
        out, at = [], 0
        for token in self._cut_special.finditer(text):
            out += [self._stretch(text[at:token.start()]), np.array([self.special[token.group()]], np.uint32)]
            at = token.end()
        return np.concatenate([*out, self._stretch(text[at:])])

    def _plain(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoding._core_bpe.encode_to_tiktoken_buffer(text, set(self.special)), np.uint32)

    def _stretch(self, text: str) -> np.ndarray:
        """Tokens of text without special tokens."""
        stops, at = [], 0
        while len(text) - at > self.part and (cut := _CUT.search(text, at + self.part)):
            stops.append(at := cut.start())
        parts = [text[a:b] for a, b in zip([0, *stops], [*stops, len(text)])]
        if len(parts) == 1:
            return self._part(text)
        with ThreadPoolExecutor(2) as pool:
            return np.concatenate(list(pool.map(self._part, parts)))

    def _long_run(self, text: str) -> bool:
        """Whether a piece may be longer than a leaf: so many characters of one kind cover a multiple of their number."""
        least = max(1, self.leaf // 4)
        for k in range(0, len(text), least):
            ahead = _KIND.match(text, k)
            # The rest of the run lies before the probe, so it is read backwards from there.
            behind = _KIND.match(text[max(0, k - least):k + 1][::-1])
            if len(ahead.group()) + len(behind.group()) > least:
                return True
        return False

    def _part(self, text: str) -> np.ndarray:
        if not self._long_run(text):
            return self._plain(text)
        pieces = (text[a:b].encode() for _, (a, b) in _PIECES.pre_tokenize_str(text))
        return np.array([token for piece in pieces for token in self.tree(piece)], np.uint32)

    def tree(self, piece: bytes) -> list[int]:
        """Tokens of bytes that the pattern doesn't split."""
        if len(piece) <= self.leaf:
            return self.encoding._core_bpe.encode_single_piece(piece)
        half = len(piece) // 2
        if len(piece) > PARALLEL:
            with ThreadPoolExecutor(2) as pool:
                return self.join(*pool.map(self.tree, (piece[:half], piece[half:])))
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the bytes of two encodings one after the other."""
        reach = 4
        while True:
            window = self.encoding._core_bpe.encode_single_piece(self.bytes_of(left[-reach:] + right[:reach]))
            if (reach >= len(left) or window[0] == left[-reach]) and (reach >= len(right) or window[-1] == right[reach - 1]):
                return left[:-reach] + window + right[reach:]
            reach *= 2

    def bytes_of(self, ids: list[int]) -> bytes:
        return self.encoding._core_bpe.decode_bytes(ids)

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no text become replacement characters."""
        return self.bytes_of(ids).decode("utf-8", errors="replace")


def _worker(path: str, with_ids: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        name = bpe.names.__getitem__
        for batch in chunks(batches):
            ids, count, id_hash, text_hash = [], [], [], []
            for text in batch.column("text").to_pylist():
                tokens = bpe.encode(text)
                plain = tokens.tolist()
                count.append(len(plain))
                id_hash.append(hashlib.sha256(",".join(map(name, plain)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(bpe.decode(plain).encode()).hexdigest())
                if with_ids:
                    ids.append(tokens)
            columns = [batch.column("id"), pa.array(count, pa.int64()), pa.array(id_hash), pa.array(text_hash)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return work


def encode(docs: DataFrame, path: str | None = None, with_ids: bool = True, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids`` for each row of ``docs``.

    The decoded text is made from the ids alone.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_worker(path or public_tokenizers.path(TOKENIZER), with_ids), schema)


def _decoder(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return work


def decode(encoded: DataFrame, path: str | None = None, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``doc_id, text`` from token ids; null ids give an empty text."""
    rows = encoded.select(F.col(id_column).cast("long").alias("id"), F.col(ids_column).alias("ids"))
    return rows.mapInArrow(_decoder(path or public_tokenizers.path(TOKENIZER)), "doc_id long, text string")
