"""Ids of a lower-casing word BPE, equal to what the tokenizers library returns.

The library spends most of its time on words it has met before. White space is dropped
by this tokenizer and no pattern reaches across it, so a text is the concatenation of
its chunks between white space, and each chunk is looked up in a table bounded in bytes.
Chunks too long to be words, as of texts without blanks, are not kept. A new chunk
of plain letters is merged by tiktoken over the same ranks (the end-of-word mark is a
byte that UTF-8 never uses); every other new chunk goes through the library itself.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

END = b"\xff"
# Latin letters that are lower-cased one by one and are composed already.
PLAIN = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)\Z")


# White space of ASCII but the blank; more would be right, too, but is rare.
BLANKS = "\t\n\v\f\r"
LONGEST = 64  # characters of a chunk that is kept in the table
ENTRY = 160  # bytes an entry takes beside its characters and ids


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def load(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordEncoder:
    """Encodes texts to little-endian 32-bit ids; the chunk table is cleared when full.

    An empty text has no ids. What the table takes is counted in bytes, so its size is
    bounded whatever the language of the texts.
    """

    def __init__(self, path: str, table_bytes: int = 128 << 20):
        self.library = load(path)
        self.table: dict[str, bytes] = {}
        self.table_bytes, self.held = table_bytes, 0
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = byte_of_char()
        ranks = {}
        for token, rank in vocabulary.items():
            ends = token.endswith("</w>") and len(token) > 4
            body = bytes(byte[c] for c in (token[:-4] if ends else token))
            ranks[body + END if ends else body] = rank
        self.merge = tiktoken.Encoding(
            "word", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece

    def _new(self, chunk: str) -> bytes:
        plain = PLAIN.match(chunk)
        if not plain:
            ids = self.library.encode(chunk, add_special_tokens=False).ids
        else:
            ids = self.merge(plain[1].lower().encode() + END)
            if plain[2]:
                ids = ids + self.merge(plain[2].encode() + END)
        return np.array(ids, "<u4").tobytes()

    def _ids(self, chunk: str) -> bytes:
        ids = self.table.get(chunk)
        if ids is None:
            ids = self._new(chunk)
            if len(chunk) <= LONGEST:
                self.held += ENTRY + 4 * len(chunk) + len(ids)
                if self.held > self.table_bytes:
                    self.table.clear()
                    self.held = ENTRY + 4 * len(chunk) + len(ids)
                self.table[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        for blank in BLANKS:
            if blank in text:
                text = text.replace(blank, " ")
        chunks = text.split(" ")
        try:
            return b"".join(map(self.table.__getitem__, chunks))
        except KeyError:
            return b"".join(map(self._ids, chunks))
