"""Token ids of whole texts by a public tokenizer, with every distinct word encoded once in a worker."""

from __future__ import annotations

import json
import os
import re
from array import array

from .common import worker_state

#: Latin letters that normalisation only lower-cases, and marks that the pre-tokenizer keeps in one run.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
RUNS = re.compile(f"[{LETTERS}]+|[{MARKS}]+")
PLAIN = re.compile(f"[{LETTERS}{MARKS}]+")


def word_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Ids of one run of letters or of marks, by the tokenizer's own model."""

    def __init__(self, owner):
        self.owner = owner

    def __missing__(self, run: str) -> bytes:
        low = run.lower()
        mapped = low if low.isascii() else "".join(self.owner.bytes_as.get(c, c) for c in low)
        ids = self.owner.packed([t.id for t in self.owner.model.tokenize(mapped)])
        if len(self) >= self.owner.room:
            self.clear()
        self[run] = ids
        return ids


class _Chunks(dict):
    """Ids of what stands between two spaces."""

    def __init__(self, owner):
        self.owner = owner
        self[""] = b""

    def __missing__(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk):
            ids = b"".join(map(self.owner.words.__getitem__, RUNS.findall(chunk)))
        else:
            ids = self.owner.library(chunk)
        if len(chunk) > 64:
            return ids
        if len(self) >= self.owner.room:
            self.clear()
            self[""] = b""
        self[chunk] = ids
        return ids


class Encoder:
    """Encodes texts to ids as little-endian integers of ``width`` bytes, without special tokens.

    If the tokenizer drops white space and never joins what stands on two sides of it, the ids of a text are those of
    its words in turn, so each distinct word is encoded once; any other tokenizer gets whole texts. ``room`` bounds how
    many words are kept at a time. A text that may hold a special token is always encoded as a whole.
    """

    def __init__(self, path: str, room: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.room = Tokenizer.from_file(path), room
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if self.size <= 1 << 16 else 4
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_as = {chr(c): level.pre_tokenize_str(chr(c))[0][0] for c in range(192, 256)}
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.special = [t["content"] for t in parts["added_tokens"]]
        split = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        normal = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        self.by_word = (
            normal == ["NFC", "Replace", "Lowercase"] and len(split) == 2 and split[1].get("type") == "ByteLevel" and not split[1]["add_prefix_space"]
            and not split[1]["use_regex"] and split[0].get("type") == "Split" and split[0]["invert"] and split[0]["behavior"] == "Removed"
            and split[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and not any(" " in s or "\n" in s for s in self.special)
        )
        self.words, self.chunks = _Words(self), _Chunks(self)

    def packed(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes()

    def library(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def encode(self, text: str) -> bytes:
        if not self.by_word or any(s in text for s in self.special):
            return self.library(text)
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file."""
    known = worker_state("encoders", dict)
    if path not in known:
        known[path] = Encoder(path)
    return known[path]
