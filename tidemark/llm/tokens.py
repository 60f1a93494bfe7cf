"""Public tokenizers on the workers."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np

from .common import kept

VOCABULARY = "byte_bpe_50k.json"
END = "<|endoftext|>"
#: Pre-tokens whose ids a worker remembers.
REMEMBERED = 400_000
#: The vocabulary's pre-tokens in a text of ASCII only: the same rule as the public pattern, spelled out for `re`.
ASCII = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t\n\x0b\x0c\r A-Za-z0-9]+|[\t\n\x0b\x0c\r ]+(?![^\t\n\x0b\x0c\r ])|[\t\n\x0b\x0c\r ]+")


def library(name: str = VOCABULARY):
    """The tokenizers library's tokenizer of a vocabulary file."""

    def build():
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(public_tokenizers.path(name))

    return kept(f"tokenizers {name}", build)


def pre_tokens() -> Callable[[str], list[str]]:
    """The function that cuts a text without special strings into the vocabulary's pre-tokens."""

    def build():
        import public_tokenizers
        import regex

        pattern = regex.compile(public_tokenizers.PATTERN)
        return lambda text: ASCII.findall(text) if text.isascii() else pattern.findall(text)

    return kept("pre-tokens", build)


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Ids(dict):
    """Pre-token -> its ids as little-endian 32-bit numbers, by the library's merges; the first `most` are remembered."""

    def __init__(self, name: str, most: int = REMEMBERED) -> None:
        super().__init__()
        tokenizer = library(name)
        self.merge, self.letters, self.most = tokenizer.model.tokenize, byte_letters(), most
        self.end = array("I", tokenizer.encode(END, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        written = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.merge(written)]).tobytes()
        if len(self) < self.most:
            self[piece] = ids
        return ids


def id_bytes(text: str, name: str = VOCABULARY) -> bytes:
    """A text's ids as the library gives them, as little-endian 32-bit numbers. A byte-level vocabulary merges
    within pre-tokens only, so each pre-token is merged once and remembered; special strings inside the text
    have ids of their own."""
    known, split = kept(f"ids {name}", lambda: Ids(name)), pre_tokens()
    return known.end.join([b"".join([known[p] for p in split(part)]) for part in text.split(END)])


def encode(text: str, name: str = VOCABULARY) -> np.ndarray:
    return np.frombuffer(id_bytes(text, name), "<u4")
