"""Tokenising whole texts with public vocabularies, as bytes of little-endian unsigned 32-bit ids.

Both encoders give the ids of the `tokenizers` library for the vocabulary file they are given, called with
add_special_tokens=False: an added token's string in a text becomes that token. A text that holds one goes through the
library itself. Else they differ from a plain call only in how they get there:

* `ByteEncoder`: byte-level vocabularies, of which the same merges run in tiktoken, about four times as fast. A text that
  its expression engine refuses (over a million white-space characters in a row) goes through the library itself.
* `WordEncoder`: lower-case word vocabularies with an end-of-word mark. The same merges run in tiktoken over pieces that
  a space ends; texts beyond Latin letters go through the library itself.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np


def library(path: str):  # noqa: ANN201
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def plain(t, texts: list[str]) -> list[bytes]:  # noqa: ANN001
    return [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]


def added(spec: dict) -> re.Pattern[str]:
    """Finds the strings of a vocabulary's added tokens."""
    return re.compile("|".join(re.escape(x["content"]) for x in spec.get("added_tokens") or []) or r"(?!)")


def bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable latin-1 stands for itself, the other
    bytes in ascending order for the code points from 256 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in kept)}


class ByteEncoder:
    #: The pre-tokenising expression that byte-level vocabularies with use_regex fix.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"] for x in spec.get("added_tokens", [])}
        letters = bytes_of_letters()
        ranks = {bytes(letters[c] for c in word): k for word, k in spec["model"]["vocab"].items() if word not in special}
        self.fast = tiktoken.Encoding("public", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow, self.path, self.added = None, path, added(spec)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            if self.added.search(t):
                self.slow = self.slow or library(self.path)
                out += plain(self.slow, [t])
                continue
            try:
                out.append(np.array(self.fast.encode_ordinary(t), "<u4").tobytes())
            except BaseException as e:  # the engine panics, which is no Exception, or raises
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
                self.slow = self.slow or library(self.path)
                out += plain(self.slow, [t])
        return out


class WordEncoder:
    #: Pieces as the vocabulary's pre-tokeniser takes them, for texts in which only Latin letters and ASCII digits occur.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+|[0-9]|[^\s0-9a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+")
    SIGNS = re.compile(r"([^\s0-9a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u024f]+)")
    DIGIT = re.compile(r"[0-9]")
    #: What the library is left to judge: other scripts, marks, other digits and spaces, letters whose lower case is two.
    ODD = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f]")

    def __init__(self, path: str) -> None:
        import tiktoken

        self.t = library(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"] for x in spec.get("added_tokens", [])}
        self.added = added(spec)
        end, letters = spec["model"]["end_of_word_suffix"], bytes_of_letters()
        ranks = {}
        for word, k in spec["model"]["vocab"].items():
            if word not in special:
                last = len(word) > len(end) and word.endswith(end)
                ranks[bytes(letters[c] for c in (word[: -len(end)] if last else word)) + b" " * last] = k
        # a space ends every piece and stands for the end-of-word mark, which joins the last byte before all other merges
        self.fast = tiktoken.Encoding("public-words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})

    def spaced(self, text: str) -> str:
        """The pieces of a text in lower case, one space or more after each."""
        low = text.lower()
        if "'" in low:
            return " ".join(self.PIECES.findall(low)) + " "
        out = self.DIGIT.sub(r" \g<0> ", " ".join(self.SIGNS.split(low)))
        for space in "\n\t\r\x0b\x0c":
            out = out.replace(space, " ")
        return out + " "

    def encode(self, texts: list[str]) -> list[bytes]:
        return [plain(self.t, [t])[0] if self.ODD.search(t) or self.added.search(t) else np.array(self.fast.encode_ordinary(self.spaced(t)), "<u4").tobytes() for t in texts]
