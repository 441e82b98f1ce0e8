"""Token ids of whole texts inside tasks, by a public vocabulary file."""

from __future__ import annotations

import json
import re

import numpy as np

# How a byte-level vocabulary of this kind splits a text before its merges (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Longer runs of blanks (of the signs that the pattern calls \s) overflow its engine's stack at some hundred thousands.
_LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def _entries(path: str) -> dict[bytes, int]:
    """The bytes that each id stands for.

    Such a file writes a byte as a printable character: itself if printable in Latin-1, else one of
    the characters from U+0100 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    special = {x["content"] for x in told.get("added_tokens", ())}
    return {bytes(byte_of[c] for c in entry): i for entry, i in told["model"]["vocab"].items() if entry not in special}


def id_width(path: str) -> np.dtype:
    """The narrowest of 16 and 32 bits that holds every id of a vocabulary."""
    return np.dtype("<u2" if max(_entries(path).values()) < 1 << 16 else "<u4")


class Encoder:
    """Encodes texts to unsigned 32-bit ids; strings of special tokens are ordinary text.

    ``path`` names a byte-level vocabulary file of the ``tokenizers`` library, readable on executors.
    Its merges run in the order of the ids, so ``tiktoken`` gives the same ids several times faster;
    a test compares both libraries.
    """

    def __init__(self, path: str):
        import tiktoken

        ranks = _entries(path)
        self.model = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for entry, i in ranks.items():
            self.lengths[i] = len(entry)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text; a long run of blanks, but for its last before other signs, is one piece of its own."""
        found, at = [], 0
        for run in _LONG_BLANKS.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            found += self.model.encode_ordinary(text[at : run.start()])
            found += self.model._encode_single_piece(text[run.start() : end].encode())
            at = end
        found += self.model.encode_ordinary(text[at:])
        return np.array(found, dtype="<u4")
