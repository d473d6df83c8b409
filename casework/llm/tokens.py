"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary's pattern cuts a text before every single space, and what lies
between two cuts is encoded by itself. So the ids of a text are those of its
space-separated chunks in turn. Chunks recur far more often than texts: a worker
keeps the ids of chunks it has seen and encodes only new ones, with the ranks
read from the tokenizer's own file. Texts in which the cut is not safe (runs of
white space with a space in them, characters outside the ranges below, or a special
token's name, which is one id) go to the tokenizer whole.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

# Characters whose class (letter, digit, space, other) is the same in every
# regular expression library at hand.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*\Z")
_SPACE_RUN = re.compile(r"\A | \Z|\s | \s")
#: Chunks remembered by a worker; beyond it the memory starts anew, which only costs time.
REMEMBERED = 600_000


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary file."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in kept}
    rest = (b for b in range(256) if b not in set(kept))
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class _Chunks(dict):
    """Chunk to the bytes of the ids of a space and the chunk, filled on demand."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk):
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[chunk] = np.array(self.encode(" " + chunk), dtype="<u4").tobytes()
        return ids


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = special = tuple(t["content"] for t in model["added_tokens"])
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in model["model"]["vocab"].items()
            if token not in special
        }
        pairs = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.encode_chunk = pairs.encode_ordinary
        self.chunks = _Chunks(pairs.encode_ordinary)

    def __call__(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        if not _PLAIN.match(text) or _SPACE_RUN.search(text) or any(name in text for name in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.encode_chunk(first), dtype="<u4").tobytes() + b"".join(
            map(self.chunks.__getitem__, rest)
        )


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(path)
