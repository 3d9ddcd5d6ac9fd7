"""A byte-pair encoder that Spark tasks build once per process from a vocabulary file's bytes."""
from __future__ import annotations

import base64
import hashlib
import re

import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's texts are cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The pattern looks ahead from white space, which costs its matcher a stack as deep as the run is long: longer runs are cut here.
LONG = 10_000
_RUN = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % LONG)

_BUILT: dict[str, tiktoken.Encoding] = {}


class Bpe:
    """Holds the file's bytes (a fixed size, sent with the tasks), so executors need no file."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        with open(path, "rb") as f:
            self.ranks = f.read()
        self.pattern, self.key = pattern, hashlib.sha256(self.ranks + pattern.encode()).hexdigest()

    def encoder(self) -> tiktoken.Encoding:
        if self.key not in _BUILT:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
            _BUILT[self.key] = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return _BUILT[self.key]


def count_tokens(encoding: tiktoken.Encoding, text: str) -> int:
    """Number of tokens of a text. A long run of white space is the piece that the pattern would make of it: the run
    without its last character, which belongs to what follows, or the whole run at the end of the text."""
    n, at = 0, 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        n += len(encoding.encode_ordinary(text[at:run.start()])) + len(encoding._encode_single_piece(text[run.start():end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:] if at else text))
