"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Whole texts are scanned where they are read. A run of 16 or more characters of the base64 and URL
alphabets with a letter in it is a candidate; text-like strings merge into long
tokens under a public byte-pair vocabulary and random ones do not, so a candidate of fewer than
``RATIO`` characters a token is a finding. Known digests (hexadecimal, of a digest's length),
UUIDs and identifiers (all parts between ``_ - / + =`` are numbers or read as words) are left out,
and so is what a pattern's match covers. Where a run has words, digests or matches beside a random
string, the stretches of its parts that are of few characters a token are the findings. Letters alone read as words by their own characters a
token and, below 16, by regular changes of case; letters of one case need fewer than ``WORD_RATIO``
in lower case to be random, as rare words of other languages come close to ``RATIO``.

Defined results: a NULL text counts as empty and has no spans; spans are code points with the end
exclusive; repeated rows are scanned alike, row by row; an empty table gives an empty result;
other columns are not read.
"""
from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Bpe
from .common import pick

#: The base patterns, in the order of the kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of [0-9a-f]+ of 16 or more
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PARTS = re.compile(r"(?<![A-Za-z0-9])" + UUID.pattern + r"(?![A-Za-z0-9])|[A-Za-z0-9]+")
PREFIX = ("0x", "0X")
WORD = 3.0  # characters a token of a word beside a random string
CORE = 8  # characters of the longest part of a random string among other parts at least
EDGE = 3  # characters of a part that goes with the random string it stands beside
LEAST = 16  # characters of a candidate
RATIO = 2.2
WORD_RATIO = 2.0  # of letters of one case, or with a capital first


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches, in order."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def known(run: str) -> bool:
    """Digests and UUIDs."""
    return bool(len(run) in DIGEST_LENGTHS and HEXADECIMAL.fullmatch(run) or UUID.fullmatch(run))


def plain(part: str, encode, ratio: float = RATIO) -> bool:
    """Numbers, and letters that read as words."""
    if not part.isalpha():
        return part.isdigit()
    if len(part) >= LEAST and (part[1:].islower() or part.isupper()):
        return len(part) >= WORD_RATIO * len(encode(part.lower()))
    if len(part) >= ratio * len(encode(part)):
        return True
    changes = sum(a.isupper() != b.isupper() for a, b in zip(part, part[1:]))
    return len(part) < LEAST and (changes < 3 or 3 * changes <= len(part))


def word(part: str, encode) -> bool:
    """Letters in long tokens, which a part of a random string hardly ever is."""
    return len(part) > EDGE and part.isalpha() and len(part) >= WORD * len(encode(part))


def _union(base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Disjoint (start, end) of the base spans, in order."""
    out: list[tuple[int, int]] = []
    for start, _, end in sorted(base):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _outside(start: int, end: int, covered: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What of start to end lies in none of ``covered``."""
    for a, b in covered:
        if a > start:
            yield start, min(a, end)
        start = max(start, b)
    if start < end:
        yield start, end


def _lowest(scored: list[tuple[int, int, float]]) -> Iterator[tuple[int, int]]:
    """(first, last) of the stretches of low sums: each from its first low part to where its sum is least."""
    i = 0
    while i < len(scored):
        low, at, total, j = 0.0, -1, 0.0, i
        while j < len(scored):
            total += scored[j][2]
            if total >= 0:
                break
            if total < low:
                low, at = total, j
            j += 1
        if at < 0:
            i += 1
        else:
            yield i, at
            i = at + 1


def low(text: str, parts: list[str], encode, ratio: float) -> bool:
    """Whether a row of parts is a random string as a whole."""
    return (len(text) >= LEAST and not all(plain(p, encode, ratio) for p in parts)
            and (text.isalpha() or len(text) < ratio * len(encode(text))))


def stretches(run: str, covered: list[tuple[int, int]], encode, ratio: float = RATIO) -> list[tuple[int, int]]:
    """(start, end) of the random strings of a run: rows of parts between words, known parts and those inside
    ``covered``, or stretches of such a row. A part that ``covered`` meets without holding it counts whole."""
    rows: list[list[tuple[int, int]]] = [[]]
    at = 0
    for m in PARTS.finditer(run):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at < len(covered) and covered[at][0] <= m.start() and covered[at][1] >= m.end() or known(m[0]) or word(m[0], encode):
            rows.append([])
        else:
            rows[-1].append(m.span())
    out = []
    for row in filter(None, rows):
        if all(b - a < CORE or plain(run[a:b], encode, ratio) for a, b in row):
            continue
        start, end = row[0][0], row[-1][1]
        if low(run[start:end], [run[a:b] for a, b in row], encode, ratio):
            out.append((start, end))
            continue
        scored, loose = [], [0]  # the vocabulary's pattern cuts at separators, so the tokens of parts add up
        for a, b in row:
            score, held = b - a - ratio * len(encode(run[a:b])), not plain(run[a:b], encode, ratio)
            scored.append((a, b, score if held else max(score, 0.0)))
            loose.append(loose[-1] + (b - a) * held)
        for i, j in _lowest(scored):
            held = loose[j + 1] - loose[i]
            while i and row[i - 1][1] - row[i - 1][0] <= EDGE:
                i -= 1
            while j + 1 < len(row) and row[j + 1][1] - row[j + 1][0] <= EDGE:
                j += 1
            start, end = row[i][0], row[j][1]
            if end - start >= LEAST and 2 * held >= end - start and (not out or start >= out[-1][1]):
                out.append((start, end))
    return out


def random_spans(text: str, base: list[tuple[int, int, int]], encode, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """Candidates of a low number of characters per token, without what the base spans cover."""
    out, at = [], 0
    taken = _union(base)
    for m in CANDIDATE.finditer(text):
        run = m[0]
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        to = at
        while to < len(taken) and taken[to][0] < m.end():
            to += 1
        covered = [(a - m.start(), b - m.start()) for a, b in taken[at:to]]
        if covered and covered[0][0] <= 0 and covered[0][1] >= len(run) or not any(c.isalpha() for c in run) or known(run):
            continue
        parts = PARTS.findall(run)
        if all(plain(p, encode, ratio) for p in parts):
            continue
        found = stretches(run, covered, encode, ratio)
        if not any(known(p) or word(p, encode) for p in parts) and found[:1] != [(0, len(run))] or not found:
            # separators at the ends go with the run, and so do words that its parts are too short without
            if not covered and not any(map(known, parts)) and low(run, parts, encode, ratio):
                found = [(0, len(run))]
        nth = 0
        for start, end in found:
            while nth < len(covered) and covered[nth][1] <= start:
                nth += 1
            for a, b in _outside(start, end, covered[nth:bisect.bisect_left(covered, (end,), nth)]):
                left = run[a:b]
                # words and prefixes at a match are no part of its token
                if (a, b) == (start, end) or left not in PREFIX and not (left.isalpha() and len(left) >= ratio * len(encode(left))):
                    out.append((m.start() + a, 3, m.start() + b))
    return out


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, bpe: Bpe, ratio: float = RATIO) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    sent = docs.sparkSession.sparkContext.broadcast(bpe)  # the vocabulary: a fixed size

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = sent.value.encoder().encode_ordinary
        for s in texts:
            rows = []
            for t in s:
                base = base_spans(t or "")
                more = random_spans(t or "", base, encode, ratio)
                n = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*n, hashlib.sha256(_said(base).encode()).hexdigest(), _said(base + more), len(more)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return pick(docs, "doc_id", "text").select("doc_id", find("text").alias("x")).select("doc_id", "x.*")


def redact(docs: DataFrame, bpe: Bpe, mark: str = "<{}>") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind; of overlapping spans the first."""
    sent = docs.sparkSession.sparkContext.broadcast(bpe)

    @F.pandas_udf("string")
    def without(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = sent.value.encoder().encode_ordinary
        for s in texts:
            out = []
            for t in s:
                base = base_spans(t or "")
                parts, at = [], 0
                for a, k, b in sorted(base + random_spans(t or "", base, encode)):
                    if a >= at:
                        parts += [t[at:a], mark.format(KINDS[k])]
                    at = max(at, b)
                out.append(t if t is None else "".join(parts) + t[at:])
            yield pd.Series(out)

    return docs.withColumn("text", without(docs["text"]))
