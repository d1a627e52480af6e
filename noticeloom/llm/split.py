"""Problem 9: texts above a token limit cut at natural boundaries, by agglomerative merging.

A text is cut into atomic segments at its boundaries (paragraphs, lines, sentences; within a
segment too long for a piece also clauses, then words), each with its strength. Adjacent segments wait in a heap; the weakest
boundary goes first (of equals the one whose merge is smallest, then the earliest) as long
as the merged segment plus the overlap fits the limit. What remains are the pieces; each
but the first starts with the last ``overlap`` tokens of the text before it.

Tokens are those of the whole text, so pieces are exact slices of it; a piece begins at the
character that holds its first token (at most three bytes earlier). Cutting
inside a run of blanks or a word can change the tokens at the two ends, so a piece within
``MARGIN`` tokens of the limit is tokenized by itself and gives up overlap tokens at its
start if it turns out larger.

Cases: null, empty and short texts have no pieces; a run without any boundary is cut at
token ends; repeated rows give equal pieces; empty tables give empty tables; other columns
are ignored; the whole text is always processed.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.llm.tokens import VOCABULARY, token_ends, tokenizer
from noticeloom.session import table

LIMIT, OVERLAP, MARGIN = 2048, 128, 16
#: Boundaries after which a text pauses, the strongest first.
PAUSES = [
    (5, re.compile(r"(?:\r\n|\r|\n)[ \t ]*(?:(?:\r\n|\r|\n)[ \t ]*)+")),
    (4, re.compile(r"\r\n|\r|\n| | |\f")),
    (3, re.compile(r"[.!?…]+[\"'”’)\]]*\s+")),
    (2, re.compile(r"[;:]\s+|,\s+|\s[–—-]\s")),
    (1, re.compile(r"\s+")),
]


#: Pauses looked for everywhere; weaker ones only within segments that are too long.
EVERYWHERE = 3


def pauses(text: str, strengths: list[tuple[int, re.Pattern]], start: int, end: int) -> dict[int, int]:
    """Character offsets at which a new segment may begin, with the strength of the pause before it."""
    out: dict[int, int] = {}
    for strength, pattern in strengths:
        for m in pattern.finditer(text, start, end):
            out.setdefault(m.end(), strength)
    out.pop(end, None)
    out.pop(start, None)
    return out


def merged(sizes: list[int], strengths: list[int], most: int) -> list[int]:
    """Segment sizes merged: indices of the segments at which a piece begins.

    ``strengths[i]`` is the pause between segment i and i + 1; no piece exceeds ``most``.
    """
    n = len(sizes)
    size, nxt, prev, alive = list(sizes), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(strengths[i], size[i] + size[i + 1], i, i + 1) for i in range(n - 1) if size[i] + size[i + 1] <= most]
    heapq.heapify(heap)
    while heap:
        strength, total, i, j = heapq.heappop(heap)
        if not alive[i] or not alive[j] or nxt[i] != j or size[i] + size[j] != total:
            continue
        alive[j] = False
        size[i] = total
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        for a, b in ((prev[i], i), (i, nxt[i])):
            if a >= 0 and b < n and size[a] + size[b] <= most:
                # the pause between a and b is the one before b's first segment
                heapq.heappush(heap, (strengths[b - 1], size[a] + size[b], a, b))
    return [i for i in range(n) if alive[i]]


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP, path: str = VOCABULARY) -> list[tuple[int, int, int, int]]:
    """``(start, end, tokens, shared tokens)`` of each piece in characters; one piece if the text fits."""
    ends = token_ends(text, path)
    total = len(ends)
    if total <= limit:
        return [(0, len(text), total, 0)] if total else []
    raw = np.frombuffer(text.encode(), np.uint8)
    byte_of = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # byte offset of each character
    token_start = np.concatenate(([0], ends))
    most = limit - overlap

    def char_at(k: int) -> int:
        return int(np.searchsorted(byte_of, token_start[k], side="right")) - 1

    def boundaries(level: int, a: int, b: int) -> list[tuple[int, int]]:
        """``(token, strength)`` of the segments' starts between tokens a and b."""
        found = pauses(text, [p for p in PAUSES if p[0] >= EVERYWHERE] if level >= EVERYWHERE else [p for p in PAUSES if p[0] == level], char_at(a), char_at(b))
        at = np.fromiter(sorted(found), np.int64, len(found))
        # a blank belongs to the next word's token: cut before the token that holds the offset
        tokens = np.searchsorted(ends, byte_of[at], side="right") if len(at) else at
        strong: dict[int, int] = {}
        for k, offset in zip(tokens.tolist(), at.tolist()):
            if a < k < b:
                strong[k] = max(found[offset], strong.get(k, 0))
        marks = sorted(strong.items())
        out, last = [], a
        for k, strength in [*marks, (b, -1)]:
            if k - last > most:
                if level > 1:
                    out += boundaries(min(level, EVERYWHERE) - 1, last, k)
                else:  # no pause within a piece's length
                    out += [(x, 0) for x in range(last + most, k, most)]
            if strength >= 0:
                out.append((k, strength))
            last = k
        return out

    marks = boundaries(EVERYWHERE, 0, total)
    bounds = [0, *(k for k, _ in marks), total]
    first = merged([b - a for a, b in zip(bounds, bounds[1:])], [s for _, s in marks], most)
    cuts = [bounds[i] for i in first] + [total]
    enc = tokenizer(path)
    out = []
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        shared = min(overlap, a) if n else 0
        while True:
            start, end, own = char_at(a - shared), char_at(b), b - a + shared
            if own > limit - MARGIN:
                own = len(enc.encode_ordinary(text[start:end]))
            if own <= limit or shared == 0:
                break
            shared = max(0, shared - (own - limit))
        out.append((start, end, own, shared))
    return out


def split_documents(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, piece_no, start, end, n_tokens, shared, text`` of every text above ``limit`` tokens."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text in zip(batch["doc_id"], batch["text"]):
                pieces = split_text(text, limit, overlap, path)
                if len(pieces) > 1:
                    rows += [(i, n, s, e, t, o, text[s:e]) for n, (s, e, t, o) in enumerate(pieces)]
            yield pd.DataFrame(rows, columns=["doc_id", "piece_no", "start", "end", "n_tokens", "shared", "text"])

    # a token has at least one byte: texts of up to `limit` bytes can't exceed the limit
    longer = docs.where(F.octet_length("text") > limit).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return longer.mapInPandas(split, "doc_id bigint, piece_no int, start bigint, end bigint, n_tokens bigint, shared int, text string")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(table(spark, sf_dir, "documents")).where("piece_no = 0").select("doc_id").distinct()


def p9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(table(spark, sf_dir, "documents"))
