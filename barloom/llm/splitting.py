"""Oversized texts cut at natural boundaries, by recursive bisection, with an overlap between neighbouring pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.tokens import RANKS, Tokenizer, tokenizer
from barloom.session import ship

# Strengths of natural boundaries; the cut lies after the white space or the mark. Marks of compact data, which has no white space, are weaker than those of language: the comma between two records, and any other. Any other place between two characters is weaker than all of them.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, RECORD, MARK = 7, 6, 5, 4, 3, 2, 1
# Marks that end a sentence or a clause before white space, what may close a quotation between, and marks of wide scripts that end one by themselves.
ENDS, PAUSES, CLOSERS, WIDE_ENDS, WIDE_PAUSES = ".!?…", ",;:", "\"')]", "。！？", "，；：、"
# Marks of compact data, and what may follow a closing brace that still belongs to it.
MARKS, AFTER_BRACE = ",;}", ",;}])"


#: Tokens a piece may gain when it is counted by itself, since its ends can cut a word.
SLACK = 4


def _one_of(c: np.ndarray, chars: str) -> np.ndarray:
    return np.isin(c, [ord(k) for k in chars])


def _white(c: np.ndarray) -> np.ndarray:
    return (c == 32) | ((c >= 9) & (c <= 13)) | ((c >= 28) & (c <= 31)) | (c == 0x85) | (c == 0xA0) | (c == 0x1680) | ((c >= 0x2000) & (c <= 0x200A)) | (c == 0x2028) | (c == 0x2029) | (c == 0x202F) | (c == 0x205F) | (c == 0x3000)


def structure(text: str) -> np.ndarray:
    """As boundaries(), of the marks of compact data without white space after them: RECORD after the comma of '},{', MARK after any other of MARKS; 0 elsewhere."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    strength = np.zeros(len(c) + 1, np.int8)
    mark, after = c[:-1], c[1:]
    strength[1:-1][_one_of(mark, MARKS) & ~_white(after) & ~((mark == ord("}")) & _one_of(after, AFTER_BRACE))] = MARK
    strength[2:-1][(c[:-2] == ord("}")) & (c[1:-1] == ord(",")) & (c[2:] == ord("{"))] = RECORD
    return strength


def boundaries(text: str) -> np.ndarray:
    """The strength of the boundary before each character, and after the last; 0 at both ends and where there is none.

    A run of white space gives one at its end: a paragraph's with two line breaks in it, else by what stands before it; and after each line break in it a line's."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(c)
    white = _white(c)
    strength = np.zeros(n + 1, np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], white, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    strength[end] = WORD
    at = start - 1  # the character before each run, quotations' closers skipped
    for _ in range(3):
        ok = at >= 0
        at = np.where(ok & _one_of(c[np.maximum(at, 0)], CLOSERS), at - 1, at)
    before, plain = c[np.maximum(at, 0)], c[np.maximum(start - 1, 0)]
    strength[end[(start > 0) & _one_of(plain, PAUSES)]] = CLAUSE
    strength[end[(at >= 0) & _one_of(before, ENDS)]] = SENTENCE
    for chars, rank in ((WIDE_PAUSES, CLAUSE), (WIDE_ENDS, SENTENCE)):
        i = np.flatnonzero(_one_of(c, chars)) + 1
        strength[i] = np.maximum(strength[i], rank)
    breaks = (c == 10) | ((c == 13) & (np.append(c[1:], 0) != 10))
    i = np.flatnonzero(breaks) + 1
    strength[i] = LINE
    lines = np.concatenate([[0], np.cumsum(breaks)])
    strength[end[lines[end] - lines[start] >= 2]] = PARAGRAPH
    strength[[0, n]] = 0
    return strength


class _Text:
    """A text with the number of its tokens before any character, and its natural boundaries."""

    def __init__(self, text: str, t: Tokenizer, ids: list[int] | None = None):
        self.text, self.t = text, t
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        starts = np.flatnonzero((raw & 0xC0) != 0x80)
        ended = np.zeros(len(raw) + 1, np.int8)
        ended[t.ends(text, ids)] = 1
        #: before[i]: tokens that end at or before character i.
        self.before = np.cumsum(ended, dtype=np.int64)[np.append(starts, len(raw))]
        strength = boundaries(text)
        strength = np.where(strength > 0, strength, structure(text))
        self.at = np.flatnonzero(strength)
        self.strength = strength[self.at]

    def size(self, a: int, b: int) -> int:
        return int(self.before[b] - self.before[a])

    def count(self, a: int, b: int) -> int:
        """Tokens of the characters from a to b by themselves. Before a single space between two words the pattern splits whatever stands around it, so between the first and the last such place the tokens are those of the whole text, and only the ends are encoded anew."""
        text = self.text
        f = text.find(" ", a + 1, b - 1)
        while f > 0 and (text[f - 1].isspace() or text[f + 1].isspace()):
            f = text.find(" ", f + 1, b - 1)
        if f > 0:
            g = text.rfind(" ", f, b - 1)
            while g > f and (text[g - 1].isspace() or text[g + 1].isspace()):
                g = text.rfind(" ", f, g)
            return self.t.count(text[a:f]) + self.size(f, g) + self.t.count(text[g:b])
        return self.t.count(text[a:b])

    def char_at(self, tokens: int) -> int:
        """The last character position with at most so many tokens before it."""
        return int(np.searchsorted(self.before, tokens, "right")) - 1

    def cut(self, a: int, b: int) -> int:
        """Where to cut between a and b: the strongest boundary in the middle half of the tokens, of equals the nearest to the midpoint; without any there, the boundary of the span nearest to it; without any at all, the place between two tokens nearest to it."""
        lo, n = int(self.before[a]), self.size(a, b)
        mid = lo + n / 2
        left, right = self.char_at(lo + n // 4), self.char_at(lo + n - n // 4)
        i, j = np.searchsorted(self.at, max(left, a + 1)), np.searchsorted(self.at, min(right, b - 1), "right")
        if j > i:
            s = self.strength[i:j]
            best = np.flatnonzero(s == s.max()) + i
            return int(self.at[best[np.argmin(np.abs(self.before[self.at[best]] - mid))]])
        first, last = np.searchsorted(self.at, a, "right"), np.searchsorted(self.at, b)
        if last > first:  # all of them outside: those next to the middle half
            near = self.at[[k for k in (min(i, last) - 1, i) if first <= k < last]]
            return int(near[np.argmin(np.abs(self.before[near] - mid))])
        return min(max(self.char_at(int(mid)), a + 1), b - 1)


def pieces(text: str, t: Tokenizer, limit: int, overlap: int, ids: list[int] | None = None) -> list[tuple[int, int, int, int]]:
    """(start, core start, end, tokens) in characters of the pieces of a text with more than limit tokens. Cores follow each other without a gap; a piece begins overlap tokens before its core, at the nearest character at or before that token. ids: the text's tokens, if they are known. Every piece, counted by itself, has at most limit tokens; only a single character of more than limit tokens is left as it is."""
    x = _Text(text, t, ids)
    most = max(1, limit - overlap - (SLACK if limit - overlap > 2 * SLACK else 0))
    todo, out = [(0, len(text))], []
    while todo:
        a, b = todo.pop()
        if b - a > 1 and x.size(a, b) > most:
            c = x.cut(a, b)
            todo += [(c, b), (a, c)]
            continue
        start = x.char_at(int(x.before[a]) - overlap) if a and overlap else a
        start = max(0, min(start, a))
        n = x.count(start, b)
        if n > limit and b - a > 1:
            c = x.cut(a, b)
            todo += [(c, b), (a, c)]
            continue
        while n > limit and start < a:  # one wide character: the overlap gives way
            start += 1
            n = x.count(start, b)
        out.append((start, a, b, n))
    return out


def full_pieces(text: str, t: Tokenizer, limit: int, overlap: int = 0, ids: list[int] | None = None) -> list[tuple[int, int, int, int]]:
    """As pieces(), without overlap and for filling containers: each piece but the last ends at the strongest boundary in the last eighth of the limit, of equals the latest, or without any between two tokens, so little of the limit is left over."""
    x = _Text(text, t, ids)
    a, out = 0, []
    while a < len(text):
        lo, room = int(x.before[a]), limit
        while True:
            b = len(text) if x.size(a, len(text)) <= room else max(x.char_at(lo + room), a + 1)
            if b < len(text):
                i, j = np.searchsorted(x.at, max(x.char_at(lo + room - limit // 8), a + 1)), np.searchsorted(x.at, b, "right")
                if j > i:
                    s = x.strength[i:j]
                    b = int(x.at[i + np.flatnonzero(s == s.max())[-1]])
            n = x.count(a, b)
            if n <= limit or b == a + 1:
                break
            room = max(1, room - max(1, n - limit))
        out.append((a, a, b, n))
        a = b
    return out


SHAPE = "doc_id long, piece_no int, start_char long, core_char long, end_char long, n_tokens int, text_tokens int, piece string"


def split_long(docs: DataFrame, limit: int, overlap: int, ranks: str = RANKS, keep_short: bool = False, with_text: bool = True, cut: Callable = pieces) -> DataFrame:
    """The pieces of each text with more than limit tokens, in order: doc_id, piece_no from 0, start_char (with the overlap), core_char (without), end_char, n_tokens of the piece, text_tokens of the whole text, and the piece itself. overlap must be less than limit.

    docs: (doc_id, text); other columns are ignored. Texts within the limit give no row, or one whole piece if keep_short. Null and empty texts have no tokens and give no row. Repeated rows are cut each for itself. A text without any natural place is cut between tokens, never inside a character. No text has more tokens than bytes, so texts of at most limit bytes need not be encoded to know that they fit. with_text=False leaves piece null. cut: the function of (text, tokenizer, limit, overlap, token ids) that cuts.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(ranks)
        names = [c.split()[0] for c in SHAPE.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = t.ids(text)
                n = len(ids)
                if n > limit:
                    rows += [(doc, i, s, c, e, k, n, text[s:e] if with_text else None) for i, (s, c, e, k) in enumerate(cut(text, t, limit, overlap, ids))]
                    held += len(text)
                elif keep_short and n:
                    rows.append((doc, 0, 0, 0, len(text), n, n, text if with_text else None))
                if held > 4_000_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)

    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null and text <> ''")
    if not keep_short:
        texts = texts.where(F.octet_length("text") > limit)
    return texts.mapInPandas(run, SHAPE)
