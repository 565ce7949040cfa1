"""Sizes of texts in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import ship

#: Default place of the vocabulary; every operator takes another as a parameter.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before merges, as published with this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are encoded in stretches of about so many characters, and longer runs of white space as a piece of their own, which the pattern's matcher could not hold.
STRETCH, BLANK_RUN = 100_000, 2_000
# The pattern's white space, and letters, digits and marks on whose classes every version of Unicode agrees. Between two classes the pattern always splits, but for letters after white space or after an apostrophe.
_WHITE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS, _DIGITS, _MARKS = "A-Za-z\u0430-\u044f\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3", "0-9", "!-&(-/:-@\\[-`{-~，。、；：？！「」"
_SAFE = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])|(?<=[{_LETTERS}])(?=['{_DIGITS}{_MARKS}])|(?<=[{_DIGITS}])(?=['{_LETTERS}{_MARKS}])|(?<=[{_MARKS}])(?=[{_LETTERS}{_DIGITS}])")
_BLANKS = re.compile(f"[{_WHITE}]{{{BLANK_RUN},}}")


class Tokenizer:
    """Encodes a text in stretches that end where the pattern always splits, so tokens equal those of the text in one go; a run of one class, however long, is never cut."""

    def __init__(self, ranks: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.length = np.zeros(max(table.values()) + 1, np.int64)
        for k, v in table.items():
            self.length[v] = len(k)

    def _end(self, text: str, at: int, end: int) -> int:
        """Where a stretch from at ends: the last safe place within STRETCH, or else the first one after it."""
        step = 1_000
        for hi in range(at + STRETCH, at + STRETCH // 2, -step):
            places = [m.start() for m in _SAFE.finditer(text, hi - step, hi)]
            if places and at < places[-1] < end:
                return places[-1]
        m = _SAFE.search(text, at + STRETCH)
        return min(m.start(), end) if m else end

    def _encoded(self, text: str) -> Iterator[list[int]]:
        if len(text) <= BLANK_RUN:
            yield self.enc.encode_ordinary(text)
            return
        at = 0
        # All of a run of white space but its last character before a word is one piece of the pattern.
        runs = [(m.start(), m.end() if m.end() == len(text) else m.end() - 1) for m in _BLANKS.finditer(text)]
        for a, b in [*runs, (len(text), len(text))]:
            while at < a:
                end = self._end(text, at, a) if a - at > STRETCH else a
                yield self.enc.encode_ordinary(text[at:end])
                at = end
            if a < b:
                yield self.enc._encode_single_piece(text[a:b])
            at = b

    def count(self, text: str | None) -> int:
        return sum(map(len, self._encoded(text))) if text else 0

    def ids(self, text: str) -> list[int]:
        return [i for x in self._encoded(text) for i in x]

    def ends(self, text: str, ids: list[int] | None = None) -> np.ndarray:
        """Byte positions at which the tokens of the text, ids if they are known, end."""
        ids = self.ids(text) if ids is None else ids
        return np.cumsum(self.length[np.array(ids, np.int64)]) if ids else np.zeros(0, np.int64)


@functools.lru_cache(maxsize=2)
def tokenizer(ranks: str) -> Tokenizer:
    """One for each worker process."""
    return Tokenizer(ranks)


def token_count(text: Column, ranks: str = RANKS) -> Column:
    """Tokens of each text; 0 for a null or empty one."""
    if (spark := SparkSession.getActiveSession()) is not None:
        ship(spark)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = tokenizer(ranks)
        for s in batches:
            yield pd.Series([t.count(x) for x in s], dtype="int64")

    return run(text)


def canonical_source(c: Column) -> Column:
    """Lower case, trimmed, with hyphens and inner white space as underscores; null if nothing is left."""
    x = F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))), r"[ -]", "_")
    return F.when(x != "", x)


def capacity(limits: DataFrame, profile: str) -> tuple[int, int]:
    """(capacity_tokens, overlap_tokens) of a profile in size_limits."""
    row = limits.where(F.col("profile") == profile).select("capacity_tokens", "overlap_tokens").first()
    if row is None:
        raise ValueError(f"no such profile: {profile}")
    return int(row[0]), int(row[1] or 0)
