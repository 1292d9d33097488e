"""Chunks of at most a number of characters, on paragraph and sentence borders: folds whose resets depend on the data.

Texts within the limit are one chunk and never reach Python; longer ones are folded in Arrow batches.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import SPACE

_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


class _Fold:
    """Parts gathered up to the limit; a part that is longer than the limit alone is cut."""

    def __init__(self, limit: int):
        self.limit, self.done, self.held = limit, [], ""

    def flush(self) -> None:
        if self.held:
            self.done.append(self.held)
        self.held = ""

    def fits(self, part: str, glue: str) -> bool:
        joined = f"{self.held}{glue}{part}" if self.held else part
        if len(joined) > self.limit:
            return False
        self.held = joined
        return True

    def add(self, part: str, glue: str = " ") -> None:
        if not self.fits(part, glue):
            self.flush()
            cut = max(0, -(-len(part) // self.limit) - 1) * self.limit
            self.done += [part[i : i + self.limit] for i in range(0, cut, self.limit)]
            self.held = part[cut:]


def chunk_paragraphs(text: str, limit: int = fixed.CHUNK_CHARS, keep_pipes: bool = True) -> list[str]:
    """Lines first, then sentences of a line that is too long. Without keep_pipes a "|" in such a line is lost."""
    if len(text) <= limit:
        return [text] if text else []
    fold = _Fold(limit)
    for line in text.split("\n"):
        if fold.fits(line, "\n"):
            continue
        fold.flush()
        if fold.fits(line, "\n"):
            continue
        parts = re.split(r"(?<=[?!.]) ", line)
        for part in parts if keep_pipes else [p for s in parts for p in s.split("|")]:
            fold.add(part)
    fold.flush()
    return fold.done


def chunk_sentences(text: str, limit: int = fixed.CHUNK_CHARS) -> list[str]:
    if len(text) <= limit:
        return [text] if text else []
    fold = _Fold(limit)
    for part in split_sentences(text):
        fold.add(part)
    fold.flush()
    return fold.done


def split_sentences(text: str) -> list[str]:
    return [p for p in _SENTENCE_END.split(text) if p.strip()] or [text]


def split_halves(text: str) -> list[str]:
    """Two parts around the blank nearest to the middle; cut in the middle where there is none."""
    middle = len(text) // 2
    left, right = text.rfind(" ", 0, middle + 1), text.find(" ", middle)
    at = min((p for p in (left, right) if p > 0), key=lambda p: abs(p - middle), default=middle)
    return [p for p in (text[:at].strip(), text[at:].strip()) if p]


def _udf(fold):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else fold(t) for t in text])

    return run


def chunks(text: Column, limit: int = fixed.CHUNK_CHARS, by: str = "paragraphs", keep_pipes: bool = True) -> Column:
    fold = _udf(lambda t: chunk_paragraphs(t, limit, keep_pipes) if by == "paragraphs" else chunk_sentences(t, limit))
    short = F.when(F.length(text) > 0, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.when(F.length(text) <= limit, short).otherwise(fold(F.when(F.length(text) > limit, text)))


def sentences(text: Column) -> Column:
    """Sentences for translation, cut after . ! ? and white space; blank ones dropped, the text itself if none is left."""
    parts = F.filter(F.split(text, f"(?U)(?<=[.!?]){SPACE}+"), lambda s: F.length(F.regexp_replace(s, f"(?U){SPACE}+", "")) > 0)
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(text))
