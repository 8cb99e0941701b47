"""Text expressions: tokens, unescaping, paths."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "[ \\t\\r\\n]+"


def split_words(text: str | Column) -> Column:
    """Lower-case words split at blanks; a leading or trailing blank leaves an empty word."""
    return F.split(F.lower(text), SPACE)


def hash_embedder(dim: int = 64) -> Callable[[pd.Series], list[np.ndarray]]:
    """A model-free embedder: signed word counts hashed into `dim` places, scaled to unit length."""

    def place(word: str) -> tuple[int, int]:
        digest = hashlib.md5(word.encode()).hexdigest()
        return int(digest[:8], 16) % dim, 1 if int(digest[8], 16) % 2 == 0 else -1

    known: dict[str, tuple[int, int]] = {}

    def embed(texts: pd.Series) -> list[np.ndarray]:
        out = []
        if len(known) > 1_000_000:
            known.clear()
        for text in texts:
            vector = np.zeros(dim)
            for word in re.split(SPACE, (text or "").lower()):
                if word:
                    if word not in known:
                        known[word] = place(word)
                    at, sign = known[word]
                    vector[at] += sign
            norm = np.sqrt((vector * vector).sum())
            out.append(vector / norm if norm else vector)
        return out

    return embed


# Backslash sequences and what they stand for.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "'": "'", '"': '"', "\\": "\\", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}
_ESCAPE = re.compile(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|[ntr'\"\\abfv])")


def unescape_text(text: str) -> str:
    """Resolve backslash sequences; others stay as they are."""

    def resolve(match: re.Match) -> str:
        code = match.group(1)
        if code[0] in "xuU":
            return chr(int(code[1:], 16))
        if code[0] in "01234567":
            return chr(int(code, 8))
        return _ESCAPES[code]

    return _ESCAPE.sub(resolve, text)


_MARK = "\x01"  # stands for a backslash while the other sequences are replaced


def unescape(text: str | Column) -> Column:
    """Column form of `unescape_text`. Only rows with numbered sequences go through Python."""
    column = F.col(text) if isinstance(text, str) else text

    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unescape_text(t) if isinstance(t, str) else t)

    numbered = column.rlike(r"\\[xuU0-7]") | column.contains(_MARK)
    plain = F.replace(column, F.lit("\\\\"), F.lit(_MARK))
    for code, value in _ESCAPES.items():
        if code != "\\":
            plain = F.replace(plain, F.lit("\\" + code), F.lit(value))
    plain = F.replace(plain, F.lit(_MARK), F.lit("\\"))
    # A text without numbered sequences is null to the function, which costs next to nothing.
    return F.when(numbered, run(F.when(numbered, column))).otherwise(plain)


def parent_path(location: str | Column) -> Column:
    """Everything before the last path segment, outer slashes removed."""
    trimmed = F.regexp_replace(location, r"^/+|/+$", "")
    return F.regexp_extract(trimmed, r"^(.*)/[^/]*$", 1)
