"""Expressions over reads: qualities, mismatches, runs of a base."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


_CHANCES = {33: 10.0 ** (-(np.arange(128) - 33) / 10.0)}


def error_chances(qual: str, offset: int = 33) -> np.ndarray:
    """The error chance that each character of a Phred string stands for."""
    if qual.isascii():
        if offset not in _CHANCES:
            _CHANCES[offset] = 10.0 ** (-(np.arange(128) - offset) / 10.0)
        return _CHANCES[offset][np.frombuffer(qual.encode(), np.uint8)]
    return 10.0 ** (-(np.frombuffer(qual.encode("utf-32-le"), np.uint32) - float(offset)) / 10.0)


def expected_errors(qual: Column, offset: int = 33) -> Column:
    """Sum of the error chances that a Phred string stands for; null for null. One pass over each string's bytes."""

    @F.pandas_udf("double")
    def errors(quals: pd.Series) -> pd.Series:
        return pd.Series([None if q is None else float(error_chances(q, offset).sum()) for q in quals], dtype="float64")

    return errors(qual)


def hamming(a: Column, b: Column) -> Column:
    """Positions of ``a`` at which ``b`` differs or ends; longer ``b`` don't count against it."""
    places = F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1)))
    return F.size(F.filter(places, lambda i: (i <= F.length(a)) & (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))))


def count_char(seq: Column, char: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(char), F.lit("")))


def has_run(seq: Column, length: int = 20, bases: str = "ACGT") -> Column:
    return seq.rlike("|".join(f"{b}{{{length}}}" for b in bases))


def only_ascii(text: Column, mark: str = "?") -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", mark)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def kmers(seq: Column, k: int) -> Column:
    """Distinct words of length k; none for shorter sequences."""
    n = F.length(seq) - k + 1
    words = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(seq, i, F.lit(k)))
    return F.when(n >= 1, F.array_distinct(words)).otherwise(F.array().cast("array<string>"))


def identity(a: Column, b: Column) -> Column:
    """1 - edit distance / the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)
