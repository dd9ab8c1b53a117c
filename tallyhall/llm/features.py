"""String features of whole texts as 64-bit hashes, and their bounded models.

Features are made once for each distinct word of a slice and gathered by
number.  A model is a sorted array of hashes with a weight each, so a feature
that the model does not have weighs nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

MARKS = ".,;:!?\"'()[]{}…-"


def hashed(strings: pa.Array, kind: str) -> np.ndarray:
    """Hashes of strings; equal strings of two kinds differ."""
    values = strings.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(values, hash_key=f"{kind:0<16.16}", categorize=False) if len(values) else np.zeros(0, np.uint64)


class Words:
    """The words of each text: ``row`` and ``code`` of every word in order,
    and the distinct words by code."""

    def __init__(self, texts: pa.Array):
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        named = cut.flatten().dictionary_encode()
        code = named.indices.to_numpy()
        row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(cut.offsets.to_numpy()))
        blank = pc.index_in(pa.array([""], pa.string()), value_set=named.dictionary)[0].as_py()
        if blank is not None:  # white space at an end gives an empty word
            code, row = code[code != blank], row[code != blank]
        self.code, self.row, self.words, self.n = code, row, named.dictionary, len(texts)

    def runs(self, n: int) -> np.ndarray:
        """Places where n words of one text follow each other."""
        at = np.arange(max(0, len(self.row) - n + 1))
        return at[self.row[at] == self.row[at + n - 1]]


def distinct(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, by row and feature."""
    order = np.lexsort((feature, row))
    row, feature = row[order], feature[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (feature[1:] != feature[:-1])
    return row[new], feature[new]


def number_in(features: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Each feature's number in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(features), -1)
    at = np.minimum(np.searchsorted(known, features), len(known) - 1)
    return np.where(known[at] == features, at, -1)


def numbered(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, number) of the features that ``known`` has.  ``parts``
    are (row, code, features by code): a feature is looked up once per code."""
    rows, numbers = [], []
    for row, code, features in parts:
        number = number_in(features, known)[code]
        hit = number >= 0
        rows.append(row[hit])
        numbers.append(number[hit])
    return distinct(np.concatenate(rows), np.concatenate(numbers))


def all_pairs(column: pa.Array, parts_of, rows: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) of all features of the texts, made ``rows``
    texts at a time."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for low in range(0, len(column), rows):
        parts = parts_of(column.slice(low, rows))
        row, feature = distinct(np.concatenate([r for r, _, _ in parts]), np.concatenate([f[c] for _, c, f in parts]))
        out.append((row + low, feature))
    return np.concatenate([r for r, _ in out]), np.concatenate([f for _, f in out])
