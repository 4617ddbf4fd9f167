"""Substring dedup by level-wise doubling: remove words of windows that occur more than once.

Levels double up to the window: stretches of half a window (rounded up) that occur once end
there, only repeated ones are extended to a whole window, and those again are kept only where
the window repeats. With nothing repeated at a level, no candidate survives and the search ends.
The first level looks at one stretch in a run of windows (see `repeats`) rather than at all.

Words are what lies between the six ASCII white-space bytes, unchanged. Defined cases: a null
or empty text has no words; a row given twice counts twice, so its windows repeat; null ids
stay null; a document shorter than a window keeps everything; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hirelake.llm.common import SPACE_WORDS, documents, word_spans, word_values
from hirelake.llm.repeats import RepeatFinder


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, stops, first = word_spans(data, ends, SPACE_WORDS)
    return word_values(data, starts, stops), first


def kept_words(texts: pa.Array, covered: np.ndarray, first: np.ndarray) -> dict[str, pa.Array]:
    counts = np.diff(first)
    total = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
    removed = total[first[1:]] - total[first[:-1]]
    kept = []
    for row, text in enumerate(texts):
        words = text.as_py().encode().split()  # splits at the same six bytes
        if removed[row]:
            words = itertools.compress(words, ~covered[first[row]:first[row + 1]])
        kept.append(b" ".join(words).decode())
    return {"n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept": pa.array(kept, pa.string())}


def substring_dedup(docs: DataFrame, window: int = 35, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): kept is the words that stay, joined by one space."""
    finder = RepeatFinder(word_hashes, kept_words, "n_words long, n_removed long, kept string",
                          window, (window + 1) // 2)
    return finder.run(documents(docs, id_col, text_col)).withColumnRenamed("id", id_col)
