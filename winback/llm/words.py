"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of characters other than the six ASCII white space characters, with A-Z lowered. Each distinct word of a
slice of texts is hashed once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, which of them stand one after the other, and how many each text has (null: none)."""
    # a copy of its own: Arrow lowers a slice that was cast to large strings from the wrong place
    texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    filled = np.fromiter(map(bool, distinct), bool, len(distinct))  # white space at an end gives an empty word
    codes = coded.indices.to_numpy()
    owners = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    real = filled[codes] if len(distinct) else np.zeros(0, bool)
    return hashes, codes[real], np.bincount(owners[real], minlength=len(texts)).astype(np.int64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after the other, and how many each text has (null: none)."""
    hashes, codes, counts = coded_words(texts)
    return hashes[codes], counts
