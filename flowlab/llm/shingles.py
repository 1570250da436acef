"""Word shingle sets of Arrow batches, as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20  # of text looked at together


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of about `limit` bytes each, so that a batch of long texts is
    never taken apart all at once."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, A-Z lower-cased, and where each text's begin."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    values, at = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    kept = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(kept)])
    return values.filter(pa.array(kept)), before[at - at[0]]


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its `size`-word shingles; a text of fewer
    words is one shingle, a text without words none."""
    for _, part in slices(texts):
        values, at = words(part)
        coded = values.dictionary_encode()
        codes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
                            np.uint64, len(coded.dictionary))
        each = codes[coded.indices.to_numpy()]
        n = max(len(each) - size + 1, 0)
        hashed = np.zeros(n, np.uint64)
        for i in range(size):
            hashed = mix(hashed + each[i:i + n] + np.uint64(i + 1))
        for start, stop in zip(at[:-1], at[1:]):
            if stop - start >= size:
                yield np.unique(hashed[start:stop - size + 1])
            elif stop > start:
                yield np.array([xxhash.xxh3_64_intdigest(each[start:stop].tobytes())], np.uint64)
            else:
                yield np.empty(0, np.uint64)


def set_digest(shingles: np.ndarray) -> bytes:
    """Equal for equal sets, 128 bits."""
    return xxhash.xxh3_128_digest(shingles.tobytes())
