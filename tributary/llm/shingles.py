"""Word shingles of a text and their 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
_digest = xxhash.xxh64_intdigest


def hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, A-Z lower-cased, repeats included, in order. A text of
    fewer words is one shingle, one without words has none."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # ASCII only, both
    if not found:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([_digest(joined, SEED)], dtype=np.uint64)
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - words].tolist()
    stops = ends[words - 1:].tolist()
    return np.fromiter(
        (_digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=len(starts)
    )


def simhash(hashed: np.ndarray) -> int:
    """Bit j is 1 if it is 1 in over half of the hashes; 0 for none. Signed, as Spark's bigint."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashed), 65536):  # bounds the memory a long text takes
        part = np.ascontiguousarray(hashed[at:at + 65536]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashed)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])
