"""Word shingles and their XXH64 hashes, for one text at a time inside a task."""

import numpy as np
import xxhash

SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_bytes(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, in UTF-8. Splits at space and the controls tab to carriage return."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_digests(found: list[bytes], width: int) -> np.ndarray:
    """Big-endian XXH64 digests of all shingles, one row of 8 bytes each.

    A text of fewer words has one shingle, the whole of it; one without words has none.
    """
    if not found:
        return np.zeros((0, 8), np.uint8)
    joined = b" ".join(found)
    digest = xxhash.xxh64_digest
    if len(found) <= width:
        return np.frombuffer(digest(joined, SEED), np.uint8).reshape(1, 8)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8).reshape(-1, 8)
