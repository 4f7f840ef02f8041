"""Words and word shingles of a text as 64-bit hashes, computed with numpy inside tasks.

A word is a run of bytes other than space and \\x09-\\x0D, with A-Z lower-cased. Two different shingles get
the same hash with odds of about 2**-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE_WORDS = 5
_LONG = 64  # bytes; longer words are hashed one by one
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)
_FACTORS = np.random.Generator(np.random.PCG64(77003)).integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finalizer of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def bounds_between(blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches without blanks start and end."""
    padded = np.ones(len(blank) + 2, dtype=bool)
    padded[1:-1] = blank
    return np.flatnonzero(padded[:-1] & ~padded[1:]), np.flatnonzero(~padded[:-1] & padded[1:])


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the words start and end."""
    codes = np.frombuffer(data, dtype=np.uint8)
    return bounds_between((codes == 32) | ((codes >= 9) & (codes <= 13)))


def hashes_between(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each stretch of bytes, which are read eight at once."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    loads = np.ndarray((len(data) + 1,), dtype="<u8", buffer=data + bytes(8), strides=(1,))
    hashes = mixed((loads[starts] & _MASKS[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * _FACTORS[1])
    rest, offset = np.flatnonzero((lengths > 8) & (lengths <= _LONG)), 8
    while len(rest):
        left = lengths[rest] - offset
        hashes[rest] = mixed(hashes[rest] * _FACTORS[0] ^ loads[starts[rest] + offset] & _MASKS[np.minimum(left, 8)])
        rest, offset = rest[left > 8], offset + 8
    for i in np.flatnonzero(lengths > _LONG):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]], seed=9)
    return hashes


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word of a UTF-8 text, in order."""
    data = data.lower()  # of bytes: A-Z only
    return hashes_between(data, *word_bounds(data))


def joined_texts(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """Many texts as one, lower-cased (A-Z), with a line feed after each, and where each starts and the last ends."""
    data = "\n".join([*(x or "" for x in texts.to_pylist()), ""]).encode().lower()
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    return data, np.concatenate([[0], np.cumsum(sizes + 1)])


def row_ranges(texts: pa.Array, most_bytes: int) -> list[tuple[int, int]]:
    """The rows cut into ranges of about so many bytes of text; a longer text is a range of its own."""
    total = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    out, start = [], 0
    while start < len(texts):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + most_bytes, side="right")))
        out.append((start, end))
        start = end
    return out


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words; with fewer words, one for the whole sequence."""
    size = min(size, len(words))
    if size == 0:
        return np.empty(0, dtype=np.uint64)
    count = len(words) - size + 1
    sums = np.full(count, size * 0xD6E8FEB86659FD93 % 2**64, dtype=np.uint64)
    for i in range(size):
        sums += words[i:i + count] * _FACTORS[i]
    return mixed(sums)


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a whole text, sorted; empty for a null text or one without words."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    return np.unique(gram_hashes(word_hashes(text.encode()), size))
