"""Words of many texts as 64-bit hashes, computed on whole Arrow buffers.

Nothing here loops over words in Python. A text is read as UTF-8 bytes, A-Z
counts as a-z, and a word is a longest run of bytes that are no separators.
Texts are handled in blocks of a few megabytes, so that the working arrays stay
small however long a batch is; only a single text longer than a block makes a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Every ASCII byte that is neither a letter nor a digit.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(b).isalnum() for b in range(128)]

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters() -> np.ndarray:
    values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
    values[65:91] = values[97:123]
    return values


LETTERS = _letters()
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 64, 2 * len(_powers))
        _powers = np.cumprod(np.full(size, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)
    return _powers


def text_array(column: pa.Array) -> pa.Array:
    """A string column with empty texts in place of nulls, as 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes each; at least one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def hash_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts ``data[offsets[i]:offsets[i + 1]]``, one after
    another, and where each text's words start (one more entry than texts)."""
    begin = int(offsets[0])
    text = data[begin : int(offsets[-1])]
    bounds = offsets - begin
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~separators[text]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = bounds[:-1][bounds[:-1] < len(text)]
    starts[cut] = inside[cut]
    at = np.flatnonzero(starts)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    place = np.arange(len(text), dtype=np.int32)
    lengths = np.diff(np.append(at, len(text)))
    place[at[0] :] -= np.repeat(at.astype(np.int32), lengths)
    place[: at[0]] = 0
    # Only bytes up to the end of the word count, so long gaps need no powers.
    place[~inside] = 0
    weights = _power_table(int(place.max()) + 1)
    value = LETTERS[text] * weights[place]
    value[~inside] = 0
    hashes = mix(np.add.reduceat(value, at))
    return hashes, np.searchsorted(at, bounds).astype(np.int64)


def shingles(words: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words within a text, and their offsets.

    A text with fewer words gives one shingle of all of them; a text without
    words gives none.
    """
    counts = np.diff(offsets)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=out[1:])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    first = np.repeat(offsets[:-1] - out[:-1], made) + np.arange(out[-1])
    padded = np.append(words, np.zeros(width, np.uint64))
    total = np.zeros(out[-1], np.uint64)
    short = np.repeat(np.minimum(counts, width), made)
    factors = np.cumprod(np.full(width, 0xA0761D6478BD642F, np.uint64), dtype=np.uint64)
    for k in range(width):
        term = padded[first + k] * factors[k]
        if k:
            term[short <= k] = 0
        total += term
    # The length keeps short texts apart from runs that begin alike.
    return mix(total + short.astype(np.uint64)), out


def distinct_per_text(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats, and their offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.searchsorted(owner, np.arange(len(offsets))).astype(np.int64)


BYTES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)


def hash_strings(strings: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each byte string; upper and lower case differ."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    full = np.flatnonzero(lengths)
    out = np.zeros(len(strings), np.uint64)
    if len(full):
        text = np.frombuffer(b"".join(strings), np.uint8)
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(text)) - np.repeat(starts, lengths)
        value = BYTES[text] * _power_table(int(lengths.max()))[place]
        out[full] = np.add.reduceat(value, starts[full])
    return mix(out + lengths.astype(np.uint64))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as one array and its offsets."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets
