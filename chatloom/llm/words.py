"""Hashes of the words of many texts at once.

The bytes of a batch of texts are one array. Each byte has a random 64-bit value
(A-Z that of a-z, white space none), a word's hash is the sum of its bytes' values
times the powers of an odd number, and with one running sum over the batch every
word costs the same few array operations, however many words there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on together; a longer text is one run of its own.
RUN_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xBF58476D1CE4E5B9)
_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit values spread evenly, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MUL
    x = (x ^ (x >> np.uint64(27))) * _ODD
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    values = mix(mix(np.arange(1, 257, dtype=np.uint64) * _ODD) + _MUL)
    values[65:91] = values[97:123]
    values[IS_SPACE] = 0
    return values


_VALUES = _byte_values()
_POWERS: dict[int, np.ndarray] = {}


def _powers(of: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``of`` modulo 2^64."""
    have = _POWERS.get(of)
    if have is None or len(have) < n:
        steps = np.full(max(n, RUN_BYTES + 1), np.uint64(of))
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= 4 * RUN_BYTES:
            _POWERS[of] = have
    return have[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n + 1 places where its texts begin; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    places = np.frombuffer(offsets, kind, texts.offset + len(texts) + 1)[texts.offset :].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def runs(places: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``size`` bytes together, or one text."""
    a = 0
    while a < len(places) - 1:
        b = max(a + 1, int(np.searchsorted(places, places[a] + size, "right")) - 1)
        yield a, b
        a = b


def word_hashes(raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the n + 1 places where the texts' words begin among them."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(places), np.int64)
    inside = ~IS_SPACE[raw]
    # a word begins where white space or another text goes before
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = places[:-1][places[:-1] < n]
    begins[first] = inside[first]
    last = np.empty(n, bool)
    last[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    last[-1] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(last)
    total = np.cumsum(_VALUES[raw] * _powers(_STEP, n), dtype=np.uint64)
    sums = total[end]
    before = np.where(start > 0, total[start - 1], np.uint64(0))
    hashes = mix((sums - before) * _powers(_BACK, n)[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(start, places)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of ``size`` words.

    A text of fewer words has one shingle, which is no window of any other text
    of ``size`` words; null and empty texts have none.
    """
    raw, places = text_bytes(texts)
    for a, b in runs(places):
        words, first = word_hashes(raw[places[a] : places[b]], places[a : b + 1] - places[a])
        whole = words[: max(0, len(words) - size + 1)].copy()
        for k in range(1, size):
            whole = whole * _ODD + words[k : k + len(whole)]
        whole = mix(whole + np.uint64(size))
        for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if y - x >= size:
                s = np.sort(whole[x : y - size + 1])
                if len(s) > 1 and not (new := s[1:] != s[:-1]).all():
                    s = np.concatenate([s[:1], s[1:][new]])
                yield s
            elif y == x:
                yield np.zeros(0, np.uint64)
            else:
                h = words[x : x + 1]
                for k in range(x + 1, y):
                    h = h * _ODD + words[k : k + 1]
                yield mix(h + np.uint64(y - x))
