"""Sets of hashed word shingles, for many texts at once."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_rng = np.random.default_rng(20240229)
#: A random number for each byte, A-Z as a-z; blanks are zero.
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            all_ = np.full(n, base, dtype=np.uint64)
            all_[0] = 1
            _powers[k] = np.cumprod(all_, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its ``words``-word shingles, A-Z lower-cased.

    A text of fewer words has one shingle, all its words; one without words has none. Hashes stand for the shingles:
    two different ones agree with a probability of about 2^-64.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])]).astype(np.int64)
    data = np.frombuffer(b" ".join([*encoded, b""]) or b" ", dtype=np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    power, inverse = _power(len(data) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64)])
    hashes = mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * _STEP)
    first = np.searchsorted(begin, starts)
    out = []
    whole = np.full(max(0, len(hashes) - words + 1), words, dtype=np.uint64)
    for k in range(words if len(whole) else 0):
        whole = (whole ^ hashes[k : k + len(whole)]) * _STEP
        whole ^= whole >> np.uint64(29)
    whole = mixed(whole)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(whole[a : b - words + 1]))
        elif b > a:
            own = np.full(1, b - a, dtype=np.uint64)
            for h in hashes[a:b]:
                own = (own ^ h) * _STEP
                own ^= own >> np.uint64(29)
            out.append(mixed(own))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
