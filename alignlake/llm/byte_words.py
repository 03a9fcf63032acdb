"""Words of many texts at once, as runs of bytes in one array of UTF-8."""

from __future__ import annotations

import numpy as np

LANES = 16


def mixed(x: np.ndarray) -> np.ndarray:
    """An invertible mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def lower_table() -> np.ndarray:
    """Bytes with A-Z in lower case."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return lower


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of true values."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lanes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers per word: its bytes, up to 16 of them, else a digest of all."""
    import xxhash

    sizes = ends - starts
    out = np.append(data, np.zeros(LANES, np.uint8))[starts[:, None] + np.arange(LANES)]
    out[np.arange(LANES) >= sizes[:, None]] = 0
    out = out.view(np.uint64)
    for i in np.flatnonzero(sizes > LANES):
        out[i] = np.frombuffer(xxhash.xxh3_128_digest(data[starts[i] : ends[i]].tobytes()), np.uint64)
    return out


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word."""
    both = lanes(data, starts, ends)
    return mixed(both[:, 0] + mixed(both[:, 1] + mixed((ends - starts).astype(np.uint64))))
