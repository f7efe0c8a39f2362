"""Vectorised 64-bit hashes of runs of symbols, for work inside tasks."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
R = 0x9E3779B97F4A7C15


def constant(k: int) -> np.uint64:
    """k times the base multiplier, modulo 2^64."""
    return np.uint64(k * R & _MASK)


R1, R2 = np.uint64(R), np.uint64(R * R & _MASK)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def run_hashes(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each run symbols[starts[k]:starts[k+1]], the last one to the end; `starts` ascends from 0."""
    lengths = np.diff(np.append(starts, len(symbols)))
    powers = np.multiply.accumulate(np.full(int(lengths.max()), R1))
    place = np.arange(len(symbols)) - np.repeat(starts, lengths)
    return mixed(np.add.reduceat((symbols.astype(np.uint64) + np.uint64(1)) * powers[place], starts))
