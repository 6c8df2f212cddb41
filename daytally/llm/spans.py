"""Spans in a batch of texts: runs of bytes, and places in code points."""

import numpy as np


def byte_class(members: str) -> np.ndarray:
    """Which of the 256 bytes are among the ASCII ``members``."""
    out = np.zeros(256, bool)
    out[np.frombuffer(members.encode("ascii"), np.uint8)] = True
    return out


def maximal_runs(mask: np.ndarray, offsets: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest runs of true bytes within a row, of ``least`` bytes or more."""
    begins, stops = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    stops[:-1] &= ~mask[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = mask[first]
    stops[first[1:] - 1] = mask[first[1:] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = end - start >= least
    return start[long], end[long]


def row_of(place: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each byte."""
    return np.searchsorted(offsets, place, side="right") - 1


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte of a text, and its end, how many code points begin before it."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
