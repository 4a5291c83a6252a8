"""Words of many texts at once: places and hashes as arrays."""

from __future__ import annotations

import numpy as np

from paperloom.llm.common import hash_powers, mix


def lowered_bytes(separators: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with A-Z lowered, and whether it belongs to a word."""
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    inside = np.ones(256, bool)
    inside[separators] = False
    return low, inside


def word_table(data: np.ndarray, offsets: np.ndarray, low: np.ndarray, inside: np.ndarray) -> dict:
    """Words of texts laid end to end: lowered bytes, starts, ends, the text's number, hash sums."""
    numbers = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    low, inside = low[data], inside[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = hash_powers(max(len(data), len(starts)) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(numbers[low] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    sums = np.zeros(len(starts) + 1, np.uint64)
    np.cumsum(hashes * up[: len(starts)], out=sums[1:])
    owner = np.searchsorted(offsets, starts, "right") - 1
    return {"low": low, "starts": starts, "ends": ends, "owner": owner, "sums": sums, "down": down}


def window_hashes(words: dict, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and whether it lies in one text."""
    count = max(len(words["starts"]) - size + 1, 0)
    hashes = mix((words["sums"][size : size + count] - words["sums"][:count]) * words["down"][:count])
    return hashes, words["owner"][size - 1 : size - 1 + count] == words["owner"][:count]
