"""Simple-8b: whole numbers packed into 64-bit words, several to a word.

The top four bits of a word select how many numbers it holds and how wide they are; the
other sixty bits hold the numbers, first number lowest. Numbers come in blocks of a fixed
count, each block starts a new word, and the word at which each block starts is kept, so
blocks decode independently. The last word of a block may be filled in part.

Numbers of more than sixty bits escape: two words of selector 0, with the high and the low
32 bits. As every word carries its selector, words need not be read one after another.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
ESCAPE = 0
# Fixed values of the coding: numbers in a word and bits of each, for selectors 14 down to 1.
COUNTS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
WIDTHS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    """Bits of each number: exponents of the halves, which fit a double exactly."""
    high, low = ids >> np.uint64(32), ids & np.uint64(0xFFFFFFFF)
    bits = np.frexp(low.astype(np.float64))[1].astype(np.uint8)
    if high.any():
        bits = np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, bits).astype(np.uint8)
    return bits


AT_A_TIME = 1024 * BLOCK


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``ids``, and for each block the word at which it starts."""
    words, starts, used = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    for at in range(0, len(ids), AT_A_TIME):
        some, first = _pack_blocks(np.asarray(ids[at:at + AT_A_TIME], np.uint64))
        words.append(some)
        starts.append(first + np.uint64(used))
        used += len(some)
    return np.concatenate(words), np.concatenate(starts)


def _pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = -(-len(ids) // BLOCK)
    # Past the end of a block, and of all, there are zeros.
    grid = np.zeros((blocks, BLOCK + COUNTS[-1]), np.uint64)
    whole = len(ids) // BLOCK
    grid[:whole, :BLOCK] = ids[: whole * BLOCK].reshape(whole, BLOCK)
    if whole < blocks:
        grid[whole, : len(ids) - whole * BLOCK] = ids[whole * BLOCK:]
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(ids) - BLOCK * (blocks - 1)

    choice = _widest_choice(_bit_lengths(grid[:, :BLOCK]))
    counts = np.array(COUNTS)
    at = np.zeros(blocks, np.int64)     # next number of each block
    used = np.zeros(blocks, np.int64)   # words of each block so far
    taken = []
    alive = np.arange(blocks)
    while len(alive):
        here = choice[alive, at[alive]]
        taken.append((alive, at[alive], used[alive], here))
        at[alive] += np.where(here < 0, 1, counts[here])
        used[alive] += np.where(here < 0, 2, 1)
        alive = alive[at[alive] < sizes[alive]]
    starts = np.concatenate(([0], np.cumsum(used)))
    block, first, word, chosen = (np.concatenate(parts) for parts in zip(*taken))
    place = starts[block] + word
    words = np.zeros(starts[-1], np.uint64)
    numbers, begin = grid.ravel(), block * grid.shape[1] + first
    for option, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        rows = np.flatnonzero(chosen == option)
        packed, here = np.full(len(rows), (len(COUNTS) - option) << 60, np.uint64), begin[rows]
        for j in range(count):
            packed |= numbers[here + j] << np.uint64(j * width)
        words[place[rows]] = packed
    rows = np.flatnonzero(chosen < 0)
    wide = numbers[begin[rows]]
    words[place[rows]] = wide >> np.uint64(32)
    words[place[rows] + 1] = wide & np.uint64(0xFFFFFFFF)
    return words, starts[:-1].astype(np.uint64)


def _widest_choice(bits: np.ndarray) -> np.ndarray:
    """For each place, the option that takes most numbers from there; -1 to escape."""
    choice = np.where(bits > WIDTHS[0], -1, 0).astype(np.int8)
    widest = {1: bits}   # the largest width among the next so many numbers
    for option in range(1, len(COUNTS)):
        count = COUNTS[option]
        half = max(c for c in widest if c < count)
        rest = max(c for c in widest if c <= count - half)
        reach = _joined(widest[half], widest[rest], half)
        have = half + rest
        while have < count:
            more = max(c for c in widest if c <= count - have)
            reach = _joined(reach, widest[more], have)
            have += more
        fits = reach <= WIDTHS[option]
        if not fits.any():
            break   # what fits more numbers also fits fewer
        choice[fits] = option
        widest[count] = reach
    return choice


def _joined(first: np.ndarray, second: np.ndarray, shift: int) -> np.ndarray:
    out = first.copy()
    np.maximum(out[:, :-shift], second[:, shift:], out=out[:, :-shift])
    return out


def unpack(words: np.ndarray, starts: np.ndarray, total: int) -> np.ndarray:
    """The ``total`` numbers that ``pack`` made ``words`` and ``starts`` of."""
    out = np.zeros(total, np.uint64)
    if not total:
        return out
    words = np.asarray(words, np.uint64)
    starts = np.asarray(starts).astype(np.int64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    holds = np.zeros(16, np.int64)
    holds[len(COUNTS) - np.arange(len(COUNTS))] = COUNTS
    number = holds[selector]
    escapes = np.flatnonzero(selector == ESCAPE)
    high, low = escapes[0::2], escapes[1::2]
    number[low] = 1
    before = np.cumsum(number) - number
    block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
    first = before - before[starts][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, total)
    for option, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        rows = np.flatnonzero(selector == len(COUNTS) - option)
        mask = np.uint64((1 << width) - 1)
        full = first[rows] + count <= end[rows]
        here, held, cut = first[rows[full]], words[rows[full]], rows[~full]
        for j in range(count):
            out[here + j] = (held >> np.uint64(j * width)) & mask
            inside = cut[first[cut] + j < end[cut]]   # the last words of blocks
            out[first[inside] + j] = (words[inside] >> np.uint64(j * width)) & mask
    out[first[low]] = (words[high] << np.uint64(32)) | words[low]
    return out
