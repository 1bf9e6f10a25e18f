"""CRC-32 of many spans of one byte array at once, from a table of what a byte adds by its distance from the span's end.

The register after a message is linear in its bytes: byte b at distance d from the end adds TABLE[d][b], and all
additions meet by XOR, so the checksum of every span is one ``bitwise_xor.reduceat``. What the start value of the register
adds depends on the length alone (START). Spans longer than ``BLOCK`` are cut into blocks from the end; a block's sum is
pushed through the next block by four tables of one step of ``BLOCK`` bytes each.
"""

from __future__ import annotations

import numpy as np

#: The reflected polynomial of CRC-32 and its start value, which is also XORed to the end.
POLYNOMIAL, ONES = 0xEDB88320, 0xFFFFFFFF
#: Bytes that the position table reaches.
BLOCK = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


def _zeros(register: np.ndarray, count: int) -> np.ndarray:
    """The register after ``count`` more bytes of zero."""
    for _ in range(count):
        register = (register >> 8) ^ _ONE[register & 0xFF]
    return register


_ONE = _byte_table()
TABLE = np.stack([_zeros(_ONE, d) for d in range(BLOCK)])
START = np.stack([_zeros(np.array(ONES, np.uint32), n) for n in range(BLOCK + 1)])
_PUSH = np.stack([_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), BLOCK) for k in range(4)])


def _push(register: np.ndarray) -> np.ndarray:
    """The register after ``BLOCK`` more bytes of zero, from its four bytes."""
    moved = _PUSH[0][register & 0xFF]
    for k in (1, 2, 3):
        moved = moved ^ _PUSH[k][(register >> np.uint32(8 * k)) & 0xFF]
    return moved


def _sums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XOR of the table over the bytes of every span (of 1 to ``BLOCK`` bytes)."""
    edges = np.concatenate(([0], np.cumsum(sizes)))
    inside = np.arange(edges[-1]) - np.repeat(edges[:-1], sizes)
    added = TABLE[np.repeat(sizes, sizes) - 1 - inside, data[np.repeat(starts, sizes) + inside]]
    return np.bitwise_xor.reduceat(added, edges[:-1])


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of ``data[start:end]`` (bytes) for every span; an empty span has 0."""
    sizes = ends - starts
    found = np.zeros(len(sizes), np.uint32)
    short = np.flatnonzero((sizes > 0) & (sizes <= BLOCK))
    if len(short):
        found[short] = _sums(data, starts[short], sizes[short]) ^ START[sizes[short]]
    left = np.flatnonzero(sizes > BLOCK)
    if len(left):
        # The first block of a span takes what the others leave, so the rest are whole.
        first = (sizes[left] - 1) % BLOCK + 1
        at = starts[left] + first
        register = _sums(data, starts[left], first) ^ START[first]
        while len(left):
            register = _push(register) ^ _sums(data, at, np.full(len(left), BLOCK))
            at = at + BLOCK
            open_ = at < ends[left]
            found[left[~open_]] = register[~open_]
            left, at, register = left[open_], at[open_], register[open_]
        long = sizes > BLOCK
        found[long] ^= np.uint32(ONES)
    found[short] ^= np.uint32(ONES)
    return found
