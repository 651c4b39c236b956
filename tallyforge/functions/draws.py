"""The first four bytes of md5 over many numbers at a time, with numpy: draws of a bootstrap that need no random state."""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np

_SINES = [int(abs(math.sin(k + 1)) * 2**32) for k in range(64)]
_TURNS = [*(7, 12, 17, 22) * 4, *(5, 9, 14, 20) * 4, *(4, 11, 16, 23) * 4, *(6, 10, 15, 21) * 4]
_WORD = [*range(16), *((5 * k + 1) % 16 for k in range(16)), *((3 * k + 5) % 16 for k in range(16)), *(7 * k % 16 for k in range(16))]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: The same as arrays without axes, which numpy takes without a conversion.
_SINE, _LEFT, _RIGHT, _FIRST = ([np.array(x, np.uint32) for x in own] for own in (_SINES, _TURNS, [32 - x for x in _TURNS], _START))
#: Digits of a number that differ within a call; a message of one md5 block has so many bytes at most.
DIGITS, ONE_BLOCK = 4, 55


def _written(digits: int) -> np.ndarray:
    """All numbers of so many digits, leading zeros included, as little-endian words of their letters."""
    n = np.arange(10**digits, dtype=np.uint32)
    return sum((n // 10 ** (digits - 1 - i) % 10 + 48).astype(np.uint32) << np.uint32(8 * i) for i in range(digits))


_LETTERS = {d: _written(d) for d in range(1, DIGITS + 1)}


def _block(prefix: bytes, letters: np.ndarray, width: int) -> np.ndarray:
    """The first four bytes, as a number, of md5 over the prefix and each word of letters."""
    size = len(prefix) + width
    if size > ONE_BLOCK:
        return np.array([int.from_bytes(hashlib.md5(prefix + x.tobytes()[:width]).digest()[:4], "big") for x in letters.astype("<u4")], np.uint32)
    words = list(struct.unpack("<16I", (prefix + bytes(width) + b"\x80").ljust(56, b"\0") + struct.pack("<Q", 8 * size)))
    at, shift = divmod(len(prefix), 4)
    shift *= 8
    own = {at: (letters << np.uint32(shift)) | np.uint32(words[at])}
    if shift + 8 * width > 32:
        own[at + 1] = (letters >> np.uint32(32 - shift)) | np.uint32(words[at + 1])
    a, b, c, d = _START
    for k in range(at):  # the same for all
        f = d ^ (b & (c ^ d))
        x = (a + f + _SINES[k] + words[k]) & 0xFFFFFFFF
        a, d, c, b = d, c, b, (b + (x << _TURNS[k] | x >> 32 - _TURNS[k])) & 0xFFFFFFFF
    a, b, c, d = (np.full(len(letters), x, np.uint32) for x in (a, b, c, d))
    t, u = np.empty_like(a), np.empty_like(a)
    for k in range(at, 61):  # what the last three rounds make isn't in the first four bytes
        if k < 16:
            np.bitwise_xor(c, d, t)
            np.bitwise_and(t, b, t)
            np.bitwise_xor(t, d, t)
        elif k < 32:
            np.bitwise_xor(b, c, t)
            np.bitwise_and(t, d, t)
            np.bitwise_xor(t, c, t)
        elif k < 48:
            np.bitwise_xor(b, c, t)
            np.bitwise_xor(t, d, t)
        else:
            np.invert(d, t)
            np.bitwise_or(t, b, t)
            np.bitwise_xor(t, c, t)
        np.add(t, a, t)
        w = _WORD[k]
        if w in own:
            np.add(t, own[w], t)
            np.add(t, _SINE[k], t)
        else:
            np.add(t, np.array((_SINES[k] + words[w]) & 0xFFFFFFFF, np.uint32) if words[w] else _SINE[k], t)
        np.right_shift(t, _RIGHT[k], u)
        np.left_shift(t, _LEFT[k], t)
        np.bitwise_or(t, u, t)
        np.add(t, b, t)
        a, b, c, d, t = d, t, b, c, a
    np.add(b, _FIRST[0], b)
    return b.byteswap()


def codes(prefix: str, n: int, at_once: int = 10**DIGITS) -> Iterator[tuple[int, np.ndarray]]:
    """For each number i under n, the first eight hexadecimal digits of md5(prefix, i) as a number: (first i, codes) in turn, of
    about at_once numbers each."""
    held: list[np.ndarray] = []
    first = size = 0
    for own in _blocks(prefix.encode(), n):
        held.append(own)
        size += len(own)
        if size >= at_once:
            yield first, np.concatenate(held)
            held, first, size = [], first + size, 0
    if held:
        yield first, np.concatenate(held)


def _blocks(head: bytes, n: int) -> Iterator[np.ndarray]:
    for width in range(1, DIGITS + 1):
        low, high = (10 ** (width - 1) if width > 1 else 0), min(n, 10**width)
        if low < high:
            yield _block(head, _LETTERS[width][low:high], width)
    step = 10**DIGITS
    for lead in range(1, -(-n // step)):
        yield _block(head + str(lead).encode(), _LETTERS[DIGITS][: n - lead * step], DIGITS)
