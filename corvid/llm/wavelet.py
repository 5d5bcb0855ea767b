"""A wavelet matrix over token ids, with its file format.

The distinct ids of a shard are its alphabet, in ascending order; each token is
its place there.  Plane k holds bit ``levels - 1 - k`` of every place, the
sequence being stably parted by that bit (zeros first) before the next plane.
Access, rank (how often a token occurs before a position), select (where its
k-th occurrence is), counting and listing occurrences need the planes only.

File: magic ``CWM2``, a little-endian uint32 length and a JSON header (token
count, zeros of each plane, block size, part lengths), then zstd frames: the
alphabet (uint32), document ids (int64), document lengths (uint32), the rank
directory (uint32: for each plane and block, the ones before the block and the
length of its frame), and the blocks of each plane (packed bits, little-endian
in a byte).  ``opened`` reads header, alphabet and directory, and of the planes
only the blocks that a question needs: one block a plane for an access or rank.
"""

from __future__ import annotations

import functools
import io
import json
import struct
from collections.abc import Callable
from typing import BinaryIO

import numpy as np
import zstandard

MAGIC = b"CWM2"
BLOCK = 1 << 16  # bits between the samples of a plane's rank directory, and in a frame


class Plane:
    """One bit vector with rank and select: ``samples`` are the ones before each block, ``block`` gives the bytes of a block."""

    def __init__(self, n: int, samples: np.ndarray, block: Callable[[int], np.ndarray]):
        self.n, self.samples, self.block = n, samples, block

    @classmethod
    def of(cls, packed: np.ndarray, n: int) -> Plane:
        size = BLOCK // 8
        ones = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), size), dtype=np.int64) if len(packed) else np.zeros(0, np.int64)
        return cls(n, np.concatenate([[0], np.cumsum(ones)]), lambda k: packed[k * size : (k + 1) * size])

    @property
    def blocks(self) -> int:
        return -(-self.n // BLOCK)

    def packed(self) -> np.ndarray:
        return np.concatenate([self.block(k) for k in range(self.blocks)]) if self.n else np.zeros(0, np.uint8)

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed(), count=self.n, bitorder="little").view(bool)

    def get(self, i: int) -> int:
        return int(self.block(i // BLOCK)[i % BLOCK >> 3]) >> (i & 7) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        k, inside = divmod(i, BLOCK)
        ones = int(self.samples[k])
        if inside:
            block = self.block(k)
            ones += int(np.bitwise_count(block[: inside >> 3]).sum(dtype=np.int64))
            if inside & 7:
                ones += (int(block[inside >> 3]) & (1 << (inside & 7)) - 1).bit_count()
        return ones

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """The position of the k-th (from 0) such bit: its block by the directory, then its place inside."""
        starts = np.arange(len(self.samples), dtype=np.int64) * BLOCK
        before = self.samples if bit else starts - self.samples
        at = int(np.searchsorted(before[: self.blocks], k, "right")) - 1
        inside = np.unpackbits(self.block(at), count=min(BLOCK, self.n - at * BLOCK), bitorder="little")
        return at * BLOCK + int(np.flatnonzero(inside == bit)[k - int(before[at])])


class WaveletMatrix:
    def __init__(self, alphabet: np.ndarray, planes: list[Plane], zeros: list[int], n: int):
        self.alphabet, self.planes, self.zeros, self.n = alphabet, planes, zeros, n

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        seen = np.bincount(tokens) if len(tokens) else np.zeros(0, np.int64)
        alphabet = np.flatnonzero(seen).astype(np.uint32)
        place = np.zeros(len(seen), np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        place[alphabet] = np.arange(len(alphabet), dtype=place.dtype)
        row = place[tokens]
        planes, zeros = [], []
        for level in range(max(0, len(alphabet) - 1).bit_length() - 1, -1, -1):
            bit = (row & place.dtype.type(1 << level)).astype(bool)
            planes.append(Plane.of(np.packbits(bit, bitorder="little"), len(row)))
            low, high = np.compress(~bit, row), np.compress(bit, row)
            zeros.append(len(low))
            row = np.concatenate([low, high])
        return cls(alphabet, planes, zeros, len(tokens))

    def access(self, i: int) -> int:
        place = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane.get(i)
            place = place << 1 | bit
            i = zeros + plane.rank1(i) if bit else i - plane.rank1(i)
        return int(self.alphabet[place])

    def _place(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def _range(self, place: int, start: int, end: int) -> tuple[int, int]:
        """Where the tokens of [start, end) that have this place end up below the last plane."""
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = place >> (len(self.planes) - 1 - k) & 1
            start, end = ((zeros + plane.rank1(x)) if bit else x - plane.rank1(x) for x in (start, end))
        return start, end

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before position i."""
        place = self._place(token)
        if place is None:
            return 0
        start, end = self._range(place, 0, i)
        return end - start

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence; IndexError past the last."""
        place = self._place(token)
        if place is None or k < 0:
            raise IndexError(token)
        start, end = self._range(place, 0, self.n)
        if start + k >= end:
            raise IndexError(token)
        at = start + k
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = place >> level & 1
            at = plane.select(bit, at - zeros if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """The whole sequence, from the last plane up."""
        if not self.planes:
            return np.repeat(self.alphabet, self.n) if len(self.alphabet) else np.empty(0, np.uint32)
        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        row = np.zeros(self.n, kind)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = plane.bits()
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~bit)] = row[:zeros]
            up[np.flatnonzero(bit)] = row[zeros:] | kind(1 << level)
            row = up
        return self.alphabet[row]


def to_bytes(matrix: WaveletMatrix, ids: np.ndarray, lengths: np.ndarray, level: int = 1) -> bytes:
    """The file image of a shard: documents ``ids`` of ``lengths`` tokens each, in this order."""
    press = zstandard.ZstdCompressor(level=level).compress
    frames = [[press(p.block(k).tobytes()) for k in range(p.blocks)] for p in matrix.planes]
    directory = [np.stack([p.samples[: p.blocks], list(map(len, f))]) for p, f in zip(matrix.planes, frames, strict=True)]
    parts = [press(x.tobytes()) for x in (matrix.alphabet.astype("<u4"), ids.astype("<i8"), lengths.astype("<u4"), np.array(directory, "<u4"))]
    header = json.dumps({"n": matrix.n, "zeros": matrix.zeros, "block": BLOCK, "parts": [len(p) for p in parts]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *parts, *[f for plane in frames for f in plane]])


def opened(file: BinaryIO, documents: bool = False) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """(matrix, document ids, their lengths) of an open file that can seek; the two arrays are empty unless ``documents``."""
    unpress = zstandard.ZstdDecompressor().decompress
    head = file.read(8)
    if head[:4] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    header = json.loads(file.read(struct.unpack("<I", head[4:])[0]))
    if header["block"] != BLOCK:
        raise ValueError(f"blocks of {header['block']} bits")
    n, levels = header["n"], len(header["zeros"])
    at = file.tell()
    starts = [at + sum(header["parts"][:k]) for k in range(5)]

    def part(k: int, kind: str) -> np.ndarray:
        file.seek(starts[k])
        return np.frombuffer(unpress(file.read(header["parts"][k])), kind)

    alphabet = part(0, "<u4")
    ids, lengths = (part(1, "<i8"), part(2, "<u4")) if documents else (np.empty(0, "<i8"), np.empty(0, "<u4"))
    blocks = -(-n // BLOCK)
    directory = part(3, "<u4").astype(np.int64).reshape(levels, 2, blocks)
    ends = starts[4] + np.cumsum(directory[:, 1].ravel()).reshape(levels, blocks)

    def plane(k: int) -> Plane:
        @functools.lru_cache(4)
        def block(b: int) -> np.ndarray:
            size = int(directory[k, 1, b])
            file.seek(int(ends[k, b]) - size)
            return np.frombuffer(unpress(file.read(size)), np.uint8)

        return Plane(n, np.append(directory[k, 0], n - header["zeros"][k]), block)

    return WaveletMatrix(alphabet, [plane(k) for k in range(levels)], header["zeros"], n), ids, lengths


def from_bytes(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """(matrix, document ids, their lengths) of a whole file image."""
    return opened(io.BytesIO(data), documents=True)
