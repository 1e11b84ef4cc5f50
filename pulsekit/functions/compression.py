"""Packed message parts, for the compression names a channel can carry.

Layouts: `lz4` is a four-byte size and an LZ4 block; `bitshuffle_lz4` is the size (8 bytes, big endian),
the block size in bytes (4 bytes, big endian), then blocks of bit-transposed elements, each an LZ4 block
behind its packed length (4 bytes, big endian), then the last elements short of eight as they are.
LZ4 blocks come from Arrow, which is on every executor already.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

# Bits are transposed for eight elements at a time, a fixed value of the layout.
_BLOCK_UNIT = 8
# Elements per block we write. Readers take any: the size travels in the part.
_BLOCK_ELEMENTS = 1024


def _lz4(data: bytes) -> bytes:
    return pa.compress(data, codec="lz4_raw", asbytes=True)


def _unlz4(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="lz4_raw", asbytes=True)


def unpack(data: bytes, compression: str | None, code: str) -> bytes:
    """The plain bytes of a part; raises on damaged data."""
    if compression in (None, "none"):
        return data
    if compression == "lz4":
        return _unpack_lz4(data, code)
    return _unpack_bitshuffle(data, np.dtype(code).itemsize)


def pack(data: bytes, compression: str | None, code: str) -> bytes:
    if compression in (None, "none"):
        return data
    if compression == "lz4":
        return struct.pack("<I", len(data)) + _lz4(data)
    return _pack_bitshuffle(data, np.dtype(code).itemsize)


def _unpack_lz4(data: bytes, code: str) -> bytes:
    # Writers put the size little endian whatever the channel's byte order; accept either.
    orders = (">I", "<I") if code.startswith(">") else ("<I", ">I")
    error: Exception = ValueError("short lz4 part")
    for order in orders:
        size = struct.unpack(order, data[:4])[0]
        if size == 0:
            return b""
        # A block cannot grow more than 255-fold, so a larger size is the wrong byte order.
        if size > 255 * len(data):
            continue
        try:
            return _unlz4(data[4:], size)
        except (OSError, ValueError, pa.ArrowException) as failed:
            error = failed
    raise error


def _unpack_bitshuffle(data: bytes, width: int) -> bytes:
    size, block_bytes = struct.unpack(">qi", data[:12])
    if size % width:
        raise ValueError("size is not a multiple of the element width")
    n, block = size // width, block_bytes // width
    if size and block <= 0:
        raise ValueError("no block size")
    view, at, out = memoryview(data), 12, []
    for elements in _blocks(n, block):
        length = struct.unpack(">I", view[at : at + 4])[0]
        bits = np.frombuffer(_unlz4(bytes(view[at + 4 : at + 4 + length]), elements * width), np.uint8)
        planes = np.unpackbits(bits.reshape(width * 8, elements // 8), axis=1, bitorder="little")
        out.append(np.packbits(planes.T, axis=1, bitorder="little").tobytes())
        at += 4 + length
    rest = n % _BLOCK_UNIT * width
    if len(data) < at + rest:
        raise ValueError("short bitshuffle part")
    out.append(bytes(view[at : at + rest]))
    return b"".join(out)


def _pack_bitshuffle(data: bytes, width: int) -> bytes:
    n, block = len(data) // width, _BLOCK_ELEMENTS
    out, at = [struct.pack(">qi", len(data), block * width)], 0
    for elements in _blocks(n, block):
        rows = np.frombuffer(data, np.uint8, elements * width, at).reshape(elements, width)
        planes = np.unpackbits(rows, axis=1, bitorder="little").T
        packed = _lz4(np.packbits(planes, axis=1, bitorder="little").tobytes())
        out += [struct.pack(">I", len(packed)), packed]
        at += elements * width
    out.append(data[at:])
    return b"".join(out)


def _blocks(n: int, block: int) -> list[int]:
    """Full blocks, then one of what is left in whole units."""
    if n == 0:
        return []
    last = n % block // _BLOCK_UNIT * _BLOCK_UNIT
    return [block] * (n // block) + ([last] if last else [])
