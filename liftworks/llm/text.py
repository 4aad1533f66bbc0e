"""Byte-level helpers that run inside tasks."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard

#: ASCII upper case to lower case; other letters stay.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Columns of the corpus tables this package reads.
DOC_ID, TEXT = "doc_id", "text"


def binaries(column) -> list[bytes]:
    """Values of a string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of bytes other than space and 0x09-0x0D."""
    return text.translate(LOWER).split()


def pack_ints(values: np.ndarray) -> bytes:
    """Compressed non-negative integers below 2**32, as byte planes."""
    raw = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack_ints(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack_bytes(items: list[bytes]) -> bytes:
    """Compressed list of byte strings."""
    lengths = pack_ints(np.fromiter(map(len, items), dtype=np.uint32, count=len(items)))
    body = zstandard.ZstdCompressor(level=1).compress(b"".join(items))
    return struct.pack("<I", len(lengths)) + lengths + body


def unpack_bytes(blob: bytes) -> list[bytes]:
    n = struct.unpack_from("<I", blob)[0]
    ends = np.cumsum(unpack_ints(blob[4 : 4 + n]), dtype=np.int64).tolist()
    body = zstandard.ZstdDecompressor().decompress(blob[4 + n :])
    return [body[a:b] for a, b in zip([0, *ends], ends)]
