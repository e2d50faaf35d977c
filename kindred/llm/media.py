"""Media columns: Netpbm and BMP images as numpy arrays, area-resized, tiled and hashed."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, utf8

WIDTH = 64
TOKEN = re.compile(rb"(?:\s|#[^\n]*\n)*([^\s#]+)")


def encode_pgm(pixels: np.ndarray) -> bytes:
    """A binary 8-bit graymap (P5) or, for three channels, pixmap (P6)."""
    kind = b"P5" if pixels.ndim == 2 else b"P6"
    return kind + b"\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def encode_bmp(pixels: np.ndarray) -> bytes:
    """An uncompressed BMP: 8 bits with a gray palette, or 24 bits for three channels."""
    high, wide = pixels.shape[:2]
    depth = 8 if pixels.ndim == 2 else 24
    rows = pixels if depth == 8 else pixels[:, :, ::-1]
    row = wide * depth // 8
    lines = np.zeros((high, -(-row // 4) * 4), np.uint8)
    lines[:, :row] = rows.reshape(high, row)
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if depth == 8 else b""
    at = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", at + lines.size, 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, wide, high, 1, depth, 0, lines.size, 2835, 2835, 256 if depth == 8 else 0, 0)
    return head + palette + lines[::-1].tobytes()


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind, at, head = data[:2], 2, []
    wanted = 2 if kind in (b"P1", b"P4") else 3
    for _ in range(wanted):
        found = TOKEN.match(data, at)
        if not found:
            raise ValueError("a Netpbm header ends early")
        head.append(int(found[1]))
        at = found.end()
    wide, high = head[:2]
    most = head[2] if wanted == 3 else 1
    if not 0 < most < 65536 or wide < 1 or high < 1:
        raise ValueError("a Netpbm header has a value out of range")
    channels = 3 if kind in (b"P3", b"P6") else 1
    count = wide * high * channels
    if kind == b"P4":
        rows = np.frombuffer(data, np.uint8, high * (-(-wide // 8)), at + 1).reshape(high, -1)
        values = 1 - np.unpackbits(rows, axis=1)[:, :wide].reshape(-1)
    elif kind == b"P1":
        values = np.array([b == 48 for b in data[at:] if b in b"01"][:count], np.uint8)
    elif kind in (b"P2", b"P3"):
        values = np.array(data[at:].split()[:count], np.int64)
    else:
        values = np.frombuffer(data, np.uint8 if most < 256 else ">u2", count, at + 1)
    if len(values) != count:
        raise ValueError("a Netpbm image ends early")
    if most != 255:
        values = (values.astype(np.int64) * 255 + most // 2) // most
    values = values.astype(np.uint8, copy=False)
    return values.reshape(high, wide) if channels == 1 else values.reshape(high, wide, 3)


def _decode_bmp(data: bytes) -> np.ndarray:
    at, size, wide, high, _, depth, packed = struct.unpack_from("<10xIIiiHHI", data)
    if packed or depth not in (8, 24, 32) or wide < 1 or not high:
        raise ValueError("only uncompressed BMP of 8, 24 or 32 bits is read")
    rows, stride = abs(high), -(-wide * depth // 32) * 4
    lines = np.frombuffer(data, np.uint8, rows * stride, at).reshape(rows, stride)[:, : wide * depth // 8]
    lines = lines[::-1] if high > 0 else lines
    if depth == 8:
        used = struct.unpack_from("<I", data, 46)[0] or 256
        palette = np.frombuffer(data, np.uint8, used * 4, 14 + size).reshape(used, 4)[:, 2::-1]
        pixels = palette[lines]
        return pixels[:, :, 0] if (palette == palette[:, :1]).all() else pixels
    return lines.reshape(rows, wide, depth // 8)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    """Rows of samples (gray) or of three channels, 8 bits each; ValueError for anything else."""
    if data[:2] in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        return _decode_netpbm(data)
    if data[:2] == b"BM" and len(data) >= 54:
        return _decode_bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def _integral_at(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The running sum over the first axis at fractional positions, without holding the whole integral image."""
    whole = np.minimum(np.floor(cuts).astype(np.int64), values.shape[0])
    out, total, last = [], np.zeros(values.shape[1:], np.float64), 0
    for cut, to in zip(cuts, whole):
        for at in range(last, to, 1 << 16):
            total = total + values[at : min(to, at + (1 << 16))].sum(axis=0, dtype=np.float64)
        last = to
        out.append(total + (cut - to) * values[to] if cut > to and to < values.shape[0] else total)
    return np.stack(out)


def area_resize(pixels: np.ndarray, high: int, wide: int) -> np.ndarray:
    """Means of the source areas under each target sample, from the integral image's corners (float64)."""
    ys, xs = np.linspace(0, pixels.shape[0], high + 1), np.linspace(0, pixels.shape[1], wide + 1)
    rows = _integral_at(pixels, ys)
    corners = _integral_at(np.moveaxis(rows, 1, 0), xs)
    corners = np.moveaxis(corners, 0, 1)
    sums = np.diff(np.diff(corners, axis=0), axis=1)
    area = (ys[1] - ys[0]) * (xs[1] - xs[0])
    return sums / area


def tile(pixels: np.ndarray, side: int = 32) -> bytes:
    """The area-resized image as an 8-bit NPY file."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(area_resize(pixels, side, side)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def difference_hash(pixels: np.ndarray) -> str:
    """16 hex digits: for 8 rows of 9 area means, whether each is less than its right neighbour."""
    gray = pixels if pixels.ndim == 2 else pixels @ np.array([0.299, 0.587, 0.114])
    means = area_resize(gray, 8, 9)
    return np.packbits(means[:, :-1] < means[:, 1:]).tobytes().hex()


def payload_image(raw: bytes, width: int = WIDTH) -> np.ndarray:
    """Bytes with zeros up to a positive multiple of ``width``, as rows of samples."""
    padded = raw + bytes(max(width, -(-len(raw) // width) * width) - len(raw))
    return np.frombuffer(padded, np.uint8).reshape(-1, width)


def features(raw: bytes) -> tuple:
    media = encode_pgm(payload_image(raw))
    pixels = decode(media)
    payload = pixels.tobytes()
    small = tile(pixels)
    return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), difference_hash(pixels), small


def media_features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store every text as a graymap, read it back and describe it; no row meets another.

    Null texts are empty, and an empty text is one row of 64 zeros. Equal texts have equal
    values. The NPY tile of 32 x 32 area means comes as a binary column. A very long text is
    held a few times over by one task and summed in strips.
    """
    kind = dict(docs.dtypes)[doc_id]
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def of(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            columns = zip(*(features(raw) for raw in part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("raw")), of, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary")
