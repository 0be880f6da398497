"""Media columns: Netpbm and BMP to numpy, area resizing by integral images, NPY tiles, difference hashes.

The text query stores each text as a binary PGM of width 64: its UTF-8 bytes, padded with bytes 0
to a positive multiple of 64, are the samples. Everything it returns comes from decoding the
stored bytes again.

Defined cases: null text is empty text, one row of zeros; equal texts give equal values, repeated rows
one row each; a damaged or unknown file is an error row (``error`` not null) of ``decode_media``, never an
exception; very long texts are resized band by band; an empty table gives no rows; other columns are left
out; equal neighbours in a difference hash count as not brighter.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, tidied

WIDTH = 64
#: Side of the NPY tiles.
TILE = 32
HASH_W, HASH_H = 9, 8
#: Samples of an image that are resized at a time (32 MB as floats, a few times over).
BAND = 1 << 20


class MediaError(ValueError):
    pass


_TOKEN = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*([^\s#]+)")


def _header(data: bytes, n: int) -> tuple[list[int], int]:
    """n integers after the magic; where the samples begin (one white space after the last)."""
    at, out = 2, []
    for _ in range(n):
        m = _TOKEN.match(data, at)
        if not m or not m[1].isdigit():
            raise MediaError("bad header")
        out.append(int(m[1]))
        at = m.end()
    return out, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 to (height, width, channels), uint8 or, for a largest value over 255, uint16; bitmaps: 1 is black, as 0, white as 1."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise MediaError("no Netpbm")
    bitmap, channels = kind in (b"P1", b"P4"), 3 if kind in (b"P3", b"P6") else 1
    head, at = _header(data, 2 if bitmap else 3)
    w, h = head[:2]
    most = 1 if bitmap else head[2]
    if w < 1 or h < 1 or not 0 < most < 65536:
        raise MediaError("bad size")
    n = w * h * channels
    if kind == b"P1":
        digits = re.sub(rb"#[^\n\r]*", b"", data[at - 1 :])
        flat = np.array([c - 48 for c in digits if c in b"01"][:n], dtype=np.uint8)
    elif kind in (b"P2", b"P3"):
        flat = np.array(re.sub(rb"#[^\n\r]*", b"", data[at - 1 :]).split()[:n], dtype=np.int64)
    elif kind == b"P4":
        row = -(-w // 8)
        packed = np.frombuffer(data, np.uint8, offset=at)
        if packed.size < row * h:
            raise MediaError("short file")
        flat = np.unpackbits(packed[: row * h].reshape(h, row), axis=1)[:, :w].ravel()
    else:
        flat = np.frombuffer(data, np.dtype(">u2") if most > 255 else np.uint8, offset=at)
    if flat.size < n:
        raise MediaError("short file")
    out = flat[:n].reshape(h, w, channels)
    if bitmap:
        return (1 - out).astype(np.uint8)
    return out.astype(np.uint16 if most > 255 else np.uint8)


def _channel(pixels: np.ndarray, mask: int) -> np.ndarray:
    """The bits of a mask, stretched to 0 to 255."""
    if not mask:
        return np.zeros(pixels.shape, dtype=np.uint8)
    shift = (mask & -mask).bit_length() - 1
    most = mask >> shift
    return (((pixels & mask) >> shift).astype(np.uint64) * 255 // most).astype(np.uint8)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 16, 24 or 32 bits, bit fields too, to (height, width, 3), in RGB."""
    if data[:2] != b"BM" or len(data) < 54:
        raise MediaError("no BMP")
    start, size, w, h, _, bits, packing = struct.unpack_from("<IIiiHHI", data, 10)
    if packing not in (0, 3) or bits not in (1, 4, 8, 16, 24, 32) or (packing == 3 and bits not in (16, 32)) or w < 1 or h == 0:
        raise MediaError("unsupported BMP")
    top_down, h = h < 0, abs(h)
    row = (w * bits + 31) // 32 * 4
    raw = np.frombuffer(data, np.uint8, offset=start)
    if raw.size < row * h:
        raise MediaError("short file")
    raw = raw[: row * h].reshape(h, row)
    if bits == 16 or packing == 3:
        masks = struct.unpack_from("<III", data, 54) if packing == 3 else (0x7C00, 0x03E0, 0x001F)
        pixels = np.ascontiguousarray(raw[:, : w * bits // 8]).view("<u2" if bits == 16 else "<u4").astype(np.uint32)
        out = np.stack([_channel(pixels, m) for m in masks], axis=2)
    elif bits >= 24:
        out = raw[:, : w * bits // 8].reshape(h, w, bits // 8)[:, :, 2::-1]
    else:
        used = struct.unpack_from("<I", data, 46)[0] or 1 << bits
        palette = np.frombuffer(data, np.uint8, count=4 * used, offset=14 + size).reshape(used, 4)[:, 2::-1]
        index = raw if bits == 8 else np.unpackbits(raw, axis=1).reshape(h, -1, bits) @ (1 << np.arange(bits)[::-1])
        out = palette[index[:, :w]]
    return np.ascontiguousarray(out if top_down else out[::-1])


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(samples: np.ndarray) -> bytes:
    h, w = samples.shape
    return b"P5\n%d %d\n255\n" % (w, h) + samples.astype(np.uint8).tobytes()


def grey(image: np.ndarray) -> np.ndarray:
    return image[:, :, 0].astype(np.float64) if image.shape[2] == 1 else image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def area_resize(image: np.ndarray, w: int, h: int) -> np.ndarray:
    """Means over the exact (fractional) source area of each target cell, from an integral image that is made band by band.

    image: (rows, columns) of brightness or (rows, columns, channels), made grey one band at a time; so the memory needed beside
    the image is a band's.
    """
    rows, cols = image.shape[:2]
    x, y = np.linspace(0, cols, w + 1), np.linspace(0, rows, h + 1)
    low = np.minimum(np.floor(x).astype(np.int64), cols - 1)
    corners = np.zeros((h + 1, w + 1))
    above = np.zeros(w + 1)  # the integral at the columns' edges, down to the band
    step = max(1, BAND // cols)
    for lo in range(0, rows, step):
        band = image[lo : lo + step]
        band = band.astype(np.float64) if band.ndim == 2 else grey(band)
        across = np.zeros((len(band), cols + 1))
        np.cumsum(band, axis=1, out=across[:, 1:])
        edges = across[:, low] + (x - low) * (across[:, low + 1] - across[:, low])
        down = np.concatenate([above[None, :], above + np.cumsum(edges, axis=0)])
        inside = np.flatnonzero((y >= lo) & (y < lo + len(band)))
        at = np.floor(y[inside]).astype(np.int64) - lo
        corners[inside] = down[at] + (y[inside] - lo - at)[:, None] * (down[at + 1] - down[at])
        above = down[-1]
    corners[y >= rows] = above
    cells = corners[1:, 1:] - corners[:-1, 1:] - corners[1:, :-1] + corners[:-1, :-1]
    return cells / (rows / h * cols / w)


def difference_hash(image: np.ndarray) -> str:
    """64 bits, row by row: is a cell of the 9 x 8 image brighter than its left neighbour."""
    small = np.round(area_resize(image, HASH_W, HASH_H), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, tile)
    return out.getvalue()


def tile(image: np.ndarray, side: int = TILE) -> bytes:
    return npy(np.clip(np.round(area_resize(image, side, side)), 0, 255).astype(np.uint8))


def decode_media(media: DataFrame, *, id_col: str = "media_id", data_col: str = "data", side: int = TILE) -> DataFrame:
    """(id, width, height, channels, dhash, tile, error): tile is an NPY file of side x side."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for data in b.column(1).to_pylist():
                try:
                    image = decode(data or b"")
                    out.append((image.shape[1], image.shape[0], image.shape[2], difference_hash(image), tile(image, side), None))
                except (MediaError, ValueError, struct.error, IndexError, OverflowError) as e:
                    out.append((None, None, None, None, None, str(e) or type(e).__name__))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["id", "width", "height", "channels", "dhash", "tile", "error"])

    out = small_batches(media.select(F.col(id_col).alias("id"), F.col(data_col).alias("data"))).mapInArrow(run, f"id {dict(media.dtypes)[id_col]}, width int, height int, channels int, dhash string, tile binary, error string")
    return out.withColumnRenamed("id", id_col)


def encode_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text as a PGM file."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, files = [], []
            for t in b.column(1).to_pylist():
                raw = (t or "").encode()
                sizes.append(len(raw))
                rows = max(1, -(-len(raw) // WIDTH))
                files.append(encode_pgm(np.frombuffer(raw.ljust(rows * WIDTH, b"\0"), np.uint8).reshape(rows, WIDTH)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], names=["id", "n_bytes", "media"])

    out = small_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_bytes long, media binary")
    return out.withColumnRenamed("id", id_col)


def digest_media(media: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """From the stored files alone: payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, tile.

    tile: an NPY file of TILE x TILE samples; feature: the difference hash and the beginning of the tile's SHA-256.
    """

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tile"]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
        for b in batches:
            out = []
            for data in b.column(2).to_pylist():
                image = decode(data)
                payload = image.tobytes()
                small = tile(image)
                feature = f"{difference_hash(image)}:{hashlib.sha256(small).hexdigest()[:16]}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), feature, small))
            cols = list(zip(*out, strict=True)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["id", "n_bytes", *names])

    out = small_batches(media.select(F.col(id_col).alias("id"), "n_bytes", "media")).mapInArrow(run, f"id {dict(media.dtypes)[id_col]}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return digest_media(encode_texts(table(spark, sf_dir, "documents")))
