"""Decoding and pixel arithmetic in numpy, for use inside Arrow batches."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def bounded_side(side: Column, other: Column, most: int) -> Column:
    """A side after the longer of two is brought down to most; never up. Truncated, as int() does."""
    longest = F.greatest(side, other)
    return F.when(longest > most, (side * (F.lit(float(most)) / longest)).cast("int")).otherwise(side.cast("int"))


def bounded_size(width: int, height: int, most: int) -> tuple[int, int]:
    """The same for one image, with no side under a pixel."""
    longest = max(width, height)
    if not most or longest <= most:
        return width, height
    ratio = most / longest
    return max(1, int(width * ratio)), max(1, int(height * ratio))


def _weights(before: int, after: int) -> np.ndarray:
    """Rows of Lanczos weights (three lobes), widened when an axis shrinks."""
    scale = max(before / after, 1.0)
    centre = (np.arange(after) + 0.5) * before / after
    x = (np.arange(before)[None, :] + 0.5 - centre[:, None]) / scale
    weights = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def resample(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Lanczos resampling, one axis after the other."""
    out = np.tensordot(_weights(pixels.shape[0], height), pixels.astype(np.float64), axes=(1, 0))
    out = np.moveaxis(np.tensordot(_weights(pixels.shape[1], width), out, axes=(1, 1)), 0, 1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8) if pixels.dtype == np.uint8 else out


def on_white(pixels: np.ndarray) -> np.ndarray:
    """RGB of grey, grey and alpha, RGB or RGBA pixels; what is transparent lets white through."""
    if pixels.ndim == 2:
        pixels = pixels[..., None]
    n = pixels.shape[2]
    colour = pixels[..., :1].repeat(3, axis=2) if n < 3 else pixels[..., :3]
    if n in (1, 3):
        return colour.copy()
    alpha = pixels[..., -1:].astype(np.uint32)
    return ((colour * alpha + 255 * (255 - alpha) + 127) // 255).astype(np.uint8)


def quantize(pixels: np.ndarray, colours: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """A palette of at most so many colours, and for each pixel its place there, by median cut.

    Boxes of distinct colours are split at the median of their longest side, the fullest and widest first; a box's colour
    is the mean of its pixels. An image with few enough colours keeps them exactly.
    """
    flat = pixels.reshape(-1, 3)
    distinct, inverse, counts = np.unique(flat, axis=0, return_inverse=True, return_counts=True)
    inverse = inverse.reshape(-1)
    if len(distinct) <= colours:
        return distinct, inverse
    boxes = [np.arange(len(distinct))]
    while len(boxes) < colours:
        spread = [int(np.ptp(distinct[b], axis=0).max()) * int(counts[b].sum()) if len(b) > 1 else -1 for b in boxes]
        k = int(np.argmax(spread))
        if spread[k] < 0:
            break
        box = boxes.pop(k)
        axis = int(np.argmax(np.ptp(distinct[box], axis=0)))
        box = box[np.argsort(distinct[box, axis], kind="stable")]
        upto = np.cumsum(counts[box])
        cut = min(max(1, int(np.searchsorted(upto, upto[-1] / 2)) + 1), len(box) - 1)
        boxes += [box[:cut], box[cut:]]
    place = np.empty(len(distinct), dtype=np.int64)
    palette = np.empty((len(boxes), 3), dtype=np.uint8)
    for i, box in enumerate(boxes):
        place[box] = i
        palette[i] = np.rint(np.average(distinct[box], axis=0, weights=counts[box]))
    return palette, place[inverse]


class UndecodableError(ValueError):
    """Bytes that no decoder here reads."""


def decode(content: bytes) -> np.ndarray:
    """Height x width x channels of 8 bits. PNG and BMP are read here; other formats need Pillow, if it is installed."""
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        try:
            return _png(content)
        except (zlib.error, struct.error, IndexError, KeyError) as e:
            raise UndecodableError(f"broken PNG: {e}") from e
    if content[:2] == b"BM":
        return _bmp(content)
    try:
        import io

        from PIL import Image
    except ImportError:
        raise UndecodableError("no decoder for this format") from None
    try:
        image = Image.open(io.BytesIO(content))
        return np.asarray(image.convert("RGBA" if image.mode in ("P", "LA", "RGBA") else "RGB"))
    except OSError as e:
        raise UndecodableError(str(e)) from e


def _png(content: bytes) -> np.ndarray:
    at, data, palette, transparent = 8, [], None, b""
    width = height = depth = kind = interlaced = 0
    while at < len(content):
        length, name = struct.unpack_from(">I4s", content, at)
        body = content[at + 8 : at + 8 + length]
        if name == b"IHDR":
            width, height, depth, kind, _, _, interlaced = struct.unpack(">IIBBBBB", body)
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif name == b"tRNS":
            transparent = body
        elif name == b"IDAT":
            data.append(body)
        elif name == b"IEND":
            break
        at += 12 + length
    if depth not in (1, 2, 4, 8, 16) or interlaced or not width or not height:
        raise UndecodableError("interlaced or empty PNG")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    stride, step = -(-width * channels * depth // 8), max(1, channels * depth // 8)
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if len(raw) < height * (stride + 1):
        raise UndecodableError("truncated PNG")
    lines = raw[: height * (stride + 1)].reshape(height, stride + 1)
    out = np.zeros((height, stride), dtype=np.uint8)
    above = np.zeros(stride, dtype=np.uint8)
    for y in range(height):
        above = out[y] = _unfiltered(int(lines[y, 0]), lines[y, 1:], above, step)
    if depth == 16:
        samples = out.reshape(height, width * channels, 2)[..., 0]
    elif depth == 8:
        samples = out
    else:
        bits = np.unpackbits(out, axis=1).reshape(height, -1, depth)[:, : width * channels]
        samples = (bits @ (1 << np.arange(depth - 1, -1, -1))).astype(np.uint8)
        if kind == 0:
            samples = (samples * (255 // ((1 << depth) - 1))).astype(np.uint8)
    pixels = samples.reshape(height, width, channels)
    if kind == 3:
        alpha = np.full(len(palette), 255, dtype=np.uint8)
        alpha[: len(transparent)] = np.frombuffer(transparent, np.uint8)[: len(palette)]
        colours = palette[pixels[..., 0]]
        return np.dstack([colours, alpha[pixels[..., 0]]]) if transparent else colours
    return pixels


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line.copy()
    if kind == 2:
        return line + above
    if kind == 1:
        out = line.copy()
        for c in range(step):
            out[c::step] = np.cumsum(line[c::step], dtype=np.uint64).astype(np.uint8)
        return out
    out = np.zeros(len(line), dtype=np.int64)
    up = above.astype(np.int64)
    for i in range(len(line)):
        left = out[i - step] if i >= step else 0
        if kind == 3:
            guess = (left + up[i]) // 2
        else:
            corner = up[i - step] if i >= step else 0
            p = left + up[i] - corner
            near = (abs(p - left), abs(p - up[i]), abs(p - corner))
            guess = left if near[0] <= near[1] and near[0] <= near[2] else up[i] if near[1] <= near[2] else corner
        out[i] = (int(line[i]) + guess) & 255
    return out.astype(np.uint8)


def _bmp(content: bytes) -> np.ndarray:
    try:
        (start,) = struct.unpack_from("<I", content, 10)
        width, height = struct.unpack_from("<ii", content, 18)
        depth, packing = struct.unpack_from("<HI", content, 28)
    except struct.error as e:
        raise UndecodableError(f"broken BMP: {e}") from e
    if depth not in (24, 32) or packing not in (0, 3) or width <= 0 or not height:
        raise UndecodableError("BMP with a palette or compression")
    stride = (width * depth // 8 + 3) // 4 * 4
    rows = np.frombuffer(content, np.uint8, abs(height) * stride, start).reshape(abs(height), stride)
    pixels = rows[:, : width * depth // 8].reshape(abs(height), width, depth // 8)[..., 2::-1]
    return np.ascontiguousarray(pixels[::-1] if height > 0 else pixels)


def encode_png(pixels: np.ndarray) -> bytes:
    """A plain PNG of grey, RGB or RGBA pixels."""
    if pixels.ndim == 2:
        pixels = pixels[..., None]
    height, width, channels = pixels.shape
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    lines = np.hstack([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1).astype(np.uint8)])
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 2: 4, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")

