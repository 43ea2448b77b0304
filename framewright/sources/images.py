"""Images as arrays of bytes: decoding files of a folder, or a column of file contents, in Arrow batches."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

DECODED = "path string, height int, width int, channels int, pixels binary, error string"
#: Fixed values of the PNG format: its first bytes, and channels by color type.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def _chunks(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(SIGNATURE)
    while at + 8 <= len(raw):
        size, kind = struct.unpack_from(">I4s", raw, at)
        yield kind, raw[at + 8 : at + 8 + size]
        at += size + 12


def _paeth(left: int, up: int, corner: int) -> int:
    """Of the three neighbours, the one nearest to left + up - corner; in that order where they tie."""
    return min((left, up, corner), key=lambda x: abs(left + up - corner - x))


def _unfiltered(row: np.ndarray, kind: int, above: np.ndarray, step: int) -> np.ndarray:
    """A row of bytes from its differences to what stands before it and above it."""
    if kind == 0:
        return row
    if kind == 2:
        return row + above
    if kind == 1:
        return np.cumsum(row.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
    out = np.zeros(len(row) + step, np.int64)
    corner = np.concatenate([np.zeros(step, np.int64), above])
    for i, x in enumerate(row.tolist()):
        left, up = int(out[i]), int(above[i])
        out[i + step] = (x + ((left + up) // 2 if kind == 3 else _paeth(left, up, int(corner[i])))) & 255
    return out[step:].astype(np.uint8)


def decode(raw: bytes) -> np.ndarray:
    """(height, width, channels) of a PNG file of 8 bits a channel without interlacing, or of a binary PGM or PPM file."""
    if raw[:2] in (b"P5", b"P6"):
        parts, at = [], 2
        while len(parts) < 3:
            while raw[at : at + 1].isspace():
                at += 1
            end = at
            while raw[end : end + 1].isdigit():
                end += 1
            parts.append(int(raw[at:end]))
            at = end
        width, height, _ = parts
        return np.frombuffer(raw, np.uint8, height * width * (1 if raw[1:2] == b"5" else 3), at + 1).reshape(height, width, -1)
    if not raw.startswith(SIGNATURE):
        raise ValueError("neither PNG nor binary PGM or PPM")
    parts = [*_chunks(raw)]
    width, height, depth, color, _, _, interlace = struct.unpack(">IIBBBBB", dict(parts)[b"IHDR"])
    if depth != 8 or interlace or color not in CHANNELS:
        raise ValueError(f"PNG of {depth} bits, color type {color}, interlacing {interlace}")
    step = CHANNELS[color]
    rows = np.frombuffer(zlib.decompress(b"".join(x for kind, x in parts if kind == b"IDAT")), np.uint8).reshape(height, width * step + 1)
    out, above = [], np.zeros(width * step, np.uint8)
    for row in rows:
        above = _unfiltered(row[1:], int(row[0]), above, step)
        out.append(above)
    return np.stack(out).reshape(height, width, step) if out else np.zeros((0, width, step), np.uint8)


def encode(pixels: np.ndarray) -> bytes:
    """A PNG file of (height, width, channels)."""
    height, width, step = pixels.shape
    color = next(k for k, n in CHANNELS.items() if n == step)
    rows = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def decoded(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """DECODED of a column of file contents; a null or broken one has an error and no pixels."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    x = decode(raw or b"")
                    rows.append((name, *x.shape, x.tobytes(), None))
                except (ValueError, KeyError, struct.error, zlib.error) as e:
                    rows.append((name, None, None, None, None, str(e)))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["path", "height", "width", "channels", "pixels", "error"])

    return df.selectExpr(f"{path} AS path", f"{content} AS content").mapInArrow(run, DECODED)


def images(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """DECODED of the files of a folder; each is read whole by one task."""
    return decoded(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder))
