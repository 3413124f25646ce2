"""Media columns: texts as greyscale PNG images in a binary column, and image hashes of what the column holds.

A payload (the bytes of a text, padded with zeros to whole rows of 64) is stored as an 8-bit greyscale PNG that is
64 samples wide. Reading back parses the chunks, tests every chunk's CRC, inflates the image data and undoes the
row filters with numpy. Rows are filtered as what is smallest of themselves, their change along the row and their change
from the row above; an image of these kinds is restored by running sums over whole stretches of rows, one of the other two
kinds (average, Paeth: read, never written) along its diagonals. The feature is a 64-bit perceptual hash: the image is averaged to 32 x 32, and a bit tells
whether one of the 8 x 8 lowest cosine-transform coefficients is above the median of the others.

The images are a table of their own with a binary column, written to the shared folder; what is known of an image comes
from that table. Null and empty texts give an image of one zero row. Equal texts give equal rows, whatever else the table holds.
Rows are handled one at a time, so memory is bounded by one Arrow batch plus the largest single image.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import settle, text_of

WIDTH = 64
#: Rows of an image that are filtered at a time.
BLOCK_ROWS = 1 << 14
SIGNATURE = b"\x89PNG\r\n\x1a\n"
FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def pad(data: bytes, width: int = WIDTH) -> bytes:
    """``data`` with zero bytes up to a positive multiple of ``width``."""
    return data + bytes(-len(data) % width if data else width)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_encode(payload: bytes, width: int = WIDTH, level: int = 6) -> bytes:
    """A greyscale PNG of ``payload``, whose length is a positive multiple of ``width``; each row has the cheapest of filters 0 to 2."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    lines = np.empty((len(rows), width + 1), np.uint8)
    for at in range(0, len(rows), BLOCK_ROWS):
        own = rows[at : at + BLOCK_ROWS]
        forms = np.stack([own, np.diff(own, axis=1, prepend=np.uint8(0)), np.diff(own, axis=0, prepend=rows[at - 1 : at] if at else np.zeros((1, width), np.uint8))])
        cost = np.abs(forms.view(np.int8).astype(np.int16)).sum(2)
        kind = cost.argmin(0)
        lines[at : at + BLOCK_ROWS, 0] = kind
        lines[at : at + BLOCK_ROWS, 1:] = forms[kind, np.arange(len(own))]
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def png_decode(media: bytes) -> np.ndarray:
    """The samples of an 8-bit greyscale PNG. ValueError for a broken chunk, checksum or format."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, head, data, ended = 8, None, [], False
    while at < len(media) and not ended:
        if at + 12 > len(media):
            raise ValueError("cut short")
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if len(body) < size or media[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError(f"checksum of {kind!r}")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if head is None or not ended or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("only whole 8-bit greyscale images without interlacing")
    width, height = head[:2]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if lines.size != height * (width + 1):
        raise ValueError("image data of another size")
    return _unfilter(lines.reshape(height, width + 1))


def _unfilter(lines: np.ndarray) -> np.ndarray:
    kinds, raw = lines[:, 0], lines[:, 1:]
    if len(kinds) and kinds.max() > 4:
        raise ValueError(f"row filter {kinds.max()}")
    out = np.empty_like(raw)
    above = np.zeros(raw.shape[1], np.uint8)
    group = np.minimum(kinds, 3)  # average and Paeth go together
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    for start, end in zip(starts, [*starts[1:], len(group)], strict=True):
        own = raw[start:end]
        if group[start] == 0:
            out[start:end] = own
        elif group[start] == 1:
            out[start:end] = np.cumsum(own, axis=1, dtype=np.uint8)
        elif group[start] == 2:
            out[start:end] = np.cumsum(own, axis=0, dtype=np.uint8) + above
        else:
            out[start:end] = _along_diagonals(own, above, kinds[start:end] == 4)
        above = out[end - 1]
    return out


def _along_diagonals(raw: np.ndarray, above: np.ndarray, paeth: np.ndarray) -> np.ndarray:
    """Rows of average and Paeth filters restored: a sample needs those left, above and left above, so a diagonal is one step."""
    height, width = raw.shape
    whole = np.zeros((height + 1, width + 1), np.int16)  # with the row above and a column of zeros
    whole[0, 1:] = above
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, up, corner = whole[y + 1, x], whole[y, x + 1], whole[y, x]
        near = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        closest = np.where((near[0] <= near[1]) & (near[0] <= near[2]), left, np.where(near[1] <= near[2], up, corner))
        whole[y + 1, x + 1] = (raw[y, x] + np.where(paeth[y], closest, (left + up) >> 1)) & 255
    return whole[1:, 1:].astype(np.uint8)


def _cosines(size: int, low: int) -> np.ndarray:
    return np.cos(np.pi * (2 * np.arange(size)[None, :] + 1) * np.arange(low)[:, None] / (2 * size))


_DCT = _cosines(32, 8)


def image_hash(image: np.ndarray) -> str:
    """16 hex digits: the low-frequency cosine-transform hash of a greyscale image."""
    small = image.astype(np.float64)
    for axis in (0, 1):
        n = small.shape[axis]
        starts = np.arange(32) * n // 32
        if n >= 32:
            small = np.add.reduceat(small, starts, axis=axis) / np.diff(np.append(starts, n)).reshape((-1, 1) if axis == 0 else (1, -1))
        else:
            small = np.take(small, starts, axis=axis)
    low = np.round(_DCT @ small @ _DCT.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def with_media(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Adds the binary column ``media``: each text as a PNG. Null texts count as empty."""

    @F.pandas_udf("binary")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([png_encode(pad(t.encode())) for t in s], dtype=object)

    return df.withColumn(media, encode(text_of(text)))


def with_media_features(df: DataFrame, media: str = "media", to: str = "media_features") -> DataFrame:
    """Adds a struct read from the stored images: size and digest of samples and file, and the image hash. Null stays null."""

    def features(stored: bytes | None) -> tuple | None:
        if stored is None:
            return None
        image = png_decode(stored)
        payload = image.tobytes()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), image_hash(image)

    @F.pandas_udf(FEATURES)
    def decode(stored: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in FEATURES.split(", ")]
        for s in stored:
            yield pd.DataFrame([features(None if m is None else bytes(m)) or (None,) * len(names) for m in s], columns=names)

    return df.withColumn(to, decode(F.col(media)))


def op2_media(spark, sf_dir: str) -> DataFrame:
    """Every text of documents as an image stored in a table, and what reading the image back gives."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.octet_length(text_of("text")).cast("long").alias("n_bytes"), "text")
    stored = settle(with_media(docs).select("doc_id", "n_bytes", "media"), "media")
    return with_media_features(stored).select("doc_id", "n_bytes", "media_features.*")
