"""Tiny PNG writer (zlib only) and drawings used by the image tests."""

import struct
import zlib

import numpy as np


def exif_tiff(orientation: int, order: str = "MM") -> bytes:
    """A minimal TIFF block with one IFD entry: Orientation (0x0112, SHORT)."""
    bo = "big" if order == "MM" else "little"
    entry = ((0x0112).to_bytes(2, bo) + (3).to_bytes(2, bo) + (1).to_bytes(4, bo)
             + orientation.to_bytes(2, bo) + b"\x00\x00")
    return (order.encode() + (42).to_bytes(2, bo) + (8).to_bytes(4, bo) + (1).to_bytes(2, bo) + entry
            + (0).to_bytes(4, bo))


def png_bytes(img: np.ndarray, orientation: int | None = None) -> bytes:
    img = np.asarray(img, dtype=np.uint8)
    if img.ndim == 2:
        img = img[:, :, None]
    h, w, c = img.shape
    color = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\x00" + img[y].tobytes() for y in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    exif = chunk(b"eXIf", exif_tiff(orientation)) if orientation else b""
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
            + exif + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def white(h, w):
    return np.full((h, w, 3), 255, dtype=np.uint8)


def draw_digit_like(img, x, y=60, w=70, h=140, t=12, ink=30):
    """A ring (like a 0) of thickness t."""
    img[y:y + h, x:x + w] = ink
    img[y + t:y + h - t, x + t:x + w - t] = 255
    return img


def five_digits(h=260, w=920, gap=175, x0=55):
    img = white(h, w)
    for i in range(5):
        draw_digit_like(img, x0 + gap * i)
    return img
