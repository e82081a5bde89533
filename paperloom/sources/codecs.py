"""Page images as bytes: portable maps (several to a file) and PNG, read and written with numpy and zlib.

A codec is an object with ``index(file)``, which gives an entry for each page without reading pixels,
and ``load(file, entry)``, which gives one page as a uint8 array (height, width) or (height, width, 3).
``file`` is a seekable binary file. Rasterisers of other formats are plugged in as such objects.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

#: The PNG signature, and channels by colour type (grey, colour, palette, grey and alpha, colour and alpha).
PNG_HEAD = b"\x89PNG\r\n\x1a\n"
PNG_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


class PortableMaps:
    """P5 (grey) and P6 (colour) images with values to 255, one after another in a file."""

    @staticmethod
    def index(file) -> list[tuple[int, int, int, int]]:
        """(offset of the pixels, height, width, channels) of each image, read from the headers alone."""
        end = file.seek(0, io.SEEK_END)
        at, out = 0, []
        while at < end:
            file.seek(at)
            head = file.read(512)
            kind = head[:2]
            if kind not in (b"P5", b"P6"):
                if out and not head.strip():
                    break
                raise ValueError("not a portable map")
            words, i = [], 2
            while len(words) < 3:
                while i < len(head) and head[i : i + 1].isspace():
                    i += 1
                if head[i : i + 1] == b"#":
                    i = head.find(b"\n", i) + 1 or len(head)
                    continue
                start = i
                while i < len(head) and not head[i : i + 1].isspace():
                    i += 1
                if start == i:
                    raise ValueError("a header breaks off")
                words.append(int(head[start:i]))
            width, height, most = words
            if not 0 < most < 256:
                raise ValueError("values beyond a byte")
            channels = 1 if kind == b"P5" else 3
            out.append((at + i + 1, height, width, channels))
            at += i + 1 + height * width * channels
        if at > end and out:
            out[-1] = (*out[-1][:3], -out[-1][3])  # the last one lacks pixels: an error when it is loaded
        return out

    @staticmethod
    def load(file, entry: tuple[int, int, int, int]) -> np.ndarray:
        offset, height, width, channels = entry
        file.seek(offset)
        data = file.read(height * width * abs(channels))
        if len(data) < height * width * abs(channels):
            raise ValueError("pixels break off")
        return np.frombuffer(data, np.uint8).reshape((height, width) if channels == 1 else (height, width, 3))

    @staticmethod
    def dump(image: np.ndarray) -> bytes:
        return b"P%d\n%d %d\n255\n" % (5 if image.ndim == 2 else 6, image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


class Png:
    """Images of 8 bits a channel (also 1 to 4 bits in one channel) without interlacing; alpha is dropped, palettes become colours."""

    @staticmethod
    def index(file) -> list[int]:
        file.seek(0)
        if file.read(8) != PNG_HEAD:
            raise ValueError("not a PNG")
        return [0]

    @staticmethod
    def load(file, entry: int = 0) -> np.ndarray:
        file.seek(8)
        packed, palette, size = [], None, None
        while True:
            head = file.read(8)
            if len(head) < 8:
                raise ValueError("pixels break off")
            length, kind = struct.unpack(">I4s", head)
            data = file.read(length)
            if zlib.crc32(kind + data) != int.from_bytes(file.read(4), "big"):
                raise ValueError("a chunk is damaged")
            if kind == b"IHDR":
                width, height, depth, colour, _, _, interlaced = size = struct.unpack(">IIBBBBB", data)
                if interlaced or colour not in PNG_CHANNELS or depth not in ((8,) if PNG_CHANNELS[colour] > 1 else (1, 2, 4, 8)):
                    raise ValueError("a kind of PNG that is not read")
            elif kind == b"PLTE":
                palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                packed.append(data)
            elif kind == b"IEND":
                break
        if not size:
            raise ValueError("no header")
        channels = PNG_CHANNELS[colour]
        stride = (width * channels * depth + 7) // 8
        raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
        if len(raw) < height * (stride + 1):
            raise ValueError("pixels break off")
        lines = raw[: height * (stride + 1)].reshape(height, stride + 1)
        image = unfiltered(lines[:, 0], lines[:, 1:], channels if depth == 8 else 1)
        if depth < 8:
            bits = np.unpackbits(image, axis=1).reshape(height, -1, depth)
            image = np.packbits(bits, axis=2)[:, :width, 0] >> (8 - depth)
            image = image if colour == 3 else (image.astype(int) * 255 // (2**depth - 1)).astype(np.uint8)
        image = image.reshape(height, width, channels) if channels > 1 else image
        if colour == 3:
            if palette is None:
                raise ValueError("no palette")
            return palette[image]
        return image[:, :, :3] if colour in (2, 6) else image[:, :, 0] if colour == 4 else image

    @staticmethod
    def dump(image: np.ndarray, level: int = 6) -> bytes:
        """The image with each row as the difference from the one above."""
        rows = np.ascontiguousarray(image, np.uint8).reshape(image.shape[0], int(np.prod(image.shape[1:])))
        up = rows - np.concatenate([np.zeros_like(rows[:1]), rows[:-1]])
        lines = np.concatenate([np.full((len(rows), 1), 2, np.uint8), up], axis=1)
        head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
        chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
        return PNG_HEAD + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + chunk(b"IEND", b"")


def unfiltered(kinds: np.ndarray, lines: np.ndarray, step: int) -> np.ndarray:
    """PNG rows without their filters: 0 none, 1 left, 2 above, 3 mean of both, 4 the nearest of left, above, corner."""
    out = np.zeros_like(lines)
    above = np.zeros(lines.shape[1], np.uint8)
    for y, kind in enumerate(kinds.tolist()):
        row = lines[y]
        if kind == 0:
            own = row
        elif kind == 1:
            own = row.copy()
            for c in range(step):
                own[c::step] = np.cumsum(row[c::step], dtype=np.uint8)
        elif kind == 2:
            own = row + above
        elif kind in (3, 4):
            left, corner = [0] * step, [0] * step
            values, up = row.tolist(), above.tolist()
            for i, v in enumerate(values):
                a, b, c = left[i % step], up[i], corner[i % step]
                if kind == 3:
                    guess = (a + b) >> 1
                else:
                    pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
                values[i] = left[i % step] = (v + guess) & 255
                corner[i % step] = b
            own = np.array(values, np.uint8)
        else:
            raise ValueError("an unknown filter")
        out[y] = above = own
    return out


BY_EXTENSION = {"pgm": PortableMaps, "ppm": PortableMaps, "pnm": PortableMaps, "png": Png}


def dumped(image: np.ndarray, name: str) -> bytes:
    """The image in the format that the file name asks for."""
    codec = BY_EXTENSION.get(name.rpartition(".")[2].lower())
    if not codec:
        raise ValueError(f"no image format is known for {name}")
    return codec.dump(image)
