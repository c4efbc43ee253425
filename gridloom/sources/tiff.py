"""TIFF files by their byte ranges: the header, its chain of images, and single blocks (strips or tiles)."""

from __future__ import annotations

import dataclasses
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np

Read = Callable[[int, int], bytes]  # offset, length

# Sizes and codes of the field types, the sample formats, and the numbers of tags.
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
SAMPLES = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}
KIND, WIDTH, HEIGHT, BITS, PACKING, STRIPS, BANDS, ROWS, STRIP_BYTES, PLANAR, DIFFERS, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, SCALE, TIE, NODATA = (
    254, 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339, 33550, 33922, 42113,
)
PLAIN, LZW, DEFLATE, OLD_DEFLATE, ZSTD = 1, 5, 8, 32946, 50000


@dataclasses.dataclass(frozen=True)
class Image:
    """One image of a file: its shape, how its blocks are packed, and where the tables of their places are."""

    width: int
    height: int
    block: tuple[int, int]  # rows, columns
    bands: int
    sample: str
    packing: int
    differs: int
    apart: bool  # a plane for each band
    order: str
    places: tuple[str, int, int]  # type, count, offset
    sizes: tuple[str, int, int]
    scale: tuple[float, float]
    corner: tuple[float, float]
    nodata: float | None
    reduced: bool
    tiled: bool

    @property
    def down(self) -> int:
        return -(-self.height // self.block[0])

    @property
    def across(self) -> int:
        return -(-self.width // self.block[1])


def images(read: Read) -> list[Image]:
    """The images of a file, the full one first, then the reduced ones by falling size; masks are left out."""
    head = read(0, 16)
    if head[:2] not in (b"II", b"MM"):
        raise ValueError("not a TIFF")
    order = "<" if head[:2] == b"II" else ">"
    (magic,) = struct.unpack_from(f"{order}H", head, 2)
    if magic not in (42, 43):
        raise ValueError("not a TIFF")
    large = magic == 43
    (at,) = struct.unpack_from(f"{order}{'Q' if large else 'I'}", head, 8 if large else 4)
    count, word, entry = ("Q", 8, 20) if large else ("H", 4, 12)
    found = []
    while at:
        (n,) = struct.unpack(f"{order}{count}", read(at, struct.calcsize(count)))
        start = at + struct.calcsize(count)
        table = read(start, n * entry + word)
        tags = {}
        for i in range(n):
            tag, kind = struct.unpack_from(f"{order}HH", table, i * entry)
            (many,) = struct.unpack_from(f"{order}{'Q' if large else 'I'}", table, i * entry + 4)
            if kind in TYPES:
                inside = start + i * entry + 4 + word
                size = struct.calcsize(TYPES[kind]) * many
                tags[tag] = TYPES[kind], many, inside if size <= word else struct.unpack_from(f"{order}{'Q' if large else 'I'}", table, i * entry + 4 + word)[0]
        (at,) = struct.unpack_from(f"{order}{'Q' if large else 'I'}", table, n * entry)
        found.append(_image(read, tags, order))
    found = [x for x in found if x]
    if not found:
        raise ValueError("no image in this file")
    main = next((x for x in found if not x.reduced), found[0])
    less = sorted((x for x in found if x.reduced and x is not main), key=lambda x: -x.width)
    scaled = [dataclasses.replace(x, corner=main.corner, nodata=main.nodata, scale=(main.scale[0] * main.width / x.width, main.scale[1] * main.height / x.height)) for x in less]
    return [main, *scaled]


def _image(read: Read, tags: dict[int, tuple[str, int, int]], order: str) -> Image | None:
    def values(tag: int, default: tuple = ()) -> tuple:
        if tag not in tags:
            return default
        kind, n, at = tags[tag]
        return struct.unpack(f"{order}{n}{kind}", read(at, n * struct.calcsize(kind)))

    what = values(KIND, (0,))[0]
    if what & 4:
        return None
    width, height = values(WIDTH)[0], values(HEIGHT)[0]
    tiled = TILE_WIDTH in tags
    block = (values(TILE_HEIGHT)[0], values(TILE_WIDTH)[0]) if tiled else (min(values(ROWS, (height,))[0], height), width)
    sample = SAMPLES.get((values(FORMAT, (1,))[0], values(BITS, (1,))[0]))
    packing, differs = values(PACKING, (1,))[0], values(DIFFERS, (1,))[0]
    if not sample or packing not in (PLAIN, LZW, DEFLATE, OLD_DEFLATE, ZSTD) or differs not in (1, 2, 3) or differs == 2 and sample[0] == "f" or differs == 3 and sample[0] != "f":
        raise ValueError("this kind of TIFF is not supported")
    scale, tie = values(SCALE, (1.0, 1.0, 0.0)), values(TIE, (0.0,) * 6)
    said = b"".join(values(NODATA)).strip(b"\0 ")
    return Image(
        width, height, block, values(BANDS, (1,))[0], sample, packing, differs, values(PLANAR, (1,))[0] == 2, order, tags[TILES if tiled else STRIPS], tags[TILE_BYTES if tiled else STRIP_BYTES],
        (scale[0], scale[1]), (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1]), float(said) if said else None, bool(what & 1), tiled,
    )


def row_of_blocks(image: Image, read: Read, by: int, first: int = 0, last: int | None = None) -> list[list[tuple[int, int]]]:
    """The (offset, length) of the blocks ``first`` to ``last`` of a row of blocks, a list for each plane; only these entries are read."""
    last = image.across - 1 if last is None else last
    out = []
    for plane in range(image.bands if image.apart else 1):
        i, n = (plane * image.down + by) * image.across + first, last - first + 1
        own = []
        for kind, _, at in (image.places, image.sizes):
            size = struct.calcsize(kind)
            own.append(struct.unpack(f"{image.order}{n}{kind}", read(at + i * size, n * size)))
        out.append(list(zip(*own, strict=True)))
    return out


def unpacked(raw: bytes, image: Image) -> bytes:
    if image.packing == PLAIN:
        return raw
    if image.packing == LZW:
        return unlzw(raw)
    if image.packing == ZSTD:
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return zlib.decompress(raw)


def decoded(raw: bytes, image: Image, by: int, bx: int) -> np.ndarray:
    """(rows, columns, bands of the plane) of a block, cut to the image."""
    h, w = image.block
    rows = h if image.tiled else min(h, image.height - by * h)
    bands = 1 if image.apart else image.bands
    kind = np.dtype(image.order + image.sample)
    if not raw:  # a block that is left out holds no data
        data = np.full((rows, w, bands), np.nan if image.sample[0] == "f" else image.nodata or 0, kind)
    elif image.differs == 3:  # bytes of equal weight stand together and are differences
        steps = np.frombuffer(unpacked(raw, image), np.uint8, rows * w * bands * kind.itemsize).reshape(rows, -1)
        sums = np.empty_like(steps)
        for k in range(bands):
            sums[:, k::bands] = np.add.accumulate(steps[:, k::bands], 1, dtype=np.uint8)
        planes = sums.reshape(rows, kind.itemsize, w * bands)  # the highest byte first
        data = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">{image.sample}").reshape(rows, w, bands)
    else:
        data = np.frombuffer(unpacked(raw, image), kind, rows * w * bands).reshape(rows, w, bands)
        if image.differs == 2:
            data = np.add.accumulate(data.astype(image.sample), 1, dtype=image.sample)
    return data[: image.height - by * h, : image.width - bx * w]


def corner(image: Image, by: int, bx: int) -> tuple[float, float]:
    """The north-west corner of a block."""
    return image.corner[0] + bx * image.block[1] * image.scale[0], image.corner[1] - by * image.block[0] * image.scale[1]


def within(image: Image, bounds: tuple[float, float, float, float]) -> tuple[int, int, int, int] | None:
    """The blocks (first row, last row, first column, last column) whose insides meet the bounds (minx, miny, maxx, maxy)."""
    minx, miny, maxx, maxy = bounds
    h, w = image.block[0] * image.scale[1], image.block[1] * image.scale[0]
    x, y = image.corner
    if maxx <= x or minx >= x + image.width * image.scale[0] or miny >= y or maxy <= y - image.height * image.scale[1] or minx >= maxx or miny >= maxy:
        return None
    inside = lambda low, high, n: (int(np.clip(np.floor(low), 0, n - 1)), int(np.clip(np.ceil(high) - 1, 0, n - 1)))
    return *inside((y - maxy) / h, (y - miny) / h, image.down), *inside((minx - x) / w, (maxx - x) / w, image.across)


def level_for(found: list[Image], pixel: float | None) -> int:
    """The image with the largest pixels that are not larger than asked for; the full one if none."""
    fits = [i for i, x in enumerate(found) if pixel is not None and x.scale[0] <= pixel * (1 + 1e-9)]
    return max(fits, key=lambda i: found[i].scale[0], default=0)


def blocks(read: Read, image: Image, rows: range, columns: tuple[int, int] | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
    """(by, bx, array of rows, columns, bands) of rows of blocks; one block is held at a time."""
    first, last = columns or (0, image.across - 1)
    for by in rows:
        planes = row_of_blocks(image, read, by, first, last)
        for k, bx in enumerate(range(first, last + 1)):
            parts = [decoded(read(*plane[k]) if plane[k][1] else b"", image, by, bx) for plane in planes]
            yield by, bx, parts[0] if len(parts) == 1 else np.concatenate(parts, 2)


def unlzw(data: bytes) -> bytes:
    """TIFF's variant of Lempel, Ziv and Welch: codes of 9 to 12 bits, the highest bit first, widened one code early; 256 clears, 257 ends."""
    out, table, prev = bytearray(), [], None
    width, held, n = 9, 0, 0
    for byte in data:
        held, n = held << 8 | byte, n + 8
        if n < width:
            continue
        n -= width
        code, held = held >> n, held & (1 << n) - 1
        if code == 257:
            break
        if code == 256:
            table, prev, width = [bytes((i,)) for i in range(256)] + [b"", b""], None, 9
            continue
        entry = table[code] if code < len(table) else prev + prev[:1]
        if prev is not None:
            table.append(prev + entry[:1])
        out += entry
        prev = entry
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return bytes(out)
