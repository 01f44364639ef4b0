"""Media columns as progressive JPEG.

A payload of bytes is stored in the quantised coefficients of a 4:2:0 image, 48 bytes a block in the
zigzag places 1 to 48, each byte as one coefficient of magnitude 128 to 255 (the format's unit, so the
image is lossless for the payload). The file is a progressive JPEG: a DC scan and its refinement,
then for each component two spectral bands, each with a first scan of the high bits and a
successive-approximation scan of the last bit. The decoder accumulates all scans into coefficient
arrays, dequantises, inverse-transforms in numpy, upsamples the chroma planes and gives RGB tensors
of full resolution. Scans whose code lengths are all equal are decoded as whole arrays; any other
scan is decoded bit by bit.

Defined results: a null text counts as empty; an empty payload becomes one unit of padding. Texts of
any length are stored whole (up to the format's 65,535 pixels a side, 4.8 GB of payload). Rows keep their
ids, null or repeated; extra columns are ignored. Media that is not such a file raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIT = 576
PER_BLOCK = 48
BANDS = ((1, 16), (17, PER_BLOCK))
PART_BYTES = 4 << 20
#: Components: id, horizontal and vertical sampling, blocks of one MCU.
COMPONENTS = ((1, 2, 2), (2, 1, 1), (3, 1, 1))
#: AC code lengths: one bit for (run 0, size 7), five bits for the fifteen end-of-band runs.
AC_BITS, AC_SYMBOLS = bytes([1, 0, 0, 0, 15] + [0] * 11), bytes([0x07, *(n << 4 for n in range(15))])
DC_BITS, DC_SYMBOLS = bytes([1] + [0] * 15), bytes([0])


def _zigzag() -> np.ndarray:
    """Natural index of each zigzag place."""
    order = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in order])


ZIGZAG = _zigzag()


def _inverse_dct() -> np.ndarray:
    """Matrix from 64 coefficients in zigzag order to 64 samples."""
    k, x = np.meshgrid(np.arange(8), np.arange(8), indexing="ij")
    basis = np.cos((2 * x + 1) * k * np.pi / 16) / 2
    basis[0] /= np.sqrt(2)
    return np.ascontiguousarray(np.kron(basis, basis)[ZIGZAG].astype(np.float32))


IDCT = _inverse_dct()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _stuffed(bits: np.ndarray) -> bytes:
    """Entropy-coded bytes of an array of bits: padded with ones, a zero after each 255."""
    return _stuff(np.packbits(np.concatenate([bits, np.ones(-len(bits) % 8, np.uint8)])))


def _stuff(data: np.ndarray) -> bytes:
    return data.tobytes().replace(b"\xff", b"\xff\x00")


def _bits(value: int, n: int) -> np.ndarray:
    return ((value >> np.arange(n - 1, -1, -1)) & 1).astype(np.uint8)


def _scan(components: list[int], ss: int, se: int, ah: int, al: int, data: bytes) -> bytes:
    spec = b"".join(bytes([c, 0x00]) for c in components)
    return _segment(0xDA, bytes([len(components)]) + spec + bytes([ss, se, ah << 4 | al])) + data


def padded(payload: bytes) -> bytes:
    """The payload with bytes 255 up to a positive multiple of the unit."""
    return payload + b"\xff" * (max(1, -(-len(payload) // UNIT)) * UNIT - len(payload))


def encode(payload: bytes, n_bytes: int) -> bytes:
    """A progressive JPEG file that holds a padded payload; n_bytes, its length without padding, goes into a comment."""
    if not payload or len(payload) % UNIT:
        raise ValueError("the payload is not a positive multiple of the unit")
    mcus = len(payload) // (6 * PER_BLOCK)
    wide = int(np.ceil(np.sqrt(mcus)))
    high = -(-mcus // wide)
    cells = wide * high
    data = np.full(cells * 6 * PER_BLOCK, 255, np.uint8)
    data[: len(payload)] = np.frombuffer(payload, np.uint8)
    blocks = data.reshape(-1, PER_BLOCK)
    out = [b"\xff\xd8", _segment(0xFE, f"payload {len(payload)} of {n_bytes}".encode()), _segment(0xDB, bytes([0] + [1] * 64))]
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + b"".join(bytes([c, h << 4 | v, 0]) for c, h, v in COMPONENTS)))
    out.append(_segment(0xC4, bytes([0x00]) + DC_BITS + DC_SYMBOLS + bytes([0x10]) + AC_BITS + AC_SYMBOLS))
    zeros = _stuffed(np.zeros(6 * cells, np.uint8))
    out += [_scan([1, 2, 3], 0, 0, 0, 1, zeros), _scan([1, 2, 3], 0, 0, 1, 0, zeros)]
    planes = {1: blocks[: 4 * cells], 2: blocks[4 * cells : 5 * cells], 3: blocks[5 * cells :]}
    for ss, se in BANDS:
        for c, plane in planes.items():  # a zero bit, the code, and seven bits of amplitude: never 255
            out.append(_scan([c], ss, se, 0, 1, (plane[:, ss - 1 : se] >> 1).tobytes()))
    for ss, se in BANDS:
        for c, plane in planes.items():
            bits = []
            for i in range(0, len(plane), 32767):
                part = plane[i : i + 32767, ss - 1 : se] & 1
                n = len(part).bit_length() - 1
                bits += [_bits(0b10000 + n, 5), _bits(len(part) - (1 << n), n), part.ravel()]
            out.append(_scan([c], ss, se, 1, 0, _stuffed(np.concatenate(bits))))
    return b"".join([*out, b"\xff\xd9"])


class _Codes:
    """A Huffman table."""

    def __init__(self, counts: bytes, symbols: bytes):
        self.of: dict[tuple[int, int], int] = {}
        code = k = 0
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                self.of[length, code] = symbols[k]
                code, k = code + 1, k + 1
            code <<= 1


class _Bits:
    """Bits of an entropy-coded segment, one after another."""

    def __init__(self, data: np.ndarray):
        self.bits, self.at = np.unpackbits(data), 0

    def take(self, n: int) -> int:
        out = 0
        for b in self.bits[self.at : self.at + n].tolist():
            out = out << 1 | b
        self.at += n
        return out

    def symbol(self, codes: _Codes) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (length, code) in codes.of:
                return codes.of[length, code]
        raise ValueError("no such code")

    def value(self, size: int) -> int:
        v = self.take(size)
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def _dc_first(x: list[np.ndarray], codes: list[_Codes], data: np.ndarray, al: int) -> None:
    """x: for each component its DC values in MCU order, one row an MCU."""
    if all(c.of.get((1, 0)) == 0 for c in codes) and not np.unpackbits(data)[: sum(p.size for p in x)].any():
        return  # every difference is coded as none
    bits, last = _Bits(data), [0] * len(x)
    for m in range(len(x[0])):
        for c, plane in enumerate(x):
            for k in range(plane.shape[1]):
                last[c] += bits.value(bits.symbol(codes[c]))
                plane[m, k] = last[c] << al


def _dc_refine(x: list[np.ndarray], data: np.ndarray, al: int) -> None:
    wide = sum(p.shape[1] for p in x)
    bits = np.unpackbits(data)[: len(x[0]) * wide].reshape(-1, wide).astype(np.int32) << al
    at = 0
    for plane in x:
        plane |= bits[:, at : at + plane.shape[1]]
        at += plane.shape[1]


def _ac_first(band: np.ndarray, codes: _Codes, data: np.ndarray, al: int) -> None:
    """band: blocks by places of one band."""
    size = codes.of.get((1, 0), 0)
    if size == 7 and data.size == band.size and data.max(initial=0) < 128:  # each byte is one code and its amplitude
        a = data.reshape(band.shape).astype(np.int32)
        band[:] = np.where(a >= 64, a, a - 127) << al
        return
    bits, run = _Bits(data), 0
    for block in band:
        k = 0
        if run:
            run -= 1
            continue
        while k < len(block):
            rs = bits.symbol(codes)
            r, s = rs >> 4, rs & 15
            if s:
                k += r
                block[k] = bits.value(s) << al
            elif r == 15:
                k += 15
            else:
                run = (1 << r) + bits.take(r) - 1
                break
            k += 1


def _ac_refine(band: np.ndarray, codes: _Codes, data: np.ndarray, al: int) -> None:
    bits = _Bits(data)
    if band.all():  # no coefficient can be new: end-of-band runs, each before the bits of its blocks
        i = 0
        while i < len(band):
            r = bits.symbol(codes) >> 4
            part = band[i : i + (1 << r) + bits.take(r)]
            more = bits.bits[bits.at : bits.at + part.size].reshape(part.shape).astype(np.int32) << al
            bits.at += part.size
            part += np.where(part > 0, more, -more)
            i += len(part)
        return
    run, one = 0, 1 << al
    for block in band:

        def correct(k: int, block: np.ndarray = block) -> None:
            if bits.take(1):
                block[k] += one if block[k] > 0 else -one

        k = 0
        if not run:
            while k < len(block):
                rs = bits.symbol(codes)
                r, s = rs >> 4, rs & 15
                value = 0
                if s:
                    value = one if bits.take(1) else -one
                elif r < 15:
                    run = (1 << r) + bits.take(r)
                    break
                while k < len(block):
                    if block[k]:
                        correct(k)
                    elif r:
                        r -= 1
                    else:
                        if value:
                            block[k] = value
                        k += 1
                        break
                    k += 1
        if run:
            for k in range(k, len(block)):
                if block[k]:
                    correct(k)
            run -= 1


def coefficients(media: bytes) -> tuple[list[np.ndarray], int, int, np.ndarray, bytes]:
    """Accumulated coefficients (blocks of 64, zigzag) of each component, MCUs a row and in all, quantisers, comment."""
    buf = np.frombuffer(media, np.uint8)
    if media[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    ff = np.flatnonzero(buf[:-1] == 255)
    marks = ff[buf[ff + 1] != 0]
    at, planes, codes, note, quant = 2, [], {}, b"", np.ones(64, np.float32)
    wide = high = 0
    while True:
        marker, size = media[at + 1], int.from_bytes(media[at + 2 : at + 4], "big")
        if marker == 0xD9:
            break
        body = media[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            note = body
        elif marker == 0xDB:
            quant = np.frombuffer(body[1:65], np.uint8).astype(np.float32)
        elif marker == 0xC2:
            _, h, w, n = struct.unpack(">BHHB", body[:6])
            sampling = [body[7 + 3 * k] for k in range(n)]
            if sampling != [h << 4 | v for _, h, v in COMPONENTS] or h % 16 or w % 16:
                raise ValueError("only whole MCUs of 4:2:0 are read")
            wide, high = w // 16, h // 16
            planes = [np.zeros((wide * high * h * v, 64), np.int32) for _, h, v in COMPONENTS]
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                counts = body[k + 1 : k + 17]
                codes[body[k]] = _Codes(counts, body[k + 17 : k + 17 + sum(counts)])
                k += 17 + sum(counts)
        elif marker == 0xDA:
            end = int(marks[np.searchsorted(marks, at)])
            data = buf[at:end]
            stuffed = np.flatnonzero(data == 255)
            data = np.delete(data, stuffed + 1) if len(stuffed) else data
            at, n = end, body[0]
            of = [body[1 + 2 * k] - 1 for k in range(n)]
            tables = [body[2 + 2 * k] for k in range(n)]
            ss, se, approx = body[1 + 2 * n : 4 + 2 * n]
            ah, al = approx >> 4, approx & 15
            if ss == 0:
                x = []
                for c in of:  # DC scans go by MCU: 2 x 2 luma blocks, then chroma
                    v, h = COMPONENTS[c][2], COMPONENTS[c][1]
                    x.append(np.ascontiguousarray(planes[c][:, 0].reshape(high, v, wide, h).transpose(0, 2, 1, 3).reshape(-1, v * h)))
                if ah:
                    _dc_refine(x, data, al)
                else:
                    _dc_first(x, [codes[t >> 4] for t in tables], data, al)
                for c, plane in zip(of, x, strict=True):
                    v, h = COMPONENTS[c][2], COMPONENTS[c][1]
                    planes[c][:, 0] = plane.reshape(high, wide, v, h).transpose(0, 2, 1, 3).ravel()
            else:
                band = planes[of[0]][:, ss : se + 1]
                (_ac_refine if ah else _ac_first)(band, codes[0x10 | tables[0] & 15], data, al)
        if at >= len(media):
            raise ValueError("the file ends early")
    return planes, wide, high, quant, note


def payload_of(planes: list[np.ndarray], note: bytes) -> bytes:
    """The padded payload that the coefficients hold."""
    v = np.concatenate(planes)[:, 1 : PER_BLOCK + 1].ravel()
    size = np.abs(v)
    data = np.where(v > 0, v, 254 - size + 2 * (size & 1)).astype(np.uint8)
    return data[: int(note.split()[1])].tobytes()


def rgb(planes: list[np.ndarray], wide: int, high: int, quant: np.ndarray) -> np.ndarray:
    """The full-resolution RGB tensor: inverse transform, chroma repeated two by two, colour conversion."""
    out = []
    for plane, (_, h, v) in zip(planes, COMPONENTS, strict=True):
        x = (plane * quant).astype(np.float32) @ IDCT
        x = x.reshape(high * v, wide * h, 8, 8).transpose(0, 2, 1, 3).reshape(high * v * 8, wide * h * 8)
        out.append(x if h == 2 else x.repeat(2, 0).repeat(2, 1))
    y, cb, cr = out
    y += 128
    both = np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], -1)
    return np.clip(np.rint(both, out=both), 0, 255, out=both).astype(np.uint8)


def feature(tensor: np.ndarray) -> str:
    """Height x width, the mean of each channel in thousandths, and the share of dark and bright values."""
    flat = tensor.reshape(-1, 3)
    means = (flat.sum(0, dtype=np.int64) * 1000 // len(flat)).tolist()
    dark, bright = int((flat < 64).sum()), int((flat >= 192).sum())
    return f"{tensor.shape[0]}x{tensor.shape[1]} " + " ".join(map(str, means)) + f" {dark * 1000 // flat.size} {bright * 1000 // flat.size}"


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about PART_BYTES in column 1."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)).cumsum()
    i = 0
    while i < len(batch):
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + PART_BYTES, "right")))
        yield batch.slice(i, j - i)
        i = j


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _pieces(batch):
            raw = [(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in part.column(1)]
            media = [encode(padded(x), len(x)) for x in raw]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])


def _read(tensors: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch):
                rows = []
                for m in part.column(1):
                    media = m.as_py()
                    planes, wide, high, quant, note = coefficients(media)
                    payload, tensor = payload_of(planes, note), rgb(planes, wide, high, quant)
                    if tensors:
                        rows.append((payload, tensor.shape[0], tensor.shape[1], tensor.tobytes(), feature(tensor)))
                    else:
                        rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(tensor)))
                kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.string()) if tensors else (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["id", "n_bytes", *("abcdef"[: len(columns)])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *columns], names)

    return run


def store(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_bytes, media): each text's UTF-8 bytes as a progressive JPEG."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(_stored, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def read(media: DataFrame, *, id_col: str = "doc_id", tensors: bool = True) -> DataFrame:
    """From store(): rows (id_col, n_bytes, payload, height, width, rgb, feature), or without tensors the digests
    (payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) of what was read back."""
    rows = media.select(F.col(id_col).alias("id"), "media", "n_bytes")
    kind = rows.schema["id"].dataType.simpleString()
    if tensors:
        names, kinds = ("payload", "height", "width", "rgb", "feature"), ("binary", "int", "int", "binary", "string")
    else:
        names, kinds = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"), ("long", "string", "long", "long", "string", "string")
    schema = ", ".join([f"id {kind}", "n_bytes long", *(f"{x} {k}" for x, k in zip("abcdef", kinds, strict=False))])
    out = rows.mapInArrow(_read(tensors), schema)
    return out.select(F.col("id").alias(id_col), "n_bytes", *(F.col(x).alias(n) for x, n in zip("abcdef", names, strict=False)))
