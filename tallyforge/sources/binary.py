"""Typed arrays out of binary files: a small decoder per format over ``binaryFile`` rows, in tasks.

Every decoder yields (record, kind, shape, axes, values as doubles); whole numbers of 64 bits, which
a double cannot hold, stand in ``longs`` instead. A file that does not fit its format yields one row
with ``error`` set and no values, so that rejects are counted, not lost; so do unsigned numbers
beyond the signed 64 bits. Files are read whole by a task, as these formats cannot be split.
"""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import ship

SCHEMA = "path string, record int, kind string, shape array<int>, axes array<string>, values array<double>, longs array<bigint>, error string"
Decoded = tuple[str, tuple[int, ...], tuple[str, ...], np.ndarray]

#: Codes of raw arrays.
KINDS = {"u8": "u1", "i8": "i1", "u16": "u2", "i16": "i2", "f16": "f2", "u32": "u4", "i32": "i4", "f32": "f4", "u64": "u8", "i64": "i8", "f64": "f8"}


def need(test: bool, what: str) -> None:
    if not test:
        raise ValueError(what)


def raw(kind: str, big_endian: bool = False) -> Callable[[bytes], Iterator[Decoded]]:
    def decode(data: bytes) -> Iterator[Decoded]:
        dtype = np.dtype((">" if big_endian else "<") + KINDS[kind])
        need(len(data) % dtype.itemsize == 0, "size is no multiple of the element")
        values = np.frombuffer(data, dtype)
        yield kind, (len(values),), ("value",), values

    return decode


def wav(data: bytes) -> Iterator[Decoded]:
    """PCM of 16 bits; several channels as (frame, channel)."""
    need(data[:4] == b"RIFF" and data[8:12] == b"WAVE", "no WAVE file")
    at, channels = 12, 0
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"fmt ":
            code, channels, _, _, _, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            need(code in (1, 0xFFFE) and bits == 16, "not 16-bit PCM")
        if name == b"data":
            need(channels > 0 and at + 8 + size <= len(data), "cut short")
            values = np.frombuffer(data, "<i2", size // 2, at + 8)
            shape = (len(values),) if channels == 1 else (len(values) // channels, channels)
            yield "i16", shape, ("frame",) if channels == 1 else ("frame", "channel"), values
        at += 8 + size + size % 2


def npy(data: bytes) -> Iterator[Decoded]:
    array = np.load(io.BytesIO(data), allow_pickle=False)
    need(array.dtype.kind in "uif", "no numbers")
    yield f"{array.dtype.kind}{array.dtype.itemsize * 8}", array.shape, tuple(f"axis{i}" for i in range(array.ndim)), array.ravel()


def npz(data: bytes) -> Iterator[Decoded]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name in sorted(z.namelist()):
            yield from npy(z.read(name))


def tiff16(data: bytes) -> Iterator[Decoded]:
    """One record per directory: one 16-bit sample a pixel, uncompressed or deflated, without predictor."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    need(order is not None, "no TIFF file")
    at = struct.unpack_from(order + "I", data, 4)[0]
    while at:
        tags = {}
        count = struct.unpack_from(order + "H", data, at)[0]
        for i in range(count):
            tag, kind, n, value = struct.unpack_from(order + "HHI4s", data, at + 2 + 12 * i)
            code = {3: "H", 4: "I"}.get(kind)
            if code:
                size = struct.calcsize(code) * n
                place = at + 2 + 12 * i + 8 if size <= 4 else struct.unpack(order + "I", value)[0]
                tags[tag] = struct.unpack_from(f"{order}{n}{code}", data, place)
        width, height = tags[256][0], tags[257][0]
        packing = tags.get(259, (1,))[0]
        need(tags.get(258, (1,)) == (16,) and packing in (1, 8, 32946) and tags.get(317, (1,))[0] == 1, "other TIFF layout")
        strips = [data[o : o + n] for o, n in zip(tags[273], tags[279], strict=True)]
        body = b"".join(strips if packing == 1 else map(zlib.decompress, strips))
        need(len(body) == 2 * width * height, "strips do not fit the image")
        signed = tags.get(339, (1,))[0] == 2
        yield ("i16" if signed else "u16"), (height, width), ("row", "column"), np.frombuffer(body, order + ("i2" if signed else "u2"), width * height)
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * count)[0]


def las_intensity(data: bytes) -> Iterator[Decoded]:
    need(data[:4] == b"LASF", "no LAS file")
    start, size = struct.unpack_from("<I", data, 96)[0], struct.unpack_from("<H", data, 105)[0]
    count = struct.unpack_from("<I", data, 107)[0]
    if data[25] >= 4 and not count:  # from version 1.4 on the count of 64 bits holds
        count = struct.unpack_from("<Q", data, 247)[0]
    need(size >= 14 and start + size * count <= len(data), "cut short")
    points = np.frombuffer(data, np.uint8, size * count, start).reshape(count, size)
    yield "u16", (count,), ("point",), points[:, 12:14].copy().view("<u2").ravel()


def hgt(data: bytes) -> Iterator[Decoded]:
    """A square elevation tile of big-endian 16-bit heights."""
    side = int((len(data) // 2) ** 0.5)
    need(side * side * 2 == len(data) and side > 1, "no square tile")
    yield "i16", (side, side), ("row", "column"), np.frombuffer(data, ">i2")


def mrc(data: bytes) -> Iterator[Decoded]:
    nx, ny, nz, mode = struct.unpack_from("<4i", data)
    kind = {0: "i1", 1: "i2", 2: "f4", 6: "u2"}.get(mode)
    need(kind is not None and len(data) >= 1024, "other MRC mode")
    start = 1024 + struct.unpack_from("<i", data, 92)[0]
    need(start + nx * ny * nz * np.dtype(kind).itemsize <= len(data), "cut short")
    yield {"i1": "i8", "i2": "i16", "f4": "f32", "u2": "u16"}[kind], (nz, ny, nx), ("section", "row", "column"), np.frombuffer(data, "<" + kind, nx * ny * nz, start)


def segy_i16(data: bytes) -> Iterator[Decoded]:
    """SEG-Y of format 3: one record a trace, of the length that its own header gives, else the file's."""
    need(len(data) > 3600 and struct.unpack_from(">h", data, 3224)[0] == 3, "no SEG-Y file of format 3")
    usual, at = struct.unpack_from(">H", data, 3220)[0], 3600
    while at < len(data):
        need(at + 240 <= len(data), "traces do not fit")
        n = struct.unpack_from(">H", data, at + 114)[0] or usual
        need(n > 0 and at + 240 + 2 * n <= len(data), "traces do not fit")
        yield "i16", (n,), ("sample",), np.frombuffer(data, ">i2", n, at + 240)
        at += 240 + 2 * n


def iq16(data: bytes) -> Iterator[Decoded]:
    need(len(data) % 4 == 0, "no whole pairs")
    yield "i16", (len(data) // 4, 2), ("sample", "iq"), np.frombuffer(data, "<i2")


DECODERS: dict[str, Callable[[bytes], Iterator[Decoded]]] = {"wav": wav, "npy": npy, "npz": npz, "tif": tiff16, "tiff": tiff16, "las": las_intensity, "hgt": hgt, "mrc": mrc, "sgy": segy_i16, "segy": segy_i16, "iq": iq16}


def decode_files(spark: SparkSession, path: str, decoder: Callable[[bytes], Iterator[Decoded]] | None = None) -> DataFrame:
    """Records of the files under ``path``, by the decoder given or that of each file's suffix."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at = 0
                try:
                    use = decoder or DECODERS.get(name.rpartition(".")[2].lower())
                    need(use is not None, "no decoder for this suffix")
                    for at, (kind, shape, axes, values) in enumerate(list(use(data))):  # a damaged file gives nothing
                        wide = kind in ("i64", "u64")
                        need(kind != "u64" or not len(values) or int(values.max()) < 1 << 63, "beyond 64 signed bits")
                        row = [name], [at], [kind], [list(shape)], [list(axes)], [None if wide else np.asarray(values, float)], [values.astype(np.int64) if wide else None], [None]
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, TYPES, strict=True)], NAMES)
                except (ValueError, KeyError, struct.error, zipfile.BadZipFile, zlib.error) as e:
                    row = [name], [at], [None], [None], [None], [None], [None], [str(e)]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, TYPES, strict=True)], NAMES)

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


TYPES = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.string()]
NAMES = ["path", "record", "kind", "shape", "axes", "values", "longs", "error"]


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """archive, member, content of every file in the zip archives under ``path``."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for member in z.namelist():
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([member]), pa.array([z.read(member)], pa.binary())], ["archive", "member", "content"])

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, member string, content binary")
