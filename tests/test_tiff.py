"""TIFF stacks written byte by byte: offsets of 32 and 64 bits, strips and tiles, compressions, differences."""

import io
import struct
import zlib

import numpy as np
import pytest

from voxloom.operators import storage
from voxloom.sources import planes


def lzw(data):
    """Codes as the format describes them, from a table of strings."""
    codes, table, word = [256], {bytes([k]): k for k in range(256)}, b""
    widths, n = [9], 258
    width = 9
    for b in data:
        longer = word + bytes([b])
        if longer in table:
            word = longer
            continue
        codes.append(table[word])
        widths.append(width)
        table[longer] = n
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
        if n == 4095:
            codes.append(256)
            widths.append(width)
            table, n, width = {bytes([k]): k for k in range(256)}, 258, 9
        word = bytes([b])
    if word:
        codes.append(table[word])
        widths.append(width)
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    codes.append(257)
    widths.append(width)
    bits = "".join(format(c, f"0{w}b") for c, w in zip(codes, widths, strict=True))
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def packbits(data):
    out = b""
    k = 0
    while k < len(data):
        n = 1
        while n < 128 and k + n < len(data) and data[k + n] == data[k]:
            n += 1
        out += bytes([257 - n, data[k]]) if n > 1 else bytes([0, data[k]])
        k += n
    return out


PACK = {1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}


def tiff(stack, e="<", big=False, how=1, ahead=1, tile=None, strip=3, text=None):
    word, n_form = ("Q", "Q") if big else ("I", "H")
    out = io.BytesIO()
    head = (b"II" if e == "<" else b"MM") + struct.pack(e + "H", 43 if big else 42) + (struct.pack(e + "HH", 8, 0) if big else b"")
    out.write(head)
    link = out.tell()
    out.write(struct.pack(e + word, 0))
    for p in stack:
        h, w = p.shape
        places, sizes = [], []
        down, across = tile or (strip, w)
        for y in range(0, h, down):
            for x in range(0, w, across):
                a = np.zeros((down if tile else min(down, h - y), across), p.dtype)
                part = p[y : y + down, x : x + across]
                a[: part.shape[0], : part.shape[1]] = part
                if ahead == 2:
                    a[:, 1:] -= a[:, :-1].copy()
                data = PACK[how](a.astype(a.dtype.newbyteorder(e)).tobytes())
                places.append(out.tell())
                sizes.append(len(data))
                out.write(data)
        tags = {256: (3, [w]), 257: (3, [h]), 258: (3, [8 * p.dtype.itemsize]), 259: (3, [how]), 277: (3, [1]), 317: (3, [ahead])}
        tags |= {322: (3, [across]), 323: (3, [down]), 324: (16 if big else 4, places), 325: (4, sizes)} if tile else {273: (16 if big else 4, places), 278: (3, [down]), 279: (4, sizes)}
        if text:
            tags[270] = (2, list(text.encode()))
        fields = b""
        for k, (kind, v) in sorted(tags.items()):
            value = struct.pack(f"{e}{len(v)}{ {2: 'B', 3: 'H', 4: 'I', 16: 'Q'}[kind]}", *v)
            room = 8 if big else 4
            if len(value) > room:
                at = out.tell()
                out.write(value)
                value = struct.pack(e + word, at)
            fields += struct.pack(f"{e}HH{word}", k, kind, len(v)) + value.ljust(room, b"\0")
        at = out.tell()
        out.write(struct.pack(e + n_form, len(tags)) + fields)
        end = out.tell()
        out.write(struct.pack(e + word, 0))
        out.seek(link)
        out.write(struct.pack(e + word, at))
        out.seek(0, 2)
        link = end
    return out.getvalue()


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("e", ["<", ">"])
@pytest.mark.parametrize("how", [1, 5, 8, 32773])
@pytest.mark.parametrize("ahead", [1, 2])
def test_pages(big, e, how, ahead):
    rng = np.random.default_rng(how)
    for tile in (None, (16, 16)):
        for dtype in (np.uint8, np.uint16):
            stack = np.minimum(rng.integers(0, 300, (2, 21, 37)) // 40 * 40, 255).astype(dtype)
            stack[1] = rng.integers(0, 250, (21, 37))
            f = io.BytesIO(tiff(stack, e, big, how, ahead, tile))
            order, pages = planes.tiff_pages(f)
            assert order == e and len(pages) == 2
            for p, tags in zip(stack, pages, strict=True):
                assert np.array_equal(planes.tiff_plane(f, order, tags), p)


def test_lzw_fills_its_table():
    data = np.random.default_rng(0).integers(0, 256, 9000).astype(np.uint8).tobytes()
    assert planes.lzw(lzw(data)) == data
    with pytest.raises(ValueError, match="not there"):
        planes.lzw(int("100000000" + "111111110" + "000000", 2).to_bytes(3, "big"))


def test_one_directory_for_many_planes(spark, tmp_path):
    stack = np.random.default_rng(1).integers(1, 60_000, (5, 9, 8)).astype(np.uint16)
    whole = tiff(stack.reshape(1, 45, 8), strip=45, text="ImageJ\nimages=5\nslices=5")
    at = whole.index(struct.pack("<HHI", 257, 3, 1)) + 8
    (tmp_path / "s.tif").write_bytes(whole[:at] + struct.pack("<H", 9) + whole[at + 2 :])
    planes.register(spark)
    got = np.zeros(stack.shape)
    for r in storage.to_voxels(spark.read.format("voxtiff").option("path", str(tmp_path / "s.tif")).option("planes", 2).load()).collect():
        got[r["z"], r["y"], r["x"]] = r["v"]
    assert np.array_equal(got, stack)


def test_what_is_not_read():
    stack = np.zeros((1, 4, 4), np.uint16)
    f = io.BytesIO(tiff(stack))
    e, pages = planes.tiff_pages(f)
    for change in ({258: [32]}, {259: [7]}, {277: [3]}, {317: [3]}):
        with pytest.raises(ValueError, match="not supported"):
            planes.tiff_plane(f, e, {**pages[0], **change})
    with pytest.raises(ValueError, match="not a TIFF"):
        planes.tiff_pages(io.BytesIO(b"PK\x03\x04" + bytes(20)))
