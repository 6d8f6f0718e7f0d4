"""Schemas of the relations that stand for images, tiles and their metadata."""

from __future__ import annotations

#: One row per stored chunk; a chunk that is absent is all zeros. data: little-endian unsigned 16-bit values, z-major.
CHUNKS = "image string, level int, c int, cz int, cy int, cx int, z0 int, y0 int, x0 int, nz int, ny int, nx int, data binary"
U16_MAX = 65535
