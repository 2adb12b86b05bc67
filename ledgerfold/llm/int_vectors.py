"""Vectors of Arrow list columns as integer matrices, and exact products of such matrices.

A component x becomes floor(1024 * x), x as a double, which is exact. A vector that is null
or holds a null or non-finite component is left out. Integers whose distances or products
could leave a signed 64-bit number raise: no long could hold the result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCALE = 1024.0


def vectors(column: pa.Array, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows kept, the length of each, and all their integers in one array."""
    if column.null_count:
        places = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        column = column.drop_null()
    else:
        places = np.arange(len(column))
    size = column.value_lengths().to_numpy().astype(np.int64) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().cast(pa.float64(), safe=False)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(flat.fill_null(np.nan).to_numpy(zero_copy_only=False) * scale)
    first = np.concatenate([[0], np.cumsum(size)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False)))])
    good = bad[first[1:]] == bad[first[:-1]]
    values = values[np.repeat(good, size)]
    size = size[good]
    top = np.abs(values).max(initial=0)
    if size.max(initial=1) * (2 * top) ** 2 >= 2.0**63:
        raise OverflowError(f"vector component {top:.0f} (after scaling) is too large for results of 64 bits")
    return places[good], size, values.astype(np.int64)


def padded(size: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """One row a vector: shorter ones end in zeros, longer ones are cut."""
    out = np.zeros((len(size), width), np.int64)
    if len(size):
        row, at = np.repeat(np.arange(len(size)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
        fits = at < width
        out[row[fits], at[fits]] = values[fits]
    return out


def limb_bits(depth: int) -> int:
    """Bits of a limb so that sums of `depth` products of two limbs stay within 2**53."""
    return (55 - max(depth, 1).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """x as the sum of limb[i] * 2**(bits * i), limbs as doubles within +-2**(bits - 1)."""
    half, out = 1 << (bits - 1), []
    while True:
        low = ((x + half) & ((1 << bits) - 1)) - half
        out.append(low.astype(np.float64))
        x = (x - low) >> bits
        if not x.any():
            return out


def dot(a: list[np.ndarray], b: list[np.ndarray], bits: int) -> np.ndarray:
    """The exact int64 product of two matrices given as limbs: each product of limbs is an exact
    double, and sums of shifted ones are right modulo 2**64, so right where the result fits."""
    total = np.zeros((a[0].shape[0], b[0].shape[1]), np.int64)
    for i, left in enumerate(a):
        for j, right in enumerate(b):
            if bits * (i + j) < 64:
                total += (left @ right).astype(np.int64) << np.int64(bits * (i + j))
    return total
