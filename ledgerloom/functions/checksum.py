"""Mixed-case checksum form of addresses (EIP-55), batch by batch.

Spark has no Keccak-256, so this is the package's one pandas UDF. Each Arrow batch is
reduced to its distinct addresses first: an address that fills the batch is hashed once.
The permutation runs over all distinct addresses of the batch at once, lane by lane.
"""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# The function travels with the plan: executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Round constants and rotation offsets (index x + 5y) of Keccak-f[1600].
_ROUND_CONSTANTS = (
    0x0000000000000001, 0x0000000000008082, 0x800000000000808A, 0x8000000080008000,
    0x000000000000808B, 0x0000000080000001, 0x8000000080008081, 0x8000000000008009,
    0x000000000000008A, 0x0000000000000088, 0x0000000080008009, 0x000000008000000A,
    0x000000008000808B, 0x800000000000008B, 0x8000000000008089, 0x8000000000008003,
    0x8000000000008002, 0x8000000000000080, 0x000000000000800A, 0x800000008000000A,
    0x8000000080008081, 0x8000000000008080, 0x0000000080000001, 0x8000000080008008,
)
_ROTATIONS = (
    0, 1, 62, 28, 27, 36, 44, 6, 55, 20, 3, 10, 43, 25, 39, 41, 45, 15, 21, 8, 18, 2, 61, 56, 14,
)


def _rotate(lane, bits):
    if bits == 0:
        return lane
    return (lane << np.uint64(bits)) | (lane >> np.uint64(64 - bits))


def keccak_256(messages: np.ndarray) -> np.ndarray:
    """Digests of equally long messages (n x length bytes, at most 135) as n x 32 bytes."""
    count, length = messages.shape
    block = np.zeros((count, 136), dtype=np.uint8)
    block[:, :length] = messages
    block[:, length] ^= 0x01
    block[:, 135] ^= 0x80
    state = [np.zeros(count, dtype=np.uint64) for _ in range(25)]
    for i, lane in enumerate(np.ascontiguousarray(block).view("<u8").T):
        state[i] = lane.copy()
    for constant in _ROUND_CONSTANTS:
        parity = [
            state[x] ^ state[x + 5] ^ state[x + 10] ^ state[x + 15] ^ state[x + 20]
            for x in range(5)
        ]
        mixed = [parity[(x - 1) % 5] ^ _rotate(parity[(x + 1) % 5], 1) for x in range(5)]
        moved = [None] * 25
        for x in range(5):
            for y in range(5):
                lane = state[x + 5 * y] ^ mixed[x]
                moved[y + 5 * ((2 * x + 3 * y) % 5)] = _rotate(lane, _ROTATIONS[x + 5 * y])
        state = [
            moved[i] ^ (~moved[i - i % 5 + (i + 1) % 5] & moved[i - i % 5 + (i + 2) % 5])
            for i in range(25)
        ]
        state[0] = state[0] ^ np.uint64(constant)
    return np.stack(state[:4], axis=1).astype("<u8").view(np.uint8).reshape(count, 32)


def _checksum_keys(keys: list) -> list:
    if not keys:
        return []
    body = np.frombuffer("".join(k[2:] for k in keys).encode("ascii"), dtype=np.uint8)
    body = body.reshape(len(keys), 40)
    digest = keccak_256(body)[:, :20]
    nibbles = np.stack([digest >> 4, digest & 15], axis=2).reshape(len(keys), 40)
    raised = np.where((nibbles >= 8) & (body >= ord("a")), body - 32, body).astype(np.uint8)
    text = raised.tobytes().decode("ascii")
    return ["0x" + text[i : i + 40] for i in range(0, len(text), 40)]


@F.pandas_udf(StringType())
def _checksum_batch(key: pd.Series) -> pd.Series:
    codes, distinct = pd.factorize(key)
    shown = np.array(_checksum_keys(list(distinct)) + [None], dtype=object)
    return pd.Series(shown[codes])


def checksum_address(key: Column) -> Column:
    """Checksum form of a lowercase address key (see `address_key`); null stays null."""
    return _checksum_batch(key)
