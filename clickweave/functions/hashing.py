"""MD5 bucket expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_BUCKETS = 1 << 31
# odd, and small enough that its product with 32 bits is a long
MIX_FACTOR = 0x45D9F3B
_HEX_PER_CHUNK = 8


def _chunk(hex_digest: Column, k: int) -> Column:
    """The k-th 32-bit group of a hex digest as a BIGINT."""
    return F.conv(F.substring(hex_digest, k * _HEX_PER_CHUNK + 1, _HEX_PER_CHUNK), 16, 10).cast("bigint")


def md5_u32(text: Column) -> Column:
    """First 32 bits of the MD5 of the UTF-8 text."""
    return _chunk(F.md5(text.cast("binary")), 0)


def mixed_u32(bits: Column) -> Column:
    """Spread 32 bits, given as a BIGINT, over all places (a bijection)."""
    for _ in range(2):
        folded = bits.bitwiseXOR(F.shiftright(bits, 16)) * F.lit(MIX_FACTOR).cast("bigint")
        bits = folded.bitwiseAND(F.lit((1 << 32) - 1).cast("bigint"))
    return bits.bitwiseXOR(F.shiftright(bits, 16))


def md5_hex(text: Column) -> Column:
    """MD5 of the UTF-8 text as 32 hexadecimal digits."""
    return F.md5(text.cast("binary"))


def hex_mod(digest: Column, n: int) -> Column:
    """128 bits, given as hexadecimal digits, modulo ``n``; exact for 1 <= n <= 2**31."""
    if not 1 <= n <= MAX_BUCKETS:
        raise ValueError(f"number of buckets must lie in 1..{MAX_BUCKETS}, got {n}")
    if n & (n - 1) == 0:
        # a power of two sees the low bits only
        return _chunk(digest, 3).bitwiseAND(F.lit(n - 1).cast("bigint"))
    size, shift = F.lit(n).cast("bigint"), F.lit(1 << 32)
    rest = _chunk(digest, 0) % size
    for k in (1, 2, 3):
        rest = (rest * shift + _chunk(digest, k)) % size
    return rest


def md5_mod(text: Column, n: int) -> Column:
    """128-bit MD5 of the UTF-8 text, modulo ``n``."""
    return hex_mod(md5_hex(text), n)


def feature_string(value: Column, feature_id: Column) -> Column:
    """Value followed by feature id, with no separator."""
    return F.concat(value, feature_id.cast("string"))
