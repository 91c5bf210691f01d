"""Hashes, identifier remapping, sub-keys and the reversible stream cipher, as Column expressions."""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import bind

#: The most characters a value representation holds.
VR_WIDTH = {
    "AE": 16, "AS": 4, "CS": 16, "DA": 8, "DS": 16, "DT": 26, "FL": 4, "FD": 8, "IS": 12,
    "LO": 64, "LT": 10240, "PN": 64, "SH": 16, "ST": 1024, "TM": 16, "UI": 64, "UL": 4, "US": 2,
}
HASH_WIDTH = 64


def vr_width(vr: Column, default: int | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in VR_WIDTH.items() for x in pair])
    return F.coalesce(F.element_at(table, vr), F.lit(default).cast("int"))


def fit_to_vr(value: Column, vr: Column, default: int | None = None) -> Column:
    """value cut to its representation's width; whole where the representation is not in the table and default is None."""
    width = vr_width(vr, default)
    return F.when(width.isNull(), value).otherwise(F.substring(value, F.lit(1), width))


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def keyed_digest(value: Column, key: Column) -> Column:
    """Nested keyed hash: the key before the hex digest of the key before the value."""
    return sha256(F.concat(key, sha256(F.concat(key, value))))


def keyed_hash(value: Column, vr: Column, key: Column) -> Column:
    return fit_to_vr(keyed_digest(value, key), vr, HASH_WIDTH)


def digest_to_uid(digest: Column) -> Column:
    """2.25. and the digest's first 128 bits in decimal, which no decimal type holds: by two 64-bit halves, each computed once."""
    whole = lambda c: c.cast("decimal(38,0)")
    billion = F.lit(10**9).cast("decimal(10,0)")

    def halves(d: Column) -> Column:
        half = lambda at: F.conv(F.substring(d, at, 16), 16, 10).cast("decimal(20,0)")
        return F.struct(half(1).alias("high"), half(17).alias("low"))

    # 2^64 = 18446744073 * 10^9 + 709551616
    def rest(x: Column) -> Column:
        return F.struct(x["high"].alias("high"), (whole(x["high"] * F.lit(709551616).cast("decimal(10,0)")) + whole(x["low"])).alias("rest"))

    def digits(x: Column) -> Column:
        # the remainder goes first: a quotient is rounded at its sixth place, up to the next whole number from .9999995 on
        low = (x["rest"] % billion).cast("decimal(10,0)")
        upper = whole(x["high"] * F.lit(18446744073).cast("decimal(11,0)")) + whole((x["rest"] - low) / billion)
        return F.struct(upper.alias("upper"), low.cast("string").alias("lower"))

    def text(x: Column) -> Column:
        return F.when(x["upper"] == 0, x["lower"]).otherwise(F.concat(x["upper"].cast("string"), F.lpad(x["lower"], 9, "0")))

    return F.concat(F.lit("2.25."), bind(bind(bind(bind(digest, halves), rest), digits), text))


def keyed_uid(value: Column, key: Column) -> Column:
    return digest_to_uid(keyed_digest(value, key))


def salted_hash(value: Column, vr: Column, is_uid: Column, salt: str) -> Column:
    return bind(sha256(F.concat(F.lit(salt), value)), lambda d: F.when(is_uid, digest_to_uid(d)).otherwise(fit_to_vr(d, vr)))


def subkey(master: str, context: Column) -> Column:
    """HMAC-SHA256 of the context under a constant key, first 16 bytes, in hex: the key's pads are literals."""
    key = master.encode()
    key = hashlib.sha256(key).digest() if len(key) > 64 else key
    pads = [bytes(b ^ x for b in key.ljust(64, b"\0")) for x in (0x36, 0x5C)]
    inner = F.unhex(F.sha2(F.concat(F.lit(pads[0]), context.cast("binary")), 256))
    return F.substring(F.sha2(F.concat(F.lit(pads[1]), inner), 256), 1, 32)


def derive_key(master: str, context: str) -> bytes:
    return hmac.new(master.encode(), context.encode(), hashlib.sha256).digest()[:16]


def _keystream(master: str, column: Column, n_bytes: Column) -> Column:
    """Hex of the key stream of a column, long enough for n_bytes."""
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(n_bytes / 16).cast("int") - 1, F.lit(0)))
    return F.array_join(F.transform(blocks, lambda b: subkey(master, F.concat(column, F.lit(":"), b.cast("string")))), "")


def _xor_hex(data: Column, master: str, column: Column) -> Column:
    """Hex of data (hex) against the column's key stream, four bytes at a time; the stream is made once per value."""
    both = bind(data, lambda d: F.struct(d.alias("d"), _keystream(master, column, F.length(d) / 2).alias("k")))
    number = lambda text: F.conv(text, 16, 10).cast("long")

    def word(x: Column, i: Column) -> Column:
        own = F.substring(x["d"], 8 * i + 1, F.lit(8))
        mixed = lambda a: F.lpad(F.hex(number(a).bitwiseXOR(number(F.substring(x["k"], 8 * i + 1, F.length(a))))), F.length(a), "0")
        return bind(own, mixed)

    def words(x: Column) -> Column:
        steps = F.filter(F.sequence(F.lit(0), F.ceil(F.length(x["d"]) / 8).cast("int")), lambda i: 8 * i < F.length(x["d"]))
        return F.lower(F.array_join(F.transform(steps, lambda i: word(x, i)), ""))

    return bind(both, words)


def _column(name: str | Column) -> Column:
    return F.lit(name) if isinstance(name, str) else name


def xor_encrypt(value: Column, master: str, column: str | Column) -> Column:
    """ENC$ and the hex of the value's UTF-8 bytes against a stream of HMAC blocks; never cut, reversible."""
    return F.concat(F.lit("ENC$"), _xor_hex(F.hex(value.cast("binary")), master, _column(column)))


def xor_decrypt(value: Column, master: str, column: str | Column) -> Column:
    return F.decode(F.unhex(_xor_hex(F.substring(value, 5, 2**30), master, _column(column))), "UTF-8")
