"""What SQL cannot express: format-preserving encryption, class-preserving random characters, random tokens; Arrow functions."""

from __future__ import annotations

import hashlib
import hmac
import itertools
import math
import re
import secrets

import pandas as pd
from pyspark.sql import functions as F

from .hashing import VR_WIDTH, derive_key

ROUNDS = 10
UPPER, LOWER, DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
RUNS = re.compile("[A-Z]+|[a-z]+|[0-9]+")


def _round_digits(key: bytes, radix: int, number: int, half: list[int], n: int) -> list[int]:
    """n digits from a chain of HMAC-SHA1 blocks over the round's number and half; each block is one big-endian number."""
    word = lambda v: v.to_bytes(4, "little")
    seed, per_block = word(number) + b"".join(map(word, half)), max(1, int(20 * (math.log(256) / math.log(radix))))
    out: list[int] = []
    for counter in itertools.count():
        if len(out) >= n:
            return out[:n]
        block = hmac.new(key, seed + word(counter), hashlib.sha1).digest()
        value = int.from_bytes(block, "big")
        for _ in range(per_block):
            value, digit = divmod(value, radix)
            out.append(digit)
        seed = block
    raise AssertionError


def feistel(key: bytes, text: str, alphabet: str, decrypt: bool = False) -> str:
    """Ten rounds over the digits of text in its alphabet; the first half is the shorter one."""
    radix, digits = len(alphabet), [alphabet.index(c) for c in text]
    cut = len(digits) // 2
    if not decrypt:
        a, b = digits[:cut], digits[cut:]
        for k in range(ROUNDS):
            a, b = b, [(x + y) % radix for x, y in zip(a, _round_digits(key, radix, k, b, len(a)))]
    else:
        a, b = digits[:cut], digits[cut:]
        for k in reversed(range(ROUNDS)):
            a, b = [(x - y) % radix for x, y in zip(b, _round_digits(key, radix, k, a, len(b)))], a
    return "".join(alphabet[d] for d in a + b)


def _alphabet(run: str) -> tuple[str, str]:
    return ("upper", UPPER) if run[0] in UPPER else ("lower", LOWER) if run[0] in LOWER else ("digit", DIGIT)


def fpe(value: str, master: str, column: str, decrypt: bool = False) -> str:
    """value with each run of one ASCII class encrypted (or decrypted) within its class, under a key of column, class and length."""

    def one(found: re.Match) -> str:
        name, alphabet = _alphabet(found[0])
        return feistel(derive_key(master, f"{column}:{name}:{len(found[0])}"), found[0], alphabet, decrypt)

    return RUNS.sub(one, value)


def fpe_digits(value: str, master: str, column: str) -> str:
    """Values of digits only are encrypted, others stay."""
    return fpe(value, master, column) if value and all(c in DIGIT for c in value) else value


def fpe_pan(value: str, master: str, column: str) -> str:
    """Values of five capitals, four digits and a capital are encrypted, others stay."""
    return fpe(value, master, column) if re.fullmatch("[A-Z]{5}[0-9]{4}[A-Z]", value) else value


def random_class(value: str) -> str:
    """Each ASCII digit, capital and small letter replaced by a random one of its class."""
    pools = {c: pool for pool in (UPPER, LOWER, DIGIT) for c in pool}
    return "".join(secrets.choice(pools[c]) if c in pools else c for c in value)


def mask_groups(value: str, pattern: str, groups: list[tuple[int, str]], char: str) -> str:
    """In every match, the first occurrence of each group's text masked in full, or all but its first character (partial)."""

    def one(found: re.Match) -> str:
        text = found[0]
        for number, mode in groups:
            old = found[number] if number <= (found.re.groups or 0) else None
            if old:
                keep = 1 if mode == "partial" else 0
                text = text.replace(old, old[:keep] + char * (len(old) - keep), 1)
        return text

    return re.sub(pattern, one, value)


def _each(function, *, random: bool = False):
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(function, na_action="ignore")

    return run.asNondeterministic() if random else run


def fpe_udf(master: str, column: str, decrypt: bool = False):
    return _each(lambda v: fpe(v, master, column, decrypt))


def fpe_column_udf(master: str):
    """(value, column) to the value encrypted under its column's keys."""

    @F.pandas_udf("string")
    def run(values: pd.Series, columns: pd.Series) -> pd.Series:
        return pd.Series([None if v is None or v != v else fpe(v, master, c) for v, c in zip(values, columns)], dtype=object)

    return run


def random_class_udf():
    return _each(random_class, random=True)


def mask_groups_udf(pattern: str, groups: list[tuple[int, str]], char: str = "*"):
    return _each(lambda v: mask_groups(v, pattern, groups, char))


def random_token_udf():
    """(value, vr, is_uid) to an opaque token or identifier; persist the result before it is read twice."""

    @F.pandas_udf("string")
    def run(values: pd.Series, vrs: pd.Series, uids: pd.Series) -> pd.Series:
        def one(value, vr, uid):
            if value is None or value != value:
                return None
            if uid:
                return f"2.25.{secrets.randbits(128)}"
            return ("TK-" + secrets.token_hex(16).upper())[: VR_WIDTH.get(vr)]

        return pd.Series([one(*x) for x in zip(values, vrs, uids)], dtype=object)

    return run.asNondeterministic()
