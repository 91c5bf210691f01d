"""The configurable mask: its document, checked, and its steps composed into one Column or applied to one value."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import functions as F

from .ciphers import mask_groups, random_class

ORDER = ("characters", "regex", "class")


@dataclass(frozen=True)
class Pattern:
    """One pattern: a regular expression, or a description of what lies before, after or between marks; how much of it, and which groups, to mask."""

    regex: str = ""
    kind: str = ""
    delimiter: str = ""
    start: str = ""
    end: str = ""
    char: str = "*"
    length: int | None = None
    groups: tuple[tuple[int, str], ...] = ()

    def derived(self) -> str:
        """The regular expression of the description; empty where it says nothing."""
        left, right = re.escape(self.start), re.escape(self.end)
        if self.kind == "in_between":
            return "" if not (self.start and self.end) else f"{left}(.+)$" if self.end == "$" else f"{left}(.+?){right}"
        mark = re.escape(self.delimiter)
        return {"before": f"^(.+?){mark}", "after": f"{mark}(.+)$"}.get(self.kind, "") if mark else ""

    def beside(self, value: str) -> str:
        """value with `length` characters before or after every delimiter masked."""
        parts = value.split(self.delimiter)
        for k, part in enumerate(parts):
            if self.kind == "after" and k:
                n = min(len(part), self.length)
                parts[k] = self.char * n + part[n:]
            elif self.kind == "before" and k < len(parts) - 1:
                n = min(len(part), self.length)
                parts[k] = part[: len(part) - n] + self.char * n
        return self.delimiter.join(parts)

    def apply(self, value: str) -> str:
        """The delimiter's mask where it changes anything; else the expression, or where that is none the derived one; else value."""
        if self.length is not None and self.delimiter and self.kind in ("before", "after"):
            masked = self.beside(value)
            if masked != value:
                return masked
        for source, is_derived in ((self.regex, False), (self.derived(), True)):
            if not source:
                continue
            try:
                re.compile(source)
            except re.error:
                continue
            groups = list(self.groups) or ([(1, "full")] if is_derived else None)
            if groups:
                return mask_groups(value, source, groups, self.char)
            return re.sub(source, lambda found: self.char * len(found[0]), value)
        return value


@dataclass(frozen=True)
class Mask:
    column: str
    char: str = "*"
    positions: tuple[int, ...] = ()
    patterns: tuple[Pattern, ...] = ()
    order: tuple[str, ...] = ORDER
    classes: str | None = None
    letter: str = "X"
    digit: str = "0"

    def apply(self, value: str) -> str:
        """value after the steps, in their order."""
        for step in self.order:
            if step == "characters":
                value = "".join(self.char if k in self.positions else c for k, c in enumerate(value, 1))
            elif step == "regex":
                for pattern in self.patterns:
                    value = pattern.apply(value)
            elif step == "class" and self.classes == "random_class":
                value = random_class(value)
            elif step == "class" and self.classes == "fixed_class":
                value = "".join(self.digit if c.isdigit() else self.letter if c.isalpha() else c for c in value)
        return value

    def udf(self):
        """An Arrow function over a column."""

        @F.pandas_udf("string")
        def run(values: pd.Series) -> pd.Series:
            return values.map(self.apply, na_action="ignore")

        return run.asNondeterministic() if self.classes == "random_class" else run


def parse(entry: Any) -> Mask:
    """The mask of an entry; ValueError where it has no column, or positions or patterns of the wrong kind."""
    if not isinstance(entry, dict) or not entry.get("column"):
        raise ValueError("a mask is an object with a column")
    char = (entry.get("masking_char") or entry.get("masking_character") or "*")[0]
    positions = entry.get("characters_to_mask") or []
    if any(not isinstance(p, int) for p in positions):
        raise ValueError("positions must be whole numbers")
    patterns = []
    for p in entry.get("regex_patterns") or []:
        if not isinstance(p, dict):
            raise ValueError("a pattern is an object")
        groups = tuple((int(k), v) for k, v in (p.get("mask_groups") or {}).items() if str(k).lstrip("-").isdigit() and isinstance(v, str))
        length = max(0, p["length"]) if isinstance(p.get("length"), int) else None
        patterns.append(Pattern(p.get("regex") or "", (p.get("type") or "").lower(), p.get("delimiter") or "", p.get("start") or "", p.get("end") or "", (p.get("masking_char") or char)[0], length, groups))
    return Mask(entry["column"], char, tuple(p for p in positions if p > 0), tuple(patterns), tuple(entry.get("apply_order") or ORDER), entry.get("class_masking_mode"),
                (entry.get("class_mask_letter") or "X")[0], (entry.get("class_mask_digit") or "0")[0])
