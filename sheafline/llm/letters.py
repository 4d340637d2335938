"""Texts reduced to what comparisons regard: their letters and digits, without case."""

from __future__ import annotations

import json
import re

import xxhash

_OTHER = re.compile(r"[\W_]+")


def letters(text: str | None) -> str:
    """The Unicode letters and digits of a text in lower case; everything else is left out."""
    return _OTHER.sub("", text.lower().replace("ς", "σ")) if text else ""


class FieldParser:
    """Reads the fields of a record that is written in one of several label notations."""

    def __init__(self, labels: tuple[str, ...]):
        names = "|".join(r"\s*".join(map(re.escape, x)) for x in sorted(labels, key=len, reverse=True)) or r"(?!)"
        self.names = frozenset(labels)
        self.hint = re.compile(names)
        self.mark = re.compile(rf'【\s*({names})\s*】|"\s*({names})\s*"\s*[:：]|(?:^|[\n\r；;|｜,，])\s*(?:[-*•]\s*)?({names})\s*[:：=＝]|(?<=\s)[-*•]\s*({names})\s*[:：=＝]')

    def fields(self, body: str) -> list[tuple[str, str]] | None:
        """(label, letters of the value) in order of label; None for running text."""
        if not self.hint.search(body):
            return None
        if body.lstrip().startswith("{"):
            try:
                pairs = json.loads(body, strict=False, object_pairs_hook=list)
                if pairs and all(isinstance(v, str) and _OTHER.sub("", k) in self.names for k, v in pairs):
                    return sorted((_OTHER.sub("", k), letters(v)) for k, v in pairs)
            except (ValueError, TypeError, RecursionError):
                pass
        found = list(self.mark.finditer(body))
        if not found or _OTHER.sub("", body[: found[0].start()]):
            return None
        ends = [m.start() for m in found[1:]] + [len(body)]
        return sorted((_OTHER.sub("", next(filter(None, m.groups()))), letters(body[m.end() : e])) for m, e in zip(found, ends))

    def key(self, body: str) -> bytes:
        """128 bits that are equal for copies: the same letters, or the same labelled fields in any order."""
        fields = self.fields(body)
        if fields is None:
            return xxhash.xxh3_128_digest("T" + letters(body))
        return xxhash.xxh3_128_digest("F" + "\x1f".join(f"{k}\x1e{v}" for k, v in fields))
