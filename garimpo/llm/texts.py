"""Text normalisation shared by the operators on documents."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

_WORD = re.compile(r"[a-z0-9]+")
_HYPHEN = re.compile(r"[-‐‑­](?<=\w.)\s*\n\s*(?=\w)")
_INVISIBLE = re.compile(r"[­​-‏⁠﻿]")
_BROKEN = re.compile(r"[ÂÃ][\u0080-¿ŒœŠšŸŽžƒˆ˜–—‘-„†-•…‰‹›€™]")


def mend(text: str) -> str:
    """Undo UTF-8 that was read as Latin-1 or Windows-1252, where it can be undone."""
    if not ("Â" in text or "Ã" in text) or not _BROKEN.search(text):
        return text
    for codec in ("latin-1", "cp1252"):
        try:
            return text.encode(codec).decode("utf-8")
        except UnicodeError:
            continue
    return _BROKEN.sub(lambda m: _one(m[0]), text)


def _one(pair: str) -> str:
    for codec in ("latin-1", "cp1252"):
        try:
            return pair.encode(codec).decode("utf-8")
        except UnicodeError:
            continue
    return pair


def fold(text: str) -> str:
    """Lower case ASCII: accents dropped, broken accents mended, words divided at a line's end joined."""
    text = _INVISIBLE.sub("", _HYPHEN.sub("", mend(text)))
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()


#: stands between the texts of a batch; no text holds it after folding
BREAK = "\x01"


def fold_bytes(texts: list[str]) -> np.ndarray:
    """``fold`` of many texts in one go: their bytes, with one ``BREAK`` after each."""
    whole = BREAK.join([*(mend(t) for t in texts), ""]) if texts else ""
    if whole.count(BREAK) != len(texts):
        whole = BREAK.join([*(mend(t).replace(BREAK, " ") for t in texts), ""])
    if not whole.isascii():
        whole = _INVISIBLE.sub("", _HYPHEN.sub("", whole))
        return np.frombuffer(unicodedata.normalize("NFKD", whole).encode("ascii", "ignore").lower(), np.uint8)
    return np.frombuffer(_HYPHEN.sub("", whole).lower().encode(), np.uint8)


def words(text: str | None) -> list[str]:
    return _WORD.findall(fold(text)) if text else []
