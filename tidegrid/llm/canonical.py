"""Words of a text with disguises undone, for matching; never for display.

Mark-up and character references go, invisible characters go, look-alike letters of other scripts and accented letters become plain ones, case goes."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

# Letters of other scripts that look like Latin ones (a choice from the public Unicode confusables list).
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "з": "3",
    "А": "a", "В": "b", "С": "c", "Е": "e", "Н": "h", "І": "i", "Ј": "j", "К": "k", "М": "m", "О": "o", "Р": "p", "Ѕ": "s", "Т": "t", "Х": "x", "У": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "σ": "o", "ϲ": "c", "γ": "y", "μ": "u",
    "Α": "a", "Β": "b", "Ε": "e", "Ζ": "z", "Η": "h", "Ι": "i", "Κ": "k", "Μ": "m", "Ν": "n", "Ο": "o", "Ρ": "p", "Τ": "t", "Υ": "y", "Χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ß": "ss", "æ": "ae", "œ": "oe", "ƒ": "f",
}
_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,200}>|<!--.*?-->", re.S)
_LINE = re.compile(r"(?m)^[ \t]*(?:>[ \t]?)+")
_HYPHEN = re.compile(r"(?<=\w)[-‐‑]\r?\n\s*(?=\w)")
_WORD = re.compile(r"[^\W_]+")


@lru_cache(100_000)
def _char(c: str) -> str:
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    kind = unicodedata.category(c)
    if kind in ("Cf", "Mn", "Me") or c in "͏ᅟᅠㅤ️":
        return ""
    d = "".join(LOOK_ALIKES.get(x, x) for x in unicodedata.normalize("NFKD", c) if unicodedata.category(x) not in ("Mn", "Me", "Cf"))
    return d.casefold()


class _Table(dict):
    def __missing__(self, k: int) -> str:
        v = self[k] = _char(chr(k))
        return v


_TABLE = _Table()


def unmarked(text: str) -> str:
    """Without mark-up, character references, quote marks at line starts and hyphens at line ends."""
    if "<" in text:
        text = _TAG.sub(lambda m: "" if m.group()[1:2].islower() and len(m.group()) < 6 or m.group()[1:2] == "/" and m.group() not in ("</p>", "</li>", "</td>", "</h1>") else " ", text)
    if "&" in text:
        text = html.unescape(text)
    if ">" in text:
        text = _LINE.sub(" ", text)
    return _HYPHEN.sub("", text)


def worded(text: str) -> str:
    """Lower case plain letters, without invisible characters."""
    return text.lower() if text.isascii() else text.translate(_TABLE)


def plain(text: str) -> str:
    return worded(unmarked(text))


def joined(word: str) -> str:
    """The letters and digits of a piece without white space."""
    return "".join(_WORD.findall(worded(word)))
