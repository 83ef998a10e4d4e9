"""The words of a text, the same for every way of writing them down."""

from __future__ import annotations

import html
import re
import sys
import unicodedata

TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>|<![A-Za-z][^<>]*>", re.S)
WORD = re.compile(r"[^\W_]+")
#: Characters that show nothing: formats, controls that are no white space, variation selectors and blank letters.
UNSEEN = {
    c: None
    for c in range(sys.maxunicode + 1)
    if unicodedata.category(chr(c)) == "Cf" or (unicodedata.category(chr(c)) == "Cc" and not chr(c).isspace()) or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF or c in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0)
}


def plain(text: str) -> str:
    """Without tags, entities, unseen characters and compatibility forms, in one case."""
    if "<" in text:
        text = TAG.sub("", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.translate(UNSEEN)).translate(UNSEEN).casefold()
        return unicodedata.normalize("NFKC", text)
    if not text.isprintable():
        text = text.translate(UNSEEN)
    return text.lower()


def words(text: str | None) -> list[str]:
    """Runs of letters and digits of a text; none of a null or blank one."""
    return WORD.findall(plain(text)) if text else []
