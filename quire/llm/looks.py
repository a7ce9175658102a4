"""Looks of short strings in Python, by the tables that problem 3 uses in SQL."""

from __future__ import annotations

import re
import unicodedata

from quire.llm.forms import ALIKE_FROM, ALIKE_TO, COMPOSED_FROM, COMPOSED_TO, INVISIBLE, same_forms

FORM = {ord(k): v for k, v in same_forms().items()}
SHAPE = {ord(k): v for k, v in zip(COMPOSED_FROM + ALIKE_FROM, COMPOSED_TO + ALIKE_TO, strict=True)}
INVISIBLE_MARKS = re.compile("[" + "".join(sorted(INVISIBLE)) + "]")
#: Anything but characters that have one form only.
ODD = re.compile("[^ -~\nЀ-џ–—«»„“”’äöüßÄÖÜàâçéèêëîïôùûœÀÉÈÊ]")
CYRILLIC, LATIN = re.compile("[Ѐ-ԯ]"), re.compile("[A-Za-zÀ-ɏ]")
TO_CYRILLIC = {ord(v): k for k, v in zip(ALIKE_FROM, ALIKE_TO) if "Ѐ" <= k <= "ӿ" and k not in "ЅЈѕјԁԛԝӏһ"}
TO_LATIN = {ord(k): v for k, v in zip(ALIKE_FROM, ALIKE_TO)}
_ONE_BYTE = [(c, bytes(b for b in range(256) if not ODD.search(bytes([b]).decode(c, "ignore") or "\t"))) for c in ("cp1251", "cp1252")]


def odd(text: str) -> bool:
    """Whether ODD is in a text; quick for texts of one alphabet, which most are."""
    for code, usual in _ONE_BYTE:
        try:
            return bool(text.encode(code).translate(None, usual))
        except UnicodeEncodeError:
            pass
    return ODD.search(text) is not None


def one_form(text: str) -> str:
    """Forms, widths, compositions, blanks and invisible marks in one way; letters stay in their script."""
    return unicodedata.normalize("NFC", text.translate(FORM)).replace("\r\n", "\n") if odd(text) else text


def skeleton(text: str) -> str:
    """Equal for texts that look the same."""
    return unicodedata.normalize("NFC", one_form(text).translate(SHAPE))


def settled(word: str) -> str:
    """A word with look-alike letters put into its script."""
    if CYRILLIC.search(word) and LATIN.search(word):
        latin = word.translate(TO_LATIN)
        return word.translate(TO_CYRILLIC) if CYRILLIC.search(latin) else latin
    return word
