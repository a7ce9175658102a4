"""Fixed values of the reference: patterns, ranges, word lists and thresholds, plainly."""

from __future__ import annotations

#: White space as Unicode has it.
WS = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

URL = r"https?://[^\s]+"
ISBN = r"\bISBN\s*\d{3}-\d{1,5}-\d{1,7}-\d{1,7}-\d{1,7}\b"
UDK = r"\bУДК\s*\d+(?:\.\d+)+\b"
BBK = r"\bББК\s*\d+(?:\.\d+)+\b"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
GARBAGE = {"isbn": ISBN, "udk": UDK, "bbk": BBK, "url": URL, "email": EMAIL}
#: What a text with each of them holds, which is quick to see.
SIGNS_OF = {"isbn": "ISBN", "udk": "УДК", "bbk": "ББК", "url": "://", "email": "@"}
SHORT_GARBAGE = (r"^[\s\[\]\(\)\{\}\d\.\,\;\-]+$", r"^[\[\(]\d+[\]\)]\.?\s*$", r"^[Сс]\.\s*\d+\.?\s*$")
LIST_MARKER = r"^\s*[•\-*•\d]+[\.\)]\s+"
INDEX_LINE = r"[,\s]+\d+[\s,]*$"  # whatever comes before
SPACED = r"\b\w( \w){4,}\b"
SPACED_START = r"^[А-ЯЁ]\s+[а-яё]\s+[а-яё]"
MIXED_WORD = r"\b[а-яё]+[a-z]+[а-яё]*\b"
NO_LETTERS_RUN = r"[^а-яё\s]{5,}"
HYPHENATED = r"\p{L}+-\s*\n\s*\p{L}+"
RUSSIAN, ENGLISH = r"[\x{400}-\x{4FF}]", r"[A-Za-z]"
CYRILLIC_LETTER, LATIN_LETTER = r"[А-яЁё]", r"[A-Za-z]"
GREEK, MATH = r"[\x{370}-\x{3FF}\x{1F00}-\x{1FFF}]", r"[\x{2200}-\x{22FF}]"
#: Words that no sentence ends on.
OPEN_ENDINGS = (
    "в на с по к у о об от до без для из за над под при про через между перед и а но или либо что чтобы если когда "
    "in on at by for with to from of and or but"
).split()
ENDING_SIGNS = r"""[.,;:!?()\[\]{}"']+$"""

#: The code-point scrubber: blanks, what is deleted, ligatures.
SCRUB_BLANKS = r"[\x{a0}\x{2007}\x{202f}\x{205f}\x{3000}\x{1680}]"
SCRUB_DELETED = (
    r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}\x{fffc}\x{fffd}"
    r"\x{202a}-\x{202e}\x{2066}-\x{206f}\x{7f}-\x{9f}\x{e000}-\x{f8ff}\x{f0000}-\x{fffff}\x{100000}-\x{10ffff}]"
)
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ĳ": "ij"}

#: The cleaner of chunk texts; U+2060 and U+FEFF become blanks here.
CHUNK_BLANKS = r"[\x{a0}\x{2000}-\x{200a}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
CHUNK_DELETED = r"[\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}-\x{200d}\x{202a}-\x{202e}\x{2061}-\x{2064}\x{2066}-\x{206f}]"
CHUNK_DASHES = r"[\x{2013}\x{2014}\x{2015}\x{2212}]"
CHUNK_CONTROLS = r"[\x{0}-\x{1f}\x{7f}-\x{9f}\x{e000}-\x{f8ff}]"

#: Ranges of Chinese, Japanese, Korean and Thai characters.
CJK_THAI = (
    r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2b73f}\x{2b740}-\x{2b81f}\x{2b820}-\x{2ceaf}\x{2ceb0}-\x{2ebef}"
    r"\x{30000}-\x{3134f}\x{31350}-\x{323af}\x{2e80}-\x{2eff}\x{2f00}-\x{2fdf}\x{2ff0}-\x{2fff}\x{3000}-\x{303f}\x{31c0}-\x{31ef}"
    r"\x{3200}-\x{32ff}\x{3300}-\x{33ff}\x{f900}-\x{faff}\x{fe30}-\x{fe4f}\x{e00}-\x{e7f}]"
)
NOT_ACCEPTABLE = r"[^\t\n\r\x{20}-\x{7e}\x{400}-\x{52f}\x{2e00}-\x{2e7f}—–…]"

#: Cleaning of whole texts, in order: pattern and what takes its place.
TEXT_STEPS = (
    (r"[\x{a0}\x{2007}\x{202f}]", " "),
    (r"\r\n?", "\n"),
    (r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}]", ""),
    (r"(\p{L}+)-\s*\n\s*(\p{L}+)", "$1-$2"),
    (r"(?m)^.*\b(?:ISBN|УДК|ББК|ISSN|DOI)\b.*$", ""),
    (r"(?m)^\s*\d+\.?\s*$", ""),
    (r"(?m)^\s*\d+\s*$", ""),
    (r"""(?m)^\s*\d+[~'`"]?\s*$""", ""),
    (r"(?m)^[\*\-\=]{3,}$", ""),
    (r"([А-Яа-яЁё])(\d+)(?:\s|$)", "$1"),
)
BIBLIOGRAPHIC = (r"[А-ЯЁ]\s+[ѴІ]\.\s*[А-ЯЁ]?\d+", r"[А-ЯЁ]{2,3}\s+[А-ЯЁ]?\.\d+", r"[А-ЯЁ]\.\s*\d+\.\d+")
SYMBOLS = r"[▲►▼◄■□▪▫●○◦★☆♦✓✗→←↑↓]"
RULE_LINE = r"(?m)^[=\-*_]{10,}$"
BEFORE_SIGN = r"\s+([.,!?;:])"
WORD_XML = (r"</?w:[^>]+/?>", r"<w:[^\s>]*", r"""\bw:[a-z]+="[^"]*\"""", r"\s*/?>")
