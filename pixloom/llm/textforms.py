"""Character forms: what a reader sees as one text is brought to one string (pure Python, no Spark)."""

from __future__ import annotations

import re
import unicodedata

import regex

# Greek and Cyrillic letters drawn like a Latin letter (a subset of the public
# Unicode confusables data that covers letters only).
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "ρ": "p", "Ϲ": "C", "ϲ": "c", "ϳ": "j",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ғ": "F", "Ԍ": "G",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ӏ": "l", "к": "k",
}
#: Letters of the other scripts, by Latin letter, to repair a token whose own script is not Latin.
_BACK = {
    script: {latin: ch for ch, latin in reversed(LOOKALIKES.items()) if script in unicodedata.name(ch)}
    for script in ("GREEK", "CYRILLIC")
}
_FILLERS = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0}
_KEEP = ("<super>", "<sub>", "<fraction>", "<circle>", "<vertical>")


class _Folding(dict):
    """Code point to folded text, filled on demand."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        kind = unicodedata.category(ch)
        if ch.isspace():
            to = " "
        elif kind in ("Cf", "Cc") or code in _FILLERS or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            to = ""
        elif unicodedata.decomposition(ch).startswith(_KEEP):
            to = ch
        else:
            to = unicodedata.normalize("NFKC", ch)
            if to.startswith(" "):  # spacing accents would fall apart into a space and a mark
                to = ch
        self[code] = to
        return to


_FOLD = _Folding()


def fold(text: str) -> str:
    """Widths, ligatures and composed forms unified, invisible characters gone, each space a plain one.

    Case, accents, punctuation, raised and lowered digits and the number of spaces stay.
    """
    return unicodedata.normalize("NFC", text.translate(_FOLD))


def _script(ch: str) -> str | None:
    code = ord(ch)
    if code < 0x250 or 0x1E00 <= code <= 0x1EFF:
        return "LATIN" if ch.isalpha() and ch not in "ªº" else None
    if 0x370 <= code <= 0x3FF or 0x1F00 <= code <= 0x1FFF:
        return "GREEK"
    if 0x400 <= code <= 0x52F:
        return "CYRILLIC"
    return None


def scripts(token: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for ch in token:
        if s := _script(ch):
            found[s] = found.get(s, 0) + 1
    return found


def _rewrite(token: str, script: str) -> str | None:
    """The token wholly in ``script``, or None when a letter has no look-alike there."""
    out = []
    for ch in unicodedata.normalize("NFD", token):
        own = _script(ch)
        if own is None or own == script:
            out.append(ch)
            continue
        latin = ch if own == "LATIN" else LOOKALIKES.get(ch)
        to = latin if script == "LATIN" else _BACK[script].get(latin or "")
        if to is None:
            return None
        out.append(to)
    return unicodedata.normalize("NFC", "".join(out))


def repairs(token: str) -> list[str]:
    """Single-script readings of a token, its dominant script first; empty if there is nothing to repair.

    A token of one script has a second reading only when every letter of it is a look-alike.
    """
    found = scripts(token)
    if not found or found.keys() == {"LATIN"}:
        return []
    order = sorted(found, key=lambda s: (-found[s], s != "LATIN"))
    targets = order if len(order) > 1 else ["LATIN"]
    if "LATIN" not in targets:
        targets = [*targets, "LATIN"]
    seen = dict.fromkeys(_rewrite(token, s) for s in targets)
    return [r for r in seen if r is not None and r != token]


def is_word_char(ch: str) -> bool:
    return ch.isalnum() or unicodedata.category(ch)[0] == "M"


def _han(ch: str) -> bool:
    code = ord(ch)
    return 0x4E00 <= code <= 0x9FFF or 0x3400 <= code <= 0x4DBF or 0x20000 <= code <= 0x3FFFF or 0xF900 <= code <= 0xFAFF or ch in "々〇"


class _Classes(dict):
    """Code point to 'h' (Chinese character), 'w' (letter, digit or mark) or 's' (anything else)."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        self[code] = to = "h" if _han(ch) else "w" if is_word_char(ch) else "s"
        return to


_CLASS = _Classes()


def tokens(text: str) -> list[tuple[int, int]]:
    """Spans of maximal runs of letters, marks and digits outside Chinese characters."""
    spans, start = [], None
    for i, ch in enumerate(text):
        if _CLASS[ord(ch)] == "w":
            if start is None:
                start = i
        elif start is not None:
            spans.append((start, i))
            start = None
    if start is not None:
        spans.append((start, len(text)))
    return spans


def suspicious_tokens(text: str) -> list[str]:
    """Distinct tokens with a letter that is neither Latin nor without look-alikes."""
    found = (text[a:b] for a, b in tokens(text))
    return list(dict.fromkeys(t for t in found if not t.isascii() and scripts(t).keys() - {"LATIN"}))


def replace_tokens(text: str, by: dict[str, str]) -> str:
    out, last = [], 0
    for a, b in tokens(text):
        to = by.get(text[a:b])
        if to is not None:
            out += [text[last:a], to]
            last = b
    return unicodedata.normalize("NFC", "".join([*out, text[last:]])) if out else text


def skeleton(text: str) -> str:
    """``fold``, then every token read in Latin letters where it can be: for matching, not for output."""
    text = fold(text)
    if text.isascii():
        return text
    by = {}
    for t in suspicious_tokens(text):
        latin = _rewrite(t, "LATIN")
        if latin is not None:
            by[t] = latin
    return replace_tokens(text, by) if by else text


_PLAIN_WORDS = re.compile(r"[a-z0-9]+").findall
_ANY_WORDS = regex.compile(r"\p{Han}|[[\p{L}\p{M}\p{N}]--\p{Han}]+", regex.V1).findall
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1b\x7f]").search


def words(text: str) -> list[str]:
    """Words for matching: runs of letters and digits, each Chinese character alone, case and forms unified."""
    if text.isascii() and not _CONTROL(text):
        return _PLAIN_WORDS(text.lower())
    return _ANY_WORDS(skeleton(text).casefold())
