r"""RTF to plain text: a small, documented subset, one short text at a time.

Handled: groups, ``\par``/``\line``/``\tab`` and named signs, ``\'hh`` in the
declared code page, ``\uN`` with its ``\ucN`` substitutes, and destinations that
hold no body text (skipped, as is any group opened with ``\*``).
"""

from __future__ import annotations

import re

# Control words that stand for a character.
SIGNS = {
    "par": "\n", "sect": "\n\n", "page": "\n\n", "line": "\n", "tab": "\t", "row": "\n", "cell": "|",
    "emdash": "\u2014", "endash": "\u2013", "emspace": "\u2003", "enspace": "\u2002", "qmspace": "\u2005",
    "bullet": "\u2022", "lquote": "\u2018", "rquote": "\u2019", "ldblquote": "\u201c", "rdblquote": "\u201d",
}

# Control symbols that stand for a character.
SYMBOLS = {"~": "\xa0", "_": "\u2011", "-": "", "{": "{", "}": "}", "\\": "\\", "\n": "\n", "\r": "\n"}

# Destinations without body text.
SKIPPED = frozenset(
    "author category colortbl comment company creatim doccomm fonttbl footer footerf footerl footerr "
    "footnote ftncn ftnsep ftnsepc header headerf headerl headerr info keywords listoverridetable "
    "listtable manager operator pict pntext printim private revtim revtbl rsidtbl rxe stylesheet subject "
    "tc themedata title txe userprops xe xmlnstbl".split()
)

_PART = re.compile(
    r"\\([a-zA-Z]{1,32})(-?\d{1,10})? ?|\\'([0-9a-fA-F]{2})|\\([^a-zA-Z'])|([{}])|[\r\n]+|([^\\{}\r\n]+)"
)


def rtf_to_text(source: str) -> str:
    out: list[str] = []
    stack: list[tuple[bool, int]] = []
    skipping, substitutes, pending = False, 1, 0
    codepage, held = "cp1252", bytearray()
    for part in _PART.finditer(source):
        word, number, octet, symbol, brace, plain = part.groups()
        if octet and not skipping and not pending:
            held.append(int(octet, 16))  # one character may take several octets
            continue
        if held:
            out.append(held.decode(codepage, errors="replace"))
            held.clear()
        if brace == "{":
            stack.append((skipping, substitutes))
            pending = 0
        elif brace == "}":
            skipping, substitutes = stack.pop() if stack else (False, 1)
            pending = 0
        elif word == "bin":
            pending = 0
        elif word == "ansicpg" and number:
            codepage = _known_codepage(int(number))
        elif word in SKIPPED:
            skipping = True
        elif symbol == "*":
            skipping = True
        elif skipping:
            continue
        elif word == "uc" and number:
            substitutes = int(number)
        elif word == "u" and number:
            out.append(chr(int(number) % 65536))
            pending = substitutes
        elif octet:
            pending -= 1
        elif word in SIGNS:
            out.append(SIGNS[word])
        elif symbol:
            out.append(SYMBOLS.get(symbol, ""))
        elif plain:
            out.append(plain[pending:])
            pending = max(pending - len(plain), 0)
    if held:
        out.append(held.decode(codepage, errors="replace"))
    # \uN gives UTF-16 units, so signs beyond the first plane come in pairs.
    return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _known_codepage(number: int) -> str:
    name = "mac_roman" if number == 10000 else f"cp{number}"
    try:
        b"".decode(name)
    except LookupError:
        return "cp1252"
    return name
