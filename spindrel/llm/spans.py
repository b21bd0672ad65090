"""Spans of personal data and of credentials: the fixed patterns, in linear time."""

from __future__ import annotations

import hashlib
import re

PII_KINDS = ("email", "ip", "card", "phone", "term")
SECRET_KINDS = ("assign", "access", "hex", "live")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
# a match never starts inside a run of digits whose start fails, so the look-behind changes nothing
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")


def emails(text: str) -> list[tuple[int, int]]:
    out, at, end = [], text.find("@"), 0
    while at >= 0:
        s = at
        while s > end and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)  # what stands before a failed @ can't reach a later one
        at = text.find("@", end)
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def personal(text: str) -> list[tuple[int, int, int]]:
    """(start, number in PII_KINDS, end) in order, in code points."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m.groups()))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


def credentials(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number in SECRET_KINDS, end, secret value) in order, in code points."""
    out = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(out)


def joined(spans, kinds) -> str:
    return ",".join(f"{kinds[s[1]]}:{s[0]}:{s[2]}" for s in spans)


def digest(spans, kinds) -> str:
    return hashlib.sha256(joined(spans, kinds).encode()).hexdigest()
