"""Regex dialect adaptation.

Rules are authored with Python ``re`` semantics, where ``\\s``, ``\\w``, ``\\d`` and case folding are Unicode-aware.
Java's classes are ASCII unless ``(?U)`` is set, and under ``(?U)`` Java's ``\\w`` also takes combining marks, which
Python's does not. So a rule is run in Spark as ``(?U)`` + the rule with ``\\w`` spelled ``[\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

WORD_CLASS = r"[\p{L}\p{N}_]"


def java_regex(pattern: str, ignore_case: bool = False, unicode: bool = True) -> str:
    """Return ``pattern`` with Python-compatible Unicode semantics for ``rlike``/``regexp_*``."""
    out = []
    i = 0
    in_class = False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt == "w" and unicode:
                out.append(r"\p{L}\p{N}_" if in_class else WORD_CLASS)
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    flags = ("i" if ignore_case else "") + ("U" if unicode else "")
    return (f"(?{flags})" if flags else "") + "".join(out)
