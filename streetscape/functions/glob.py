"""Shell-style (fnmatch, case-sensitive) patterns as anchored Java regular expressions.

The translation runs once per pattern on the driver; matching runs in ``rlike`` on executors.
Supported: ``*`` (any run, also empty), ``?`` (one character), ``[...]`` and ``[!...]`` classes.
Everything else matches itself.
"""

from __future__ import annotations

_REGEX_SPECIAL = set("\\.^$|?*+()[]{}")


def _escape(ch: str) -> str:
    return "\\" + ch if ch in _REGEX_SPECIAL else ch


def glob_to_regex(pattern: str) -> str:
    out: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        i += 1
        if ch == "*":
            # Collapse runs of stars; they mean the same thing.
            while i < n and pattern[i] == "*":
                i += 1
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                # No closing bracket: a literal '['.
                out.append("\\[")
                continue
            body = pattern[i:j]
            i = j + 1
            negate = body.startswith("!")
            if negate:
                body = body[1:]
            # Inside a Java class only these need escaping.
            body = body.replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&")
            if body.startswith("^") and not negate:
                body = "\\" + body
            out.append("[" + ("^" if negate else "") + body + "]")
        else:
            out.append(_escape(ch))
    return "^(?s:" + "".join(out) + ")$"
