"""Names of tables and columns, quoted and unquoted."""

from __future__ import annotations

import re

_PIECE = r"""(?:"(?:[^"]|"")*"|`(?:[^`]|``)*`|[^"`])"""
#: Characters that a catalog takes in the name of a table; others are written as _x and their code in hex and _.
_PLAIN = re.compile(r"[A-Za-z0-9_]")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unquoted(text: str) -> str:
    text = text.strip()
    for q in "\"`":
        if len(text) > 1 and text[0] == text[-1] == q:
            return text[1:-1].replace(q + q, q)
    return text


def split(text: str, at: str) -> list[str]:
    """text cut at the character at, where it isn't inside quotes or parentheses."""
    out, depth = [""], 0
    for piece in re.findall(_PIECE, text, re.S):
        depth += (piece == "(") - (piece == ")")
        if piece == at and depth <= 0:
            out.append("")
        else:
            out[-1] += piece
    return out


def stored(name: str) -> str:
    """The catalog's name of a table, whatever characters the given name has; shown() turns it back."""
    safe = re.sub(r"_(?=x[0-9a-f]+_)", "_x5f_", name)
    return "".join(c if _PLAIN.match(c) else f"_x{ord(c):x}_" for c in safe)


def shown(name: str) -> str:
    return re.sub(r"_x([0-9a-f]+)_", lambda m: chr(int(m[1], 16)), name)


def table_parts(table: str, dbschema: str | None = None) -> list[str]:
    """[schema, table] or [table]: dbschema and table, or table split at its first dot outside quotes."""
    if dbschema:
        return [stored(unquoted(dbschema)), stored(unquoted(table))]
    first, *rest = split(table, ".")
    return [stored(unquoted(first)), stored(unquoted(".".join(rest)))] if rest else [stored(unquoted(first))]


def dotted(parts: list[str]) -> str:
    return ".".join(map(quoted, parts))
