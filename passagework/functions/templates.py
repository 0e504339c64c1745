"""Prompt templates: text with ``{name}`` placeholders rendered from columns.

A template is cut once into literals and names and rendered as a single ``concat``, so a placeholder
that occurs inside a value is never replaced, and braces in values are plain text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLACEHOLDER = re.compile(r"\{\{|\}\}|\{([A-Za-z_][A-Za-z0-9_]*)\}|[{}]")


def cut(template: str) -> list[tuple[str, str]]:
    """Pieces of a template as ``("text", s)`` or ``("name", s)``; doubled braces are literal ones."""
    pieces: list[tuple[str, str]] = []
    text, at = "", 0
    for m in _PLACEHOLDER.finditer(template):
        text += template[at : m.start()]
        at = m.end()
        if m.group(1):
            pieces += [("text", text), ("name", m.group(1))]
            text = ""
        elif len(m.group()) == 2:
            text += m.group()[0]
        else:
            raise ValueError(f"single brace at position {m.start()} of the template")
    pieces.append(("text", text + template[at:]))
    return [p for p in pieces if p[1]]


def placeholders(template: str) -> list[str]:
    """Names in order of first use."""
    return list(dict.fromkeys(name for kind, name in cut(template) if kind == "name"))


def render(template: str, values: Mapping[str, Column], declared: Sequence[str] | None = None) -> Column:
    """Fill the placeholders with columns; a null value makes the prompt null.

    Every placeholder needs a value and every value a placeholder; ``declared`` names, if given, must
    be exactly the template's placeholders.
    """
    names = placeholders(template)
    for what, given in (("values", set(values)), ("declared names", set(declared or names))):
        if given != set(names):
            raise ValueError(f"{what} {sorted(given)} do not match placeholders {sorted(names)}")
    parts = [values[s] if kind == "name" else F.lit(s) for kind, s in cut(template)]
    return F.concat(*parts) if parts else F.lit("")
