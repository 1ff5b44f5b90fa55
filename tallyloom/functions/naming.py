"""Column-name rules."""

from __future__ import annotations

import re


def snake_case(name: str) -> str:
    """Lower-case words of [a-z0-9] joined by single underscores; other characters vanish."""
    letters = re.sub(r"[^a-z0-9_\s]", "", name.lower())
    return "_".join(re.findall(r"[a-z0-9]+", letters))


def bare_name(name: str) -> str:
    """Letters and digits only: two names with the same bare form are the same column renamed."""
    return "".join(re.findall(r"[a-z0-9]", name.lower()))
