"""Column-name rules. They run on the driver, on names only."""

from __future__ import annotations

import re
from collections.abc import Iterable


def _tidy_name(name: str, to_underscore: str) -> str:
    text = re.sub(f"[{re.escape(to_underscore)}]", "_", name.strip().lower())
    return re.sub(r"_{2,}", "_", "".join(re.findall(r"\w", text)))


def snake_case(name: str) -> str:
    """``Shares/Par Value`` -> ``shares_par_value``; a leading underscore stays."""
    return _tidy_name(name, " /-.")


def plain_snake_case(name: str) -> str:
    """As :func:`snake_case`, but ``/`` and ``.`` vanish: ``sharespar_value``."""
    return _tidy_name(name, " -")


def require_unique(names: Iterable[str]) -> None:
    seen: dict[str, int] = {}
    for n in names:
        seen[n] = seen.get(n, 0) + 1
    clash = sorted(n for n, count in seen.items() if count > 1)
    if clash:
        raise ValueError(f"columns clash after renaming: {clash}")
