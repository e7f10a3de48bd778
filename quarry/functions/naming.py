"""Column naming rules of the text readers."""

from __future__ import annotations

# Fixed naming formats: generated names for header-less input, and the
# suffix given to repeated header names.
NO_HEADER_FORMAT = "column_{}"
DUPLICATE_FORMAT = "{}_duplicated_{}"


def generated_names(n: int) -> list[str]:
    """``column_1 .. column_n`` for input without a header."""
    return [NO_HEADER_FORMAT.format(i + 1) for i in range(n)]


def header_names(raw) -> list[str]:
    """Names from a header row: empty names become ``column_<i>`` (1-based),
    repeats become ``<name>_duplicated_<k>`` with k counting from 0."""
    names = []
    used = set()
    repeats: dict[str, int] = {}
    for i, name in enumerate(raw):
        name = "" if name is None else str(name)
        if name == "":
            name = NO_HEADER_FORMAT.format(i + 1)
        if name in used:
            base = name
            while True:
                k = repeats.get(base, 0)
                repeats[base] = k + 1
                name = DUPLICATE_FORMAT.format(base, k)
                if name not in used:
                    break
        used.add(name)
        names.append(name)
    return names
