"""Column names for flattened semi-structured paths (driver side, plan time)."""

from __future__ import annotations

import re

# Fixed patterns for name normalisation (must equal the reference's):
#   remove every double quote
#   "[<index>]" followed by an optional "_"  ->  "_<index>" and the "_"
#   any character outside A-Z a-z 0-9 _ ,    ->  "_"
# Ours additionally maps "," to "_" so the name is a plain identifier.
_INDEX = re.compile(r"\[(.+?)\](_?)")
_OTHER = re.compile(r"[^A-Za-z0-9_,]")


def normalise_name(path: str) -> str:
    """``leg[2]_cabinClass`` -> ``leg_2_cabinClass``; ``ship to.cust`` -> ``ship_to_cust``."""
    s = path.replace('"', "")
    s = _INDEX.sub(lambda m: "_" + m.group(1) + m.group(2), s).strip()
    s = _OTHER.sub("_", s)
    return s.replace(",", "_")


def unique_names(names: list[str]) -> list[str]:
    """Suffix ``_2``, ``_3`` ... on case-insensitive collisions (``a.b`` against ``a_b``)."""
    seen: dict[str, int] = {}
    taken = {n.lower() for n in names}
    out = []
    for n in names:
        key = n.lower()
        if key not in seen:
            seen[key] = 1
            out.append(n)
            continue
        k = seen[key]
        while True:
            k += 1
            cand = f"{n}_{k}"
            if cand.lower() not in taken:
                break
        seen[key] = k
        taken.add(cand.lower())
        out.append(cand)
    return out


def variant_path(steps: list[str], index: int | None = None) -> str:
    """JSON path for ``try_variant_get``: ``$["a"]["b c"][0]``.

    Every step is bracket-quoted, so names with spaces, dots or brackets are safe.
    """
    parts = ["$"]
    for s in steps:
        parts.append('["' + s.replace("\\", "\\\\").replace('"', '\\"') + '"]')
    if index is not None:
        parts.append(f"[{index}]")
    return "".join(parts)


def display_path(steps: list[str], index: int | None = None) -> str:
    """The path as the reference spells it before normalising: ``"a"."b"[0]``."""
    s = ".".join(f'"{p}"' for p in steps)
    return s if index is None else f"{s}[{index}]"
