"""Cutting texts at single spaces where byte-level BPE cuts them too.

The public pattern starts a new match at every single space between two
characters that are not white space, so the parts of a text between such
spaces are encoded independently.  Equal parts are encoded once per batch.
"""

from __future__ import annotations


def split_chunks(text: str) -> list[str]:
    """Parts whose join by single spaces is ``text``; every cut is a place
    where the pattern cuts.  All but the first go with a leading space."""
    parts = text.split(" ")
    if all(parts) and not any(p[0].isspace() or p[-1].isspace() for p in parts):
        return parts
    out = [parts[0]]
    for part in parts[1:]:
        last = out[-1]
        # isspace() holds for all of the pattern's white space and a little
        # more; a cut left out is harmless
        if last and part and not last[-1].isspace() and not part[0].isspace():
            out.append(part)
        else:
            out[-1] = f"{last} {part}"
    return out
