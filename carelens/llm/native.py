"""SQL text for word arrays and gram hashes, used by the operators that run without Python.

Arrays that a lambda reads are bound by `let`, so that Spark computes them once a row and not once an element.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(name: str, value: str, body: str) -> str:
    """body with `name` bound to value."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def ascii_lower(text: str) -> str:
    """A to Z lower-cased and nothing else; Spark's faster lower() does that where all characters are ASCII."""
    return (f"CASE WHEN octet_length({text}) = char_length({text}) THEN lower({text}) "
            f"ELSE translate({text}, '{UPPER}', '{LOWER}') END")


def words(text: str, separators: str) -> str:
    """The runs between separators (the inside of a regex class); null text has none."""
    return f"array_remove(split(coalesce({text}, ''), r'[{separators}]+'), '')"


def word_hashes(array: str) -> str:
    return f"transform({array}, w_ -> xxhash64(w_))"


def grams(hashes: str, k: int) -> str:
    """A hash of each k consecutive entries of the named array (empty where there are fewer)."""
    if k == 1:
        return hashes
    more = ", ".join(f"get({hashes}, i_ + {j})" for j in range(1, k))
    return f"transform(slice({hashes}, 1, greatest(size({hashes}) - {k - 1}, 0)), (x_, i_) -> xxhash64(x_, {more}))"


def window_minima(gram_hashes: str, w: int) -> str:
    """The distinct minima of each w consecutive gram hashes of the named array."""
    if w == 1:
        return f"array_distinct({gram_hashes})"
    more = ", ".join(f"get({gram_hashes}, i_ + {j})" for j in range(1, w))
    return (f"array_distinct(transform(slice({gram_hashes}, 1, greatest(size({gram_hashes}) - {w - 1}, 0)), "
            f"(x_, i_) -> least(x_, {more})))")
