"""Column expressions over text, all evaluated by Spark itself.

Character classes are spelled out so that whitespace, digits and uppercase mean
the full Unicode properties, whatever the regex engine's defaults are.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode character classes, as the inside of a regex bracket. ``(?U)`` makes
# ``\s`` the Unicode property; the four separators after it count as whitespace too.
UNICODE = r"(?U)"
WHITESPACE = r"\s\x1C-\x1F"
ALPHANUMERIC = r"\p{L}\p{N}"
DIGIT = (
    r"\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
UPPERCASE = r"\p{IsUppercase}"
URL = UNICODE + r"http[s]?://[^" + WHITESPACE + "]+"


def _chars_outside(text: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(text, f"{UNICODE}[{char_class}]+", ""))


def _chars_inside(text: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(text, f"{UNICODE}[^{char_class}]+", ""))


def words(text: Column) -> Column:
    """Whitespace-separated words; the empty array for blank text."""
    return F.array_remove(F.split(text, f"{UNICODE}[{WHITESPACE}]+"), "")


def lines(text: Column) -> Column:
    """Lines separated by a newline alone; blank lines count."""
    return F.split(text, "\n", -1)


def total_length(tokens: Column) -> Column:
    return F.length(F.array_join(tokens, ""))


def symbol_chars(text: Column) -> Column:
    """Characters that are neither letters, numbers nor whitespace."""
    return _chars_outside(text, ALPHANUMERIC + WHITESPACE)


def digit_chars(text: Column) -> Column:
    # Most characters are settled by the first range; the long class is only asked beyond ASCII.
    return F.regexp_count(text, F.lit(rf"{UNICODE}[0-9[\x{{B2}}-\x{{10FFFF}}&&[{DIGIT}]]]"))


def uppercase_chars(text: Column) -> Column:
    return _chars_inside(text, UPPERCASE)


def url_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(URL))


def contains_any(text: Column, needles: list[str] | tuple[str, ...]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(text, F.lit(needle))
    return found


def word_ngrams(tokens: Column, n: int) -> Column:
    """Every run of ``n`` consecutive tokens joined by a space, in order, with repeats.

    The array is zipped with itself moved along, so ``tokens`` is evaluated a fixed number of
    times per row, however Catalyst inlines it, and not once per run.
    """
    runs = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    grams = F.slice(tokens, F.lit(1), runs)
    for offset in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, F.lit(offset + 1), runs), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def content_hash(text: Column, hash_type: str = "md5") -> Column:
    raw = F.encode(text, "UTF-8")
    if hash_type == "md5":
        return F.md5(raw)
    if hash_type == "sha256":
        return F.sha2(raw, 256)
    if hash_type == "xxhash":
        return F.lpad(F.lower(F.hex(F.xxhash64(raw))), 16, "0")
    raise ValueError(f"unknown hash type: {hash_type!r}; use md5, sha256 or xxhash")
