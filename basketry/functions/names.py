"""Text of product names. (?U) gives the classes their Unicode meaning, so accented names stay whole."""

from pyspark.sql import Column, functions as F

from basketry.functions.clean import _col

# Patterns removed from a lower-case product name, applied in this order.
MEASURE_PATTERNS = [
    r"\b\d+\.\d+\s*(gm|ml|kg|mg|oz|lbs?|pcs?|pieces?|g)\b",
    r"\b\d+\s*(gm|ml|kg|mg|oz|lbs?|pcs?|pieces?|g)\b",
    r"\b\d+\s*(ml|mg|g|gm|kg|oz|lbs?|pcs?|pieces?|pack|box|can|bottle|packet)\b",
    r"\b\d+(\.\d+)?\s*x\s*\d+(\.\d+)?\s*(ml|mg|g|gm|kg|oz|lbs?|pcs?)\b",
    r"\b(small|medium|large|xl|xs|s|m|l)\b",
    r"\b\d+s?\b",
    r"\b\d+[sS]\b",
    r"\b\d+(\.\d+)?\b",
]
TOKEN_PATTERN = r"\b[a-zA-Z][a-zA-Z]+\b"
# End of fixed values.


def strip_space(c) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def normalise_name(c) -> Column:
    text = F.translate(F.lower(_col(c)), "-™®", " ")
    return strip_space(F.replace(text, F.lit("&"), F.lit("and")))


def preprocess_product_name(c) -> Column:
    """Lower-case name without measures, sizes, numbers and punctuation; '' for a null name."""
    text = F.lower(F.coalesce(_col(c), F.lit("")))
    for pattern in MEASURE_PATTERNS:
        text = F.regexp_replace(text, "(?U)" + pattern, "")
    text = F.regexp_replace(text, r"(?U)\bcigarettes\b", "cigarette")
    text = F.regexp_replace(text, r"(?U)[^\w\s]", " ")
    return strip_space(F.regexp_replace(text, r"(?U)\s+", " "))


def name_tokens(c) -> Column:
    """Lower-case alphabetic tokens of two letters or more, in order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit("(?U)" + TOKEN_PATTERN), F.lit(0))


def sorted_tokens(c) -> Column:
    """White-space tokens of a name, sorted and joined again."""
    return F.array_join(F.array_sort(F.split(strip_space(c), r"(?U)\s+")), " ")
