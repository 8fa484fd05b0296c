"""Name and address cleansing as native column expressions.

Regular expressions run inside the JVM, so every operator built on them stays
in one generated stage instead of crossing into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms dropped from the end of a cleansed name.
COMPANY_SUFFIXES = ("llc", "inc", "corp", "ltd")

# Street words written out in full, and words that introduce a unit number.
STREET_WORDS = {"st": "street", "ave": "avenue"}
UNIT_WORDS = ("apt", "apartment", "suite")

# Accented letters and their plain forms, for optional folding.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"

_POSTAL = r"(\d{5}(?:-\d{3,4})?)\s*$"


def cleanse_name(name: Column, strip_suffixes: bool = False, fold_accents: bool = False) -> Column:
    """Lower case, runs of anything but a-z and 0-9 become one space; NULL gives ''.

    Letters outside ASCII count as separators unless ``fold_accents`` maps the
    common ones to their plain form first.
    """
    lowered = F.lower(F.coalesce(name, F.lit("")))
    if fold_accents:
        lowered = F.translate(lowered, ACCENTED, PLAIN)
    cleaned = F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " "))
    if strip_suffixes:
        cleaned = F.regexp_replace(cleaned, f"( ?\\b({'|'.join(COMPANY_SUFFIXES)}))+$", "")
    return cleaned


def normalize_address(address: Column) -> Column:
    """The same rule as for names."""
    return cleanse_name(address)


def standardize_address(address: Column) -> Column:
    """Normalised address with street words written out and unit numbers removed."""
    result = normalize_address(address)
    result = F.regexp_replace(result, f"\\b({'|'.join(UNIT_WORDS)}) [a-z0-9]+\\b", "")
    for short, full in STREET_WORDS.items():
        result = F.regexp_replace(result, f"\\b{short}\\b", full)
    return F.trim(F.regexp_replace(result, " +", " "))


def address_parts(address: Column) -> dict[str, Column]:
    """City, state and postal code of '<street>, <city>, <ST> <postal code>'.

    A part that is absent is NULL.
    """

    def group(pattern: str) -> Column:
        found = F.regexp_extract(address, pattern, 1)
        return F.when(found != "", found)

    tail = r"(?:\s+\d{5}(?:-\d{3,4})?)?\s*$"
    return {
        "city": group(r",\s*([^,]+?)\s*,\s*[A-Z]{2}" + tail),
        "state": group(r"(?:^|[,\s])([A-Z]{2})" + tail),
        "zip": group(_POSTAL),
    }


def list_size(text: Column, separator: str = ",") -> Column:
    """Number of entries in a delimited list; a blank list has none."""
    return F.when(F.length(F.trim(text)) == 0, 0).otherwise(F.size(F.split(text, separator))).cast("int")
