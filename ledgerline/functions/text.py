"""Text standardisation: trimming, title case, remapping, sentinels, key slices."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space (tabs, NBSP, thin spaces, ...).
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# Spellings of states that differ from the standard one after
# trimming and title-casing.
STATE_NAMES = {
    "Uttar-Pradesh": "Uttar Pradesh",
    "Madhya_Pradesh": "Madhya Pradesh",
}

# Texts that stand for "no comment".
BLANK_TEXTS = ("nan", "", "None")

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_JOINT = "\u0001 "
_PLAIN_WORDS = r"\A[A-Za-z]+(?: [A-Za-z]+)*\z"


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not only the space character."""
    return F.btrim(c, F.lit(WHITESPACE))


def title_case(c: Column) -> Column:
    """Capital after *any* non-letter, so ``uttar-pradesh`` -> ``Uttar-Pradesh``.

    ``initcap`` only starts a word after a space, so a marker with a space is
    put before each word start and taken out again afterwards. Regexp, initcap
    and replace all stay in generated code.
    """
    marked = F.regexp_replace(c, rf"([^{_CASED}])(?=[{_CASED}])", f"$1{_JOINT}")
    titled = F.replace(F.initcap(marked), F.lit(_JOINT), F.lit(""))
    # For plain words, which are most, initcap alone does the same.
    return F.when(c.rlike(_PLAIN_WORDS), F.initcap(c)).otherwise(titled)


def remap(c: Column, mapping: Mapping[str, str]) -> Column:
    """Exact-match replacement; values without a mapping pass through."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], c) if pairs else c


def state_name(c: Column) -> Column:
    return remap(title_case(strip(c)), STATE_NAMES)


def blank_to_null(c: Column, blanks: Iterable[str] = BLANK_TEXTS) -> Column:
    """NULL for sentinel texts; the comparison is exact, as on trimmed text."""
    return F.when(~c.isin(*blanks), c)


def has_text(c: Column) -> Column:
    return c.isNotNull() & (F.length(strip(c)) > 0)


def key_from_code(c: Column, prefix: str = "C0", skip: int = 4, min_length: int = 6) -> Column:
    """Derive a key from the tail of a code (``ED1005`` -> ``C005``); short codes stay."""
    return F.when(
        F.length(c) >= min_length, F.concat(F.lit(prefix), F.substr(c, F.lit(skip + 1)))
    ).otherwise(c)
