r"""Text masking and cleaning.

The word and space classes are spelled out instead of using ``\w``, ``\s`` and ``\b``
so that the result does not depend on the Java version: words are letters, numbers and
underscore of any script, spaces are Unicode white space plus the four separators
U+001C..U+001F.

Every mask is guarded by a byte search for a literal that any match must contain.  Most
reviews hold no ``@`` and no ``://``, so the regex engine never starts on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f"  # inside (?U)
_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

# --- fixed values: what is masked and the marks put in place -----------------------------
URL = rf"(?iuU)(?=[hw])(?<![{WORD}])(?:https?://|www\.)[^{SPACE}]+{_EDGE}"
EMAIL = rf"{_EDGE}[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}(?![{WORD}])"
PHONE = rf"(?U)\+?\d[\d{SPACE}().-]{{7,}}\d"
_CUES = ["my name is", "i am", "i'm"]
_CAPITALISED = r"[A-Z][A-Za-z]+"
URL_MARK = "[URL]"
EMAIL_MARK = "[EMAIL]"
PHONE_MARK = "[PHONE]"
NAME_MARK = "[NAME]"
MARKS = {"url": URL_MARK, "email": EMAIL_MARK, "phone": PHONE_MARK, "name": NAME_MARK}


def _name_pattern(any_case: bool) -> str:
    cue = "|".join(_CUES)
    group = f"((?i:{cue}))" if any_case else f"({cue})"
    return (
        rf"(?U)(?<![{WORD}]){group}[{SPACE}]+{_CAPITALISED}"
        rf"(?:[{SPACE}]+{_CAPITALISED})?(?![{WORD}])"
    )


def _contains_any(column: Column, literals: list[str]) -> Column:
    found = F.contains(column, F.lit(literals[0]))
    for literal in literals[1:]:
        found = found | F.contains(column, F.lit(literal))
    return found


def masked_text(column: Column, any_case_names: bool = False) -> Column:
    """Null becomes empty; then web addresses, e-mails, phone-like numbers and self-introductions
    are replaced by marks, in that order."""
    raw = F.coalesce(column.cast("string"), F.lit(""))
    # No mark contains what a guard looks for, so every guard can look at the raw text.
    has_url = _contains_any(raw, ["://"]) | F.contains(F.lower(raw), F.lit("www."))
    has_email = _contains_any(raw, ["@"])
    has_cue = _contains_any(F.lower(raw) if any_case_names else raw, _CUES)

    text = F.when(has_url, F.regexp_replace(raw, URL, URL_MARK)).otherwise(raw)
    text = F.when(has_email, F.regexp_replace(text, EMAIL, EMAIL_MARK)).otherwise(text)
    text = F.regexp_replace(text, PHONE, PHONE_MARK)
    named = F.regexp_replace(text, _name_pattern(any_case_names), f"$1 {NAME_MARK}")
    return F.when(has_cue, named).otherwise(text)


def squeeze_spaces(column: Column) -> Column:
    """Every run of white space becomes one blank; ends trimmed.  Single blanks are left alone
    by the pattern, so ordinary text is copied in large pieces."""
    return F.trim(F.regexp_replace(column, rf"(?U)[{SPACE}]{{2,}}|[{SPACE}&&[^\x20]]", " "))


def clean_text(column: Column, any_case_names: bool = False) -> Column:
    return squeeze_spaces(masked_text(column, any_case_names))


def has_content(column: Column) -> Column:
    """True where cleaning leaves something.  Marks are never empty, so looking for one non-space
    character in the raw text gives the same answer as cleaning first, without running the masks
    a second time in the filter."""
    return F.coalesce(column.cast("string").rlike(rf"(?U)[^{SPACE}]"), F.lit(False))
