"""String helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-width punctuation and its plain form.
WIDE_PUNCTUATION = "（），。：；－／．　"
PLAIN_PUNCTUATION = "(),.:;-/. "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def left(c: Column | str, n: int) -> Column:
    return F.left(_col(c), F.lit(n))


def right(c: Column | str, n: int) -> Column:
    return F.right(_col(c), F.lit(n))


def mid(c: Column | str, start: int, n: int) -> Column:
    """`n` characters from a 1-based start."""
    return F.substring(_col(c), start, n)


def replace_all(c: Column | str, pairs: Mapping[str, str]) -> Column:
    """Literal replacements, applied in the order given."""
    out = _col(c)
    for old, new in pairs.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def byte_length(c: Column | str) -> Column:
    """Length in bytes: a Chinese character counts three."""
    return F.octet_length(_col(c))


def strip_leading_zeros(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^0+", "")


def between_markers(c: Column | str, start: str, end: str) -> Column:
    """The text after the last `start` and before the next `end`."""
    return F.substring_index(F.substring_index(_col(c), start, -1), end, 1)


def canonical_number(c: Column | str, drop: tuple[str, ...] = (" ", ":", "CN", "ZL")) -> Column:
    """A document number without blanks, country prefix and check digit (after the dot)."""
    return F.substring_index(replace_all(c, dict.fromkeys(drop, "")), ".", 1)


def fold_punctuation(c: Column | str) -> Column:
    return F.translate(_col(c), WIDE_PUNCTUATION, PLAIN_PUNCTUATION)


def drop_zero_cents(c: Column | str) -> Column:
    return F.regexp_replace(_col(c).cast("string"), r"\.00$", "")


def first_item(c: Column | str, sep: str = ",") -> Column:
    return F.split_part(_col(c), F.lit(sep), F.lit(1))


def fold_key(c: Column | str) -> Column:
    """A key compared without regard to case and outer blanks."""
    return F.lower(F.trim(_col(c)))


def map_code(c: Column | str, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Translate codes; codes outside the mapping become `default` (the code itself if omitted)."""
    source = _col(c)
    out = None
    for code, name in mapping.items():
        hit = source == F.lit(code)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(source if default is None else default)


def first_value_of(*cols: Column | str, blank_is_null: bool = False) -> Column:
    """First non-null column, or first non-blank one."""
    values = [_col(c) for c in cols]
    if blank_is_null:
        values = [F.when(F.trim(v.cast("string")) != "", v) for v in values]
    return F.coalesce(*values)


def changed(a: Column | str, b: Column | str) -> Column:
    """Inequality where null counts as blank; never null itself."""
    return F.coalesce(_col(a).cast("string"), F.lit("")) != F.coalesce(_col(b).cast("string"), F.lit(""))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(F.trim(_col(c).cast("string")), F.lit("")) == ""


def starts_with_column(c: Column | str, prefix: Column | str, sep: str = "") -> Column:
    """LIKE with a pattern built from another column, taken literally."""
    return F.startswith(_col(c), F.concat(_col(prefix), F.lit(sep)))


def list_length(c: Column | str, sep: str = ",") -> Column:
    """Entries of a delimited list; null stays null."""
    return F.when(_col(c).isNotNull(), F.size(F.split(_col(c), _quoted(sep))))


def _quoted(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def split_list(c: Column | str, sep: str = ",") -> Column:
    """Trimmed, non-blank entries of a delimited list."""
    entries = F.transform(F.split(_col(c), _quoted(sep)), lambda x: F.trim(x))
    return F.filter(entries, lambda x: x != "")


def tuple_field(c: Column | str, position: int, group: int = 1,
                group_sep: str = ",", field_sep: str = "|") -> Column:
    """One field of one group in `a|b|c,d|e|f` text; both positions are 1-based."""
    one_group = F.split_part(_col(c), F.lit(group_sep), F.lit(group))
    return F.split_part(one_group, F.lit(field_sep), F.lit(position))
