"""Text rules as Column expressions. Comparison helpers ignore case and trailing blanks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_key(c: Column | str) -> Column:
    """Lower case without trailing blanks: the form in which text keys compare equal."""
    return F.lower(F.rtrim(_col(c)))


def text_len(c: Column | str) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(_col(c)))


def position_of(needle: str, c: Column | str) -> Column:
    """1-based position ignoring case, 0 if absent."""
    return F.locate(needle.lower(), F.lower(_col(c)))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def first_item(c: Column | str, sep: str = ",") -> Column:
    """Text before the first separator; the whole text where there is none."""
    return F.substring_index(_col(c), sep, 1)


def after_last(c: Column | str, sep: str) -> Column:
    return F.substring_index(_col(c), sep, -1)


def nth_item(c: Column | str, sep: str, n: int) -> Column:
    """The n-th item of a delimited list, NULL where it is missing or empty."""
    return F.nullif(F.try_element_at(F.split(_col(c), "\\Q" + sep + "\\E"), F.lit(n)), F.lit(""))


def number_after(c: Column | str, sep: str, n: int) -> Column:
    """The n-th item as a number, NULL where it is not one."""
    return nth_item(c, sep, n).try_cast("long")


def split_items(c: Column | str, sep: str) -> Column:
    """Items of a delimited list in their order."""
    return F.split(_col(c), "\\Q" + sep + "\\E")


def proper_case(c: Column | str) -> Column:
    """Keep the first character of the text and after each white space, lower the rest."""
    pieces = F.split(_col(c), "(?<=[ \\t\\r\\n\\u00a0])")
    return F.array_join(F.transform(pieces, lambda w: F.concat(F.substring(w, 1, 1), F.lower(F.substr(w, F.lit(2))))), "")


def strip_markup(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "<[^>]*>", "")


def classify_contains(c: Column | str, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first rule whose keyword occurs, ignoring case."""
    text = F.lower(_col(c))
    result = None
    for keyword, label in rules:
        hit = text.contains(keyword.lower())
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(F.lit(default))


def map_codes(c: Column | str, codes: Mapping[object, str], default: object = None) -> Column:
    """Label of a code, else the default. The mapping is one literal map, looked up per row."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(c)), F.lit(default))


def normalise_names(c: Column | str, aliases: Mapping[str, str], strip: Sequence[str] = ()) -> Column:
    """Replace known aliases (ignoring case and outer blanks), then drop the given suffixes."""
    trimmed = F.trim(_col(c))
    value = F.coalesce(map_codes(F.lower(trimmed), {k.lower(): v for k, v in aliases.items()}), trimmed) if aliases else trimmed
    for suffix in strip:
        value = F.regexp_replace(value, "(?i)\\s*\\Q" + suffix + "\\E$", "")
    return value


def message(parts: Sequence[tuple[str, Column | str]], sep: str = "; ") -> Column:
    """Labelled fragments joined into one text; a fragment whose value is NULL drops out."""
    return F.concat_ws(sep, *[F.concat(F.lit(label), _col(value).cast("string")) for label, value in parts])
