"""Text normalisers as column expressions (F01, F02, F06, F07, F24, F27, R01, R02, R07, R28, J01 keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() sees it.
SPACE = r"(?U)[\s\x1C-\x1F]"

#: Cell values that stand for nothing (fixed values).
NULL_PATTERNS = (r"^<*[Nn][Uu][Ll][Ll]>*$", r"^#*[Nn]/?[Aa]$", r"^\?*$", r"^-+$")

#: A plain check of a web address: scheme, host with a dot or localhost, optional port and rest.
URL_PATTERN = r"^(?i)(https?|ftps?|ssh|sftp|git)://([^\s/@:?#]+(:[^\s/@?#]*)?@)?(([a-z0-9¡-￿]([a-z0-9¡-￿_-]*[a-z0-9¡-￿])?\.)+[a-z¡-￿]{2,63}\.?|localhost|[0-9]{1,3}(\.[0-9]{1,3}){3}|\[[0-9a-f:.]+\])(:[0-9]{2,5})?([/?#]\S*)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, function) -> Column:
    """``function`` of a value that is computed once, however often the function uses it."""
    return F.transform(F.array(value), function)[0]


def _ends_plain(c: Column) -> Column:
    """Whether a text begins and ends with printable ASCII, so that there is nothing to strip; cheaper than a pattern."""
    return F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)


def strip(c: Column | str) -> Column:
    value = col(c)
    return F.when(_ends_plain(value), value).otherwise(F.regexp_replace(value, rf"{SPACE[:4]}^{SPACE[4:]}+|{SPACE[4:]}+$", ""))


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(col(c), SPACE + "+", " "))


def _unquote(c: Column) -> Column:
    return F.translate(c, '"”', "")


def normalise_string(c: Column | str) -> Column:
    """collapse white space, drop double quotes."""
    return _unquote(squeeze(c))


def normalise_address(c: Column | str) -> Column:
    """lines and semicolons become commas, runs of commas one, no space around hyphens, no double quotes."""
    value = F.translate(F.regexp_replace(col(c), "\n", ", "), ";", ",")
    value = F.regexp_replace(squeeze(value), " ?,[ ,]*", ", ")
    value = F.regexp_replace(value, "^[, ]+|[, ]+$", "")
    value = F.regexp_replace(value, " ?-[ -]*", "-")
    return _unquote(squeeze(value))


def normalise_flag(c: Column | str) -> Column:
    """yes, no or '' where the value is y, n, yes, no or blank; null otherwise."""
    value = F.lower(strip(c))
    return F.when(value.isin("y", "yes"), "yes").when(value.isin("n", "no"), "no").when(value == "", "")


def is_url(c: Column | str) -> Column:
    return col(c).rlike(URL_PATTERN)


def normalise_url(c: Column | str) -> Column:
    """the address without white space, or null where it is none."""
    value = F.regexp_replace(col(c), SPACE + "+", "")
    return F.when(is_url(value), value)


def clean_cell(c: Column | str) -> Column:
    """Trim a cell, rewrite its line breaks as CRLF, and blank it where it stands for nothing."""
    value = F.regexp_replace(col(c), "^[ \n\r\t\f]+|[ \n\r\t\f]+$", "")
    value = F.regexp_replace(F.regexp_replace(value, "\r", ""), "\n", "\r\n")
    for pattern in NULL_PATTERNS:
        value = F.regexp_replace(value, pattern, "")
    return value


def field_name(name: str) -> str:
    """A header in the form in which headers and fields are compared (driver side)."""
    return "".join(ch for ch in name.replace("_", "-").lower() if ch.isascii() and (ch.isalnum() or ch in "-_"))


def lookup_part(c: Column | str) -> Column:
    """A prefix, reference or organisation as lookups compare it."""
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9-]", "")


def curie_parts(c: Column | str) -> Column:
    """``struct<prefix, reference>`` of a CURIE; the prefix is '' where there is none."""
    value = F.coalesce(col(c), F.lit(""))
    pattern = r"^(?s)([A-Za-z0-9_-]+):(.*)$"
    fits = value.rlike(pattern)
    return F.struct(F.when(fits, F.regexp_extract(value, pattern, 1)).otherwise("").alias("prefix"), F.when(fits, F.regexp_extract(value, pattern, 2)).otherwise(value).alias("reference"))


def uri_basename(c: Column | str) -> Column:
    """what follows the last slash, without trailing slashes, lower case."""
    return F.regexp_extract(F.lower(F.regexp_replace(col(c), "/+$", "")), "[^/]*$", 0)


def lower_uri(c: Column | str) -> Column:
    """lower case, without spaces."""
    return F.lower(F.regexp_replace(col(c), SPACE + "+", ""))


def wikipedia_reference(c: Column | str) -> Column:
    """The page name of an English Wikipedia address."""
    return F.replace(col(c), F.lit("https://en.wikipedia.org/wiki/"), F.lit(""))


def mapped(values: dict, c: Column | str) -> Column:
    """A driver dictionary applied to a column, null for other values. Two literal arrays keep this inside generated code."""
    if not values:
        return F.lit(None).cast("string")
    at = F.array_position(F.array(*map(F.lit, values)), col(c)).cast("int")
    return F.get(F.array(*(F.lit(v) for v in values.values())), at - 1)


def normalise_enum(c: Column | str, allowed: dict[str, str]) -> Column:
    """the name that a value maps to once lower case and reduced to letters, digits, hyphens, underscores and spaces; null if none."""
    return mapped(allowed, F.trim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9_ -]", "")))


def is_date(c: Column | str) -> Column:
    """whether a value is an ISO date."""
    return F.coalesce(col(c).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(col(c)).isNotNull(), F.lit(False))
