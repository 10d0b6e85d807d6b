"""Scalar expressions that the operators share; all are built-in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d+$"


#: The characters that Unicode calls white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Without leading and trailing white space, Unicode included; null becomes empty."""
    return F.btrim(F.coalesce(col(c), F.lit("")), F.lit(WHITE_SPACE))


def blank(c: Column | str) -> Column:
    """Null, empty or all white space; a text that begins with a visible ASCII character is not looked through."""
    seen = (col(c) >= F.lit("!")) & (col(c) < F.lit("\x7f"))
    return ~F.coalesce(seen, F.lit(False)) & (F.ltrim(F.coalesce(col(c), F.lit("")), F.lit(WHITE_SPACE)) == "")


def sha256(c: Column | str) -> Column:
    return F.sha2(col(c).cast("string"), 256)


def finite(c: Column | str) -> Column:
    """True for a number that is neither NaN nor infinite; null stays null."""
    return ~F.isnan(col(c)) & (F.abs(col(c)) < F.lit(INF))


def finite_or_null(c: Column | str) -> Column:
    return F.when(finite(c), col(c))


def is_hex64(c: Column | str) -> Column:
    """64 bytes that decode need no pattern, which takes several times as long."""
    decodes = (F.octet_length(col(c)) == 64) & F.unhex(col(c)).isNotNull()
    return F.coalesce(decodes, F.lit(False)) | F.coalesce(col(c).rlike("^[0-9A-Fa-f]{64}$"), F.lit(False))


def is_rfc3339(c: Column | str) -> Column:
    """A full date-time with zone; a bare date is none."""
    return F.coalesce(col(c).rlike(RFC3339), F.lit(False)) & F.try_to_timestamp(col(c)).isNotNull()


def number(t: Column) -> Column:
    """A trimmed text in plain decimal notation; null for all else, so "4d" and "NaN" are no numbers."""
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def whole(t: Column) -> Column:
    return F.when(t.rlike(INTEGER), t.try_cast("bigint"))


def parse_double(c: Column | str) -> Column:
    return number(trimmed(c))


def parse_long(c: Column | str) -> Column:
    return whole(trimmed(c))


def base64(c: Column | str) -> Column:
    """One line, whatever the session says of long ones."""
    return F.translate(F.base64(col(c)), "\r\n", "")


def slug(c: Column | str) -> Column:
    """A dataset's name as one path part: trimmed, "/" as "-"."""
    return F.replace(trimmed(c), F.lit("/"), F.lit("-"))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def any_of(*conditions: Column) -> Column:
    """True if a condition is; null counts as false."""
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def reasons(*rules: tuple[Column, str | Column]) -> Column:
    """Codes of all rules whose condition is true, in order; a code that is null is left out.

    Short lists are joined, since taking the nulls out of one long list is a
    function that Spark interprets, with all conditions below it, row by row.
    """
    none = F.array().cast("array<string>")
    made = []
    for bad, code in rules:
        hit = F.coalesce(bad, F.lit(False)) if isinstance(code, str) else F.coalesce(bad, F.lit(False)) & code.isNotNull()
        made.append(F.when(hit, F.array(F.lit(code) if isinstance(code, str) else code)).otherwise(none))
    return F.concat(*made) if made else none


def failed(rules: list[tuple[Column, str]], first: int = 0) -> Column:
    """A bit for each rule whose condition is true, from bit ``first`` on; 0 if none is."""
    out = F.lit(0).cast("bigint")
    for i, (bad, _) in enumerate(rules, first):
        out = out.bitwiseOR(F.when(F.coalesce(bad, F.lit(False)), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def failed_codes(bits: str, codes: list[str]) -> Column:
    """Codes of the bits that are set, in order; a row without one gets a constant."""
    return F.when(F.col(bits) == 0, F.array().cast("array<string>")).otherwise(reasons(*((F.col(bits).bitwiseAND(1 << i) != 0, c) for i, c in enumerate(codes))))


def distance(ax: str, ay: str, bx: str, by: str) -> Column:
    """Plane distance; null where a coordinate is missing or the result is not finite."""
    x, y = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return finite_or_null(F.sqrt(x * x + y * y))


def date_parts(ts: Column) -> list[Column]:
    """year, month, day as the lake's folders name them."""
    return [F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"), F.date_format(ts, "dd").alias("day")]


def rfc3339_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def half_away(c: Column, digits: int) -> Column:
    """Rounds halves away from zero, as Spark's round does."""
    return F.round(c, digits)


def one_decimal(c: Column) -> Column:
    """A single-precision number that was rounded to tenths as text in plain notation at any size.

    Below a million a tenth is the number's shortest text; above, numbers may lie
    between tenths (halves go to the even one) and their shortest text is scientific.
    """
    return F.when(F.abs(c) < 1e6, c.cast("string")).otherwise(F.format_string("%.1f", F.bround(c.cast("double"), 1)))


def ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(default))
