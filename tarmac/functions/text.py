"""Native text expressions; none of them needs Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode calls white space lies below U+3001.
_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Plain decimal or scientific notation. Narrower than a cast, which also takes '1d' or 'Infinity'.
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.btrim(_col(c), F.lit(_WHITESPACE))


def plain_number(text: Column) -> Column:
    """Text without white space around it to double, infinite if it has too many digits."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def finite(number: Column) -> Column:
    """The number, NULL if it is infinite."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def lenient_number(c: Column | str) -> Column:
    """Text to double; anything that is not a finite plain number becomes NULL."""
    return finite(plain_number(strip(_col(c).cast("string"))))


def surrogate_key(*cols: Column | str, sep: str = "-") -> Column:
    """Lower-case hex MD5 of the natural key text; NULL if any part is NULL."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.lit(sep), _col(c).cast("string")]
    return F.md5(F.concat(*parts[1:]))


def hash_text(c: Column | str) -> Column:
    """Lower-case hex SHA-256 of the value as text; NULL stays NULL."""
    return F.sha2(_col(c).cast("string"), 256)


def masked_email(c: Column | str) -> Column:
    """``a@b.com`` to ``a****@b.com``; whatever has no '@' (or is NULL) to ``****``."""
    text = _col(c).cast("string")
    domain = F.get(F.split(text, "@"), 1)
    return F.coalesce(F.concat(F.substring(text, 1, 1), F.lit("****@"), domain), F.lit("****"))


def masked_tail(c: Column | str, n: int = 4) -> Column:
    """Replace the last ``n`` characters by ``*``; shorter values are masked whole."""
    text = _col(c).cast("string")
    kept = F.greatest(F.char_length(text) - F.lit(n), F.lit(0))
    return F.rpad(F.left(text, kept), F.char_length(text), F.lit("*"))
