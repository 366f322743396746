"""String column expressions (all JVM-side, codegen-friendly, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` treats as whitespace
# (tab, line feed, vertical tab, form feed, carriage return, the four ASCII
# separators 0x1C-0x1F, space, next line 0x85, no-break space 0xA0, ogham space
# mark 0x1680, the spaces 0x2000-0x200A, line separator 0x2028, paragraph
# separator 0x2029, narrow no-break space 0x202F, medium mathematical space
# 0x205F and ideographic space 0x3000).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Trim every Unicode whitespace character from both ends (``F.trim`` only removes
    spaces, so tabs and newlines would survive)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def upper(c: Column | str) -> Column:
    return F.upper(_col(c))


def std_upper(c: Column | str) -> Column:
    """Normalised form used by change detection: stripped and upper-cased."""
    return F.upper(strip_ws(c))


def replace_literal(c: Column | str, search: str, replacement: str = "") -> Column:
    """Non-regex replace of every occurrence of ``search``."""
    return F.replace(_col(c), F.lit(search), F.lit(replacement))


def head_tokens(c: Column | str, sep: str = "-", n: int = 2, joiner: str = "_") -> Column:
    """First ``n`` tokens of ``c`` split on ``sep``, joined with ``joiner``.

    ``'AC-S1-FR-17'`` -> ``'AC_S1'``. NULL stays NULL.
    """
    c = _col(c)
    parts = F.split(c, _regex_literal(sep))
    return F.when(c.isNotNull(), F.array_join(F.slice(parts, 1, n), joiner))


def tail_tokens(c: Column | str, sep: str = "-", skip: int = 2) -> Column:
    """Tokens after the first ``skip`` ones, joined back with ``sep``.

    ``'AC-S1-FR-17'`` -> ``'FR-17'``; fewer than ``skip + 1`` tokens give
    ``''``. NULL stays NULL.
    """
    c = _col(c)
    parts = F.split(c, _regex_literal(sep))
    return F.when(
        c.isNotNull(), F.array_join(F.slice(parts, skip + 1, F.greatest(F.size(parts), F.lit(1))), sep)
    )


def zfill(c: Column | str, width: int) -> Column:
    """Python ``str.zfill``: left-pad with zeros after an optional sign; never truncates
    (``lpad`` alone would cut ``'123456789'`` to ``'12345678'``)."""
    c = _col(c)
    signed = c.startswith("-") | c.startswith("+")
    return (
        F.when(F.length(c) >= width, c)
        .when(signed, F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, 1 << 30), width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )


def _regex_literal(s: str) -> str:
    import re

    return re.escape(s)
