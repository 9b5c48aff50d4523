"""Cell cleansing profiles applied before a dump is written.

The source tool rewrote the whole dump text; here each rule is a ``replace``
on every string cell, all in one projection, so it runs inside whole-stage
codegen and never holds a table in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two cleansing profiles, applied in this order.
# "pipe" (primary version): the separator is '|', so a '|' inside a cell
# becomes '-', the zero datetime becomes a loadable one.  The tabs that the
# source turned into separators stood between cells (its client escapes tabs
# inside them); here cells are joined by the separator when the line is made.
PIPE_RULES = [
    ("|", "-"),
    ("0000-00-00 00:00:00", "1970-01-01 12:00:00"),
]
# "ctrl_a" (other versions): text NULL becomes empty, carriage returns go,
# the unsigned -1 sentinel 4294967295 becomes 0.
CTRL_A_RULES = [
    ("NULL", ""),
    ("\r", ""),
    ("4294967295", "0"),
]
# "oracle" (rows fetched from an Oracle source): only carriage returns go; NULL
# cells become empty when the line is joined (to_delimited).
ORACLE_RULES = [
    ("\r", ""),
]


def separator(hex_or_char: str) -> str:
    """A separator given as hex text (``'01'`` -> ctrl-A) or a character."""
    if len(hex_or_char) == 2 and all(c in "0123456789abcdefABCDEF" for c in hex_or_char):
        return bytes.fromhex(hex_or_char).decode("latin-1")
    return hex_or_char


def separator_expr(hex_text: str) -> Column:
    """C3 as an expression: ``unhex`` decoded to a one-character string."""
    return F.decode(F.unhex(F.lit(hex_text)), "ISO-8859-1")


def _replace_chain(c: Column, rules, whole_cell: bool) -> Column:
    for old, new in rules:
        if whole_cell:
            c = F.when(c == F.lit(old), F.lit(new)).otherwise(c)
        else:
            c = F.replace(c, F.lit(old), F.lit(new))
    return c


def cleanse_column(c: Column, profile: str = "pipe", sep: str = "|",
                   whole_cell: bool = False) -> Column:
    """Apply one profile to a string column.

    ``whole_cell=False`` reproduces the source behaviour: substring replacement
    (``ANNULLED`` -> ``AN``, ``14294967295`` -> ``10``).  ``whole_cell=True``
    only rewrites cells equal to the pattern.
    """
    if profile == "pipe":
        rules = PIPE_RULES
    elif profile == "ctrl_a":
        rules = CTRL_A_RULES
    elif profile == "oracle":
        rules = ORACLE_RULES
    else:
        raise ValueError(f"unknown cleansing profile {profile!r}")
    return _replace_chain(c, rules, whole_cell)


def cleanse(df: DataFrame, profile: str = "pipe", sep: str | None = None,
            whole_cell: bool = False, text_numbers: bool = None,
            columns=None) -> DataFrame:
    """Cleanse every cell of ``df`` in one ``select``.

    String columns are rewritten.  In the ``ctrl_a`` profile the source
    rewrote the dump *text*, so numbers were affected too (``4294967295``);
    ``text_numbers`` (default: on for ctrl_a) casts non-string columns to
    string first to keep that parity.  ``columns`` limits the rewrite to the
    dump columns (others, e.g. a key kept for joining, pass through).  Column
    names and order are kept.
    """
    if sep is None:
        sep = "|" if profile == "pipe" else "\x01"
    if text_numbers is None:
        text_numbers = profile == "ctrl_a"
    cols = []
    wanted = set(columns) if columns is not None else None
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if wanted is not None and f.name not in wanted:
            pass
        elif isinstance(f.dataType, T.StringType):
            c = cleanse_column(c, profile, sep, whole_cell)
        elif text_numbers and isinstance(f.dataType, T.NumericType):
            c = cleanse_column(c.cast("string"), profile, sep, whole_cell)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def to_delimited(df: DataFrame, sep: str = "\x01", columns=None,
                 null_as: str = "") -> DataFrame:
    """C4: one text line per row, NULL -> '' and every cell to text."""
    names = columns or df.columns
    cells = [F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(null_as)) for n in names]
    return df.select(F.concat_ws(sep, *cells).alias("line"))
