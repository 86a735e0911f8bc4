"""Column expressions for pipe-separated lines.

Whether a line is well formed is decided by one anchored pattern over the whole
line. That keeps the check a single pass inside the scan's codegen stage; casts
of separately split fields would be re-evaluated once per field when Catalyst
pushes the check below the projection.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetstream.schemas import DOUBLE, INT, LONG, SPARK_TYPES, STRING

SEPARATOR = "|"


def _at_most(limit: int) -> str:
    """Pattern of the unsigned decimal numbers from 0 to ``limit``, at least 10.

    A run of digits can be read in one way only, so a bad field costs one pass.
    """
    digits = str(limit)
    numbers = [f"[1-9][0-9]{{0,{len(digits) - 2}}}"]
    for i, d in enumerate(digits):
        low = 1 if i == 0 else 0
        if int(d) - 1 >= low:
            rest = len(digits) - i - 1
            numbers.append(f"{digits[:i]}[{low}-{int(d) - 1}][0-9]{{{rest}}}")
    numbers.append(digits)
    some = "(?:" + "|".join(numbers) + ")(?![0-9])"
    return f"(?:0++(?:{some})?|{some})"


def _signed(bits: int) -> str:
    top = 2 ** (bits - 1)
    return f"(?:[+-]?{_at_most(top - 1)}|-0*+{top})"


# All runs are possessive: what a run has taken it does not give back.
_BLANK = r"[\x00-\x20]*+"
_DECIMAL = r"(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?"
_HEXADECIMAL = (
    r"0[xX](?:[0-9a-fA-F]++(?:\.[0-9a-fA-F]*+)?|\.[0-9a-fA-F]++)[pP][+-]?[0-9]++"
)

# What counts as a value of each kind: no blanks in integers, range included;
# doubles as Java reads decimal and hexadecimal literals.
PATTERNS = {
    LONG: _signed(64),
    INT: _signed(32),
    DOUBLE: (
        f"{_BLANK}[+-]?(?:NaN|Infinity|(?:{_HEXADECIMAL}|{_DECIMAL})[fFdD]?){_BLANK}"
    ),
    STRING: r"[^|]*+",
}


def line_pattern(fields) -> str:
    """Matches exactly the lines that hold ``fields``.

    Trailing empty fields do not count, so surplus separators after a full line
    are accepted and an empty last field is not.
    """
    parts = [PATTERNS[kind] for _, kind in fields]
    if fields[-1][1] == STRING:
        parts[-1] = r"[^|]++"
    # (?s) and \z: a line break inside a field is data, not an end of input.
    return r"(?s)^" + r"\|".join(parts) + r"\|*+\z"


def is_well_formed(value: Column, fields) -> Column:
    return F.coalesce(value.rlike(line_pattern(fields)), F.lit(False))


def split_line(value: Column) -> Column:
    return F.split(value, r"\|")


def typed_field(parts: Column, position: int, kind: str) -> Column:
    text = F.get(parts, F.lit(position))
    return text if kind == STRING else text.try_cast(SPARK_TYPES[kind])


def reject_reason(parts: Column, fields) -> Column:
    """Why a malformed line is malformed: the field count or the first bad field.

    ``parts`` must come from a line without its trailing separators.
    """
    count = F.size(parts)
    reason = F.when(
        count != len(fields),
        F.concat(F.lit(f"expected {len(fields)} fields, found "), count.cast("string")),
    )
    for i, (name, kind) in enumerate(fields):
        if kind != STRING:
            bad = ~F.get(parts, F.lit(i)).rlike(r"(?s)^" + PATTERNS[kind] + r"\z")
            reason = reason.when(bad, F.lit(f"bad {name}"))
    return reason.otherwise(F.lit("malformed"))


def strip_trailing(value: Column) -> Column:
    return F.regexp_replace(value, r"[|]+\z", "")


def render(*columns) -> Column:
    """One line from columns. A null renders as the text ``null``."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null"))
        for c in columns
    ]
    return F.concat_ws(SEPARATOR, *texts)
