"""Measures: exact decimals with a companion flag for text that is not a number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from gridspark.fixed import AFTER_SCALE, ERROR_LITERALS, FORMAT_LITERALS, NOT_SIGNIFICANT, PLACEHOLDER, SCIENTIFIC
from gridspark.functions.binding import let
from gridspark.functions.text import strip_space

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
# Numbers whose decimals hold them whole, also after x100 and /1000: twelve integer digits, eighteen decimals.
_ORDINARY = r"^[+-]?(?=\.?\d)0*\d{0,12}(?:\.\d{0,18}0*)?$"

# What most numeric cells hold: an ordinary number that needs neither stripping nor other signs.
_SIMPLE = r"^[+-]?\d{1,12}(?:\.\d{1,18})?\z"

# One scan over a section of a number format, literals taken whole: a placeholder, a comma, and then the end or a sign
# that is neither a placeholder nor a separator.
_LITERAL = f"(?:{'|'.join(FORMAT_LITERALS)})"
_SCALES = f"(?s)^(?>{_LITERAL}|.)*?{PLACEHOLDER}{_LITERAL}*+,{_LITERAL}*+(?:{AFTER_SCALE}|$)"

NUM_TYPE = "decimal(30,18)"
# Numbers after scaling: 17 integer digits, 21 decimals.
SCALED_TYPE = "decimal(38,21)"
MEASURE_TYPE = f"struct<num:{SCALED_TYPE},digits:string,flag:string>"


def _measure(num: Column, digits: Column, flag: Column) -> Column:
    return F.struct(num.cast(SCALED_TYPE).alias("num"), digits.cast("string").alias("digits"), flag.cast("string").alias("flag"))


def _plain(raw: Column) -> Column:
    return F.translate(strip_space(raw), ",\xa0 _", ".")


def to_number(raw: Column, kind: Column | None = None) -> Column:
    """Decimal of a cell text, or NULL; ``1 234,50`` and ``1.5E3`` are numbers. NULL also for a number that the
    decimal does not hold; :func:`to_digits` has those."""
    plain = _plain(raw)
    # The pattern spares a failing cast, whose exception is dear, for every text cell.
    num = F.when(raw.rlike(_SIMPLE), raw.try_cast(NUM_TYPE)).when(plain.rlike(_ORDINARY), plain.try_cast(NUM_TYPE))
    if kind is not None:
        truth = F.when(F.lower(raw) == "true", 1).when(F.lower(raw) == "false", 0)
        num = F.when(kind == "b", truth.cast(NUM_TYPE)).otherwise(num)
    return num


def to_digits(raw: Column, kind: Column | None = None) -> Column:
    """Exact text, in plain notation, of a number of any length that :func:`to_number` does not hold, else NULL."""
    return _long(raw, kind, lambda digits: digits)


def _long(raw: Column, kind: Column | None, body: Callable[[Column], Column]) -> Column:
    """``body`` of the digits of a long number, NULL for all else."""
    # Only texts of a certain look are tried: a dozen signs and more after a digit, or an exponent.
    tried = ~raw.rlike(_SIMPLE) & raw.rlike(r"\d.{11}|\.\d+\d{18}|\d\.?[eE][+-]?\d")
    if kind is not None:
        tried = tried & ~F.coalesce(kind == "b", F.lit(False))
    return F.when(tried, let(_plain(raw), lambda p: F.when(
        p.rlike(_NUMBER) & ~p.rlike(_ORDINARY), let(canonical_digits(plain_notation(p)), body))))


def to_measure(raw: Column, kind: Column | None = None) -> Column:
    """STRUCT<num, digits, flag>: empty gives NULLs, ``NS`` and error literals go to the flag, any other text is
    passed on in the flag, stripped.

    ``digits`` is NULL for ordinary numbers, which ``num`` holds whole. Of longer ones it is the exact text, and
    ``num`` the nearest decimal, or NULL if there is none.
    """
    num, digits = to_number(raw, kind), to_digits(raw, kind)
    return _read(num, digits, raw)


def _read(num: Column, digits: Column, raw: Column) -> Column:
    return _measure(F.coalesce(num.cast(SCALED_TYPE), digits.try_cast(SCALED_TYPE)), digits,
                    F.when(digits.isNull(), _flag(raw, num)))


def _flag(raw: Column, num: Column) -> Column:
    """What stands in a measure instead of a number: sentinels in upper case, other text as it is."""
    stripped = strip_space(raw)
    upper = F.upper(stripped)
    text = F.when(upper.isin(NOT_SIGNIFICANT, *ERROR_LITERALS), upper).when(stripped != "", stripped)
    return F.when(num.isNull(), text)


# The functions on digits name their input once, so that the expressions grow with their number and not with its powers.

def _replaced(text: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def canonical_digits(text: Column) -> Column:
    """A number in plain notation without plus sign, needless zeros or a bare point."""
    return _replaced(text, (r"^\+?(-?)0*(?=\d)", "$1"), (r"^\+?(-?)\.", "$10."), (r"\.0*$|(\.\d*[1-9])0+$", "$1"), ("^-0$", "0"))


def moved_point(digits: Column, places: int) -> Column:
    """The number times ten to the ``places``, by its text alone; no digit is lost."""
    if places >= 0:
        longer = F.concat(_replaced(digits, (r"^(-?\d+)$", "$1.")), F.lit("0" * places))
        return canonical_digits(_replaced(longer, (rf"\.(\d{{{places}}})", "$1.")))
    return canonical_digits(_replaced(digits, ("^(-?)", "$1" + "0" * -places), (rf"(\d{{{-places}}})(?:\.(\d*))?$", ".$1$2")))


def round_digits(digits: Column, places: int) -> Column:
    """The number with exactly ``places`` decimals, half away from zero, by its text alone; zero has no sign."""
    padded = F.concat(_replaced(digits, (r"^(-?\d+)$", "$1.")), F.lit("0" * (places + 1)))
    # The point goes, and a bar parts the digits that stay from the one that decides.
    cut = _replaced(padded, (rf"\.(\d{{{places}}})(\d)\d*$", "$1|$2"), (r"\|[0-4]$", ""))
    # Rounding up: the nines before the bar turn over, and the digit before them, or a new one, grows.
    turned = _replaced(cut, (r"9(?=9*\|)", "n"), (r"^(-?)(?=n*\|)", "$10"))
    grown = _replaced(turned, *((rf"{d}(?=n*\|)", str(d + 1)) for d in reversed(range(9))))
    whole = F.translate(_replaced(grown, (r"\|.$", "")), "n", "0")
    return _replaced(whole, (rf"(\d{{{places}}})$", ".$1" if places else ""), (r"^-(?=[0.]*$)", ""))


def has_thousands(number_format: Column) -> Column:
    """The first section of a number format scales by a thousand (``#,##0,``)."""
    return F.coalesce(F.split_part(number_format, F.lit(";"), F.lit(1)).rlike(_SCALES), F.lit(False))


def has_percent(number_format: Column) -> Column:
    return F.coalesce(F.contains(number_format, F.lit("%")), F.lit(False))


def _ordinary(num: Column, when: Column, factor: str, factor_type: str) -> Column:
    num = num.cast(NUM_TYPE)
    return F.when(when, num * F.lit(factor).cast(factor_type)).otherwise(num)


def _thousandth(num: Column, number_format: Column) -> Column:
    return _ordinary(num, has_thousands(number_format), "0.001", "decimal(4,3)")


def _hundredfold(num: Column, number_format: Column) -> Column:
    return _ordinary(num, has_percent(number_format), "100", "decimal(3,0)")


def _moved(measure: Column, when: Column, places: int, num: Column) -> Column:
    """The measure with its point moved where a condition holds; ``num`` is what an ordinary number becomes."""
    digits = measure["digits"]
    digits = F.when(digits.isNotNull(), F.when(when, let(digits, lambda d: moved_point(d, places))).otherwise(digits))
    return _measure(F.when(digits.isNull(), num.cast(SCALED_TYPE)).otherwise(digits.try_cast(SCALED_TYPE)), digits, measure["flag"])


def scaled(measure: Column, number_format: Column) -> Column:
    """Divide by 1000 when the format does."""
    return _moved(measure, has_thousands(number_format), -3, _thousandth(measure["num"], number_format))


def percentage(measure: Column, number_format: Column) -> Column:
    """Multiply by 100 when the format shows a percent sign."""
    return _moved(measure, has_percent(number_format), 2, _hundredfold(measure["num"], number_format))


def parsed_cell() -> Column:
    """Cell columns as one struct, its number parsed once. ``long`` is NULL for ordinary numbers; of longer ones it
    has the digits, as they stand and as their format shows amounts and percentages."""
    raw, kind, shown = F.col("raw"), F.col("kind"), F.col("number_format")
    long_ = _long(raw, kind, lambda d: F.struct(
        d.alias("digits"), F.when(has_thousands(shown), moved_point(d, -3)).otherwise(d).alias("amount"),
        F.when(has_percent(shown), moved_point(d, 2)).otherwise(d).alias("percent")))
    return F.struct("raw", "kind", "ts", "number_format", to_number(raw, kind).alias("num"), long_.alias("long"))


def _of_cell(cell: Column, part: str, num: Column) -> Column:
    digits = cell["long"][part]
    return F.when(cell.isNotNull(), _measure(
        F.coalesce(num.cast(SCALED_TYPE), digits.try_cast(SCALED_TYPE)), digits, F.when(digits.isNull(), _flag(cell["raw"], cell["num"]))))


def measure_of(cell: Column) -> Column:
    """Measure of a parsed cell, NULL when there is no cell."""
    return _of_cell(cell, "digits", cell["num"])


def amount_of(cell: Column) -> Column:
    """Measure of a parsed cell, scaled as its format says."""
    return _of_cell(cell, "amount", _thousandth(cell["num"], cell["number_format"]))


def percentage_of(cell: Column) -> Column:
    """Measure of a parsed cell, times 100 under a percent format."""
    return _of_cell(cell, "percent", _hundredfold(cell["num"], cell["number_format"]))


def _rounded_digits(digits: Column, places: int) -> Column:
    return F.when(digits.isNotNull(), let(digits, lambda d: round_digits(d, places)))


def rounded(measure: Column, places: int) -> Column:
    """The measure, half away from zero at ``places``."""
    return _measure(F.round(measure["num"], places), canonical_digits(_rounded_digits(measure["digits"], places)), measure["flag"])


def two_decimals(measure: Column) -> Column:
    return rounded(measure, 2)


def is_integral(num: Column) -> Column:
    return num == F.floor(num)


def is_whole(measure: Column) -> Column:
    """The number has no fraction; NULL when there is no number."""
    return F.when(measure["digits"].isNotNull(), ~F.contains(measure["digits"], F.lit("."))).otherwise(is_integral(measure["num"]))


def to_int(measure: Column) -> Column:
    """DECIMAL(38,0) of an integral number, NULL otherwise; beyond 38 digits only ``digits`` has it."""
    whole = F.when(measure["digits"].isNotNull(), measure["digits"].try_cast("decimal(38,0)")).otherwise(measure["num"].cast("decimal(38,0)"))
    return F.when(is_whole(measure), whole)


def format_decimal(num: Column, places: int | None = None) -> Column:
    """Plain text of a number: half-up at ``places``, else without trailing zeros."""
    if places is not None:
        return F.round(num, places).cast(f"decimal(38,{places})").cast("string")
    text = num.cast("string")
    stripped = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(num == 0, "0").otherwise(stripped)


def format_measure(measure: Column, places: int | None = None) -> Column:
    """Text of a measure as published: the flag if there is one, else the number, whole at any length."""
    digits = measure["digits"] if places is None else _rounded_digits(measure["digits"], places)
    return F.coalesce(measure["flag"], digits, format_decimal(measure["num"], places), F.lit(""))


def is_scientific(c: Column) -> Column:
    """The text is a number with an exponent."""
    return F.regexp_like(strip_space(c), F.lit(SCIENTIFIC))


def plain_notation(text: Column) -> Column:
    """A finite number text without its exponent: the decimal point is shifted on the text, so no digit is lost."""
    def shifted(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, r"^[+-]?(\d*)\.?(\d*)[eE]([+-]?\d+)$", i)
        parts = F.struct(part(1).alias("whole"), part(2).alias("tail"), part(3).try_cast("int").alias("exponent"))
        sign = F.when(F.startswith(t, F.lit("-")), "-").otherwise("")
        return F.concat(sign, let(parts, lambda p: _pointed(F.concat(p["whole"], p["tail"]), F.length(p["whole"]) + p["exponent"])))

    return F.when(F.regexp_like(text, F.lit(SCIENTIFIC)), let(text, shifted)).otherwise(text)


def _pointed(digits: Column, point: Column) -> Column:
    """Digits with a point before the one at ``point`` and no needless zeros."""
    def of(p: Column) -> Column:
        # Zeros in front as many as the point lies before the digits, behind as many as it lies after them.
        longer = F.concat(F.repeat(F.lit("0"), F.greatest(1 - p["point"], F.lit(0))), F.rpad(p["digits"], F.greatest(p["point"], F.length(p["digits"])), "0"))
        point = F.greatest(p["point"], F.lit(1))
        return canonical_digits(let(longer, lambda d: F.concat(F.substr(d, F.lit(1), point), F.lit("."), F.substr(d, point + 1))))

    return let(F.struct(digits.alias("digits"), point.alias("point")), of)


def is_error(raw: Column) -> Column:
    return F.coalesce(F.upper(raw).isin(*ERROR_LITERALS), F.lit(False))


def is_valid_measure(measure: Column) -> Column:
    """A finite number, empty, ``NS`` or an error literal."""
    return measure["flag"].isNull() | measure["flag"].isin(NOT_SIGNIFICANT, *ERROR_LITERALS)
