"""Parsing, money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import MISSING_TOKENS

# Money is totalled exactly, so a total does not depend on the order in which shuffle blocks arrive. Two
# values of this width add and subtract without rounding; a value that it cannot hold fails the job.
MONEY_TOTAL = "decimal(36,18)"
LOW_BITS = 20

# Texts of digits that need no parsing beyond a cast to BIGINT.
WHOLE = r"\A[\x00-\x20]*[+-]?[0-9]+(?:\.0*)?[\x00-\x20]*\z"


def _fail(what: str, value: Column, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what}: cannot read '"), value.cast("string"), F.lit(f"' as {kind}")))


def text_is_missing(value: Column) -> Column:
    """NULL for the texts that stand for a missing value."""
    return F.when(~value.isin(*MISSING_TOKENS), value)


# The parsers below put the parsed value first in COALESCE, so that a good value is parsed once and the
# checks run for NULL and bad values only.


def strict_cast(value: Column, kind: str, what: str) -> Column:
    """Cast that passes NULL and fails the job on anything unreadable, whatever the ANSI setting."""
    return F.coalesce(value.try_cast(kind), F.when(value.isNotNull(), _fail(what, value, kind)))


def _number(value: Column, is_text: bool) -> Column:
    """Double, NULL when unreadable or NaN; a letter suffix such as in ``5d`` is not a number."""
    parsed = value.try_cast("double")
    if is_text:
        # a parse that fails costs as much as many that do not, so texts that cannot be a number are not tried
        last = F.lower(F.right(F.rtrim(value), F.lit(1)))
        suffixed = (last == "d") | ((last == "f") & ~F.endswith(F.lower(F.rtrim(value)), F.lit("inf")))
        parsed = F.when(value.rlike("[0-9]|(?i:inf)") & ~suffixed, parsed)
    return F.nullif(parsed, F.lit(float("nan")))


def _is_missing(value: Column, is_text: bool) -> Column:
    if is_text:
        return value.isNull() | (F.lower(F.trim(value)) == "nan")
    return value.isNull() | F.isnan(value.cast("double"))


def strict_number(value: Column, what: str, is_text: bool = True) -> Column:
    """Double; NULL and NaN pass as NULL, other text fails the job."""
    wrong = ~_is_missing(value, is_text)
    return F.coalesce(_number(value, is_text), F.when(wrong, _fail(what, value, "a number")))


def _whole(value: Column, is_text: bool) -> Column:
    """BIGINT where the value is a whole number in range, else NULL.

    A number is cast once and compared with itself. A text falls into one of three kinds and pays for its own only, since a
    cast that fails costs as much as fifty that do not: digits, with or without a fraction of zeros, are cast; anything else
    that holds a digit, such as ``1e3``, is read as a decimal and has to be whole; the rest is no number.
    """
    if not is_text:
        plain = value.try_cast("bigint")
        return F.when(plain == value, plain)
    plain = F.when(value.rlike(WHOLE), F.substring_index(value, ".", 1).try_cast("bigint"))
    digits = value.try_cast("decimal(38,10)")
    # what the decimal cuts off shows in the double
    whole = (digits == F.floor(digits)) & (digits.cast("double") == value.try_cast("double"))
    return F.coalesce(plain, F.when(value.rlike("[0-9]") & whole, digits.try_cast("bigint")))


def strict_integer(value: Column, what: str, is_text: bool = True) -> Column:
    """BIGINT; NULL passes, unreadable text and fractions fail the job."""
    wrong = ~_is_missing(value, is_text)
    return F.coalesce(_whole(value, is_text), F.when(wrong, _fail(what, value, "a whole number")))


def lenient_integer(value: Column, what: str, is_text: bool = True) -> Column:
    """BIGINT; anything that is not a number is unknown (NULL), a fraction fails the job."""
    wrong = _number(value, is_text).isNotNull()
    return F.coalesce(_whole(value, is_text), F.when(wrong, _fail(what, value, "a whole number")))


def exact(amount: Column) -> Column:
    """The decimal number that an amount is written as; the job fails on one that ``MONEY_TOTAL`` cannot hold.

    A double from 2^53 on is the whole number that it holds: how it is written depends on who writes it.
    """
    value = amount.cast("double")
    large = F.typeof(amount).isin("double", "float") & (F.abs(value) >= F.lit(float(1 << 53)))
    digits = F.when(large, value.try_cast("bigint").try_cast(MONEY_TOTAL)).otherwise(amount.try_cast(MONEY_TOTAL))
    held = F.when(digits.cast("double") == value, digits)
    return F.coalesce(held, F.when(amount.isNotNull(), _fail("amount", amount, f"a number of {MONEY_TOTAL}")))


def _split(amount: Column) -> tuple[Column, Column, Column]:
    """An amount as millionths, or else as whole units and a rest in units of 1e-18, from 0 on; all BIGINT.

    Nearly all amounts are whole millionths and go through DOUBLE alone. That is exact below 2^32, where neighbouring
    doubles are less than a millionth apart; larger amounts and finer ones are read as decimals.
    """
    value = amount.cast("double")
    units = F.rint(value * F.lit(1e6)).try_cast("bigint")
    short = F.coalesce((F.abs(value) < F.lit(float(1 << 32))) & (units.cast("double") / F.lit(1e6) == value), F.lit(False))
    digits = exact(amount)
    whole = F.floor(digits)
    rest = (digits - whole).cast("decimal(18,18)") * F.lit(10**18).cast("decimal(19,0)")
    return F.when(short, units), F.when(~short, whole.cast("bigint")), F.when(~short, rest.cast("bigint"))


def _limbs(value: Column, bits: int) -> tuple[Column, Column]:
    """Sums of the high and of the low bits of a BIGINT: neither overflows before 2^43 rows, or 2^31 with 32 low bits."""
    return F.sum(F.shiftright(value, bits)), F.sum(value.bitwiseAND(F.lit((1 << bits) - 1)))


def _joined(limbs: tuple[Column, Column], bits: int) -> Column:
    high, low = (F.coalesce(x, F.lit(0)).cast("decimal(20,0)") for x in limbs)
    return (high * F.lit(1 << bits).cast("decimal(10,0)") + low).cast("decimal(32,0)")


def _exact_total(millionths: Column, whole: Column, rest: Column, written: bool) -> Column:
    """Exact total of amounts in pieces, NULL without amounts: ``MONEY_TOTAL``, which fails the job where it cannot hold
    the total, or ``written`` as the same text, whatever its size.

    Every piece is added as BIGINT sums of its high and low bits, which run in generated code, several times faster than
    decimals; decimals appear once per group, when the sums are put together.
    """
    small, large, fine = (_limbs(millionths, LOW_BITS), _limbs(whole, LOW_BITS), _limbs(rest, 32))
    in_millionths, below = _joined(small, LOW_BITS), _joined(fine, 32)
    # 10^12 units of the rest are a millionth
    carried = F.floor(below * F.lit("0.000000000001").cast("decimal(12,12)")).cast("decimal(26,0)")
    left = (below - carried * F.lit(10**12).cast("decimal(13,0)")).cast("decimal(13,0)")
    in_millionths = (in_millionths + carried).cast("decimal(32,0)")
    if written:
        total = _text_of(_joined(large, LOW_BITS), in_millionths, left)
    else:
        fraction = (in_millionths * F.lit("0.000001").cast("decimal(6,6)")).cast(MONEY_TOTAL)
        fraction = fraction + (left * F.lit("1e-18").cast("decimal(18,18)")).cast(MONEY_TOTAL)
        total = (fraction.cast(MONEY_TOTAL) + _joined(large, LOW_BITS).cast(MONEY_TOTAL)).cast(MONEY_TOTAL)
    return F.when(small[0].isNotNull() | large[0].isNotNull(), total)


def _text_of(large: Column, millionths: Column, left: Column) -> Column:
    """Whole units, millionths and a rest in units of 1e-18, from 0 on and below a millionth, as one number with 18 decimals."""
    million, one = F.lit(10**6).cast("decimal(7,0)"), F.lit(10**18).cast("decimal(19,0)")
    units = F.floor(millionths * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(32,0)")
    rest = ((millionths - units * million).cast("decimal(6,0)") * F.lit(10**12).cast("decimal(13,0)") + left).cast("decimal(19,0)")
    whole = (units + large).cast("decimal(33,0)")
    below_zero = whole < 0
    turned = below_zero & (rest > 0)  # -0.3 is here -1 and 0.7
    rest = F.when(turned, one - rest).otherwise(rest).cast("bigint")
    units = F.abs(whole) - F.when(turned, F.lit(1)).otherwise(F.lit(0))
    sign = F.when(below_zero, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, units.cast("string"), F.lit("."), F.lpad(rest.cast("string"), 18, "0"))


def money_total(amount: Column | str, written: bool = False) -> Column:
    """Exact total of an amount column; ``written``: as text with 18 decimals, for totals that ``MONEY_TOTAL`` cannot hold."""
    return _exact_total(*_split(F.col(amount) if isinstance(amount, str) else amount), written)


def cost_total(quantity: Column, unit_cost: Column, written: bool = False) -> Column:
    """Exact total of quantity (BIGINT) times unit cost, with all decimals of the unit cost; ``written`` as in ``money_total``."""
    millionths, whole, rest = _split(unit_cost)
    product = F.try_multiply(quantity, millionths)
    # where the millionths do not fit: whole units and rests of the same product
    below = F.pmod(millionths, F.lit(10**6))
    units = F.coalesce(whole, F.when(product.isNull(), ((millionths - below) / F.lit(1e6)).cast("bigint")))
    parts = F.coalesce(rest, F.when(product.isNull(), below * F.lit(10**12)))
    fine = quantity.cast("decimal(19,0)") * parts.cast("decimal(18,0)")
    carried = F.floor(fine * F.lit("1e-18").cast("decimal(18,18)"))
    left = (fine - carried * F.lit(10**18).cast("decimal(19,0)")).cast("bigint")
    return _exact_total(product, quantity * units + carried.cast("bigint"), left, written)


def exact_product(amount: Column, factor: Column) -> Column:
    """Amount times factor: in decimals where all digits fit, else the nearest double; never cut to the scale of money.

    A product too large for the type fails the job.
    """
    whole, short, narrow = exact(amount), "decimal(22,6)", "decimal(15,8)"
    a, b = whole.try_cast(short), factor.try_cast(narrow)
    fits = (a == whole) & (b.cast("double") == factor.cast("double"))
    product = whole.cast("double") * factor.cast("double")
    large = F.when(product.isNotNull(), _fail("amount in the base currency", product, f"a number of {MONEY_TOTAL}"))
    return F.coalesce(F.when(fits, (a * b).try_cast(MONEY_TOTAL)), product.try_cast(MONEY_TOTAL), large)


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` where the whole is positive, else NULL."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage; NULL when the whole is zero."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.round(share * 100, digits)
