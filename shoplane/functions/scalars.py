"""Money, dates, text and repeatable draws as built-in column expressions."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplane.contracts import MONEY, PRICE, REVERSED_STATUSES

TOTAL = "decimal(28,2)"  # room for sums of money over any table

DRAW_MODULUS = 2147483647  # draws are whole numbers in [0, DRAW_MODULUS)


def money(value: Column) -> Column:
    """Round half up to cents."""
    return F.round(value, 2).cast(MONEY)


def price(value: Column) -> Column:
    """Round half up to cents at price width."""
    return F.round(value, 2).cast(PRICE)


def day_of(moment: str | Column) -> Column:
    """Calendar day of a timestamp in the session zone (UTC)."""
    return (F.col(moment) if isinstance(moment, str) else moment).cast("date")


def total(value: Column) -> Column:
    """Sum of money, zero over no rows."""
    return F.coalesce(F.sum(value), F.lit(0)).cast(TOTAL)


def earns(status: str | Column = "status") -> Column:
    """True where the order counts towards net revenue; an unknown status counts."""
    column = F.col(status) if isinstance(status, str) else status
    return F.coalesce(~column.isin(*REVERSED_STATUSES), F.lit(True))


def whole_quotient(dividend: Column, divisor: Column) -> Column:
    """Integer division."""
    return F.call_function("div", dividend, divisor)


def draw_constants(seed: int, tag: str) -> tuple[int, int]:
    """Multiplier and offset of the draw named ``tag`` under ``seed``."""
    code = zlib.crc32(tag.encode())
    return 1 + code % 65521, (seed * 7919 + code) % DRAW_MODULUS


def draw(seed: int, tag: str, row_id: Column) -> Column:
    """A repeatable pseudo-random whole number for one row id.

    Depends on (seed, tag, id) alone, so no partitioning can change it. Plain 64-bit arithmetic that never overflows
    under ANSI mode, hence any SQL engine yields the same number.
    """
    multiplier, offset = draw_constants(seed, tag)
    row_id = row_id.cast("bigint")
    modulus = F.lit(DRAW_MODULUS)
    low = F.pmod(row_id, modulus)
    high = whole_quotient(row_id, modulus)
    mixed = F.pmod(low * F.lit(multiplier) + high * F.lit(69621) + F.lit(offset), modulus)
    return F.pmod(F.pmod(mixed * mixed, modulus) * F.lit(16807) + mixed, modulus)


def draw_below(seed: int, tag: str, row_id: Column, bound: Column | int) -> Column:
    """A draw in ``[0, bound)``."""
    bound = F.lit(bound) if isinstance(bound, int) else bound
    return F.pmod(draw(seed, tag, row_id), bound.cast("bigint"))


def pick(values: Sequence[str], seed: int, tag: str, row_id: Column) -> Column:
    """One of ``values`` at random."""
    words = F.array(*[F.lit(value) for value in values])
    return F.element_at(words, (draw_below(seed, tag, row_id, len(values)) + 1).cast("int"))


def moment_between(low: Column, high: Column, seed: int, tag: str, row_id: Column) -> Column:
    """A random moment from ``low`` to ``high`` inclusive, at whole-second steps after ``low``."""
    span = F.greatest(F.unix_seconds(high) - F.unix_seconds(low), F.lit(0)) + 1
    return F.timestamp_seconds(F.unix_seconds(low) + draw_below(seed, tag, row_id, span))


def utc(moment: datetime) -> Column:
    """A timestamp literal that reads the same in any session zone."""
    if moment.tzinfo is None:
        raise ValueError("as_of must carry a time zone")
    return F.timestamp_seconds(F.lit(int(moment.timestamp())))


def days_before(moment: Column, days: int) -> Column:
    """The moment ``days`` whole days earlier."""
    return F.timestamp_seconds(F.unix_seconds(moment) - F.lit(days * 86400))


def email_handle(full_name: Column) -> Column:
    """Lower-case name with dots for spaces and no apostrophes."""
    return F.translate(F.lower(full_name), " '", ".")


def letters(number: Column, width: int) -> Column:
    """``number`` in base 26 as upper-case letters, the last ``width`` digits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    digits = []
    for place in reversed(range(width)):
        digit = F.pmod(whole_quotient(number, F.lit(26**place)), F.lit(26))
        digits.append(F.substring(alphabet, digit.cast("int") + 1, F.lit(1)))
    return F.concat(*digits)


def stock_code(row_id: Column) -> Column:
    """Code of the shape ``AAA-00000000``, unique for ids below 26^3 * 10^8."""
    block = F.lit(100000000)
    serial = F.lpad(F.pmod(row_id, block).cast("string"), 8, "0")
    return F.concat(letters(whole_quotient(row_id, block), 3), F.lit("-"), serial)


def singular(word: Column) -> Column:
    """The word without one final ``s``."""
    return F.when(word.endswith("s"), F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def noise_in_text(text: Column) -> Column:
    """True for text with a replacement character, a hex escape or markup."""
    return text.rlike("�|0x[0-9A-Fa-f]{2}|<[A-Za-z/]")
