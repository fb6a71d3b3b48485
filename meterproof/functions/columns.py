"""Column expressions shared by the operators. Built-ins only, so they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from meterproof.schemas import MONEY

# Fixed value: where a meter event carries its register reading.
METER_PATH = "$.meterValue[0].sampledValue[0].value"
# Fixed value: form of an event's timestamps.
INSTANT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})$"
PLAIN_DECIMAL = "^[0-9]+([.][0-9]{1,6})?$"


def holds(predicate: Column) -> Column:
    """A predicate that cannot be decided does not hold."""
    return F.coalesce(predicate, F.lit(False))


def broken_rules(rules: dict[str, Column]) -> Column:
    """Codes of the rules a row breaks, in declaration order; empty when the row is fine."""
    codes = F.array(*[F.when(~holds(rule), F.lit(code)) for code, rule in rules.items()])
    return F.array_except(codes, F.array(F.lit(None).cast("string")))


def keeps_all(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [holds(rule) for rule in rules.values()])


def sha256(column: str | Column) -> Column:
    return F.sha2(F.col(column) if isinstance(column, str) else column, 256)


def digest_words(text: str | Column) -> list[Column]:
    """Four 60-bit words of a text's SHA-256: their sums name a set of texts, in any order."""
    digest = sha256(text)
    return [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]


def packed(text: str | Column) -> Column:
    """A text as bytes, to be sorted and shuffled: half of them when it is a hash in small letters. See `unpacked`."""
    own = F.col(text) if isinstance(text, str) else text
    plain = F.lower(F.hex(F.unhex(own))) == own
    return F.when(plain, F.concat(F.lit(b"\x01"), F.unhex(own))).otherwise(F.concat(F.lit(b"\x00"), own.cast("binary")))


def unpacked(code: str | Column) -> Column:
    """The text that was `packed`."""
    own = F.col(code) if isinstance(code, str) else code
    rest = F.substring(own, 2, 2**31 - 1)
    return F.when(F.substring(own, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def set_digest(members: Column, sums: list[Column]) -> Column:
    """Digest of a set from its size and the sums of its members' words."""
    parts = [F.coalesce(s, F.lit(0)).cast("decimal(38,0)").cast("string") for s in sums]
    return F.sha2(F.concat_ws(":", members.cast("string"), *parts), 256)


def filled(column: str | Column) -> Column:
    return F.length(F.trim(column)) > 0


def text_at(document: Column, path: str) -> Column:
    """Text of a scalar inside a parsed JSON document, or NULL."""
    return F.try_variant_get(document, path, "string")


def document_within(marked: Column, text: str | Column) -> Column:
    """The document of a `marked` text, or NULL when anything but blanks follows it."""
    return F.when(text_at(marked, "$[1]") == sha256(text), F.try_variant_get(marked, "$[0]", "variant"))


def marked(text: str | Column) -> Column:
    """Parses a text within a list that ends in the text's own hash.

    The parser stops at the end of the first value; in this form whatever follows it shows.
    """
    own = F.col(text) if isinstance(text, str) else text
    return F.try_parse_json(F.concat(F.lit("["), own, F.lit(',"'), sha256(own), F.lit('"]')))


def whole_at(document: Column, path: str) -> Column:
    """An integer that is written as one, or NULL: not quoted, no fraction, no exponent."""
    return F.when(kind_at(document, path) == "BIGINT", text_at(document, path).try_cast("bigint"))


def instant_at(document: Column, path: str) -> Column:
    """An instant that names its zone and has six fractional digits at most, or NULL."""
    text = text_at(document, path)
    return F.when((kind_at(document, path) == "STRING") & text.rlike(INSTANT), text.try_cast("timestamp"))


def items_at(document: Column, path: str) -> Column:
    """Members of the list at the path, NULL when it is none."""
    return F.size(F.try_variant_get(document, path, "array<variant>"))


def absent_at(document: Column, path: str) -> Column:
    """Nothing at the path, or a JSON null."""
    part = F.try_variant_get(document, path, "variant")
    return part.isNull() | F.is_variant_null(part)


def kind_at(document: Column, path: str) -> Column:
    """Type of the value at a path, e.g. BIGINT, DECIMAL(3,2), DOUBLE or STRING."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def plain_decimal(kind: Column, text: Column) -> Column:
    """Nonnegative plain decimal of at most six fractional digits; NULL for anything else.

    Parsed JSON keeps plain decimals exactly and turns exponents into doubles, so the
    kind of the value is asked as well as its text.
    """
    return F.when((kind != "DOUBLE") & text.rlike(PLAIN_DECIMAL), text.try_cast(MONEY))


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def hours(micros: Column) -> Column:
    """Microseconds as hours, HALF_UP to six digits: one millionth of an hour is 3600 us."""
    millionths = F.floor((F.abs(micros) + 1800) / F.lit(3600).cast("decimal(4,0)"))
    return (F.signum(micros).cast("int") * millionths.cast("decimal(18,0)") * _unit(6)).try_cast(MONEY)


def kwh(watt_hours: Column) -> Column:
    return (watt_hours.cast("decimal(20,0)") * _unit(3)).try_cast(MONEY)


def _unit(digits: int) -> Column:
    return F.lit("0." + "0" * (digits - 1) + "1").cast(f"decimal({digits},{digits})")


def cents(amount: Column) -> Column:
    """Rounds once, HALF_UP, to two digits."""
    return F.round(amount, 2).try_cast("decimal(18,2)")


def total(column: str | Column) -> Column:
    """Sum that is 0, not NULL, over nothing."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def tally(predicate: Column) -> Column:
    return F.count_if(predicate).cast("bigint")


def iso_utc(instant: Column) -> Column:
    """ISO text of an instant under the UTC session zone, with a fraction only when there is one."""
    return F.concat(F.translate(instant.cast("string"), " ", "T"), F.lit("Z"))


def once(value: Column) -> Column:
    """Evaluates an expensive expression a single time per row.

    Filters on columns computed from parsed text are otherwise pushed below the
    projection that parses, and the parsing is repeated for every mention. Nothing
    is pushed through a generator.
    """
    return F.explode(F.array(value))
