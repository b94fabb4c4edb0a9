"""Text of JSON numbers in columns that are declared (or fall back to) ``string``.

A JSON integer keeps its digits.  A JSON number with a fraction or an exponent is a double, and its
text is the shortest one that gives the double back, written out where the exponent lies between -4
and 15 (``1e10`` is ``10000000000.0``) and as ``1e-05`` or ``1.5e+16`` beyond; too large a number is ``inf``.

``from_json`` hands such a column the JVM's text of the double, and a JSON *string* ``"1.0E10"`` the same text.
:func:`with_number_texts` tells them apart by a second parse of the page, in which the string columns are
VARIANT.  It is made only for pages that hold a text in question.  All of it is built-in expressions.

Subnormal doubles (below 2.3e-308) keep the digits that the JVM prints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the JVM writes for a double, the quotes included that JSON needs for one that is not finite.
_DOUBLE_TEXT = r'^(-?[0-9]+\.[0-9]+(E-?[0-9]+)?|"-?Infinity")$'
_NUMBER_KIND = r"^(DOUBLE|FLOAT|DECIMAL)"
# --- Fixed values: exponents from which on a number is written with one, and the text of infinity ---
WRITTEN_OUT_FROM, WRITTEN_OUT_BELOW = -4, 16
INFINITE = "inf"
# --- end of fixed values ---


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def _shortest(number: Column) -> Column:
    """The double as ``d.ddde+xx`` with 15, 16 or 17 digits, the first that gives the double back."""
    def kept(digits: int) -> Column:
        text = F.format_string(f"%.{digits - 1}e", number)
        return F.when(text.try_cast("double") == number, text)

    return F.coalesce(kept(15), kept(16), F.format_string("%.16e", number))


def _laid_out(scientific: Column) -> Column:
    sign = F.regexp_extract(scientific, "^-", 0)
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(scientific, "e", 1), "[-.]", ""), "0+$", "")
    exponent = F.substring_index(scientific, "e", -1).cast("int")

    def text(parts: Column) -> Column:
        d, e = parts["digits"], parts["exponent"]
        whole = F.rpad(d, F.greatest(e + 1, F.length(d)), F.lit("0"))  # at least all digits before the point
        large = F.concat(F.substring(whole, F.lit(1), e + 1), F.lit("."),
                         F.coalesce(F.nullif(F.substring(whole, e + 2, F.length(whole)), F.lit("")), F.lit("0")))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d)
        rest = F.substring(d, 2, 400)
        power = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")),
                         F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
        return F.concat(parts["sign"], F.when(d == "", F.lit("0.0"))
                        .when((e >= 0) & (e < WRITTEN_OUT_BELOW), large)
                        .when((e < 0) & (e >= WRITTEN_OUT_FROM), small)
                        .otherwise(F.concat(F.substring(d, 1, 1), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), power)))

    return _let(F.struct(sign.alias("sign"), digits.alias("digits"), exponent.alias("exponent")), text)


def double_text(jvm_text: Column) -> Column:
    """The text of a double, from the JVM's text of it."""
    number = jvm_text.try_cast("double")
    return (F.when(jvm_text.endswith('Infinity"'), F.when(jvm_text.startswith('"-'), f"-{INFINITE}").otherwise(INFINITE))
            .otherwise(_let(number, lambda n: _let(_shortest(n), _laid_out))))


# ---------------------------------------------------------------------------
# In records of any declared schema
# ---------------------------------------------------------------------------


def kinds_schema(declared: T.DataType) -> T.DataType | None:
    """The part of a declared type that holds strings, with VARIANT in their place; None where it holds none."""
    if isinstance(declared, T.StringType):
        return T.VariantType()
    if isinstance(declared, T.ArrayType):
        inner = kinds_schema(declared.elementType)
        return None if inner is None else T.ArrayType(inner)
    if isinstance(declared, T.StructType):
        inner = [(f.name, kinds_schema(f.dataType)) for f in declared.fields]
        fields = [T.StructField(name, kind) for name, kind in inner if kind is not None]
        return T.StructType(fields) if fields else None
    return None


def _in_question(value: Column, declared: T.DataType) -> Column:
    """Whether a value holds a text that may be a double's."""
    if isinstance(declared, T.StringType):
        return F.coalesce(value.rlike(_DOUBLE_TEXT), F.lit(False))
    if isinstance(declared, T.ArrayType):
        return F.coalesce(F.exists(value, lambda v: _in_question(v, declared.elementType)), F.lit(False))
    parts = [_in_question(value.getField(f.name), f.dataType) for f in declared.fields if kinds_schema(f.dataType) is not None]
    out = parts[0]
    for part in parts[1:]:
        out = out | part
    return out


def _rendered(value: Column, kinds: Column, declared: T.DataType) -> Column:
    if kinds_schema(declared) is None:
        return value
    if isinstance(declared, T.StringType):
        number = value.rlike(_DOUBLE_TEXT) & F.schema_of_variant(kinds).rlike(_NUMBER_KIND)
        return F.when(number, double_text(value)).otherwise(value)
    if isinstance(declared, T.ArrayType):
        return F.zip_with(value, kinds, lambda v, k: _rendered(v, k, declared.elementType))
    fields = [(_rendered(value.getField(f.name), kinds.getField(f.name), f.dataType)
               if kinds_schema(f.dataType) is not None else value.getField(f.name)).alias(f.name) for f in declared.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def with_number_texts(records: Column, declared: T.ArrayType, kinds: Column) -> Column:
    """The records with the texts of doubles in their string columns; ``kinds``: the same records, parsed as
    :func:`kinds_schema` says (computed only where it is looked at)."""
    if kinds_schema(declared) is None:
        return records
    return F.when(_in_question(records, declared), _let(kinds, lambda k: _rendered(records, k, declared))).otherwise(records)
