"""Python's reading of JSON values and numbers, as column expressions over what Spark's JSON parser returns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .metrics import double_text

# What Python's float() reads, apart from digits beyond ASCII.
FLOAT_TEXT = (r"(?i)^\s*[+-]?(?:(?:\d(?:_?\d)*\.?(?:\d(?:_?\d)*)?|\.\d(?:_?\d)*)(?:e[+-]?\d(?:_?\d)*)?"
              r"|inf(?:inity)?|nan)\s*$")
_JSON_SPACE = " \t\n\r"
_JSON_NUMBER = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?$"
_TOKENS = r'"(?:[^"\\]++|\\.)*+"|[\[\]{},:]|[^"\[\]{},:\s]++'
_INTEGER = r"^-?[0-9]+$"


def is_falsy(value: Column) -> Column:
    """Whether text is JSON of a falsy value other than an object: null, false, zero, an empty text or list, in any spelling."""
    v = F.btrim(value, F.lit(_JSON_SPACE))
    first = F.ascii(v)
    zero = first.isin(45, 48) & v.rlike(_JSON_NUMBER) & (F.abs(v.try_cast("double")) == 0)
    tiny = first.between(49, 57) & v.rlike(_JSON_NUMBER) & (v.try_cast("double") == 0)
    return v.isin("null", "false", '""') | zero | tiny | ((first == 91) & v.rlike(r"^\[[ \t\n\r]*\]$"))


def number(text: Column) -> Column:
    """Double of text that Python's float() reads, else NULL.

    Text that begins and ends like a plain number is cast as it is; only other text is held against the full pattern.
    """
    first, last = F.ascii(text), F.ascii(F.right(text, F.lit(1)))
    plain = (first.between(48, 57) | first.isin(43, 45, 46)) & (last.between(48, 57) | (last == 46)) & (F.length(text) < 24)
    plain = plain & ~F.contains(text, F.lit("_")) & ~F.contains(F.lower(text), F.lit("x"))
    return (F.when(plain, text.try_cast("double"))
            .when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")))


def _quoted(token: Column) -> Column:
    """Python's repr of a JSON string token as Spark's parser writes it."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    held = F.replace(inner, F.lit("\\\\"), F.lit("\x01"))
    held = F.replace(F.replace(F.replace(held, F.lit('\\"'), F.lit('"')), F.lit("\\b"), F.lit("\\x08")), F.lit("\\f"), F.lit("\\x0c"))
    held = F.regexp_replace(held, r"\\u00([01][0-9A-Fa-f])", r"\\x$1")
    for digit in "ABCDEF":
        held = F.replace(F.replace(held, F.lit(f"\\x0{digit}"), F.lit(f"\\x0{digit.lower()}")), F.lit(f"\\x1{digit}"), F.lit(f"\\x1{digit.lower()}"))
    held = F.replace(held, F.lit("\x7f"), F.lit("\\x7f"))
    double = F.contains(held, F.lit("'")) & ~F.contains(held, F.lit('"'))
    held = F.when(double, held).otherwise(F.replace(held, F.lit("'"), F.lit("\\'")))
    mark = F.when(double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(mark, F.replace(held, F.lit("\x01"), F.lit("\\\\")), mark)


def number_text(raw: Column) -> Column:
    """Python's text of a JSON number: digits of an integer, else the float's."""
    return F.when(raw.rlike(_INTEGER), raw).otherwise(double_text(F.btrim(raw, F.lit('"')).try_cast("double")))


def nested_text(raw: Column) -> Column:
    """Python's text of a list or an object, from its JSON: the value's tokens, each in Python's form."""
    def in_python(t: Column) -> Column:
        return (F.when(t == ",", F.lit(", ")).when(t == ":", F.lit(": ")).when(t.isin("[", "]", "{", "}"), t)
                .when(t.isin("true", "false"), F.initcap(t)).when(t == "null", F.lit("None"))
                .when(F.startswith(t, F.lit('"')), _quoted(t)).otherwise(number_text(t)))
    return F.array_join(F.transform(F.regexp_extract_all(raw, F.lit(_TOKENS), F.lit(0)), in_python), "")
