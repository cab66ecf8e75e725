"""Strict JSON parsing and key tests on VARIANT values.

``try_parse_json`` stops after the first complete JSON value and ignores what
follows (``{"a":1} x`` parses). To demand that the whole text is one value,
the text is parsed as the first element of an array whose second, last
element is the text's own MD5: ``[<text>,"<md5>"]``. A text cannot hold its
own hash, so anything but one JSON value either breaks the parse, ends the
array before the hash, or moves it from the second place. One parse decides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(*keys: str) -> str:
    return "$" + "".join('["' + k + '"]' for k in keys)


def wrap_parse(text: Column) -> Column:
    """Parse ``text`` inside the array (step 1 of the strict parse).

    Keep it in its own column so the parse runs once per row.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.md5(text.cast("binary")), F.lit('"]')))


def wrapped_ok(wrapped: Column, text: Column) -> Column:
    """True when the text was exactly one JSON value (step 2)."""
    last = F.try_variant_get(wrapped, "$[1]", "string") == F.md5(text.cast("binary"))
    return F.coalesce(last, F.lit(False)) & F.try_variant_get(wrapped, "$[2]", "variant").isNull()


def in_wrapper(wrapped: Column, keys: tuple[str, ...] | str, type_: str) -> Column:
    """Read a path of the wrapped value without first copying the value out."""
    if isinstance(keys, str):
        keys = (keys,)
    return F.try_variant_get(wrapped, "$[0]" + _path(*keys)[1:], type_)


def is_object_text(text: Column) -> Column:
    """For a text known to hold one JSON value: is that value an object.

    JSON whitespace is space, tab, CR and LF; the first other character
    decides the type, so no walk over the parsed value is needed.
    """
    return F.regexp_like(text, F.lit(r"^[ \t\r\n]*\{"))


def get(doc: Column, keys: tuple[str, ...] | str, type_: str) -> Column:
    if isinstance(keys, str):
        keys = (keys,)
    return F.try_variant_get(doc, _path(*keys), type_)
