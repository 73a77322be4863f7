"""Protected regions: masked by tokens, restored exactly. Row-local expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import patterns as P


def protected(text: Column) -> Column:
    """The protected regions of a text, in order."""
    return F.regexp_extract_all(text, F.lit(P.PROTECTED), F.lit(0))


def _between(text: Column) -> Column:
    return F.split(text, P.PROTECTED, -1)


def kind(payload: Column) -> Column:
    low = F.lower(payload)
    return F.when(low.startswith("<table"), "TAB").when(payload.startswith("!["), "IMG").when(payload.startswith("<!--"), "CMT").otherwise("MATH")


def placeholders(text: Column) -> Column:
    """array<struct<token, payload>>: <<TAB_0>> and so on, one running number."""
    return F.transform(protected(text), lambda p, i: F.struct(F.concat(F.lit("<<"), kind(p), F.lit("_"), i.cast("string"), F.lit(">>")).alias("token"), p.alias("payload")))


def mask(text: Column, tokens: Column) -> Column:
    """The text with its regions replaced by tokens (an array of as many strings)."""
    plain = _between(text)
    return F.array_join(F.zip_with(plain, tokens, lambda a, t: F.concat(a, F.coalesce(t, F.lit("")))), "")


def mask_protected(text: Column) -> Column:
    """The text with <<KIND_n>> tokens."""
    return mask(text, F.transform(placeholders(text), lambda h: h["token"]))


def unmask(text: Column, holders: Column) -> Column:
    """Tokens replaced by their payloads; missing tokens are let be."""
    return F.aggregate(holders, text, lambda t, h: F.replace(t, h["token"], h["payload"]))


def tokens_kept(text: Column, holders: Column) -> Column:
    """Whether every token is still there."""
    return F.forall(holders, lambda h: text.contains(h["token"]))


def shield(text: Column) -> Column:
    """The text with neutral tokens NUL P n NUL, which no text rule touches."""
    return mask(text, F.transform(protected(text), lambda _, i: F.concat(F.lit("\0P"), i.cast("string"), F.lit("\0"))))


def unshield(text: Column, regions: Column) -> Column:
    """Regions put back where their neutral tokens stand."""
    token = r"\x00P(\d+)\x00"
    numbers = F.regexp_extract_all(text, F.lit(token), F.lit(1))
    back = F.transform(numbers, lambda n: F.get(regions, n.cast("int")))
    return F.array_join(F.zip_with(F.split(text, token, -1), back, lambda a, p: F.concat(a, F.coalesce(p, F.lit("")))), "")
