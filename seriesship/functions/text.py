"""Text forms that differ from Spark's own: floats, URL path parts, header names, HTTP dates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# The JDK's own text of a double is already shortest up to 15 digits. Beyond that older JDKs can print too
# many digits, so those values go through the shortest-digits routine that ships with Spark's JSON library.
SHORTEST = """
CASE WHEN length(string({x})) <= 16 THEN string({x})
ELSE reflect('com.fasterxml.jackson.core.io.schubfach.DoubleToDecimal', 'toString', {x}) END"""

# Java's ``d.dddE±x`` or plain decimal text ``t``, taken apart and put together in the target form.
PARTS = r"""
named_struct(
  'sign', if(startswith(t, '-'), '-', ''),
  'digits', trim(BOTH '0' FROM regexp_replace(t, r'^-|\.|E.*', '')),
  'exp10', CASE
    WHEN contains(t, 'E') THEN int(split_part(t, 'E', 2))
    WHEN NOT t RLIKE r'^-?0\.' THEN length(regexp_extract(t, r'^-?([0-9]+)\.', 1)) - 1
    ELSE -1 - length(regexp_extract(t, r'\.(0*)', 1)) END)"""
REBUILT = """
concat(p.sign, CASE
  WHEN p.exp10 < -4 OR p.exp10 >= 6 THEN concat(
    left(p.digits, 1), if(length(p.digits) > 1, '.', ''), substring(p.digits, 2),
    if(p.exp10 < 0, 'e-', 'e+'), if(abs(p.exp10) < 10, '0', ''), string(abs(p.exp10)))
  WHEN p.exp10 < 0 THEN concat('0.', repeat('0', -p.exp10 - 1), p.digits)
  WHEN length(p.digits) <= p.exp10 + 1 THEN concat(
    p.digits, repeat('0', p.exp10 + 1 - length(p.digits)))
  ELSE concat(left(p.digits, p.exp10 + 1), '.', substring(p.digits, p.exp10 + 2)) END)"""
# ``transform`` over one element names a value that is used several times.
BOUND = r"""
CASE WHEN {x} IS NULL THEN NULL
  WHEN isnan({x}) THEN 'NaN'
  WHEN {x} = double('Infinity') THEN '+Inf'
  WHEN {x} = double('-Infinity') THEN '-Inf'
  WHEN {x} = 0 THEN if(startswith(string({x}), '-'), '-0', '0')
  WHEN abs({x}) >= 1e-3 AND abs({x}) < 1e6 THEN regexp_replace({shortest}, r'\.0$', '')
  ELSE transform(array({shortest}), t -> transform(array({parts}), p -> {rebuilt})[0])[0] END"""


def format_bound(x: str) -> Column:
    """Text of a bucket bound or quantile, given the column's name.

    Shortest round-trip digits, exponent form only below 1e-4 or from 1e6 on. (Among subnormal doubles a
    few that one digit would identify keep two.)
    """
    sql = BOUND.format(x=x, shortest=SHORTEST.format(x=x), parts=PARTS, rebuilt=REBUILT)
    return F.expr(sql)


# Characters that stay readable inside one URL path part although form encoding
# escapes them.
PATH_SAFE = {"%24": "$", "%26": "&", "%2B": "+", "%3D": "=", "%3A": ":", "%40": "@", "%7E": "~"}


def path_escape(c: Column) -> Column:
    """Escape text for use as one part of a URL path."""
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    for code, char in PATH_SAFE.items():
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.replace(out, F.lit("*"), F.lit("%2A"))


HEADER_TOKEN = r"^[A-Za-z0-9!#$%&'*+\-.^_`|~]+$"


def header_name(c: Column) -> Column:
    """Canonical header spelling; names with characters outside the token set stay as they are."""
    parts = F.transform(
        F.split(c, "-"),
        lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2)))),
    )
    return F.when(c.rlike(HEADER_TOKEN), F.array_join(parts, "-")).otherwise(c)


def varint_len(n: Column) -> Column:
    """Number of bytes of ``n`` as a base-128 varint."""
    out = F.lit(9)
    for size in range(8, 0, -1):
        out = F.when(n < (1 << (7 * size)), size).otherwise(out)
    return out


def framed_len(c: Column) -> Column:
    """Bytes of a length-prefixed text or binary field; null counts as empty."""
    return let(
        F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint"), lambda n: varint_len(n) + n
    )


HTTP_DATE = (
    r"^(?i:Mon|Tue|Wed|Thu|Fri|Sat|Sun), "
    r"([0-9]{2} (?i:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) [0-9]{4} "
    r"[0-9]{1,2}:[0-9]{2}:[0-9]{2}) GMT$"
)


def retry_after_ms(header: Column, at_ms: Column) -> Column:
    """Wait asked for by a Retry-After header: positive whole seconds, or a future HTTP date."""
    seconds = F.when(header.rlike(r"\A[+-]?[0-9]+\z"), header.try_cast("bigint"))
    # The zone is written out, so the session's own zone does not matter.
    stamp = F.initcap(F.nullif(F.regexp_extract(header, HTTP_DATE, 1), F.lit("")))
    date = F.try_to_timestamp(F.concat(stamp, F.lit("Z")), F.lit("dd MMM yyyy H:mm:ssX"))
    left = F.unix_millis(date) - at_ms
    return F.coalesce(
        F.when(seconds > 0, F.try_multiply(seconds, F.lit(1000))),
        F.when(left > 0, left),
        F.lit(0).cast("bigint"),
    )
