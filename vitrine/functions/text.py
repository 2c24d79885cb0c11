"""Scalar text functions as Column expressions.

Everything here is a composition of built-in Spark functions, so it stays inside
the JVM and can be used in any select, filter or streaming query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

# Accepted spellings of "true" in source data.
TRUE_WORDS = ("true", "yes", "1", "on", "available", "in stock")

# Fixed value: accepted e-mail shape.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# White space as text tools mean it: the Unicode property plus the four ASCII
# separators.  A plain ``trim`` would only remove the blank.
_WS = r"[\s\x1c-\x1f]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate an expensive value once although ``body`` names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def settled(value: Column) -> Column:
    """The value, in a projection that filters are not pushed through.

    Spark moves a filter on a derived column below the projection and copies the
    deriving expression into it, once per mention.  That is right for cheap
    expressions and ruinous for selectors over page nodes.  A non-deterministic
    part stops the move; here it is a test that always holds.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def strip(c: Column) -> Column:
    """Remove white space at both ends."""
    return F.regexp_replace(c, rf"(?U)^{_WS}+|{_WS}+$", "")


def collapse(c: Column) -> Column:
    """Strip, and turn each inner run of white space into one blank."""
    return F.trim(F.regexp_replace(c, rf"(?U){_WS}+", " "))


def parse_price(c: Column) -> Column:
    """``'Цена: 1 234,50 РУБ'`` -> 1234.5; text that is no number -> null."""
    kept = F.regexp_replace(c, r"[^0-9.,]", "")
    return F.translate(kept, ",", ".").try_cast("double")


def calculate_discount(original: Column, current: Column) -> Column:
    """Whole percent between two prices, truncated and kept within 0..100."""
    percent = (original - current) / original * 100
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(100.0), percent))
    return F.when((original > 0) & (current != 0), bounded.cast("int"))


def clean_title(c: Column) -> Column:
    return F.coalesce(collapse(c), F.lit(""))


def extract_number(c: Column) -> Column:
    """First run of digits as a whole number."""
    return F.regexp_extract(c, r"\d+", 0).try_cast("bigint")


def extract_float(c: Column) -> Column:
    """First ``12`` or ``12.5``; the sign is not read and a comma ends it."""
    return F.regexp_extract(c, r"\d+\.?\d*", 0).try_cast("double")


def is_valid_email(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL_PATTERN), F.lit(False))


def normalize_bool(c: Column, dtype: T.DataType | None = None) -> Column:
    """Truth of a boolean, a number or a word; ``dtype`` defaults to string."""
    if isinstance(dtype, T.BooleanType):
        truth = c
    elif isinstance(dtype, T.NumericType):
        truth = c != 0
    else:
        truth = F.lower(strip(c)).isin(*TRUE_WORDS)
    return F.coalesce(truth, F.lit(False))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c.cast("string")) == "")


def required_error(c: Column, name: str) -> Column:
    """Message when the value is null or blank, else null."""
    return F.when(is_blank(c), F.lit(f"Required field '{name}' is missing"))


def require(c: Column, name: str) -> Column:
    """The value itself; the query fails when it is null or blank."""
    message = F.lit(f"Required field '{name}' is missing")
    return F.when(is_blank(c), F.raise_error(message)).otherwise(c)


def is_url(c: Column) -> Column:
    """Both a scheme and a host are present."""
    return F.coalesce(c.rlike(r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+"), F.lit(False))


def _without_dots(path: Column) -> Column:
    """Fold ``.`` and ``..`` out of an absolute path."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    ends_open = path.rlike(r"/\.{1,2}$")
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc)
        .when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))),
    )
    tail = F.when(ends_open & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(folded, "/"), tail)
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), joined).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` as found on the page at ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    no_fragment = F.regexp_extract(base, r"^[^#]*", 0)
    no_query = F.regexp_extract(base, r"^[^?#]*", 0)
    folder = F.regexp_extract(
        F.substr(no_query, F.length(origin) + 1), r"^.*/", 0
    )
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    raw = F.when(href.startswith("/"), href).otherwise(F.concat(folder, href))
    path = F.regexp_extract(raw, r"^[^?#]*", 0)
    rest = F.substr(raw, F.length(path) + 1)
    return (
        F.when(href.isNull() | base.isNull(), F.lit(None).cast("string"))
        .when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(origin, _without_dots(path), rest))
    )


def normalize_url(base: Column, url: Column) -> Column:
    """Image and video addresses: absolute kept, ``//x`` -> ``https://x``."""
    u = strip(url)
    return (
        F.when(url.isNull() | (url == ""), F.lit(None).cast("string"))
        .when(u.rlike("^https?://"), u)
        .when(u.startswith("//"), F.concat(F.lit("https:"), u))
        .otherwise(resolve_url(base, u))
    )


def take_first(values: Column) -> Column:
    """First entry that is neither null nor empty."""
    return F.try_element_at(
        F.filter(values, lambda v: v.isNotNull() & (v.cast("string") != "")), F.lit(1)
    )


def first_value(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def float_value(values: Column) -> Column:
    return first_value(values).try_cast("double")


def int_value(values: Column) -> Column:
    """Whole number of the first entry; ``'1.5'`` is no whole number -> null."""
    first = strip(first_value(values).cast("string"))
    return F.when(first.rlike(r"^[+-]?\d+$"), first.try_cast("bigint"))


def bool_value(values: Column) -> Column:
    return normalize_bool(first_value(values).cast("string"))


def error_class(error_type: Column, status: Column) -> Column:
    """Class of a failed request, first match wins."""
    return (
        F.when(error_type == "DNSLookupError", F.lit("dns"))
        .when(error_type == "TimeoutError", F.lit("timeout"))
        .when(error_type == "ConnectionRefusedError", F.lit("refused"))
        .when(status.isNotNull(), F.concat(F.lit("http_"), status.cast("string")))
        .otherwise(F.lit("other"))
    )


def error_message(error_type: Column, status: Column, url: Column, message: Column) -> Column:
    """Log line for a failed request, same order as :func:`error_class`."""
    on_url = F.concat(F.lit(" on "), url)
    return (
        F.when(error_type == "DNSLookupError", F.concat(F.lit("DNS Lookup Error"), on_url))
        .when(error_type == "TimeoutError", F.concat(F.lit("Timeout Error"), on_url))
        .when(error_type == "ConnectionRefusedError", F.concat(F.lit("Connection Refused"), on_url))
        .when(status.isNotNull(), F.concat(F.lit("HTTP Error "), status.cast("string"), on_url))
        .otherwise(F.concat(F.lit("Error "), error_type, on_url, F.lit(": "), message))
    )
