"""Column builders for derived features. All are built-in expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_text(c) -> Column:
    """A value rendered as text the way a missing float prints: null -> 'nan'."""
    return F.coalesce(_c(c).cast("string"), F.lit("nan"))


def country_state(exchange="exchange2", country="loc_country", state="loc_state") -> Column:
    """adx keeps the state (null stays null); otherwise ``country:state`` with
    null rendered as ``nan``. A null exchange takes the otherwise branch."""
    is_adx = F.coalesce(_c(exchange) == F.lit("adx"), F.lit(False))
    return F.when(is_adx, _c(state)).otherwise(F.concat(nan_text(country), F.lit(":"), nan_text(state)))


def country_state_city(exchange="exchange2", cstate="country_state", city="loc_city") -> Column:
    """adx keeps the city; otherwise ``country_state:city``, same null rule."""
    is_adx = F.coalesce(_c(exchange) == F.lit("adx"), F.lit(False))
    return F.when(is_adx, _c(city)).otherwise(F.concat(nan_text(cstate), F.lit(":"), nan_text(city)))


def offset_hours(offset) -> Column:
    """Offset text -> whole hours. Backslashes removed, a bare ``N`` (from ``\\N``) is 0,
    null or unparsable is 0."""
    s = F.regexp_replace(_c(offset).cast("string"), r"\\", "")
    s = F.when(s == F.lit("N"), F.lit("0")).otherwise(s)
    return F.coalesce(s.try_cast("int"), F.lit(0))


def shifted(ts, offset) -> Column:
    return _c(ts) + F.make_dt_interval(F.lit(0), offset_hours(offset))


def hour_of_week(ts="timestamp", offset="timezone_offset") -> Column:
    """hour of week as text 0..167, Sunday = day 0, after shifting by the offset."""
    t = shifted(ts, offset)
    return ((F.dayofweek(t) - 1) * 24 + F.hour(t)).cast("string")


def hour_of_week_mod(ts, tz_hours) -> Column:
    """``(day*24 + hour + 168 + tz) mod 168`` at request time (UTC clock)."""
    return F.pmod((F.dayofweek(_c(ts)) - 1) * 24 + F.hour(_c(ts)) + _c(tz_hours), F.lit(168))


def time_of_day(ts, tz_hours) -> Column:
    """F16: ``(hour + tz) mod 24``, always 0..23."""
    return F.pmod(F.hour(_c(ts)) + _c(tz_hours), F.lit(24))


def label_value(c) -> Column:
    """Label text -> 0/1 int; null (or unparsable) -> 0."""
    return F.coalesce(_c(c).cast("string").try_cast("int"), F.lit(0))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: leading/trailing whitespace incl. tabs and newlines."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def formats_feature(name: str, widths, heights) -> Column:
    """non-empty width and height lists -> ``name[`` + ``WxH:`` per pair (the
    closing bracket is never written); otherwise ``name`` + ``w`` + ``x`` + ``h``."""
    w, h = _c(widths), _c(heights)
    pairs = F.arrays_zip(w.alias("w"), h.alias("h"))
    cut = F.slice(pairs, 1, F.least(F.size(w), F.size(h)))
    body = F.array_join(F.transform(cut, lambda p: F.concat(p["w"].cast("string"), F.lit("x"),
                                                             p["h"].cast("string"), F.lit(":"))), "")
    both = (F.size(w) > 0) & (F.size(h) > 0)
    plain = F.concat(F.lit(name), F.array_join(w, ","), F.lit("x"), F.array_join(h, ","))
    return F.when(both, F.concat(F.lit(name + "["), body)).otherwise(plain)


def ad_type_feature(name: str, value) -> Column:
    """``nativead`` -> name + value, anything else -> name + OTHER."""
    return F.when(_c(value) == F.lit("nativead"), F.concat(F.lit(name), _c(value))) \
            .otherwise(F.lit(name + "OTHER"))


def zip_feature(name: str, value) -> Column:
    """remove spaces."""
    return F.concat(F.lit(name), F.replace(_c(value), F.lit(" "), F.lit("")))


def url_host(url) -> Column:
    """Host of a URL; a value that does not parse as a URL is returned as is."""
    u = _c(url)
    return F.coalesce(F.try_parse_url(u, F.lit("HOST")), u)


def domain_feature(name: str, url) -> Column:
    """name + host of the page or bundle."""
    return F.concat(F.lit(name), url_host(url))
