"""Scalar expressions on transactions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str) -> Column:
    """Timestamp from text; unreadable text gives null instead of failing the job."""
    return col(c).try_cast("timestamp")


def hash_int(text: Column) -> Column:
    """28-bit integer from the leading hex digits of md5: same value on every engine."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")


def uniform(text: Column) -> Column:
    """Repeatable uniform number in [0, 1) that depends on the text alone."""
    return hash_int(text) / F.lit(268435456.0)


def keyed(key: Column | str, *parts: object) -> Column:
    """``key|part|part`` text, the argument of :func:`hash_int` and :func:`uniform`."""
    return F.concat_ws("|", col(key).cast("string"),
                       *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def cents(c: Column | str) -> Column:
    return F.round(col(c) * 100).cast("bigint")


_LOW_BITS = 24


def split_places(c: Column | str, places: int) -> tuple[Column, Column]:
    """Whole part (below 9.2e18) and digits behind the point (12 at most) as integers of one sign: what :func:`exact_sum` adds fast."""
    exact = col(c).cast(f"decimal(38,{places})")
    behind = (exact % F.lit(1).cast("decimal(1,0)")) * F.lit(10 ** places).cast("decimal(13,0)")
    return exact.cast("bigint"), behind.cast("bigint")


def _whole_sum(c: Column, bits: int) -> Column:
    """Sum of integers by their high and low bits, as a decimal."""
    high, low = F.sum(F.shiftright(c, bits)), F.sum(c.bitwiseAND(F.lit((1 << bits) - 1)))
    return high.cast("decimal(20,0)") * F.lit(1 << bits).cast("decimal(9,0)") + low.cast("decimal(20,0)")


def exact_sum(c: Column | str | tuple[Column, Column], places: int = 6) -> Column:
    """Sum in units of so many decimal places: no order of adding matters, and nothing of a cent is lost.

    Up to six places a value is a whole number of units (below 9.2e12 at six), whose high and low bits are added apart as plain integers: neither sum
    can overflow before 10^11 rows.  More places are added as decimals, or as integers too if they come from :func:`split_places`.
    A NaN or infinite value is an error.
    """
    if isinstance(c, tuple):
        whole, behind = (_whole_sum(part, _LOW_BITS) for part in c)
        return (whole.cast("decimal(25,0)") + (behind.cast("decimal(24,0)") * F.lit(f"1E-{places}").cast(f"decimal(12,{places})"))
                .cast(f"decimal(25,{places})")).cast("double")
    if places > 6:
        return F.sum(col(c).cast(f"decimal(38,{places})")).cast("double")
    units = F.round(col(c) * F.lit(float(10 ** places))).cast("bigint")
    return (_whole_sum(units, _LOW_BITS).cast("decimal(32,0)") / F.lit(10 ** places).cast("decimal(7,0)")).cast("double")


def exact_avg(c: Column | str | tuple[Column, Column], places: int = 6) -> Column:
    return exact_sum(c, places) / F.count(col(c[0] if isinstance(c, tuple) else c))


def price_per_unit(price: Column | str = "price_usd", quantity: Column | str = "quantity") -> Column:
    return col(price) / F.greatest(col(quantity), F.lit(1))


def cost_ratio(unit_cost: Column | str = "unit_cost", price: Column | str = "price_usd",
               quantity: Column | str = "quantity") -> Column:
    return col(unit_cost) / F.greatest(price_per_unit(price, quantity), F.lit(0.01))


def signed_log(c: Column | str) -> Column:
    return F.log1p(F.abs(col(c))) * F.signum(col(c))


def heuristic_price(quantity: Column | str = "quantity", unit_cost: Column | str = "unit_cost",
                    market_index: Column | str = "market_index") -> Column:
    """quantity x unit cost x market index to two decimals, in decimal arithmetic."""
    product = (col(quantity).cast("decimal(12,2)") * col(unit_cost).cast("decimal(14,6)")
               * col(market_index).cast("decimal(12,8)"))
    return F.round(product, 2).cast("double")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row.

    An expression named inside a higher-order function is otherwise repeated for every element.
    """
    return F.transform(F.array(value), use)[0]


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))
