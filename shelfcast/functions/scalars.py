"""Column expressions of the domain; everything stays inside whole-stage codegen."""

from pyspark.sql import functions as F

from shelfcast import constants as K


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c):
    """One kind of missing value: NaN becomes NULL."""
    return F.when(~F.isnan(_col(c)), _col(c))


def safe_divide(numerator, denominator, default=0.0):
    """Quotient, or `default` when the divisor is missing or about zero."""
    n, d = _col(numerator), _col(denominator)
    usable = F.abs(d) >= K.DIVISOR_FLOOR
    return F.when(usable, F.try_divide(n.cast("double"), d.cast("double"))).when(
        F.isnan(d.cast("double")), F.lit(float("nan"))
    ).otherwise(F.lit(default))


def week_start(c):
    """Monday of the ISO week, as a date."""
    return F.date_trunc("week", _col(c)).cast("date")


def parsed_week_start(c):
    """Monday of the ISO week of a text date; unreadable text raises (ANSI cast)."""
    return week_start(_col(c).cast("date"))


def month_start(c):
    return F.trunc(_col(c), "month")


def calendar_columns(week="week"):
    """ISO week number, calendar month and year, and the four season flags."""
    number, month = F.weekofyear(week), F.month(week)
    holiday = number.isin(*K.HOLIDAY_WEEKS).cast("int")
    return {
        "week_number": number,
        "month": month,
        "year": F.year(week),
        "is_holiday_week": holiday,
        "is_holiday_peak": holiday,
        "is_summer": month.isin(*K.SUMMER_MONTHS).cast("int"),
        "is_winter": month.isin(*K.WINTER_MONTHS).cast("int"),
    }


def encode(c, codes, unknown=K.UNKNOWN_CODE):
    """Ordinal code of an enumeration; anything unknown gets `unknown`."""
    branch = F.lit(unknown)
    for label, code in codes.items():
        branch = F.when(_col(c) == label, F.lit(code)).otherwise(branch)
    return branch


def category_from_sku(sku="sku"):
    """Category by the two-letter SKU prefix; unmapped prefixes give NULL."""
    pairs = [F.lit(x) for kv in K.CATEGORY_BY_PREFIX.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.substring(_col(sku), 1, 2))


def promo_rate(flag="promotion_flag"):
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(flag).cast("double")))


def delivery_indicator(columns, qty="delivered_qty"):
    """1 when something was delivered; 0 throughout when the column is absent."""
    if qty not in columns:
        return F.lit(0)
    return F.coalesce((F.col(qty) > 0).cast("int"), F.lit(0))


def revenue(units="units_sold", price="price_unit"):
    return _col(units).cast("double") * _col(price).cast("double")


def bracket(point, lower, upper):
    """Interval ends pulled to the point when they cross it."""
    return F.least(_col(lower), _col(point)), F.greatest(_col(upper), _col(point))


def season_label(holiday="is_holiday_week", summer="is_summer", winter="is_winter"):
    """Season by the exact flag triple; overlapping flags count as shoulder."""
    h, s, w = (_col(c) == 1 for c in (holiday, summer, winter))
    return (
        F.when(h & ~s & ~w, "holiday").when(~h & s & ~w, "summer")
        .when(~h & ~s & w, "winter").otherwise("shoulder")
    )


def model_name(category="category"):
    return F.concat(F.lit("forecaster_"), F.lower(F.regexp_replace(_col(category), " ", "_")))


def model_name_text(category):
    """The same name for a Python value."""
    return "forecaster_" + str(category).lower().replace(" ", "_")


def not_in(c, allowed):
    """True outside the enumeration; a missing value counts as outside."""
    return F.coalesce(~_col(c).isin(*allowed), F.lit(True))


def holds(condition):
    """Condition where an unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def valid_sku(c="sku"):
    return holds(_col(c).rlike(K.SKU_PATTERN))


def to_number(c):
    """Text or decimal to double; unreadable text becomes NULL."""
    return nan_to_null(_col(c).try_cast("double"))


def fixed_text(c, digits):
    """Number with a fixed count of decimals, exact halves going to the even digit."""
    value = _col(c).cast("double")
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def clamped_metric(c):
    """Metric limited to +-9999 and rounded to six decimals for its decimal column."""
    value = _col(c).cast("double")
    return F.round(F.greatest(F.lit(-K.METRIC_CLAMP), F.least(F.lit(K.METRIC_CLAMP), value)), 6)


def percent_change(value, base):
    return F.try_divide(_col(value) - _col(base), _col(base)) * 100.0


def lift_percent(promo, base):
    """100*(promo-base)/base, 0 when there is no base."""
    return 100.0 * safe_divide(_col(promo) - _col(base), base, 0.0)


def same_length(*arrays):
    """True when parallel arrays line up."""
    first = F.size(_col(arrays[0]))
    check = F.lit(True)
    for other in arrays[1:]:
        check = check & (F.size(_col(other)) == first)
    return check
