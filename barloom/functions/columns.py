"""Column functions: codes, dates, clock and amount texts, scalers and predicates."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of amounts and words that mark a first board.
YI, WAN, YUAN, FIRST_BOARD = "亿", "万", "元", "首板"
#: Words by which finance themes are related.
FINANCE = ("业绩", "预增", "预减", "扭亏", "年报", "半年报", "季报", "送转", "高送转", "增长")
#: Bigrams too general to relate two names.
GENERIC = ("概念", "板块", "指数", "龙头", "产业链", "制造")


def norm_date(c: Column) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD``, also with a trailing ``.0``, to a date; anything else null."""
    digits = F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), r"\.0$", ""), "-", "")
    return F.when(digits.rlike(r"^\d{8}$"), F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def norm_code(c: Column) -> Column:
    """``600519``, ``sh.600519`` and ``600519.SH`` to ``sh.600519``; the market follows from the first digit."""
    bare = F.regexp_extract(c, r"(\d{6})", 1)
    first = F.substring(bare, 1, 1)
    return (
        F.when(first == "6", F.concat(F.lit("sh."), bare))
        .when(first.isin("0", "2", "3"), F.concat(F.lit("sz."), bare))
        .otherwise(F.raise_error(F.concat(F.lit("no market for code "), F.coalesce(c, F.lit("null")))))
    )


def bare_code(c: Column) -> Column:
    """The six digits of a code, padded from the left; '' if there are none."""
    digits = F.regexp_extract(c, r"(\d+)", 1)
    return F.when(digits == "", "").otherwise(F.lpad(digits, 6, "0"))


def price_limit(code: Column, is_st: Column, is_new: Column) -> Column:
    """Daily limit as a fraction by board; -1 for unknown boards."""
    bare = F.regexp_extract(code, r"(\d{2})", 1)
    st, new = F.coalesce(is_st, F.lit(0)) == 1, F.coalesce(is_new, F.lit(0)) == 1
    main, growth, north = bare.isin("00", "60"), bare.isin("30", "68"), bare.isin("43", "83", "87", "88")
    return (
        F.when(north, F.when(new, 0.0).otherwise(0.3))
        .when(main | growth, F.when(new, 0.44).otherwise(F.when(growth, 0.2).otherwise(F.when(st, 0.05).otherwise(0.1))))
        .otherwise(-1.0)
    )


def is_st_name(c: Column) -> Column:
    return F.upper(F.trim(c)).rlike(r"^(?:XD|XR|DR|S)*\*?ST")


def session_minute(c: Column) -> Column:
    """A clock text's minutes since 9:30 without the lunch break; null outside sessions."""
    h = F.regexp_extract(c, r"(\d{1,2}):(\d{2})(?::\d{2})?\s*$", 1).try_cast("int")
    m = F.regexp_extract(c, r"(\d{1,2}):(\d{2})(?::\d{2})?\s*$", 2).try_cast("int")
    t = h * 60 + m - 570
    return F.when((t >= -15) & (t < 0), 0).when((t >= 0) & (t <= 120), t).when((t >= 210) & (t <= 330), t - 90)


def cn_number(c: Column) -> Column:
    """Amount text with commas and 亿 or 万 to a number."""
    t = F.trim(F.regexp_replace(c, ",", ""))
    unit = F.when(t.contains(YI), 1e8).when(t.contains(WAN), 1e4).otherwise(1.0)
    return F.when(~t.isin("", "--"), F.regexp_replace(t, f"[{YI}{WAN}]", "").try_cast("double") * unit)


def cn_wan(c: Column) -> Column:
    """Amount text in ten-thousands: first unsigned number, sign of a leading minus; null is 0."""
    t = F.trim(F.regexp_replace(c, ",", ""))
    n = F.regexp_extract(t, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    unit = F.when(t.contains(YI), 1e4).when(t.contains(WAN), 1.0).when(t.contains(YUAN), 1e-4).otherwise(1.0)
    return F.coalesce(n * unit * F.when(t.startswith("-"), -1.0).otherwise(1.0), F.lit(0.0))


def days_boards(c: Column) -> Column:
    """struct(days, boards) of "N days M boards"."""
    d, b = (F.regexp_extract(c, r"^(\d+)\D+(\d+)", i).try_cast("int") for i in (1, 2))
    one = F.coalesce(c.contains(FIRST_BOARD), F.lit(False))
    return F.struct(F.when(one, 1).otherwise(F.coalesce(d, F.lit(0))).alias("days"), F.when(one, 1).otherwise(F.coalesce(b, F.lit(0))).alias("boards"))


def lots_to_shares(c: Column) -> Column:
    return F.bround(c * 100, 0)


def thousands_to_units(c: Column) -> Column:
    return F.bround(c * 1000, 4)


def epoch_to_date(ms: Column, shift_days: int = 0, zone: str = "Asia/Shanghai") -> Column:
    """The local date of epoch milliseconds."""
    return F.date_add(F.from_utc_timestamp(F.timestamp_millis(ms), zone).cast("date"), shift_days)


def log_scale(c: Column, cap: float) -> Column:
    return F.log1p(c) / F.log1p(F.lit(float(cap)))


def cap_scale(c: Column, cap: float) -> Column:
    return F.least(c, F.lit(cap)) / F.lit(float(cap))


def first_minute_scale(c: Column) -> Column:
    return F.coalesce(c, F.lit(240)) / 240.0


def decay(c: Column, tau: float = 240.0) -> Column:
    return F.exp(-c / tau)


def clean_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


# fixed values: how brackets in names, and a reason's "parent(child)" head, are matched
SHORTEST_BRACKET = r"[（(].*?[)）]"
BRACKET = r"[（(][^（）()]*[）)]"
BRACKET_CONTENT = r"[（(]([^（）()]*)[）)]"
REASON_HEAD = r"^([^；;+，,（()）]{1,12})[（(]([^）()]{1,15})[）)]"


def fold_name(c: Column) -> Column:
    """Without white space around it or full-width spaces in it, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), "　", ""))


def strip_brackets(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BRACKET, ""))


def bracket_content(c: Column) -> Column:
    return F.trim(F.regexp_extract(c, BRACKET_CONTENT, 1))


def _bigrams(c: Column) -> Column:
    n = F.greatest(F.length(c) - 1, F.lit(0))
    return F.filter(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(c, i, F.lit(2))), lambda x: F.length(x) == 2)


def names_related(a: Column, b: Column) -> Column:
    """Containment either way (raw or without brackets), a shared finance word, or a shared specific bigram."""
    a, b = fold_name(a), fold_name(b)
    forms = [(x, y) for x in (a, F.regexp_replace(a, SHORTEST_BRACKET, "")) for y in (b, F.regexp_replace(b, SHORTEST_BRACKET, ""))]
    held = functools.reduce(operator.or_, [(F.length(x) > 0) & (F.length(y) > 0) & (x.contains(y) | y.contains(x)) for x, y in forms])
    finance = functools.reduce(operator.or_, [a.contains(w) for w in FINANCE]) & functools.reduce(operator.or_, [b.contains(w) for w in FINANCE])
    general = F.array(*[F.lit(w) for w in GENERIC])
    return held | finance | F.arrays_overlap(F.array_except(_bigrams(a), general), _bigrams(b))


def rel_move(pct: Column, limit: Column) -> Column:
    return F.try_divide(pct / 100, limit)


def big_moves(pct: Column, limit: Column) -> tuple[Column, Column]:
    rel, ok = rel_move(pct, limit), limit >= 0.04
    return F.when(ok & (rel >= 0.7), 1).otherwise(0), F.when(ok & (rel <= -0.7), 1).otherwise(0)


def float_cap(amount: Column, turn: Column) -> Column:
    return F.when((turn > 0.05) & (amount > 0), amount * 100 / turn)


def null_to_zero(c: Column) -> Column:
    c = c.cast("double")
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def em_codes(c: Column) -> Column:
    """``[01].`` and six digits to six digits; others drop."""
    return F.transform(F.filter(c, lambda x: x.rlike(r"^[01]\.\d{6}$")), lambda x: F.substring(x, 3, 6))


def cls_codes(c: Column) -> Column:
    return F.transform(F.filter(c, lambda x: x.rlike(r"^(?:sh|sz)\d{6}$")), lambda x: F.substring(x, 3, 6))


def m15_time(c: Column) -> Column:
    """HHMM as an int; longer stamps give their characters 9 to 12."""
    t = c.cast("string")
    return F.when(F.length(t) > 4, F.substring(t, 9, 4)).otherwise(t).try_cast("int")
