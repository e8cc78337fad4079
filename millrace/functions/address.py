"""Province and city out of a postal address.

Three rules differ from a plain reading of the address conventions, on purpose:

* where an expected delimiter is missing or comes too early, and for a null address, the result is "no info";
* in the province branch an autonomous prefecture is cut at its own 州, counted from the start of the whole text;
* Tibet has a province name but no city rule, so its city is "no info".
"""

from functools import reduce

from pyspark.sql import Column, functions as F

from ..constants import NO_INFO

# Region spelling in an address -> province name. Checked in this order.
REGION_NAMES = {
    "内蒙古自治区": "内蒙古",
    "宁夏回族自治区": "宁夏",
    "西藏自治区": "西藏",
    "广西壮族自治区": "广西",
    "新疆维吾尔自治区": "新疆",
    "北京市": "北京",
    "上海市": "上海",
    "重庆市": "重庆",
    "天津市": "天津",
}
_PLAIN_REGIONS = ("内蒙古自治区", "宁夏回族自治区", "广西壮族自治区")
_PLAIN_CITIES = ("北京市", "上海市", "天津市")


def _first_match(cases: list[tuple[Column, Column]]) -> Column:
    head, *tail = cases
    chain = reduce(lambda acc, case: acc.when(*case), tail, F.when(*head))
    return F.coalesce(chain, F.lit(NO_INFO))


def _between(addr: Column, left: str, right: str) -> Column:
    """Text between the first ``left`` and the first ``right``; null unless they come in that order."""
    start, end = F.instr(addr, left), F.instr(addr, right)
    return F.when((start > 0) & (end > start), F.substring(addr, start + 1, end - start - 1))


def _before(text: Column, mark: str) -> Column:
    at = F.instr(text, mark)
    return F.when(at > 0, F.substring(text, F.lit(1), at - 1))


def _after(addr: Column, mark: str) -> Column:
    return F.substring(addr, F.instr(addr, mark) + 1, F.length(addr))


def province(addr: Column) -> Column:
    cases = [(addr.contains(spelling), F.lit(name)) for spelling, name in REGION_NAMES.items()]
    return _first_match(cases + [(addr.contains("省"), _before(addr, "省"))])


def city(addr: Column) -> Column:
    after_region, after_city, after_province = (_after(addr, m) for m in ("区", "市", "省"))
    xinjiang = F.coalesce(_between(addr, "区", "市"), _before(after_region, "区"), _before(after_region, "州"))
    chongqing = (
        F.when(after_city.contains("区"), _between(addr, "市", "区"))
        .when(after_city.contains("县"), _between(addr, "市", "县"))
    )
    in_province = (
        F.when(after_province.contains("市"), _between(addr, "省", "市"))
        .when(after_province.contains("自治州"), _before(after_province, "州"))
    )
    return _first_match(
        [(addr.contains(r), _between(addr, "区", "市")) for r in _PLAIN_REGIONS]
        + [(addr.contains("新疆维吾尔自治区"), xinjiang)]
        + [(addr.contains(c), _between(addr, "市", "区")) for c in _PLAIN_CITIES[:2]]
        + [(addr.contains("重庆市"), chongqing)]
        + [(addr.contains(c), _between(addr, "市", "区")) for c in _PLAIN_CITIES[2:]]
        + [(addr.contains("省"), in_province)]
    )


def repair(stored: Column, from_address: Column) -> Column:
    """Use the address only where the stored value is the "no info" text. A null stays null."""
    return F.when(stored == NO_INFO, from_address).otherwise(stored)
