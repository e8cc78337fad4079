"""Golden values of the scalar functions, edge rows included."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import constants as C
from millrace.functions import address, cleansing, dates, money, text

NONE = C.NO_INFO


def results(rows, values, fn):
    df = rows([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", fn(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(df.collect())]


def check(rows, fn, cases):
    assert results(rows, [v for v, _ in cases], fn) == [want for _, want in cases]


def test_province(rows):
    check(rows, address.province, [
        ("内蒙古自治区包头市", "内蒙古"), ("宁夏回族自治区银川市", "宁夏"), ("西藏自治区拉萨市", "西藏"),
        ("广西壮族自治区南宁市", "广西"), ("新疆维吾尔自治区喀什", "新疆"), ("北京市海淀区", "北京"), ("上海市徐汇区", "上海"),
        ("重庆市渝中区", "重庆"), ("天津市河西区", "天津"), ("湖南省长沙市", "湖南"), ("位于北京市东城区", "北京"),
        ("纽约", NONE), ("", NONE), (None, NONE), ("省会", ""),
    ])


def test_city(rows):
    check(rows, address.city, [
        ("内蒙古自治区包头市昆区", "包头"), ("宁夏回族自治区银川市", "银川"), ("广西壮族自治区南宁市", "南宁"),
        ("新疆维吾尔自治区乌鲁木齐市天山区", "乌鲁木齐"), ("新疆维吾尔自治区喀什地区莎车县", "喀什地"),
        ("新疆维吾尔自治区伊犁哈萨克自治州", "伊犁哈萨克自治"), ("新疆维吾尔自治区某县", NONE),
        ("北京市海淀区", "海淀"), ("上海市徐汇区", "徐汇"), ("天津市河西区", "河西"), ("北京市某县", NONE),
        ("重庆市渝中区", "渝中"), ("重庆市云阳县", "云阳"), ("重庆市某乡", NONE),
        ("湖南省长沙市岳麓区", "长沙"), ("四川省甘孜藏族自治州康定县", "甘孜藏族自治"), ("海南省某县", NONE),
        ("西藏自治区拉萨市", NONE), ("内蒙古自治区阿拉善盟", NONE), ("东区西区上海市", NONE), ("市四川省绵阳市", NONE),
        ("", NONE), (None, NONE),
    ])


def test_repair_only_where_unknown(rows):
    df = rows(
        [("1", NONE, NONE, "湖南省长沙市"), ("2", "河北", "保定", "湖南省长沙市"), ("3", None, NONE, None)],
        "mid string, province string, city string, address string",
    )
    got = {r["mid"]: (r["province"], r["city"]) for r in cleansing.clean_machine_local(df).collect()}
    assert got == {"1": ("湖南", "长沙"), "2": ("河北", "保定"), "3": (None, NONE)}


def test_singer(rows):
    check(rows, cleansing.singer_name, [
        ('[{"name":"甲","id":"1"},{"name":"乙"}]', "甲"), ("[]", C.UNKNOWN_SINGER), ("", C.UNKNOWN_SINGER),
        (None, C.UNKNOWN_SINGER), ('[{"id":"1"}]', C.UNKNOWN_SINGER), (NONE, C.UNKNOWN_SINGER),
    ])


def test_album(rows):
    check(rows, cleansing.album_name, [
        ('[{"name":"专辑","id":1}]', "专辑"), ("见《一》和《二》", "《一》"), ("[]", C.NO_ALBUM), ("无", C.NO_ALBUM),
        ("", C.NO_ALBUM), (None, C.NO_ALBUM), ("只有《半", C.NO_ALBUM), ('[{"id":1}]', C.NO_ALBUM),
    ])


def test_company(rows):
    check(rows, cleansing.company_name, [
        ('{"name":"公司","id":1}', "公司"), ('{"id":1}', C.DEFAULT_COMPANY), (NONE, C.DEFAULT_COMPANY),
        ("", C.DEFAULT_COMPANY), (None, C.DEFAULT_COMPANY), ("[]", C.DEFAULT_COMPANY),
    ])


def test_format_date(rows):
    check(rows, dates.format_date, [
        ("2003-08-19 01:02:03", "2003-08-19 01:02:03"), ("2003-08-19 01:02:03.0", "2003-08-19 01:02:03"),
        ("0.0", "1970-01-01 00:00:00"), ("1620470362998", "2021-05-08 10:39:22"), ("1620470362998.9", "2021-05-08 10:39:22"),
        ("1.620470362998E12", "2021-05-08 10:39:22"), ("-1000", "1969-12-31 23:59:59"), ("2003-08-19", ""), ("2021-5-1 8:03:00", "2021-05-01 08:03:00"), ("2021-5-1 8:3:0.5", "2021-05-01 08:03:00"),
        ("2003-13-19 00:00:00", ""), ("soon", ""), ("", ""), (None, ""), ("9" * 30, ""),
    ])


def test_text_helpers(rows):
    check(rows, text.check_string, [("a", "a"), ("", NONE), ("[]", NONE), (None, NONE), (" ", " ")])
    check(rows, text.is_empty, [("a", False), ("", True), (None, True), ("[]", False)])
    check(rows, text.str_to_int, [("12", 12), ("", 0), (None, 0), ("-3", -3), ("x", None)])
    check(rows, text.split_cols, [("a,b", ["a", "b"]), ("a", ["a"]), ("a,,b,,", ["a", "", "b"]), (None, None)])


def test_address_leaves_out_missing_parts(rows):
    df = rows([("a", "b"), (None, "b"), ("a", None), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(text.join_address(F.col("x"), F.col("y"))).collect()] == ["ab", "b", "a", ""]


def test_epoch_texts(rows):
    df = rows([(1620470362998,)], "ms long").select(dates.epoch_date(F.col("ms")), dates.epoch_datetime(F.col("ms")))
    assert tuple(df.first()) == ("2021-05-08", "2021-05-08 10:39:22")
    far = rows([(99999999999999999,)], "ms long").select(dates.epoch_date(F.col("ms")), dates.epoch_datetime(F.col("ms")))
    assert tuple(far.first()) == (None, None)


@pytest.mark.parametrize("amount, rate, want", [
    ("300", "40.0", "120.00"), ("0.05", "50", "0.03"), ("10", None, "0.00"), ("10", "none", "0.00"), ("-300", "12.5", "-37.50"),
])
def test_share(rows, amount, rate, want):
    df = rows([(amount, rate)], "a string, r string")
    got = df.select(money.share(F.col("a").cast("decimal(18,2)"), F.col("r"))).first()[0]
    assert got == Decimal(want)


def test_no_function_leaves_the_jvm(rows):
    df = rows([("x",)], "v string").select(
        *[fn(F.col("v")) for fn in (address.city, address.province, cleansing.album_name, dates.format_date, text.split_cols)]
    )
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
