"""Warehouse inputs made from the test tables, in Spark and as SQL.

The user log comes from ``events``, the change log from ``orders``, ``part`` and ``nation``, the dimensions from
``part``, ``customer`` and ``supplier``. Each builder is followed by the same table in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import constants as C
from ..operators.geo import PointIndex
from ..sources.config import config_from_rows
from .registry import load

# ---------------------------------------------------------------- user log


def _song_id() -> Column:
    return F.get_json_object("props", "$.k")


def _degrees(micro: Column) -> Column:
    return (micro.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(10,6)").cast("string")


def log_text(events: DataFrame) -> DataFrame:
    """One JSON text per event: clicks are plays, signups are logins, errors are lines of plain text."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    uid, mid = F.col("user_id").cast("string"), (F.col("user_id") + 80000).cast("string")
    play = F.struct(
        F.lit(C.PLAY_EVENT).alias("event_type"),
        F.struct(
            _song_id().alias("songid"), F.concat(F.lit("song-"), _song_id()).alias("songname"),
            F.lit("").alias("order_id"), F.col("user_id").alias("uid"), (F.col("user_id") + 80000).alias("mid"),
            F.col("event_id").alias("session_id"), F.lit(100).alias("pkg_id"), F.floor("value").alias("dur_time"),
            F.when(F.col("value") >= 10, F.floor("value")).alias("play_time"), ms.alias("time"),
        ).alias("event_content"),
        mid.alias("mid"), ms.alias("timestamp"),
    )
    login = F.struct(
        F.lit(C.LOGIN_EVENT).alias("event_type"), uid.alias("uid"), mid.alias("mid"),
        _degrees(F.lit(73000000) + F.pmod(F.col("user_id") * 399989, F.lit(60000000))).alias("lng"),
        _degrees(F.lit(18000000) + F.pmod(F.col("user_id") * 733331, F.lit(35000000))).alias("lat"),
        ms.alias("login_dt"),
    )
    view = F.struct(
        F.lit("PAGE_VIEW").alias("event_type"),
        F.struct(F.col("event_id"), F.col("user_id")).alias("event_content"), mid.alias("mid"), ms.alias("timestamp"),
    )
    untyped = F.struct(F.col("event_id"), mid.alias("mid"), ms.alias("timestamp"))
    kind = F.col("event_type")
    return events.select(
        F.when(kind == "click", F.to_json(play)).when(kind == "signup", F.to_json(login))
        .when(kind == "view", F.to_json(view)).when(kind == "purchase", F.to_json(untyped))
        .otherwise(F.concat(F.lit("error at "), ms, F.lit(" of "), F.col("event_id"))).alias("value")
    )


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_text(load(spark, sf_dir, "events"))


PLAYS_SQL = """plays AS (
  SELECT CAST(json_extract(props, '$.k') AS VARCHAR) AS songid,
         'song-' || CAST(json_extract(props, '$.k') AS VARCHAR) AS songname,
         CAST(user_id AS VARCHAR) AS uid, CAST(user_id + 80000 AS VARCHAR) AS mid,
         CAST(event_id AS VARCHAR) AS session_id, CAST(floor(value) AS BIGINT) AS dur_time,
         CASE WHEN value >= 10 THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS play_time,
         epoch_us(ts) // 1000 AS time, make_timestamp(epoch_us(ts) // 1000 * 1000) AS at_ts
  FROM events WHERE event_type = 'click')"""

LOGINS_SQL = """logins AS (
  SELECT CAST(user_id AS VARCHAR) AS uid, CAST(user_id + 80000 AS VARCHAR) AS mid,
         73000000 + (user_id * 399989) % 60000000 AS lng_e6, 18000000 + (user_id * 733331) % 35000000 AS lat_e6,
         epoch_us(ts) // 1000 AS login_dt, make_timestamp(epoch_us(ts) // 1000 * 1000) AS at_ts
  FROM events WHERE event_type = 'signup'),
logins_text AS (
  SELECT *, printf('%d.%06d', lng_e6 // 1000000, lng_e6 % 1000000) AS lng,
         printf('%d.%06d', lat_e6 // 1000000, lat_e6 % 1000000) AS lat
  FROM logins)"""

# ---------------------------------------------------------------- dimensions


def song_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean songs. Promotional parts are not in the catalogue, and large parts have no known singer."""
    part = load(spark, sf_dir, "part").filter("p_type <> 'PROMO'")
    return part.select(
        F.col("p_partkey").cast("string").alias("source_id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("album"), F.when(F.col("p_size") < 45, F.col("p_brand")).alias("singer_info"),
        F.col("p_size").cast("string").alias("post_time"), F.lit(C.DEFAULT_COMPANY).alias("authorized_company"),
    )


SONGS_SQL = f"""songs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS source_id, p_name AS name, p_type AS album,
         CASE WHEN p_size < 45 THEN p_brand END AS singer_info, CAST(p_size AS VARCHAR) AS post_time,
         '{C.DEFAULT_COMPANY}' AS authorized_company, true AS known
  FROM part WHERE p_type <> 'PROMO')"""


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song rows as they come from the source, with every spelling that cleansing has to cope with."""
    kind, size = F.col("p_type"), F.col("p_size")
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("source_id"), F.col("p_name").alias("name"),
        F.when(kind == "ECONOMY", F.concat(F.lit('[{"name":"'), "p_name", F.lit('","id":"7"}]')))
        .when(kind == "LARGE", F.concat(F.lit("现场《"), "p_name", F.lit("》《2》")))
        .when(kind == "MEDIUM", F.lit("[]")).when(kind == "SMALL", F.lit('[{"id":"7"}]'))
        .when(kind == "PROMO", F.col("p_name")).alias("album"),
        F.when(size < 5, F.lit(C.NO_INFO)).when(size < 8, F.lit("")).when(size < 10, F.lit('[{"id":"9"}]'))
        .when(size < 45, F.concat(F.lit('[{"name":"'), "p_brand", F.lit('","id":"1"},{"name":"x","id":"2"}]')))
        .alias("singer_info"),
        F.when(size < 10, F.lit("2003-08-19")).when(size < 20, F.lit("0.0"))
        .when(size < 30, F.concat((F.col("p_partkey") * 86400123).cast("string"), F.lit(".75")))
        .when(size < 40, F.concat(F.lit("2021-05-"), F.lpad((size - 10).cast("string"), 2, "0"), F.lit(" 10:20:30")))
        .when(size < 45, F.lit("soon")).alias("post_time"),
        F.when(size < 15, F.concat(F.lit('{"id":3,"name":"'), "p_brand", F.lit('"}')))
        .when(size < 30, F.lit('{"id":3}')).when(size < 45, F.lit(C.NO_INFO)).alias("authorized_company"),
    )


RAW_SONGS_SQL = """raw AS (SELECT CAST(p_partkey AS VARCHAR) AS source_id, * FROM part),
cleansed AS (
  SELECT source_id, p_name AS name,
         CASE p_type WHEN 'ECONOMY' THEN p_name WHEN 'LARGE' THEN '《' || p_name || '》' ELSE '暂无专辑' END AS album,
         CASE WHEN p_size BETWEEN 10 AND 44 THEN p_brand ELSE '未知歌手' END AS singer_info,
         CASE WHEN p_size BETWEEN 10 AND 19 THEN '1970-01-01 00:00:00'
              WHEN p_size BETWEEN 20 AND 29 THEN strftime(make_timestamp(p_partkey * 86400123 * 1000), '%Y-%m-%d %H:%M:%S')
              WHEN p_size BETWEEN 30 AND 39 THEN printf('2021-05-%02d 10:20:30', p_size - 10)
              ELSE '' END AS post_time,
         CASE WHEN p_size < 15 THEN p_brand ELSE '乐心曲库' END AS authorized_company
  FROM raw)"""

# Address around a name, by the customer's nation: one line per rule and per way to miss it.
ADDRESS_PARTS = [
    ("内蒙古自治区", "市新城区1号"),
    ("宁夏回族自治区", "市"),
    ("西藏自治区", "市城关区"),
    ("广西壮族自治区", "市青秀区"),
    ("新疆维吾尔自治区", "市天山区"),
    ("新疆维吾尔自治区", "地区沙雅县"),
    ("新疆维吾尔自治区", "蒙古自治州库尔勒"),
    ("新疆维吾尔自治区", "县"),
    ("北京市", "区中关村"),
    ("上海市", "区"),
    ("重庆市", "区解放碑"),
    ("重庆市", "县城"),
    ("重庆市", "乡"),
    ("天津市", "区"),
    ("四川省", "市武侯区"),
    ("四川省", "藏族自治州康定县"),
    ("海南省", "县"),
    ("内蒙古自治区", "盟"),
    ("北京市", "县"),
    ("东区", "区上海市"),
    ("", ""),
    ("市场路", "省会东路"),
    ("市四川省", "市"),
    ("广东省", ""),
]


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as machines with an address; nation 24 has none. Half the places are stored already."""
    parts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ADDRESS_PARTS])
    part = F.get(parts, F.col("c_nationkey"))
    known = F.col("c_acctbal") > 5000
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("mid"),
        F.when(known, F.lit("河北")).otherwise(F.lit(C.NO_INFO)).alias("province"),
        F.when(known, F.lit("石家庄")).otherwise(F.lit(C.NO_INFO)).alias("city"),
        F.concat(part["a"], "c_name", part["b"]).alias("address"),
    )


_PARTS_VALUES = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(ADDRESS_PARTS))
ADDRESSES_SQL = f"""machines AS (
  SELECT CAST(c_custkey AS VARCHAR) AS mid, p.a || c_name || p.b AS address,
         CASE WHEN c_acctbal > 5000 THEN '河北' ELSE '{C.NO_INFO}' END AS province,
         CASE WHEN c_acctbal > 5000 THEN '石家庄' ELSE '{C.NO_INFO}' END AS city
  FROM customer LEFT JOIN (VALUES {_PARTS_VALUES}) AS p(n, a, b) ON c_nationkey = p.n),
places AS (
  SELECT *,
    CASE WHEN address IS NULL THEN '{C.NO_INFO}'
         WHEN contains(address, '内蒙古自治区') THEN '内蒙古' WHEN contains(address, '宁夏回族自治区') THEN '宁夏'
         WHEN contains(address, '西藏自治区') THEN '西藏' WHEN contains(address, '广西壮族自治区') THEN '广西'
         WHEN contains(address, '新疆维吾尔自治区') THEN '新疆' WHEN contains(address, '北京市') THEN '北京'
         WHEN contains(address, '上海市') THEN '上海' WHEN contains(address, '重庆市') THEN '重庆'
         WHEN contains(address, '天津市') THEN '天津'
         WHEN contains(address, '省') THEN regexp_extract(address, '^([^省]*)省', 1)
         ELSE '{C.NO_INFO}' END AS found_province,
    CASE WHEN regexp_matches(address, '内蒙古自治区|宁夏回族自治区|广西壮族自治区|新疆维吾尔自治区')
              AND regexp_matches(address, '^[^区市]*区[^市]*市')
           THEN regexp_extract(address, '^[^区市]*区([^市]*)市', 1)
         WHEN contains(address, '新疆维吾尔自治区') AND regexp_matches(address, '^[^区]*区[^区]*区')
           THEN regexp_extract(address, '^[^区]*区([^区]*)区', 1)
         WHEN contains(address, '新疆维吾尔自治区') AND regexp_matches(address, '^[^区]*区[^州]*州')
           THEN regexp_extract(address, '^[^区]*区([^州]*)州', 1)
         WHEN regexp_matches(address, '北京市|上海市|重庆市|天津市') AND regexp_matches(address, '^[^区市]*市[^区]*区')
           THEN regexp_extract(address, '^[^区市]*市([^区]*)区', 1)
         WHEN contains(address, '重庆市') AND regexp_matches(address, '^[^区县市]*市[^区县]*县')
           THEN regexp_extract(address, '^[^区县市]*市([^区县]*)县', 1)
         WHEN regexp_matches(address, '自治区|北京市|上海市|重庆市|天津市') THEN '{C.NO_INFO}'
         WHEN regexp_matches(address, '^[^省市]*省[^市]*市') THEN regexp_extract(address, '^[^省市]*省([^市]*)市', 1)
         WHEN regexp_matches(address, '^[^市]*省[^市]*自治州') THEN regexp_extract(address, '^[^省]*省([^州]*)州', 1)
         ELSE '{C.NO_INFO}' END AS found_city
  FROM machines)"""


def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of machines. Furniture customers have none yet; indebted ones have an unknown city."""
    customer = load(spark, sf_dir, "customer").filter("c_mktsegment <> 'FURNITURE'")
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    # Nations and regions are fixed in number.
    named = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.select(
        F.col("c_custkey").cast("string").alias("mid"), F.col("r_name").alias("province"),
        F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("city"),
    )


def contract_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of machines. Machinery customers have none; the four rates of a contract add up to 100."""
    nation = F.col("c_nationkey")
    return load(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").cast("string").alias("machine_num"), F.col("c_name").alias("machine_name"),
        F.col("c_mktsegment").alias("package_name"), (nation + 40).cast("string").alias("inv_rate"),
        F.lit("20").alias("age_rate"), F.lit("10.0").alias("com_rate"), (F.lit(30) - nation).cast("string").alias("par_rate"),
        F.concat(F.lit("scene-"), nation).alias("scene_address"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("ground_name"),
    )


DIMS_SQL = """locations AS (
  SELECT CAST(c_custkey AS VARCHAR) AS mid, r_name AS province, CASE WHEN c_acctbal >= 0 THEN n_name END AS city, true AS known
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_mktsegment <> 'FURNITURE'),
contracts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS machine_num, c_name AS machine_name, c_mktsegment AS package_name,
         CAST(40 + c_nationkey AS VARCHAR) AS inv_rate, '20' AS age_rate, '10.0' AS com_rate,
         CAST(30 - c_nationkey AS VARCHAR) AS par_rate, 'scene-' || c_nationkey AS scene_address,
         CASE WHEN c_acctbal >= 0 THEN c_name END AS ground_name, true AS known
  FROM customer WHERE c_mktsegment <> 'MACHINERY')"""

CELL = 2_000_000


def geo_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as reference points. Those of nation 0 stand on one spot, so that ties happen."""
    supplier = load(spark, sf_dir, "supplier")
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    named = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    )
    spot = F.when(F.col("s_nationkey") == 0, F.lit(0)).otherwise(F.col("s_suppkey"))
    return named.select(
        F.col("s_suppkey").alias("geo_id"),
        (F.lit(73000000) + F.pmod(spot * 7350107, F.lit(60000000))).alias("lng_e6"),
        (F.lit(18000000) + F.pmod(spot * 5190013, F.lit(35000000))).alias("lat_e6"),
        F.col("r_name").alias("province"), F.when(F.col("s_acctbal") >= 0, F.col("n_name")).otherwise("[]").alias("city"),
        F.col("s_name").alias("district"), F.concat_ws(" ", "r_name", "n_name", "s_name").alias("address"),
    )


def point_index(spark: SparkSession, sf_dir: str, **options) -> PointIndex:
    return PointIndex.build(geo_points(spark, sf_dir), CELL, **options)


GEO_SQL = f"""geo AS (
  SELECT s_suppkey AS geo_id, r_name AS province, CASE WHEN s_acctbal >= 0 THEN n_name ELSE '{C.NO_INFO}' END AS city,
         s_name AS district, r_name || ' ' || n_name || ' ' || s_name AS address,
         73000000 + (CASE WHEN s_nationkey = 0 THEN 0 ELSE s_suppkey END * 7350107) % 60000000 AS g_lng,
         18000000 + (CASE WHEN s_nationkey = 0 THEN 0 ELSE s_suppkey END * 5190013) % 35000000 AS g_lat
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
asked AS (SELECT DISTINCT lng_e6, lat_e6 FROM logins),
near AS (
  SELECT lng_e6, lat_e6, geo.*,
         row_number() OVER (PARTITION BY lng_e6, lat_e6
                            ORDER BY (lng_e6 - g_lng) * (lng_e6 - g_lng) + (lat_e6 - g_lat) * (lat_e6 - g_lat), geo_id) AS nth
  FROM asked JOIN geo ON abs(lng_e6 // {CELL} - g_lng // {CELL}) <= 1 AND abs(lat_e6 // {CELL} - g_lat // {CELL}) <= 1),
logins_wide AS (
  SELECT l.uid, l.mid, l.lng, l.lat, l.login_dt, l.at_ts,
         coalesce(n.province, '{C.NO_INFO}') AS province, coalesce(n.city, '{C.NO_INFO}') AS city,
         coalesce(n.district, '{C.NO_INFO}') AS district, coalesce(n.address, '{C.NO_INFO}') AS address
  FROM logins_text l LEFT JOIN near n ON l.lng_e6 = n.lng_e6 AND l.lat_e6 = n.lat_e6 AND n.nth = 1)"""

# ---------------------------------------------------------------- orders and changes


def order_facts(orders: DataFrame) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("mid"),
        F.col("o_totalprice").cast(C.MONEY).alias("amount"), F.col("o_orderpriority").alias("pkg_name"),
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "yyyyMMddHHmmss"))
        .otherwise(F.unix_millis(day).cast("string")).alias("action_time"),
        F.date_format(day, "yyyyMMdd").alias("bill_date"),
    )


ORDERS_SQL = """facts AS (
  SELECT o_orderkey AS id, o_custkey AS mid, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority AS pkg_name,
         strftime(o_orderdate, '%Y%m%d') AS bill_date, strftime(o_orderdate, '%Y-%m-%d') AS action_dt
  FROM orders)"""

WIDE_SQL = f"""{ORDERS_SQL}, {DIMS_SQL},
wide AS (
  SELECT f.*, CASE WHEN l.known THEN l.province ELSE '{C.NO_INFO}' END AS province,
         CASE WHEN l.known THEN l.city ELSE '{C.NO_INFO}' END AS city,
         CASE WHEN c.known THEN c.machine_name ELSE '{C.NO_INFO}' END AS machine_name,
         CASE WHEN c.known THEN c.package_name ELSE '{C.NO_INFO}' END AS package_name,
         CASE WHEN c.known THEN c.inv_rate ELSE '100.0' END AS inv_rate, CASE WHEN c.known THEN c.age_rate ELSE '0.0' END AS age_rate,
         CASE WHEN c.known THEN c.com_rate ELSE '0.0' END AS com_rate, CASE WHEN c.known THEN c.par_rate ELSE '0.0' END AS par_rate,
         CASE WHEN c.known THEN c.scene_address ELSE '{C.NO_INFO}' END AS scene_address,
         CASE WHEN c.known THEN c.ground_name ELSE '{C.NO_INFO}' END AS ground_name,
         l.known AS placed, c.known AS contracted
  FROM facts f LEFT JOIN locations l ON CAST(f.mid AS VARCHAR) = l.mid
  LEFT JOIN contracts c ON CAST(f.mid AS VARCHAR) = c.machine_num)"""


def _money_sql(rate: str) -> str:
    return f"CAST(amount * CAST({rate} AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


REVENUE_SQL = f"""{WIDE_SQL},
revenue AS (
  SELECT province, city, coalesce(scene_address, '') || coalesce(ground_name, '') AS address,
         CAST(mid AS VARCHAR) AS mid, machine_name, pkg_name, amount,
         {_money_sql("inv_rate")} AS inv_rev, {_money_sql("age_rate")} AS age_rev,
         {_money_sql("com_rate")} AS com_rev, {_money_sql("par_rate")} AS par_rev, bill_date AS data_dt, action_dt
  FROM wide)"""

CONFIG_ROWS = [
    ("orders", "sales", "fact", "id", "id,mid,amount", "", C.DWD_ORDER),
    ("machine", "sales", "dim", "mid", "mid,province,city,address", C.DIM_MACHINE_LOCAL, C.DWD_DIM),
    ("part", "sales", "dim", "source_id", "source_id,name,album,singer_info,post_time,authorized_company", C.DIM_SONG, C.DWD_DIM),
    ("absent", "sales", "dim", "id", "id", "DIM_ABSENT", C.DWD_DIM),
]


def config(spark: SparkSession) -> DataFrame:
    return config_from_rows(CONFIG_ROWS)(spark)


def _change_type() -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", "insert").when(priority == "2-HIGH", "update")
        .when(priority == "3-MEDIUM", "bootstrap-insert").when(priority == "4-NOT SPECIFIED", "delete")
        .otherwise("table-alter")
    )


def _envelope(table: str, kind: Column, seconds: Column, xid: Column, data: Column, last: Column | None = None) -> Column:
    """A change record. ``last`` tells the committing record of a transaction, which has no offset, from those before."""
    last = F.lit(False) if last is None else last
    return F.to_json(F.struct(
        F.lit("sales").alias("database"), F.lit(table).alias("table"), kind.alias("type"), seconds.alias("ts"),
        xid.alias("xid"), F.when(~last, F.lit(0)).alias("xoffset"), F.when(last, F.lit(True)).alias("commit"), data.alias("data"),
    ))


def order_changes(orders: DataFrame) -> DataFrame:
    """Every order as a change of the fact table."""
    typed = orders.withColumns({"_type": _change_type(), "_s": F.unix_seconds(F.col("o_orderdate").cast("timestamp"))})
    day = F.col("o_orderdate").cast("timestamp")
    body = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("mid"),
        F.col("o_totalprice").cast(C.MONEY).alias("amount"), F.col("o_orderpriority").alias("pkg_name"),
        F.date_format(day, "yyyyMMdd").alias("bill_date"), F.lit("").alias("trade_no"),
    )
    return typed.select(_envelope("orders", F.col("_type"), F.col("_s"), F.col("o_orderkey"), body).alias("value"))


def machine_changes(orders: DataFrame) -> DataFrame:
    """Every order also reports the place of its machine, a change of the place dimension.

    It is a transaction of two records: a draft, and the record that commits it and counts.
    """
    status = F.col("o_orderstatus")
    day = F.col("o_orderdate").cast("timestamp")
    drafted = orders.withColumn("_last", F.explode(F.array(F.lit(True), F.lit(False))))
    place = F.when(status != "P", F.concat(F.lit("四川省城"), "o_orderkey", F.lit("市东路")))
    body = F.struct(
        F.col("o_custkey").alias("mid"),
        F.when(status == "F", F.lit(C.NO_INFO)).otherwise(F.concat(F.lit("省份"), status)).alias("province"),
        F.when(status == "O", F.lit("城市O")).otherwise(F.lit(C.NO_INFO)).alias("city"),
        F.when(F.col("_last"), place).otherwise(F.lit("草")).alias("address"),
        F.lit(1).alias("map_class"),
    )
    record = _envelope("machine", _change_type(), F.unix_seconds(day), F.col("o_orderkey"), body, F.col("_last"))
    return drafted.select(record.alias("value"))


def song_changes(songs: DataFrame) -> DataFrame:
    return songs.select(
        _envelope("part", F.lit("bootstrap-insert"), F.lit(0), F.col("source_id").cast("bigint"), F.struct(*songs.columns)).alias("value")
    )


def nation_changes(nation: DataFrame) -> DataFrame:
    return nation.select(
        _envelope("nation", F.lit("insert"), F.lit(0), F.col("n_nationkey"), F.struct(*nation.columns)).alias("value")
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return (
        order_changes(orders).unionByName(machine_changes(orders)).unionByName(song_changes(raw_songs(spark, sf_dir)))
        .unionByName(nation_changes(load(spark, sf_dir, "nation")))
    )


CHANGES_SQL = f"""order_log AS (
  SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'insert' WHEN '2-HIGH' THEN 'update'
            WHEN '3-MEDIUM' THEN 'bootstrap-insert' WHEN '4-NOT SPECIFIED' THEN 'delete' ELSE 'table-alter' END AS type,
         CAST(epoch(o_orderdate) AS BIGINT) AS ts
  FROM orders),
changes AS (
  SELECT 'orders' AS tbl, type, ts, o_orderkey AS xid FROM order_log
  UNION ALL SELECT 'machine', type, ts, o_orderkey FROM order_log, (VALUES (1), (2))
  UNION ALL SELECT 'part', 'bootstrap-insert', 0, p_partkey FROM part
  UNION ALL SELECT 'nation', 'insert', 0, n_nationkey FROM nation),
conf(tbl, kind, pk_col, phoenix_tbl_name, sink_topic) AS (VALUES
  ('orders', 'fact', 'id', '', '{C.DWD_ORDER}'), ('machine', 'dim', 'mid', '{C.DIM_MACHINE_LOCAL}', '{C.DWD_DIM}'),
  ('part', 'dim', 'source_id', '{C.DIM_SONG}', '{C.DWD_DIM}'))"""

MACHINES_SQL = f"""kept AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY ts DESC, o_orderkey DESC) AS nth
  FROM order_log WHERE type IN ('insert', 'update', 'bootstrap-insert')),
machine_dim AS (
  SELECT CAST(o_custkey AS VARCHAR) AS mid, CASE o_orderstatus WHEN 'F' THEN '四川' ELSE '省份' || o_orderstatus END AS province,
         CASE o_orderstatus WHEN 'O' THEN '城市O' WHEN 'F' THEN '城' || o_orderkey ELSE '{C.NO_INFO}' END AS city,
         CASE WHEN o_orderstatus <> 'P' THEN '四川省城' || o_orderkey || '市东路' END AS address
  FROM kept WHERE nth = 1)"""
