"""Fixed values and row layouts shared by the operators."""

from pyspark.sql import types as T

# They end up in stored data and later steps compare with them.
NO_INFO = "无信息"
UNKNOWN_SINGER = "未知歌手"
NO_ALBUM = "暂无专辑"
DEFAULT_COMPANY = "乐心曲库"
RATE_DEFAULTS = {
    "inv_rate": "100.0",
    "age_rate": "0.0",
    "com_rate": "0.0",
    "par_rate": "0.0",
}

# Event types that the user log router looks for.
PLAY_EVENT = "MINIK_CLIENT_SONG_PLAY_OPERATE_REQ"
LOGIN_EVENT = "USER_LOGIN_LOCATION_LOG"

# Topic, dimension and mart names.
ODS_USER_LOG = "ODS_LOG_USERLOG"
ODS_CDC = "ODS_DB_BUSSINESS_DATA"
DWD_PLAY = "DWD_SONG_PLAY_INFO_RT"
DWD_LOGIN = "DWD_USER_LOGIN_LOCATION_INFO_RT"
DWD_OTHER = "DWD_OTHER_USERLOG_RT"
DWD_ORDER = "DWD_MACHINE_CONSUMER_DETAIL_RT"
DWD_DIM = "DWD_DIM_INFO_RT"
DWS_PLAY = "DWS_SONG_PLAY_INFO_WIDE_RT"
DWS_LOGIN = "DWS_USER_LOGIN_LOCATION_INFO_WIDE_RT"
DWS_ORDER = "DWS_MACHINE_CONSUMER_DETAIL_WIDE_RT"
DIM_SONG = "DIM_SONG"
DIM_MACHINE_LOCAL = "DIM_MACHINE_LOCAL_INFO"
DIM_MACHINE_ADMIN = "DIM_MACHINE_ADMIN_MAP"
MART_SONG_HOT = "dm_songplay_hot"
MART_LOGIN = "dm_user_login_loc_info_rt"
MART_ORDER = "dm_order_info_rt"

# Change types that reach a dimension.
DIM_OPS = ("insert", "update", "bootstrap-insert")

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
MONEY = T.DecimalType(18, 2)


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


def _longs(*names):
    return [T.StructField(n, T.LongType()) for n in names]


PLAY_SCHEMA = T.StructType(
    _strings("songid", "songname", "order_id", "uid", "mid", "session_id", "pkg_id", "optrate_type", "consume_type")
    + _longs("dur_time", "play_time", "time")
)
PLAY_WIDE_SCHEMA = T.StructType(PLAY_SCHEMA.fields + _strings("singer_info"))

LOGIN_SCHEMA = T.StructType(_strings("uid", "mid", "lng", "lat") + _longs("login_dt"))
LOGIN_WIDE_SCHEMA = T.StructType(LOGIN_SCHEMA.fields + _strings("province", "city", "district", "address"))

ORDER_SCHEMA = T.StructType(
    _longs("id", "mid", "uid", "p_type", "m_type", "pkg_id", "activity_id", "coupon_type", "order_type")
    + [T.StructField(n, MONEY) for n in ("amount", "pkg_price", "pkg_discount")]
    + _strings(
        "pkg_name", "consum_id", "order_id", "trade_no", "nickname", "activity_name", "coupon_type_name",
        "action_time", "bill_date", "ts",
    )
)
LOCATION_COLUMNS = ["province", "city"]
CONTRACT_COLUMNS = [
    "machine_name", "package_name", "inv_rate", "age_rate", "com_rate", "par_rate", "scene_address", "ground_name",
]
ORDER_WIDE_SCHEMA = T.StructType(ORDER_SCHEMA.fields + _strings(*LOCATION_COLUMNS, *CONTRACT_COLUMNS))

CONFIG_SCHEMA = T.StructType(
    _strings("tbl_name", "tbl_db", "tbl_type", "pk_col", "cols", "phoenix_tbl_name", "sink_topic")
)
RECORD_SCHEMA = T.StructType(_strings("key", "value", "topic"))
