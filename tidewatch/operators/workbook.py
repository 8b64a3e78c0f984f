"""The daily report workbook (SNK-11): eight sheets from one aggregate over every flow.

Each flow gives rows (family, device, ts, origin, black), and heartbeat listings give (family, device, ts).  One
aggregate with GROUPING SETS makes a row for each device and one for each family; both hold the report
day's counts, the newest data and the newest heartbeat, and all sheets are cut out of these rows without another
look at the flows.  Combined before its shuffle, so a device with a third of all rows is no hot task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..storage import write_once
from .metrics import display_name

#: FIXED VALUES: the sheets in their order, with their headers.
SHEETS = {
    "daily": ("今日数据日报", ["厂商", "日志数量", "日志总数量", "黑日志数"]),
    "online": ("今日在线安全设备", ["family", "device"]),
    "iep_data": ("iep最近上传数据时间", ["IEP", "最近上报数据时间"]),
    "ptd_data": ("ptd最近上传数据时间", ["PTD", "最近上报数据时间"]),
    "iep_heartbeat": ("iep最近发送心跳时间", ["IEP", "最近发送心跳时间"]),
    "ptd_heartbeat": ("ptd最近发送心跳时间", ["PTD", "最近发送心跳时间"]),
    "iep_counts": ("iep上传日志条数", ["IEP", "上传总日志条数", "上传黑日志条数"]),
    "ptd_counts": ("ptd上传日志条数", ["PTD", "上传总日志条数", "上传黑日志条数"]),
}
#: FIXED VALUES: sources of the daily sheet with their titles; the first two share a total.
DAILY = {"star": "启明", "hillstone": "山石", "iep": "IEP", "ptd": "PTD", "gap": "网闸"}
MERGED = ("star", "hillstone")
UNREPORTED = ("zhenguan",)      # FIXED VALUE: not on the online sheet
_TIME = "yyyy-MM-dd HH:mm:ss"
_CELLS = ("a", "b", "c", "d")


def figures(flows: Sequence[DataFrame], heartbeats: DataFrame, day: Column) -> DataFrame:
    """(level, family, device, origin, black, last_data, last_heartbeat): level 0 rows are devices, level 1 rows families.

    ``flows``: (family, device, ts, origin, black) with booleans for what counts.  A family of ``DAILY`` without a row has zeros.
    Rows without a device count for their family and for the device ''."""
    none = F.lit(None).cast("timestamp")
    data = [f.select("family", F.coalesce("device", F.lit("")).alias("device"), F.col("ts").alias("data"), none.alias("heartbeat"),
                     ((F.to_date("ts") == day) & F.col("origin")).alias("origin"), ((F.to_date("ts") == day) & F.col("black")).alias("black")) for f in flows]
    beats = heartbeats.select("family", "device", none.alias("data"), F.col("ts").alias("heartbeat"), F.lit(False).alias("origin"), F.lit(False).alias("black"))
    # families that must have a row, as rows that count nothing
    always = heartbeats.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, DAILY))).alias("family"), F.lit(None).cast("string").alias("device"),
                                                     none.alias("data"), none.alias("heartbeat"), F.lit(False).alias("origin"), F.lit(False).alias("black"))
    rows = reduce(DataFrame.unionByName, [*data, beats, always])
    out = rows.groupingSets([["family", "device"], ["family"]], "family", "device").agg(
        F.grouping("device").cast("int").alias("level"), F.count_if("origin").alias("origin"), F.count_if("black").alias("black"),
        F.max("data").alias("last_data"), F.max("heartbeat").alias("last_heartbeat"))
    return out.where((F.col("level") == 1) | F.col("device").isNotNull())


def sheets(fig: DataFrame, as_of: Column, names: dict[str, str], data_minutes: int = C.PRESENCE_DATA_MINUTES,
           heartbeat_minutes: int = C.PRESENCE_HEARTBEAT_MINUTES) -> DataFrame:
    """(sheet, a, b, c, d): every line of every sheet, cells as text, unused ones null."""
    family, device, level = F.col("family"), F.col("device"), F.col("level")
    text = lambda c: c.cast("string")
    time = lambda c: F.date_format(c, _TIME)
    # families that share a total meet in one small group; each device row is a group of its own
    team = F.when(family.isin(*MERGED), "merged").otherwise(family)
    total = F.sum("origin").over(Window.partitionBy("team", "level", "own"))
    fig = fig.withColumn("team", team).withColumn("own", F.when(level == 0, F.struct("family", "device"))).withColumn("total", total)
    name = display_name(device, names)
    seconds = F.unix_timestamp
    by_data = seconds("last_data") + data_minutes * 60 > seconds(as_of)
    by_beat = seconds("last_heartbeat").between(seconds(as_of) - heartbeat_minutes * 60, seconds(as_of))
    online = (F.coalesce(by_data, F.lit(False)) | F.coalesce(by_beat, F.lit(False))) & ~family.isin(*UNREPORTED)

    def line(when: Column, sheet: Column, *cells: Column) -> Column:
        blank = [F.lit(None).cast("string")] * (len(_CELLS) - len(cells))
        return F.when(when, F.struct(sheet.alias("sheet"), *(c.alias(n) for c, n in zip((*cells, *blank), _CELLS, strict=True))))

    one, sided = level == 0, family.isin("iep", "ptd")
    title = reduce(lambda c, kv: c.when(family == kv[0], kv[1]), DAILY.items(), F.when(F.lit(False), ""))
    lines = F.array(
        line((level == 1) & family.isin(*DAILY), F.lit("daily"), title, text(F.col("origin")), text(F.col("total")), text(F.col("black"))),
        line(one & online & (device != ""), F.lit("online"), family, name),
        line(one & sided & F.col("last_data").isNotNull(), F.concat(family, F.lit("_data")), name, time("last_data")),
        line(one & sided & F.col("last_heartbeat").isNotNull(), F.concat(family, F.lit("_heartbeat")), name, time("last_heartbeat")),
        line(one & sided & F.col("last_data").isNotNull(), F.concat(family, F.lit("_counts")), name, text(F.col("origin")), text(F.col("black"))))
    return fig.select(F.inline(F.filter(lines, lambda x: x.isNotNull())))


def write_workbook(lines: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write ``sheets`` once, partitioned by sheet, and return each sheet as a frame with its own headers.
    A folder that an earlier run finished is read back instead."""
    done = write_once(lines, path, "sheet")
    return {title: done.where(F.col("sheet") == k).select(*(F.col(c).alias(h) for c, h in zip(_CELLS, headers, strict=False)))
            for k, (title, headers) in SHEETS.items()}
