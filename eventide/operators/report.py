"""Text reports.

The reference's primary outputs are text: a ranked block per window end and
a one-line province report.  Both are built from rows with column
expressions; the ranked block gathers only the ``n`` ranked rows of a window
(bounded by ``n``), never a window's full key list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import ts_text


def ranked_report(ranked: DataFrame, key: str, count_col: str, *,
                  time_col: str = "window_end", rank_col: str = "rank",
                  key_label: str = "item", count_label: str = "views") -> DataFrame:
    """One text block per window end:

    ``window end: <time>`` then one line ``No<rank>: <key_label>=<key>
    <count_label>=<count>`` per ranked row, in rank order.
    Output: time_col, report.
    """
    line = F.concat(F.lit("No"), F.col(rank_col).cast("string"), F.lit(": "),
                    F.lit(key_label + "="), F.col(key).cast("string"), F.lit(" "),
                    F.lit(count_label + "="), F.col(count_col).cast("string"))
    lines = (ranked.groupBy(time_col)
             .agg(F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"),
                                                       line.alias("l")))).alias("ls")))
    header = F.concat(F.lit("window end: "), ts_text(F.col(time_col)))
    return lines.select(time_col, F.concat_ws(
        "\n", header, F.concat_ws("\n", F.transform("ls", lambda x: x["l"]))).alias("report"))


def region_report(counts: DataFrame, region_col: str, count_col: str, *,
                  time_col: str = "window_end") -> DataFrame:
    """``<window end> <region> <count>`` per row."""
    return counts.select(
        region_col, time_col,
        F.concat_ws(" ", ts_text(F.col(time_col)), F.col(region_col),
                    F.col(count_col).cast("string")).alias("report"))
