"""Sinks (K1-K3, K7). Stage tables (K4) are `quern.session.stage`; reports (K5, K6) are DataFrames."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as tx


def write_key_values(df: DataFrame, path: str, key: str, value: str, mode: str = "errorifexists") -> None:
    """One 'key<tab>value' line per row (K1)."""
    line = F.concat(F.col(key).cast("string"), F.lit("\t"), F.col(value).cast("string"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_scores(scores: DataFrame, path: str, layout: str = "csv", mode: str = "errorifexists") -> None:
    """`user_id, item_id, score` as CSV, or as 'user<tab>item,score' lines for layout='tab' (K2)."""
    columns = [F.col(c).cast("string") for c in ("user_id", "item_id", "score")]
    if layout == "csv":
        scores.select("user_id", "item_id", "score").write.mode(mode).csv(path)
    elif layout == "tab":
        line = F.format_string("%s\t%s,%s", *columns)
        scores.select(line.alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"layout must be 'csv' or 'tab', not {layout!r}")


def write_projection(
    df: DataFrame, path: str, vector: str = "projection", cluster: str = "cluster", layout: str = "flat"
) -> None:
    """2-D projection and cluster id as CSV, overwriting: x,y,cluster or '"[x,y]",cluster' (K3)."""
    if layout == "flat":
        xy = vector_to_array(F.col(vector))
        out = df.select(xy[0].alias("x"), xy[1].alias("y"), cluster)
    elif layout == "bracketed":
        out = df.select(tx.vector_to_text(F.col(vector)).alias("projection"), cluster)
    else:
        raise ValueError(f"layout must be 'flat' or 'bracketed', not {layout!r}")
    out.write.mode("overwrite").csv(path)


def write_texts(df: DataFrame, path: str, column: str = "text", mode: str = "errorifexists") -> None:
    """One text per line (K7)."""
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)
