"""URL filters: host-suffix and path-prefix expressions looked up among rules by short digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import lower_ascii
from quern.session import BROADCAST_BYTES

#: Copies of each rule, and parts of the expressions, when the rules are too large to broadcast.
PARTS = 16
#: Hexadecimal digits of the digest that the join compares first.
SHORT_DIGITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without `://`."""
    found = r"(?s)://([^/?#]*)([^?#]*)"
    empty = F.lit("")
    host = lower_ascii(F.regexp_extract(url, found, 1))
    return F.coalesce(host, empty), F.coalesce(F.regexp_extract(url, found, 2), empty)


def _suffixes(host: Column, most: int) -> Column:
    """The host and its parent domains of at most `most` labels."""
    labels = F.split(host, r"\.", -1)
    count = F.size(labels)
    lengths = F.sequence(F.lit(1), F.least(count, F.lit(most)))
    return F.transform(lengths, lambda n: F.concat_ws(".", F.slice(labels, count - n + 1, n)))


def _prefixes(path: Column, most: int) -> Column:
    """The path, and its parts that end with one of its first `most` slashes."""
    pieces = F.split(path, "/", -1)
    ends = F.least(F.size(pieces) - 1, F.lit(most))
    lengths = F.when(ends > 0, F.sequence(F.lit(1), ends)).otherwise(F.array().cast("array<int>"))
    folders = F.transform(lengths, lambda n: F.concat(F.concat_ws("/", F.slice(pieces, 1, n)), F.lit("/")))
    return F.array_distinct(F.concat(folders, F.array(path)))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path).cast("binary"), 256)


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
    otherwise: str = "allow", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`key, host, path, rule, verdict`: one row per page, by the longest rule that fits its URL.

    `rules` holds `host, path, verdict` (allow or block); a rule's path ends with `/` or is a whole
    path, and a rule fits its host and every subdomain. Of rules of one length the longer host wins,
    and of one rule given twice `block` does. Without a rule the verdict is `otherwise` and `rule` is
    null. A null or empty URL has an empty host and path and fits no rule; rows that repeat stay.

    A page becomes one expression for each host suffix and path prefix, no deeper than the deepest
    rule, so nothing a rule could fit is left out. Expressions meet rules on a short digest prefix;
    the full digest and the text then confirm. Rules are broadcast when their measured size allows it;
    otherwise each rule is copied to `PARTS` parts over which the expressions of a frequent host spread.
    """
    given = rules.select(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), "verdict").dropna()
    unique = given.groupBy("r_host", "r_path").agg(F.max("verdict").alias("r_verdict"))
    labels = F.size(F.split("r_host", r"\.", -1))
    slashes = F.size(F.split("r_path", "/", -1)) - 1
    deepest, most_slashes = unique.agg(F.max(labels), F.max(slashes)).first()
    digest = _digest(F.col("r_host"), F.col("r_path"))
    entry = F.struct(digest.alias("digest"), "r_host", "r_path", "r_verdict")
    known = unique.groupBy(F.substring(digest, 1, SHORT_DIGITS).alias("short")).agg(F.collect_list(entry).alias("found"))

    host, path = host_and_path(F.col(url))
    hosts = F.posexplode(_suffixes(F.col("host"), deepest or 1)).alias("at_host", "e_host")
    paths = F.posexplode(_prefixes(F.col("path"), most_slashes or 0)).alias("at_path", "e_path")
    asked = (
        pages.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"))
        .select("*", hosts)
        .select("*", paths)
        .withColumn("e_digest", _digest(F.col("e_host"), F.col("e_path")))
        .withColumn("short", F.substring("e_digest", 1, SHORT_DIGITS))
    )
    size = unique.agg(F.sum(F.length("r_host") + F.length("r_path") + 200)).first()[0] or 0
    if size <= broadcast_bytes:
        met = asked.join(F.broadcast(known), "short", "left")
    else:
        asked = asked.withColumn("part", F.pmod(F.xxhash64("k", "host", "path"), F.lit(PARTS)).cast("int"))
        parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
        met = asked.join(known.select("*", parts), ["short", "part"], "left")

    def same(rule: Column) -> Column:
        return (rule["digest"] == F.col("e_digest")) & (rule["r_host"] == F.col("e_host")) & (rule["r_path"] == F.col("e_path"))

    def ranked(rule: Column) -> Column:
        text = F.concat(rule["r_host"], rule["r_path"])
        return F.struct(F.length(text), F.length(rule["r_host"]), text.alias("rule"), rule["r_verdict"].alias("verdict"))

    best = F.array_max(F.transform(F.filter("found", same), ranked))
    whole = (F.col("at_host") == 0) & (F.col("at_path") == 0)  # one such expression for each row
    judged = met.groupBy("k", "host", "path").agg(F.max(best).alias("best"), F.count(F.when(whole, 1)).alias("copies"))
    return judged.select(
        F.col("k").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
