"""URL rules by host suffix and path prefix, looked up by hash prefix.

Each distinct URL is expanded into its host suffixes times its path prefixes (cut after each
``/``). The expressions meet the rules in an equi-join on four bytes of their digest; the full
digests then decide, and of the rules that fit the longest wins. Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.llm.tables import BROADCAST_BYTES, repeated

# Copies of the rules and shares of the URLs, if the rules are too large to be copied to all executors.
SALTS = 16
_PREFIX_DIGITS = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )


def _folders(path: Column) -> Column:
    """The path cut after each slash, and the empty path."""
    parts = F.split(path, "/", -1)
    cut = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i - 1), "/")
    )
    return F.transform(cut, lambda text, i: F.when(i == 0, F.lit("")).otherwise(F.concat(text, F.lit("/"))))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _keyed(rules: DataFrame) -> DataFrame:
    """Rules with their key: host and the path up to its last slash."""
    host, path = F.translate("host", _UPPER, _LOWER), F.coalesce("path", F.lit(""))
    rules = rules.where(F.col("host").isNotNull() & F.col("action").isNotNull())
    rules = rules.select(host.alias("r_host"), path.alias("r_path"), F.col("action").alias("r_action")).distinct()
    folder = F.regexp_extract("r_path", r"(?s)^(.*/)?", 0)
    return rules.select(
        F.substring(_digest(F.col("r_host"), folder), 1, _PREFIX_DIGITS).alias("r_key"),
        _digest(F.col("r_host"), F.col("r_path")).alias("r_digest"),
        F.length("r_path").alias("r_length"),
        F.struct(
            (F.length("r_host") + F.length("r_path")).alias("size"),
            F.length("r_host").alias("host_size"),
            F.col("r_action").alias("action"),
            F.concat("r_host", "r_path").alias("rule"),
        ).alias("r_rank"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col``, host, path, rule and verdict of every row.

    ``rules`` (host, path, action): a rule fits its host and all subdomains if the path starts
    with the rule's. The longest rule (host and path together) wins, then the longer host, then
    the action that sorts last (block before allow). Without a fitting rule ``rule`` is null
    and the verdict is ``default``. Rules with a null host or action are left out; a null path
    counts as empty. Rows with a null id or url are judged like others (host and path empty),
    repeated rows are returned as often as they occur, an empty table gives an empty result,
    and other columns are not read.
    """
    seen = pages.select(F.col(id_col).alias("u_id"), F.col(url_col).alias("u_url")).groupBy("u_id", "u_url").agg(F.count(F.lit(1)).alias("u_copies"))
    parts = seen.select("*", host_of(F.col("u_url")).alias("u_host"), path_of(F.col("u_url")).alias("u_path"))
    spread = parts.withColumn("u_suffix", F.explode(_suffixes(F.col("u_host")))).withColumn("u_folder", F.explode(_folders(F.col("u_path"))))
    spread = spread.withColumn("u_key", F.substring(_digest(F.col("u_suffix"), F.col("u_folder")), 1, _PREFIX_DIGITS))
    keyed = _keyed(rules)
    size = keyed.agg(F.sum(F.lit(200) + F.octet_length("r_rank.rule"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        met = spread.join(F.broadcast(keyed), F.col("u_key") == F.col("r_key"), "left")
    else:
        salted = keyed.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        share = F.pmod(F.xxhash64("u_id", "u_url"), F.lit(SALTS)).cast("int")
        met = spread.withColumn("u_salt", share).join(salted, (F.col("u_key") == F.col("r_key")) & (F.col("u_salt") == F.col("r_salt")), "left")
    start = F.expr("substring(u_path, 1, r_length)")
    fits = (F.length("u_path") >= F.col("r_length")) & (_digest(F.col("u_suffix"), start) == F.col("r_digest"))
    best = met.groupBy("u_id", "u_url").agg(
        F.first("u_copies").alias("u_copies"), F.first("u_host").alias("host"), F.first("u_path").alias("path"),
        F.max(F.when(fits, F.col("r_rank"))).alias("u_best"),
    )
    out = best.select(
        F.col("u_id").alias(id_col), "host", "path", F.col("u_best.rule").alias("rule"),
        F.coalesce("u_best.action", F.lit(default)).alias("verdict"),
        "u_copies",
    )
    return repeated(out, "u_copies", "u_copy").drop("u_copy")
