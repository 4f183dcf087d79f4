"""URL rules as intervals of canonical keys, applied by a sorted sweep over ranges."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayworks.llm.shared import free_name

SAMPLED_KEYS = 20_000
ROWS_PER_RANGE = 5_000
MAX_RANGES = 2_000
END = "\U0010ffff"


def url_host(url: Column) -> Column:
    """What lies between the first :// and the next slash, question mark, hash or the end, A to Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """From the end of the host to the next question mark, hash or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot: a host and its subdomains are one interval of keys."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _splitters(keyed: DataFrame, key: str, ident: str, ranges: int, rows: int) -> list[str]:
    """Keys that cut the table into about equal ranges, from a sample of about SAMPLED_KEYS rows.

    The sample decides how even the ranges are and nothing else. A frequent key may come several times.
    """
    every = max(1, rows // SAMPLED_KEYS)
    sample = keyed.filter(F.pmod(F.xxhash64(ident, key), F.lit(every)) == 0)
    keys = sorted(row[0] for row in sample.select(key).collect())
    return [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []


def apply_rules(urls: DataFrame, rules: DataFrame, ident: str, url: str, default: str,
                rows: int | None = None) -> DataFrame:
    """Judges every URL by the longest rule that fits.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains, if the
    URL's path starts with the rule's. Of several, the one with the longest host and path
    together wins, then the longer host, then "allow" before other verdicts. Rows of
    ``rules`` with a NULL host or verdict fit nothing; a NULL path counts as empty.
    Returns ident, host, path, rule (host and path, or NULL), verdict; one row per row of ``urls``, which may
    repeat or have NULL ids. A NULL URL or one without :// has empty host and path and fits no rule.

    The host is turned round, so a rule's host is an interval of keys and intervals nest. Both tables are
    dealt by ranges of keys. A range gets the rules whose interval reaches into it, in order, and one sweep
    over its sorted rows keeps a stack of the open rules. A host with very many rows
    fills several ranges; its rows are dealt among them by a hash. When the sample yields no finer ranges,
    each is cut into slices by a hash, so a task sorts about ROWS_PER_RANGE rows.
    """
    names = {x: free_name(urls, x) for x in ("ident", "host", "path", "key", "range")}
    keyed = urls.select(
        F.col(ident).alias(names["ident"]), url_host(F.col(url)).alias(names["host"]),
        url_path(F.col(url)).alias(names["path"]),
    ).withColumn(names["key"], host_key(F.col(names["host"])))
    total = urls.count() if rows is None else rows
    ranges = min(MAX_RANGES, max(1, -(-total // ROWS_PER_RANGE)))
    slices = max(1, -(-total // (ranges * ROWS_PER_RANGE)))
    cuts = _splitters(keyed, names["key"], names["ident"], ranges, total)

    # Between equal cuts any range will do: they share the frequent key.
    @F.pandas_udf("int")
    def range_of(key: pd.Series, spread: pd.Series) -> pd.Series:
        low = [bisect_left(cuts, x) for x in key]
        high = [bisect_right(cuts, x) for x in key]
        picked = [a + int(s) % (b - a + 1) for a, b, s in zip(low, high, spread, strict=True)]
        return pd.Series([x * slices + int(s) // 1024 % slices for x, s in zip(picked, spread, strict=True)], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series) -> pd.Series:
        return pd.Series([[bisect_left(cuts, x) * slices, (bisect_right(cuts, x + END) + 1) * slices - 1] for x in key])

    spread = F.pmod(F.xxhash64(names["ident"], names["path"]), F.lit(1 << 20))
    dealt = keyed.withColumn(names["range"], range_of(names["key"], spread))
    usable = rules.filter("host IS NOT NULL AND verdict IS NOT NULL").select(
        F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).withColumn("key", host_key(F.col("host"))).withColumn("reach", ranges_of("key"))
    spans = usable.select(
        "host", "path", "verdict", "key",
        F.explode(F.sequence(F.col("reach")[0], F.col("reach")[1])).alias("range"))
    schema = T.StructType([
        T.StructField(ident, urls.schema[ident].dataType), T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType())])
    columns = [names["ident"], names["host"], names["path"], names["key"]]

    def judge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left[columns].sort_values(columns[3], kind="stable")
        found = list(sweep(left[columns[3]], left[columns[2]], right, default))
        out = left[columns[:3]].set_axis([ident, "host", "path"], axis=1)
        return out.assign(rule=[x[0] for x in found], verdict=[x[1] for x in found])

    judged = dealt.groupBy(names["range"]).cogroup(spans.groupBy("range")).applyInPandas(judge, schema)
    return judged


def sweep(keys: Sequence[str], paths: Sequence[str], rules: pd.DataFrame,
          default: str) -> Iterator[tuple[str | None, str]]:
    """Rule and verdict of each row of sorted keys. The stack holds the hosts open at the present key."""
    hosts = sorted(rules.groupby("key"), key=lambda x: x[0]) if len(rules) else []
    stack: list[tuple[str, pd.DataFrame]] = []
    ahead = 0
    for key, path in zip(keys, paths, strict=True):
        while ahead < len(hosts) and hosts[ahead][0] <= key:
            opened = hosts[ahead]
            while stack and not opened[0].startswith(stack[-1][0]):
                stack.pop()
            own = sorted({(len(h) + len(p), len(h), v == "allow", v, h, p) for h, p, v in zip(
                opened[1]["host"], opened[1]["path"], opened[1]["verdict"], strict=True)}, reverse=True)
            stack.append((opened[0], own))
            ahead += 1
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        fitting = [next((r for r in own if path.startswith(r[5])), None) for _, own in stack]
        best = max((r for r in fitting if r), key=lambda r: r[:4], default=None)
        yield (best[4] + best[5], best[3]) if best else (None, default)
