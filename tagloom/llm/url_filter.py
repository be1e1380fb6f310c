"""URL filters: rules by host and path, then a list of URLs behind a blocked Bloom filter.

Native: DataFrame functions only.

* The canonical form drops the scheme, a ``www.``/``m.``/``mobile.`` label before two others or more, default ports, the fragment,
  tracking parameters, ``index.html``/``.html`` endings and the last slash, and sorts the
  remaining query parameters.
* The filter has up to ``max_blocks`` blocks of eight 64-bit words. One hash picks the
  block, and one bit is set in every word (``bit_or`` per block). Its size is bounded by
  ``max_blocks`` whatever the list's length, so it may be broadcast; beyond about 50 keys
  a block it lets more false positives through, which the exact join removes.
* Possible hits alone are shuffled: a hash join with the distinct list decides exactly.

Null urls: empty host and path, no rule, verdict ``allow``. Repeated rows stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: Parameters that only track where a visit came from.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
WORDS = 8


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The canonical form; null where the url has no ``://`` or no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^(www|m|mobile)\.([^.]+\.)", "$2")
    path = F.regexp_replace(path_of(url), r"(/index)?\.html?$|/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"),
                                 lambda p: (p != "") & ~F.split(p, "=")[0].rlike(f"(?i)^({TRACKING})$")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                                       .otherwise(F.lit(""))))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _masks(key: Column) -> list[Column]:
    """One bit in each of the eight words, from two more hashes."""
    a, b = F.xxhash64(key, F.lit("a")), F.xxhash64(key, F.lit("b"))
    pick = [F.shiftrightunsigned(a if k < 4 else b, 6 * (k % 4)).bitwiseAND(F.lit(63)).cast("int") for k in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in pick]


def bloom_blocks(keys: DataFrame, key_col: str, n_blocks: int) -> DataFrame:
    """The filter of all ``keys``: one row per block in use, with eight words."""
    k = F.col(key_col)
    masked = keys.where(k.isNotNull()).select(_block(k, n_blocks).alias("_block"),
                                              *[m.alias(f"_m{i}") for i, m in enumerate(_masks(k))])
    return masked.groupBy("_block").agg(*[F.bit_or(f"_m{i}").alias(f"_w{i}") for i in range(WORDS)])


def bloom_pass(rows: DataFrame, key: str, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """Rows with a flag ``_maybe``: false only where the key is surely not in the filter."""
    k = F.col(key)
    probed = rows.withColumn("_block", _block(k, n_blocks)).join(F.broadcast(blocks), "_block", "left")
    hit = k.isNotNull()
    for i, m in enumerate(_masks(k)):
        hit = hit & (F.coalesce(F.col(f"_w{i}"), F.lit(0).cast("long")).bitwiseAND(m) != 0)
    return probed.withColumn("_maybe", hit).drop("_block", *[f"_w{i}" for i in range(WORDS)])


def rule_of(host: Column, path: Column, rules=None) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(RULES if rules is None else rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_filter(pages: DataFrame, listed: DataFrame, rules=None, url_col: str = "url", listed_col: str = "url",
               max_blocks: int = 1 << 16, keys_per_block: int = 40) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``canonical_url``, ``rule``, ``listed``, ``verdict``.

    ``listed``: urls to block unless a rule says otherwise. Columns of ``pages`` with one of these
    names are replaced; all others are kept.
    """
    keys = listed.select(canonical(F.col(listed_col)).alias("_key")).where(F.col("_key").isNotNull()).distinct()
    n_blocks = max(1, min(max_blocks, -(-keys.count() // keys_per_block)))
    blocks = bloom_blocks(keys, "_key", n_blocks)
    own = [c for c in pages.columns if c not in ("host", "path", "canonical_url", "rule", "listed", "verdict")]
    rows = pages.select(F.struct(*own).alias("_own"), host_of(F.col(url_col)).alias("_host"), path_of(F.col(url_col)).alias("_path"),
                        canonical(F.col(url_col)).alias("_canon"))
    flagged = bloom_pass(rows, "_canon", blocks, n_blocks)
    exact = (flagged.where("_maybe").join(keys.withColumn("_in", F.lit(True)), F.col("_canon") == F.col("_key"), "left")
             .withColumn("_listed", F.coalesce("_in", F.lit(False))).drop("_in", "_key"))
    sure = flagged.where(~F.col("_maybe")).withColumn("_listed", F.lit(False))
    rule = rule_of(F.col("_host"), F.col("_path"), rules)
    judged = exact.unionByName(sure).withColumn("_rule", rule)
    named = [F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_canon").alias("canonical_url")]
    return judged.select(
        *[F.col("_own")[c].alias(c) for c in own], *named, F.col("_rule.rule").alias("rule"),
        F.col("_listed").alias("listed"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
