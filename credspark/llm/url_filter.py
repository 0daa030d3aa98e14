"""URL filters: a blocked Bloom filter before an exact hash join.  DataFrame functions only.

The list holds canonical (host, path) entries, each with a verdict.  An entry
fits its host and all subdomains of it, where the URL's path starts with the
entry's path; the longest fitting entry decides and ``allow`` holds where
none fits.  Each URL probes the filter with every (host suffix, path prefix
of a listed length); the exact join afterwards removes false positives.

Defined results: a null URL or one without ``://`` has an empty host and path
and can match no entry with a host; empty list: everything is allowed;
entries listed twice count once, and ``block`` wins between equal entries;
repeated pages keep their rows; other columns of ``pages`` are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8            # 64-bit words in a block: 512 bits, one cache line
BITS_PER_KEY = 16    # false positives of about 1 in 1,000 with one bit in each word
#: Filters up to this size are broadcast; beyond it, Spark joins them by shuffle.
BROADCAST_BYTES = 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"\A([^?#]*)", 1)


def _block(host: Column, path: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(n_blocks))


def _bit(host: Column, path: Column, word: int) -> Column:
    """The word's bit of a key: 6 bits of a second hash."""
    h = F.xxhash64(F.lit("bit"), host, path)
    return F.shiftright(h, 6 * word).bitwiseAND(F.lit(63)).cast("int")


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def bloom_blocks(keys: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0..w7) of the filter over ``keys`` (host, path): one row for each block in use."""
    h, p = F.col("host"), F.col("path")
    return (keys.select(_block(h, p, n_blocks).alias("block"), *[_bit(h, p, w).alias(f"b{w}") for w in range(WORDS)])
            .groupBy("block").agg(*[F.bit_or(_one(F.col(f"b{w}"))).alias(f"w{w}") for w in range(WORDS)]))


def maybe_listed(probes: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """The rows of ``probes`` (host, path, ...) whose key the filter over ``keys`` lets pass."""
    n_blocks = max(1, -(-n_keys * BITS_PER_KEY // (64 * WORDS)))
    blocks = bloom_blocks(keys, n_blocks)
    if n_blocks * (8 * WORDS + 16) <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    h, p = F.col("host"), F.col("path")
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.col(f"w{w}").bitwiseAND(_one(_bit(h, p, w))) != 0)
    return (probes.withColumn("block", _block(h, p, n_blocks)).join(blocks, "block").filter(hit)
            .drop("block", *[f"w{w}" for w in range(WORDS)]))


def url_filter(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    ``listed``: host, path, verdict (allow or block); it may have any size.
    """
    entries = (listed.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
               .withColumn("rule", F.concat("host", "path")))
    about = entries.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("path")).alias("lengths")).first()
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))

    #: The same URL is judged once.  The lengths of listed paths are few numbers, whatever the list's size.
    once = urls.filter("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).drop("n")
    labels = F.size(F.split("host", r"\."))
    lengths = F.filter(F.array(*[F.lit(int(x)) for x in sorted(about["lengths"])]).cast("array<int>"),
                       lambda n: n <= F.length("path"))
    probes = (once.select(F.col("host").alias("u_host"), F.col("path").alias("u_path"), lengths.alias("ls"),
                          F.explode(F.sequence(F.lit(1), labels)).alias("k"))
              .select("u_host", "u_path", "k", F.explode("ls").alias("len"))
              .select("u_host", "u_path",
                      F.call_function("substring_index", F.col("u_host"), F.lit("."), -F.col("k")).alias("host"),
                      F.substring(F.col("u_path"), F.lit(1), F.col("len")).alias("path")))
    hits = maybe_listed(probes, entries.select("host", "path"), about["n"]).join(entries, ["host", "path"])
    best = hits.groupBy("u_host", "u_path").agg(
        F.max(F.struct(F.length("rule").alias("len"), "rule", "verdict")).alias("best"))
    u, b = urls.alias("u"), best.alias("b")
    return (u.join(b, (F.col("u.host") == F.col("b.u_host")) & (F.col("u.path") == F.col("b.u_path")), "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit("allow")).alias("verdict")))
