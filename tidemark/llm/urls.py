"""URL filters: rules by host and path, and a Bloom filter before an exact join. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TRACKING = r"(?i)^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
WORDS, PROBES, KEY_BITS = 4, 8, 16  # a block is 4 words of 64 bits; a key sets 2 bits in each


def host(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lowered; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """One form for addresses of one page: host without www., path without trailing slashes, query sorted and without
    tracking fields; neither scheme nor fragment. NULL where there is no host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    fields = F.array_sort(F.filter(F.split(query, "&"), lambda f: (f != "") & ~f.rlike(TRACKING)))
    place = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), r"/+$", ""))
    whole = F.when(F.size(fields) > 0, F.concat(place, F.lit("?"), F.array_join(fields, "&"))).otherwise(place)
    return F.when(host(url) != "", whole)


def rule_for(host_of: Column, path_of: Column, rules=RULES) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits, or NULL.

    A rule fits its host and all hosts below it, and paths that start with its
    path. The length is that of host and path together.
    """
    fits = [
        F.when(((host_of == h) | host_of.endswith(f".{h}")) & path_of.startswith(p),
               F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in rules]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """Two bits in each word of a block, from 48 bits of a second hash."""
    bits = F.xxhash64(F.lit("bits"), url)
    place = lambda i: F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63)
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), place(i).cast("int"))
    return [one(2 * i).bitwiseOR(one(2 * i + 1)) for i in range(WORDS)]


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, word0...): the filter as a table, one row per block that holds a key."""
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(url)))]
    return listed.select(_block(F.col(url), blocks).alias("block"), *masks).groupBy("block").agg(
        *[F.bit_or(f"m{i}").alias(f"word{i}") for i in range(WORDS)])


def on_list(urls: DataFrame, listed: DataFrame, url: str = "canonical", key_bits: int = KEY_BITS) -> DataFrame:
    """The distinct canonical URLs of `urls` that are in `listed`; both have the column `url`. NULL is on no list.

    The filter is a table of blocks, so it may grow with the list: Spark joins
    it to the addresses by block, broadcast only below its own size limit. About
    one in a thousand addresses that are not listed passes at 16 bits a key; a
    join with the list by the address itself takes these out again. A popular
    address is one row before any join.
    """
    wanted = listed.select(url).filter(F.col(url).isNotNull()).distinct()
    blocks = max(1, -(-wanted.count() * key_bits // (64 * WORDS)))
    filled = bloom_filter(wanted, url, blocks)
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(url)))]
    asked = (
        urls.select(url).filter(F.col(url).isNotNull()).distinct()
        .select(url, _block(F.col(url), blocks).alias("block"), *masks))
    hit = reduce(lambda a, b: a & b, [F.col(f"word{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)])
    possible = asked.join(filled, "block").filter(hit).select(url)
    return possible.join(wanted, url, "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, canonical) of every row of `pages`.

    The longest rule that fits decides; without one, an address whose canonical
    form is in `listed` (column canonical) is blocked and any other allowed. A
    NULL or broken address has empty host and path, no canonical form, and is allowed.
    """
    address = F.col(url)
    rows = pages.select(
        F.col(key), host(address).alias("host"), path(address).alias("path"), canonical(address).alias("canonical"))
    ruled = rows.withColumn("__rule", rule_for(F.col("host"), F.col("path"), rules))
    asked = ruled.filter(F.col("__rule").isNull())
    hits = on_list(asked, listed).withColumn("__listed", F.lit(True))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("__listed"), "block"), F.lit("allow"))
    return ruled.join(hits, "canonical", "left").select(
        key, "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "canonical")


def keep_allowed(pages: DataFrame, listed: DataFrame, rules=RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """The rows of `pages` with the verdict allow, with their columns."""
    whole = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("page"), pages[url].alias("url"))
    return judge(whole, listed, rules, "page", "url").filter(F.col("verdict") == "allow").select("page.*")
