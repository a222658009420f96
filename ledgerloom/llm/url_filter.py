"""URL filters: a blocked Bloom filter of listed addresses in front of an exact hash join.

Listed are rules (host and path prefix, each with its own verdict) and canonical addresses to block.
Both are keys of one filter: blocks of four 64-bit words, two bits per word and key, as a table of
``(block, w0..w3)`` built with a map-side ``bit_or``. A page probes the keys it could match: every
parent domain of a rule's number of labels with every path length that a rule has, and its own canonical address. Only possible
hits go on to the join on the key itself, which removes false positives. The filter and the list
are broadcast while their counted size (for the list the real lengths of its keys) is within ``BROADCAST_BYTES``; else
both joins shuffle. Hosts and paths may be of any length; other columns of the input aren't read.

The verdict is that of the longest fitting rule (of equal length, the longer host), else ``block`` for
a listed canonical address, else ``allow``. A canonical address is the lower-cased host and the
path without trailing slashes; query and fragment don't count. A null url, or one without ``://``, has
empty host and path, fits nothing and is allowed. Every input row gives one row, repeated ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import query, stored, table

BITS_PER_KEY = 24
BLOCK_BITS = 256
BROADCAST_BYTES = 8 << 20
# What a row needs beside its key.
BLOCK_BYTES, KEY_BYTES = 48, 96
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
_AFTER_SCHEME = "://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER_SCHEME, 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER_SCHEME, 2)


def canonical(host: Column, path: Column) -> Column:
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", "")))


def _masks(key: Column) -> list[Column]:
    """Two bits in each of the four words of a key's block."""
    h = F.xxhash64(F.lit("bits"), key)
    bit = lambda i: F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    )
    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(4)]


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of a frame with a column ``key``."""
    words = [m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("key")))]
    return keys.select(_block(F.col("key"), blocks).alias("block"), *words).groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)]
    )


def possible(probes: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """The probes whose bits are all set: every listed key, and few others."""
    if blocks * BLOCK_BYTES <= BROADCAST_BYTES:
        filter_ = F.broadcast(filter_)
    set_ = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("key")))]
    return (
        probes.withColumn("block", _block(F.col("key"), blocks)).join(filter_, "block")
        .where(set_[0] & set_[1] & set_[2] & set_[3])
        .drop("block", "w0", "w1", "w2", "w3")
    )


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """``page_id, url`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``.

    ``rules`` has ``host, path, verdict``; ``listed`` has ``canonical``.
    """
    rule_keys = rules.select(
        F.concat(F.lit("r:"), "host", "path").alias("key"),
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
    ).dropDuplicates(["key"])
    url_keys = listed.where("canonical IS NOT NULL").select(
        F.concat(F.lit("u:"), "canonical").alias("key"), F.lit(None).cast("string").alias("rule"),
        F.lit("block").alias("verdict"), F.lit(0).alias("host_length"),
    ).distinct()
    # Written once: counted, made into the filter and joined.
    keys = stored(rule_keys.unionByName(url_keys), "url-keys")
    count, size = keys.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key") + KEY_BYTES), F.lit(0))).first()
    blocks = blocks_for(count)
    # One row per distinct length of a rule's path: no more than the longest path has characters.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)

    rows = (
        pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("times"))
        .withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    )
    # Of a host only the suffixes that have as many labels as a rule's host, few numbers each.
    sizes = sorted(r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().collect() if r[0] > 0)
    labels = F.size(F.split("host", r"\."))
    domains = F.filter(
        F.array(*[F.when(labels >= k, F.substring_index("host", ".", -k)) for k in sizes]), lambda x: x.isNotNull(),
    ) if sizes else F.array().cast("array<string>")
    starts = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]),
        lambda x: x.isNotNull(),
    ) if lengths else F.array().cast("array<string>")
    tried = F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda s: F.concat(F.lit("r:"), d, s))))
    own = F.array(F.concat(F.lit("u:"), canonical(F.col("host"), F.col("path"))))
    probes = rows.where("host != ''").select("page_id", "url", F.explode(F.concat(tried, own)).alias("key"))
    hits = possible(probes, bloom(keys, blocks), blocks)
    exact = keys if size > BROADCAST_BYTES else F.broadcast(keys)
    found = hits.join(exact, "key").select("page_id", "url", "rule", "verdict", "host_length")
    absent = [F.lit(None).cast(t).alias(n) for n, t in (("rule", "string"), ("verdict", "string"), ("host_length", "int"))]
    best = rows.select("*", *absent).unionByName(found, allowMissingColumns=True).groupBy("page_id", "url").agg(
        F.max("times").alias("times"), F.max("host").alias("host"), F.max("path").alias("path"),
        F.max(F.when(F.col("rule").isNotNull(), F.struct(
            F.length("rule").alias("length"), "host_length", "rule", "verdict"))).alias("best"),
        F.coalesce(F.bool_or(F.col("rule").isNull() & (F.col("verdict") == "block")), F.lit(False)).alias("listed"),
    )
    return best.select(
        "page_id", "url", "host", "path", "best.rule", "listed",
        F.coalesce("best.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        F.explode(F.expr("sequence(1L, times)")).alias("_n"),
    ).drop("_n")


def recrawled(pages: DataFrame) -> DataFrame:
    """Canonical addresses that more than one page has: spellings of one address fetched again."""
    address = canonical(host(F.col("url")), path(F.col("url")))
    return pages.groupBy(address.alias("canonical")).agg(F.count("*").alias("n")).where("n > 1").select("canonical")


SQL = r"""
WITH p AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), c AS (
  SELECT *, CASE WHEN host <> '' THEN host || regexp_replace(path, '/+$', '') END AS canonical FROM p
), rules(h, p, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), f AS (
  SELECT host, path, arg_max(h || rules.p, length(h || rules.p)) AS rule, arg_max(v, length(h || rules.p)) AS v
  FROM (SELECT DISTINCT host, path FROM c) u
  JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p)
  GROUP BY host, path
), n AS (SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.v, CASE WHEN n.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN f ON c.host = f.host AND c.path = f.path LEFT JOIN n ON c.canonical = n.canonical
"""


@query("op2_url_filter", SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    values = ", ".join(str(rule) for rule in RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return judge(pages, rules, recrawled(pages)).select("page_id", "host", "path", "rule", "verdict")
