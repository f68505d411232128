"""URL filters: host and path rules in front of a Bloom filter cascade, in DataFrame operations alone.

The cascade encodes which keys of the corpus's complete key universe are listed. Its first level is a Bloom filter of
the listed keys; the second holds the unlisted keys that pass the first, the third the listed keys that pass the
second, and so on until no key passes wrongly. A key's first failing level tells its membership exactly, so pages are
judged by bit tests alone, without a join.

Scale: keys are the domains of distinct hosts, deduplicated before any level is built. Keys are dealt to parts by hash,
about ``PART_KEYS`` listed ones each, so that a part's words are a small array at any size of the list; a level's bits are
OR-ed to 64-bit words map-side. The first level's false-positive rate is about listed / unlisted, so all words together
take about listed * (1.44 * log2(unlisted / listed) + 4) bits: bounded by the list, not by the corpus. Up to
``max_bytes``, which is checked, they are one broadcast row and pages are judged as they are read; the words of a longer
list stay distributed and the distinct domains are sent to their parts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbria.llm.common import cut

#: (verdict, host, path): the most specific (longest) rule that fits wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Domains of link farms, advertisers and pill shops that are blocked with all their subdomains.
LISTED = ("ads-track.example.com", "cheap-pills.example.com", "spam-farm.example.org", "casino-bonus.example.net", "free-downloads.example.org")
LONGEST_DOMAIN, PART_KEYS, MAX_BYTES = 253, 1 << 16, 32 << 20
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), *LOWER), F.lit(""))


def path(url: str = "url") -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: str) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url)))


def rule(rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits columns host and path; null without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    fits = [((F.col("host") == h) | F.endswith(F.col("host"), F.lit(f".{h}"))) & F.startswith(F.col("path"), F.lit(p)) for _, h, p in ordered]
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for (v, h, p), fit in reversed(list(zip(ordered, fits, strict=True))):
        name, verdict = F.when(fit, h + p).otherwise(name), F.when(fit, v).otherwise(verdict)
    return name, verdict


def domains(name: str = "host") -> Column:
    """A host and the domains above it. Only the last 253 characters can hold a domain, so longer hosts stay cheap."""
    tail = F.when(F.length(name) > LONGEST_DOMAIN, F.regexp_replace(F.expr(f"right({name}, {LONGEST_DOMAIN + 1})"), r"^[^.]*\.?", "")).otherwise(F.col(name))
    labels = F.split(tail, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _spots(key: Column, depth: int, bits: int, hashes: int) -> list[Column]:
    first, step = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 10) for seed in (depth, -1 - depth))
    return [F.pmod(first + F.lit(i) * step if i else first, F.lit(bits)) for i in range(hashes)]


def _holds(words: Column, key: Column, depth: int, bits: int, hashes: int) -> Column:
    held = F.lit(True)
    for s in _spots(key, depth, bits, hashes):
        held = held & (F.getbit(F.get(words, F.shiftright(s, 6).cast("int")), s.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return F.coalesce(held, F.lit(False))


@dataclass(frozen=True)
class Cascade:
    """Bits and hashes of each level (the same in all parts) and the table (part, levels array<array<bigint>>) of words."""

    shapes: list[tuple[int, int]]
    parts: int
    table: DataFrame

    @property
    def bytes(self) -> int:
        return self.parts * sum(bits for bits, _ in self.shapes) // 8

    def part(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("part")), F.lit(self.parts)).cast("int")

    def member(self, levels: Column, key: Column) -> Column:
        """Exact membership of a key of the universe, given its part's words: its first failing level is of listed keys (even:
        not listed) or of unlisted ones (odd: listed); passing all levels means being in the last one's own set."""
        out = F.lit(bool(len(self.shapes) % 2))
        for depth in range(len(self.shapes) - 1, -1, -1):
            out = F.when(~_holds(F.get(levels, F.lit(depth)), key, depth, *self.shapes[depth]), F.lit(depth % 2 == 1)).otherwise(out)
        return out

    def found(self, keys: DataFrame) -> DataFrame:
        """The listed ones among distinct ``keys`` (key) of the universe: each meets the words of its part."""
        return keys.withColumn("part", self.part(F.col("key"))).join(self.table, "part").where(self.member(F.col("levels"), F.col("key"))).select("key")


def _level(keys: DataFrame, parts: int, depth: int, bits: int, hashes: int) -> DataFrame:
    """(part, words) of a level over ``keys`` (key, part): every part has bits / 64 words, the empty ones too."""
    spots = keys.select("part", F.explode(F.array(*_spots(F.col("key"), depth, bits, hashes))).alias("s"))
    words = spots.select("part", F.shiftright("s", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
    blank = keys.sparkSession.range(parts).select(F.col("id").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(bits // 64 - 1))).alias("w"), F.lit(0).cast("long").alias("b"))
    whole = words.union(blank).groupBy("part", "w").agg(F.expr("bit_or(b)").alias("b"))
    return whole.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("x")).select("part", F.transform("x", lambda e: e["b"]).alias("words"))


def cascade(universe: DataFrame, listed: DataFrame, part_keys: int = PART_KEYS, max_levels: int = 64) -> Cascade | None:
    """Levels that separate ``listed`` (key) from the rest of ``universe`` (distinct key), both distinct and not null; None
    if no key of the universe is listed."""
    inside = cut(universe.join(listed, "key", "left_semi"))
    n = inside.count()
    if not n:
        return None
    parts = max(1, -(-n // part_keys))
    made = Cascade([], parts, universe.sparkSession.createDataFrame([], "part int, levels array<array<bigint>>"))
    inside, outside = (df.withColumn("part", made.part(F.col("key"))) for df in (inside, universe.join(listed, "key", "left_anti")))
    rate = min(0.5, n / max(outside.count(), 1) / 2)
    tables: list[DataFrame] = []
    while n and len(tables) < max_levels:
        depth, bits = len(tables), max(64, math.ceil(1.1 * n / parts * 1.4427 * math.log2(1 / rate) / 64) * 64)
        hashes = max(1, round(math.log2(1 / rate)))
        level = cut(_level(inside, parts, depth, bits, hashes))
        made.shapes.append((bits, hashes))
        tables.append(level.withColumn("depth", F.lit(depth)))
        passed = outside.join(level, "part").where(_holds(F.col("words"), F.col("key"), depth, bits, hashes)).select("key", "part")
        inside, outside, rate = cut(passed), inside, 0.5
        n = inside.count()
    if n:
        raise ValueError(f"the cascade did not close in {max_levels} levels")
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.union(table)
    table = rows.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("depth", "words"))).alias("x"))
    return Cascade(made.shapes, parts, cut(table.select("part", F.transform("x", lambda e: e["words"]).alias("levels"))))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(key) from a text file or folder of domains, one a line; A-Z are lower-cased, blank lines and ``#`` comments left out."""
    line = F.trim(F.regexp_replace("value", "#.*", ""))
    return spark.read.text(path).select(F.translate(line, *LOWER).alias("key")).where("key <> ''").distinct()


def judge(pages: DataFrame, listed: DataFrame | None = None, rules=RULES, url_col: str = "url", id_col: str = "page_id", max_bytes: int = MAX_BYTES, part_keys: int = PART_KEYS) -> DataFrame:
    """id, host, path, rule, verdict of every row of ``pages``.

    The verdict is that of the longest fitting rule, else block for hosts that are a listed domain or below one
    (``listed``: key; lower-case, at most 253 characters; default ``LISTED``), else allow. A null url or one without
    ``://`` has empty host and path and is allowed unless the empty key is listed. Rows that repeat an id each return
    a row. Very long urls are matched whole; only their host's last 253 characters can hold a listed domain. Other
    columns, whatever their names, are not read. Empty tables give an empty result.
    """
    spark = pages.sparkSession
    listed = listed if listed is not None else spark.createDataFrame([(d,) for d in LISTED], "key string")
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    parsed = pages.select(id_col, host(url_col).alias("host"), path(url_col).alias("path"))
    universe = cut(parsed.select("host").distinct().select(F.explode(domains()).alias("key")).distinct())
    name, verdict = rule(rules)
    ruled = parsed.withColumn("rule", name).withColumn("__verdict", verdict)
    held = cascade(universe, listed, part_keys)
    if held is None:
        out = ruled.withColumn("__bad", F.lit(False))
    elif held.bytes <= max_bytes:  # one row of at most max_bytes, which every page meets by an equi-join on 0
        one = held.table.groupBy(F.lit(0).cast("long").alias("__zero")).agg(F.sort_array(F.collect_list(F.struct("part", "levels"))).alias("__parts"))
        words = lambda d: F.get(F.col("__parts"), held.part(d))["levels"]
        bad = F.exists(domains(), lambda d: held.member(words(d), d))
        out = ruled.withColumn("__zero", F.pmod(F.xxhash64("host"), F.lit(1))).join(F.broadcast(one), "__zero").withColumn("__bad", bad)
    else:
        hosts = parsed.select("host").distinct().withColumn("key", F.explode(domains())).join(held.found(universe), "key", "left_semi").select(F.col("host").alias("__h")).distinct()
        out = ruled.join(hosts, F.col("host") == F.col("__h"), "left").withColumn("__bad", F.col("__h").isNotNull())
    return out.select(id_col, "host", "path", "rule", F.coalesce("__verdict", F.when(F.col("__bad"), "block").otherwise("allow")).alias("verdict"))


def judge_sql() -> str:
    """The same in SQL, with the listed domains looked up directly."""
    listed = ", ".join(f"'{d}'" for d in LISTED)
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fit = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    names = " ".join(f"WHEN {fit(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdicts = " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for v, h, p in ordered)
    return rf"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{LOWER[0]}', '{LOWER[1]}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests)
SELECT page_id, host, path, CASE {names} END AS rule,
  CASE {verdicts} WHEN len(list_filter([{listed}], lambda d: host = d OR ends_with(host, '.' || d))) > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM parsed
"""
