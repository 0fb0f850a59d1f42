"""URL verdicts from allow and block lists held in cascades of Bloom filters, all in DataFrame functions."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from threadtables.session import stage

#: Bits for each key of a filter (of the first level at least so many), and its hash functions.
KEY_BITS, HASHES = 10, 3
#: Bytes of the filters that one pass over the URLs takes along; longer lists make more passes.
PASS_BYTES = 4 << 20
_SLICE = 32768  # bits of a bitmap of bitmap_construct_agg

#: Rules: (verdict, host, path).
Rule = tuple[str, str, str]


@dataclass
class Filter:
    """One level: a bit array of `size` bits as 64-bit words."""

    level: int
    size: int
    words: list[int]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.level * HASHES + i), key), F.lit(self.size)) for i in range(HASHES)]

    def holds(self, key: Column) -> Column:
        words = F.from_json(F.lit("[" + ",".join(map(str, self.words)) + "]"), "array<bigint>")
        found = F.lit(True)
        for p in self.positions(key):
            word = F.get(words, F.shiftright(p, 6).cast("int"))
            found = found & (_shifted(word, p).bitwiseAND(F.lit(1)) == 1)
        return found


def _shifted(word: Column, place: Column) -> Column:
    return F.call_function("shiftrightunsigned", word, (place % 64).cast("int"))


def first_bits(listed: int, universe: int) -> int:
    """Bits for each listed key at level 0 that make levels 0 and 1 smallest together: the more keys the universe has for
    each listed one, the fewer of them may pass."""
    return max(KEY_BITS, math.ceil(HASHES * (KEY_BITS * universe / max(listed, 1)) ** (1 / (HASHES + 1))))


def expected_bytes(listed: int, universe: int) -> int:
    """Bytes of a whole cascade; those beyond level 1 are a tenth of it at most."""
    if not listed:
        return 0
    bits = first_bits(listed, universe)
    passing = universe * (1 - math.exp(-HASHES / bits)) ** HASHES
    return math.ceil(1.1 * (listed * bits + passing * KEY_BITS) / 8)


def _filter(keys: DataFrame, n: int, level: int, bits_each: int = KEY_BITS) -> Filter:
    out = Filter(level, max(64, -(-n * bits_each // 64) * 64), [])
    places = keys.select(F.explode(F.array(*out.positions(F.col("key")))).alias("p"))
    slices = places.groupBy(F.expr(f"p div {_SLICE}").alias("s")).agg(F.bitmap_construct_agg(F.col("p") % _SLICE).alias("bits")).collect()
    bits = np.zeros(-(-out.size // _SLICE) * _SLICE // 8, np.uint8)
    for r in slices:
        bits[r["s"] * _SLICE // 8:(r["s"] + 1) * _SLICE // 8] = np.frombuffer(r["bits"], np.uint8)
    out.words = bits[:out.size // 8].view("<i8").tolist()
    return out


@dataclass
class Cascade:
    """Level 0 encodes the listed keys, level 1 what else of the universe passes level 0, level 2 the listed keys that
    pass level 1, and so on; so membership is exact for every key of the universe."""

    levels: list[Filter]

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for f in reversed(self.levels):
            answer = F.when(f.holds(key), answer).otherwise(F.lit(f.level % 2 == 1))
        return answer


def cascade(keys: DataFrame) -> Cascade:
    """From the whole universe: rows (key, listed), each key once. Keys that pass on get fewer with each level."""
    levels: list[Filter] = []
    rest = keys
    while True:
        level = len(levels)
        own = rest.where(F.col("listed") == F.lit(level % 2 == 0))
        n = own.count()
        if not n:
            return Cascade(levels)
        levels.append(_filter(own, n, level, KEY_BITS if level else first_bits(n, keys.count())))
        rest = rest.where((F.col("listed") == F.lit(level % 2 == 0)) | levels[-1].holds(F.col("key")))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased, and the path; both empty for null or without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _shapes(rules: Iterable[Rule]) -> list[tuple[int, int]]:
    return sorted({(host.count(".") + 1, len(path)) for _, host, path in rules})


def _rule_key(labels: int, length: int) -> Column:
    """The only string that a rule of this shape could have to fit the URL; null if it has too few labels or too short
    a path."""
    fits = (F.size(F.split("host", r"\.")) >= labels) & (F.char_length("path") >= length)
    return F.when(fits, F.concat(F.substring_index("host", ".", -labels), F.substring(F.col("path"), 1, length)))


def judge(pages: DataFrame, rules: list[Rule], blocked_hosts: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page (page_id, url).

    A rule fits its host and all subdomains if the path starts with the rule's; of several the longest string decides,
    then the longer host. Without a rule a URL is blocked if its host is in `blocked_hosts` (host), else allowed. Rules
    and hosts are keys of two cascades, allow and block, built over all keys of the corpus; URLs are judged by filters
    alone. Where the cascades over a large corpus or of long lists go beyond PASS_BYTES, keys are split by hash and
    probed in several passes. A null URL has an empty
    host and path and is allowed; repeated rows are judged each; extra columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    shapes = _shapes(rules)
    candidates = {f"r{i}": _rule_key(*s) for i, s in enumerate(shapes)}
    keyed = pages.select("*", *(F.concat(F.lit("rule "), c).alias(k) for k, c in candidates.items()), F.concat(F.lit("host "), "host").alias("h"))
    columns = [*candidates, "h"]
    seen = keyed.select(F.explode(F.array(*columns)).alias("key")).where("key is not null").select("key", F.lit(False).alias("allow"), F.lit(False).alias("block"))
    spark = pages.sparkSession
    own = spark.createDataFrame([(f"rule {h}{p}", v == "allow", v == "block") for v, h, p in rules], "key string, allow boolean, block boolean")
    hosts = blocked_hosts.where("host is not null").select(F.concat(F.lit("host "), "host").alias("key"), F.lit(False).alias("allow"), F.lit(True).alias("block"))
    universe = stage(seen.unionByName(own).unionByName(hosts).groupBy("key").agg(F.max("allow").alias("allow"), F.max("block").alias("block")), "url-keys")
    counts = universe.agg(F.count("*").alias("all"), *(F.count_if(kind).alias(kind) for kind in ("allow", "block"))).first()
    passes = max(1, -(-sum(expected_bytes(counts[kind], counts["all"]) for kind in ("allow", "block")) // PASS_BYTES))
    part = lambda key: F.pmod(F.xxhash64(F.lit(-1), key), F.lit(passes))
    hits = {f"{c}_{kind}": F.lit(False) for c in columns for kind in ("allow", "block")}
    for g in range(passes):
        mine = universe.where(part(F.col("key")) == g)
        for kind in ("allow", "block"):
            filters = cascade(mine.select("key", F.col(kind).alias("listed")))
            for c in columns:
                probe = F.col(c).isNotNull() & filters.holds(F.col(c))
                hits[f"{c}_{kind}"] = F.when(part(F.col(c)) == g, probe).otherwise(hits[f"{c}_{kind}"])
        if passes > 1:
            keyed = stage(keyed.select(*pages.columns, *columns, *(v.alias(k) for k, v in hits.items())), "url-hits")
            hits = {k: F.col(k) for k in hits}
    found = keyed.select(*pages.columns, *columns, *(v.alias(k) for k, v in hits.items()))
    fitting = [
        F.when(F.col(f"{c}_allow") | F.col(f"{c}_block"), F.struct(
            F.char_length(c).alias("length"), F.char_length(F.substring_index("host", ".", -shapes[i][0])).alias("host_length"),
            F.expr(f"substring({c}, 6)").alias("rule"), F.when(F.col(f"{c}_allow"), "allow").otherwise("block").alias("verdict")))
        for i, c in enumerate(candidates)]
    longest = F.greatest(*fitting) if len(fitting) > 1 else fitting[0] if fitting else F.lit(None).cast("struct<length:int,host_length:int,rule:string,verdict:string>")
    return found.withColumn("best", longest).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("h_block"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def hosts_with_label(pages: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """host: all hosts of the pages with one of these labels between their dots."""
    host, _ = host_and_path(F.col("url"))
    return pages.select(host.alias("host")).where(F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, labels)))).distinct()
