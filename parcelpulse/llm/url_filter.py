"""Exact allow and block lists for urls by Bloom filter cascades, in DataFrame operations only.

A rule is a host and the start of a path. The keys that could be a rule for some url of the
corpus are its host's suffixes (cut at dots) with its path's starts; lists hold few lengths, so
only keys whose pair of lengths occurs in the list are formed. The set of all keys of all urls
is the universe. Level 1 of a cascade encodes the listed keys, level 2 the keys of the universe
that level 1 takes wrongly, level 3 the listed keys that level 2 takes wrongly, and so on until
none are left. Within its universe the cascade is exact, and a lookup reads bits only: no join.

Size: level 1 is dimensioned so that it wrongly takes about ``sqrt(1/2)`` keys per listed key,
whatever the size of the universe, and later levels halve. All levels together have about
``1.44 * log2(universe / listed) + 6`` bits per listed key. That bound does not grow with the
rows of the corpus but by the logarithm, so the bits are literals of the plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICTS = ("allow", "block")


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    words: tuple[int, ...]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://`` with A-Z in lower case, and the path; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _keys(host: Column, path: Column, lengths: list[tuple[int, int]]) -> Column:
    """Structs (size, host size, key) of all keys of a url with one of the pairs of lengths."""
    if not lengths:
        return F.array().cast("array<struct<size:int,of_host:int,key:string>>")
    pairs = F.from_json(
        F.lit("[" + ",".join(f'{{"h":{h},"p":{p}}}' for h, p in sorted(lengths)) + "]"), "array<struct<h:int,p:int>>"
    )
    fits = F.filter(
        pairs,
        lambda x: (x.p <= F.length(path))
        & ((x.h == F.length(host)) | ((x.h < F.length(host)) & (F.substring(host, F.length(host) - x.h, F.lit(1)) == "."))),
    )
    return F.transform(
        fits,
        lambda x: F.struct(
            (x.h + x.p).alias("size"),
            x.h.alias("of_host"),
            F.concat(F.substring(host, F.length(host) - x.h + 1, x.h), F.substring(path, F.lit(1), x.p)).alias("key"),
        ),
    )


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    """Double hashing: the bits that stand for a key in a level."""
    first, step = F.xxhash64(key, F.lit(seed)), F.xxhash64(key, F.lit(seed + 1_000_003))
    half = F.lit(1 << 31)
    a, b = F.pmod(first, half), F.pmod(step, half)
    return [F.pmod(a + b * F.lit(i) + F.lit(i * i), F.lit(bits)) for i in range(hashes)]


def _encode(keys: DataFrame, bits: int, hashes: int, seed: int) -> Level:
    """One row for each 64 bits comes to the driver: the size of the level, see the module's bound."""
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed))).alias("spot"))
    words = (
        spots.groupBy(F.expr("spot div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("held"))
        .collect()
    )
    held = [0] * -(-bits // 64)
    for row in words:
        held[row.word] = row.held
    return Level(bits, hashes, seed, tuple(held))


def _in_level(key: Column, level: Level) -> Column:
    held = F.lit(",".join(map(str, level.words)))
    words = F.split(held, ",").cast("array<bigint>")
    tests = [
        F.getbit(F.get(words, F.shiftright(spot, 6).cast("int")), (spot % 64).cast("int")) == 1
        for spot in _positions(key, level.bits, level.hashes, level.seed)
    ]
    every = tests[0]
    for test in tests[1:]:
        every = every & test
    return every


def in_cascade(key: Column, cascade: list[Level]) -> Column:
    """Whether a key of the universe is listed: the first level that lacks it decides."""
    listed = F.lit(len(cascade) % 2 == 1)
    for depth, level in reversed(list(enumerate(cascade, 1))):
        listed = F.when(~_in_level(key, level), F.lit(depth % 2 == 0)).otherwise(listed)
    return listed


def _level_size(keys: int, wrong: float) -> tuple[int, int]:
    wrong = min(max(wrong, 1e-12), 0.5)
    hashes = max(1, round(-math.log2(wrong)))
    return max(64, math.ceil(-keys * math.log(wrong) / math.log(2) ** 2)), hashes


def build_cascade(listed: DataFrame, universe: DataFrame, n_universe: int, seed: int = 0) -> list[Level]:
    """Levels for the rows ``key`` of ``listed`` among those of ``universe``.

    ``universe`` may repeat keys; it is read once, and only what level 1 takes is kept. Null keys
    don't count. An empty list gives no level, and nothing is listed then.
    """
    ours = listed.where("key is not null").select("key").distinct()
    n = ours.count()
    if not n:
        return []
    wrong = math.sqrt(0.5) * n / max(n_universe - n, n)
    levels = [_encode(ours, *_level_size(n, wrong), seed)]
    taken = universe.where(_in_level(F.col("key"), levels[0])).select("key").distinct().join(ours, "key", "left_anti")
    # what is taken wrongly is about as many keys as are listed: written once, in the shared folder
    ours, taken = ours.checkpoint(), taken.checkpoint()
    inside, outside = taken, ours
    while (n := inside.count()) > 0:
        levels.append(_encode(inside, *_level_size(n, 0.5), seed + 17 * len(levels)))
        inside, outside = outside.where(_in_level(F.col("key"), levels[-1])), inside
    return levels


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", prefix: str = ""
) -> DataFrame:
    """All columns of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, each after ``prefix``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains
    if the url's path starts with the rule's. The longest rule wins, then the longer host, then
    block. Without a rule, the rule is null and the verdict ``otherwise``: a key that no list
    holds is no reason to block. Null urls and urls without ``://`` have an empty host and path.
    Rules with a null field are left out; repeated rules count once. A column of ``pages`` with
    one of the new names is replaced.
    """
    spark = pages.sparkSession
    _checkpoint_folder(spark)
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict"
    )
    host, path = host_and_path(F.col(url))
    lengths = [
        (r.h, r.p) for r in rules.select(F.length("host").alias("h"), F.length("path").alias("p")).distinct().collect()
    ]  # pairs of lengths: bounded by the longest host and path of a rule
    keys = _keys(host, path, lengths)
    universe = pages.select(F.explode(F.transform(keys, lambda k: k.key)).alias("key"))
    n = universe.agg(F.approx_count_distinct("key").alias("n")).first().n
    cascades = {
        v: build_cascade(rules.where(F.col("verdict") == v).select(F.concat("host", "path").alias("key")), universe, n, 101 * i)
        for i, v in enumerate(VERDICTS)
    }
    found = [_found(keys, v, cascade) for v, cascade in cascades.items() if cascade]
    none = F.array().cast("array<struct<size:int,of_host:int,blocks:boolean,key:string>>")
    found = F.flatten(F.array(*found)) if found else none
    best = F.array_max(found)
    verdict = F.when(best.isNull(), otherwise).when(best.blocks, "block").otherwise("allow")
    return pages.withColumns(
        {f"{prefix}host": host, f"{prefix}path": path, f"{prefix}rule": best.key, f"{prefix}verdict": verdict}
    )


def _found(keys: Column, verdict: str, cascade: list[Level]) -> Column:
    listed = F.filter(keys, lambda k: in_cascade(k.key, cascade))
    return F.transform(
        listed,
        lambda k: F.struct(k["size"], k.of_host, F.lit(verdict == "block").alias("blocks"), k.key),
    )


def _checkpoint_folder(spark: SparkSession) -> None:
    """checkpoint() writes to the folder the cluster names; a local session may have none."""
    from parcelpulse.session import shared_folder

    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
