"""URL rules by a cascade of Bloom filters, in DataFrame functions only.

A rule is a host and a path: it fits that host and its subdomains where the
path starts with the rule's. A URL can only fit the rules that equal one of its
*keys*: a host suffix of as many labels, and a path prefix of as many
characters, as some rule has. All keys of the corpus are the universe. Level 0
of the cascade encodes the listed keys, level 1 the keys of the universe that
pass level 0 wrongly, level 2 the listed keys that pass level 1, and so on until
no key passes wrongly. A lookup walks the levels and is exact for each key of
the universe, so the verdict needs no join.

Cases: a NULL URL, or one without ``://``, has an empty host and path and fits
no rule. Repeated rows are judged alike. Without pages, or without rules, every
verdict is the default. Of fitting rules of one length the larger in string order
wins. A rule given with two verdicts is an error. Columns of
the pages may have any names: only the URL is read and the added columns replace
their namesakes.

Size: a level takes about ``BITS`` bits a key. The listed keys are a rule list that
its owner hands over, so level 0 is as long as that list; every later level is a small
fraction of the one before. Levels are literals of the plan.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

#: Bits for each encoded key, and hash functions.
BITS = 12
HASHES = 4


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def _split(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def shapes_of(rules: list[str]) -> list[tuple[int, int]]:
    """(labels of the host, characters of the path) that rules have."""
    return sorted({(host.count(".") + 1, len(path)) for host, path in map(_split, rules)})


def keys_of(host: Column, path: Column, shapes: list[tuple[int, int]]) -> list[Column]:
    """The key of a URL for each shape of a rule; NULL where it is too short for one."""
    labels = F.size(F.split(host, r"\.", -1))
    return [
        F.when(
            (host != "") & (labels >= k) & (F.length(path) >= n),
            F.concat(F.substring_index(host, ".", -k), F.substring(path, 1, n)),
        )
        for k, n in shapes
    ]


def _places(key: Column, bits: int, level: int) -> list[Column]:
    """The bits of a key, by other hash functions in each level."""
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + i), key), F.lit(bits)) for i in range(HASHES)]


def _level(keys: DataFrame, level: int) -> tuple[int, list[int]] | None:
    """A filter over the keys as (bits, 64-bit words); None without keys."""
    many = keys.count()
    if not many:
        return None
    bits = -(-many * BITS // 64) * 64
    place = F.explode(F.array(*_places(F.col("key"), bits, level)))
    found = (
        keys.select(place.alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("set"))
        .collect()
    )
    words = [0] * (bits // 64)
    for word, value in found:
        words[word] = value
    return bits, words


def _passes(key: Column, filters: tuple[int, list[int]], level: int) -> Column:
    bits, words = filters
    table = F.array(*(F.lit(word).cast("long") for word in words))
    held = F.lit(True)
    for at in _places(key, bits, level):
        word = F.element_at(table, F.shiftright(at, 6).cast("int") + 1)
        held = held & (F.getbit(word, at.bitwiseAND(63).cast("int")) == 1)
    return held


def build_cascade(universe: DataFrame, listed: DataFrame) -> list[tuple[int, list[int]]]:
    """The levels for the listed keys within the universe; both have one column ``key`` without repeats.

    Each round runs over the keys that passed the round before, and no key is dropped
    before the cascade tells it apart.
    """
    inside, outside = listed.join(universe, "key", "left_semi"), universe.join(listed, "key", "left_anti")
    levels: list[tuple[int, list[int]]] = []
    while True:
        made = _level(inside, len(levels))
        if made is None:
            return levels
        levels.append(made)
        outside = outside.where(_passes(F.col("key"), made, len(levels) - 1))
        inside, outside = outside, inside


def member(key: Column, levels: list[tuple[int, list[int]]]) -> Column:
    """Whether a key of the universe is listed: the first level that it fails decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(range(len(levels))):
        answer = F.when(_passes(key, levels[level], level), answer).otherwise(F.lit(level % 2 == 1))
    return answer


def judge(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", url: str = "url") -> DataFrame:
    """The pages with ``host``, ``path``, the longest fitting ``rule`` or NULL, and the ``verdict``.

    ``rules`` holds (verdict, rule). Where none fits, no key of the page is listed and the
    verdict is the default.
    """
    verdicts: dict[str, str] = {}
    for verdict, rule in rules:
        if verdicts.setdefault(rule, verdict) != verdict:
            raise ValueError(f"two verdicts for {rule}")
    shapes = shapes_of(list(verdicts))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    keys = keys_of(host, path, shapes)
    universe = pages.select(F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL").distinct() if keys else None
    judged = pages.withColumns({"host": host, "path": path})
    fits = []
    for kind in sorted(set(verdicts.values())):
        listed = pages.sparkSession.createDataFrame([(r,) for r, v in sorted(verdicts.items()) if v == kind], "key string")
        levels = build_cascade(universe, listed)
        fits += [
            F.when(key.isNotNull() & member(key, levels), F.struct(F.length(key).alias("size"), key.alias("rule"), F.lit(kind).alias("verdict")))
            for key in keys_of(F.col("host"), F.col("path"), shapes)
        ]
    rule, verdict = F.lit(None).cast("string"), F.lit(default)
    if fits:
        best = F.array_max(F.array(*fits))
        rule, verdict = best["rule"], F.coalesce(best["verdict"], F.lit(default))
    return judged.withColumns({"rule": rule, "verdict": verdict})
