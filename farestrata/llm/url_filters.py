"""URL rules by a sort-merge range join over reversed hosts.

A host is turned around by its labels (``www.example.com`` becomes ``com.example.www.``). All hosts under a rule's
host then start with the rule's key, so they lie in one interval of the sorted keys, and intervals of rules are nested or
apart. Urls and rules are cut into ranges of that order; a rule stands in every range that its interval meets. Each
range is sorted and swept once: a stack holds the rules whose intervals are open, the innermost on top, and a url asks
the open rules whether its path starts with theirs. The longest rule wins (by the characters of host and path, then
by host); of equal rules a block wins.

Ranges are cut by url key and a hash of path and id, at quantiles of some urls, so one host with very many urls
spreads over many ranges. There are ``MOST_RANGES`` ranges at most and ``LOOKED_AT`` urls each to place them, so what the driver
sees is bounded; larger ranges only sort more. The cuts decide where ranges end, never what a url gets.

Urls that are NULL or have no ``://`` have an empty host and path, which only a rule with an empty host and path could fit.
Rows that repeat are judged alike. NULL rules or rules without a host are refused. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farestrata.llm.common import map_rows, stored

URL = re.compile(r"^.*?://([^/?#]*)([^?#]*)", re.S)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Urls in one range, about; the number of ranges at any size; urls per range looked at to place the cuts.
RANGE_ROWS = 50_000
MOST_RANGES = 10_000
LOOKED_AT = 40
#: Keys longer than any valid host don't place cuts (they are judged like all others).
LONGEST_CUT = 256
FIRST_MIX = -(1 << 63)


def split_url(url: str | None) -> tuple[str, str]:
    found = URL.match(url) if url else None
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def reversed_key(host: str) -> str:
    """Host labels from the top down, each ended by a dot; hosts below it have it as a prefix."""
    return ".".join(reversed(host.split("."))) + "." if host else ""


def _after(key: str) -> str:
    """The first string after all that start with ``key`` (which ends with a dot)."""
    return key[:-1] + "/"


class Sweep:
    """State of one sorted pass: the open rules, innermost last."""

    def __init__(self):
        self.open: list[tuple[str, str, dict[str, tuple]]] = []

    def close_before(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def enter(self, key: str, rule: tuple) -> None:
        """``rule`` is (host, path, verdict)."""
        self.close_before(key)
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, rule[0], {}))
        paths = self.open[-1][2]
        known = paths.get(rule[1])
        if known is None or rule[2] == "block":
            paths[rule[1]] = rule

    def judge(self, key: str, path: str) -> tuple | None:
        self.close_before(key)
        best = None
        for _, host, paths in self.open:
            # a few paths are tried one by one, many are looked up by the prefixes of this path
            fits = (
                [p for p in paths if path.startswith(p)] if len(paths) <= len(path) + 1
                else [path[:n] for n in range(len(path) + 1) if path[:n] in paths]
            )
            if fits:
                found = paths[max(fits, key=len)]
                if best is None or (len(host) + len(found[1]), len(host)) >= (len(best[0]) + len(best[1]), len(best[0])):
                    best = found
        return best


def judge_urls(
    urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``id, host, path, rule, verdict`` for every url. ``rules`` has ``host, path, verdict``.

    ``rule`` is host and path of the rule that decides, NULL where none fits and ``default`` holds.
    """
    spark = urls.sparkSession
    kind = dict(urls.dtypes)[id_col]

    def keyed(batches) -> Iterator:
        for ids, texts in batches:
            parts = [split_url(url) for url in texts]
            hosts = [p[0] for p in parts]
            yield ids, [str(i) for i in ids], [reversed_key(h) for h in hosts], hosts, [p[1] for p in parts]

    split = map_rows(urls.select(id_col, url_col), keyed, f"id {kind}, tie string, key string, host string, path string")
    rows = stored(
        split.select("id", F.xxhash64("path", "tie").alias("mix"), "key", "host", "path"), "url-keys"
    )
    total = rows.count()
    ranges = min(MOST_RANGES, max(1, -(-total // range_rows)))
    chance = min(1.0, LOOKED_AT * ranges / max(total, 1))
    seen = rows.where(
        (F.pmod(F.xxhash64(F.lit(1), "mix", "key"), F.lit(1 << 30)) < int(chance * (1 << 30)) + 1)
        & (F.length("key") <= LONGEST_CUT)
    )
    # about LOOKED_AT short keys for each of at most MOST_RANGES ranges
    points = sorted((r.key, r.mix) for r in seen.select("key", "mix").collect()) if ranges > 1 else []
    cuts = sorted({points[i * len(points) // ranges] for i in range(1, ranges)}) if points else []
    keys = [c[0] for c in cuts]

    def url_rows(batches) -> Iterator:
        for ids, mixes, key, hosts, paths in batches:
            at = [bisect_right(cuts, point) for point in zip(key, mixes, strict=True)]
            none = [None] * len(ids)
            yield at, key, [1] * len(ids), ids, hosts, paths, none

    def rule_rows(batches) -> Iterator:
        for hosts, paths, verdicts in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for host, path, verdict in zip(hosts, paths, verdicts, strict=True):
                if not host or path is None or verdict not in ("allow", "block"):
                    raise ValueError(f"not a rule: {host!r}, {path!r}, {verdict!r}")
                host = host.translate(LOWER)
                key = reversed_key(host)
                first = bisect_right(cuts, (key, FIRST_MIX))
                last = bisect_right(keys, _after(key))
                for at in range(first, last + 1):
                    for column, value in zip(out, (at, key, 0, None, host, path, verdict), strict=True):
                        column.append(value)
            yield out

    schema = f"at int, key string, kind int, id {kind}, host string, path string, verdict string"
    both = map_rows(rows, url_rows, schema).union(
        map_rows(rules.select("host", "path", "verdict"), rule_rows, schema)
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = both.repartition(tasks, "at").sortWithinPartitions("at", "key", "kind")

    def swept(batches) -> Iterator:
        sweep, now = Sweep(), None
        for ats, key, kinds, ids, hosts, paths, verdicts in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for at, k, what, i, host, path, verdict in zip(ats, key, kinds, ids, hosts, paths, verdicts, strict=True):
                if at != now:
                    sweep, now = Sweep(), at
                if what == 0:
                    sweep.enter(k, (host, path, verdict))
                    continue
                rule = sweep.judge(k, path)
                row = (i, host, path, rule[0] + rule[1] if rule else None, rule[2] if rule else default)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield out

    return map_rows(
        dealt, swept, f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    )
