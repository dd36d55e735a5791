"""URL filter: a trie over reversed host labels and path segments.

Every rule ``(verdict, host, path)`` sits at the node of its host's labels,
read from the right, and below it at the node of its path's segments.  A url
walks the host labels once; at each node with rules it walks the path segments.
The longest rule met (length of ``host + path``, then of ``host``) decides.
The trie is broadcast: the rule list is configuration of the caller, and more
than ``MAX_RULES`` rules are refused.

Rows: a null url, or one without ``://``, has an empty host and path; no rule
fits it unless the rule's host is met by an empty host.  Urls that no rule fits
get ``default``.  Repeated rows give repeated results; an empty table gives an
empty result; columns other than the id and the url are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from .common import small_batches

MAX_RULES = 1_000_000
SCHEMA = "host string, path string, rule string, verdict string"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HOST_END = re.compile(r"[/?#]")
_PATH_END = re.compile(r"[?#]")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host after the first ``://``, A-Z lower-cased; the path up to ``?`` or ``#``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = _HOST_END.search(rest)
    if end is None:
        return rest.translate(_LOWER), ""
    return rest[:end.start()].translate(_LOWER), _PATH_END.split(rest[end.start():], maxsplit=1)[0]


class _Node:
    __slots__ = ("children", "paths")

    def __init__(self) -> None:
        self.children: dict[str, _Node] = {}
        self.paths: _PathNode | None = None


class _PathNode:
    """``children`` by whole segment; ``tails``: (text that the next segment starts with, rule)."""

    __slots__ = ("children", "tails")

    def __init__(self) -> None:
        self.children: dict[str, _PathNode] = {}
        self.tails: list[tuple[str, tuple]] = []


class UrlTrie:
    """``rules``: (verdict, host, path) with verdict ``allow`` or ``block``; an empty path fits every url of the host."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules; the trie is broadcast and must stay small")
        self.root, self.any_path = _Node(), {}
        seen: dict[tuple[str, str], str] = {}
        for verdict, host, path in rules:
            host = host.translate(_LOWER)
            if verdict not in ("allow", "block") or path[:1] not in ("", "/"):
                raise ValueError(f"not a rule: {(verdict, host, path)}")
            if seen.setdefault((host, path), verdict) != verdict:
                raise ValueError(f"{host}{path} is both allowed and blocked")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.children.setdefault(label, _Node())
            node.paths = node.paths or _PathNode()
            rule = (len(host) + len(path), len(host), host + path, verdict)
            if not path:
                self.any_path[id(node.paths)] = rule
                continue
            *whole, tail = path[1:].split("/")
            at = node.paths
            for segment in whole:
                at = at.children.setdefault(segment, _PathNode())
            at.tails.append((tail, rule))

    def longest(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule text, verdict) of the longest rule that fits, or (None, None)."""
        best = None
        segments = path[1:].split("/") if path.startswith("/") else None
        node = self.root
        for label in reversed(host.split(".")):
            node = node.children.get(label)
            if node is None:
                break
            if node.paths is None:
                continue
            found = [self.any_path.get(id(node.paths))]
            if segments is not None:
                at = node.paths
                for depth, segment in enumerate(segments):
                    found += [rule for tail, rule in at.tails if segment.startswith(tail)]
                    at = at.children.get(segment)
                    if at is None or depth == len(segments) - 1:
                        break
            for rule in found:
                if rule is not None and (best is None or rule[:2] > best[:2]):
                    best = rule
        return (best[2], best[3]) if best else (None, None)


def url_filter(df: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` for every row; the trie goes out once as a broadcast variable."""
    UrlTrie(rules)  # refuses bad rules on the driver
    shared = df.sparkSession.sparkContext.broadcast(list(rules))
    small_batches(df.sparkSession, 2_000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = UrlTrie(shared.value)
        for batch in batches:
            rows = []
            for u in batch["_url"]:
                host, path = split_url(u)
                rule, verdict = trie.longest(host, path)
                rows.append((host, path, rule, verdict or default))
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype="object")
            out.insert(0, key, batch["_key"].to_numpy())
            yield out

    src = df.select(df[key].alias("_key"), df[url].cast("string").alias("_url"))
    return src.mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, {SCHEMA}")
