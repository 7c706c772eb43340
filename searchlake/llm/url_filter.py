"""URL filters over a sorted digest array (operator 8).

A rule is a host and a path prefix.  It fits its host and all subdomains
when the URL's path starts with the rule's; the longest fitting rule decides
(more path first among equal lengths).  The rules' 64-bit xxhash keys form
one sorted array; a worker maps it from a file, probes all candidate keys of
a batch (host suffixes times the path lengths that occur in rules) with one
vectorised binary search, and confirms every match against the stored rule
string, so a hash collision cannot decide.

The array is broadcast behind a check of its size.  A larger list is not
broadcast: the distinct candidates of the URLs meet the rules in a Spark
join on the rule string, and only URLs with a candidate meet them again.

Null URLs and URLs without ``://`` have an empty host and path.  A URL that no rule
fits gets ``default``.  Rules with a null host are ignored; a rule given
twice blocks if any copy blocks.  Repeated rows get equal results.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest rule list (bytes of host and path) that is broadcast.
BROADCAST_BYTES = 64 << 20

_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL column, empty if there is none."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), *_A_TO_Z)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


class DigestArray:
    """The sorted keys of a rule list, mapped from a file, with the strings."""

    def __init__(self, rules: dict[bytes, bool]):
        order = sorted((xxhash.xxh3_64_intdigest(r), r) for r in rules)
        self.rules = [r for _, r in order]
        self.block = [rules[r] for r in self.rules]
        self.lengths = sorted({len(r) - r.find(b"/") if b"/" in r else 0 for r in self.rules}, reverse=True)
        keys = np.array([k for k, _ in order], np.uint64)
        if not len(keys):
            self.keys = keys
            return
        handle, path = tempfile.mkstemp(suffix=".digests")
        with os.fdopen(handle, "wb") as f:
            keys.tofile(f)
        self.keys = np.memmap(path, np.uint64, "r")
        os.unlink(path)  # the mapping keeps the file

    def find(self, candidates: list[bytes]) -> np.ndarray:
        """The place of each candidate in the list, or -1."""
        out = np.full(len(candidates), -1, np.int64)
        if not len(self.keys) or not candidates:
            return out
        digests = np.fromiter(map(xxhash.xxh3_64_intdigest, candidates), np.uint64, len(candidates))
        low, high = np.searchsorted(self.keys, digests, "left"), np.searchsorted(self.keys, digests, "right")
        for i in np.flatnonzero(low < high).tolist():
            for at in range(low[i], high[i]):  # rules of one digest
                if self.rules[at] == candidates[i]:
                    out[i] = at
        return out


def candidates(host: bytes, path: bytes, lengths: list[int]) -> list[bytes]:
    """The rules that could fit, those with more path first."""
    labels = host.split(b".")
    suffixes = [b".".join(labels[i:]) for i in range(len(labels))] if host else []
    return [s + path[:n] for n in lengths if n <= len(path) for s in suffixes]


def _judged(shared, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(shared.value)
        for batch in batches:
            hosts, paths = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("host", "path"))
            own = [candidates(h, p, array.lengths) for h, p in zip(hosts, paths)]
            found = array.find([c for x in own for c in x])
            rules, verdicts, start = [], [], 0
            for x in own:
                fits = [(-len(x[i]), i, at) for i, at in enumerate(found[start : start + len(x)].tolist()) if at >= 0]
                start += len(x)
                at = min(fits)[2] if fits else -1
                rules.append(array.rules[at].decode() if fits else None)
                verdicts.append(("block" if array.block[at] else "allow") if fits else default)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "host", "path")), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["id", "host", "path", "rule", "verdict"],
            )

    return run


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for each row of ``pages``.
    ``rules(host, path, verdict)``: verdict ``allow`` or ``block``, a path
    that is empty or starts with ``/``; ``rule`` is host and path."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    base = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    listed = rules.where("host is not null").groupBy(
        F.concat(F.translate("host", *_A_TO_Z), F.coalesce("path", F.lit(""))).alias("rule")
    ).agg(F.max(F.col("verdict") == "block").alias("block"))
    size = listed.agg(F.sum(F.octet_length("rule"))).first()[0] or 0
    if size <= broadcast_bytes:
        known = {r["rule"].encode(): r["block"] for r in listed.collect()}  # bounded by the check above
        shared = pages.sparkSession.sparkContext.broadcast(known)
        kind = base.schema["id"].dataType.simpleString()
        out = base.mapInArrow(_judged(shared, default), f"id {kind}, host string, path string, rule string, verdict string")
    else:
        out = _joined(base, listed, default)
    return out.withColumnRenamed("id", id_col)


def _joined(base: DataFrame, listed: DataFrame, default: str) -> DataFrame:
    """The same verdicts by a join, for lists of any size.  Distinct (host,
    path) pairs are joined, so a site with very many rows counts once."""
    suffixes = F.expr("transform(sequence(0, size(split(host, '[.]')) - 1), i -> array_join(slice(split(host, '[.]'), i + 1, 1000000), '.'))")
    sites = base.select("host", "path").where("host <> ''").distinct().withColumn("suffix", F.explode(suffixes))
    prefixes = F.expr("transform(sequence(0, length(path)), n -> substr(path, 1, n))")
    # A rule's host has to be there at all before the path's prefixes are listed.
    hosts = listed.select(F.substring_index("rule", "/", 1).alias("suffix")).distinct()
    near = sites.join(hosts, "suffix", "left_semi").withColumn("rule", F.explode(prefixes))
    near = near.withColumn("rule", F.concat("suffix", "rule")).join(listed, "rule")
    rank = Window.partitionBy("host", "path").orderBy(F.octet_length("rule").desc(), F.octet_length("suffix"))
    best = near.withColumn("rank", F.row_number().over(rank)).where("rank = 1").select("host", "path", "rule", "block")
    verdict = F.when(F.col("block"), F.lit("block")).when(F.col("block").isNotNull(), F.lit("allow")).otherwise(F.lit(default))
    return base.join(best, ["host", "path"], "left").select("id", "host", "path", "rule", verdict.alias("verdict"))
