"""URL filters by a sorted digest array.

An entry is a host with a path prefix, ``example.net/en/``; it fits its host
and all subdomains if the URL's path starts with the prefix.  All entries lie
in one file: their 64-bit xxhash keys in order, then where each entry's text
begins, then the texts.  Executors fetch the file and map it into memory.  For a URL, each
host suffix is joined with each path prefix of a length that occurs; the keys of
these strings are looked up by a vectorised binary search, and a hit counts
only if the stored text is the same, so colliding digests do no harm.

Rules come before the list: the longest fitting rule gives the verdict.  A URL
without a fitting rule is blocked if an entry of the block list fits it.

Defined cases: a null URL, or one without ``://``, has an empty host and path and fits
nothing; the empty host is allowed; of equal entries the last one counts;
repeated rows and null ids pass through; an empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martflow.llm.flat import map_texts

#: The rules of the mix, and hosts that are nothing but offers.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
BLOCKED = tuple(f"{name}.example.{top}/" for name in ("casino-win", "cheap-pills", "free-bets", "spam-farm", "ads-track") for top in ("com", "net", "org"))
#: Most bytes of a digest file; a longer list takes several, which are all asked.
MOST_BYTES = 1 << 30

_URL = re.compile(r"\A.*?://([^/?#]*)([^?#]*)", re.S)
_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def digest_files(entries: dict[str, str], into: str, most: int | None = None) -> list[str]:
    """Digest files of entry -> verdict, as many as ``most`` bytes for each call for."""
    parts, size = [{}], 0
    for e, verdict in entries.items():
        # its key, its end and its text, and at most one more length in the head
        need = 24 + len(e.encode()) + 1 + len(verdict.encode())
        if parts[-1] and size + need > (most or MOST_BYTES) - 24:
            parts.append({})
            size = 0
        parts[-1][e] = verdict
        size += need
    return [digest_file(p, into) for p in parts]


def digest_file(entries: dict[str, str], into: str) -> str:
    """Write the sorted digest array of entry -> verdict; returns the path, named by its content."""
    keys = np.array([xxhash.xxh64_intdigest(e) for e in entries], np.uint64)
    order = np.argsort(keys, kind="stable")
    names = list(entries)
    texts = [f"{names[i]}\t{entries[names[i]]}".encode() for i in order]
    ends = np.cumsum([0] + [len(t) for t in texts]).astype(np.int64)
    lengths = sorted({len(e) - e.index("/") for e in entries})
    hosts = [e[:e.index("/")] for e in entries]
    labels, longest = max((h.count(".") + 1 for h in hosts), default=0), max(map(len, hosts), default=0)
    head = np.array([len(texts), len(lengths), labels, longest, *lengths], np.int64)
    body = head.tobytes() + keys[order].tobytes() + ends.tobytes() + b"".join(texts)
    path = Path(into, f"digests-{hashlib.sha256(body).hexdigest()[:24]}.bin")
    path.write_bytes(body)
    return str(path)


class Digests:
    """A digest file, mapped into memory."""

    def __init__(self, path: str):
        self.raw = np.memmap(path, np.uint8, "r")
        n, m, self.labels, self.widest = self.raw[:32].view(np.int64).tolist()
        at = 32 + 8 * m
        self.lengths = self.raw[32:at].view(np.int64).tolist()
        self.keys = self.raw[at:at + 8 * n].view(np.uint64)
        self.ends = self.raw[at + 8 * n:at + 16 * n + 8].view(np.int64)
        self.texts = self.raw[at + 16 * n + 8:]

    def find(self, entries: list[str]) -> list[str | None]:
        """The verdict stored for each string, or None."""
        keys = np.fromiter(map(xxhash.xxh64_intdigest, entries), np.uint64, len(entries))
        out: list[str | None] = [None] * len(entries)
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(high > low):
            for k in range(low[i], high[i]):
                text, _, verdict = self.texts[self.ends[k]:self.ends[k + 1]].tobytes().decode().rpartition("\t")
                if text == entries[i]:
                    out[i] = verdict
        return out

    def suffixes(self, host: str) -> list[str]:
        """The host and its parent domains, as far as an entry can have as many labels and characters."""
        parts = host.rsplit(".", self.labels)
        out = [".".join(parts[k:]) for k in range(max(0, len(parts) - self.labels), len(parts))]
        return [x for x in out if x and len(x) <= self.widest]

    def longest(self, urls: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        """The longest entry that fits each (host, path), and its verdict; of equally long ones that of the longer host."""
        asked, of = [], []
        for i, (host, path) in enumerate(urls):
            prefixes = [path[:n] for n in self.lengths if n <= len(path)]
            for suffix in self.suffixes(host) if prefixes else ():
                asked += [suffix + p for p in prefixes]
                of += [(i, len(suffix))] * len(prefixes)
        best: list = [None] * len(urls)
        for entry, (i, n), verdict in zip(asked, of, self.find(asked)):
            if verdict is not None and (best[i] is None or (len(entry), n) > best[i][0]):
                best[i] = ((len(entry), n), entry, verdict)
        return [b and b[1:] for b in best]


class DigestList:
    """Digest files, asked together."""

    def __init__(self, paths: list[str]):
        self.files = [Digests(p) for p in paths]

    def longest(self, urls: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        found = [f.longest(urls) for f in self.files]
        # of equally long entries that of the longer host
        rank = lambda x: (len(x[0]), x[0].index("/"))
        return [max((x for x in each if x), key=rank, default=None) for each in zip(*found)]


def host_and_path(url: str | None) -> tuple[str, str]:
    m = _URL.match(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def _shared(spark: SparkSession, entries: dict[str, str]) -> list[str]:
    """Names under which the executors get the digest files of ``entries``."""
    paths = digest_files(entries, tempfile.mkdtemp(prefix="martflow-digests-"))
    sent = spark.sparkContext.__dict__.setdefault("_martflow_digests", set())
    for path in paths:
        if Path(path).name not in sent:
            spark.sparkContext.addFile(path)
            sent.add(Path(path).name)
    return [Path(p).name for p in paths]


def judge(pages: DataFrame, page: str = "page_id", url: str = "url", rules: dict[str, str] | None = None,
          blocked: tuple[str, ...] = BLOCKED) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``."""
    spark = pages.sparkSession
    first, second = _shared(spark, RULES if rules is None else rules), _shared(spark, dict.fromkeys(blocked, "block"))
    fields = [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict")]

    def make():
        ruled, listed = (DigestList([SparkFiles.get(n) for n in names]) for names in (first, second))

        def work(urls):
            split = [host_and_path(u) for u in urls]
            unique = list(dict.fromkeys(split))
            rule = dict(zip(unique, ruled.longest(unique)))
            # an entry for a host alone also fits a URL that has no path
            block = dict(zip(unique, listed.longest([(h, p or "/") for h, p in unique])))
            verdicts = [rule[u][1] if rule[u] else "block" if block[u] else "allow" for u in split]
            columns = [[h for h, _ in split], [p for _, p in split], [rule[u] and rule[u][0] for u in split], verdicts]
            return [pa.array(c, pa.string()) for c in columns]

        return work

    return map_texts(pages, make, fields, url, [page])


def _oracle() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    listed = lambda entries: ", ".join(f"('{e}', '{v}')" for e, v in entries.items())
    parts = "entry, verdict, split_part(entry, '/', 1) AS h, substr(entry, strpos(entry, '/')) AS pre"
    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{split}', 1), '{upper}', '{upper.lower()}') AS host,
             regexp_extract(coalesce(url, ''), '{split}', 2) AS path FROM pages),
r AS (SELECT {parts} FROM (VALUES {listed(RULES)}) AS x(entry, verdict)),
b AS (SELECT {parts} FROM (VALUES {listed(dict.fromkeys(BLOCKED, 'block'))}) AS x(entry, verdict)),
m AS (SELECT *, (SELECT entry FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre)
                 ORDER BY length(entry) DESC, length(h) DESC LIMIT 1) AS rule FROM p)
SELECT page_id, host, path, rule,
       coalesce((SELECT verdict FROM r WHERE r.entry = m.rule),
                CASE WHEN EXISTS (SELECT 1 FROM b WHERE (host = h OR ends_with(host, '.' || h))
                                  AND starts_with(CASE path WHEN '' THEN '/' ELSE path END, pre)) THEN 'block' ELSE 'allow' END) AS verdict
FROM m
"""


ORACLE = _oracle()
