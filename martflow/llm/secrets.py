"""Secret scans over a trigram inverted index, in DataFrame functions alone.

From each rule's regular expression a Boolean query over lower-case trigrams
is derived that every match must satisfy.  The index holds the postings of the
trigrams that some rule asks for, a staged table (gram, key); a key is the hash
of a document's id and text.  Intersecting and uniting postings by key
gives each rule its candidates, and only there the rule's expression runs.  A
rule without mandatory trigrams runs on every text.  A wrong candidate costs a
scan and no more, so a key that two texts share does no harm.

Matches are leftmost and non-overlapping for each rule; those whose measured
group is too short are dropped.  Spans count code points, the end exclusive.

Defined cases: a null or empty text has no spans; null ids stay null; rows that
repeat, also with equal ids, each get their own result; equal starts are
ordered as the rules are listed; a private key is reported by its header line and
redacted through its END line or the end of its base64 text; an empty table gives an empty result.  Input
columns are carried in one struct, so their names cannot clash.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.staging import staged


class Rule(NamedTuple):
    """A kind of secret: expression, whether letters stand for either case, the group whose length counts, its least length."""

    kind: str
    regex: str
    either_case: bool = False
    group: int = 0
    least: int = 1


#: The base kinds, then token formats that their issuers publish.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
)
BASE = ("assign", "access", "hex")
#: Most strings that a part of an expression is spelled out into.
SPELLED = 64


def trigram_query(regex: str):
    """The Boolean query of ``regex``: a gram, ("and", parts), ("or", parts), or None where nothing is mandatory."""

    def both(a, b):
        return b if a is None else a if b is None or a == b else ("and", [a, b])

    def either(parts):
        plain = [isinstance(p, str) or p is not None and p[0] == "and" and all(isinstance(g, str) for g in p[1]) for p in parts]
        named = [set(grams_of(p)) for p in parts]
        # a conjunction that asks for more than another one adds nothing
        parts = [p for i, p in enumerate(parts) if p not in parts[:i] and not (plain[i] and any(plain[j] and named[j] < named[i] for j in range(len(parts))))]
        return None if not parts or None in parts else parts[0] if len(parts) == 1 else ("or", parts)

    def grams(s):
        found = [s[i:i + 3] for i in range(len(s) - 2)]
        return None if not found else found[0] if len(found) == 1 else ("and", list(dict.fromkeys(found)))

    def spelled(strings):
        return either([grams(s) for s in sorted(strings)])

    def one(code, value):
        """(strings that the part stands for, or None; query of a part that isn't spelled out)."""
        if code is op.LITERAL:
            return {chr(value).lower()}, None
        if code is op.IN and value[0][0] is not op.NEGATE and all(c is op.LITERAL for c, _ in value):
            return {chr(v).lower() for _, v in value}, None
        if code is op.SUBPATTERN:
            return several(value[3])
        if code is op.BRANCH:
            parts = [several(p) for p in value[1]]
            if all(s is not None for s, _ in parts):
                return set().union(*[s for s, _ in parts]), None
            return None, either([q if s is None else spelled(s) for s, q in parts])
        if code in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            strings, query = several(inner)
            if strings is not None and low == high and len(strings) ** low <= SPELLED:
                return {"".join(p) for p in product(strings, repeat=low)}, None
            if strings is not None and (low, high) == (0, 1):
                return strings | {""}, None
            return None, (query if strings is None else spelled(strings)) if low else None
        if code is op.AT:
            return {""}, None
        return None, None

    def several(parts):
        now, query, whole = {""}, None, True
        for code, value in parts:
            strings, asked = one(code, value)
            if strings is not None and len(now) * len(strings) <= SPELLED:
                now = {a + b for a in now for b in strings}
                continue
            query, whole = both(both(query, spelled(now)), asked if strings is None else spelled(strings)), False
            now = {""}
        return (now, None) if whole else (None, both(query, spelled(now)))

    strings, query = several(parser.parse(regex))
    return query if strings is None else spelled(strings)


def grams_of(query) -> list[str]:
    """The trigrams that a query names."""
    if query is None or isinstance(query, str):
        return [query] if query else []
    return list(dict.fromkeys(g for part in query[1] for g in grams_of(part)))


def _holds(query, there: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(there, query)
    out = _holds(query[1][0], there)
    for part in query[1][1:]:
        out = out & _holds(part, there) if query[0] == "and" else out | _holds(part, there)
    return out


def postings(keyed: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key): which texts hold which of ``grams``, case ignored."""
    low = keyed.select("key", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select(F.explode(found).alias("gram"), "key")


def candidates(index: DataFrame, queries: dict) -> DataFrame:
    """(key, rules): the rules whose query a text's postings satisfy; texts without any are left out.

    The grams gathered for a key are at most those of the rules.
    """
    there = index.groupBy("key").agg(F.collect_set("gram").alias("grams"))
    rules = F.array_compact(F.array(*[F.when(_holds(q, F.col("grams")), F.lit(kind)) for kind, q in queries.items()]))
    return there.select("key", rules.alias("rules")).filter(F.size("rules") > 0)


def _pattern(rule: Rule) -> str:
    return ("(?i)" if rule.either_case else "") + rule.regex


#: Spans that are worked on at a time.
CHUNK = 128


def with_matches(rows: DataFrame, rule: Rule, at: int, wanted: Column) -> DataFrame:
    """Adds ``s{at}``: the rule's spans as (start, place in the list of rules, kind, end).

    The gaps between matches, from a split, give the positions.
    """
    p, hits, gaps, sized = F.lit(_pattern(rule)), f"h{at}", f"g{at}", f"v{at}"
    rows = rows.withColumn(hits, F.when(wanted, F.regexp_extract_all("text", p, F.lit(0))))
    some = F.coalesce(F.size(hits) > 0, F.lit(False))
    rows = rows.withColumns({gaps: F.when(some, F.split("text", _pattern(rule), -1)),
                             sized: F.when(some, F.regexp_extract_all("text", p, F.lit(rule.group)))})
    # Running sums in chunks: what a chunk advances, where it begins, and its spans from there.  The cost grows with the spans.
    kind, chunk = "struct<start:bigint,place:int,kind:string,end:bigint>", CHUNK
    rows = rows.withColumn(gaps, F.expr(f"transform({gaps}, g -> length(g))")).withColumn(hits, F.expr(f"transform({hits}, h -> length(h))"))
    sums = f"""transform(sequence(0, (size({hits}) - 1) div {chunk}), c -> cast(
        aggregate(slice({gaps}, int(c * {chunk} + 1), least({chunk}, int(size({hits}) - c * {chunk}))), 0L, (a, g) -> a + g)
        + aggregate(slice({hits}, int(c * {chunk} + 1), {chunk}), 0L, (a, h) -> a + h) as bigint))"""
    rows = rows.withColumn(f"b{at}", F.when(some, F.expr(f"aggregate({sums}, array(0L), (a, x) -> concat(a, array(element_at(a, -1) + x)))")))
    spans = f"""transform(sequence(0, (size({hits}) - 1) div {chunk}), c -> aggregate(
        sequence(int(c * {chunk} + 1), int(least((c + 1) * {chunk}, size({hits})))),
        named_struct('at', b{at}[int(c)], 'out', cast(array() as array<{kind}>)),
        (acc, i) -> named_struct(
            'at', acc.at + {gaps}[i - 1] + {hits}[i - 1],
            'out', if(length({sized}[i - 1]) >= {rule.least}, concat(acc.out, array(named_struct(
                'start', acc.at + {gaps}[i - 1], 'place', {at}, 'kind', '{rule.kind}', 'end', acc.at + {gaps}[i - 1] + {hits}[i - 1]))), acc.out)),
        acc -> acc.out))"""
    found = F.when(some, F.expr(f"flatten({spans})")).otherwise(F.expr(f"cast(array() as array<{kind}>)"))
    return rows.withColumn(f"s{at}", found).drop(hits, gaps, sized, f"b{at}")


def find_secrets(docs: DataFrame, doc: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (all input columns), text and spans, sorted by start and rule, of every document."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                       F.xxhash64(F.col(doc), F.col(text)).alias("key"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.regex)) is not None}
    if queries:
        grams = list(dict.fromkeys(g for q in queries.values() for g in grams_of(q)))
        index = staged(postings(rows, grams), "postings")
        rows = rows.join(candidates(index, queries).hint("shuffle_hash"), "key", "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<string>"))
    for i, r in enumerate(rules):
        wanted = F.coalesce(F.array_contains("rules", r.kind), F.lit(False)) if r.kind in queries else F.lit(True)
        rows = with_matches(rows, r, i, wanted)
    return rows.select("row", "text", F.array_sort(F.concat(*[f"s{i}" for i in range(len(rules))])).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""
    kinds = lambda k: F.filter("spans", lambda s: s["kind"].isin(*k))
    return found.select(F.col(f"row.{doc}").alias("doc_id"),
                        *[F.size(kinds([k])).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(span_text(kinds(BASE)), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def _with(value: Column, use) -> Column:
    """``use(value)``, the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _key_length(text: Column, at: Column) -> Column:
    """Characters of a private key after its header line, which ends at ``at``.

    Through the END line if that is the next line of dashes; or else the run of base64 words that follows (words of 16
    characters or more, then a short one that is padded or ends its line), after header fields if there are any.
    """
    dashes = F.call_function("locate", F.lit("-----"), text, (at + 1).cast("int"))
    to_dashes = F.when(dashes > 0, dashes - at - 1).otherwise(F.length(text)).cast("int")
    closed = F.when(dashes > 0, F.length(F.regexp_extract(F.substring(text, dashes, F.lit(256)), r"^-----END (?:[A-Z]+ )*PRIVATE KEY-----", 0))).otherwise(0)

    def run(flat: Column) -> Column:
        fields = F.length(F.regexp_extract(flat, r"^(?:\s*[A-Za-z-]{1,40}: [^\r\n]*[\r\n]){0,4}", 0))
        words = F.regexp_extract(F.substring(flat, fields + 1, F.length(flat)), r"""^[A-Za-z0-9+/=\s"']*+""", 0)
        short = F.regexp_instr(words, F.lit(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/=]{1,15}(?![A-Za-z0-9+/=])"))
        long = F.length(F.regexp_replace(F.when(short > 0, F.substring(words, F.lit(1), short - 1)).otherwise(words), r"""[\s"']++$""", ""))
        rest = F.substring(flat, fields + long + 1, F.length(flat))
        last = F.length(F.regexp_extract(rest, r"^(?:\s*[A-Za-z0-9+/]+={1,2}|[ \t]*[\r\n]\s*[A-Za-z0-9+/]+(?=[ \t]*(?:[\r\n]|\z)))", 0))
        return F.when(long + last > 0, fields + long + last).otherwise(0)

    # a line end may be spelled as a backslash and a letter
    open_run = _with(F.regexp_replace(F.substring(text, (at + 1).cast("int"), to_dashes), r"\\[rnt]", "\n "), run)
    return _with(closed, lambda c: F.when(c > 0, to_dashes + c).otherwise(open_run)).cast("long")


def redacted(found: DataFrame) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in square brackets.

    The span of a private key is its header line; here the key itself goes with it.
    """
    text = found["text"]  # not by name: a select may give an output of its own that name
    spans = F.transform(found["spans"], lambda s: F.when(s["kind"] == "private_key", s.withField("end", s["end"] + _key_length(text, s["end"]))).otherwise(s))
    cut = lambda at, n: F.substring(text, (at + 1).cast("int"), n.cast("int"))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def chunk(spans: Column, acc: Column, c: Column) -> Column:
        """The text of the spans of a chunk, from ``acc.at``, cut from what is left of the whole text."""
        left = cut(acc["at"], F.length(text) - acc["at"])
        of = lambda rest: F.aggregate(
            F.slice(spans, (c * CHUNK + 1).cast("int"), F.lit(CHUNK)), F.struct(F.lit("").alias("out"), acc["at"].alias("at")),
            lambda a, s: F.struct(
                F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(rest, (a["at"] - acc["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                                                       F.lit("["), s["kind"], F.lit("]"))).otherwise(a["out"]).alias("out"),
                F.greatest(a["at"], s["end"]).alias("at")),
            lambda a: F.struct(a["at"].alias("at"), F.concat(acc["out"], F.array(a["out"])).alias("out")))
        return _with(left, of)

    def all_of(spans: Column) -> Column:
        chunks = F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(chunks, none, lambda acc, c: chunk(spans, acc, c),
                           lambda a: F.concat(F.array_join(a["out"], ""), cut(a["at"], F.length(text) - a["at"])))

    return _with(spans, all_of)


def _oracle() -> str:
    def kind(i: int, r: Rule) -> str:
        p = _pattern(r).replace("'", "''")
        return (f"SELECT doc_id, {i} AS place, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, '{p}', 0) AS h, "
                f"regexp_extract_all(t, '{p}', {r.group}) AS v, string_split_regex(t, '{p}') AS g FROM d")

    one = "kind || ':' || s || ':' || e"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(kind(i, r) for i, r in enumerate(RULES))}),
n AS (SELECT doc_id, place, kind, least, h[i] AS hit, v[i] AS val,
        (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
      FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM m)),
k AS (SELECT doc_id, place, kind, s, s + length(hit) AS e FROM n WHERE length(val) >= least),
a AS (SELECT doc_id, {counts},
        string_agg({one}, ',' ORDER BY s, place) FILTER (place < {len(BASE)}) AS base, string_agg({one}, ',' ORDER BY s, place) AS spans
      FROM k GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
