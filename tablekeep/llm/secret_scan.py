"""Secret scan over a trigram inverted index (DataFrame functions only).

Each rule is a regular expression and nothing else. ``trigram_query`` derives
from its syntax tree a Boolean query over lower-case trigrams that every text
with a match satisfies: the texts a sub-expression can stand for are followed
as long as they are few; where they become too many, or unknown, the trigrams
of what was known so far are kept, and the ends are carried on, so trigrams
across the borders of parts are found too. The query is an OR of ANDs. What
cannot be known (large classes, repeats from nought, back references, syntax
that only the JVM has) asks for nothing, and a rule left with no trigram scans
all documents.

The index holds, for every trigram that some rule asks for, the sorted ids of
the documents that contain it, in blocks of ``BLOCK`` ids so that no posting
list grows without bound. A rule's candidates are the intersections (AND) and
unions (OR) of its posting lists within each block; candidates are then
verified with the rule itself. They are written to the shared work folder, so
that their size is known when they are joined to the texts: few are sent to all
tasks by Spark's own size check, and the texts are not shuffled; many are
joined by shuffle.

Spans come from ``split`` and ``regexp_extract_all`` with the same pattern: a
match starts where the pieces and matches before it end. Positions count code
points, ends are exclusive.

Rules: assign, access and hex, as the contract fixes them; the method's own
rules add spans of ``pem`` (private-key headers) and ``jwt`` (signed tokens).

Defined results: a null or empty text has no span; a null id cannot be posted,
so such rows are verified by every rule; rows that share an id are all verified
when one of them is a candidate; an empty table gives an empty result. Ids are
whole numbers. Extra columns are ignored.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .common import pick

#: Ids of one posting block.
BLOCK = 4096
#: Matches whose positions are added up in one go.
STEPS = 512
#: Most signs of a class, texts of an expression and branches of a query that are followed.
MAX_CLASS, MAX_TEXTS, MAX_BRANCHES = 4, 32, 64


@dataclass(frozen=True)
class Rule:
    """``value``: the group whose length must reach ``least``."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 0


#: The letters of the key words match in either case.
RULES = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    # a run of at least 16 signs is the match of AKIA[A-Z0-9]+ whenever that match is long enough
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    # maximal runs of at least 32 digits
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE = ("assign", "access", "hex")


def trigrams(text: str) -> list[str]:
    return sorted({text[i : i + 3] for i in range(len(text) - 2)})


#: A query is a set of branches (OR), each a set of trigrams (AND); a branch without trigrams is always satisfied.
Query = frozenset
ANYTHING: Query = frozenset({frozenset()})


def any_of(branches: Iterable[frozenset]) -> Query:
    """The OR of the branches, without those that another implies; over many branches ask for nothing."""
    kept: list[frozenset] = []
    for branch in sorted(set(branches), key=lambda b: (len(b), sorted(b))):
        if not any(k <= branch for k in kept):
            kept.append(branch)
    return frozenset(kept) if len(kept) <= MAX_BRANCHES else ANYTHING


def both(a: Query, b: Query) -> Query:
    """The AND of two queries; if its branches are too many, the query of the two that has fewer."""
    if len(a) * len(b) > MAX_BRANCHES:
        return min(a, b, key=lambda q: (q == ANYTHING, len(q)))
    return any_of(x | y for x in a for y in b)


def holds(texts: Iterable[str]) -> Query:
    """One of the texts occurs."""
    return any_of(frozenset(trigrams(t)) for t in texts)


@dataclass(frozen=True)
class Part:
    """What is known of the texts that a sub-expression matches, lower-cased: all of them (``texts``), or else
    what they begin and end with (one of ``heads``, one of ``tails``); and the trigrams they need."""

    texts: frozenset | None
    heads: frozenset
    tails: frozenset
    need: Query = ANYTHING

    @staticmethod
    def of(texts: Iterable[str]) -> "Part":
        texts = frozenset(texts)
        return Part(texts, texts, texts, holds(texts))

    def open(self) -> "Part":
        """The same with its texts no longer known as whole."""
        return Part(None, frozenset(h[:2] for h in self.heads), frozenset(t[-2:] for t in self.tails), self.need)

    def then(self, other: "Part") -> "Part":
        if self.texts is not None and other.texts is not None and len(self.texts) * len(other.texts) <= MAX_TEXTS:
            return Part.of(a + b for a in self.texts for b in other.texts)
        need = both(self.need, other.need)
        if len(self.tails) * len(other.heads) <= MAX_TEXTS:
            need = both(need, holds(t + h for t in self.tails for h in other.heads))
        heads, tails = self.heads, other.tails
        if self.texts is not None and len(self.texts) * len(other.heads) <= MAX_TEXTS:
            heads = frozenset(a + h for a in self.texts for h in other.heads)
        if other.texts is not None and len(other.texts) * len(self.tails) <= MAX_TEXTS:
            tails = frozenset(t + b for t in self.tails for b in other.texts)
        return Part(None, heads, tails, need).open()

    def either(self, other: "Part") -> "Part":
        if self.texts is not None and other.texts is not None and len(self.texts | other.texts) <= MAX_TEXTS:
            return Part.of(self.texts | other.texts)
        a, b = self.open(), other.open()
        return Part(None, a.heads | b.heads, a.tails | b.tails, any_of(a.need | b.need))


EMPTY, UNKNOWN = Part.of([""]), Part(None, frozenset([""]), frozenset([""]))


def _signs(codes: Iterable[int]) -> Part:
    """One sign out of these. Others than ASCII are unknown: their lower case may depend on their neighbours."""
    low = {chr(c).lower() for c in codes}
    return Part.of(low) if 0 < len(low) <= MAX_CLASS and all(x.isascii() for x in low) else UNKNOWN


def _class(items: list) -> Part:
    codes: set[int] = set()
    for op, arg in items:
        if op is K.LITERAL:
            codes.add(arg)
        elif op is K.RANGE and arg[1] - arg[0] < 128:
            codes.update(range(arg[0], arg[1] + 1))
        else:  # negated, a named class, or a wide range
            return UNKNOWN
    return _signs(codes)


def _repeat(least: int, most: int, item: Part) -> Part:
    if least == 0:
        return item.either(EMPTY) if most == 1 else UNKNOWN
    copies = min(least, 3)
    out = item
    for _ in range(copies - 1):
        out = out.then(item)
    return out if copies == most else out.open()


def _sequence(tree) -> Part:
    out = EMPTY
    for op, arg in tree:
        if op is K.LITERAL:
            part = _signs([arg])
        elif op is K.IN:
            part = _class(arg)
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            part = _repeat(arg[0], arg[1], _sequence(arg[2]))
        elif op is K.SUBPATTERN:
            part = _sequence(arg[3])
        elif op is K.ATOMIC_GROUP:
            part = _sequence(arg)
        elif op is K.BRANCH:
            first, *others = [_sequence(t) for t in arg[1]]
            for other in others:
                first = first.either(other)
            part = first
        elif op in (K.AT, K.ASSERT, K.ASSERT_NOT):  # of no width
            part = EMPTY
        else:
            part = UNKNOWN
        out = out.then(part)
    return out


#: Syntax that the JVM reads otherwise: Unicode case and comments as flags, octal signs, vertical space.
OTHERWISE = re.compile(r"\(\?[a-zA-Z]*[uUx]|\\0|\\v")


def trigram_query(pattern: str) -> list[list[str]]:
    """OR of ANDs that every text with a match satisfies; empty: nothing is known, and the rule must scan everything."""
    if OTHERWISE.search(pattern):
        return []
    with warnings.catch_warnings():
        warnings.simplefilter("error", FutureWarning)  # sets within sets, which the JVM reads otherwise
        try:
            tree = _parser.parse(pattern)
        except (re.error, FutureWarning):
            return []
    need = _sequence(tree).need
    return [] if need == ANYTHING else sorted(sorted(branch) for branch in need)


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(trigram, block, ids): sorted ids of the documents of a block that contain the trigram."""
    low = F.lower(F.col("text"))
    present = F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in vocabulary])
    # A projection of its own and no function with a lambda over the array, so that generated code lower-cases a
    # text once and not for every trigram; and the outer form, as Spark would else put a filter on the array below
    # the projection and make the array twice.
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", present.alias("present"))
    rows = rows.select("doc_id", F.explode_outer("present").alias("trigram")).filter("trigram IS NOT NULL")
    block = F.floor(F.col("doc_id") / BLOCK).cast("long")
    return rows.groupBy("trigram", block.alias("block")).agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, kinds): the rules whose Boolean query the document satisfies."""
    wanted = {r.kind: trigram_query(r.pattern) for r in rules}
    vocabulary = sorted({t for q in wanted.values() for ts in q for t in ts})
    lists = index.groupBy("block").agg(*[F.first(F.when(F.col("trigram") == t, F.col("ids")), ignorenulls=True).alias(f"t{i}") for i, t in enumerate(vocabulary)])

    def posting(t: str) -> Column:
        return F.coalesce(F.col(f"t{vocabulary.index(t)}"), F.array().cast("array<long>"))

    found = []
    for kind, query in wanted.items():
        union = None
        for branch in query:
            common = posting(branch[0])
            for t in branch[1:]:
                common = F.array_intersect(common, posting(t))
            union = common if union is None else F.array_union(union, common)
        found.append(F.struct(F.lit(kind).alias("kind"), union.alias("ids")))
    by_kind = lists.select(F.explode(F.array(*found)).alias("f")).select("f.kind", F.explode("f.ids").alias("doc_id"))
    return by_kind.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, order, kind, end) of the rule's matches in the text, in order.

    Positions are added up within blocks of ``STEPS`` matches and then over the
    blocks, because each step copies the array made so far: a text with very
    many matches costs little more than the matches themselves.
    """
    regex = F.lit(rule.pattern)
    matches, pieces = F.regexp_extract_all(text, regex, F.lit(0)), F.split(text, rule.pattern, -1)
    lengths = F.transform(matches, F.char_length)
    gaps = F.transform(F.slice(pieces, F.lit(1), F.size(matches)), F.char_length)
    values = F.transform(F.regexp_extract_all(text, regex, F.lit(rule.value)), F.char_length) if rule.value else lengths
    order = [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)
    steps = F.arrays_zip(gaps.alias("gap"), lengths.alias("len"), values.alias("value"))

    def one(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind"), end.alias("end"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["len"]
        return F.struct(end.alias("at"), F.when(x["value"] >= rule.least, F.concat(acc["out"], F.array(one(start, end)))).otherwise(acc["out"]).alias("out"))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda s: one(acc["at"] + s["start"], acc["at"] + s["end"]))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    kind = "array<struct<start:int,order:int,kind:string,end:int>>"
    empty = F.array().cast(kind)
    nothing = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    cuts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(matches), F.lit(1)) - 1) / STEPS).cast("int"))
    blocks = F.transform(cuts, lambda k: F.aggregate(F.slice(steps, k * STEPS + 1, F.lit(STEPS)), nothing, step))
    whole = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out")), join, lambda a: F.flatten(a["out"]))
    return F.when(text.rlike(rule.pattern), F.when(F.size(matches) > STEPS, whole).otherwise(F.aggregate(steps, nothing, step, lambda a: a["out"]))).otherwise(empty)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found): for every row the sorted array of (start, order, kind, end) of all rules."""
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    indexed = [r for r in rules if trigram_query(r.pattern)]
    vocabulary = sorted({t for r in indexed for branch in trigram_query(r.pattern) for t in branch})
    path, spark = scratch(docs.sparkSession, "llm-secret-candidates"), docs.sparkSession
    if indexed:
        candidates(postings(rows, vocabulary), indexed).write.parquet(path)
        hits = spark.read.schema(f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, kinds array<string>").parquet(path)
    else:
        hits = rows.select("doc_id", F.array().cast("array<string>").alias("kinds")).filter(F.lit(False))
    joined = rows.join(hits.withColumnRenamed("doc_id", "hit_id"), F.col("doc_id") == F.col("hit_id"), "left")
    empty = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    parts = []
    for rule in rules:
        own = spans(F.col("text"), rule)
        if rule in indexed:
            own = F.when(F.col("doc_id").isNull() | F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)), own).otherwise(empty)
        parts.append(own)
    return joined.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
