"""Personal data by weak supervision, in DataFrame functions only.

Base spans are matches of one pattern per kind that pass a check. On top of them a wider
pattern per kind proposes candidates. Four labelers vote on each candidate (for, against
or not at all): the base pattern, a check of the digits, a gazetteer of known prefixes,
and the words before it. Expectation-maximisation estimates from the counts of all vote
patterns how reliable each labeler is, and so how likely each pattern is personal data. A
logistic span classifier is then trained on these likelihoods over other features of the
spans; candidates that it accepts are added where no base span of the kind overlaps them.

The whole corpus is counted, by kind, votes and features; only this table, whose size the
votes and features bound, reaches the driver. Null texts count as empty: no spans.
Positions are code points from 0, the end exclusive. Repeated rows get a row each.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lendframe.llm.naming import free_names

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
_LABEL = r"[A-Za-z0-9-]"
#: Written without nested repeats, so that long runs neither overflow a stack nor take quadratic time.
#: ``\G`` lets a match start in a run whose first part an earlier match took.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?=\.{_LABEL})(?:(?!\.(?!{_LABEL}))[A-Za-z0-9.-])++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++\x20?(?:@|\(at\)|\[at\])\x20?{_LABEL}++\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]++(?:(?!\.(?!{_LABEL}))[A-Za-z0-9.-])*+",
    "ip": r"(?<![0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20.-]?[0-9]{4,6}){2}[\x20.-]?[0-9]{2,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]\(?[0-9]{2,4}\)?){1,3}[\x20./-][0-9]{2,5}(?![0-9A-Za-z])",
}
#: Texts without these characters hold no match, and their patterns are not run.
NEEDS = {"email": "@|\\(at\\)|\\[at\\]", "ip": "[0-9]\\.[0-9]", "card": "[0-9]{4}|[0-9][\\x20-][0-9]", "phone": "[0-9]"}
#: Beginnings that real data of a kind have.
GAZETTEER = {
    "email": r"(?i)[@\])]\x20?(?:mail|mx|smtp|gmail|googlemail|outlook|hotmail|yahoo|icloud|proton|gmx|web|aol|orange|wanadoo)[a-z0-9-]*[\x20.(\[]",
    "ip": r"^(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+|00)(?:1|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
}
FOR_WORDS = {
    "email": r"(?i)(?:e-?mail|contact|write|mail|kontakt|correo|courriel|contacto|adresse)[^a-z]*$",
    "ip": r"(?i)(?:\bip|address|host|server|login|from)[^a-z]*$",
    "card": r"(?i)(?:card|visa|credit|payment|karte|carte|tarjeta|konto)[^a-z]*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|cell|telefon|t[ée]l[ée]fono?|m[óo]vil|number)[^a-z]*$",
}
AGAINST_WORDS = r"(?i)(?:version|v|section|chapter|page|pages|isbn|issn|release|ver|year|fig|figure|table|no|build|=|[=\x22'#/_])\s*\.?\s*$"
CONTEXT = 24
LABELERS = ("base", "check", "gazetteer", "context")
FEATURES = ("size", "marks", "before", "lead")
#: Candidates at or above this score are added.
ACCEPT = 0.9
ROUNDS = 60
#: Arrays of more items are worked through in blocks.
LONG = 64
#: Characters of a part of a text.
PART = 2048


def _passes(kind: str, span: Column) -> Column:
    """The check of a base match."""
    digits = F.regexp_replace(span, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(span, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
            F.split(span, r"\."), lambda p: F.coalesce(F.right(F.concat(F.lit("000"), F.ltrim(p, F.lit("0"))), F.lit(3)), F.lit("")) <= "255"
        )
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.length(digits).between(14, 19) & luhn(digits)


def luhn(digits: Column) -> Column:
    """Every second digit from the right counts double, 9 less beyond 9; the sum ends in 0."""
    doubled = "0246813579"
    total = F.aggregate(
        F.zip_with(F.split(F.reverse(digits), ""), F.sequence(F.lit(0), F.greatest(F.length(digits) - 1, F.lit(0))), lambda d, i: F.when(i % 2 == 1, F.translate(d, "0123456789", doubled)).otherwise(d).cast("int")),
        F.lit(0),
        lambda a, b: a + F.coalesce(b, F.lit(0)),
    )
    return total % 10 == 0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, zero: Column, fold: Callable[[Column, Column], Column], put: Callable[[Column, Column], Column], kind: str) -> Column:
    """``put(state, item)`` of every item, where the state is the fold of the items before it.

    ``fold`` must also take a fold in place of an item's state: it is applied to whole blocks.
    Appending to an array copies it, so long arrays are cut into as many blocks as a block
    has items: blocks are folded first, then every block goes on from those before it.
    """
    empty = F.array().cast(f"array<{kind}>")

    def plain(part: Column, state: Column) -> Column:
        start = F.struct(state.alias("state"), empty.alias("made"))
        return F.aggregate(part, start, lambda acc, x: F.struct(fold(acc["state"], x).alias("state"), F.concat(acc["made"], F.array(put(acc["state"], x))).alias("made")), lambda acc: acc["made"])

    def in_blocks(whole: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(whole))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / size).cast("int")), lambda b: F.slice(whole, b * size + 1, size))
        return let(blocks, lambda parts: F.flatten(F.zip_with(parts, starts(parts), plain)))

    def starts(parts: Column) -> Column:
        start = F.struct(zero.alias("state"), F.array().cast("array<int>").alias("made"))
        return F.aggregate(parts, start, lambda acc, part: F.struct(F.aggregate(part, acc["state"], fold).alias("state"), F.concat(acc["made"], F.array(acc["state"])).alias("made")), lambda acc: acc["made"])

    return let(items, lambda whole: F.when(F.size(whole) > LONG, in_blocks(whole)).otherwise(plain(whole, zero)))


def _located(text: Column, pattern: str, needs: str) -> Column:
    """Matches of a pattern as ``array<struct<start, end, span, before>>``.

    The text is cut at the matches, and the lengths of pieces and matches are added up.
    """
    kind = "struct<start:int,end:int,span:string,before:string>"
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("span"))

    def put(at: Column, pair: Column) -> Column:
        begin = at + F.length(pair["piece"])
        return F.struct(begin.alias("start"), (begin + F.length(pair["span"])).alias("end"), pair["span"].alias("span"), F.right(pair["piece"], F.lit(CONTEXT)).alias("before"))

    matched = F.filter(pairs, lambda p: p["span"].isNotNull())
    found = running(matched, F.lit(0), lambda at, pair: at + F.length(pair["piece"]) + F.length(pair["span"]), put, kind)
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(f"array<{kind}>"))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind: ``array<struct<start, order, end, kind>>``."""

    def of(order: int, kind: str) -> Column:
        kept = F.filter(_located(text, BASE[kind], NEEDS[kind]), lambda s: _passes(kind, s["span"]))
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*(of(*k) for k in enumerate(KINDS))))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def candidates(text: Column) -> Column:
    """Wide matches of all kinds with votes and features, as one array of structs."""

    def of(order: int, kind: str) -> Column:
        def described(s: Column) -> Column:
            span, before = s["span"], s["before"]
            digits = F.length(F.regexp_replace(span, "[^0-9]", ""))
            strict = F.regexp_extract(span, f"^(?:{BASE[kind]})$", 0) != ""
            checked = {
                "email": _vote(span.rlike(r"\.\x20?[A-Za-z]{2,}$"), span.rlike(r"[.-]{2}")),
                "ip": _vote(_passes("ip", span), ~_passes("ip", span)),
                "card": _vote(_passes("card", span), ~_passes("card", span)),
                "phone": _vote(digits.between(10, 13), ~digits.between(7, 15) | span.rlike(r"^(?:19|20)[0-9]{2}[-./][01]?[0-9][-./][0-3]?[0-9]$")),
            }[kind]
            marks = F.length(F.regexp_replace(span, "[A-Za-z0-9]", ""))
            return F.struct(
                s["start"].alias("start"),
                F.lit(order).alias("order"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                _vote(strict, F.lit(False)).alias("base"),
                checked.alias("check"),
                _vote(span.rlike(GAZETTEER[kind]), F.lit(kind in ("card", "phone")) & ~span.rlike(GAZETTEER[kind])).alias("gazetteer"),
                _vote(before.rlike(FOR_WORDS[kind]), before.rlike(AGAINST_WORDS)).alias("context"),
                F.least(F.floor(F.length(span) / 4), F.lit(8)).cast("int").alias("size"),
                F.least(marks, F.lit(6)).alias("marks"),
                F.when(before == "", 0).when(before.rlike(r"\s$"), 1).when(before.rlike("[(\\[{<:]$"), 2).otherwise(3).alias("before"),
                F.when(span.startswith("+"), 0).when(span.startswith("("), 1).when(span.rlike("^[0-9]"), 2).otherwise(3).alias("lead"),
            )

        return F.transform(_located(text, WIDE[kind], NEEDS[kind]), described)

    return F.concat(*(of(*k) for k in enumerate(KINDS)))


def estimate(rows: list[tuple[str, tuple[int, ...], tuple[int, ...], int]]) -> dict[tuple, float]:
    """Expectation-maximisation over vote patterns: how likely each (kind, votes) is personal data.

    Votes are taken as independent given the truth; each labeler's three answers get a
    share under either truth, smoothed, starting from labelers that are mostly right.
    """
    likely: dict[tuple, float] = {}
    for kind in KINDS:
        counts: dict[tuple[int, ...], int] = {}
        for k, votes, _, n in rows:
            if k == kind:
                counts[votes] = counts.get(votes, 0) + n
        if not counts:
            continue
        prior = 0.5
        answers = [{1: {1: 0.6, 0: 0.3, -1: 0.1}, 0: {1: 0.1, 0: 0.3, -1: 0.6}} for _ in LABELERS]
        posterior: dict[tuple[int, ...], float] = {}
        for _ in range(ROUNDS):
            for votes in counts:
                yes, no = math.log(prior), math.log(1 - prior)
                for table, vote in zip(answers, votes, strict=True):
                    yes += math.log(table[1][vote])
                    no += math.log(table[0][vote])
                posterior[votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, no - yes))))
            total = sum(counts.values())
            prior = (1 + sum(posterior[v] * n for v, n in counts.items())) / (2 + total)
            for place, table in enumerate(answers):
                for truth in (1, 0):
                    # as if ten spans had been seen that the starting answers fit
                    share = {1: 6.0, 0: 3.0, -1: 1.0} if truth else {1: 1.0, 0: 3.0, -1: 6.0}
                    for votes, n in counts.items():
                        share[votes[place]] += n * (posterior[votes] if truth else 1 - posterior[votes])
                    whole = sum(share.values())
                    table[truth] = {a: s / whole for a, s in share.items()}
        likely |= {(kind, v): p for v, p in posterior.items()}
    return likely


def _active(kind: str, votes: tuple[int, ...], features: tuple[int, ...]) -> list[tuple[str, int]]:
    """Indicator names of a span: the kind, each vote, each feature within the kind."""
    named = [*zip(LABELERS, votes, strict=True), *zip(FEATURES, features, strict=True)]
    return [(kind, 0), *((f"{kind}.{name}", value) for name, value in named)]


def train_spans(rows: list[tuple[str, tuple[int, ...], tuple[int, ...], int]]) -> dict[tuple[str, int], float]:
    """Weights of the span classifier: logistic regression on the estimated likelihoods."""
    likely = estimate(rows)
    data = [(_active(k, v, f), likely[k, v], math.log1p(n)) for k, v, f, n in rows]
    weights: dict[tuple[str, int], float] = {name: 0.0 for names, _, _ in data for name in names}
    for step in range(200):
        gradient = {name: 0.02 * w for name, w in weights.items()}
        size = {name: 1.0 for name in weights}
        for names, target, n in data:
            error = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[x] for x in names))))) - target)
            for name in names:
                gradient[name] += error
                size[name] += n / 4 * len(names)
        for name in weights:
            weights[name] -= gradient[name] / size[name]
    return weights


def learn(docs: DataFrame) -> dict[tuple[str, int], float]:
    """Count the candidates of the whole corpus by kind, votes and features, and train on the counts."""
    found = docs.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("c")).select("c.*")
    table = found.groupBy("kind", *LABELERS, *FEATURES).count().orderBy("kind", *LABELERS, *FEATURES).collect()
    return train_spans([(r["kind"], tuple(r[x] for x in LABELERS), tuple(r[x] for x in FEATURES), r["count"]) for r in table])


def _score(c: Column, weights: dict[tuple[str, int], float]) -> Column:
    """The classifier as an expression over a candidate."""

    def weight(column: Column, prefix: str) -> Column:
        known = {v: w for (name, v), w in weights.items() if name == prefix}
        return reduce(lambda e, item: e.when(column == item[0], F.lit(item[1])), sorted(known.items()), F.when(F.lit(False), F.lit(0.0))).otherwise(F.lit(0.0))

    total = F.lit(0.0)
    for kind in KINDS:
        if (kind, 0) in weights:
            own = reduce(lambda e, name: e + weight(c[name], f"{kind}.{name}"), (*LABELERS, *FEATURES), F.lit(weights[kind, 0]))
            total = F.when(c["kind"] == kind, own).otherwise(total)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


_SPAN = "struct<start:int,own:int,order:int,end:int,kind:string,met:boolean>"


def _apart(base: Column, found: Column) -> Column:
    """The spans of ``found`` that meet none of ``base``.

    Both go in one array by start. A span meets one before it that ends behind its start, the
    farthest end so far tells; or one behind it that starts before its end, the nearest start
    coming from behind tells.
    """

    def listed(spans: Column, own: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit(False).alias("met")))

    def put(met: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
        return lambda state, s: F.struct(*(s[f].alias(f) for f in ("start", "own", "order", "end", "kind")), (s["met"] | (s["own"] == 1) & met(state, s)).alias("met"))

    together = F.array_sort(F.concat(listed(base, 0), listed(found, 1)))
    ahead = running(together, F.lit(-1), lambda end, s: F.when(s["own"] == 0, F.greatest(end, s["end"])).otherwise(end), put(lambda end, s: end > s["start"]), _SPAN)
    behind = running(F.reverse(ahead), F.lit(2**31 - 1), lambda start, s: F.when(s["own"] == 0, F.least(start, s["start"])).otherwise(start), put(lambda start, s: start < s["end"]), _SPAN)
    return F.filter(F.reverse(behind), lambda s: (s["own"] == 1) & ~s["met"])


def all_spans(text: Column, base: Column, weights: dict[tuple[str, int], float]) -> Column:
    """Base spans and accepted candidates, by start, then kind."""
    accepted = F.filter(candidates(text), lambda c: _score(c, weights) >= ACCEPT)

    def joined(kept: Column) -> Column:
        plain = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["order"].alias("order"), c["end"].alias("end"), c["kind"].alias("kind")))
        return F.array_sort(F.concat(base, plain))

    few = lambda found: F.filter(found, lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return let(accepted, lambda found: joined(F.when(F.size(found) + F.size(base) > LONG, F.transform(_apart(base, found), _bare)).otherwise(F.transform(few(found), _bare))))


def _bare(s: Column) -> Column:
    return F.struct(*(s[f].alias(f) for f in ("start", "order", "end", "kind")))


def find_personal_data(docs: DataFrame, keep: list[str] | None = None, names: tuple[str, str, str] = ("__text", "__base", "__spans")) -> DataFrame:
    """``keep`` columns (all by default) with text, base and all spans under the ``names`` given; learned from ``docs`` itself."""
    weights = learn(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]
    own, base, spans = names
    based = docs.select(*kept, text.alias(own), base_spans(text).alias(base))
    return based.select(*kept, own, base, all_spans(F.col(own), F.col(base), weights).alias(spans))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digest of base spans, and all spans written out."""
    found = find_personal_data(docs, ["doc_id"])
    kinds = F.transform("__base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("__base")), 256).alias("base_sha256"), written(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; null texts stay null."""
    names = free_names(docs, "__text", "__base", "__spans")
    found = find_personal_data(docs, names=names)
    text, spans = F.col(names[0]), F.col(names[2])

    def between(parts: Column, low: Column, high: Column) -> Column:
        """Text from a place up to another, from parts of PART characters: to count from the start each time would be quadratic."""
        first, last = (F.floor(x / PART).cast("int") for x in (low, high))
        inside = F.substring(F.get(parts, first), low % PART + 1, high - low)
        head = F.substring(F.get(parts, first), low % PART + 1, F.lit(PART))
        middle = F.array_join(F.slice(parts, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.substring(F.coalesce(F.get(parts, last), F.lit("")), F.lit(1), high % PART)
        return F.when(low >= high, F.lit("")).when(first == last, inside).otherwise(F.concat(head, middle, tail))

    def clean(parts: Column) -> Column:
        def put(at: Column, s: Column) -> Column:
            # a span that starts inside another gives nothing
            return F.when(s["start"] >= at, F.concat(between(parts, at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))

        pieces = running(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]), put, "string")
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), between(parts, end, F.length(text)))

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), 0)
    redacted = F.when(F.size(spans) == 0, F.col("text")).otherwise(let(parts, clean))
    return found.withColumn("text", redacted).select(*[F.col(f"`{c}`") for c in docs.columns])
