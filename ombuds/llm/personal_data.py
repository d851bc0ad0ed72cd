"""Personal data in texts, by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Spans of four kinds that match exactly (the base) always stay. Looser patterns give further candidates: masked addresses,
numbers without a plus sign, shorter cards, addresses of other lengths. Five labelers vote on every candidate, for, against
or not at all: its form (check digits, ranges), a gazetteer (top-level domains, issuers, reserved networks, calling codes),
words before it, the characters at its borders, and its shape. Expectation-maximisation estimates how reliable each of
them is for each kind, with the base as known cases and what fails its check digits or ranges as known others; the posteriors train a logistic span classifier on features of the
span and its surroundings, and candidates that it takes are added where they don't meet a base span.

Finding, voting and deciding are column expressions over whole texts. Only counts of equal votes and features reach the
driver: their number is bounded by the product of the features' few values, whatever the corpus holds.

Patterns are written without backtracking into repeats (possessive, anchored at the start of a run or where the last match
ended), which changes no match and keeps long runs of digits or letters linear. Places count code points.

NULL texts are empty and have no spans. Ids may be NULL or repeat: each row has its own result. Without rows, or without
candidates of a kind, nothing is learnt and nothing is added. Ties have no part in it: a score of at least the threshold
decides. Columns beside the id and the text are left out, whatever they are called.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ombuds.llm.common import written

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.5

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_EMAIL_START, _NUMBER_START = rf"(?:\G|(?<!{_LOCAL}))", r"(?:\G|(?<![0-9]))"
#: Exact patterns; what they match must also pass ``_passes``.
BASE = {
    "email": rf"{_EMAIL_START}{_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": rf"{_NUMBER_START}[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser ones.
_AT, _DOT = r"(?: ?[\[({] ?at ?[\])}] ?|@)", r"(?: ?[\[({] ?dot ?[\])}] ?|\.)"
LOOSE = {
    "email": rf"{_EMAIL_START}{_LOCAL}++{_AT}{_LABEL}++(?:{_DOT}{_LABEL}++)++",
    "ip": rf"{_NUMBER_START}[0-9]++(?:\.[0-9]++){{2,}}+|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}",
    "card": BASE["card"],
    "phone": r"(?<![0-9A-Za-z])(?:\+|\()?[0-9][ ().0-9-]+[0-9]",
}
#: Texts without a match of this have none of the kind.
_HINT = {"email": r"@|[\[({] ?at ?[\])}]", "ip": r"[0-9]\.[0-9]|[0-9A-Fa-f]:", "card": "[0-9]", "phone": "[0-9]"}
#: Digits that a candidate has, from and to.
_DIGITS = {"card": (13, 19), "phone": (7, 15)}

# Gazetteers and words that speak for and against.
DOMAINS = ("com org net edu gov mil int info biz io ai app dev example test eu us uk de fr es it nl ch at be se no dk fi pl "
           "pt ru cn jp kr in br mx ca au nz za").split()  # fmt: skip
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|62|35|30[0-5]|3[689])"
CALLING = r"^(?:1|7|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[1-9]|37[0-9]|38[0-9]|42[01]|21[1-8]|97[1-7])"
RESERVED = r"^(?:0|127|255|2[4-5][0-9]|22[4-9]|23[0-9])\."
FOR = {
    "email": r"\b(?:e-?mail|mail|contact|write|address|correo|kontakt)\b",
    "ip": r"\b(?:ip|host|server|address|client|from|login)\b",
    "card": r"\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b",
    "phone": r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|m[oó]vil)\b",
}
AGAINST = r"\b(?:token|key|version|v|isbn|issn|order|invoice|sha|md5|hash|chapter|section|page|figure|fig|ref|doi|build|release)\b"

BEFORE, AFTER = 24, 8
#: Lengths that are summed one after another before sums of sums are.
_CHUNK = 256


# Places of matches


def _before(values: Column) -> Column:
    """Sums of the first 0, 1, 2, ... values."""
    return F.aggregate(
        values, F.array(F.lit(0)), lambda sums, value: F.concat(sums, F.array(F.element_at(sums, -1) + value))
    )


def _in_chunks(lengths: Column) -> Column:
    """``_before`` of each chunk of lengths: a list that grows one by one is copied at each step, so it must stay short."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int"))
    return F.transform(numbers, lambda at: _before(F.slice(lengths, at * _CHUNK + 1, _CHUNK)))


def _joined(chunks: str, starts: str) -> Column:
    """Sums before each length, from those of each chunk and the sums before each chunk."""
    both = F.arrays_zip(F.col(chunks).alias("sums"), F.col(starts).alias("start"))
    # ``starts`` has one more, and so has each chunk.
    pairs = F.slice(both, 1, F.size(chunks))
    whole = lambda pair: F.transform(F.slice(pair["sums"], 1, F.size(pair["sums"]) - 1), lambda s: s + pair["start"])
    return F.flatten(F.transform(pairs, whole))


def _found(docs: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """``docs`` with, per name, the matches of its (pattern, hint) in ``text``: structs of value, before, after, start, end."""
    none = F.array().cast("array<string>")
    values = {name: F.when(F.col("text").rlike(hint), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))) for name, (pattern, hint) in names.items()}
    docs = docs.select("*", *(F.coalesce(column, none).alias(name) for name, column in values.items()))
    some = {name: F.when(F.size(name) > 0, F.split("text", pattern, -1)) for name, (pattern, _) in names.items()}
    docs = docs.select("*", *(column.alias(f"{name}_between") for name, column in some.items()))

    def lengths(name: str) -> Column:
        """Of what lies between matches and of matches, in turn."""
        between = F.transform(F.slice(f"{name}_between", 1, F.size(name)), F.length)
        pairs = F.arrays_zip(between.alias("one"), F.transform(name, F.length).alias("two"))
        return F.flatten(F.transform(pairs, lambda pair: F.array(pair["one"], pair["two"])))

    # Each step is a projection of its own, so that none is computed again for every match.
    for step, column in (
        ("lengths", lengths),
        ("chunks", lambda name: _in_chunks(F.col(f"{name}_lengths"))),
        ("starts", lambda name: _before(F.transform(f"{name}_chunks", lambda sums: F.element_at(sums, -1)))),
        ("places", lambda name: _joined(f"{name}_chunks", f"{name}_starts")),
    ):
        docs = docs.select("*", *(F.when(F.size(name) > 0, column(name)).alias(f"{name}_{step}") for name in names))

    def matches(name: str) -> Column:
        between, places = F.col(f"{name}_between"), F.col(f"{name}_places")

        def match(value: Column, at: Column) -> Column:
            start = F.get(places, 2 * at + 1)
            return F.struct(
                value.alias("value"),
                F.lower(F.right(F.get(between, at), F.lit(BEFORE))).alias("before"),
                F.left(F.get(between, at + 1), F.lit(AFTER)).alias("after"),
                start.alias("start"),
                (start + F.length(value)).alias("end"),
            )

        return F.transform(F.col(name), match)

    return docs.select("id", *(matches(name).alias(name) for name in names))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _small_parts(value: Column) -> Column:
    """Whether all numbers between dots are at most 255."""
    figures = F.transform(F.split(value, r"\."), lambda part: F.regexp_replace(part, "^0+", ""))
    return F.forall(figures, lambda part: (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255")))


def _luhn(value: Column) -> Column:
    return F.call_function("luhn_check", _digits(value))


def _passes(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern is of its kind."""
    n = F.length(_digits(value))
    if kind == "card":
        return n.between(16, 19) & _luhn(value)
    return {"email": F.lit(True), "ip": _small_parts(value), "phone": n.between(8, 15)}[kind]


def _known(kind: str, value: Column) -> Column:
    """True for what the base has, false for what fails its check digits or ranges, else NULL."""
    exact = BASE[kind].removeprefix(_EMAIL_START).removeprefix(_NUMBER_START)
    return F.when(value.rlike(f"^(?:{exact})$") & _passes(kind, value), True).when(_form(kind, value) == "-", False)


# Labelers and features of a candidate


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, "+").when(bad, "-").otherwise("0")


def _top_domain(value: Column) -> Column:
    return F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))


def _form(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "email":
        letters = _top_domain(value).rlike("^[a-z]{2,}$")
        return _vote(letters, ~letters)
    if kind == "ip":
        fits = _small_parts(value) & (F.size(F.split(value, r"\.")) == 4) | value.contains(":")
        return _vote(fits, ~fits)
    if kind == "card":
        return _vote(_luhn(value), ~_luhn(value))
    bare = value.rlike(r"^[0-9.]+$")
    return _vote(n.between(10, 13) & ~bare, (n < 8) | bare)


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        return _vote(_top_domain(value).isin(DOMAINS), F.lit(False))
    if kind == "ip":
        return _vote(F.lit(False), value.rlike(RESERVED))
    if kind == "card":
        return _vote(_digits(value).rlike(ISSUERS), ~_digits(value).rlike(ISSUERS))
    return _vote(value.startswith("+") & _digits(value).rlike(CALLING), value.startswith("+") & ~_digits(value).rlike(CALLING))


def _words(kind: str, match: Column) -> Column:
    return _vote(match["before"].rlike(FOR[kind]), match["before"].rlike(AGAINST))


def _borders(match: Column) -> Column:
    inside = match["before"].rlike(r"[\p{L}0-9_=/#\"'.-]$") | match["after"].rlike(r"^[\p{L}0-9_=/\"'@-]|^\.[0-9]")
    return _vote(~inside, inside)


def _shape(kind: str, value: Column) -> Column:
    if kind == "email":
        return _vote(value.rlike(rf"^{_LOCAL}{{2,}}+@\S+$"), value.rlike("^[._%+-]|@-|-$"))
    if kind == "ip":
        return _vote(~value.rlike(r"(?:^|\.)0[0-9]"), value.rlike(r"(?:^|\.)0[0-9]"))
    if kind == "card":
        plain = value.rlike(r"^[0-9]++$") | value.rlike(r"^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$")
        return _vote(plain | value.rlike(r"^[0-9]{4}([ -])[0-9]{6}\1[0-9]{5}$"), value.rlike(r"(?<![0-9])[0-9](?![0-9])"))
    return _vote(value.startswith("+") | value.rlike(r"^\([0-9]{2,5}\) ?[0-9]"), value.rlike(r"^[0-9]+$|\([^)]*$|^[0-9.]+$"))


def votes(kind: str, match: Column) -> Column:
    """The labelers' votes on a match, a character each."""
    value = match["value"]
    return F.concat(_form(kind, value), _gazetteer(kind, value), _words(kind, match), _borders(match), _shape(kind, value))


def _border_kind(text: Column, at_end: bool) -> Column:
    def is_(what: str) -> Column:
        return text.rlike(f"{what}$" if at_end else f"^{what}")

    return F.when(text == "", "edge").when(is_(r"\s"), "space").when(is_(r"[\p{L}0-9_]"), "word").when(
        is_(r"[\"'=/#@]"), "code").otherwise("sign")


def features(kind: str, match: Column) -> Column:
    """What the classifier sees of a match: names, one per feature, of few values each."""
    value = match["value"]
    n = F.length(_digits(value))
    size = F.when(n > 20, 20).otherwise(n) if kind in _DIGITS else F.when(n > 3, 3).otherwise(n)
    parts = {
        "form": F.nullif(_form(kind, value), F.lit("0")),
        "list": F.nullif(_gazetteer(kind, value), F.lit("0")),
        "shape": F.nullif(_shape(kind, value), F.lit("0")),
        "words": F.nullif(_words(kind, match), F.lit("0")),
        "digits": size.cast("string"),
        "left": _border_kind(match["before"], True),
        "right": _border_kind(match["after"], False),
    }
    return F.array_compact(F.array(*(F.concat(F.lit(f"{name} "), part) for name, part in parts.items())))


# Learning


def estimate(counts: list[tuple[str, bool | None, float]], rounds: int = 60) -> list[float]:
    """Posterior that candidates with given votes are real, from ``(votes, known, count)``; what is known stays.

    Labelers err independently given the truth, and a labeler that doesn't vote says nothing. How often each is right on real
    and on other candidates is estimated together with the truth, beginning with the majority; a prior of a few cases says that
    a vote is rather right than wrong.
    """
    if not counts:
        return []
    weight = np.array([count for *_, count in counts], float)
    known = np.array([np.nan if known is None else float(known) for _, known, _ in counts])
    cast = np.array([["-+0".index(vote) for vote in row] for row, *_ in counts])
    pro, con = (cast == 1).sum(axis=1), (cast == 0).sum(axis=1)
    real = np.where(np.isnan(known), np.clip((pro + 1) / (pro + con + 2), 0.05, 0.95), known)
    prior = {1: np.array([1.0, 4.0]), 0: np.array([4.0, 1.0])}
    for _ in range(rounds):
        logs = []
        for truth, share in ((0, 1 - real), (1, real)):
            held = weight * share
            total = np.full(len(counts), np.log((held.sum() + 1) / (weight.sum() + 2)))
            for column in cast.T:
                seen = np.bincount(column, held, 3)[:2] + prior[truth]
                total += np.append(np.log(seen / seen.sum()), 0.0)[column]
            logs.append(total)
        real = np.where(np.isnan(known), 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50))), known)
    return real.tolist()


def train(rows: list[tuple[tuple[str, ...], float, float]], ridge: float = 1.0, steps: int = 30) -> dict[str, float]:
    """Weights of features, and of "" for all, of the logistic regression of ``(features, share real, count)``: Newton steps."""
    if not rows:
        return {}
    names = {name: at for at, name in enumerate(["", *sorted({name for found, *_ in rows for name in found})])}
    x = np.zeros((len(rows), len(names)))
    for at, (found, *_) in enumerate(rows):
        x[at, [0, *(names[name] for name in found)]] = 1
    share, weight = (np.array([row[i] for row in rows], float) for i in (1, 2))
    w = np.zeros(len(names))
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (share - guess)) - ridge * w
        curve = (x * (weight * guess * (1 - guess))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    return dict(zip(names, w.tolist()))


@dataclass(frozen=True)
class Model:
    """Weights of the classifier by kind."""

    weights: dict[str, dict[str, float]]

    def score(self, kind: str, match: Column) -> Column:
        """Probability that a match is personal data; 0 where nothing was learnt."""
        weights = self.weights.get(kind)
        if not weights:
            return F.lit(0.0)
        pairs = [F.lit(part) for pair in weights.items() for part in pair]
        known = F.create_map(*pairs)
        of = lambda name: F.coalesce(F.try_element_at(known, name), F.lit(0.0))
        logit = F.aggregate(features(kind, match), F.lit(weights[""]), lambda total, name: total + of(name))
        return 1 / (1 + F.exp(-logit))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, <kind>, <kind>_loose)``: per kind the base spans and the looser matches of each text."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    names = {kind: (BASE[kind], _HINT[kind]) for kind in KINDS}
    names |= {f"{kind}_loose": (LOOSE[kind], _HINT[kind]) for kind in KINDS if LOOSE[kind] != BASE[kind]}
    found = _found(docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text")), names)

    def loose(kind: str) -> Column:
        matches = F.col(f"{kind}_loose" if f"{kind}_loose" in names else kind)
        least, most = _DIGITS.get(kind, (0, 1 << 30))
        return F.filter(matches, lambda m: F.length(_digits(m["value"])).between(least, most))

    base = {kind: F.filter(F.col(kind), lambda m: _passes(kind, m["value"])) for kind in KINDS}
    columns = (column for kind in KINDS for column in (base[kind].alias(kind), loose(kind).alias(f"{kind}_loose")))
    return found.select("id", *columns)


def fit(found: DataFrame) -> Model:
    """Learn from the result of ``candidates``."""
    weights = {}
    each = [
        found.select(F.explode(f"{kind}_loose").alias("match")).select(
            F.lit(kind).alias("kind"),
            votes(kind, F.col("match")).alias("votes"),
            features(kind, F.col("match")).alias("features"),
            _known(kind, F.col("match.value")).alias("known"),
        )
        for kind in KINDS
    ]
    every = each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])
    counted = every.groupBy("kind", "votes", "features", "known").agg(F.count("*").alias("count")).collect()
    by_kind = defaultdict(list)
    for row in sorted(counted, key=lambda row: (row.kind, row.votes, row.features, str(row.known))):
        by_kind[row.kind].append(row)
    for kind, rows in by_kind.items():
        real = estimate([(row.votes, row.known, row["count"]) for row in rows])
        weights[kind] = train([(tuple(row.features), share, row["count"]) for row, share in zip(rows, real)])
    return Model(weights)


def decide(found: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, base, spans)``: structs (kind, start, end, value, score) by kind, then start; base spans have score 1."""

    def span(kind: str, match: Column, score: Column) -> Column:
        at = F.lit(KINDS.index(kind)).alias("at")
        return F.struct(at, match["start"].alias("start"), match["end"].alias("end"), match["value"].alias("value"), score.alias("score"))

    base = F.flatten(F.array(*(F.transform(F.col(kind), lambda m: span(kind, m, F.lit(1.0))) for kind in KINDS)))

    def more(kind: str) -> Column:
        """What looks like the base isn't more: the base has it, or a part of it."""
        others = F.filter(f"{kind}_loose", lambda m: ~F.coalesce(_known(kind, m["value"]), F.lit(False)))
        return F.transform(others, lambda m: span(kind, m, model.score(kind, m)))

    loose = F.flatten(F.array(*map(more, KINDS)))
    both = found.select("id", base.alias("base"), F.filter(loose, lambda s: s["score"] >= threshold).alias("loose"))
    free = F.filter(
        "loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    # Of two added spans that meet, of different kinds, the first kind listed stays.
    alone = both.select("id", "base", free.alias("free"))
    added = F.filter(
        "free",
        lambda s: ~F.exists("free", lambda o: (o["at"] < s["at"]) & (o["start"] < s["end"]) & (s["start"] < o["end"])),
    )
    kinds = F.array(*(F.lit(kind) for kind in KINDS))

    def named(spans: Column) -> Column:
        return F.transform(F.array_sort(spans), lambda s: s.withField("kind", F.get(kinds, s["at"])).dropFields("at"))

    return alone.select("id", named(F.col("base")).alias("base"), named(F.concat("base", added)).alias("spans"))


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learn from all texts, then ``(id, base, spans)`` of each; see ``decide``."""
    found, _ = written(candidates(docs, id_column, text_column), "candidates")
    return decide(found, fit(found))
