"""Personal data by weak supervision; DataFrame functions only.

Fixed patterns find the base spans of each kind, wider patterns further candidates (spelled-out
addresses, other notations). Labelers vote on every match: pattern, checksum or range, gazetteer,
context words before it, and its edges; a labeler may abstain. Only the counts of the vote patterns
(a few hundred at most, whatever the size of the corpus) reach the driver, where expectation
maximisation estimates how reliable each labeler is, and a logistic span classifier is trained on
the estimated labels. Base spans stay; candidates that the classifier accepts are added, unless they
overlap a base span. Time is in proportion to the text and its matches, however many one text has.

Positions are code points. Defined results: an empty table gives an empty one; very long texts are
searched whole; a null text is empty; a text without spans has the hash of the empty string; repeated
rows are searched each on its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.storage import materialize

# The kinds in order, and their base patterns.
KINDS = ("email", "ip", "card", "phone")
# The forms below match what the patterns of the contract match, in linear time: a match starts where
# a run starts or the last match ended, and cards of under 13 digits, which fail, are passed over.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further notations; each is told apart by its own form.
WIDE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+"
        r"(?:\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]++(?:\x20?(?:[(\[{]dot[)\]}]|\.)\x20?[A-Za-z0-9-]++)++"
        r"|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++)"
    ),
    # Eight groups, or fewer around one double colon.
    "ip": (
        r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?=(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])|[0-9A-Fa-f]{3,4}::[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:]))"
        r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})(?![0-9A-Za-z:])"
    ),
    "card": r"(?<![0-9])[0-9]{4}(?:[._/\u00A0\u2009][0-9]{4}){3}(?![0-9])",
    # Three, three and four digits; pairs after a trunk zero; an area code with it; a calling code after 00.
    "phone": (
        r"(?<![0-9+A-Za-z])(?:(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"
        r"|0[1-9](?:[\x20.-][0-9]{2}){4}"
        r"|\(?0[1-9][0-9]{1,3}\)?[\x20/-][0-9]{3,4}[\x20-][0-9]{3,5}"
        r"|00[1-9][0-9]{0,2}(?:[\x20-][0-9]{2,8}){2,4})(?![0-9A-Za-z])"
    ),
}
# Frequent top-level domains, calling codes, issuer prefixes, context words.
DOMAINS = (
    "com org net edu gov mil int info biz name io ai app dev co me tv us uk de fr es it nl be at ch "
    "se no dk fi pl cz pt ie gr ru ua tr in cn jp kr au nz ca mx br ar cl za eu"
).split()
CALLING = r"(?:1|7|2[07]|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
ISSUERS = r"(?:4|5[1-5]|2[2-7]|3[0-9]|6(?:011|2|4|5))"
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|reach|adresse|correo|kontakt)[^a-z]*+$",
    "ip": r"(?i)(?:\bip|host|server|address|login|from)[^a-z]*+$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|payment|karte|carte|tarjeta)[^a-z]*+$",
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|whatsapp|telefon|appelez|llame)[^a-z]*+$",
}
AGAINST = r"(?i)(?:token|hash|key|version|order|serial|isbn|commit|uuid)[^a-z]*+$"
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
# Code points before a match that a context labeler sees.
NEAR = 32
# A private-use character stands around matches; one in the text is taken for another of them.
_MARK, _OTHER = "\ue000", "\ue001"
ROUNDS, STEPS, RATE = 60, 400, 0.5
# Values of a text that are added up in one go; changes cost only.
RUN = 128


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    digits = F.split(F.reverse(_digits(value)), "")

    def worth(digit: Column, place: Column) -> Column:
        number = F.coalesce(digit.try_cast("int"), F.lit(0))
        double = number * 2
        return F.when(place % 2 == 0, number).otherwise(F.when(double > 9, double - 9).otherwise(double))

    total = F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _check(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern holds; the rule of its kind."""
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: F.length(F.regexp_replace(part, "^0+", "")) <= 3,
        ) & F.forall(F.split(value, r"\."), lambda part: part.try_cast("decimal(38,0)") <= 255)
    count = F.length(_digits(value))
    if kind == "card":
        return count.between(13, 19) & _luhn(value)
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _in_gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        last = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)[)\]}]?$", 1))
        return last.isin(DOMAINS)
    if kind == "ip":
        return ~value.rlike(r"^(?:0|10|127|22[4-9]|2[3-5][0-9])\.|^192\.168\.|^169\.254\.")
    if kind == "card":
        return _digits(value).rlike("^" + ISSUERS)
    return ~value.startswith("+") | _digits(value).rlike("^" + CALLING)


def _matches(text: Column, pattern: str) -> Column:
    """The text cut before and after every match; matches have odd places."""
    return F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK, -1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _last(items: Column) -> Column:
    return F.get(items, F.size(items) - 1)


def _running(values: Column, combine, start: int) -> Column:
    """``combine`` over each value and all before it, ``start`` being neutral.

    An array that grows by one is copied each time, so runs of ``RUN`` values are worked out on their
    own, then the values carried into each run, and both are combined.
    """
    none = F.array().cast("array<int>")

    def grown(items: Column, value: Column) -> Column:
        return F.concat(items, F.array(combine(F.coalesce(_last(items), F.lit(start)), value)))

    def worked_out(items: Column) -> Column:
        def run(number: Column) -> Column:
            stop = F.least(number * RUN + RUN, F.size(items)) - 1
            places = F.sequence(number * RUN, stop)
            return F.aggregate(places, none, lambda done, at: grown(done, F.get(items, at)))

        def carried(runs: Column) -> Column:
            begin = F.array(F.lit(start))
            return F.aggregate(runs, begin, lambda done, own: grown(done, _last(own)))

        def combined(runs: Column) -> Column:
            return _let(
                carried(runs),
                lambda before: F.flatten(
                    F.transform(runs, lambda own, at: F.transform(own, lambda v: combine(F.get(before, at), v)))
                ),
            )

        numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / RUN).cast("int"))
        return F.when(F.size(items) > 0, _let(F.transform(numbers, run), combined)).otherwise(none)

    return _let(values, worked_out)


def _located(parts: Column) -> Column:
    """``(start, end, value, before, after)`` of every match."""
    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"

    def of_all(ends: Column) -> Column:
        def match(number: Column) -> Column:
            return F.struct(
                F.get(ends, 2 * number - 2).alias("start"),
                F.get(ends, 2 * number - 1).alias("end"),
                F.get(parts, 2 * number - 1).alias("value"),
                F.right(F.get(parts, 2 * number - 2), F.lit(NEAR)).alias("before"),
                F.left(F.get(parts, 2 * number), F.lit(1)).alias("after"),
            )

        return F.transform(F.sequence(F.lit(1), F.floor(F.size(parts) / 2).cast("int")), match)

    ends = _running(F.transform(parts, F.length), lambda a, b: a + b, 0)
    return F.when(F.size(parts) > 1, _let(ends, of_all)).otherwise(F.array()).cast(kind)


def _apart(asked: Column, base: Column) -> Column:
    """The asked spans that overlap no base span.

    Among all spans by start, one overlaps if a base span before it ends behind its start, or one after it
    starts before its end; so two running extremes tell it for all spans at once.
    """
    far = 2**31 - 1

    def marked(spans: Column, is_base: bool) -> Column:
        return F.transform(
            spans,
            lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                               x["kind"].alias("kind"), F.lit(is_base).alias("base")),
        )

    def of_sorted(spans: Column) -> Column:
        ends = F.transform(spans, lambda x: F.when(x["base"], x["end"]).otherwise(F.lit(-1)))
        starts = F.transform(spans, lambda x: F.when(x["base"], x["start"]).otherwise(F.lit(far)))
        return _let(
            F.struct(
                _running(ends, F.greatest, -1).alias("ends"),
                F.reverse(_running(F.reverse(starts), F.least, far)).alias("starts"),
            ),
            lambda known: F.filter(
                spans,
                lambda x, at: ~x["base"]
                & (F.get(known["ends"], at) <= x["start"])
                & (F.get(known["starts"], at) >= x["end"]),
            ),
        )

    return _let(F.array_sort(F.concat(marked(base, True), marked(asked, False))), of_sorted)


def _vote(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _voted(found: Column, kind: str, base: bool) -> Column:
    """Matches with the vote of every labeler: 1, 0, or -1 for none."""

    def judge(x: Column) -> Column:
        checked = _check(kind, x["value"])
        checks = kind == "card" or (base and kind != "email")
        inside = x["before"].rlike("[A-Za-z0-9]$") | x["after"].rlike("^[A-Za-z0-9]")
        quoted = x["before"].rlike("[\"'=#/_]$")
        votes = {
            "pattern": _vote(checked) if base else F.lit(-1),
            "check": _vote(checked) if checks else F.lit(-1),
            "gazetteer": _vote(_in_gazetteer(kind, x["value"])),
            "context": F.when(x["before"].rlike(CONTEXT[kind]), F.lit(1))
            .when(x["before"].rlike(AGAINST), F.lit(0))
            .otherwise(F.lit(-1)),
            "edges": _vote(~inside & ~quoted),
        }
        return F.struct(
            F.lit(kind).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.lit(base).alias("base"),
            checked.alias("holds"),
            *[votes[name].cast("int").alias(name) for name in LABELERS],
        )

    return F.transform(found, judge)


def candidates(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """The kept columns and ``spans``: all matches of a text with their votes."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), _MARK, _OTHER)
    rows = docs.select(*keep, clean.alias("__text"))
    passes = [(f"{kind}_{form}", kind, form == "base", patterns[kind])
              for form, patterns in (("base", BASE), ("wide", WIDE)) for kind in KINDS]
    rows = rows.select(
        *keep, *[_matches(F.col("__text"), pattern).alias(f"__{name}") for name, _, _, pattern in passes]
    )
    rows = rows.select(
        *keep, *[_located(F.col(f"__{name}")).alias(f"__{name}") for name, _, _, _ in passes]
    )
    voted = [_voted(F.col(f"__{name}"), kind, base) for name, kind, base, _ in passes]
    return rows.select(*keep, F.concat(*voted).alias("spans"))


@dataclass(frozen=True)
class Model:
    """What was learned for each kind: the reliability of the labelers and the weights of its classifier."""

    prior: dict[str, float]
    hits: dict[str, dict[str, float]]
    false_hits: dict[str, dict[str, float]]
    weights: dict[str, dict[str, float]]
    bias: dict[str, float]

    def accepts(self, span: Column) -> Column:
        total = F.lit(0.0)
        for kind in KINDS:
            own = F.lit(self.bias[kind])
            for name in LABELERS:
                vote = F.when(span[name] >= 0, 2.0 * span[name] - 1).otherwise(0.0)
                own = own + F.lit(self.weights[kind][name]) * vote
            total = F.when(span["kind"] == kind, own).otherwise(total)
        return total >= 0


def _posterior(prior: float, hits: dict, false_hits: dict, votes: dict) -> float:
    yes, no = math.log(prior), math.log(1 - prior)
    for name, vote in votes.items():
        if vote >= 0:
            yes += math.log(hits[name] if vote else 1 - hits[name])
            no += math.log(false_hits[name] if vote else 1 - false_hits[name])
    return 1 / (1 + math.exp(max(-60.0, min(60.0, no - yes))))


def _learn_kind(own: list[tuple[dict[str, int], int]]) -> tuple[float, dict, dict, dict, float]:
    """Prior, reliabilities, weights and bias of one kind, from its ``(votes, count)``."""
    truth = []
    for votes, _ in own:
        cast = [v for v in votes.values() if v >= 0]
        truth.append((sum(cast) + 1) / (len(cast) + 2))
    prior, total = 0.5, sum(n for _, n in own)
    hits, false_hits = dict.fromkeys(LABELERS, 0.75), dict.fromkeys(LABELERS, 0.25)
    for _ in range(ROUNDS):
        prior = (sum(t * n for (_, n), t in zip(own, truth)) + 1) / (total + 2)
        for name in LABELERS:
            cast = [(v[name], t, n) for (v, n), t in zip(own, truth) if v[name] >= 0]
            hits[name] = (sum(v * t * n for v, t, n in cast) + 3) / (sum(t * n for _, t, n in cast) + 4)
            false_hits[name] = (sum(v * (1 - t) * n for v, t, n in cast) + 1) / (
                sum((1 - t) * n for _, t, n in cast) + 4
            )
        truth = [_posterior(prior, hits, false_hits, v) for v, _ in own]
    weights, bias = dict.fromkeys(LABELERS, 0.0), 0.0
    for _ in range(STEPS):
        slope, shift = dict.fromkeys(LABELERS, 0.0), 0.0
        for (votes, n), t in zip(own, truth):
            signs = {name: 2 * v - 1 if v >= 0 else 0 for name, v in votes.items()}
            score = bias + sum(weights[name] * s for name, s in signs.items())
            error = (t - 1 / (1 + math.exp(max(-60.0, min(60.0, -score))))) * n / total
            shift += error
            for name, s in signs.items():
                slope[name] += error * s
        for name in LABELERS:
            weights[name] += RATE * (slope[name] - 0.001 * weights[name])
        bias += RATE * shift
    return prior, hits, false_hits, weights, bias


def learn(patterns: list[tuple[str, dict[str, int], int]]) -> Model:
    """Expectation maximisation, then the classifier, on ``(kind, votes, count)``, for each kind alone.

    A labeler that is good for cards may be bad for phones. The estimates are kept off 0 and 1 by a few
    imagined votes, so that few matches teach little; where there is none, the labelers count alike.
    """
    learned = {k: _learn_kind([(v, n) for kind, v, n in patterns if kind == k]) for k in KINDS}
    return Model(*({kind: parts[i] for kind, parts in learned.items()} for i in range(5)))


def fit(found: DataFrame) -> Model:
    """Learn from the votes on all matches of the corpus, counted by pattern."""
    spans = found.select(F.explode("spans").alias("span")).select("span.*")
    counted = spans.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = [(r["kind"], {name: r[name] for name in LABELERS}, r["n"]) for r in counted]
    return learn(sorted(rows, key=lambda r: (r[0], tuple(r[1].values()))))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def _name(kind: str):
    return lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["end"])


def _places(spans: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"),
                                                 x["end"].alias("end")))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, joined by commas."""
    parts = []
    for kind in KINDS:
        ordered = F.array_sort(
            F.transform(_of_kind(spans, kind), lambda x: F.struct(x["start"], x["end"]))
        )
        parts.append(F.transform(ordered, _name(kind)))
    return F.array_join(F.concat(*parts), ",")


def annotate(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with ``n_email, n_ip, n_card, n_phone, base_sha256, spans``."""
    found = materialize(candidates(docs, text, *keep), "pii-candidates")
    model = fit(found)
    base = F.filter("spans", lambda x: x["base"] & x["holds"])
    rows = found.select(*keep, "spans", base.alias("__base"))

    accepted = F.filter("spans", lambda x: ~x["base"] & model.accepts(x))
    rows = rows.select(*keep, "__base", _apart(accepted, F.col("__base")).alias("__added"))
    counts = [
        F.size(_of_kind(F.col("__base"), kind)).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return rows.select(
        *keep,
        *counts,
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
        _listed(F.concat(_places("__base"), _places("__added"))).alias("spans"),
    )
