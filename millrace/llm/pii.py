"""Personal data: regular expressions propose, checksums confirm, context adjusts a score.

Only DataFrame functions run, no Python on the executors. A kind's matches are the
leftmost ones that don't overlap; those that fail the kind's check are dropped and
nothing is tried again inside them. Positions come from splitting the text at the
same pattern: a match starts after all pieces and matches before it.

The patterns say the same as the plain ones in their comments. Possessive
quantifiers keep the matcher from backtracking over long runs, and a look-behind
lets a match begin only where a run begins or the last match ended, so matching takes
time in proportion to a text's length. Adding up positions takes time by the square of
the number of matches in one text.

Nulls and edges: a null text is empty and has no spans; every input row gives one
row; repeated rows give equal rows. Columns other than those named are passed on by
``redacted`` and not read by ``personal_data``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before and after a span in which context words count.
NEAR = 40
CONTEXT_WEIGHT = 0.3
THRESHOLD = 0.6


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, a first guess at the score, and words that raise it."""

    name: str
    pattern: str
    prior: float
    words: str
    base: bool = True
    hint: str = "[0-9]"


_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "e-?mail|mail|contact|write", hint="@"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|host|server|address|login"),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.7, "card|visa|credit|pay|carte|tarjeta|karte"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 0.6, "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, "ssn|social|security", base=False),
    Kind("local_phone", r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", 0.4, "phone|call|tel|mobile|fax", base=False),
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total: Column, k: Column) -> Column:
        doubled = back.substr(k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return total + doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN without blanks passes its check: letters as 10 to 35, remainder 1."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        return (rest * F.when(letter, 100).otherwise(10) + F.ascii(c) - F.when(letter, 55).otherwise(48)) % 97

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), add) == 1


_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _valid(kind: Kind, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind.name == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind.name == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind.name == "phone":
        return F.length(digits).between(9, 15)
    if kind.name == "iban":
        return mod97(F.regexp_replace(match, " ", ""))
    if kind.name == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|0000$")
    return F.lit(True)


def _spans(text: Column, lower: Column, kind: Kind, order: int) -> Column:
    """``array<struct<start, order, kind, end, score>>`` of one kind, positions in code points."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    paired = F.arrays_zip(F.split(text, kind.pattern, -1).alias("before"), matches.alias("match"))
    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,match:string>>)").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["before"])
        found = F.array(F.struct(start.alias("start"), pair["match"].alias("match")))
        return F.when(pair["match"].isNull(), state).otherwise(F.struct((start + F.length(pair["match"])).alias("at"), F.concat(state["out"], found).alias("out")))

    located = F.filter(F.aggregate(paired, first, step)["out"], lambda x: _valid(kind, x["match"]))

    def scored(x: Column) -> Column:
        end = x["start"] + F.length(x["match"])
        around = F.concat(
            lower.substr(F.greatest(F.lit(1), x["start"] + 1 - NEAR), F.least(x["start"], F.lit(NEAR))),
            F.lit("\n"),
            lower.substr(end + 1, F.lit(NEAR)),
        )
        raised = F.when(around.rlike(rf"(?<![a-z])(?:{kind.words})(?![a-z])"), CONTEXT_WEIGHT).otherwise(0.0)
        return F.struct(
            x["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"), end.alias("end"), F.round(F.lit(kind.prior) + raised, 2).alias("score")
        )

    spans = F.transform(located, scored)
    spans = spans if kind.base else F.filter(spans, lambda x: x["score"] >= THRESHOLD)
    none = F.expr("cast(array() as array<struct<start:int,order:int,kind:string,end:int,score:double>>)")
    return F.when(text.rlike(f"{kind.hint}") & (F.size(matches) > 0), spans).otherwise(none)


def found_spans(text: Column) -> Column:
    """All spans of a text, by start, then kind as listed.

    Base kinds are confirmed by pattern and check alone and stay whatever their score;
    the others need a score of THRESHOLD, most of them a context word.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.sort_array(F.concat(*(_spans(whole, F.lower(whole), kind, k) for k, kind in enumerate(KINDS))))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _only(kind: str):
    return lambda x: F.when(x["kind"] == kind, x)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found`` of each document."""
    found = docs.select("doc_id", found_spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda x: x["order"] < sum(kind.base for kind in KINDS))
    counts = [F.size(F.array_compact(F.transform("found", _only(k.name)))).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base]
    return found.select("doc_id", *counts, F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("found")).alias("spans"), "found")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets.

    Of spans that overlap the first one stays, widened to the end of the last. A null
    text stays null.
    """
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        inside = x["start"] < state["at"]
        piece = F.concat(state["out"], text.substr(state["at"] + 1, x["start"] - state["at"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(inside, state["out"]).otherwise(piece).alias("out"))

    done = F.aggregate(spans, first, step)
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(F.concat(done["out"], text.substr(done["at"] + 1, F.length(text))))
