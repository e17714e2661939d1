"""Secret scans in SQL functions only: three patterns, and the entropy of sliding windows.

Candidates are maximal runs of one character class. A window slides over each and carries a count
for every character of the class; one count falls for the character that leaves and one rises for
that which enters, and the entropy follows from the sum of c * log2(c), which changes by these two
counts only. Windows above the threshold of the class that overlap or touch become one span.
The allow-list has two parts: placeholder words part a candidate, so that what stands beside them is
still judged, and whole spans of a harmless form go. It never touches spans of the patterns.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, packed, with_results

#: The three patterns.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


@dataclass(frozen=True)
class Entropy:
    """A character class: its kind in results, its members, the window and the bits it must exceed."""

    kind: str
    members: str
    window: int
    bits: float


#: Windows of 24 hexadecimal digits over 3.05 bits (at most 4), of 24 characters of base64 over 3.9 (at most 4.58).
CLASSES = (Entropy("hex_entropy", "0-9A-Fa-f", 24, 3.05), Entropy("base64_entropy", "A-Za-z0-9+/_=-", 24, 3.9))
#: Spans that aren't secrets: digits or capitals alone, UUIDs.
ALLOW = (
    r"^[0-9]+$",
    r"^[A-Z]+$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
)
#: Words that stand for a secret; they end a candidate as a blank does, one after the other.
PLACEHOLDERS = ("EXAMPLE", "example", "PLACEHOLDER", "placeholder", "0123456789", "ABCDEFGHIJKLM", "abcdefghijklm")
#: What a secret has and a path or list of words lacks: a digit, a plus, a capital after a letter.
UNLIKE_WORDS = r"[0-9+]|[A-Za-z][A-Z]"


def located(text: Column, pattern: str, chunk: int = 256) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, piece>>; starts are code points.

    The pieces between matches come from a split by the same pattern, so a running sum of lengths
    gives the starts. It runs over chunks of matches, which keeps texts with very many cheap.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / chunk).cast("int")), lambda c: F.slice(steps, c * chunk + 1, F.least(F.lit(chunk), F.size(found) - c * chunk)))
    none = F.array().cast("array<struct<start:int,piece:string>>")

    def place(acc: Column, s: Column) -> Column:
        end = acc["at"] + s["g"] + F.length(s["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + s["g"]).alias("start"), s["m"].alias("piece")))).alias("out"))

    def place_all(acc: Column, some: Column) -> Column:
        one = F.aggregate(some, F.struct(acc["at"].alias("at"), none.alias("out")), place)
        return F.struct(one["at"].alias("at"), F.concat(acc["out"], F.array(one["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,piece:string>>>").alias("out"))
    return F.when(F.size(found) > 0, F.flatten(F.aggregate(chunks, start, place_all)["out"])).otherwise(none)


def _spans(places: Column, kind: str, rank: int) -> Column:
    return F.transform(
        places,
        lambda p: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), p["start"].alias("start"), (p["start"] + F.length(p["piece"])).cast("int").alias("end")),
    )


def pattern_spans(text: Column) -> Column:
    """Spans of the three patterns; matches whose value is too short are dropped."""
    assign = F.filter(located(text, ASSIGN), lambda p: F.length(F.regexp_extract(p["piece"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return F.concat(_spans(assign, "assign", 1), _spans(located(text, ACCESS), "access", 2), _spans(located(text, HEX), "hex", 3))


def _let(value: Column, use) -> Column:
    """Bind a value, so that an expression that uses it twice computes it once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _gains(w: int) -> Column:
    """c log2 c - (c - 1) log2(c - 1) for c from 1 to w: what the sum gains when a count rises to c."""
    f = [c * math.log2(c) if c else 0.0 for c in range(w + 1)]
    return F.array(*[F.lit(b - a) for a, b in zip(f, f[1:])])


def alphabet(members: str) -> str:
    """The characters of a class, in the order of code points."""
    return "".join(c for c in map(chr, range(128)) if re.fullmatch(f"[{members}]", c))


def _raised(counts: Column, at: Column, by: int, size: int) -> Column:
    """Counts with the one at a place changed."""
    return F.concat(F.slice(counts, 1, at - 1), F.array(F.element_at(counts, at) + by), F.slice(counts, at + 1, F.lit(size) - at))


def window_spans(start: Column, piece: Column, how: Entropy) -> Column:
    """Spans of one candidate whose windows exceed the entropy: array<struct<start, end>>.

    The characters' places in the class are bound once, as the only element of an array, since what
    an aggregate carries is copied at every step; it carries the counts of one window only.
    """
    w = how.window
    log_w = math.log2(w)
    members = alphabet(how.members)
    size = len(members)

    def walk(chars: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            slides = i > w
            gone = F.element_at(chars, F.greatest(i - w, F.lit(1)))
            leaves = F.when(slides, F.element_at(_gains(w), F.element_at(acc["counts"], gone))).otherwise(F.lit(0.0))
            fewer = F.when(slides, _raised(acc["counts"], gone, -1, size)).otherwise(acc["counts"])
            return _let(fewer, lambda fewer: _let(_raised(fewer, F.element_at(chars, i), 1, size), lambda counts: entered(acc, i, leaves, counts)))

        def entered(acc: Column, i: Column, leaves: Column, counts: Column) -> Column:
            enters = F.element_at(_gains(w), F.element_at(counts, F.element_at(chars, i)))
            return _let(acc["total"] + enters - leaves, lambda total: _let((i >= w) & (log_w - total / w > how.bits), lambda high: after(acc, i, counts, total, high)))

        def after(acc: Column, i: Column, counts: Column, total: Column, high: Column) -> Column:
            fresh = high & (acc["end"] < i - w)
            return F.struct(
                counts.alias("counts"),
                total.alias("total"),
                F.when(fresh, i - w).otherwise(acc["start"]).cast("int").alias("start"),
                F.when(high, i).otherwise(acc["end"]).cast("int").alias("end"),
                F.when(fresh & (acc["end"] >= 0), closed(acc)).otherwise(acc["out"]).alias("out"),
            )

        none = F.array_repeat(F.lit(0), size)
        begin = F.struct(none.alias("counts"), F.lit(0.0).alias("total"), F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), begin, step, lambda acc: F.when(acc["end"] >= 0, closed(acc)).otherwise(acc["out"]))

    def closed(acc: Column) -> Column:
        return F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))

    places = F.transform(F.split(piece, ""), lambda c: F.instr(F.lit(members), c))
    done = F.element_at(F.transform(F.array(places), walk), 1)
    return F.transform(done, lambda s: F.struct((start + s["start"]).cast("int").alias("start"), (start + s["end"]).cast("int").alias("end")))


def _each(how: Entropy):
    return lambda p: window_spans(p["start"], p["piece"], how)


def _named(kind: str, rank: int):
    return lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"))


def _not_allowed(text: Column, allowed: str):
    def keep(s: Column) -> Column:
        piece = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        return ~piece.rlike(allowed) & piece.rlike(UNLIKE_WORDS)

    return keep


def entropy_spans(
    text: Column, classes: tuple[Entropy, ...] = CLASSES, allow: tuple[str, ...] = ALLOW, placeholders: tuple[str, ...] = PLACEHOLDERS
) -> Column:
    """Spans above the entropy of their class, without placeholders and spans that the allow-list names."""
    allowed = "|".join(f"(?:{a})" for a in allow)
    for word in placeholders:  # as many blanks, so that places stay
        text = F.replace(text, F.lit(word), F.lit(" " * len(word)))
    out = []
    for rank, how in enumerate(classes, 4):
        candidates = located(text, f"[{how.members}]{{{how.window},}}")
        found = F.flatten(F.transform(candidates, _each(how)))
        if allow:
            found = F.filter(found, _not_allowed(text, allowed))
        out.append(F.transform(found, _named(how.kind, rank)))
    return F.concat(*out)


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of listing, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(
    docs: DataFrame,
    text_col: str = "text",
    columns: list[str] | None = None,
    classes: tuple[Entropy, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
    placeholders: tuple[str, ...] = PLACEHOLDERS,
) -> DataFrame:
    """A row per input row: the ``columns`` (all by default), then base_spans and entropy_spans.

    Both are array<struct<kind, rank, start, end>> over code points, end exclusive. Base spans come
    from the patterns; the allow-list never touches them. A null or empty text has none; a text is
    scanned whole, however long, in a time that grows with it. No row meets another, so ties and repeated rows are independent and nothing is shuffled. A result takes the
    place of an input column of its name.
    """
    names = docs.columns if columns is None else columns
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.select(packed(docs, names).alias("row"), text.alias("text"))
    found = rows.select("row", pattern_spans(F.col("text")).alias("base"), entropy_spans(F.col("text"), classes, allow, placeholders).alias("added"))
    return with_results(found, "row", names, {"base_spans": F.col("base"), "entropy_spans": F.col("added")})
