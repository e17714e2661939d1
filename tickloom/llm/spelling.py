"""Spelling variants among the words of a corpus, by an index of variable-length grams.

Words are decomposed into grams of 2 to 4 code points. Which longer grams exist says a dictionary that
is pruned by frequency: a gram is extended only while it is frequent, so common beginnings become long,
rare grams and rare ones stay short. A word keeps at each place the longest gram of the dictionary
that no earlier gram covers.

For every word the grams that a single edit can destroy are bounded exactly for its own
decomposition: those over the edited place, those left of it that a longer gram reaching into the new
text could replace, and those right of it that a gram coming out of it could cover. A word with g grams
of which an edit affects at most a shares g - a with each word one edit away, so of its lists only the
a + 1 shortest are merged; two words meet if they share a gram, their lengths allow one edit, the text
on one side of the gram is the same, and so is one half of the text on the other. Words whose bound is zero are also filed by their halves, one of which an edit leaves alone.
Whatever meets is verified by its edit distance inside the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

SHORTEST, LONGEST = 2, 4
SLICE = 1024
WORDS_A_TASK, MOST_TASKS = 20_000, 20_000
GRAMS_A_LENGTH = 20_000
#: A gram is extended if it is this many times as frequent as a gram must be to be in the dictionary.
EXTEND = 4
#: Characters put before and after a word, so that grams know its ends. Other texts may hold them too.
BEGIN, END = "\x01", "\x02"


@dataclass
class Dictionary:
    """Grams longer than SHORTEST, their proper beginnings and ends, and how frequent grams are."""

    grams: set[str]
    beginnings: set[str]
    ends: set[str]
    counts: dict[str, int]


def counted_words(words: DataFrame, least_points: int = 5, least_n: int = 3) -> DataFrame:
    """Rows (word, n) of the words of at least ``least_points`` code points that occur ``least_n`` times.

    ``words`` has a row per occurrence, in a column word; tasks count before the shuffle, so a word with a
    third of all rows sends one row per task. Nulls are no words.
    """
    known = words.where(F.length("word") >= least_points).groupBy("word").agg(F.count("*").alias("n"))
    return known.where(F.col("n") >= least_n)


def dictionary(words: DataFrame, grams_a_length: int = GRAMS_A_LENGTH) -> Dictionary:
    """The pruned dictionary of (word, ...): at most ``grams_a_length`` grams of each length, by counting.

    A gram must be as frequent as 1 in ``grams_a_length`` of all grams of its length, which proves the bound.
    """
    marked = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("w"))
    total = marked.agg(F.sum(F.length("w"))).first()[0] or 0
    least = max(2, math.ceil(total / grams_a_length))
    lengths = F.array(*[F.lit(q) for q in range(SHORTEST, LONGEST + 1)])
    places = marked.select("w", F.explode(lengths).alias("q")).where(F.length("w") >= F.col("q"))
    places = places.select("w", "q", F.explode(F.expr("sequence(1, length(w) - q + 1)")).alias("p"))
    counts = places.groupBy(F.expr("substring(w, p, q)").alias("gram")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    found = dict(map(tuple, counts.collect()))
    grams = {g for g in found if len(g) > SHORTEST and found.get(g[:-1], 0) >= EXTEND * least}
    inner = range(SHORTEST, LONGEST)
    return Dictionary(
        grams, {g[:k] for g in grams for k in inner if k < len(g)}, {g[-k:] for g in grams for k in inner if k < len(g)}, {g: n for g, n in found.items() if g in grams or len(g) == SHORTEST}
    )


def decomposed(word: str, grams: set[str]) -> list[tuple[int, int]]:
    """Places and ends (exclusive) of the grams of a marked word."""
    out, end = [], 0
    for p in range(len(word) - SHORTEST + 1):
        q = min(LONGEST, len(word) - p)
        while q > SHORTEST and word[p : p + q] not in grams:
            q -= 1
        if p + q > end:
            end = p + q
            out.append((p, end))
    return out


def affected(word: str, places: list[tuple[int, int]], d: Dictionary) -> int:
    """How many grams of a marked word one edit destroys at most.

    The edit replaces or deletes word[i], or puts something in before word[i] (then nothing is over it but
    grams that hold both neighbours). ``left`` is the first place whose gram could now reach into the
    edit, ``right`` the end of the last gram that could now come out of it.
    """
    most = 0
    for i in range(1, len(word)):
        left = i
        for p in range(max(0, i - LONGEST + 1), i - SHORTEST + 1):
            if word[p:i] in d.beginnings:
                left = p
                break
        for after in (i, i + 1) if i < len(word) - 1 else (i,):
            right = after
            for e in range(min(len(word), after + LONGEST - 1), after + SHORTEST - 1, -1):
                if word[after:e] in d.ends:
                    right = e
                    break
            n = 0
            for s, e in places:
                if e <= i:
                    n += s >= left
                elif s >= after:
                    n += e <= right
                else:
                    n += 1
            most = max(most, n)
    return most


def keys_of(word: str, d: Dictionary) -> tuple[list[tuple[int, int]], bool]:
    """Where the grams whose lists are merged begin and end in a marked word, and whether its bound is zero."""
    marked = BEGIN + word + END
    places = decomposed(marked, d.grams)
    bound = affected(marked, places, d)
    if len(places) <= bound:
        return places, True
    order = sorted((d.counts.get(marked[s:e], 0), marked[s:e], s, e) for s, e in places)
    # Occurrences of the last gram come together, so that two words choose alike.
    last = order[bound][1]
    return [(s, e) for i, (_, gram, s, e) in enumerate(order) if i <= bound or gram == last], False


def halves(text: str, least: int) -> list[tuple[str, int]]:
    """The two halves of a text, of which one edit leaves one alone, and on which side they lie.

    ``least`` is the length of the shorter of the two texts compared; both end alike, with a mark.
    """
    half = least // 2
    return [(text[:half], 1), (text[len(text) - (least - half) :], 2)] if half else [(text[len(text) - least :], 2)]


def lists_of(word: str, d: Dictionary) -> Iterator[tuple[str, int, int, bool]]:
    """The lists (text, side, points, longer) a word is in.

    The edit between two words lies behind a gram that they share, and all up to the gram's end is equal,
    or before it, and all from its start on is. One half of what is left is equal too. So a gram's
    list is kept divided by these texts: ``side`` has the gram's length and which parts they are.
    ``points`` is the length of the shorter word of a pair; ``longer`` rows stand for a word that is one longer.
    """
    marked = BEGIN + word + END
    grams, weak = keys_of(word, d)
    for points, longer in ((len(word), False), (len(word) - 1, True)):
        for s, e in grams:
            for text, side in halves(marked[e:], points + 2 - e) if e < points + 2 else [("", 0)]:
                yield f"{marked[:e]}\n{text}", 10 * (e - s) + side, points, longer
            before = points + 2 - (len(marked) - s)
            for text, side in halves(marked[:s][::-1], before) if before > 0 else [("", 0)]:
                yield f"{text}\n{marked[s:]}", 10 * (e - s) + 5 + side, points, longer
        if weak:
            for text, side in halves(marked[1:], points + 1):
                yield text, side, points, longer


def listed(words: DataFrame, d: Dictionary) -> DataFrame:
    """Rows (word, n, longer, key): the lists that every word is in, named by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), SLICE):
                part = batch.slice(begin, SLICE)
                own = [list(lists_of(word, d)) for word in part["word"].to_pylist()]
                at = [i for i, rows in enumerate(own) for _ in rows]
                columns = zip(*[row for rows in own for row in rows]) if at else ([],) * 4
                types = (pa.string(), pa.int32(), pa.int32(), pa.bool_())
                new = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*part.select(["word", "n"]).take(pa.array(at, pa.int32())).columns, *new], ["word", "n", "text", "side", "points", "longer"])

    tasks = max(1, min(MOST_TASKS, words.count() // WORDS_A_TASK))
    rows = words.select("word", "n").repartition(tasks, "word").mapInArrow(run, "word string, n long, text string, side int, points int, longer boolean")
    return rows.select("word", "n", "longer", F.xxhash64("text", "side", "points").alias("key"))


def near_words(words: DataFrame, grams_a_length: int = GRAMS_A_LENGTH) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of words that differ by exactly one inserted, deleted or replaced code point.

    Each pair comes once, the shorter word or the smaller one first. ``words`` has (word, n), every word
    once. The edit distance is part of the join, so lists of any length put out near words only.
    """
    lists = materialise(listed(words, dictionary(words, grams_a_length)), "spelling-lists")
    a = lists.where("not longer").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = lists.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "longer")
    near = F.levenshtein("a", "b", 1) == 1
    pairs = a.join(b, "key").where((F.col("longer") | (F.col("a") < F.col("b"))) & near)
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def followed(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for (word, form): where the forms of a word lead at last.

    Each round doubles the reach. A form is at least twice as frequent as its word, so a way has at most
    63 steps and six rounds reach its end.
    """
    ways = forms.select("word", F.col("form").alias("root"))
    for _ in range(7):
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        ways = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return ways


def spelling_variants(words: DataFrame, times: int = 2, grams_a_length: int = GRAMS_A_LENGTH) -> DataFrame:
    """Words with the more usual spelling that each is taken for.

    ``words`` has (word, n): every word once and how often it occurs. Two words are near if they differ by
    exactly one inserted, deleted or replaced code point. The form of a word is its near word of the largest
    n (ties: the first in code-point order) if that is at least ``times`` its own n, else null; root is
    what following forms leads to, the word itself without a form. Returns (word, form, root, n, n_near,
    form_n), n_near the number of near words.

    * Null words are left out; empty ones are words. Words may hold any characters and be of any
      length; work per word grows with its length only. An empty table gives an empty result.
    * Repeated words count as one, with the sum of their n; other columns are ignored. ``times`` is at least 2.

    The dictionary is at most ``grams_a_length`` grams of each length and goes to every task; words,
    lists and pairs stay in Spark.
    """
    if times < 2:
        raise ValueError("times is at least 2")
    words = materialise(words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("long").alias("n")), "spelling-words")
    pairs = materialise(near_words(words, grams_a_length), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("at"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    usual = -F.col("best.at") >= F.col("n") * times
    known = materialise(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(usual, F.col("best.near")).alias("form"), F.when(usual, -F.col("best.at")).alias("form_n")), "spelling-forms")
    roots = followed(known.where("form is not null"))
    out = known.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def deleted_at(word: Column, place: Column) -> Column:
    """A word without its code point at ``place``, from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))
