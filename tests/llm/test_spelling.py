from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import differences
from tests.conftest import DATA
from tests.llm.cases import SCHEMA, none, odd
from tickloom.llm.oracle import ORACLE
from tickloom.llm.queries import misspelt_runs, op12_spelling_variants
from tickloom.llm.spelling import BEGIN, END, Dictionary, affected, counted_words, decomposed, dictionary, lists_of, spelling_variants


def one_edit(word, letters):
    """Every word that is one edit away."""
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        yield word[:i] + word[i + 1 :]


def distance_is_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=2):
    near = {w: [v for v in counts if distance_is_one(w, v)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def variants(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling_variants(df, **options).collect()}


def small_dictionary(grams, frequent=()):
    full = {g[:k] for g in grams for k in range(3, len(g) + 1)} | set(grams)
    inner = lambda g: range(2, len(g))
    return Dictionary(full, {g[:k] for g in full for k in inner(g)}, {g[-k:] for g in full for k in inner(g)}, {g: 5 for g in frequent})


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table_against_sql(spark, sf):
    assert differences(op12_spelling_variants(spark, f"{DATA}/sf{sf}"), ORACLE["op12_spelling_variants"], f"{DATA}/sf{sf}")[:3] == []


@pytest.mark.parametrize("grams_a_length", [5, 300, 20_000])
def test_against_all_pairs(spark, grams_a_length):
    rng = random.Random(grams_a_length)
    words = {"".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(700)} | {"", "a", "ab", "aaaaaaaaaaaaaaa", "aaaaaaaaaaaaaa"}
    words |= {w[:-1] + "日" for w in list(words)[:50]} | {"x" * 500, "x" * 499 + "y", "\x01\x02", "\x01"}
    counts = {w: rng.choice([1, 2, 4, 8, 100]) for w in words}
    assert variants(spark, counts, grams_a_length=grams_a_length) == brute(counts)


@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=9), st.sets(st.text("abc\x01\x02", min_size=3, max_size=4), max_size=12))
def test_an_edit_leaves_grams_and_a_common_list(word, grams):
    d = small_dictionary(grams)
    marked = BEGIN + word + END
    places = decomposed(marked, d.grams)
    own = [marked[s:e] for s, e in places]
    bound = affected(marked, places, d)
    lists = {longer: {row[:3] for row in lists_of(word, d) if row[3] == longer} for longer in (False, True)}
    for other in set(one_edit(word, "abcd")) - {word}:
        rest = [(BEGIN + other + END)[s:e] for s, e in decomposed(BEGIN + other + END, d.grams)]
        shared = sum(min(own.count(g), rest.count(g)) for g in set(own))
        assert shared >= len(own) - bound
        theirs = {longer: {row[:3] for row in lists_of(other, d) if row[3] == longer} for longer in (False, True)}
        if len(other) > len(word):
            assert lists[False] & theirs[True]
        elif len(other) < len(word):
            assert lists[True] & theirs[False]
        else:
            assert lists[False] & theirs[False]


def test_the_dictionary_is_pruned_and_bounded(spark):
    rng = random.Random(3)
    words = ["th" + "".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    d = dictionary(df, 60)
    assert BEGIN + "th" in d.grams and not any(g[0] in "abcdefgh" for g in d.grams)
    assert all(sum(len(g) == q for g in d.grams) <= 60 for q in (3, 4))
    assert dictionary(df.limit(0)).grams == set()


def test_chains_lead_to_the_last_form_and_ties_to_the_first_word(spark):
    counts = {"abcdefg" + "x" * i: 3 ** (i + 1) for i in range(12)}
    counts |= {"zzzzz": 1, "zzzzb": 9, "zzzza": 9}
    got = variants(spark, counts)
    assert got["abcdefg"][:2] == ("abcdefgx", "abcdefg" + "x" * 11)
    assert got["zzzzz"] == ("zzzza", "zzzza", 1, 2, 9) and got["zzzza"][0] is None
    with pytest.raises(ValueError, match="times"):
        variants(spark, counts, times=1)


def test_odd_documents(spark):
    words = {r["word"]: r["n"] for r in counted_words(misspelt_runs(odd(spark)), 3, 2).collect()}
    assert words["lorem"] == 8000 or words["lorem"] == 4000
    assert words["row"] == 3 and words["über"] == 1 if "über" in words else "one" in words
    assert counted_words(misspelt_runs(none(spark))).collect() == []
    empty = spark.createDataFrame([], "word string, n long, form string, root string")
    assert spelling_variants(empty).collect() == []
    rows = spark.createDataFrame([(None, 5, "x"), ("hello", 2, "x"), ("hello", 1, "y"), ("hallo", 9, "z")], "word string, n long, key string")
    assert sorted(map(tuple, spelling_variants(rows).collect())) == [("hallo", None, "hallo", 9, 1, None), ("hello", "hallo", "hallo", 3, 1, 9)]
    assert SCHEMA.names[1] == "text"
