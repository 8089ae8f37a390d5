"""The pattern join against plain substring search."""

import random

import pytest

from codexflow.operators import linking, patterns


def search(text, wanted, gram, mode):
    hits = [(b, b + len(p), p) for p in set(wanted) if p and len(p) >= gram for b in range(len(text) - len(p) + 1) if text.startswith(p, b)]
    return patterns.chosen(hits, mode)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abc民法\U0001f600") for _ in range(n))
    wanted = [word(rng.randint(0, 7)) for _ in range(60)] + ["aaaa", "aaaa", "aa", None, "never there at all", "民法", "民事訴訟法"]
    texts = [(i, word(rng.randint(0, 60))) for i in range(80)] + [(1, "again " + word(30)), (2, None), (None, "民事訴訟法と民法"), (3, ""), (9, "a" * 3000)]
    texts += [texts[5], texts[5]]
    table = spark.createDataFrame(texts, "id long, text string").repartition(3)
    return texts, wanted, table, spark.createDataFrame([(w,) for w in wanted], "title string")


@pytest.mark.parametrize("mode", ["overlapping", "earliest", "longest"])
@pytest.mark.parametrize("gram", [2, 4])
def test_find(case, mode, gram):
    texts, wanted, table, titles = case
    found = patterns.find(table, "id", "text", titles, "title", gram, mode, 3).collect()
    expected = [(i, p, a, b, t[b : b + 3]) for i, t in texts if t for a, b, p in search(t, wanted, gram, mode)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_runs_of_a_long_text(case, monkeypatch):
    texts, wanted, table, titles = case
    monkeypatch.setattr(patterns, "RUN", 7)
    found = patterns.find(table, "id", "text", titles, "title", 3).count()
    assert found == sum(len(search(t, wanted, 3, "overlapping")) for _, t in texts if t)


def test_held_equals_the_automaton(spark, case):
    _, wanted, table, titles = case
    ours = patterns.held(table, "id", "text", titles, "title", 2).collect()
    theirs = linking.patterns_held(table, "id", "text", [w for w in wanted if w and len(w) >= 2]).collect()
    assert sorted(map(repr, ours)) == sorted(map(repr, theirs))


def test_empty_tables(spark, case):
    _, _, table, titles = case
    assert patterns.find(table.limit(0), "id", "text", titles, "title", 2).count() == 0
    assert patterns.find(table, "id", "text", titles.limit(0), "title", 2).count() == 0


def test_many_patterns(spark):
    """A dictionary that no automaton of a task would hold; the texts hold every thousandth of it."""
    titles = spark.range(300_000).selectExpr("concat('law ', lpad(conv(id * 7919, 10, 36), 7, 'x'), ' of the ', id % 97) as title")
    texts = titles.selectExpr("title", "row_number() over (order by title) as n").filter("n % 1000 = 0").selectExpr("n as id", "concat('see ', title, '!') as text")
    assert patterns.find(texts, "id", "text", titles, "title", 8, "longest").count() == 300


def test_few_patterns_give_the_same_rows_without_a_shuffle(spark):
    rng = random.Random(5)
    texts = spark.createDataFrame([(i % 50, "".join(rng.choice("abc\n") for _ in range(60))) for i in range(60)] + [(7, None), (8, "")], "id int, text string")
    words = spark.createDataFrame([("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))),) for _ in range(25)] + [(None,)], "w string")
    for mode in ("overlapping", "earliest", "longest"):
        found = [patterns.find(texts, "id", "text", words, "w", 2, mode, 3, few) for few in (0, 25)]
        one, other = (sorted(map(tuple, f.collect())) for f in found)
        assert one == other and one
        assert "Exchange" not in found[1]._jdf.queryExecution().executedPlan().toString()
        one, other = (sorted((r["id"], r["patterns"], r["lines"]) for r in patterns.held(texts, "id", "text", words, "w", 2, mode, few).collect()) for few in (0, 25))
        assert one == other and one
