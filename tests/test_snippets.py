"""Snippet windows against a search over every window."""

import random

from codexflow.operators import snippets


def search(columns, phrases, size):
    """The best window, by trying all that the definition allows and counting with plain loops."""
    tried = []
    for c, text in enumerate(columns):
        cut = snippets.tokens(text)
        words = [w for w, _, _ in cut]
        hits = [(i, k) for i in range(len(words)) for k, p in enumerate(phrases) if words[i : i + len(p)] == p]
        begins = [i for i in range(len(cut)) if i == 0 or text[cut[i - 1][2] : cut[i][1]].rstrip(" \t\n\r")[-1:] in (".", ":") and text[cut[i][1] - 1] in " \t\n\r"]
        for place, _ in hits:
            for begin in (place, max((b for b in begins if b <= place), default=None)):
                if begin is None or (begin != place and len(cut) <= size):
                    continue
                inside = [h for h in hits if begin <= h[0] < begin + size]
                score = sum(1000 if k not in [j for _, j in inside[:n]] else 1 for n, (_, k) in enumerate(inside))
                if begin == place:
                    first, last = inside[0][0], inside[-1][0] + len(phrases[inside[-1][1]])
                    start = max(0, min(first - (size - (last - first)) // 2, len(cut) - size))
                    tried.append((score, c, start))
                    continue
                tried.append((score + (120 if begin == 0 else 100), c, begin))
    if not tried:
        return None
    best = max(t[0] for t in tried)
    return next((c, s, v) for v, c, s in tried if v == best)


def test_windows():
    rng = random.Random(6)
    for _ in range(400):
        text = lambda n: "".join(rng.choice(["a", "b", "c", "d", "e", "f"]) + rng.choice([" ", " ", ". ", ": ", ".", "\n", "  "]) for _ in range(n))
        columns = [text(rng.randint(0, 5)), text(rng.randint(0, 60)), ""]
        phrases = [["a"], ["b", "c"], ["d"]][: rng.randint(1, 3)]
        assert snippets.best_window(columns, phrases, rng_size := rng.choice([3, 5, 8])) == search(columns, phrases, rng_size)


def test_marks():
    text = "One two. Three four five six seven eight nine ten"
    assert snippets.marked(text, [["three"], ["three", "four"], ["nine"]]) == "One two. <mark>Three four</mark> five six seven eight <mark>nine</mark> ten"
    assert snippets.marked(text, [["seven"]], 5, 3) == "...six <mark>seven</mark> eight..."
    assert snippets.marked(text, [["one"]], 0, 2) == "<mark>One</mark> two..."
    assert snippets.marked("", [["one"]], 0, 2) == ""


def test_rows(spark):
    rows = spark.createDataFrame([(1, "title Law", "x y z. The law of the sea is law " + "w " * 30), (2, None, "nothing"), (3, None, None), (4, "sea", None)], "id int, title string, body string")
    found = {r["id"]: r for r in snippets.snippets(rows, ["id"], ["title", "body"], [["law"], ["sea"], []], 4).collect()}
    assert set(found) == {1, 4}
    assert (found[1]["column"], found[1]["snippet"]) == ("body", "...<mark>law</mark> of the <mark>sea</mark>...")
    assert found[4]["marked"] == ["<mark>sea</mark>", ""]
    assert found[1]["marked"][0] == "title <mark>Law</mark>"
