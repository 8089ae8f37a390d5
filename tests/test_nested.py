"""Nested diffs against a plain form of their definition."""

import random

from codexflow.operators import nested
from codexflow.operators.textdiff import text_operations

SCHEMA = f"law int, id string, article {nested.ARTICLE}"


def steps(old, new):
    old, new = old or [], new or []
    out = []
    if old and new and all(p[0] is not None for p in old + new):
        earlier = {no: text for no, text in old}
        for no, text in new:
            out.append(("added", no, text, None) if no not in earlier else ("unchanged", no, None, None) if earlier[no] == text else ("modified", no, None, text_operations(earlier[no], text)))
        return out + [("removed", no, text, None) for no, text in old if no not in {p[0] for p in new}]
    for i in range(max(len(old), len(new))):
        if i >= len(old):
            out.append(("added", *new[i], None))
        elif i >= len(new):
            out.append(("removed", *old[i], None))
        else:
            out.append(("unchanged", new[i][0], None, None) if old[i] == new[i] else ("modified", new[i][0], None, text_operations(old[i][1], new[i][1])))
    return out


def make(rng):
    number = rng.random() < 0.7
    return (rng.choice(["第一条", "第二条"]), rng.choice([None, "（題）"]), rng.choice([None, *[[(rng.choice("1234") if number or rng.random() < 0.6 else None, rng.choice(["甲は乙", "甲が乙", "丙", ""])) for _ in range(rng.randint(0, 4))] for _ in range(6)]]))


def test_diffs(spark):
    rng = random.Random(3)
    sides = [{f"art_{k}": make(rng) for k in range(150) if rng.random() < 0.9} for _ in range(2)]
    sides[1] |= {k: v for k, v in sides[0].items() if rng.random() < 0.2}
    tables = [spark.createDataFrame([(1, k, v) for k, v in side.items()], SCHEMA) for side in sides]
    pairs = nested.article_pairs(*tables, ["law", "id"])
    found = {r["id"]: r for r in nested.diff_articles(pairs, unchanged=True).collect()}
    assert set(found) == set(sides[0]) | set(sides[1])
    for k, row in found.items():
        old, new = (side.get(k) for side in sides)
        wanted = "added" if old is None else "removed" if new is None else "unchanged" if old == new else "modified"
        assert row["change"] == wanted
        if wanted == "modified":
            got = [(p["change"], p["paragraph_no"], p["text"], p["text_diff"] and [tuple(o) for o in p["text_diff"]]) for p in row["paragraphs"]]
            assert got == [(c, n, t, ops if c != "modified" else [tuple(o) for o in ops] or ops) for c, n, t, ops in steps(old[2], new[2])]
            assert (row["from_article"]["caption"], row["to_article"]["article_no"]) == (old[1], new[0])
        else:
            assert row["paragraphs"] is None
            whole = row["to_article"] if wanted == "added" else row["from_article"]
            assert (whole is None) == (wanted == "unchanged")
            assert wanted == "unchanged" or (whole["article_no"], whole["caption"], whole["paragraphs"] and [tuple(p) for p in whole["paragraphs"]]) == (new or old)
    (counts,) = nested.diff_counts(nested.diff_articles(pairs, unchanged=True), ["law"]).collect()
    assert sum(counts[c] for c in ("added", "removed", "modified", "unchanged")) == len(found) and counts["modified"] > 40
    assert nested.diff_articles(pairs).count() == len(found) - counts["unchanged"]


def test_heads_and_paragraphs_come_from_one_pass(spark):
    """Each reader of the changes would send them through Python again."""
    from codexflow.plans.registry import QUERIES

    plan = QUERIES["nested_diffs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_steps_of_sliced_and_null_lists():
    import pyarrow as pa

    rng = random.Random(5)
    texts = ["品目3番", "数量は17個とする。", "割引4", "終わり", "ab" * 200, "", None]
    made = lambda: {"change": rng.choice(["modified", "added", "removed", "unchanged"]), "paragraph_no": rng.choice(["1", None]), "old": rng.choice(texts), "new": rng.choice(texts)}
    rows = [None if rng.random() < 0.4 else [made() for _ in range(rng.randint(0, 4))] for _ in range(60)]
    ops = lambda p: [{"op": o, "text": t} for o, t in text_operations(p["old"] or "", p["new"] or "")]
    said = lambda p: {"change": p["change"], "paragraph_no": p["paragraph_no"], "text": {"added": p["new"], "removed": p["old"]}.get(p["change"]), "text_diff": ops(p) if p["change"] == "modified" else None}
    whole = pa.array(rows, pa.list_(pa.struct([(n, pa.string()) for n in ("change", "paragraph_no", "old", "new")])))
    for begin in range(len(rows) + 1):
        found = nested._said(whole.slice(begin), nested._operations)
        found.validate(full=True)
        assert found.to_pylist() == [None if r is None else [said(p) for p in r] for r in rows[begin:]]
