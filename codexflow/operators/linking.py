"""Links between corpora: dictionary matches, references, scored matches and graph neighbours."""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codexflow.operators import patterns as pattern_join
from codexflow.operators.batches import slices
from codexflow.operators.patterns import chosen
from codexflow.operators.ranges import LEVELS, grid_cell
from codexflow.sources.workspace import stored, workspace

#: Patterns that one automaton takes; a larger dictionary is looked for in parts.
MOST_PATTERNS = 500_000
#: Widths of a range from which on a value is compared with each of that size.
HUGE = 1 << 30
#: Values near in a part of a cell beyond which it is cut into 2**CUT, and the k of cells (2**k of the grid) that are cut no further.
CROWD, CUT, FINEST = 32, 4, 2
#: Rows and values of a table of cells up to which it is broadcast, about 10 MB.
SENT = 100_000


def _finder(patterns: list[str], mode: str):
    """Function that gives (begin, stop, pattern) of a text's hits.

    ``overlapping`` reports every hit, ``earliest`` the hit that ends first and then goes on behind it,
    ``longest`` the leftmost hit, the longest of those that begin there.
    """
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for p in patterns:
        if p:
            automaton.add_word(p, p)
    automaton.make_automaton()

    def find(text: str) -> list[tuple[int, int, str]]:
        found = [(end + 1 - len(p), end + 1, p) for end, p in automaton.iter(text)] if len(automaton) else []
        return found if mode == "overlapping" else chosen(found, mode)

    return find


def _parts(patterns: list[str]) -> list[list[str]]:
    distinct = sorted(set(patterns))
    return [distinct[i : i + MOST_PATTERNS] for i in range(0, len(distinct), MOST_PATTERNS)] or [[]]


def find_patterns(texts: DataFrame, id_col: str, text_col: str, patterns: list[str], mode: str = "overlapping", tail: int = 0) -> DataFrame:
    """``id``, ``pattern``, ``begin`` and ``stop`` of every hit, and ``rest``, the ``tail`` characters behind it.

    The patterns (a fixed list of words; a table of them is for ``patterns.find``) go to the tasks as plain strings
    and the texts stream past an automaton. Beyond ``MOST_PATTERNS`` each part of the dictionary has an automaton of its own, one after the
    other, and hits that overlap are chosen among all parts' hits, so the rows are the same.
    """
    parts = [texts.sparkSession.sparkContext.broadcast(p) for p in _parts(patterns)]

    def work(batches):
        finders = [_finder(p.value, mode if len(parts) == 1 else "overlapping") for p in parts]
        for batch in slices(batches):
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hits = [h for find in finders for h in find(t or "")]
                if len(parts) > 1 and mode != "overlapping":
                    hits = chosen(hits, mode)
                rows += [(i, p, a, b, t[b : b + tail]) for a, b, p in hits]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "pattern", "begin", "stop", "rest"])

    kind = texts.schema[id_col].dataType.simpleString()
    found = texts.select(id_col, text_col).mapInArrow(work, f"id {kind}, pattern string, begin int, stop int, rest string")
    return found if tail else found.drop("rest")


def patterns_held(texts: DataFrame, id_col: str, text_col: str, patterns: list[str], mode: str = "overlapping") -> DataFrame:
    """``id`` and ``patterns``, the distinct ones in order, of every text that holds one; and ``lines``, the number of
    its lines that hold each. One row a text: nothing is shuffled to tell or to count."""
    parts = [texts.sparkSession.sparkContext.broadcast(p) for p in _parts(patterns)]

    def work(batches):
        finders = [_finder(p.value, mode if len(parts) == 1 else "overlapping") for p in parts]
        for batch in slices(batches):
            ids, held, lines = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hits = [h for find in finders for h in find(t or "")]
                if len(parts) > 1 and mode != "overlapping":
                    hits = chosen(hits, mode)
                if not hits:
                    continue
                breaks = [k for k, c in enumerate(t) if c == "\n"] if "\n" in t else []
                seen: dict[str, set[int]] = {}
                for a, b, p in hits:
                    line = bisect_left(breaks, a)
                    seen.setdefault(p, set()).update([line] if line == bisect_left(breaks, b - 1) else ())
                ids.append(i)
                held.append(sorted(seen))
                lines.append([len(seen[p]) for p in held[-1]])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(held, pa.list_(pa.string())), pa.array(lines, pa.list_(pa.int64()))], names=["id", "patterns", "lines"])

    kind = texts.schema[id_col].dataType.simpleString()
    return texts.select(id_col, text_col).mapInArrow(work, f"id {kind}, patterns array<string>, lines array<bigint>")


#: Number of an article as it is written: ``第``, digits or numerals, ``条``, and branches after ``の``.
ARTICLE_NUMBER = "第[0-9０-９〇一二三四五六七八九十百千]+条(?:の[0-9０-９〇一二三四五六七八九十百千]+)*"


def own_references(articles: DataFrame, law: str, article: str, number: str, body: str) -> DataFrame:
    """``law``, ``source``, ``said`` and ``target``: references in articles to other articles of their own law.

    What looks like an article's number is shortened character by character, down to its ``条``, and the longest
    beginning that is a number of the law counts: leftmost-longest matching by joins on equal numbers.
    """
    runs = articles.select(F.col(law).alias("law"), F.col(article).alias("source"), F.posexplode(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(ARTICLE_NUMBER), F.lit(0))).alias("at", "run"))
    shorter = F.transform(F.sequence(F.instr("run", "条"), F.length("run")), lambda n: F.left("run", n))
    tried = runs.select("law", "source", "at", F.explode(shorter).alias("said"))
    known = articles.select(F.col(law).alias("law"), F.col(number).alias("said"), F.col(article).alias("target"))
    best = tried.join(known, ["law", "said"]).groupBy("law", "source", "at").agg(F.max_by(F.struct("said", "target"), F.struct(F.length("said"), "target")).alias("b"))
    return best.select("law", "source", "b.said", "b.target").filter("source <> target").distinct()


def link_edges(hits: DataFrame, source: str, target: str, pattern: str, is_number: Column) -> DataFrame:
    """One edge for each pair, its sorted patterns as reasons, stronger if a number was among them."""
    edges = hits.groupBy(source, target).agg(F.array_sort(F.collect_set(pattern)).alias("reasons"), F.bool_or(is_number).alias("by_number"))
    return edges.withColumn("confidence", F.when(F.col("by_number"), F.lit(0.92)).otherwise(F.lit(0.55)))


def mentions(edges: DataFrame, parts: DataFrame, source: str, text_col: str) -> DataFrame:
    """How many parts (speeches) of the source hold a reason of the edge."""
    met = edges.join(parts.select(source, F.col(text_col).alias("part_")), source)
    keys = [c for c in edges.columns if c != "reasons"]
    return met.groupBy(*keys, "reasons").agg(F.count_if(F.exists("reasons", lambda r: F.contains(F.col("part_"), r))).alias("mentions"))


def cross_references(texts: DataFrame, id_col: str, text_col: str, titles: DataFrame, articles: DataFrame, tail: int = 16) -> DataFrame:
    """References to titles of others, with the article that follows within ``tail`` characters.

    ``titles`` has ``title`` and ``target``; ``articles`` has ``target`` and ``article_no``. Titles match
    leftmost-longest; the longest article number that begins the rest wins; own titles don't count.
    """
    titles, articles = stored(titles, "titles"), stored(articles, "articles")  # small ones are known to be so before hits are shuffled
    hits = pattern_join.find(texts, id_col, text_col, titles, "title", 2, "longest", tail)
    rest = hits.select("id", F.col("pattern").alias("title"), "begin", "rest")
    linked = rest.join(titles, "title").filter(F.col("target") != F.col("id"))
    met = linked.join(articles, (linked["target"] == articles["target"]) & F.startswith(F.col("rest"), F.col("article_no")), "left").drop(articles["target"])
    return met.groupBy("id", "title", "begin", "target").agg(F.max_by("article_no", F.length("article_no")).alias("article_no"))


def neighbour_references(rows: DataFrame, group: str, order: str, key: str, text_col: str, before: str, after: str) -> DataFrame:
    """References to the row before (texts that hold ``before``) and after (``after``) within a group."""
    by = Window.partitionBy(group).orderBy(order)
    seen = rows.select(group, F.col(key).alias("source"), F.col(text_col).alias("text_"), F.lag(key).over(by).alias("prev"), F.lead(key).over(by).alias("next"))
    refs = F.array(
        F.when(F.contains("text_", F.lit(before)), F.struct(F.lit("previous").alias("kind"), F.col("prev").alias("target"))),
        F.when(F.contains("text_", F.lit(after)), F.struct(F.lit("next").alias("kind"), F.col("next").alias("target"))),
    )
    return seen.select(group, "source", F.explode(F.filter(refs, lambda r: r["target"].isNotNull())).alias("r")).select(group, "source", "r.kind", "r.target")


def best_match(left: DataFrame, right: DataFrame, left_id: str, rules: list[tuple[str, Column, float]], equal: list[tuple[str, str]], order: Column) -> DataFrame:
    """Best-scored partner of every left row.

    ``rules`` are (name, condition, weight) over the joined columns; candidates come from equi-joins on
    each pair in ``equal``, so nothing is compared with everything. Equal scores go to the first by ``order``.
    """
    score = sum((F.when(c, F.lit(w)).otherwise(F.lit(0.0)) for _, c, w in rules), F.lit(0.0))
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c, _ in rules]))
    parts = [left.join(right, left[a] == right[b]) for a, b in equal]
    met = parts[0]
    for part in parts[1:]:
        met = met.union(part)
    row = F.struct(*[F.col(f"`{c}`") for c in right.columns], score.alias("score"), reasons.alias("reasons"))
    best = met.groupBy(left_id).agg(F.max_by(row, F.struct(score, order)).alias("best"))
    return best.filter("best.score > 0").select(left_id, "best.*")


def best_within(left: DataFrame, right: DataFrame, left_id: str, key: tuple[str, str], value: tuple[str, str], width: float, weights: tuple[float, float, float], order: str) -> DataFrame:
    """Best-scored partner of every left row among the right rows of its key: id, ``order`` of the partner and ``score``.

    ``weights`` are those of the equal key, of values less than ``width`` apart and of values that are both positive or both not; a null
    value meets neither. Equal scores go to the partner of the least ``order``.

    Nothing is paired to be scored: what a left row can meet is looked up by the cell of a grid that its value lies in (``_firsts_by_cell``),
    one record a cell, made of the right rows alone. So left rows are sent on once, to meet by id, and once more if the cells are too many
    to be broadcast. Only values that differ by about ``width`` from those of a crowded cell of the finest grid are compared
    themselves, and values of ``HUGE`` widths and more, beside which such a cell is no longer told apart.
    """
    sign = lambda v: F.col(v) > 0
    finite = lambda v: F.abs(v) < float("inf")
    known = right.select(F.col(key[1]).alias("key_"), F.col(value[1]).cast("double").alias("theirs_"), F.col(order).alias("order_")).filter("key_ is not null")
    known = stored(known.groupBy("key_", "theirs_").agg(F.min("order_").alias("order_")), "values")
    of = lambda c, name: F.min(F.when(c, F.col("order_"))).alias(name)
    signs = stored(known.groupBy("key_").agg(of(sign("theirs_"), "positive_"), of(~sign("theirs_"), "other_"), of(F.col("theirs_").isNull(), "null_")), "signs")
    placed = known.filter(F.abs("theirs_") < HUGE * width).withColumn("at_", grid_cell(F.col("theirs_"), width))
    levels, cuts, left_over = _firsts_by_cell(placed)

    rows = left.select(F.col(left_id).alias("id_"), F.col(key[0]).alias("key_"), F.col(value[0]).cast("double").alias("ours_")).filter("key_ is not null")
    rows = rows.withColumn("at_", F.when(F.abs("ours_") < (HUGE + 1) * width, grid_cell(F.col("ours_"), width)))
    own = sign("ours_")
    near = lambda theirs: F.abs(F.col("ours_") - theirs) < width
    score = lambda near, same: F.lit(weights[0]) + F.lit(weights[1] if near else 0.0) + F.when(same, F.lit(weights[2])).otherwise(F.lit(0.0))
    best_of = lambda s, found: F.when(found.isNotNull(), F.struct((-s).alias("s"), found.alias("order_")))
    like = F.when(own, F.col("positive_")).when(~own, F.col("other_"))
    unlike = F.when(own, F.least("other_", "null_")).when(~own, F.least("positive_", "null_")).otherwise(F.least("positive_", "other_", "null_"))
    # Each place is looked up in a cell of the size to which it is cut; a cell's number and its k are one number here.
    placing = rows.withColumn("k_", F.lit(levels[0][0]))
    for k, crowded in cuts:
        cut = crowded.select("key_", F.col("cell_").alias("cut_"), F.lit(k - CUT).alias("smaller_"))
        placing = placing.withColumn("cut_", F.shiftright("at_", k)).join(_sent(cut, F.lit(1)), ["key_", "cut_"], "left")
        placing = placing.select("id_", "key_", "ours_", "at_", F.coalesce("smaller_", "k_").alias("k_"))
    placing = placing.select("id_", "key_", "ours_", (F.expr("shiftright(at_, k_)") * 32 + F.col("k_")).alias("cell_"))
    cells = reduce(DataFrame.unionByName, [table.withColumn("cell_", F.col("cell_") * 32 + k) for k, table in levels])
    met = placing.join(_sent(cells, 1 + F.size("some_")), ["key_", "cell_"], "left").join(_sent(signs, F.lit(1)), "key_")
    some = F.transform(F.filter("some_", lambda c: near(c["theirs_"])), lambda c: best_of(score(True, own == (c["theirs_"] > 0)), c["order_"]))
    # Of a row's firsts, by its cell and by its key alone, the best is kept at once: it is one record of those that meet by id.
    firsts = [best_of(score(True, own), F.col("above_")), best_of(score(True, ~own), F.col("below_")), F.array_min(some), best_of(score(False, F.lit(True)), like), best_of(score(False, F.lit(False)), unlike)]
    found = met.select("id_", F.least(*firsts).alias("b"))
    pairs = []
    if left_over is not None:
        pairs.append(rows.withColumn("cell_", F.shiftright("at_", levels[-1][0])).join(left_over, ["key_", "cell_"]))
    huge = known.filter(finite("theirs_") & (F.abs("theirs_") >= HUGE * width))
    if not huge.isEmpty():
        pairs.append(rows.filter(finite("ours_") & (F.abs("ours_") >= (HUGE - 1) * width)).join(huge, "key_"))
    for part in pairs:
        found = found.unionByName(part.filter(near(F.col("theirs_"))).select("id_", best_of(score(True, own == sign("theirs_")), F.col("order_")).alias("b")))
    best = found.groupBy("id_").agg(F.min("b").alias("b"))
    return best.select(F.col("id_").alias(left_id), F.col("b.order_").alias(order), (-F.col("b.s")).alias("score"))


def _sent(table: DataFrame, weight: Column) -> DataFrame:
    """A stored table, broadcast if ``weight`` sums up to at most ``SENT``."""
    return F.broadcast(table) if (table.agg(F.sum(weight)).first()[0] or 0) <= SENT else table


def _firsts_by_cell(placed: DataFrame) -> tuple[list[tuple[int, DataFrame]], list[tuple[int, DataFrame]], DataFrame | None]:
    """What a value meets within one width, by ``key_`` and its cell: tables for cells of 2**k cells of the grid, largest first, those
    that are cut into smaller ones, and the values that are left for comparison, with their cell of the finest size.

    ``above_`` and ``below_`` are the least ``order_`` of the positive and of the other values that are near wherever in the cell one is;
    ``some_`` the values that are near in a part of the cell and come before that first. A cell with more than ``CROWD`` of these is
    cut and has no row; in one of the finest size they are left over.
    """
    width, k, at, positive = 1 << LEVELS, LEVELS + 2, F.col("at_"), F.col("theirs_") > 0
    parts = placed.select("key_", "theirs_", "order_", "at_", F.explode(F.sequence(F.shiftright(at - width - 1, k), F.shiftright(at + width + 1, k))).alias("cell_"))
    within = F.explode(F.sequence(F.shiftleft("cell_", CUT), F.shiftleft("cell_", CUT) + ((1 << CUT) - 1))).alias("cell_")
    outer, levels, cuts = None, [], []
    while True:
        k -= CUT
        begin, end = F.shiftleft("cell_", k), F.shiftleft("cell_", k) + ((1 << k) - 1)
        # A value's own cell and a cell's number round down, so one cell more at either end counts as not sure.
        everywhere = (begin >= at - width + 2) & (end <= at + width - 2)
        parts = parts.select("key_", "theirs_", "order_", "at_", within).filter((end >= at - width - 1) & (begin <= at + width + 1))
        first = parts.filter(everywhere).select("key_", "cell_", F.when(positive, F.col("order_")).alias("above_"), F.when(~positive, F.col("order_")).alias("below_"))
        if outer is not None:
            first = first.unionByName(outer.select("key_", within, "above_", "below_"))
        first = stored(first.groupBy("key_", "cell_").agg(F.min("above_").alias("above_"), F.min("below_").alias("below_")), "firsts")
        before = F.when(positive, F.col("above_")).otherwise(F.col("below_"))
        parts = parts.filter(~everywhere).join(first, ["key_", "cell_"], "left").filter(before.isNull() | (F.col("order_") < before))
        parts = stored(parts.select("key_", "theirs_", "order_", "at_", "cell_"), "parts")
        crowded = stored(parts.groupBy("key_", "cell_").agg(F.count("*").alias("n_")).filter(F.col("n_") > CROWD).select("key_", "cell_"), "crowded")
        full = not crowded.isEmpty()
        some = parts.join(crowded, ["key_", "cell_"], "left_anti") if full else parts
        usual = first.join(crowded, ["key_", "cell_"], "left_anti") if full and k > FINEST else first
        none = [F.lit(None).cast(first.schema[c].dataType).alias(c) for c in ("above_", "below_")]
        cells = some.select("key_", "cell_", *none, F.struct("theirs_", "order_").alias("some_"))
        cells = cells.unionByName(usual.select("*", F.lit(None).cast(cells.schema["some_"].dataType).alias("some_")))
        cells = cells.groupBy("key_", "cell_").agg(F.min("above_").alias("above_"), F.min("below_").alias("below_"), F.collect_list("some_").alias("some_"))
        levels.append((k, stored(cells, "cells")))
        if not full:
            return levels, cuts, None
        parts = stored(parts.join(crowded, ["key_", "cell_"]), "parts")
        if k <= FINEST:
            return levels, cuts, parts
        cuts.append((k, crowded))
        outer = stored(crowded.join(first, ["key_", "cell_"], "left"), "outer")


def best_by_keys(left: DataFrame, right: DataFrame, left_id: str, rules: list[tuple[str, str, str, float]], order: str) -> DataFrame:
    """Best-scored partner of every left row, of all right rows: id, ``order`` of the partner, ``score``, ``reasons``.

    ``rules`` are (name, left column, right column, weight); a rule is met if the left value equals the right one or, where
    that is an array, one of its elements. Equal scores go to the partner of the least ``order``.

    Nothing is paired to be scored: of the right rows that agree in a set of rules, only the first can win, so the right
    side shrinks to one row for each set of rules and values, and a left row looks up at most one for each set: what a
    key's rows have in common never meets row by row. A right row's own arrays are multiplied with each other.
    """
    sets = [[k for k in range(len(rules)) if mask >> k & 1] for mask in range(1, 1 << len(rules))]
    for_sets = lambda keys: F.array(*[
        F.when(_all(keys[k].isNotNull() for k in chosen_), F.struct(F.lit(m).alias("set"), F.array(*[keys[k] for k in chosen_]).alias("keys"))) for m, chosen_ in enumerate(sets)
    ])
    values = right.select(F.col(order).alias("order_"), *[F.col(r).alias(f"k{k}_") for k, (_, _, r, _) in enumerate(rules)])
    for k, (_, _, r, _) in enumerate(rules):
        if right.schema[r].dataType.typeName() == "array":
            values = values.withColumn(f"k{k}_", F.explode_outer(F.array_distinct(f"k{k}_")))
    values = values.select("order_", F.explode(F.array_compact(for_sets([F.col(f"k{k}_").cast("string") for k in range(len(rules))]))).alias("s"))
    first = values.groupBy("s.set", "s.keys").agg(F.min("order_").alias("order_"))
    path = workspace(right.sparkSession, "first")  # stored, so that Spark can split the left rows of a hot key
    first.write.parquet(path)
    first = right.sparkSession.read.schema(first.schema).parquet(path)
    asked = left.select(F.col(left_id).alias("id_"), F.explode(F.array_compact(for_sets([F.col(c).cast("string") for _, c, _, _ in rules]))).alias("s")).select("id_", "s.set", "s.keys")
    met = asked.join(first, ["set", "keys"])
    scores = F.array(*[F.lit(round(sum(rules[k][3] for k in chosen_), 6)) for chosen_ in sets])
    best = met.groupBy("id_").agg(F.min(F.struct((-F.element_at(scores, F.col("set") + 1)).alias("s"), "order_", "set")).alias("b"))
    names = F.array(*[F.array(*[F.lit(rules[k][0]) for k in chosen_]) for chosen_ in sets])
    return best.select(F.col("id_").alias(left_id), F.col("b.order_").alias(order), (-F.col("b.s")).alias("score"), F.element_at(names, F.col("b.set") + 1).alias("reasons"))


def _all(conditions) -> Column:
    found = F.lit(True)
    for c in conditions:
        found = found & c
    return found


def title_score(a: Column, b: Column, least: int = 4) -> Column:
    """1 for equal cores, 0.8 if one holds the other and the shorter is long enough, else 0."""
    long = F.least(F.length(a), F.length(b)) >= least
    return F.when(a == b, F.lit(1.0)).when(long & (F.contains(a, b) | F.contains(b, a)), F.lit(0.8)).otherwise(F.lit(0.0))


def reverse_links(links: DataFrame, keys: list[str], target: str) -> DataFrame:
    return links.groupBy(*keys).agg(F.array_sort(F.collect_set(target)).alias("targets"))


def touching(edges: DataFrame, source: str, target: str, node: Column) -> DataFrame:
    """Edges from, to or of a node: ``direction`` says which."""
    hit = edges.filter((F.col(source) == node) | (F.col(target) == node))
    return hit.withColumn("direction", F.when(F.col(source) == F.col(target), "loop").when(F.col(source) == node, "out").otherwise("in"))
