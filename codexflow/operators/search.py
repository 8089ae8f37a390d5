"""Full-text search: postings, Boolean matching, BM25, synonyms, snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexflow.functions.text import tokens as default_tokens

K1, B = 1.2, 0.75
LEAST_IDF = 1e-6


def postings(docs: DataFrame, id_col: str, text_cols: list[str], tokenize=default_tokens, wanted: list[str] | None = None) -> DataFrame:
    """``id``, ``token``, ``tf`` and ``dl`` (tokens of the document over all its indexed columns).

    With ``wanted`` only these tokens are kept, filtered before anything is exploded or shuffled.
    """
    joined = F.concat_ws(" \n ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols])
    cut = docs.select(F.col(id_col).alias("id"), tokenize(joined).alias("all"))
    used = F.filter("all", lambda t: t.isin(*wanted)) if wanted is not None else F.col("all")
    rows = cut.select("id", F.size("all").cast("long").alias("dl"), F.explode(used).alias("token"))
    return rows.groupBy("id", "token").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def match(found: DataFrame, groups: list[list[str]]) -> DataFrame:
    """Ids that hold every token of one group at least."""
    if not any(groups):
        return found.select("id").limit(0)
    names = {t: f"held{n}_" for n, t in enumerate(sorted({t for g in groups for t in g}))}
    held = found.groupBy("id").agg(*[F.bool_or(F.col("token") == t).alias(n) for t, n in names.items()])
    some = F.lit(False)
    for group in groups:
        if group:
            every = F.lit(True)
            for t in set(group):
                every = every & F.col(names[t])
            some = some | every
    return held.filter(some).select("id")


def bm25(docs: DataFrame, id_col: str, text_cols: list[str], groups: list[list[str]], tokenize=default_tokens) -> DataFrame:
    """``id`` and ``score`` of the documents that match; higher is better.

    Two passes of the documents: their number and mean length, and the postings of the query's tokens
    alone (a row a token, so their frequencies are broadcast). Document frequencies are counted over all documents that have a token, matching or not.
    """
    wanted = sorted({t for g in groups for t in g})
    lengths = docs.select(F.size(tokenize(F.concat_ws(" \n ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols]))).alias("dl"))
    corpus = lengths.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()  # two numbers
    n, mean = F.lit(corpus["n"]), F.lit(corpus["avgdl"] or 1.0)
    found = postings(docs, id_col, text_cols, tokenize, wanted or [""])
    df = found.groupBy("token").agg(F.count("*").alias("df"))
    hits = found.join(match(found, groups), "id", "left_semi").join(F.broadcast(df), "token")
    idf = F.greatest(F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(LEAST_IDF))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / mean))
    return hits.groupBy("id").agg(F.sum(part).alias("score"))


def query_tokens(query: str) -> list[str]:
    """Tokens of a query that take part in matching: those of two characters and more."""
    import re

    cjk = "぀-ゟ゠-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿ｦ-ﾝ"
    out = []
    for run in re.findall(rf"[{cjk}]+|(?:(?![{cjk}])[^\W_])+", query):
        if re.match(rf"[{cjk}]", run):
            out += [run[i : i + 2] for i in range(len(run) - 1)] or [run]
        else:
            out.append(run.lower())
    return [t for t in out if len(t) >= 2]


def expansions(query: str, thesaurus: dict[str, list[str]], most: int = 12) -> list[str]:
    """Other forms of every entry of which the query holds a form, in order, without repeats."""
    out: list[str] = []
    for entry, synonyms in thesaurus.items():
        if entry.startswith("_"):
            continue
        forms = [entry, *synonyms]
        if any(f in query for f in forms if len(f) >= 2):
            out += [f for f in forms if f not in query and f not in out]
    return out[:most]


def query_groups(query: str, thesaurus: dict[str, list[str]] | None = None) -> list[list[str]]:
    """Alternatives of a query: its own tokens, and those of each expansion."""
    groups = [query_tokens(query)] + [query_tokens(x) for x in expansions(query, thesaurus or {})]
    return [g for g in groups if g]


def snippet(text: Column, needles: list[str], size: int = 10, tokenize=None) -> Column:
    """Words around the first hit, hits in marks, dots where words are left out."""
    cut = F.split(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), " ")
    bare = F.transform(cut, lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]", ""))
    first = F.array_min(F.array(*[F.nullif(F.array_position(bare, F.lit(n)), F.lit(0)) for n in needles]))
    begin = F.greatest(F.coalesce(first, F.lit(1)) - size // 2, F.lit(1)).cast("int")
    window = F.transform(
        F.slice(cut, begin, F.lit(size)),
        lambda w: F.when(F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]", "").isin(*needles), F.concat(F.lit("<mark>"), w, F.lit("</mark>"))).otherwise(w),
    )
    head, tail = F.when(begin > 1, "...").otherwise(""), F.when(begin + size - 1 < F.size(cut), "...").otherwise("")
    return F.concat(head, F.array_join(window, " "), tail)


def join_bigrams(parts: Column) -> Column:
    """Text of a sequence of bigrams and words: overlaps are folded, words keep a space, ``...`` starts anew."""
    return F.aggregate(
        parts,
        F.struct(F.lit("").alias("text"), F.lit("").alias("last")),
        lambda a, t: F.struct(
            F.when(a.text == "", t)
            .when((a.last == "...") | (t == "..."), F.concat(a.text, t))
            .when((F.length(a.last) == 2) & (F.length(t) == 2) & (F.substring(a.last, 2, 1) == F.substring(t, 1, 1)) & ~t.rlike("^[ -~]"), F.concat(a.text, F.substring(t, 2, 1)))
            .when(a.last.rlike("[ -~]$") & t.rlike("^[ -~]"), F.concat(a.text, F.lit(" "), t))
            .otherwise(F.concat(a.text, t))
            .alias("text"),
            t.alias("last"),
        ),
        lambda a: a.text,
    )
