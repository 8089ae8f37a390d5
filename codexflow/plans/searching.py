"""Full-text search over ``documents``, ``conversations`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexflow.functions.text import char_ngrams, words
from codexflow.operators import index, search, snippets
from codexflow.plans.base import Tables, query
from codexflow.sources.workspace import workspace

TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
AND_GROUP, DNF_GROUPS = ["the", "of"], [["the", "and", "with"], ["que", "para"], ["und"]]


def _match_sql(table: str, key: str, groups: list[list[str]]) -> str:
    some = " or ".join("(" + " and ".join(f"list_contains(t, '{w}')" for w in g) + ")" for g in groups)
    return f"select {key} from (select {key}, {TOKENS} as t from {table}) where {some}"


def _bm25_sql(table: str, key: str, groups: list[list[str]]) -> str:
    wanted = ", ".join(f"'{w}'" for w in sorted({w for g in groups for w in g}))
    return f"""
    with d as (select {key} as id, {TOKENS} as t from {table}),
    c as (select count(*) as n, avg(len(t)) as avgdl from d),
    p as (select id, len(t) as dl, unnest(t) as token, t from d),
    tf as (select id, token, count(*) as tf, any_value(dl) as dl from p where token in ({wanted}) group by id, token),
    df as (select token, count(*) as df from tf group by token),
    m as (select {key} as id from ({_match_sql(table, key, groups)}))
    select tf.id as {key}, round(sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) as score
    from tf join m using (id) join df using (token) cross join c group by tf.id"""


@query(f"select doc_id, len(t)::bigint as n_tokens, len(list_distinct(t))::bigint as n_distinct, md5(array_to_string(t, ' ')) as tokens_md5 from (select doc_id, {TOKENS} as t from documents)")
def tokenize_documents(t: Tables) -> DataFrame:
    cut = t.documents.select("doc_id", search.default_tokens(F.col("text")).alias("w"))
    return cut.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"), F.md5(F.array_join("w", " ").cast("binary")).alias("tokens_md5"))


@query("select n_nationkey::bigint as n_nationkey, i::bigint as place, substr(n_name, i, 2) as bigram from nation, range(1, 100) r(i) where i < length(n_name)")
def bigram_tokens_nation(t: Tables) -> DataFrame:
    rows = t.nation.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.posexplode(char_ngrams(F.col("n_name"))).alias("p", "bigram"))
    return rows.select("n_nationkey", (F.col("p") + 1).cast("long").alias("place"), "bigram")


_INDICES: dict[tuple[str, str], str] = {}


def _turns(t: Tables) -> DataFrame:
    return t.conversations.select(F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("key"), "text")


def _index(t: Tables) -> str:
    """Path of the stored index of the four corpora; a session writes it once and its searches read it."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _INDICES:
        path = workspace(t.spark, "search-index")
        sources = {
            "document": t.documents.select(F.col("doc_id").alias("key"), "text"),
            "turn": _turns(t),
            "benchmark": t.benchmark.select(F.col("item_id").alias("key"), "text"),
            "page": t.pages.select(F.col("page_id").alias("key"), F.col("html").alias("text")),
        }
        index.write_index(sources, path)
        _INDICES[key] = path
    return _INDICES[key]


def _scored(t: Tables, groups: list[list[str]]) -> DataFrame:
    found = index.search(t.spark, _index(t), "document", groups)
    return found.select(F.col("id").cast("long").alias("doc_id"), F.round("score", 6).alias("score"))


def _matched(t: Tables, groups: list[list[str]]) -> DataFrame:
    wanted = sorted({w for g in groups for w in g})
    return search.match(index.postings(t.spark, _index(t), "document", wanted), groups).select(F.col("id").cast("long").alias("doc_id"))


@query(_match_sql("documents", "doc_id", [AND_GROUP]))
def fts_match_and(t: Tables) -> DataFrame:
    return _matched(t, search.query_groups("The of a"))


@query(_match_sql("documents", "doc_id", DNF_GROUPS))
def fts_match_dnf(t: Tables) -> DataFrame:
    return _matched(t, search.query_groups("the (and) with", {"with": ["que para", "und"]}))


@query(_bm25_sql("documents", "doc_id", DNF_GROUPS) + " order by score desc, doc_id limit 50")
def fts_bm25_topk(t: Tables) -> DataFrame:
    return _scored(t, DNF_GROUPS).orderBy(F.col("score").desc(), "doc_id").limit(50)


@query(_bm25_sql("documents", "doc_id", [AND_GROUP]))
def fts_bm25_scores(t: Tables) -> DataFrame:
    return _scored(t, [AND_GROUP])


@query(f"select s.doc_id, lang, score from ({_bm25_sql('documents', 'doc_id', [AND_GROUP])}) s join documents using (doc_id) where lang in ('en', 'fr') order by score desc, doc_id limit 20")
def fts_category_filter(t: Tables) -> DataFrame:
    kept = t.documents.filter(F.col("lang").isin("en", "fr")).select("doc_id", "lang")
    return _scored(t, [AND_GROUP]).join(kept, "doc_id").select("doc_id", "lang", "score").orderBy(F.col("score").desc(), "doc_id").limit(20)


_FEDERATED = [["the", "and"]]


@query(f"""select 'document' as kind, doc_id::varchar as key, score from ({_bm25_sql('documents', 'doc_id', _FEDERATED)} order by score desc, doc_id::varchar limit 50)
union all select 'turn', key, score from ({_bm25_sql("(select conv_id::varchar || '-' || turn::varchar as key, text from conversations)", 'key', _FEDERATED)} order by score desc, key limit 10)
union all select 'benchmark', key, score from ({_bm25_sql("(select item_id::varchar as key, text from benchmark)", 'key', _FEDERATED)} order by score desc, key limit 10)
union all select 'page', key, score from ({_bm25_sql("(select page_id::varchar as key, html as text from pages)", 'key', _FEDERATED)} order by score desc, key limit 10)""")
def fts_federated(t: Tables) -> DataFrame:
    return index.federated(t.spark, _index(t), _FEDERATED, {"document": 50, "turn": 10, "benchmark": 10, "page": 10, "gazette": 10})


@query(f"""select 'document' as kind, count(*) as n, sum(len({TOKENS}))::bigint as tokens from documents union all select 'turn', count(*), sum(len({TOKENS}))::bigint from conversations
union all select 'benchmark', count(*), sum(len({TOKENS}))::bigint from benchmark union all select 'page', count(*), sum(len(text))::bigint from (select {TOKENS} as text from (select html as text from pages))""")
def index_meta(t: Tables) -> DataFrame:
    return index.meta(t.spark, _index(t))


@query(f"select token, count(*) as df, sum(tf)::bigint as tf from (select doc_id, token, count(*) as tf from (select doc_id, unnest({TOKENS}) as token from documents) group by all) group by token")
def index_tokens(t: Tables) -> DataFrame:
    held = t.spark.read.parquet(f"{_index(t)}/postings").filter("kind = 'document'")
    return held.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query(f"select 'documents' as key, count(*) as value from documents union all select 'tokens', sum(len({TOKENS}))::bigint from documents union all select 'turns', count(*) from conversations union all select 'pages', count(*) from pages")
def fts_meta(t: Tables) -> DataFrame:
    docs = t.documents.agg(F.count("*").alias("documents"), F.sum(F.size(words(F.col("text")))).alias("tokens"))
    pairs = docs.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in ("documents", "tokens")])).alias("r")).select("r.*")
    count = lambda name, rows: rows.agg(F.count("*").alias("value")).select(F.lit(name).alias("key"), "value")
    return pairs.union(count("turns", t.conversations)).union(count("pages", t.pages))


@query()
def fts_snippet(t: Tables) -> DataFrame:
    return t.documents.join(_matched(t, [AND_GROUP]), "doc_id", "left_semi").select("doc_id", search.snippet(F.col("text"), AND_GROUP).alias("snippet"))


@query("select doc_id, case when regexp_matches(lower(coalesce(text, '')), '(^|[^[:alnum:]_])the($|[^[:alnum:]_])') then true else false end as in_text from documents where regexp_matches(lower(coalesce(lang, '') || ' ' || coalesce(source, '') || chr(10) || coalesce(text, '')), '(^|[^[:alnum:]_])(the|de)($|[^[:alnum:]_])')")
def fts_snippet_columns(t: Tables) -> DataFrame:
    """Rows that hold a word in one of three columns, and whether the marks of the text show one of them."""
    plain = t.documents.withColumn("text", F.regexp_replace("text", r"[^\x00-\x7F]", " "))
    found = snippets.snippets(plain, ["doc_id"], ["lang", "source", "text"], [["the"], ["de"]])
    return found.select("doc_id", F.lower(F.element_at("marked", 3)).contains("<mark>the</mark>").alias("in_text"))


@query("select conv_id, turn, text as joined from conversations where text is not null and regexp_matches(text, '^[ -~]+$') and not regexp_matches(text, '  |^ | $|\\.\\.\\.')")
def unbigram_snippet(t: Tables) -> DataFrame:
    plain = t.conversations.filter(F.col("text").rlike("^[ -~]+$") & ~F.col("text").rlike(r"  |^ | $|\.\.\."))
    return plain.select("conv_id", "turn", search.join_bigrams(F.split("text", " ")).alias("joined"))


@query("select o_orderkey, '条約改正...' || o_orderkey || ' word' as folded from orders")
def bigrams_folded(t: Tables) -> DataFrame:
    parts = F.array(*[F.lit(x) for x in ("条約", "約改", "改正", "...")], F.col("o_orderkey").cast("string"), F.lit("word"))
    return t.orders.select("o_orderkey", search.join_bigrams(parts).alias("folded"))


THESAURUS = {"question": ["answer", "reply"], "the": ["this", "that", "x"], "_note": ["the"], "alone": []}
_FORMS = "flatten([case when list_contains(h, 'question') or list_contains(h, 'answer') or list_contains(h, 'reply') then ['question', 'answer', 'reply'] else [] end, case when list_contains(h, 'the') or list_contains(h, 'this') or list_contains(h, 'that') then ['the', 'this', 'that', 'x'] else [] end])"


@query(f"select key, {_FORMS} as forms from (select conv_id || '-' || turn as key, regexp_extract_all(text, 'question|answer|reply|the|this|that') as h from conversations) where len(h) > 0")
def synonym_expand(t: Tables) -> DataFrame:
    return index.appended_forms(_turns(t), "key", "text", THESAURUS).select(F.col("id").alias("key"), "forms")
